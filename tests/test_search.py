"""Candidates of a search on hand-made rows."""

from pyspark.sql import functions as F

from terrane.operators import search


def _words(spark, texts):
    return search.parsed(spark.createDataFrame(list(enumerate(texts)), "q int, text string"))


def test_near_and_city_rows_below_the_cap(spark):
    rows = spark.range(1, 121).select("id", F.lit(41.7).alias("lat"), F.when(F.col("id") == 120, 44.8).otherwise(43.0).alias("lon"), F.when(F.col("id") == 119, 7).otherwise(1).alias("city_id"))
    index = rows.select("id", F.lit("red").alias("key"))
    near = spark.createDataFrame([(0, 41.7, 44.8)], "q int, q_lat double, q_lon double")
    cities = spark.createDataFrame([(1, 7, 41.7, 44.8, 5.0)], "q int, city_id int, c_lat double, c_lon double, reach_km double")
    got = {(r.q, r.id) for r in search.candidates(_words(spark, ["red", "red"]), index, 80, rows, near, cities).collect()}
    assert got == {(0, i) for i in [*range(1, 81), 120]} | {(1, 119), (1, 120)}


def test_numbers(spark):
    index = spark.createDataFrame([(1, "37"), (2, "37a"), (3, "375"), (4, "red")], "id long, key string")
    assert {r.id for r in search.matches(_words(spark, ["37"]), index).collect()} == {1, 2}
    words = search.optional_numbers(_words(spark, ["red 37"]))
    assert {r.id for r in search.candidates(words, index).collect()} == {4}
