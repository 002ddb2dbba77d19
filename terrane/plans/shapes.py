"""The driver's tables as map-shaped data, deterministically, in Spark and in SQL alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from .registry import table

COUNTRY, OCCUPIED, HARD_MARGIN, BAND_MARGIN = (44.0, 41.5, 45.0, 42.5), (44.6, 42.2, 44.8, 42.4), 0.02, 0.08
CLASSES = ("motorway", "trunk", "primary", "secondary", "tertiary", "residential", "service", "track")


def grown(box: tuple[float, float, float, float], by: float) -> tuple[float, float, float, float]:
    return round(box[0] - by, 6), round(box[1] - by, 6), round(box[2] + by, 6), round(box[3] + by, 6)


ZONES = {"country": COUNTRY, "occupied": OCCUPIED, "hard": grown(OCCUPIED, HARD_MARGIN), "band": grown(OCCUPIED, BAND_MARGIN)}


def zone_rings() -> dict[str, geo.Rings]:
    return {k: [geo.rectangle(*v)] for k, v in ZONES.items()}


def lat(key: Column) -> Column:
    return F.lit(41.4) + F.lit(1.2) * ((key * 7919) % 10007).cast("double") / 10007.0


def lon(key: Column) -> Column:
    return F.lit(43.9) + F.lit(1.2) * ((key * 104729) % 10009).cast("double") / 10009.0


def points(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """The table with lat and lon, which follow from its key; dealt by it, as a small file would be one task's however many rows it holds."""
    return table(spark, sf_dir, name).repartition(F.col(key)).withColumn("lat", lat(F.col(key))).withColumn("lon", lon(F.col(key)))


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is a way whose nodes are its parts: way, refs, line, tags."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    rows = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"))).alias("r"))
    out = rows.select(F.col("l_orderkey").alias("way"), F.transform("r", lambda x: x["l_partkey"]).alias("refs"))
    names = F.array(*map(F.lit, CLASSES))
    return out.withColumn("line", F.transform("refs", lambda k: geo.point(lon(k), lat(k)))).withColumn("class", F.get(names, (F.col("way") % len(CLASSES)).cast("int"))).withColumn("class_rank", (F.col("way") % len(CLASSES)).cast("int"))


def order_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as tagged ways: way, tags."""
    o = table(spark, sf_dir, "orders")
    names = F.array(*map(F.lit, CLASSES))
    pairs = F.create_map(
        F.lit("highway"), F.get(names, (F.col("o_orderkey") % len(CLASSES)).cast("int")), F.lit("oneway"), F.when(F.col("o_orderstatus") == "F", "yes").when(F.col("o_orderstatus") == "O", "no").otherwise("-1"),
        F.lit("maxspeed"), F.concat((F.col("o_orderkey") % 9 * 10 + 20).cast("string"), F.when(F.col("o_orderkey") % 5 == 0, " mph").when(F.col("o_orderkey") % 5 == 1, " km/h").otherwise("")),
        F.lit("access"), F.when(F.col("o_custkey") % 7 == 0, "private").when(F.col("o_custkey") % 7 == 1, "no").when(F.col("o_custkey") % 7 == 2, "agricultural;destination").otherwise("yes"),
        F.lit("motor_vehicle"), F.when(F.col("o_custkey") % 11 == 0, "no").when(F.col("o_custkey") % 11 == 1, "delivery").otherwise(""),
    )
    return o.select(F.col("o_orderkey").alias("way"), F.map_filter(pairs, lambda _, v: v != "").alias("tags"))


# ---------------------------------------------------------------- the same in SQL


def sql_lat(k: str) -> str:
    return f"(41.4::DOUBLE + 1.2::DOUBLE * (({k} * 7919) % 10007)::DOUBLE / 10007.0::DOUBLE)"


def sql_lon(k: str) -> str:
    return f"(43.9::DOUBLE + 1.2::DOUBLE * (({k} * 104729) % 10009)::DOUBLE / 10009.0::DOUBLE)"


def sql_metres(a: str, b: str, c: str, d: str) -> str:
    return f"(2 * {geo.EARTH_M}::DOUBLE * asin(least(1.0::DOUBLE, sqrt(pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2)))))"


def sql_in(zone: str, lat: str, lon: str) -> str:
    a, b, c, d = ZONES[zone]
    return f"({lon} >= {a}::DOUBLE AND {lon} < {c}::DOUBLE AND {lat} >= {b}::DOUBLE AND {lat} < {d}::DOUBLE)"


def sql_zone(lat: str, lon: str) -> str:
    has = lambda z: sql_in(z, lat, lon)
    return f"CASE WHEN NOT {has('country')} THEN 'outside' WHEN {has('hard')} AND NOT {has('occupied')} THEN 'buffer' WHEN {has('hard')} THEN 'occupied' WHEN {has('band')} THEN 'band' END"


def sql_points(table: str, key: str) -> str:
    return f"(SELECT *, {sql_lat(key)} AS lat, {sql_lon(key)} AS lon FROM {table})"


SQL_WAYNODES = f"""(SELECT l_orderkey AS way, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) - 1 AS pos,
    l_partkey AS node, {sql_lat('l_partkey')} AS lat, {sql_lon('l_partkey')} AS lon FROM lineitem)"""
