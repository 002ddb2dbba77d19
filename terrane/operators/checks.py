"""Constraints over tables, as tables: what was expected, what is there, and whether that will do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def foreign_key(name: str, child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """link, violations: rows whose key no parent has."""
    missing = child.select(F.col(key).alias("_k")).join(parent.select(F.col(parent_key).alias("_k")), "_k", "left_anti")
    return missing.agg(F.lit(name).alias("link"), F.count(F.lit(1)).alias("violations"))


def bands(counts: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """counts (metric, n) with passed: within the metric's limits; a metric without limits passes."""
    low, high = (F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(v[i]))]) for i in (0, 1))
    ok = F.col("n").between(F.try_element_at(low, F.col("metric")), F.try_element_at(high, F.col("metric")))
    return counts.select("metric", "n", F.coalesce(ok, F.lit(True)).alias("passed"))


def drop_against(before: DataFrame, now: DataFrame, most: float) -> DataFrame:
    """metric, before, now, passed: not more than a share of `most` lost; what is new passes, what is gone doesn't."""
    both = before.join(now, "metric", "full")
    ok = F.col("before").isNull() | (F.coalesce("now", F.lit(0)) >= F.col("before") * (1 - most))
    return both.select("metric", "before", "now", ok.alias("passed"))


def violations(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rule, violations: in one pass over the rows; rules without any are left out."""
    broken = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]))
    return rows.select(F.explode(broken).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("violations"))


def meta_equals(meta: DataFrame, expected: dict[str, str]) -> DataFrame:
    """key, expected, actual, passed for a key-value table."""
    want = meta.sparkSession.createDataFrame(list(expected.items()), "key string, expected string")
    return want.join(meta.select("key", F.col("value").alias("actual")), "key", "left").withColumn("passed", F.coalesce(F.col("expected") == F.col("actual"), F.lit(False)))


def binding(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """key, expected, actual, passed: facts (key, value) that two documents must agree on, missing ones included."""
    both = expected.withColumnRenamed("value", "expected").join(actual.withColumnRenamed("value", "actual"), "key", "full")
    return both.select("key", "expected", "actual", F.col("expected").eqNullSafe(F.col("actual")).alias("passed"))


def trips(legs: DataFrame) -> DataFrame:
    """trip, legs, crosses, passed: a trip passes if none of its legs crosses."""
    return legs.groupBy("trip").agg(F.count(F.lit(1)).alias("legs"), F.bool_or("crosses").alias("crosses")).withColumn("passed", ~F.col("crosses"))


def problems(checks: DataFrame) -> DataFrame:
    """name, passed, problems of rows (name, problem), where a null problem is none."""
    return checks.groupBy("name").agg(F.sort_array(F.collect_set("problem")).alias("problems")).select("name", (F.size("problems") == 0).alias("passed"), "problems")


def release_tag(when: Column, commit: Column) -> Column:
    """vYYYY.MM.DD-commit with seven digits of the commit; anything else raises."""
    tag = F.concat(F.lit("v"), F.date_format(when, "yyyy.MM.dd"), F.lit("-"), F.substring(commit, 1, 7))
    return F.when(tag.rlike(r"^v\d{4}\.\d{2}\.\d{2}-[0-9a-f]{7}$"), tag).otherwise(F.raise_error(F.concat(F.lit("no release tag: "), tag)))


def luminance(colour: Column) -> Column:
    """Relative luminance of #rrggbb."""
    def part(at: int) -> Column:
        v = F.conv(F.substring(colour, at, 2), 16, 10).cast("double") / 255.0
        return F.when(v <= 0.04045, v / 12.92).otherwise(F.pow((v + 0.055) / 1.055, F.lit(2.4)))

    return 0.2126 * part(2) + 0.7152 * part(4) + 0.0722 * part(6)


def contrast(a: Column, b: Column) -> Column:
    """Contrast ratio of two colours, 1 to 21."""
    x, y = luminance(a), luminance(b)
    return (F.greatest(x, y) + 0.05) / (F.least(x, y) + 0.05)
