"""Ranks and votes: row ids without one partition, top rows per group, weighted names, medoids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import checkpointed


def row_ids(rows: DataFrame, order: list[Column], column: str = "id", parts: int | None = None) -> DataFrame:
    """Dense ids from 1 in the given order over a whole table.

    Rows are sorted by ranges (as many as the session's shuffles have partitions, if not told), written down so
    that numbers can't change where a part is computed again, and numbered within each; the ranges' sizes (one
    row each) give what to add, so no task sees more than its range.
    """
    dealt = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    sorted_ = checkpointed(dealt.sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id()))
    sizes = sorted_.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min("_seq").alias("_low"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = F.broadcast(sizes.select("_part", "_low", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base")))
    return sorted_.join(base, "_part").withColumn(column, (F.col("_base") + F.col("_seq") - F.col("_low") + 1).cast("long")).drop("_part", "_seq", "_low", "_base")


def top_per_group(rows: DataFrame, group: list[str], order: list[Column], n: int, column: str = "rank") -> DataFrame:
    return rows.withColumn(column, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(column) <= n)


def weighted_vote(rows: DataFrame, group: list[str], value: str, weight: str, pos: str) -> DataFrame:
    """The value with the most weight in each group; of equals the one that came first."""
    sums = rows.groupBy(*group, value).agg(F.sum(weight).alias("_w"), F.min(pos).alias("_p"))
    return sums.groupBy(*group).agg(F.max_by(value, F.struct(F.col("_w"), (-F.col("_p")).alias("_p"))).alias(value))


def medoid(rows: DataFrame, group: list[str], key: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """The row of each group that is nearest to the mean of its points, east scaled at the mean; ties by key."""
    mean = rows.groupBy(*group).agg(F.avg(lat).alias("_lat"), F.avg(lon).alias("_lon"))
    d = F.pow(F.col(lat) - F.col("_lat"), 2) + F.pow((F.col(lon) - F.col("_lon")) * F.cos(F.radians("_lat")), 2)
    return rows.join(mean, group).groupBy(*group).agg(F.min(F.struct(F.round(d, 15).alias("d"), F.col(key).alias("k"))).alias("b")).select(*group, F.col("b.k").alias(key))


def log_share(value: Column, full: float) -> Column:
    """0 to 1 on a logarithmic scale that is full at `full`."""
    from ..functions.tags import clamp01

    return clamp01(F.log10(F.greatest(value, F.lit(0.0)) + 1) / F.log10(F.lit(full) + 1))
