"""The clip as a file: pieces, the nodes that they need and their relations written as an extract, and read back in ranges."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lines
from ..runtime import checkpointed, shared_folder
from ..sources import ranges
from . import shapes as S
from .geo_queries import _CLIP, LOST, _clip_ways, clipped
from .registry import query

#: Bytes of a range that a task reads; a country's extract would take the default.
RANGE = 64 << 10


def _written(spark: SparkSession, d: str) -> str:
    """The clip of the orders' ways as an extract: nodes, then ways, then a relation for each ten orders of what is left of them."""
    w = _clip_ways(spark, d)
    cut_ = checkpointed(clipped(w))
    cut = cut_.where("piece is not null").join(w.select("way", "refs", "tags"), "way")
    ways = cut.select("way", "id", "piece", "tags", F.expr("slice(refs, first + 1, last - first + 1)").alias("refs"))
    none = lambda kind: F.lit(None).cast(kind)
    listed = "array<struct<type:string,ref:long,role:string>>"
    nodes = ways.select(F.explode("refs").alias("id")).distinct().where(F.col("id") % LOST > 0)
    whole = cut_.where("piece is null").select("way").distinct()
    pieces = ways.select("way", "piece", "id", F.col("refs").alias("nodes"))
    members = w.select(F.floor(F.col("way") / 10).cast("long").alias("relation"), F.lit("multipolygon").alias("kind"), F.col("way").alias("pos"), F.lit("w").alias("type"), F.col("way").alias("ref"), F.lit("outer").alias("role"))
    relations = lines.rewrite_members(members, whole, pieces)
    rows = [
        nodes.select(F.lit("n").alias("kind"), "id", S.lat(F.col("id")).alias("lat"), S.lon(F.col("id")).alias("lon"), none("map<string,string>").alias("tags"), none("array<long>").alias("refs"), none(listed).alias("members")),
        ways.select(F.lit("w"), "id", none("double"), none("double"), "tags", "refs", none(listed)),
        relations.select(F.lit("r"), F.col("relation"), none("double"), none("double"), F.create_map(F.lit("type"), F.lit("multipolygon")), none("array<long>"), "members"),
    ]
    path = f"{shared_folder(spark, f'clip-{zlib.crc32(d.encode()):08x}')}.pbf"
    ranges.register(spark)
    ranges.ordered(rows[0].union(rows[1]).union(rows[2])).write.format("map_extract").option("time", 1_700_000_000).mode("overwrite").save(path)
    return path


@query("clip_file", "SRC01 SRC02 SRC05 SNK01", f"""WITH c AS ({_CLIP}), p AS (SELECT * FROM c WHERE piece IS NOT NULL)
    SELECT 'w' AS kind, id, (last - first + 1)::INT AS parts FROM p
    UNION ALL SELECT DISTINCT 'n', node, 0 FROM p JOIN {S.SQL_WAYNODES} n ON n.way = p.way AND n.pos BETWEEN p.first AND p.last WHERE node % {LOST} > 0
    UNION ALL SELECT 'r', way // 10, count(*)::INT FROM p GROUP BY way // 10""")
def clip_file(spark: SparkSession, d: str) -> DataFrame:
    """What the clip's file holds, read back by ranges of its blobs."""
    rows = spark.read.format("map_extract").option("range_bytes", RANGE).load(_written(spark, d))
    parts = F.coalesce(F.size("refs"), F.lit(0)) + F.coalesce(F.size("members"), F.lit(0))
    return rows.select("kind", "id", parts.cast("int").alias("parts"))
