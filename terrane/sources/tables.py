"""Sources and sinks as DataFrames: GeoJSON, row files, tile archives, tiles, glyphs, trees, map objects."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..runtime import ship
from . import binary as B


def decoded(files: DataFrame, f: Callable[[bytes], list[tuple]], fields: str, kinds: list[pa.DataType], content: str = "content", keep: str = "path") -> DataFrame:
    """keep and a row for each that f makes of a file's bytes; bytes that are broken give one row of nulls with the reason in `problem`."""
    names = [x.split()[0] for x in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, rows, why = [], [], []
            for i, data in enumerate(batch.column(1).to_pylist()):
                try:
                    got, problem = list(f(data or b"")), None
                except (B.Broken, ValueError, IndexError, OSError, EOFError) as e:
                    got, problem = [(None,) * len(names)], str(e) or type(e).__name__
                own += [i] * len(got)
                rows += got
                why += [problem] * len(got)
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own, pa.int64())), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True)), pa.array(why, pa.string())], names=[keep, *names, "problem"])

    kind = dict(files.dtypes)[keep]
    ship(files.sparkSession)
    return files.select(keep, content).mapInArrow(run, f"{keep} {kind}, {fields}, problem string")


def binary_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path", "content")


def archive_entries(files: DataFrame) -> DataFrame:
    """path, tile_id, offset, length, run of tile archives."""
    return decoded(files, lambda d: list(B.entries(d)), "tile_id long, offset long, length long, run long", [pa.int64()] * 4)


def archive_headers(files: DataFrame) -> DataFrame:
    names = ("addressed", "entries", "contents", "min_zoom", "max_zoom", "tile_compression", "min_lon", "min_lat", "max_lon", "max_lat")
    kinds = [pa.int64()] * 6 + [pa.float64()] * 4
    return decoded(files, lambda d: [tuple(B.header(d)[n] for n in names)], ", ".join(f"{n} {'long' if i < 6 else 'double'}" for i, n in enumerate(names)), kinds)


def tiles(files: DataFrame) -> DataFrame:
    """path, tile_id, run and the bytes of each stored tile, decompressed."""
    def read(d: bytes) -> list[tuple]:
        codec = B.header(d)["tile_compression"]
        return [(t, run, B.inflated(d[at : at + n], codec)) for t, at, n, run in B.entries(d)]

    return decoded(files, read, "tile_id long, run long, tile binary", [pa.int64(), pa.int64(), pa.binary()])


def features(tiles_: DataFrame, layers: tuple[str, ...] | None = None, keep: str = "tile_id") -> DataFrame:
    """keep, layer, kind, props, geom and outer rings of tiles; equal bytes are decoded once.

    layers: decode only those. Tiles are often repeated (sea), so distinct bytes are decoded and joined back.
    """
    wanted = frozenset(layers) if layers else None
    keyed = tiles_.select(keep, "tile", F.sha2("tile", 256).alias("_key"))
    once = keyed.groupBy("_key").agg(F.first("tile").alias("tile"))
    read = lambda d: [(a, b, list(c.items()), g, B.outer_rings(g) if b == 3 else 0) for a, b, c, g in B.tile_features(d, wanted)]
    got = decoded(once, read, "layer string, kind int, props map<string,string>, geom array<long>, outer_rings int", [pa.string(), pa.int32(), pa.map_(pa.string(), pa.string()), pa.list_(pa.int64()), pa.int32()], "tile", "_key")
    return keyed.select(keep, "_key").join(got, "_key").drop("_key")


def glyph_table(files: DataFrame) -> DataFrame:
    read = lambda d: [(s, r, m["id"], m["width"], m["height"], m["left"], m["top"], m["advance"], b) for s, r, m, b in B.glyphs(d)]
    return decoded(files, read, "stack string, range string, id long, width long, height long, left long, top long, advance long, bitmap binary", [pa.string()] * 2 + [pa.int64()] * 6 + [pa.binary()])


def pictures(files: DataFrame) -> DataFrame:
    return decoded(files, lambda d: [B.png(d)], "width int, height int, channels int, pixels binary", [pa.int32()] * 3 + [pa.binary()])


def zip_members(files: DataFrame) -> DataFrame:
    return decoded(files, lambda d: B.members(d), "name string, bytes binary", [pa.string(), pa.binary()])


def polylines(rows: DataFrame, column: str, key: str, precision: int = 6) -> DataFrame:
    """key and line of encoded polylines."""
    kind = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
    read = lambda d: [([{"x": x, "y": y} for x, y in B.polyline(d, precision)],)]
    return decoded(rows.select(key, F.col(column).cast("binary").alias("content")), read, "line array<struct<x:double,y:double>>", [kind], "content", key)


def edge_rows(spark: SparkSession, path: str, columns: list[str], row: str = "\x1e", cell: str = "\x00") -> DataFrame:
    """A file of rows and cells split by control characters, read in splits; the last row counts without its end."""
    parts = F.split("value", cell)
    rows = spark.read.option("lineSep", row).text(path).where("value != ''")
    return rows.select(*[F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(columns)])


def geojson_rings(spark: SparkSession, path: str) -> DataFrame:
    """name, kind, part, ring, line of a FeatureCollection of polygons and multipolygons."""
    shape = "struct<type:string,features:array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>>"
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", shape).alias("g"))
    f = raw.select(F.explode("g.features").alias("f")).select(F.col("f.properties").alias("p"), F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("c"))
    many = F.when(F.col("kind") == "MultiPolygon", F.from_json("c", "array<array<array<array<double>>>>")).otherwise(F.array(F.from_json("c", "array<array<array<double>>>")))
    parts = f.select(F.try_element_at("p", F.lit("name")).alias("name"), "kind", F.posexplode(many).alias("part", "rings"))
    return parts.select("name", "kind", "part", F.posexplode("rings").alias("ring", "r")).withColumn("line", F.transform("r", lambda q: geo.point(q[0], q[1]))).drop("r")


def boundary(spark: SparkSession, path: str, sha256: str) -> DataFrame:
    """name, rings and sha256 of each polygon of a frozen boundary file; a file of another content than was frozen raises where it is read.

    The file's own hash is asked, so that neither a point nor a comment can have changed.
    """
    text = spark.read.text(path, wholetext=True).select(F.assert_true(F.sha2("value", 256) == sha256, F.lit("the boundary file isn't the frozen one")).alias("ok"))
    rings = geojson_rings(spark, path).groupBy("name").agg(F.transform(F.sort_array(F.collect_list(F.struct("part", "ring", "line"))), lambda r: r["line"]).alias("rings"))  # as many as a country has
    return rings.withColumn("one", F.lit(1)).join(text.select(F.lit(1).alias("one"), F.coalesce(F.col("ok").cast("string"), F.lit(sha256)).alias("sha256")), "one").drop("one")


def geojson_feature(name: Column, rings: Column) -> Column:
    """A polygon as GeoJSON text, a point to a line, so that two versions compare line by line."""
    spell = lambda p: F.format_string("[%.7f, %.7f]", p["x"], p["y"])
    ring = lambda r: F.concat(F.lit("[\n"), F.array_join(F.transform(geo.closed(r), spell), ",\n"), F.lit("\n]"))
    return F.concat(F.lit('{"type": "Feature", "properties": '), F.to_json(F.struct(name.alias("name"))), F.lit(', "geometry": {"type": "Polygon", "coordinates": ['), F.array_join(F.transform(rings, ring), ",\n"), F.lit("]}}"))


# ---------------------------------------------------------------- map objects

def with_lines(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """ways with line: their nodes' places in order, null where a node is missing."""
    refs = ways.select("id", F.posexplode_outer("refs").alias("pos", "ref"))
    placed = refs.join(nodes.select(F.col("id").alias("ref"), "lat", "lon"), "ref", "left")
    point = F.when(F.col("lat").isNotNull(), geo.point(F.col("lon"), F.col("lat")))
    lines = placed.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("pos", point.alias("p")))).alias("l")).select("id", F.transform("l", lambda x: x["p"]).alias("line"))
    return ways.join(lines, "id")


def wanted_objects(nodes: DataFrame, ways: DataFrame, relations: DataFrame, keys: tuple[str, ...], pick: Column) -> dict[str, DataFrame]:
    """What two passes over an extract keep: chosen relations, their member ways, ways and nodes with a key of interest, nodes that are members."""
    chosen = relations.where(pick)
    members = chosen.select(F.explode("members").alias("m")).select("m.type", F.col("m.ref").alias("id"))
    has = F.arrays_overlap(F.map_keys("tags"), F.array(*map(F.lit, keys)))
    of = lambda kind: members.where(F.col("type") == kind).select("id").distinct()
    tagged = lambda df: df.where((F.size("tags") > 0) & has)
    both = lambda df, kind: tagged(df).unionByName(df.join(of(kind), "id", "left_semi")).dropDuplicates(["id"])
    return {"relations": chosen, "ways": both(ways, "w"), "nodes": both(nodes, "n")}


def write_sorted(df: DataFrame, path: str, sort: list[str], parts: int = 8, partition: list[str] | None = None) -> None:
    """A table sorted by ranges, so that Parquet's bounds serve as its index; statistics come with the files."""
    out = df.repartitionByRange(parts, *sort).sortWithinPartitions(*sort).write.mode("overwrite")
    (out.partitionBy(*partition) if partition else out).parquet(path)
