"""Files as tables and back: extracts, boundaries, rows split by control characters, pictures, sorted tables."""

import hashlib
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from terrane.functions import geo
from terrane.operators import release
from terrane.sources import extract
from terrane.sources import tables as src


def test_extract_round_trip(spark):
    nodes = [(10, 41.5, 44.25, {"place": "town", "name": "é"}), (3, -41.5, -44.0, {}), (7, 0.0, 0.0, {"a": "b"})]
    ways, rels = [(5, [10, 3, 99], {"highway": "primary"})], [(9, {"type": "route"}, [("w", 5, "outer"), ("n", 10, "")])]
    files = spark.createDataFrame([(f"f{i}", extract.written(nodes, ways, rels, 1_700_000_000, bool(i))) for i in (0, 1)] + [("bad", b"\x00\x00\x00\x09no"), ("cut", extract.written(nodes, [], [], 5)[:-4])], "path string, content binary")
    rows = extract.read_objects(files)
    bad = {r.path: r.problem for r in rows.where("problem is not null").collect()}
    assert set(bad) == {"bad", "cut"}
    for f in ("f0", "f1"):
        got = rows.where(F.col("path") == f).collect()
        assert [(r.id, round(r.lat, 7), round(r.lon, 7), r.tags) for r in got if r.kind == "n"] == nodes
        assert [(r.id, r.refs, r.tags) for r in got if r.kind == "w"] == ways
        assert [(r.id, r.tags, [(m.type, m.ref, m.role) for m in r.members]) for r in got if r.kind == "r"] == rels
    parts = extract.split(rows.where("problem is null"))
    assert [p.count() for p in parts.values()] == [3, 1, 1]
    line = src.with_lines(parts["ways"], parts["nodes"]).first().line
    assert [p and (round(p.y, 7), round(p.x, 7)) for p in line] == [(41.5, 44.25), (-41.5, -44.0), None]
    assert {r.time for r in extract.read_headers(files.where("path like 'f%'")).collect()} == {1_700_000_000}


def test_boundary_is_the_frozen_one(spark, tmp_path):
    ring = F.array(geo.literal_ring(geo.rectangle(1, 2, 3, 4)), geo.literal_ring(geo.rectangle(1.5, 2.5, 2, 3)))
    feature = spark.range(1).select(src.geojson_feature(F.lit('a "quoted" name'), ring).alias("t")).first().t
    text = '{"type": "FeatureCollection", "features": [' + feature + "]}"
    path = tmp_path / "b.geojson"
    path.write_text(text)
    got = src.boundary(spark, str(path), hashlib.sha256(text.encode()).hexdigest()).collect()
    assert len(got) == 1 and got[0].name == 'a "quoted" name' and [len(r) for r in got[0].rings] == [5, 5] and (got[0].rings[0][0].x, got[0].rings[0][0].y) == (1, 2)
    with pytest.raises(Exception, match="frozen"):
        src.boundary(spark, str(path), "0" * 64).collect()


def test_rows_pictures_and_sorted_tables(spark, tmp_path):
    (tmp_path / "edges.txt").write_text("1\x00a\x1e2\x00b\x1e3")
    rows = src.edge_rows(spark, str(tmp_path / "edges.txt"), ["id", "name"]).orderBy("id").collect()
    assert [(r.id, r.name) for r in rows] == [("1", "a"), ("2", "b"), ("3", None)]
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    raw = b"".join(b"\x00" + bytes([x, y, 0, 255]) for y in range(1) for x in (7,)) + b"\x00" + bytes([9, 8, 7, 6])
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 2, 8, 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    folder = tmp_path / "pics"
    folder.mkdir()
    (folder / "a.png").write_bytes(png)
    (folder / "b.txt").write_text("no")
    files = src.binary_files(spark, str(folder), "*.png")
    got = src.pictures(files).collect()
    assert len(got) == 1 and (got[0].width, got[0].height, got[0].channels, bytes(got[0].pixels)) == (1, 2, 4, bytes([7, 0, 0, 255, 9, 8, 7, 6]))
    src.write_sorted(spark.range(100).select((99 - F.col("id")).alias("id")), str(tmp_path / "sorted"), ["id"], 4)
    back = spark.read.parquet(str(tmp_path / "sorted"))
    assert back.count() == 100 and all(a <= b for p in back.rdd.glom().collect() for a, b in zip([r.id for r in p], [r.id for r in p][1:], strict=False))
    release.write_report(spark.range(3).select(F.lit("x").alias("check"), (F.col("id") > 0).alias("passed")), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).where("passed").count() == 2
