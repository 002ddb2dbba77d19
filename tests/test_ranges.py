"""Extracts in ranges and back to a file: many tasks, pushed filters, order, and what a failed write leaves."""

import os

import pytest
from pyspark.sql import functions as F

from terrane.sources import extract, ranges
from terrane.sources.binary import Broken


@pytest.fixture(scope="module")
def source(spark):
    ranges.register(spark)
    return lambda path, **o: spark.read.format("map_extract").options(**o).load(path)


@pytest.fixture(scope="module")
def file(tmp_path_factory):
    """Thirty blocks of nodes, some of ways and one of relations."""
    out = ranges.header_blob(1_700_000_000)
    for b in range(30):
        nodes = [(b * 100 + i + 1, 41 + i / 1000, 44 + b / 1000, {"place": "town"} if i % 10 == 0 else {}) for i in range(100)]
        out += extract.written(nodes, [], [], 0, dense=b % 2 == 0, head=False)
    for b in range(4):
        out += extract.written([], [(b * 10 + i + 1, [1, 2, 3 + i], {"highway": "primary"}) for i in range(10)], [], 0, head=False)
    out += extract.written([], [], [(7, {"type": "route"}, [("w", 1, "outer"), ("n", 5, "")])], 0, head=False)
    path = tmp_path_factory.mktemp("extract") / "c.pbf"
    path.write_bytes(out)
    return str(path)


def test_a_file_is_read_by_many_tasks(source, file):
    rows = source(file, range_bytes=700)
    assert rows.rdd.getNumPartitions() > 8
    whole = [tuple(o) for o in extract.objects(open(file, "rb").read())]
    got = rows.select("kind", "id", "lat", "lon", "tags", "refs", "members").collect()
    assert len(got) == len(whole) == 3041
    assert sorted((r.kind, r.id, r.lat, r.lon, tuple(r.tags.items()), tuple(r.refs or ())) for r in got) == sorted((k, i, a, o, tuple(t), tuple(r or ())) for k, i, a, o, t, r, _ in whole)
    assert [(m.type, m.ref, m.role) for r in got if r.kind == "r" for m in r.members] == [("w", 1, "outer"), ("n", 5, "")]
    assert sum(r.size for r in ranges.runs_of(file, 2000)) == os.path.getsize(file) and len(ranges.runs_of(file)) == 1
    assert source(os.path.dirname(file)).count() == 3041 and source(f"file://{file}").where("kind = 'w'").count() == 40


def test_filters_are_pushed_to_it(source, file):
    ways = source(file, range_bytes=2000).where("kind = 'w' and id > 20")
    plan = ways._jdf.queryExecution().executedPlan().toString()
    assert ways.count() == 20 and "kind" not in plan.split("Filter")[1].split("\n")[0]  # taken over by the source
    both = source(file).where(F.col("kind").isin("w", "r"))
    assert both.count() == 41 and source(file, keys="place,type").count() == 301
    reader = ranges.ExtractReader({"path": file})
    from pyspark.sql.datasource import EqualTo, GreaterThan

    assert [type(f) for f in reader.pushFilters([EqualTo(("kind",), "n"), GreaterThan(("id",), 3)])] == [GreaterThan] and reader.kinds == {"n"}


def test_broken_files_say_where(tmp_path, file):
    data = open(file, "rb").read()
    cut = tmp_path / "cut.pbf"
    cut.write_bytes(data[:-5])
    with pytest.raises(Broken, match="cut short"):
        ranges.places_of_blobs(str(cut))
    cut.write_bytes(b"\xff" * 40)
    with pytest.raises(Broken, match="byte 0"):
        ranges.places_of_blobs(str(cut))
    with pytest.raises(FileNotFoundError):
        ranges.files_of(str(tmp_path / "none"))


def test_written_and_read_back(spark, source, file, tmp_path):
    rows, path = source(file), str(tmp_path / "new.pbf")
    mixed = rows.orderBy(F.rand(3)).repartition(5)
    ranges.ordered(mixed, 6).write.format("map_extract").option("time", 5).option("block", 70).mode("overwrite").save(path)
    key = lambda df: sorted((r.kind, r.id, round(r.lat or 0, 7), round(r.lon or 0, 7), tuple(sorted(r.tags.items())), tuple(r.refs or ()), tuple(map(tuple, r.members or ()))) for r in df.collect())
    assert key(source(path)) == key(rows)
    data = open(path, "rb").read()
    seen = [(o[0], o[1]) for o in extract.objects(data)]
    assert seen == sorted(seen, key=lambda x: ("nwr".index(x[0]), x[1])) and extract.header(data)[0] == 5
    assert sorted(os.listdir(tmp_path)) == ["new.pbf"]
    ranges.ordered(rows.where("id < 0")).write.format("map_extract").mode("overwrite").save(path)
    assert source(path).count() == 0


def test_a_failed_write_leaves_nothing(spark, source, file, tmp_path):
    path = str(tmp_path / "bad.pbf")
    with pytest.raises(Exception, match="comes after"):
        source(file).coalesce(1).orderBy(F.desc("id")).write.format("map_extract").mode("overwrite").save(path)
    assert os.listdir(tmp_path) == []
