"""Operators on hand-made inputs."""

import gzip

import pytest
from pyspark.sql import functions as F

from terrane.functions import fold, geo, tags
from terrane.operators import build, graph, lines, rank
from terrane.plans import search_queries as made
from terrane.plans import shapes
from terrane.sources import binary as B

# Texts and the keys that they must have.
KEYS = {
    "შოთა რუსთაველის გამზირი": ["shota", "rustavelis", "gamziri"],
    "მე-9 ქუჩა": ["9", "kucha"],
    "39ა": ["39a"],
    "Vazha-Pshavela Avenue": ["vaja", "pshavela", "avenue"],
    "Şıxlı-2": ["shihli", "2"],
    "20 ა": ["20a"],
    "37ა, ქ. თბილისი": ["37a", "k", "tbilisi"],
    "Чайка": ["chaika"],
    "9-й линия": ["9", "linia"],
    "vakhtang vi": ["vahtang", "6"],
    "N37": ["37"],
}


def test_fold_is_one_on_both_sides(spark):
    f = fold.folder()
    df = spark.createDataFrame([(t,) for t in [*KEYS, "", "Łódź 12/5", "a-b-c"]], "t string").select("t", fold.keys(F.col("t")).alias("k"), fold.index_keys(F.col("t")).alias("i"))
    for r in df.collect():
        assert r.k == f.keys(r.t) and r.i == f.index_keys(r.t)
        assert r.t not in KEYS or r.k == KEYS[r.t]


def test_query_parts():
    q = fold.folder().parse("ჭავჭავაძის 37, ბინა 12")
    assert [t.prefixes for t in q.required] == [["chavchavadz"], ["37"]] and len(q.dropped) == 2
    assert fold.folder().parse("ი. აბაშიძის ქუჩა").initials == ["i"]


def test_runs_of_flags(spark):
    r = spark.range(1).select(lines.good_runs(F.lit([True, True, False, True])).alias("a"), lines.split_by_flags(F.lit(2), F.lit([True, False, False])).alias("b"), lines.good_runs(F.array().cast("array<boolean>")).alias("c")).first()
    assert [tuple(x) for x in r.a] == [(0, 2), (3, 4)] and [tuple(x) for x in r.b] == [(2, 3, True), (3, 5, False)] and r.c == []


def test_members_after_a_cut(spark):
    members = spark.createDataFrame([(501, "route", 0, "w", 102, ""), (501, "route", 1, "w", 100, ""), (502, "restriction", 0, "w", 101, "from"), (502, "restriction", 1, "n", 2, "via"), (503, "restriction", 0, "w", 100, "from"), (503, "restriction", 1, "n", 5, "via")], "relation long, kind string, pos int, type string, ref long, role string")
    pieces = spark.createDataFrame([(100, 0, 100, [1, 2]), (100, 1, 4_000_000_000, [4, 5]), (102, 0, 102, [7, 8])], "way long, piece int, id long, nodes array<long>")
    out = lines.rewrite_members(members, spark.createDataFrame([(101,)], "way long"), pieces)
    got = {r.relation: [m.ref for m in r.members] for r in out.collect()}
    assert got == {501: [102, 100, 4_000_000_000], 503: [4_000_000_000, 5]}


def test_rings():
    assert graph.rings_of([(1, [1, 2, 3]), (2, [5, 4, 3]), (3, [5, 6, 1]), (4, [9, 8])]) == ([[1, 2, 3, 4, 5, 6, 1]], [4])


def test_shortest_path():
    edges = [(1, 2, 5.0, 0), (2, 3, 5.0, 1), (1, 3, 20.0, 2)]
    assert graph.shortest(edges, 1, 3, 100) == (10.0, [0, 1]) and graph.shortest(edges, 3, 1, 100) is None and graph.shortest(edges, 1, 3, 9) is None


def test_components_of_a_star_and_a_chain(spark):
    edges = [(0, i) for i in range(1, 60)] + [(1000 + i, 1001 + i) for i in range(12)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(60)) and all(got[1000 + i] == 1000 for i in range(13))


def test_row_ids(spark):
    df = rank.row_ids(spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")), [F.col("v").desc()], "id", 7)
    assert all(r.id == 1000 - r.v for r in df.collect())


@pytest.mark.parametrize(("value", "speed"), [("60", 60), ("60 km/h", 60), ("40 mph", 64), ("none", None), ("50;60", None), ("500", None), (None, None), ("GE:urban", 60)])
def test_speeds(spark, value, speed):
    assert spark.createDataFrame([(value,)], "v string").select(tags.maxspeed(F.col("v"), {"GE:urban": 60})).first()[0] == speed


def test_access(spark):
    cases = [({"highway": "primary"}, "yes"), ({"highway": "construction", "access": "yes"}, "no"), ({"highway": "primary", "access": "private"}, "destination"), ({"highway": "footway", "motorcar": "yes"}, "yes"), ({"highway": "primary", "motor_vehicle": "no"}, "no"), ({"highway": "primary", "vehicle": "no", "motorcar": "destination"}, "destination"), ({"route": "ferry"}, "yes"), ({}, "no")]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, tags map<string,string>").select("i", tags.car_access(F.col("tags")).alias("a"))
    assert {r.i: r.a for r in df.collect()} == {i: a for i, (_, a) in enumerate(cases)}


def test_polygon_with_a_hole(spark):
    rings = F.array(geo.literal_ring(geo.rectangle(0, 0, 4, 4)), geo.literal_ring(geo.rectangle(1, 1, 2, 2)))
    r = spark.range(1).select(geo.contains(rings, F.lit(3.0), F.lit(3.0)), geo.contains(rings, F.lit(1.5), F.lit(1.5)), geo.contains_closed(rings, F.lit(4.0), F.lit(2.0)), geo.representative_point(rings)).first()
    assert (r[0], r[1], r[2]) == (True, False, True) and tuple(r[3]) == (2.0, 2.0)


def test_archive_round_trip():
    tiles = {i: made.point_tile("place", [(i, -i, f"n{i}")]) for i in range(5, 40, 3)} | {100 + i: made.point_tile("water", [(0, 0, "sea")]) for i in range(9)}
    for leaf in (0, 4):
        data = made.archive(tiles, leaf=leaf)
        got = {}
        for t, at, n, run in B.entries(data):
            got |= dict.fromkeys(range(t, t + run), gzip.decompress(data[at : at + n]))
        assert got == tiles
    (layer, kind, props, shape) = next(B.tile_features(tiles[8]))
    assert (layer, kind, props, B.shape_parts(shape)) == ("place", 1, {"name": "n8"}, [[(8, -8)]])
    assert list(B.tile_features(tiles[8], frozenset(["road"]))) == []
    with pytest.raises(B.Broken):
        list(B.entries(data[:50]))


def test_polyline_and_zip():
    assert B.polyline(b"_p~iF~ps|U_ulLnnqC_mqNvxq`@", 5) == [(-120.2, 38.5), (-120.95, 40.7), (-126.453, 43.252)]
    assert B.members(B.packed({"b": b"2", "a": b"1"})) == [("a", b"1"), ("b", b"2")] and B.packed({"a": b""}) == B.packed({"a": b""})
    with pytest.raises(B.Broken):
        B.members(B.packed({"../a": b""}))


def test_places_keep_lands_apart(spark):
    """A district on occupied land belongs to no legal town, however near."""
    rows = [("n1", 42.15, 44.3, {"place": "city", "name": "ქალაქი", "population": "90000"}), ("n2", 42.151, 44.301, {"place": "suburb", "name": "უბანი"}), ("n3", 42.3, 44.7, {"place": "suburb", "name": "Окупе", "name:ka": "სოფელი"}), ("n4", 42.7, 44.5, {"place": "town", "name": "outside"})]
    objects = spark.createDataFrame(rows, "osm string, lat double, lon double, tags map<string,string>")
    got = {r.osm: r for r in build.places(objects, shapes.zone_rings()).collect()}
    assert set(got) == {"n1", "n2", "n3"} and got["n2"].parent_osm == "n1" and got["n3"].parent_osm is None
    assert (got["n3"].zone, got["n3"].label_ka, got["n3"].label_en) == ("occupied", "სოფელი", "Sopeli")


def test_greedy_dedup_keeps_directions(spark):
    rows = spark.createDataFrame([(1, "fixed", 42.0, 44.0, 90.0, 1), (2, "fixed", 42.0001, 44.0, 95.0, 2), (3, "fixed", 42.0001, 44.0, 270.0, 3), (4, "fixed", 42.0, 44.0, None, 4), (5, "red_light", 42.0, 44.0, 90.0, 5)], "key long, kind string, lat double, lon double, heading double, priority long")
    assert sorted(r.key for r in graph.greedy_dedup(rows, "key", 50.0).collect()) == [1, 3, 4, 5]
