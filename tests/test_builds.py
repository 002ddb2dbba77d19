"""Areas, builders and the rules around a search on small made-up countries, against plain loops and hand-checked cases."""

import random

import pytest
from pyspark.sql import functions as F

from terrane.config import BuildConfig, SearchConfig
from terrane.functions import fold, geo
from terrane.operators import areas, build, release, search, search_rules
from terrane.plans import search_queries as made
from terrane.plans import shapes as S

RINGS = "array<array<struct<x:double,y:double>>>"
TAGS = "map<string,string>"


def box(x, y, h):
    return [[(x - h, y - h), (x + h, y - h), (x + h, y + h), (x - h, y + h), (x - h, y - h)]]


def rings_of(b):
    return [[{"x": x, "y": y} for x, y in r] for r in b]


# ---------------------------------------------------------------- areas


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_areas_take_places_in_turn(spark, seed):
    rng = random.Random(seed)
    places = [(f"n{i:03d}", "town", rng.uniform(41.5, 41.9), rng.uniform(44, 44.4), rng.choice(("aba", "ede"))) for i in range(60)]
    spots = [(f"w{i:03d}", rng.uniform(44, 44.4), rng.uniform(41.5, 41.9), rng.choice((0.02, 0.1, 0.2)), rng.choice(("aba", "ede"))) for i in range(40)]
    p = spark.createDataFrame([(o, k, a, x, {"name": n}) for o, k, a, x, n in places], f"osm string, kind string, lat double, lon double, tags {TAGS}")
    a = spark.createDataFrame([(o, "town", rings_of(box(x, y, h)), {"name": n}) for o, x, y, h, n in spots], f"osm string, kind string, rings {RINGS}, tags {TAGS}")
    got = {r.osm: r.area_osm for r in areas.link_areas(p, a).collect()}
    want, left = {o: None for o, *_ in places}, []
    for o, x, y, h, n in spots:
        mine = [q for q, _, lat, lon, m in places if m == n and want[q] is None and x - h <= lon < x + h and y - h <= lat < y + h]
        if mine:
            want[mine[0]] = o
        else:
            left.append(o)
    assert got == want | {o: o for o in left} and left


def test_a_settlement_has_the_larger_area(spark):
    p = spark.createDataFrame([("n1", "city", 41.5, 44.0, "Aba", rings_of(box(44, 41.5, 0.01))), ("n2", "city", 41.5, 44.2, "Aba", None), ("n3", "village", 41.5, 44.4, "Ede", None), ("n4", "town", 41.5, 44.6, "Imi", rings_of(box(44.6, 41.5, 0.3)))], f"osm string, kind string, lat double, lon double, name string, rings {RINGS}")
    admins = spark.createDataFrame([
        ("r1", "Aba", rings_of(box(44.1, 41.5, 0.2)), [2]),  # holds both, its label is the second
        ("r2", "Ede", rings_of(box(44.4, 41.5, 0.1)), []),  # a village has no unit
        ("r3", "Imi", rings_of(box(44.6, 41.5, 0.1)), [99]),  # smaller than its own area
    ], f"osm string, name string, rings {RINGS}, labels array<long>")
    got = {r.osm: round(r.area, 4) for r in areas.settlement_areas(p, admins).collect()}
    assert got == {"n1": 0.0004, "n2": 0.16, "n4": 0.36}


def test_wanted_relations(spark):
    cases = [({"type": "multipolygon", "place": "town"}, True), ({"type": "boundary", "boundary": "administrative", "admin_level": "6", "name": "x"}, True), ({"type": "boundary", "boundary": "administrative", "admin_level": "6"}, False), ({"type": "boundary", "boundary": "administrative", "admin_level": "2", "name": "x"}, False),
             ({"type": "route", "place": "town"}, False), ({"type": "enforcement"}, True), ({"type": "multipolygon", "building": "yes"}, False), ({"type": "multipolygon", "addr:housenumber": "1"}, True), ({"type": "multipolygon", "amenity": "fuel"}, True)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], f"i int, tags {TAGS}")
    got = {r.i: r.w for r in df.select("i", areas.wanted_relation(F.col("tags")).alias("w")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]


# ---------------------------------------------------------------- builders


def line(*points):
    return [{"x": x, "y": y} for x, y in points]


@pytest.fixture(scope="module")
def town(spark):
    rows = [("n1", 41.7, 44.2, {"place": "city", "name": "Aba", "population": "100000"}), ("n2", 41.72, 44.21, {"place": "suburb", "name": "Ede"}), ("n3", 42.3, 44.7, {"place": "town", "name": "Imi"}), ("n4", 40.0, 44.2, {"place": "town", "name": "Olo"})]
    places = build.places(spark.createDataFrame(rows, f"osm string, lat double, lon double, tags {TAGS}"), S.zone_rings()).cache()
    return places, build.centres(places).cache()


def test_places_zones_and_parents(town):
    got = {r.osm: r for r in town[0].collect()}
    assert set(got) == {"n1", "n2", "n3"} and got["n3"].occupied == 1 and got["n2"].parent_osm == "n1"
    assert got["n1"].importance > got["n2"].importance and [r.city for r in town[1].collect()] == ["n1"]


def test_streets_addresses(spark, town):
    w = [
        (1, line((44.2, 41.7), (44.201, 41.7)), {"highway": "primary", "name": "Main Road"}), (2, line((44.201, 41.7), (44.203, 41.7)), {"highway": "secondary", "name": "Main Road"}),
        (3, line((44.21, 41.7), (44.211, 41.7)), {"highway": "track", "name": "Main Road"}),  # 600 m on: the same street by its box
        (4, line((44.2, 41.75), (44.21, 41.75)), {"highway": "residential", "name": "Side Road"}), (5, line((44.2, 41.7), (44.21, 41.7)), {"highway": "footway", "name": "Main Road"}), (6, line((44.7, 42.3), (44.71, 42.3)), {"highway": "primary", "name": "Main Road"}),
    ]
    ways = spark.createDataFrame(w, f"way long, line array<struct<x:double,y:double>>, tags {TAGS}")
    streets = build.streets(ways, S.zone_rings(), town[1]).cache()
    got = {r.street: r for r in streets.where("city is not null").collect()}
    assert set(got) == {1, 4} and got[1].kind == "primary" and got[1].city == "n1" and got[1].length_m > got[4].length_m / 3
    o = [
        ("n10", 41.7001, 44.2005, {"addr:housenumber": "1", "addr:street": "Main Road", "building": "yes"}), ("n11", 41.70012, 44.2005, {"addr:housenumber": "1", "addr:street": "Main Road"}),  # a copy without a building
        ("n12", 41.75, 44.205, {"addr:housenumber": "2", "addr:street": "Side Road"}), ("n13", 41.7, 44.2, {"addr:housenumber": "3", "addr:street": "Lost Lane"}), ("n14", 41.7, 44.2, {"addr:street": "Main Road"}),
    ]
    a = build.addresses(spark.createDataFrame(o, f"osm string, lat double, lon double, tags {TAGS}"), S.zone_rings(), streets, town[1])
    got = {r.osm: (r.street, r.virtual_street, r.city) for r in a.collect()}
    assert got == {"n10": (1, None, "n1"), "n12": (4, None, "n1"), "n13": (None, "n13", "n1")}


def test_pois_cameras_hazards(spark, town):
    tag = f"osm string, lat double, lon double, tags {TAGS}"
    o = [("n1", 41.7, 44.2, {"amenity": "fuel", "name": "Gas"}), ("n2", 41.7002, 44.2, {"amenity": "fuel", "name": "Gas", "brand": "B", "toilets": "yes"}), ("n3", 41.7, 44.3, {"amenity": "cafe"}), ("n4", 41.6, 44.2, {"tourism": "hotel"}), ("n5", 42.3, 44.7, {"amenity": "fuel"})]
    got = {r.osm: r for r in build.pois(spark.createDataFrame(o, tag), S.zone_rings(), town[1]).collect()}
    assert set(got) == {"n2", "n4"} or set(got) == {"n2", "n4", "n5"}
    assert got["n2"].attrs == "toilets" and got["n2"].city == "n1" and got["n2"].kind == "fuel"
    ways = spark.createDataFrame([
        (1, [1, 2, 3], line((44.2, 41.7), (44.21, 41.7), (44.22, 41.7)), 2, {"highway": "primary", "maxspeed": "60", "oneway": "yes", "ref": "S1"}),
        (2, [4, 5], line((44.2, 41.8), (44.2, 41.81)), 5, {"highway": "residential"}),
    ], f"way long, refs array<long>, line array<struct<x:double,y:double>>, class_rank int, tags {TAGS}")
    n = [("n2", 2, 41.7, 44.21, {"highway": "speed_camera"}), ("n9", 9, 41.8001, 44.20001, {"highway": "speed_camera", "direction": "N", "maxspeed": "40"}), ("n8", 8, 41.80012, 44.20001, {"highway": "speed_camera", "direction": "NNE"}), ("n7", 7, 41.9, 44.2, {"highway": "speed_camera"})]
    nodes = spark.createDataFrame(n, f"osm string, id long, lat double, lon double, tags {TAGS}")
    rel = spark.createDataFrame([("r1", "average_speed", 70, 7)], "osm string, kind string, maxspeed int, device long")
    cams = {r.osm: r for r in build.cameras(nodes, ways, rel, S.zone_rings()).collect()}
    assert cams["n2"].heading == 90 and cams["n2"].heading_src == "oneway" and cams["n2"].maxspeed == 60 and cams["n2"].maxspeed_src == "road" and cams["n2"].road_dist_m == 0
    assert "n9" in cams and "n8" not in cams and cams["n9"].heading == 180 and cams["n9"].maxspeed == 40  # the copy without a limit goes
    assert cams["n7"].kind == "average_speed" and cams["n7"].maxspeed == 70 and cams["n7"].road_class is None
    h = [("n1", 1, 41.7, 44.2, {"traffic_calming": "hump"}), ("n4", 4, 41.8, 44.2, {"railway": "level_crossing"}), ("n5", 5, 41.81, 44.2, {"railway": "level_crossing"}), ("n6", 6, 41.7, 44.3, {"traffic_calming": "bump"})]
    haz = {r.osm: r.kind for r in build.hazards(spark.createDataFrame(h, f"osm string, id long, lat double, lon double, tags {TAGS}"), ways, S.zone_rings(), spark.createDataFrame([(4,)], "node long")).collect()}
    assert haz == {"n1": "bump", "n4": "rail"}


# ---------------------------------------------------------------- search


def test_words_are_one_to_one(spark):
    f = fold.folder()
    cases = [("red gear", "gear red", False, True), ("red gear", "red", False, False), ("red", "red gear", False, False), ("red red", "red", False, False), ("red red", "red red", False, True)]
    rows = [(i, f.keys(n), [(list(w.keys), list(w.prefixes)) for w in f.parse(t).required], s) for i, (n, t, s, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, keys array<string>, tokens array<struct<keys:array<string>,prefixes:array<string>>>, s boolean")
    got = {r.i: r.ok for r in df.select("i", search_rules.words_are(F.col("keys"), F.col("tokens")).alias("ok")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for *_, w in cases]


def test_search_finds_near_and_partly(spark):
    names = ["red gear", "red wheel", "blue gear", "redwood", "green"]
    rows = spark.createDataFrame([(i + 1, n, 1 - i / 10, 41.7, 44.0 + i / 5) for i, n in enumerate(names)], "id long, name string, importance double, lat double, lon double")
    index = build.postings(rows, F.array("name"))
    keyed = made._names(rows)
    typed = spark.createDataFrame([("a", "red"), ("b", "red gear"), ("c", "gear zzz"), ("d", "red"), ("e", "")], "q string, text string")
    near = spark.createDataFrame([("d", 41.7, 44.6)], "q string, q_lat double, q_lon double")
    out = {}
    for r in search.search(typed, rows, keyed, index, near, SearchConfig()).orderBy("q", "rank").collect():
        out.setdefault(r.q, []).append((r.id, r.partial))
    assert [i for i, _ in out["a"]][:2] == [1, 2] and out["b"] == [(1, False)] and {i for i, p in out["c"] if p} == {1, 3} and "e" not in out
    assert {i for i, _ in out["d"]} == {1, 2, 4}


def test_configurations_are_checked():
    assert release.config_problems(BuildConfig()) == [] and release.config_problems(SearchConfig()) == []
    bad = release.config_problems(SearchConfig(prefix=0.95, coverage=1.5, categories=(("a", "x"), ("a", "y"))))
    assert len(bad) == 3 and release.config_problems(BuildConfig(street_weights=(0.5, 0.5, 0.5))) == ["street_weights: don't add up to one"]
    assert geo.DEGREE_M > 111_000
