"""Sections on a made-up divided road, and walks against a plain search."""

import heapq
import random

import pytest

from terrane.operators import sections as X
from terrane.plans import shapes as S

NODES = {
    1: (44.20, 41.70), 2: (44.30, 41.70), 3: (44.30, 41.7003), 4: (44.20, 41.7003), 5: (44.25, 41.70), 6: (44.252, 41.704), 7: (44.69, 42.30), 8: (44.80, 42.30),
    11: (44.10, 41.80), 12: (44.13, 41.80), 13: (44.17, 41.80), 14: (44.20, 41.80), 21: (44.10, 41.90), 22: (44.12, 41.90), 23: (44.14, 41.90), 15: (44.1301, 41.80),
}
WAYS = {
    1: ([1, 2], {"highway": "motorway", "ref": "R 9", "oneway": "yes", "maxspeed": "90"}), 2: ([3, 4], {"highway": "motorway", "ref": "R 9", "oneway": "yes"}), 3: ([7, 8], {"highway": "trunk", "ref": "R 9"}),
    4: ([5, 6], {"highway": "motorway_link", "ref": "R 9", "oneway": "yes"}), 5: ([11, 12], {"highway": "trunk", "ref": "R 8;E 1", "oneway": "yes", "maxspeed": "80"}), 6: ([12, 13], {"highway": "trunk", "ref": "R 8", "oneway": "yes", "maxspeed": "80"}),
    7: ([13, 14], {"highway": "trunk", "ref": "R 8", "oneway": "yes", "maxspeed": "60"}), 8: ([21, 22, 23], {"highway": "primary", "name": "Long road", "maxspeed:forward": "70", "maxspeed:backward": "50"}),
}
C, K = "confirmed", "corroborated"
CASES = {
    # the post stands beside the other carriageway; each direction goes onto its own
    "east": ("r:R 9", (41.7003, 44.21), (41.7003, 44.28), 90, C, (41.70, 44.21, 44.28, 90, 90, None)),
    "west": ("r:R 9", (41.70, 44.28), (41.70, 44.21), 90, C, (41.7003, 44.28, 44.21, 270, 90, None)),
    "conflict": ("r:R 9", (41.70, 44.23), (41.70, 44.26), 70, C, (41.70, 44.23, 44.26, 90, None, "conflict")),
    "no road": ("r:R 99", (41.70, 44.23), (41.70, 44.26), 70, C, None),
    "name": ("n:Long road", (41.90, 44.102), (41.90, 44.138), 70, C, (41.90, 44.102, 44.138, 90, 70, None)),
    "occupied": ("r:R 9", (42.30, 44.692), (42.30, 44.75), 60, C, None),
    "unconfirmed": ("r:R 9", (41.7003, 44.21), (41.7003, 44.28), 90, None, (41.70, 44.21, 44.28, 90, None, "unconfirmed")),
    "walk": ("r:R 8", (41.8001, 44.101), (41.8001, 44.169), 80, K, (41.80, 44.101, 44.169, 90, 80, None)),
    "slower end": ("r:R 8", (41.8001, 44.101), (41.8001, 44.199), 80, K, (41.80, 44.101, 44.199, 90, None, "60")),
    "no limit": ("r:R 9", (41.70, 44.28), (41.70, 44.21), 90, K, (41.7003, 44.28, 44.21, 270, None, "none")),
    "ramp": ("r:R 9", (41.7001, 44.2501), (41.70, 44.29), 90, C, (41.70, 44.2501, 44.29, 90, 90, None)),
    "ahead": ("n:Long road", (41.90, 44.101), (41.90, 44.139), 70, K, (41.90, 44.101, 44.139, 90, 70, None)),
    "back": ("n:Long road", (41.90, 44.139), (41.90, 44.101), 50, K, (41.90, 44.139, 44.101, 270, 50, None)),
    "wrong way": ("n:Long road", (41.90, 44.139), (41.90, 44.101), 70, K, (41.90, 44.139, 44.101, 270, None, "50")),
    "against it": ("r:R 8", (41.80, 44.169), (41.80, 44.101), 80, C, None),
}


def ways_of(spark, ways, nodes):
    return spark.createDataFrame([(w, refs, [nodes[r] for r in refs], tags) for w, (refs, tags) in ways.items()], "way long, refs array<long>, line array<struct<x:double,y:double>>, tags map<string,string>")


def sections_of(spark, cases):
    return spark.createDataFrame([(i, road, *a, *b, kmh, status) for i, (road, a, b, kmh, status, _) in cases.items()], "id string, road string, a_lat double, a_lon double, b_lat double, b_lon double, maxspeed int, status string")


def test_sections_go_onto_their_carriageway(spark):
    got = {r.id: r for r in X.place_sections(sections_of(spark, CASES), ways_of(spark, WAYS, NODES), S.zone_rings()).collect()}
    assert set(got) == {i for i, c in CASES.items() if c[5]}
    for i, c in CASES.items():
        if c[5]:
            lat, lon, end, heading, kmh, why = c[5]
            r = got[i]
            assert (r.lat, r.end_lon, r.heading, r.maxspeed, r.why) == (pytest.approx(lat, abs=1e-6), pytest.approx(end, abs=1e-6), heading, kmh, why), i
            assert r.lon == pytest.approx(lon, abs=1e-6) and r.src == (None if kmh is None else "section") and r.end_lat == pytest.approx(lat, abs=1e-6)


def test_a_broken_carriageway_has_no_walk(spark):
    ways = {**WAYS, 6: ([15, 13], WAYS[6][1])}
    got = X.place_sections(sections_of(spark, {"walk": CASES["walk"]}), ways_of(spark, ways, NODES), S.zone_rings()).first()
    assert (got.maxspeed, got.why) == (None, "no walk")


def test_walks_are_the_shortest(spark):
    rng = random.Random(2)
    edges = [("r", rng.randrange(25), rng.randrange(25), float(rng.randrange(1, 90)), [str(rng.choice((50, 60)))]) for _ in range(70)]
    edges += [(f"r{i % 2}", a, b, m + 1, ["9"]) for i, (_, a, b, m, _) in enumerate(edges)]
    trips = [(f"{road}-{a}-{b}", road, a, b, 150.0) for road in ("r", "r0") for a in range(0, 25, 5) for b in range(1, 25, 6)]
    got = X.walks(spark.createDataFrame(trips, "id string, road string, source long, target long, most double"), spark.createDataFrame(edges, "road string, source long, target long, metres double, limits array<string>"))
    got = {r.id: (r.metres, tuple(r.limits)) for r in got.collect()}
    want = {}
    for i, road, a, b, most in trips:
        best, heap = {a: (0.0, ())}, [(0.0, (), a)]
        while heap:
            d, l, n = heapq.heappop(heap)
            if n == b or (d, l) > best[n] or d > most:
                continue
            for r, s, t, m, limits in edges:
                new = d + m, tuple(sorted({*l, *limits}))
                if r == road and s == n and (t not in best or new < best[t]):
                    best[t] = new
                    heapq.heappush(heap, (*new, t))
        if b in best:
            want[i] = best[b]
    assert len(want) > 15 and {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}


def test_pieces_split_at_junctions_only(spark):
    nodes = {i: (44 + i / 1000, 41.5) for i in range(9)}
    ways = {1: ([0, 1, 2, 3, 4], {"highway": "primary", "ref": "A", "maxspeed": "50"}), 2: ([4, 5, 2], {"highway": "primary", "ref": "A", "oneway": "yes"}), 3: ([6, 1], {"highway": "primary", "ref": "B"}), 4: ([7, 3], {"highway": "primary_link", "ref": "A"})}
    wanted = spark.createDataFrame([("r:A",)], "road string")
    seg = X.road_segments(ways_of(spark, ways, nodes), wanted)
    got = {(r.source, r.target): (round(r.metres), r.limits) for r in X.pieces(seg, spark.createDataFrame([("r:A", 3)], "road string, node long")).collect()}
    assert set(got) == {(0, 2), (2, 0), (2, 3), (3, 2), (3, 4), (4, 3), (4, 2)} and got[0, 2][1] == ["50"] and got[4, 2][1] == ["none"]
