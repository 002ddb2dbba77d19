"""Lines, zones, clusters and de-duplication against plain loops, on slanted polygons with a hole."""

import math
import random

import pytest
from pyspark.sql import functions as F

from terrane.functions import geo
from terrane.operators import graph, lines, spatial

OUTER = [(44.0, 41.0), (45.0, 41.2), (45.3, 42.0), (44.6, 41.8), (44.2, 42.3), (44.0, 41.0)]  # slanted, and concave
HOLE = [(44.4, 41.3), (44.7, 41.4), (44.5, 41.6), (44.4, 41.3)]


def rings():
    return F.array(geo.literal_ring(OUTER), geo.literal_ring(HOLE))


def inside(x, y):
    hit = False
    for ring in (OUTER, HOLE):
        for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                hit = not hit
    return hit


def walk(p, q, n=4000):
    return [(p[0] + (q[0] - p[0]) * i / n, p[1] + (q[1] - p[1]) * i / n) for i in range(n + 1)]


def test_segments_against_points_along_them(spark):
    rng = random.Random(1)
    pairs = []
    for i in range(150):
        p, q = [(rng.uniform(43.9, 45.4), rng.uniform(40.9, 42.4)) for _ in range(2)]
        if i % 2:
            q = (p[0] + (q[0] - p[0]) / 8, p[1] + (q[1] - p[1]) / 8)
        pairs.append((i, *p, *q))
    df = spark.createDataFrame(pairs, "i int, ax double, ay double, bx double, by double")
    p, q = geo.point(F.col("ax"), F.col("ay")), geo.point(F.col("bx"), F.col("by"))
    got = {r.i: r for r in df.select("i", geo.segment_hits(rings(), p, q).alias("hits"), geo.segment_within(rings(), p, q).alias("stays"), geo.line_gap_m(rings(), F.array(p, q)).alias("gap")).collect()}
    for i, ax, ay, bx, by in pairs:
        seen = [inside(x, y) for x, y in walk((ax, ay), (bx, by))]
        if got[i].hits != any(seen):  # a corner cut between two of the points
            assert got[i].hits and not any(inside(x, y) for x, y in walk((ax, ay), (bx, by), 100)), i
        if got[i].stays != all(seen):
            assert all(seen) and not got[i].stays and sum(seen) == len(seen), i
        assert (got[i].gap == 0) == got[i].hits


def test_clip_drops_what_crosses_between_good_nodes(spark):
    z = {"country": F.array(geo.literal_ring(geo.rectangle(0, 0, 10, 10))), "hard": F.array(geo.literal_ring([(4, 4), (6, 5), (5, 6), (4, 4)])), "band": F.array(geo.literal_ring(geo.rectangle(3.5, 3.5, 6.5, 6.5)))}
    ways = [
        (1, [(1.0, 5.0), (4.0, 5.2), (7.0, 5.3), (9.0, 5.0)], {"highway": "track"}),  # nodes clear of the triangle, the second segment isn't
        (2, [(1.0, 1.0), (2.0, 1.0)], {"highway": "track"}),
        (3, [(1.0, 1.0), (None, None), (2.0, 1.0), (3.0, 1.0)], {"highway": "primary"}),
        (4, [(4.9, 5.0), (5.0, 5.0)], {"building": "yes"}),
        (5, [(1.0, 5.0), (9.0, 5.3)], {"route": "ferry"}),
        (6, [(3.6, 3.6), (3.6, 3.9), (2.0, 2.0)], {"highway": "track"}),
        (7, [(9.0, 9.0), (11.0, 9.0)], {"highway": "primary"}),
    ]
    df = spark.createDataFrame([(w, [{"x": x, "y": y} for x, y in line], t) for w, line, t in ways], "way long, line array<struct<x:double,y:double>>, tags map<string,string>")
    got = {}
    for r in lines.cut_ways(lines.judged(df, z, ("track",)), 4_000_000_000).collect():
        got.setdefault(r.way, []).append((r.id, r.first, r.last, r.band, r.reason))
    for v in got.values():
        v.sort(key=lambda x: (x[1] is None, x[1]))
    assert got[1] == [(1, 0, 1, True, None), (4_000_000_000, 2, 3, False, None)]
    assert got[2] == [(2, 0, 1, False, None)] and got[4] == [(4, 0, 1, False, None)]
    assert got[3] == [(3, 2, 3, False, None)] and got[5][0][4] == "no_go" and got[7][0][4] == "outside"
    assert [x[3] for x in got[6]] == [True] and got[6][0][:3] == (6, 0, 2)


def metres(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * geo.EARTH_M * math.asin(min(1, math.sqrt(h)))


def groups_of_points(seed, n=500):
    """Heaps, chains, lone points and points just beside the radius of 300 m."""
    rng, out = random.Random(seed), []
    for g in range(n // 5):
        lat, lon = rng.uniform(41.5, 42.5), rng.uniform(44, 45)
        step = rng.choice((0, 20, 150, 290, 310)) / geo.DEGREE_M
        for k in range(5):
            out.append((lat + k * step * rng.uniform(0.9, 1.1), lon + rng.uniform(-0.0005, 0.0005)))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_clusters_lose_no_link(spark, seed):
    pts = groups_of_points(seed)
    df = spark.createDataFrame([(i, a, b, i % 2) for i, (a, b) in enumerate(pts)], "k long, lat double, lon double, kind int")
    got = {r.k: r.cluster for r in graph.linked_clusters(df, "k", 300.0, ("kind",)).collect()}
    parent = list(range(len(pts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(pts)):
        for j in range(i):
            if i % 2 == j % 2 and metres(pts[i], pts[j]) <= 300:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert got == {i: root(i) for i in range(len(pts))}


@pytest.mark.parametrize("seed", [1, 2])
def test_dedup_is_one_pass_in_order(spark, seed):
    rng, pts = random.Random(seed), groups_of_points(seed)
    pts += pts[:60]
    rows = [(i, str(i % 3 // 2), a, b, rng.choice((None, 0.0, 25.0, 90.0, 350.0)), rng.randrange(9)) for i, (a, b) in enumerate(pts)]
    df = spark.createDataFrame(rows, "k long, kind string, lat double, lon double, heading double, priority int")
    got = {r.k for r in graph.greedy_dedup(df, "k", 300.0).collect()}
    kept = []
    for r in sorted(rows, key=lambda r: (r[5], r[0])):
        def same(s, r=r):
            alike = (r[4] is None and s[4] is None) or (r[4] is not None and s[4] is not None and abs((r[4] - s[4] + 180) % 360 - 180) <= 30)
            return s[1] == r[1] and alike and metres(r[2:4], s[2:4]) <= 300

        if not any(map(same, kept)):
            kept.append(r)
    assert got == {r[0] for r in kept}


def test_near_boxes_like_all_pairs(spark):
    rng = random.Random(5)
    boxes = []
    for i in range(200):
        lat, lon = rng.uniform(41.5, 42.0), rng.uniform(44, 44.6)
        boxes.append((i, i % 3, lat, lon, lat + rng.random() ** 4 / 3, lon + rng.random() ** 4 / 3))
    df = spark.createDataFrame(boxes, "k long, g int, min_lat double, min_lon double, max_lat double, max_lon double")
    got = {(r.a, r.b) for r in spatial.near_boxes(df, "k", 1500.0, ("g",)).collect()}
    want = set()
    for a in boxes:
        for b in boxes:
            if a[0] < b[0] and a[1] == b[1]:
                dy = max(b[2] - a[4], a[2] - b[4], 0) * geo.DEGREE_M
                dx = max(b[3] - a[5], a[3] - b[5], 0) * geo.DEGREE_M * math.cos(math.radians((a[2] + a[4] + b[2] + b[4]) / 4))
                if math.hypot(dx, dy) <= 1500:
                    want.add((a[0], b[0]))
    assert got == want


def test_strict_rings_name_the_loose_end(spark):
    rows = spark.createDataFrame([(1, 0, 10, [1, 2, 3]), (1, 1, 11, [3, 4])], "relation long, pos int, way long, nodes array<long>")
    assert graph.assemble_rings(rows).first().loose == [10, 11]
    with pytest.raises(Exception, match="node 3|node 4"):
        graph.assemble_rings(rows, strict=True).collect()


def test_polygons_of_plain_numbers(spark):
    """Tests against a polygon of plain numbers are those against its column, and are compiled: no lambda goes through its sides."""
    rng = random.Random(3)
    ends = [(rng.uniform(43.9, 45.4), rng.uniform(40.9, 42.4)) for _ in range(150)] + OUTER + HOLE
    pairs = [(i, *rng.choice(ends), *rng.choice(ends)) for i in range(300)]
    df = spark.createDataFrame(pairs, "i long, ax double, ay double, bx double, by double")
    p, q = geo.point(F.col("ax"), F.col("ay")), geo.point(F.col("bx"), F.col("by"))
    line = F.array(p, q, geo.point(F.col("ax") + 0.2, F.col("by")))

    def asked(r):
        near = geo.ring_distance_m(r, p["y"], p["x"])
        return [geo.segment_hits(r, p, q), geo.segment_within(r, p, q), geo.contains(r, p["x"], p["y"]), geo.contains_closed(r, p["x"], p["y"]), near, geo.line_hits(r, line), geo.first_outside(line, r)]

    both = [[OUTER, HOLE], rings()]
    for r in df.select(*[F.struct(*asked(b)).alias(f"of{i}") for i, b in enumerate(both)]).collect():
        assert r.of0 == r.of1
    plan = df.select(*asked(both[0])[:5])._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "*(1) Project" in plan
    gaps = {r.i: r.metres for r in spatial.line_gaps(df.select("i", line.alias("line")), both[0], "i").collect()}
    assert gaps == {r.i: pytest.approx(r.m) for r in df.select("i", geo.line_gap_m(rings(), line).alias("m")).collect()}
