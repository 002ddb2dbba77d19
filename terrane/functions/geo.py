"""Geometry as Column expressions: distances, bearings, rings, predicates, tiles.

Coordinates are degrees; a ring or a line is array<struct<x:double,y:double>>, a polygon is an array of
rings under the even-odd rule. Nothing here leaves the JVM.

A polygon that is known when a query is built may be given as plain numbers, rings of (x, y), instead of a
column: tests of points and segments against it are then spelt out side by side, which Spark compiles, while
a column's sides are gone through one by one for each row.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A polygon: a column, or its rings as plain numbers.
Rings = Column | list[list[tuple[float, float]]]

# Fixed values
EARTH_M = 6371008.8
DEGREE_M = EARTH_M * math.pi / 180


def let(value: Column, body) -> Column:
    """body(value), with the value computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres between two points."""
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def flat_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres on a plane whose east is scaled at the first point; for short distances."""
    return F.hypot((lon2 - lon1) * F.cos(F.radians(lat1)) * DEGREE_M, (lat2 - lat1) * DEGREE_M)


def box_distance_m(lat: Column, lon: Column, min_lat: Column, min_lon: Column, max_lat: Column, max_lon: Column) -> Column:
    """Metres from a point to a box, 0 inside."""
    dy = F.greatest(min_lat - lat, lat - max_lat, F.lit(0.0))
    dx = F.greatest(min_lon - lon, lon - max_lon, F.lit(0.0))
    return F.hypot(dx * F.cos(F.radians(lat)) * DEGREE_M, dy * DEGREE_M)


def box_gap_m(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Metres between two boxes (min_lat, min_lon, max_lat, max_lon), 0 where they touch; east is scaled at the mean of their four latitudes."""
    dy = F.greatest(b["min_lat"] - a["max_lat"], a["min_lat"] - b["max_lat"], F.lit(0.0))
    dx = F.greatest(b["min_lon"] - a["max_lon"], a["min_lon"] - b["max_lon"], F.lit(0.0))
    middle = (a["min_lat"] + a["max_lat"] + b["min_lat"] + b["max_lat"]) / 4
    return F.hypot(dx * F.cos(F.radians(middle)) * DEGREE_M, dy * DEGREE_M)


def along(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Where on a segment, from 0 to 1, the nearest point lies; planar units."""
    dx, dy = bx - ax, by - ay
    size = dx * dx + dy * dy
    return F.when(size > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - ax) * dx + (py - ay) * dy) / size))).otherwise(0.0)


def segment_distance_m(lat: Column, lon: Column, lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres from a point to a segment, on the plane scaled at the point."""
    k = F.cos(F.radians(lat)) * DEGREE_M
    ax, ay, bx, by = (lon1 - lon) * k, (lat1 - lat) * DEGREE_M, (lon2 - lon) * k, (lat2 - lat) * DEGREE_M
    t = along(F.lit(0.0), F.lit(0.0), ax, ay, bx, by)
    return F.hypot(ax + t * (bx - ax), ay + t * (by - ay))


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """First direction of travel in degrees from north, 0 to 360."""
    a, b, d = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    turn = F.degrees(F.atan2(F.sin(d) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d)))
    return F.pmod(turn + 360.0, F.lit(360.0))


def angle_diff(a: Column, b: Column) -> Column:
    """The smaller angle between two directions, 0 to 180."""
    return F.abs(F.pmod(a - b + 180.0, F.lit(360.0)) - 180.0)


def onto_line(direction: Column, line: Column) -> Column:
    """Of a line's two directions the one nearer to a direction."""
    return F.when(angle_diff(direction, line) <= 90.0, F.pmod(line, F.lit(360.0))).otherwise(F.pmod(line + 180.0, F.lit(360.0)))


# ---------------------------------------------------------------- rings and lines


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def rectangle(min_x: float, min_y: float, max_x: float, max_y: float) -> list[tuple[float, float]]:
    return [(min_x, min_y), (max_x, min_y), (max_x, max_y), (min_x, max_y), (min_x, min_y)]


def literal_ring(points: list[tuple[float, float]]) -> Column:
    return F.array(*[point(F.lit(x), F.lit(y)) for x, y in points])


def clean_ring(ring: Column) -> Column:
    """A ring without its repeated last point."""
    return F.when((F.size(ring) > 1) & (F.get(ring, F.lit(0)) == F.get(ring, F.size(ring) - 1)), F.slice(ring, 1, F.size(ring) - 1)).otherwise(ring)


def edges(line: Column) -> Column:
    """Neighbouring points of a line as structs of a and b."""
    n = F.greatest(F.size(line) - 1, F.lit(0))
    return F.zip_with(F.slice(line, 1, n), F.slice(line, 2, n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def closed(ring: Column) -> Column:
    """A ring that ends where it starts."""
    return let(clean_ring(ring), lambda r: F.when(F.size(r) > 0, F.concat(r, F.slice(r, 1, 1))).otherwise(r))


def signed_area(ring: Column) -> Column:
    """Twice-signed shoelace halved: positive where the ring turns left."""
    return F.aggregate(edges(closed(ring)), F.lit(0.0), lambda s, e: s + (e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])) / 2


def centroid(ring: Column) -> Column:
    """Centre of a ring's area; of its points where it has none."""
    zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def step(s: Column, e: Column) -> Column:
        c = e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]
        return F.struct((s["w"] + c).alias("w"), (s["x"] + (e["a"]["x"] + e["b"]["x"]) * c).alias("x"), (s["y"] + (e["a"]["y"] + e["b"]["y"]) * c).alias("y"))

    mean = lambda r, k: F.aggregate(r, F.lit(0.0), lambda s, p: s + p[k]) / F.greatest(F.size(r), F.lit(1))
    whole = lambda r: F.aggregate(edges(closed(r)), zero, step, lambda s: F.when(F.abs(s["w"]) > 1e-15, point(s["x"] / (3 * s["w"]), s["y"] / (3 * s["w"]))))
    return let(clean_ring(ring), lambda r: F.coalesce(whole(r), point(mean(r, "x"), mean(r, "y"))))


def _crossings(rings: Column, x: Column, y: Column) -> Column:
    """How many edges a ray to the right of a point crosses; an edge holds its lower end, not its upper one."""
    hit = lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / F.nullif(e["b"]["y"] - e["a"]["y"], F.lit(0.0)) + e["a"]["x"])
    return F.aggregate(rings, F.lit(0), lambda n, ring: n + F.size(F.filter(edges(closed(ring)), hit)))


def contains(rings: Rings, x: Column, y: Column) -> Column:
    """Even-odd point in polygon, half-open: of two polygons that share an edge one holds a point on it."""
    if isinstance(rings, list):
        return within_sides(ring_edges(rings), x, y)
    return _crossings(rings, x, y) % 2 == 1


def on_edge(rings: Rings, x: Column, y: Column, within: float = 0.0) -> Column:
    """Whether a point is on (or, in degrees, within a distance of) an edge."""
    def near(e: Column) -> Column:
        t = along(x, y, e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"])
        return F.hypot(e["a"]["x"] + t * (e["b"]["x"] - e["a"]["x"]) - x, e["a"]["y"] + t * (e["b"]["y"] - e["a"]["y"]) - y) <= within

    if isinstance(rings, list):
        return any_of([near(e) for e in ring_edges(rings)])
    return F.exists(rings, lambda ring: F.exists(edges(closed(ring)), near))


def contains_closed(rings: Rings, x: Column, y: Column) -> Column:
    """Point in polygon, its edges included."""
    return contains(rings, x, y) | on_edge(rings, x, y, 1e-12)


def winding(rings: Column, x: Column, y: Column) -> Column:
    """A second way to tell a point in one ring, by turns around it; for cross-checks."""
    side = lambda e: (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) - (x - e["a"]["x"]) * (e["b"]["y"] - e["a"]["y"])
    turn = lambda e: F.when((e["a"]["y"] <= y) & (e["b"]["y"] > y) & (side(e) > 0), 1).when((e["a"]["y"] > y) & (e["b"]["y"] <= y) & (side(e) < 0), -1).otherwise(0)
    return F.aggregate(rings, F.lit(0), lambda n, ring: n + F.aggregate(edges(closed(ring)), F.lit(0), lambda m, e: m + turn(e))) != 0


def ring_distance_m(rings: Rings, lat: Column, lon: Column) -> Column:
    """Metres from a point to the nearest edge of a polygon, whichever side it is on."""
    metres = lambda e: segment_distance_m(lat, lon, e["a"]["y"], e["a"]["x"], e["b"]["y"], e["b"]["x"])
    if isinstance(rings, list):
        return F.least(*[metres(e) for e in ring_edges(rings)])
    each = lambda ring: F.transform(edges(closed(ring)), metres)
    return F.array_min(F.flatten(F.transform(rings, each)))


def within_m(rings: Rings, lat: Column, lon: Column, metres: float) -> Column:
    """In a polygon or not further than so many metres from it: a buffer as a predicate."""
    return contains(rings, lon, lat) | (ring_distance_m(rings, lat, lon) <= metres)


def segments_cross(p: Column, q: Column, a: Column, b: Column) -> Column:
    """Whether two closed segments share a point."""
    turn = lambda o, s, t: F.signum((s["x"] - o["x"]) * (t["y"] - o["y"]) - (s["y"] - o["y"]) * (t["x"] - o["x"]))
    d1, d2, d3, d4 = turn(p, q, a), turn(p, q, b), turn(a, b, p), turn(a, b, q)
    among = lambda o, s, t: (t["x"] >= F.least(o["x"], s["x"])) & (t["x"] <= F.greatest(o["x"], s["x"])) & (t["y"] >= F.least(o["y"], s["y"])) & (t["y"] <= F.greatest(o["y"], s["y"]))
    return ((d1 * d2 < 0) & (d3 * d4 < 0)) | ((d1 == 0) & among(p, q, a)) | ((d2 == 0) & among(p, q, b)) | ((d3 == 0) & among(a, b, p)) | ((d4 == 0) & among(a, b, q))


#: All edges of a polygon: a column, or of plain numbers.
Sides = Column | list[dict]


def _open(ring: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """clean_ring of plain numbers."""
    return ring[:-1] if len(ring) > 1 and ring[0] == ring[-1] else ring


def ring_edges(rings: Rings) -> Sides:
    """All edges of a polygon, for tests of many segments against it."""
    if isinstance(rings, list):
        spot = lambda p: {"x": F.lit(float(p[0])), "y": F.lit(float(p[1]))}
        return [{"a": spot(a), "b": spot(b), "at": (a, b)} for ring in map(_open, rings) for a, b in zip(ring, [*ring[1:], *ring[:1]], strict=True)]
    return F.flatten(F.transform(rings, lambda ring: edges(closed(ring))))


def with_edges(rings: Rings, body) -> Column:
    """body(ring_edges(rings)), which are computed once for a row."""
    return body(ring_edges(rings)) if isinstance(rings, list) else let(ring_edges(rings), body)


def any_of(tests: list[Column]) -> Column:
    """Whether any holds, null as `exists` has it."""
    return functools.reduce(operator.or_, tests, F.lit(False))


def within_sides(sides: Sides, x: Column, y: Column) -> Column:
    """Even-odd point in polygon, as `contains`, by all its edges."""
    hit = lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"])
    if isinstance(sides, list):
        # no point is at a level edge's height and beside it
        return functools.reduce(operator.add, [F.when(hit(e), 1).otherwise(0) for e in sides if e["at"][0][1] != e["at"][1][1]], F.lit(0)) % 2 == 1
    return F.size(F.filter(sides, hit)) % 2 == 1


def meets(sides: Sides, p: Column, q: Column) -> Column:
    """Whether a segment shares a point with one of a polygon's edges."""
    if isinstance(sides, list):
        return any_of([~_beside(e["at"], p, q) & segments_cross(p, q, e["a"], e["b"]) for e in sides])
    return F.exists(sides, lambda e: segments_cross(p, q, e["a"], e["b"]))


def _beside(points: Iterable[tuple[float, float]], p: Column, q: Column) -> Column:
    """Whether both ends of a segment lie on one side of the points' box, so that it can't touch what they bound."""
    xs, ys = zip(*points, strict=True)
    off = lambda k, lo, hi: ((p[k] < lo) & (q[k] < lo)) | ((p[k] > hi) & (q[k] > hi))
    return off("x", float(min(xs)), float(max(xs))) | off("y", float(min(ys)), float(max(ys)))


def segment_hits(rings: Rings, p: Column, q: Column) -> Column:
    """Whether a segment touches a polygon: an end inside, or an edge met."""
    if isinstance(rings, list):
        s = ring_edges(rings)
        return ~_beside([xy for ring in rings for xy in ring], p, q) & (within_sides(s, p["x"], p["y"]) | within_sides(s, q["x"], q["y"]) | meets(s, p, q))
    return let(ring_edges(rings), lambda s: within_sides(s, p["x"], p["y"]) | within_sides(s, q["x"], q["y"]) | meets(s, p, q))


def segment_within(rings: Rings, p: Column, q: Column) -> Column:
    """Whether a segment stays in a polygon: both ends and the middle inside, and no edge met between its ends.

    An end may lie on an edge; a segment that touches a corner on its way counts as leaving, to be safe.
    """
    turn = lambda o, s, t: F.signum((s["x"] - o["x"]) * (t["y"] - o["y"]) - (s["y"] - o["y"]) * (t["x"] - o["x"]))

    def crossed(e: Column) -> Column:
        d1, d2, d3, d4 = turn(p, q, e["a"]), turn(p, q, e["b"]), turn(e["a"], e["b"], p), turn(e["a"], e["b"], q)
        return (d3 * d4 < 0) & (d1 * d2 <= 0)

    middle = point((p["x"] + q["x"]) / 2, (p["y"] + q["y"]) / 2)
    ends = contains_closed(rings, p["x"], p["y"]) & contains_closed(rings, q["x"], q["y"])
    if isinstance(rings, list):
        return ends & contains_closed(rings, middle["x"], middle["y"]) & ~any_of([crossed(e) for e in ring_edges(rings)])
    return ends & contains_closed(rings, middle["x"], middle["y"]) & ~F.exists(rings, lambda ring: F.exists(edges(closed(ring)), crossed))


def line_hits(rings: Rings, line: Column) -> Column:
    """Whether a line (or its only point) touches a polygon."""
    alone = F.when(F.size(line) == 1, contains_closed(rings, F.get(line, F.lit(0))["x"], F.get(line, F.lit(0))["y"])).otherwise(F.lit(False))
    return F.when(F.size(line) > 1, F.exists(edges(line), lambda e: segment_hits(rings, e["a"], e["b"]))).otherwise(alone)


def line_gap_m(rings: Column, line: Column) -> Column:
    """Metres from a line to a polygon, 0 where they touch: the least of the line's corners to edges and the polygon's corners to segments."""
    corners = F.flatten(F.transform(rings, clean_ring))
    ends = F.array_min(F.transform(line, lambda p: ring_distance_m(rings, p["y"], p["x"])))
    sides = F.array_min(F.flatten(F.transform(edges(line), lambda e: F.transform(corners, lambda c: segment_distance_m(c["y"], c["x"], e["a"]["y"], e["a"]["x"], e["b"]["y"], e["b"]["x"])))))
    return F.when(line_hits(rings, line), 0.0).otherwise(F.least(ends, sides))


def representative_point(rings: Column, outer: Column | int = 1) -> Column:
    """A point that speaks for a polygon: the outer rings' weighted centre if inside; else the middle of the
    widest stretch inside at the middle height; else the first point."""
    outer = F.lit(outer) if isinstance(outer, int) else outer
    zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def weigh(s: Column, r: Column) -> Column:
        w, c = F.abs(signed_area(r)), centroid(r)
        return F.struct((s["w"] + w).alias("w"), (s["x"] + w * c["x"]).alias("x"), (s["y"] + w * c["y"]).alias("y"))

    middle = F.aggregate(F.slice(rings, 1, outer), zero, weigh, lambda s: F.when(s["w"] > 0, point(s["x"] / s["w"], s["y"] / s["w"])))
    flat = F.flatten(rings)
    height = (F.array_min(F.transform(flat, lambda p: p["y"])) + F.array_max(F.transform(flat, lambda p: p["y"]))) / 2
    met = lambda y: F.array_sort(F.flatten(F.transform(rings, lambda r: F.transform(F.filter(edges(closed(r)), lambda e: (e["a"]["y"] > y) != (e["b"]["y"] > y)), lambda e: (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"]))))
    gaps = lambda xs, y: F.transform(F.sequence(F.lit(0), F.greatest(F.size(xs) / 2 - 1, F.lit(0)).cast("int")), lambda i: F.struct((F.get(xs, 2 * i + 1) - F.get(xs, 2 * i)).alias("w"), point((F.get(xs, 2 * i + 1) + F.get(xs, 2 * i)) / 2, y).alias("p")))
    widest = let(height, lambda y: let(met(y), lambda xs: F.when(F.size(xs) > 1, F.array_max(gaps(xs, y))["p"])))
    inside = let(middle, lambda m: F.when(contains(rings, m["x"], m["y"]), m))
    return F.coalesce(inside, widest, F.get(flat, F.lit(0)))


def line_length_m(line: Column) -> Column:
    return F.aggregate(edges(line), F.lit(0.0), lambda s, e: s + distance_m(e["a"]["y"], e["a"]["x"], e["b"]["y"], e["b"]["x"]))


def hausdorff_m(a: Column, b: Column) -> Column:
    """The farthest that a corner of one line is from the other line, both ways."""
    far = lambda s, t: F.array_max(F.transform(s, lambda p: F.array_min(F.transform(edges(t), lambda e: segment_distance_m(p["y"], p["x"], e["a"]["y"], e["a"]["x"], e["b"]["y"], e["b"]["x"])))))
    return F.greatest(far(a, b), far(b, a))


def outside_m(line: Column, rings: Column) -> Column:
    """How far a line's corners poke out of a polygon."""
    return F.array_max(F.transform(line, lambda p: F.when(contains(rings, p["x"], p["y"]), 0.0).otherwise(ring_distance_m(rings, p["y"], p["x"]))))


def geometry_key(rings: Column, places: int = 7) -> Column:
    """SHA-256 of a polygon that doesn't depend on the direction, start or order of its rings."""
    spell = lambda r: F.transform(r, lambda p: F.format_string("%." + str(places) + "f %." + str(places) + "f", p["x"], p["y"]))
    turned = lambda s: let(F.array_position(s, F.array_min(s)).cast("int"), lambda i: F.concat(F.slice(s, i, F.size(s)), F.slice(s, 1, i - 1)))
    one = lambda r: let(spell(clean_ring(r)), lambda s: F.least(F.array_join(turned(s), ","), F.array_join(turned(F.reverse(s)), ",")))
    return F.sha2(F.array_join(F.array_sort(F.transform(rings, one)), ";"), 256)


def bounds(line: Column) -> Column:
    xs, ys = F.transform(line, lambda p: p["x"]), F.transform(line, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"), F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y"))


def outward(value: Column, places: int, up: bool) -> Column:
    """Rounded away from the inside of a box."""
    scale = float(10**places)
    return (F.ceil(value * scale) if up else F.floor(value * scale)) / scale


def first_outside(line: Column, rings: Rings) -> Column:
    """The first corner (from 0) of a line that isn't in a polygon; null where all are."""
    i = F.array_position(F.transform(line, lambda p: contains(rings, p["x"], p["y"])), F.lit(False)) - 1
    return F.when(i >= 0, i)


# ---------------------------------------------------------------- plane projection


def aeqd(lat: Column, lon: Column, lat0: float, lon0: float) -> Column:
    """Azimuthal equidistant metres around a centre, on a sphere."""
    a, b, d = F.radians(lat), math.radians(lat0), F.radians(lon - lon0)
    cos_c = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.sin(a) * math.sin(b) + F.cos(a) * math.cos(b) * F.cos(d)))
    c = F.acos(cos_c)
    k = F.when(c > 1e-12, c / F.sin(c)).otherwise(1.0) * EARTH_M
    return point(k * F.cos(a) * F.sin(d), k * (math.cos(b) * F.sin(a) - math.sin(b) * F.cos(a) * F.cos(d)))


# ---------------------------------------------------------------- tiles


def tile_x(lon: Column, z: int) -> Column:
    n = 1 << z
    return F.least(F.lit(n - 1), F.greatest(F.lit(0), F.floor((lon + 180.0) / 360.0 * n))).cast("long")


def tile_y(lat: Column, z: int) -> Column:
    n = 1 << z
    r = F.radians(lat)
    return F.least(F.lit(n - 1), F.greatest(F.lit(0), F.floor((1 - F.ln(F.tan(r) + 1 / F.cos(r)) / math.pi) / 2 * n))).cast("long")


def tile_lon(x: Column, z: int) -> Column:
    return x / float(1 << z) * 360.0 - 180.0


def tile_lat(y: Column, z: int) -> Column:
    return F.degrees(F.atan(F.sinh(math.pi * (1 - 2 * y / float(1 << z)))))


def hilbert_id(z: int, x: Column, y: Column) -> Column:
    """A tile's number along the Hilbert curves of all zooms up to its own."""
    start = (4**z - 1) // 3
    state = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(start).cast("long").alias("d"))

    def step(s: Column, level: Column) -> Column:
        side = F.shiftleft(F.lit(1).cast("long"), 0)
        side = F.pow(F.lit(2.0), level).cast("long")
        rx = F.when(s["x"].bitwiseAND(side) != 0, 1).otherwise(0).cast("long")
        ry = F.when(s["y"].bitwiseAND(side) != 0, 1).otherwise(0).cast("long")
        d = s["d"] + side * side * ((3 * rx).bitwiseXOR(ry))
        flip = (ry == 0) & (rx == 1)
        fx, fy = F.when(flip, side - 1 - s["x"]).otherwise(s["x"]), F.when(flip, side - 1 - s["y"]).otherwise(s["y"])
        # within the quadrant only the low bits matter
        return F.struct(F.when(ry == 0, fy).otherwise(fx).alias("x"), F.when(ry == 0, fx).otherwise(fy).alias("y"), d.alias("d"))

    levels = F.lit(list(range(z - 1, -1, -1))).cast("array<int>") if z else F.array().cast("array<int>")
    masked = lambda s, level: F.struct(s["x"].bitwiseAND(2 * F.pow(F.lit(2.0), level).cast("long") - 1).alias("x"), s["y"].bitwiseAND(2 * F.pow(F.lit(2.0), level).cast("long") - 1).alias("y"), s["d"].alias("d"))
    return F.aggregate(levels, state, lambda s, level: step(masked(s, level), level), lambda s: s["d"])


def tile_of_hilbert(tile_id: Column) -> Column:
    """struct<z, x, y> of a tile's number."""
    zooms = F.transform(F.lit(list(range(27))).cast("array<int>"), lambda z: ((F.pow(F.lit(4.0), z) - 1) / 3).cast("long"))
    z = F.size(F.filter(zooms, lambda s: s <= tile_id)) - 1
    start = lambda k: ((F.pow(F.lit(4.0), k) - 1) / 3).cast("long")

    def step(s: Column, level: Column) -> Column:
        side = F.pow(F.lit(2.0), level).cast("long")
        rx = (s["t"] / 2).cast("long").bitwiseAND(1)
        ry = s["t"].bitwiseXOR(rx).bitwiseAND(1)
        flip = (ry == 0) & (rx == 1)
        fx, fy = F.when(flip, side - 1 - s["x"]).otherwise(s["x"]), F.when(flip, side - 1 - s["y"]).otherwise(s["y"])
        x, y = F.when(ry == 0, fy).otherwise(fx), F.when(ry == 0, fx).otherwise(fy)
        return F.struct((x + side * rx).alias("x"), (y + side * ry).alias("y"), F.floor(s["t"] / 4).cast("long").alias("t"))

    def path(k: Column) -> Column:
        first = F.struct(F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), (tile_id - start(k)).cast("long").alias("t"))
        levels = F.when(k > 0, F.sequence(F.lit(0), k - 1)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(levels, first, step, lambda s: F.struct(k.alias("z"), s["x"].alias("x"), s["y"].alias("y")))

    return let(z, path)
