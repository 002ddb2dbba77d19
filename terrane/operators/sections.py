"""Average-speed sections on their roads: both ends onto the carriageway that carries their traffic, and the limits of the walk between.

A road's ways make a graph: they are split where they meet (and where a section begins or ends), a piece leads along its way,
against it, or both, by its one-way sign, and knows its metres and the limits on it. Walks go from all sections at once, by
rounds: the nodes that got nearer in the last round are joined to the pieces that begin there. A round passes a whole piece,
so there are as many rounds as a walk has pieces, and no section or road has to fit into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import tags as T
from ..runtime import checkpointed, forgotten
from .spatial import cell, zone

#: Cells of segments, in degrees; limits are told as text, this where there is none.
SIZE, NONE = 0.02, "none"


def road_segments(ways: DataFrame, wanted: DataFrame) -> DataFrame:
    """Segments of the wanted roads: road (r:ref or n:name), way, pos, their two nodes and points, highway, sign, forward, backward.

    ways: way, refs, line, tags; wanted: road. A way of several refs or names is there for each of them.
    """
    names = F.array_compact(F.array(*[T.tag(F.col("tags"), k) for k in ("name", "name:ka")]))
    roads = F.array_distinct(F.concat(F.transform(F.coalesce(T.values(T.tag(F.col("tags"), "ref")), F.array().cast("array<string>")), lambda v: F.concat(F.lit("r:"), v)), F.transform(names, lambda v: F.concat(F.lit("n:"), v))))
    w = ways.withColumn("road", F.explode(roads)).join(wanted.select("road").distinct(), "road", "left_semi")
    plain = T.maxspeed(T.tag(F.col("tags"), "maxspeed"))
    limit = lambda k: F.coalesce(T.maxspeed(T.tag(F.col("tags"), k)), plain)
    w = w.select("road", "way", "refs", "line", T.oneway(F.col("tags")).alias("sign"), F.coalesce(T.tag(F.col("tags"), "highway"), F.lit("")).alias("highway"), limit("maxspeed:forward").alias("forward"), limit("maxspeed:backward").alias("backward"))
    pairs = F.zip_with(F.slice("refs", 1, F.size("refs") - 1), F.slice("refs", 2, F.size("refs")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    both = F.arrays_zip(pairs.alias("n"), geo.edges(F.col("line")).alias("e"))
    each = w.where(F.size("refs") >= 2).select("road", "way", "sign", "highway", "forward", "backward", F.posexplode(both).alias("pos", "s"))
    s = each.select("road", "way", "pos", "sign", "highway", "forward", "backward", F.col("s.n.a").alias("a"), F.col("s.n.b").alias("b"), F.col("s.e.a.x").alias("x1"), F.col("s.e.a.y").alias("y1"), F.col("s.e.b.x").alias("x2"), F.col("s.e.b.y").alias("y2"))
    return s.where("x1 is not null and x2 is not null and y1 is not null and y2 is not null")


def placed(ends: DataFrame, segments: DataFrame, snap_m: float, line_max_deg: float) -> DataFrame:
    """Ends (id, end, road, lat, lon, travel) with the carriageway of their road that is nearest and carries their traffic.

    -> id, end, way, pos, ahead (along the way), p_lat, p_lon, heading. Of a way its nearest segment counts; it has to run
    within line_max_deg of the travel, and a one-way one in that direction.
    """
    grow = snap_m / geo.DEGREE_M * 2
    span = lambda a, b: F.sequence(cell(F.least(a, b) - grow, SIZE), cell(F.greatest(a, b) + grow, SIZE))
    s = segments.withColumn("_cx", F.explode(span(F.col("x1"), F.col("x2")))).withColumn("_cy", F.explode(span(F.col("y1"), F.col("y2"))))
    e = ends.withColumn("_cx", cell(F.col("lon"), SIZE)).withColumn("_cy", cell(F.col("lat"), SIZE))
    lat, lon = F.col("lat"), F.col("lon")
    metres = geo.segment_distance_m(lat, lon, F.col("y1"), F.col("x1"), F.col("y2"), F.col("x2"))
    m = e.join(s, ["road", "_cx", "_cy"]).withColumn("metres", metres).where(F.col("metres") <= snap_m)
    one = Window.partitionBy("id", "end", "way").orderBy("metres", "pos")
    m = m.withColumn("k", F.row_number().over(one)).where("k = 1")
    line = geo.bearing(F.col("y1"), F.col("x1"), F.col("y2"), F.col("x2"))
    m = m.withColumn("line", line).withColumn("heading", geo.onto_line(F.col("travel"), F.col("line")))
    allowed = F.when(F.col("sign") > 0, F.col("line")).otherwise(F.col("line") + 180.0)
    good = (geo.angle_diff(F.col("travel"), F.col("heading")) <= line_max_deg) & ((F.col("sign") == 0) | (geo.angle_diff(allowed, F.col("heading")) <= 90.0))
    first = Window.partitionBy("id", "end").orderBy("metres", "way")
    m = m.where(good).withColumn("k", F.row_number().over(first)).where("k = 1")
    k = F.cos(F.radians(lat)) * geo.DEGREE_M
    at = geo.along(lon * k, lat * geo.DEGREE_M, F.col("x1") * k, F.col("y1") * geo.DEGREE_M, F.col("x2") * k, F.col("y2") * geo.DEGREE_M)
    m = m.withColumn("ahead", geo.angle_diff(F.col("heading"), F.col("line")) <= 90.0).withColumn("t", at)
    return m.select("id", "end", "road", "way", "pos", "ahead", (F.col("y1") + F.col("t") * (F.col("y2") - F.col("y1"))).alias("p_lat"), (F.col("x1") + F.col("t") * (F.col("x2") - F.col("x1"))).alias("p_lon"), "heading", "a", "b", "x1", "y1", "x2", "y2", "forward", "backward", "highway")


def _limit(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(NONE))


def pieces(segments: DataFrame, ends: DataFrame) -> DataFrame:
    """The graph of roads: road, source, target, metres, limits (of segments of a metre or more), a row for each direction of each piece.

    ends: road, node: where pieces end besides. Links are no part of it.
    """
    s = segments.where(~F.col("highway").endswith("_link"))
    nodes = s.select("road", "way", F.col("a").alias("node")).unionByName(s.groupBy("road", "way").agg(F.max_by("b", "pos").alias("node")))
    shared = nodes.groupBy("road", "node").count().where(F.col("count") > 1).select("road", "node")
    tips = s.groupBy("road", "way").agg(F.min_by("a", "pos").alias("first")).select("road", F.col("first").alias("node"))
    cuts = shared.unionByName(tips).unionByName(ends.select("road", "node")).distinct().withColumn("cut", F.lit(1))
    w = Window.partitionBy("road", "way").orderBy("pos")
    cut = s.withColumn("node", F.col("a")).join(cuts, ["road", "node"], "left").withColumn("cut", F.coalesce("cut", F.lit(0)))
    # written down, as both directions go through it
    run = cut.withColumn("run", F.sum("cut").over(w)).withColumn("m", geo.distance_m(F.col("y1"), F.col("x1"), F.col("y2"), F.col("x2")))
    run, long = checkpointed(run), F.col("m") >= 1.0
    p = run.groupBy("road", "way", "run", "sign").agg(F.min_by("a", "pos").alias("a"), F.max_by("b", "pos").alias("b"), F.sum("m").alias("metres"), F.collect_set(F.when(long, _limit(F.col("forward")))).alias("f"), F.collect_set(F.when(long, _limit(F.col("backward")))).alias("r"))
    ahead = p.where("sign >= 0").select("road", F.col("a").alias("source"), F.col("b").alias("target"), "metres", F.col("f").alias("limits"))
    back = p.where("sign <= 0").select("road", F.col("b").alias("source"), F.col("a").alias("target"), "metres", F.col("r").alias("limits"))
    return ahead.unionByName(back)


def walks(trips: DataFrame, graph: DataFrame) -> DataFrame:
    """The shortest walk of each trip: id, metres, limits; none beyond most.

    trips: id, road, source, target, most (a walk goes on from nodes within so many metres). Of equally long walks
    the one with the lesser list of limits counts.
    """
    zero = F.array().cast("array<string>")
    reached = forgotten(trips.select("id", "road", F.col("source").alias("node"), "target", "most", F.struct(F.lit(0.0).alias("metres"), zero.alias("limits")).alias("best")))
    front = reached
    while not front.isEmpty():
        goal = reached.where("node = target").select("id", F.col("best.metres").alias("goal"))
        on = front.where(F.col("best.metres") <= F.col("most")).join(goal, "id", "left").where("node != target and (goal is null or best.metres < goal)")
        step = on.join(graph.select("road", F.col("source").alias("node"), F.col("target").alias("next"), F.col("metres").alias("m"), F.col("limits").alias("l")), ["road", "node"])
        far = F.struct((F.col("best.metres") + F.col("m")).alias("metres"), F.array_sort(F.array_union("best.limits", "l")).alias("limits"))
        offered = step.select("id", "road", F.col("next").alias("node"), "target", "most", far.alias("far")).groupBy("id", "road", "node", "target", "most").agg(F.min("far").alias("far"))
        old = reached.select("id", "node", F.col("best").alias("old"))
        front = forgotten(offered.join(old, ["id", "node"], "left").where("old is null or far < old").select("id", "road", "node", "target", "most", F.col("far").alias("best")))
        reached = forgotten(reached.join(front.select("id", "node"), ["id", "node"], "left_anti").unionByName(front))
    return reached.where("node = target").select("id", F.col("best.metres").alias("metres"), F.col("best.limits").alias("limits"))


def place_sections(sections: DataFrame, ways: DataFrame, rings: dict[str, geo.Rings], snap_m: float = 60.0, line_max_deg: float = 25.0) -> DataFrame:
    """Sections whose both ends land on their road, outside of what is closed: id, lat, lon, end_lat, end_lon, heading, maxspeed, src, band, why.

    sections: id, road (r:ref or n:name), a_lat, a_lon, b_lat, b_lon, maxspeed, status; ways: way, refs, line, tags.
    A confirmed limit counts unless the road's own says otherwise; a corroborated one while every piece of the walk says the
    same; of others the number is left out. `why`: conflict, no walk, the other limits, unconfirmed, or null.
    """
    travel = geo.bearing(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon"))
    s = sections.withColumn("travel", travel)
    end = lambda e: s.select("id", F.lit(e).alias("end"), "road", F.col(f"{e}_lat").alias("lat"), F.col(f"{e}_lon").alias("lon"), "travel")
    seg = checkpointed(road_segments(ways, sections))
    on = checkpointed(placed(end("a").unionByName(end("b")), seg, snap_m, line_max_deg))
    told = ("way", "pos", "ahead", "p_lat", "p_lon", "heading", "a", "b", "x1", "y1", "x2", "y2", "forward", "backward")
    side = lambda e: on.where(F.col("end") == e).select("id", *[F.col(c).alias(f"{e}{e}_{c}") for c in told])
    both = s.join(side("a"), "id").join(side("b"), "id")
    z = {e: zone(rings, F.col(f"{e}{e}_p_lat"), F.col(f"{e}{e}_p_lon")) for e in "ab"}
    both = both.withColumn("za", z["a"]).withColumn("zb", z["b"]).where(~F.coalesce(F.col("za").isin("outside", "occupied", "buffer"), F.lit(False)) & ~F.coalesce(F.col("zb").isin("outside", "occupied", "buffer"), F.lit(False)))
    own = F.when(F.col("aa_ahead"), F.col("aa_forward")).otherwise(F.col("aa_backward"))
    last = F.when(F.col("bb_ahead"), F.col("bb_forward")).otherwise(F.col("bb_backward"))
    tip = lambda e, ahead, c: F.when(F.col(f"{e}{e}_ahead") == F.lit(ahead), F.col(f"{e}{e}_{c[1]}")).otherwise(F.col(f"{e}{e}_{c[0]}"))
    start, stop = {c: tip("a", True, p) for c, p in (("n", ("a", "b")), ("x", ("x1", "x2")), ("y", ("y1", "y2")))}, {c: tip("b", False, p) for c, p in (("n", ("a", "b")), ("x", ("x1", "x2")), ("y", ("y1", "y2")))}
    both = both.withColumn("own", own).withColumn("last", last).withColumn("source", start["n"]).withColumn("target", stop["n"])
    both = both.withColumn("first_m", geo.distance_m(F.col("aa_p_lat"), F.col("aa_p_lon"), start["y"], start["x"])).withColumn("last_m", geo.distance_m(stop["y"], stop["x"], F.col("bb_p_lat"), F.col("bb_p_lon")))
    both = checkpointed(both.withColumn("same", (F.col("aa_way") == F.col("bb_way")) & (F.col("aa_pos") == F.col("bb_pos")) & (F.col("aa_ahead") == F.col("bb_ahead"))))
    asked = both.where("status = 'corroborated' and not same")
    gap = geo.distance_m(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon"))
    trips = asked.select("id", "road", "source", "target", F.greatest(3 * gap, gap + 3000.0).alias("most"))
    cuts = trips.select("road", F.col("source").alias("node")).unionByName(trips.select("road", F.col("target").alias("node")))
    walked = walks(trips, checkpointed(pieces(seg, cuts)))
    out = both.join(walked, "id", "left")
    part = lambda limit, m: F.when(m >= 1.0, F.array(_limit(limit))).otherwise(F.array().cast("array<string>"))
    straight = part(F.col("own"), geo.distance_m(F.col("aa_p_lat"), F.col("aa_p_lon"), F.col("bb_p_lat"), F.col("bb_p_lon")))
    limits = F.when(F.col("same"), straight).when(F.col("limits").isNotNull(), F.array_distinct(F.concat(part(F.col("own"), F.col("first_m")), "limits", part(F.col("last"), F.col("last_m")))))
    others = F.array_sort(F.array_except(limits, F.array(_limit(F.col("maxspeed")))))
    why = F.when(F.col("status") == "corroborated", F.when(limits.isNull(), "no walk").when(F.size(others) > 0, F.array_join(others, "/"))).when(F.coalesce(F.col("status"), F.lit("")) != "confirmed", "unconfirmed").when(F.col("own") != F.col("maxspeed"), "conflict")
    out = out.withColumn("why", why)
    return out.select("id", F.round("aa_p_lat", 7).alias("lat"), F.round("aa_p_lon", 7).alias("lon"), F.round("bb_p_lat", 7).alias("end_lat"), F.round("bb_p_lon", 7).alias("end_lon"), (F.bround("aa_heading").cast("int") % 360).alias("heading"), F.when(F.col("why").isNull(), F.col("maxspeed")).alias("maxspeed"), F.when(F.col("why").isNull(), "section").alias("src"), F.coalesce((F.col("za") == "band") | (F.col("zb") == "band"), F.lit(False)).alias("band"), "why")
