"""Surgery on lines: runs of flags, pieces of ways, members of relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import tags as T
from ..functions.geo import let
from ..runtime import checkpointed


def good_runs(flags: Column) -> Column:
    """Runs of true segment flags as array<struct<first,last>> of nodes: segment i joins nodes i and i + 1."""
    at = lambda f, keep: F.filter(F.transform(f, lambda x, i: F.when(keep(f, x, i), i)), lambda i: i.isNotNull())
    firsts = lambda f: at(f, lambda g, x, i: x & ~F.coalesce(F.get(g, i - 1), F.lit(False)))
    lasts = lambda f: at(f, lambda g, x, i: x & ~F.coalesce(F.get(g, i + 1), F.lit(False)))
    return let(flags, lambda f: F.zip_with(firsts(f), lasts(f), lambda a, b: F.struct(a.alias("first"), (b + 1).alias("last"))))


def split_by_flags(first: Column, flags: Column) -> Column:
    """A run cut where its segments' flag changes, as array<struct<first,last,flag>>; neighbours share a node."""
    starts = lambda f: F.filter(F.transform(f, lambda x, i: F.when((i == 0) | (x != F.get(f, i - 1)), i)), lambda i: i.isNotNull())
    piece = lambda f, s: F.transform(s, lambda i, k: F.struct((first + i).alias("first"), (first + F.coalesce(F.get(s, k + 1), F.size(f))).alias("last"), F.get(f, i).alias("flag")))
    return let(flags, lambda f: let(starts(f), lambda s: piece(f, s)))


def judged(ways: DataFrame, rings: dict[str, geo.Rings], band_classes: tuple[str, ...] = ()) -> DataFrame:
    """Ways (way, line, tags) with what `cut_ways` asks for, and `destination`.

    A node may stay if it has a place, lies in the country and not in the hard zone. A segment may stay if both
    of its nodes may, it doesn't touch the hard zone and doesn't leave the country: a straight line can cut a
    corner of a zone though its ends are clear of it. The band holds a segment that touches it, of a road of
    band_classes that is open to all cars. Of a way for four wheel drive only cars may enter for a destination.
    """
    xy = lambda p: p["x"].isNotNull() & p["y"].isNotNull() & ~F.isnan(p["x"]) & ~F.isnan(p["y"])
    node = lambda sides: F.transform("line", lambda p: F.coalesce(xy(p) & geo.within_sides(sides, p["x"], p["y"]), F.lit(False)))
    inside = lambda zone: geo.with_edges(rings[zone], node)
    n = F.greatest(F.size("line") - 1, F.lit(0))
    pairs = lambda c, f: F.zip_with(F.slice(c, 1, n), F.slice(c, 2, n), f)
    w = ways.withColumn("country", inside("country")).withColumn("hard", inside("hard"))
    w = w.withColumn("ok", F.zip_with("country", "hard", lambda a, b: a & ~b)).withColumn("fine", pairs("ok", lambda a, b: a & b))
    # only segments whose ends are fine are asked further; with ends inside, one that meets no edge of the country stays in it
    whole = lambda c, h, e: (~geo.meets(c, e["a"], e["b"]) | geo.segment_within(rings["country"], e["a"], e["b"])) & ~geo.meets(h, e["a"], e["b"])
    tested = lambda c, h: F.zip_with("fine", geo.edges(F.col("line")), lambda fine, e: F.when(fine, whole(c, h, e)).otherwise(False))
    w = w.withColumn("segment_ok", geo.with_edges(rings["country"], lambda c: geo.with_edges(rings["hard"], lambda h: tested(c, h))))
    highway, route = T.tag(F.col("tags"), "highway"), T.tag(F.col("tags"), "route")
    access = T.car_access(F.col("tags"))
    w = w.withColumn("is_road", T.road_like(F.col("tags"))).withColumn("is_ferry", F.coalesce(route.isin(*T.FERRIES), F.lit(False))).withColumn("n_nodes", F.size("line"))
    w = w.withColumn("four", F.coalesce((T.tag(F.col("tags"), "4wd_only") == "yes") & (access == "yes"), F.lit(False)))
    banded = F.coalesce(highway.isin(*band_classes), F.lit(False)) & (access == "yes") & ~F.col("four")
    touches = lambda b, ends: F.zip_with(ends, geo.edges(F.col("line")), lambda held, e: held | F.coalesce(xy(e["a"]) & xy(e["b"]) & geo.meets(b, e["a"], e["b"]), F.lit(False)))
    ends = let(inside("band"), lambda flags: pairs(flags, lambda a, b: a | b))
    w = w.withColumn("band", F.when(banded, geo.with_edges(rings["band"], lambda b: touches(b, ends))).otherwise(F.array().cast("array<boolean>")))
    return w.withColumn("any_hard", F.exists("hard", lambda x: x)).withColumn("any_outside", F.exists("country", lambda x: ~x))


def cut_ways(ways: DataFrame, fresh_from: int, mode: str = "cut") -> DataFrame:
    """Ways with segment_ok and band flags -> pieces: way, piece, id, first, last, band, reason.

    ways: way, is_road, is_ferry, n_nodes, segment_ok (array<boolean>), band (array<boolean>), any_hard,
    any_outside. Ways that are no roads, or have fewer than two nodes, stay whole; a ferry or any way in
    mode drop goes if not all is well; of the others each good run, cut where the band changes, is a
    piece. Piece 0 keeps the id; later ones get fresh ids in the order of ways, by range offsets and
    without one partition for all. Ways that vanish have no piece and a reason.
    """
    whole = (~F.col("is_road")) | (F.col("n_nodes") < 2) | F.forall("segment_ok", lambda x: x)
    all_of = F.array(F.struct(F.lit(0).alias("first"), F.greatest(F.col("n_nodes") - 1, F.lit(0)).alias("last")))
    nothing = F.array().cast("array<struct<first:int,last:int>>")
    runs = F.when(whole, all_of).when(F.col("is_ferry") | F.lit(mode == "drop"), nothing).otherwise(good_runs(F.col("segment_ok")))
    banded = lambda r: split_by_flags(r["first"], F.slice(F.col("band"), r["first"] + 1, r["last"] - r["first"]))
    plain = lambda r: F.array(F.struct(r["first"].alias("first"), r["last"].alias("last"), F.lit(False).alias("flag")))
    pieces = F.flatten(F.transform(runs, lambda r: F.when((r["last"] > r["first"]) & F.col("is_road") & (F.size("band") > 0), banded(r)).otherwise(plain(r))))
    reason = F.when(F.size("runs") > 0, F.lit(None)).when(F.col("any_hard"), "no_go").when(F.col("any_outside"), "outside").otherwise("no_go")
    # written down once, as fresh ids go through it several times
    cut = checkpointed(ways.withColumn("runs", pieces).select("way", "runs", "any_hard", "any_outside").withColumn("reason", reason).select("way", "runs", "reason"))
    ids = fresh_ids(cut.select("way", F.greatest(F.size("runs") - 1, F.lit(0)).alias("extra")), "way", "extra", fresh_from)
    rows = cut.join(ids, "way").select("way", "reason", "fresh", F.posexplode_outer("runs").alias("piece", "r"))
    return rows.select("way", "piece", F.when(F.col("piece") == 0, F.col("way")).when(F.col("piece") > 0, F.col("fresh") + F.col("piece") - 1).alias("id"), F.col("r.first").alias("first"), F.col("r.last").alias("last"), F.col("r.flag").alias("band"), "reason")


def fresh_ids(rows: DataFrame, key: str, need: str, start: int, range_rows: int = 250_000, most_ranges: int = 4096) -> DataFrame:
    """key and fresh, the first of the ids that a row gets: running sums in the order of the key.

    The rows are dealt to ranges of the key by quantiles, as many as there are rows for; sums within a range,
    and of the ranges before it (one row each), add up, so nothing is sorted in one task.
    """
    parts = max(1, min(most_ranges, -(-rows.count() // range_rows)))
    cuts = (rows.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)], 20_000)).first()[0] or []) if parts > 1 else []
    bounds = F.split(F.lit(",".join(map(str, sorted(set(cuts))))), ",").cast("array<long>") if cuts else F.array().cast("array<long>")
    dealt = rows.withColumn("_range", F.size(F.filter(bounds, lambda b: b < F.col(key))))
    totals = dealt.groupBy("_range").agg(F.sum(need).alias("n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn("own", F.coalesce(F.sum(need).over(within), F.lit(0))).join(F.broadcast(base), "_range").select(key, (F.lit(start) + F.col("base") + F.col("own")).cast("long").alias("fresh"))


def rewrite_members(members: DataFrame, removed: DataFrame, pieces: DataFrame) -> DataFrame:
    """Relations after ways were cut: relation, kind, and members as array<struct<type,ref,role>> in order.

    members: relation, kind ('restriction' or other), pos, type, ref, role; removed: way; pieces: way,
    piece, id, nodes. Removed ways vanish, cut ones stand as all their pieces; a relation left empty
    goes. A restriction goes if a member is removed; if one is cut it must have one via, a node, and
    each cut member becomes the one piece that holds it.
    """
    cut = pieces.groupBy("way").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("way", F.lit(True).alias("is_cut"))
    via = members.where("role = 'via'").groupBy("relation").agg(F.count(F.lit(1)).alias("vias"), F.min(F.when(F.col("type") == "n", F.col("ref"))).alias("via"))
    m = members.join(removed.select(F.col("way").alias("ref"), F.lit("w").alias("type"), F.lit(True).alias("gone")), ["type", "ref"], "left")
    m = m.join(cut.select(F.col("way").alias("ref"), F.lit("w").alias("type"), "is_cut"), ["type", "ref"], "left").join(via, "relation", "left")
    parts = pieces.join(cut, "way", "left_semi").select(F.col("way").alias("ref"), F.lit("w").alias("type"), "piece", F.col("id").alias("new_ref"), "nodes")
    m = m.join(parts, ["type", "ref"], "left")
    holds = F.coalesce(F.array_contains("nodes", F.col("via")), F.lit(False)) & (F.coalesce("vias", F.lit(0)) == 1)
    restriction = F.col("kind") == "restriction"
    split = F.col("is_cut").isNotNull()
    keep = F.col("gone").isNull() & (~restriction | ~split | holds)
    per = m.withColumn("keep", keep).groupBy("relation", "kind", "pos").agg(
        F.sum(F.col("keep").cast("int")).alias("kept"), F.max(F.col("gone").isNotNull()).alias("gone"), F.max(split).alias("split"),
        F.sort_array(F.collect_list(F.when(F.col("keep"), F.struct(F.coalesce("piece", F.lit(0)).alias("piece"), F.col("type"), F.coalesce("new_ref", "ref").alias("ref"), F.col("role"))))).alias("parts"),
    )
    bad = restriction & (F.col("gone") | (F.col("split") & (F.col("kept") != 1)))
    whole = per.groupBy("relation", "kind").agg(F.max(bad).alias("bad"), F.sort_array(F.collect_list(F.struct("pos", "parts"))).alias("all"))
    made = F.flatten(F.transform("all", lambda x: F.transform(x["parts"], lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), p["role"].alias("role")))))
    return whole.where(~F.col("bad")).select("relation", "kind", made.alias("members")).where(F.size("members") > 0)
