"""Builds the search tables from map objects: places, streets, addresses, points of interest, cameras, hazards.

Objects come as (osm, lat, lon, tags); every builder is a chain of joins and aggregates, and what a
one-pass builder would decide by the order of its input is decided here by ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BuildConfig
from ..functions import fold, geo
from ..functions import tags as T
from . import graph, rank, roads, spatial

LEGAL = "coalesce(zone, '') not in ('outside', 'buffer')"
NAME_TAGS = ("name", "name:ka", "name:en", "name:ru")
ALT_TAGS = ("alt_name", "old_name", "short_name", "official_name", "loc_name")


def names(tags: Column) -> dict[str, Column]:
    """name, name_ka, name_en, name_ru and alt_names (joined by |, none of them twice or a main one)."""
    main = {k.replace(":", "_"): T.tag(tags, k) for k in NAME_TAGS}
    alts = F.array_distinct(F.flatten(F.array(*[T.values(T.tag(tags, k)) for k in ALT_TAGS])))
    mains = F.array_compact(F.array(*main.values()))
    return main | {"alt_names": F.array_join(F.array_except(alts, mains), "|")}


def labels(occupied: Column) -> dict[str, Column]:
    """label_ka and label_en: on occupied land only Georgian names count, romanised for Latin; else each language's own, or what there is."""
    georgian = F.coalesce(F.col("name_ka"), F.when(fold.has_georgian(F.col("name")), F.col("name")))
    ka = F.when(occupied, georgian).otherwise(F.coalesce(georgian, F.col("name")))
    latin = F.when(F.col("name").rlike(r"^[\p{IsLatin}\P{L}]+$"), F.col("name"))
    en = F.when(occupied, fold.romanise(georgian)).otherwise(F.coalesce(F.col("name_en"), fold.romanise(georgian), latin, F.col("name")))
    return {"label_ka": ka, "label_en": en}


def zoned(rows: DataFrame, rings: dict[str, geo.Rings]) -> DataFrame:
    return rows.withColumn("zone", spatial.zone(rings, F.col("lat"), F.col("lon")))


def dropped(rows: DataFrame) -> DataFrame:
    """How many rows each zone costs."""
    return rows.where(f"not ({LEGAL})").groupBy("zone").agg(F.count(F.lit(1)).alias("n"))


def places(objects: DataFrame, rings: dict[str, geo.Rings], cfg: BuildConfig = BuildConfig()) -> DataFrame:
    """Settlements and districts with zones, labels, importance and the parent that they lie in reach of."""
    kinds = F.create_map(*[x for k, (base, _) in cfg.place_kinds.items() for x in (F.lit(k), F.lit(base))])
    reach = F.create_map(*[x for k, (_, km) in cfg.place_kinds.items() for x in (F.lit(k), F.lit(km * 1000))])
    rows = zoned(objects.withColumn("kind", T.tag(F.col("tags"), "place")).where(F.col("kind").isin(*cfg.place_kinds)), rings).where(LEGAL)
    rows = rows.select("osm", "kind", "lat", "lon", "zone", *[c.alias(k) for k, c in names(F.col("tags")).items()], T.tag(F.col("tags"), "population").try_cast("long").alias("population"), (F.coalesce(T.tag(F.col("tags"), "capital"), F.lit("")) == "yes").alias("capital"), T.tag(F.col("tags"), "wikidata").isNotNull().alias("known"))
    rows = rows.where(F.coalesce("name", "name_ka", "name_en").isNotNull()).withColumn("occupied", (F.coalesce("zone", F.lit("")) == "occupied").cast("int"))
    own = F.try_element_at(kinds, F.col("kind")) + cfg.population_weight * rank.log_share(F.coalesce("population", F.lit(0)), cfg.population_full) + F.when(F.col("capital"), cfg.capital_bonus).otherwise(0.0) + F.when(F.col("known"), cfg.wikidata_bonus).otherwise(0.0)
    rows = graph.kept(rows.withColumn("own", own))
    towns = rows.where(~F.col("kind").isin(*cfg.districts)).select(F.col("osm").alias("parent_osm"), F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"), F.col("own").alias("parent_own"), F.col("occupied"), F.try_element_at(reach, F.col("kind")).alias("reach"))
    # an occupied place may only belong to an occupied one, a legal one only to a legal one
    near = spatial.nearest(rows.where(F.col("kind").isin(*cfg.districts)).select("osm", "lat", "lon", "occupied"), towns, "osm", "parent_osm", F.col("reach"), max(km for _, km in cfg.place_kinds.values()) * 1000, ("occupied",))
    rows = rows.join(near.select("osm", "parent_osm"), "osm", "left").join(towns.select("parent_osm", "parent_own"), "parent_osm", "left")
    rows = rows.withColumn("importance", F.round(T.clamp01(F.col("own") + cfg.parent_weight * F.coalesce("parent_own", F.lit(0.0))), 4))
    return rows.select("osm", "kind", "lat", "lon", "name", "name_ka", "name_en", "name_ru", "alt_names", "population", "importance", "parent_osm", "occupied", "zone", *[c.alias(k) for k, c in labels(F.col("occupied") == 1).items()])


def centres(places_: DataFrame, cfg: BuildConfig = BuildConfig()) -> DataFrame:
    """Settlements as centres with a reach, for what must be told its city; occupied ones and districts serve nobody."""
    reach = F.create_map(*[x for k, (_, km) in cfg.place_kinds.items() for x in (F.lit(k), F.lit(km * 1000))])
    rows = places_.where((F.col("occupied") == 0) & ~F.col("kind").isin(*cfg.districts))
    return rows.select(F.col("osm").alias("city"), F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"), F.try_element_at(reach, F.col("kind")).alias("reach"), F.col("importance").alias("city_importance"), fold.name_key(F.coalesce("name", "name_ka", "name_en")).alias("name_key"))


def city_of(rows: DataFrame, centres_: DataFrame, key: str) -> DataFrame:
    """rows with city: the nearest of the name in addr_city within 30 km if there is one, else the centre nearest by its reach."""
    named = rows.where(F.col("addr_city").isNotNull()).select(key, "lat", "lon", fold.name_key(F.col("addr_city")).alias("name_key"))
    by_name = spatial.nearest(named, centres_, key, "city", None, 30_000.0, ("name_key",)).select(key, F.col("city").alias("_named"))
    near = spatial.nearest(rows.select(key, "lat", "lon"), centres_, key, "city", F.col("reach"), 15_000.0).select(key, F.col("city").alias("_near"))
    out = rows.join(by_name, key, "left").join(near, key, "left").withColumn("city", F.coalesce("_named", "_near")).drop("_named", "_near")
    return out.join(centres_.select("city", "city_importance"), "city", "left")


def streets(ways: DataFrame, rings: dict[str, geo.Rings], centres_: DataFrame, cfg: BuildConfig = BuildConfig()) -> DataFrame:
    """Named ways of one name that lie close together are a street; streets of one name and city whose boxes almost meet are one.

    ways: way, line, tags. -> street (its least way), name, key, kind, lat, lon, box, length_m, city, importance, band.
    """
    classes = F.create_map(*[x for k, v in cfg.street_classes.items() for x in (F.lit(k), F.lit(v))])
    w = ways.withColumn("class", T.tag(F.col("tags"), "highway")).withColumn("name", T.tag(F.col("tags"), "name")).where(F.col("name").isNotNull() & F.col("class").isin(*cfg.street_classes) & (F.size("line") > 1))
    w = w.select("way", "class", "name", fold.name_key(F.col("name")).alias("key"), "line", geo.bounds(F.col("line")).alias("b"), geo.line_length_m(F.col("line")).alias("m")).where("key != ''")
    w = graph.kept(w)
    # ways of a name are chained through their corners
    corners = w.select("way", "key", F.explode("line").alias("p")).select("way", "key", F.col("p.y").alias("lat"), F.col("p.x").alias("lon")).withColumn("corner", F.monotonically_increasing_id())
    corners = graph.kept(corners)
    chains = graph.linked_clusters(corners, "corner", cfg.street_cluster_m, ("key",)).join(corners, "corner")
    roots = graph.components(chains.groupBy("cluster", "key").agg(F.min("way").alias("first")).join(chains, ["cluster", "key"]).select(F.col("way").alias("a"), F.col("first").alias("b")))
    w = w.join(roots.select(F.col("node").alias("way"), "root"), "way")
    middle = w.groupBy("root", "key").agg(F.min("b.min_x").alias("min_lon"), F.min("b.min_y").alias("min_lat"), F.max("b.max_x").alias("max_lon"), F.max("b.max_y").alias("max_lat"))
    middle = middle.withColumn("lat", (F.col("min_lat") + F.col("max_lat")) / 2).withColumn("lon", (F.col("min_lon") + F.col("max_lon")) / 2).withColumn("addr_city", F.lit(None).cast("string"))
    placed = graph.kept(city_of(middle, centres_, "root"))
    near = spatial.near_boxes(placed.where("city is not null"), "root", cfg.street_merge_m, ("key", "city"))
    merged = graph.components(near.select("a", "b")).select(F.col("node").alias("root"), F.col("root").alias("street"))
    w = w.join(merged, "root", "left").withColumn("street", F.coalesce("street", "root")).join(placed.select("root", "city", "city_importance"), "root")
    points = w.select("street", "way", F.posexplode("line").alias("pos", "p")).select("street", "way", "pos", F.col("p.y").alias("lat"), F.col("p.x").alias("lon"))
    mean = points.groupBy("street").agg(F.avg("lat").alias("a"), F.avg("lon").alias("o"))
    off = F.pow(F.col("lat") - F.col("a"), 2) + F.pow((F.col("lon") - F.col("o")) * F.cos(F.radians("a")), 2)
    spot = points.join(mean, "street").groupBy("street").agg(F.min(F.struct(off.alias("d"), F.col("way"), F.col("pos"), F.col("lat"), F.col("lon"))).alias("s"))
    vote = rank.weighted_vote(w, ["street"], "name", "m", "way")
    whole = w.groupBy("street").agg(
        F.max_by("class", F.struct(F.try_element_at(classes, F.col("class")), -F.col("way"))).alias("kind"), F.sum("m").alias("m"), F.min("b.min_x").alias("min_lon"), F.min("b.min_y").alias("min_lat"), F.max("b.max_x").alias("max_lon"), F.max("b.max_y").alias("max_lat"),
        F.min("key").alias("key"), F.min("city").alias("city"), F.max("city_importance").alias("city_importance"), F.coalesce(F.min(F.when(F.col("way") < 4_000_000_000, F.col("way"))), F.min("way")).alias("way"),
    )
    cw, lw, tw = cfg.street_weights
    score = cw * F.coalesce(F.try_element_at(classes, F.col("kind")), F.lit(0.3)) + lw * T.clamp01(F.log10(F.greatest("m", F.lit(1.0))) / F.log10(F.lit(cfg.length_full_m))) + tw * F.coalesce("city_importance", F.lit(0.0))
    out = whole.join(vote, "street").join(spot, "street").withColumn("lat", F.col("s.lat")).withColumn("lon", F.col("s.lon"))
    out = zoned(out, rings).where(LEGAL)
    return out.select("street", F.concat(F.lit("w"), F.col("way")).alias("osm"), "kind", "lat", "lon", "min_lat", "min_lon", "max_lat", "max_lon", "name", "key", "city", F.round("m", 0).cast("int").alias("length_m"), F.round(T.clamp01(score), 4).alias("importance"), (F.coalesce("zone", F.lit("")) == "band").cast("int").alias("band"))


def addresses(objects: DataFrame, rings: dict[str, geo.Rings], streets_: DataFrame, centres_: DataFrame, cfg: BuildConfig = BuildConfig()) -> DataFrame:
    """House numbers on streets: of the very name, else of all its words, nearest box within reach; else on a street of their own."""
    t = F.col("tags")
    a = zoned(objects.where(T.tag(t, "addr:housenumber").isNotNull()), rings).where(LEGAL)
    a = a.select("osm", "lat", "lon", "zone", T.tag(t, "addr:housenumber").alias("housenumber"), T.tag(t, "addr:street").alias("street_name"), T.tag(t, "addr:place").alias("place"), T.tag(t, "addr:city").alias("addr_city"), T.tag(t, "building").isNotNull().alias("building"))
    a = city_of(a, centres_, "osm").withColumn("key", fold.name_key(F.col("street_name"))).withColumn("words", F.filter(fold.keys(F.col("street_name")), lambda k: ~fold.is_type_key(k)))
    a = graph.kept(a)
    s = streets_.select("street", F.col("key").alias("s_key"), F.split("key", " ").alias("s_words"), "min_lat", "min_lon", "max_lat", "max_lon", F.col("importance").alias("street_importance"))
    metres = geo.box_distance_m(F.col("lat"), F.col("lon"), F.col("min_lat"), F.col("min_lon"), F.col("max_lat"), F.col("max_lon"))
    # both tiers meet through the address's rarest word among streets and cells as wide as the reach, kept if all of its words are there
    index = s.withColumn("w", F.explode(F.array_distinct("s_words")))
    rare = a.select("osm", F.explode(F.array_distinct("words")).alias("w")).join(index.groupBy("w").agg(F.count(F.lit(1)).alias("n")), "w", "left")
    rare = rare.groupBy("osm").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("w"))).alias("b")).select("osm", F.col("b.w").alias("w"))
    grow = 2 * cfg.address_link_m / geo.DEGREE_M
    wide = s.agg(F.avg(F.greatest(F.col("max_lat") - F.col("min_lat"), F.col("max_lon") - F.col("min_lon")))).first()[0] or 0.0
    size = max(grow, wide)
    grown = lambda lo, hi: F.explode(F.sequence(spatial.cell(F.col(lo) - grow, size), spatial.cell(F.col(hi) + grow, size)))
    index = index.withColumn("_cy", grown("min_lat", "max_lat")).withColumn("_cx", grown("min_lon", "max_lon"))
    here = a.join(rare, "osm").withColumn("_cy", spatial.cell(F.col("lat"), size)).withColumn("_cx", spatial.cell(F.col("lon"), size))
    pairs = here.join(index, ["w", "_cy", "_cx"]).withColumn("metres", metres)
    pairs = pairs.where((F.col("metres") <= cfg.address_link_m) & ((F.col("key") == F.col("s_key")) | (F.size(F.array_except("words", "s_words")) == 0)))
    tier = F.when(F.col("key") == F.col("s_key"), 0).otherwise(1)
    linked = pairs.groupBy("osm").agg(F.min(F.struct(tier.alias("tier"), F.col("metres"), F.col("street"), F.col("street_importance"))).alias("b")).select("osm", F.col("b.street").alias("street"), F.col("b.street_importance").alias("street_importance"))
    a = graph.kept(a.join(linked, "osm", "left"))
    # what found none is gathered to streets of its own, by name and city and nearness
    own = graph.linked_clusters(a.where("street is null and key != ''").select("osm", "lat", "lon", "key", F.coalesce("city", F.lit("")).alias("c")), "osm", cfg.street_merge_m, ("key", "c")).select("osm", F.col("cluster").alias("virtual"))
    a = a.join(graph.kept(own), "osm", "left").withColumn("on", F.coalesce(F.col("street").cast("string"), F.concat(F.lit("v:"), "virtual"), F.concat_ws("|", F.lit("p:"), "place", "city")))
    a = graph.kept(a.withColumn("number_key", fold.name_key(F.col("housenumber"))))
    same = graph.linked_clusters(a.select("osm", "lat", "lon", "on", "number_key"), "osm", cfg.address_dedup_m, ("on", "number_key"))
    a = graph.kept(a.join(same, "osm"))
    best = a.groupBy("on", "number_key", "cluster").agg(F.min_by("osm", F.struct(~F.col("building"), F.col("osm"))).alias("osm"))
    base, cw, sw, bw = cfg.address_weights
    score = base + cw * F.coalesce("city_importance", F.lit(0.0)) + sw * F.coalesce("street_importance", F.lit(0.0)) + F.when(F.col("building"), bw).otherwise(0.0)
    return a.join(best.select("osm"), "osm", "left_semi").select("osm", "lat", "lon", "housenumber", "street", F.col("virtual").alias("virtual_street"), "place", "city", F.round(T.clamp01(score), 4).alias("importance"), (F.coalesce("zone", F.lit("")) == "band").cast("int").alias("band"))


def pois(objects: DataFrame, rings: dict[str, geo.Rings], centres_: DataFrame, cfg: BuildConfig = BuildConfig()) -> DataFrame:
    """Points of interest by the first rule that matches; copies near each other are one, the one with most tags."""
    t = F.col("tags")
    named = F.coalesce(*[T.tag(t, k) for k in NAME_TAGS]).isNotNull()
    p = objects.withColumn("kind", T.first_rule(t, list(cfg.poi_rules), named | T.tag(t, "brand").isNotNull())).where("kind is not null")
    p = zoned(p, rings).where(LEGAL).select("osm", "lat", "lon", "zone", "kind", "tags", *[c.alias(k) for k, c in names(t).items()], T.tag(t, "brand").alias("brand"), T.tag(t, "addr:city").alias("addr_city"), T.tag(t, "wikidata").isNotNull().alias("known"))
    close = geo.ring_distance_m(rings["hard"], F.col("lat"), F.col("lon")) <= cfg.line_checkpoint_m
    border = F.col("kind") == "border_control"
    p = p.where(~(border & close & F.col("name").isNull())).withColumn("kind", F.when(border & close, "line_checkpoint").otherwise(F.col("kind")))
    p = p.withColumn("label", F.coalesce(fold.name_key(F.coalesce("name", "name_ka", "name_en", "brand")), F.lit("")))
    p = graph.kept(p)
    same = graph.linked_clusters(p.select("osm", "lat", "lon", "kind", "label"), "osm", cfg.poi_dedup_m, ("kind", "label"))
    best = p.join(same, "osm").groupBy("kind", "label", "cluster").agg(F.max_by("osm", F.struct(F.size("tags"), F.col("osm"))).alias("osm"))
    p = city_of(p.join(best.select("osm"), "osm", "left_semi"), centres_, "osm")
    prior = F.create_map(*[x for r in (*cfg.poi_rules, {"kind": "line_checkpoint", "prior": 0.6}) for x in (F.lit(r["kind"]), F.lit(r["prior"]))])
    group = F.create_map(*[x for r in (*cfg.poi_rules, {"kind": "line_checkpoint", "group": "travel"}) for x in (F.lit(r["kind"]), F.lit(r["group"]))])
    n, b, k = cfg.poi_bonuses
    score = F.try_element_at(prior, F.col("kind")) + F.when(F.col("name").isNotNull(), n).otherwise(0.0) + F.when(F.col("brand").isNotNull(), b).otherwise(0.0) + F.when(F.col("known"), k).otherwise(0.0)
    attrs = F.array_join(F.array_compact(F.array(*[F.when(T.tag(t, a) == "yes", F.lit(a)) for a in ("toilets", "wheelchair", "internet_access")])), ";")
    return p.select("osm", "kind", F.try_element_at(group, F.col("kind")).alias("grp"), "lat", "lon", "name", "name_ka", "name_en", "name_ru", "alt_names", "brand", attrs.alias("attrs"), "city", F.round(T.clamp01(score), 4).alias("importance"), (F.coalesce("zone", F.lit("")) == "band").cast("int").alias("band"), *[c.alias(x) for x, c in labels(F.lit(False)).items()])


def cameras(nodes: DataFrame, ways: DataFrame, relations: DataFrame, rings: dict[str, geo.Rings], cfg: BuildConfig = BuildConfig()) -> DataFrame:
    """Speed cameras with heading and limit: on a road by its node, else beside the nearest one; copies are one.

    nodes: osm, id, lat, lon, tags; ways: way, refs, line, tags, class_rank; relations: osm, kind, maxspeed,
    device (a node id) — an enforcement relation's own facts go before the device's.
    """
    t = F.col("tags")
    n = nodes.where(F.coalesce(T.tag(t, "highway"), F.lit("")) == "speed_camera").select("osm", "id", "lat", "lon", T.tag(t, "direction").alias("direction"), T.maxspeed(T.tag(t, "maxspeed")).alias("own"), F.when(F.coalesce(T.tag(t, "enforcement"), F.lit("")).contains("traffic_signals"), "red_light").when(F.coalesce(T.tag(t, "enforcement"), F.lit("")).contains("average_speed"), "average_speed").otherwise("fixed").alias("kind"))
    n = zoned(n, rings).where(LEGAL)
    rel = relations.groupBy(F.col("device").alias("id")).agg(F.min("maxspeed").alias("relation_speed"), F.min(F.when(F.col("kind") != "fixed", F.col("kind"))).alias("relation_kind"))
    on = ways.select("way", "class_rank", F.posexplode("refs").alias("pos", "id"), "line").join(n.select("id"), "id", "left_semi")
    here = geo.bearing(F.get("line", F.col("pos") - 1)["y"], F.get("line", F.col("pos") - 1)["x"], F.get("line", F.col("pos"))["y"], F.get("line", F.col("pos"))["x"])
    ahead = geo.bearing(F.get("line", F.col("pos"))["y"], F.get("line", F.col("pos"))["x"], F.get("line", F.col("pos") + 1)["y"], F.get("line", F.col("pos") + 1)["x"])
    by_node = on.withColumn("bearing", F.coalesce(ahead, here)).groupBy("id").agg(F.min(F.struct("class_rank", "way", "bearing")).alias("b")).select("id", F.col("b.way").alias("node_way"), F.col("b.bearing").alias("node_bearing"))
    near = roads.nearest(n.select("osm", "lat", "lon"), ways.select("way", "line", "class_rank"), "osm", cfg.camera_road_m)
    by_near = near.select("osm", F.col("way").alias("near_way"), F.col("bearing").alias("near_bearing"), F.col("metres").alias("near_m"))
    c = n.join(rel, "id", "left").join(by_node, "id", "left").join(by_near, "osm", "left")
    c = c.withColumn("way", F.coalesce("node_way", "near_way")).withColumn("road_bearing", F.coalesce("node_bearing", "near_bearing"))
    facts = ways.select("way", T.oneway(t).alias("sign"), T.maxspeed(T.tag(t, "maxspeed")).alias("road_speed"), T.tag(t, "ref").alias("road_ref"), T.tag(t, "name").alias("road_name"), T.tag(t, "highway").alias("road_class"))
    c = c.join(facts, "way", "left").withColumn("d", T.direction(F.col("direction")))
    oneway = F.when(F.col("sign") == 1, F.col("road_bearing")).when(F.col("sign") == -1, F.pmod(F.col("road_bearing") + 180, F.lit(360.0)))
    facing = F.pmod(F.col("d.value") + 180, F.lit(360.0))
    tagged = F.when(F.col("d.kind") == "along", F.pmod(F.col("road_bearing") + F.when(F.col("d.value") < 0, 180).otherwise(0), F.lit(360.0))).when((F.col("d.kind") == "degrees") & (F.coalesce(geo.angle_diff(facing, geo.onto_line(facing, F.col("road_bearing"))), F.lit(0.0)) <= 45), facing)
    c = c.withColumn("heading", F.bround(F.coalesce(oneway, tagged), 0).cast("int")).withColumn("heading_src", F.when(oneway.isNotNull(), "oneway").when(tagged.isNotNull(), "tag"))
    c = c.withColumn("maxspeed", F.coalesce("relation_speed", "own", "road_speed")).withColumn("maxspeed_src", F.when(F.col("relation_speed").isNotNull(), "relation").when(F.col("own").isNotNull(), "camera").when(F.col("road_speed").isNotNull(), "road"))
    c = c.withColumn("kind", F.coalesce("relation_kind", "kind"))
    order = F.struct(F.col("maxspeed").isNull(), F.col("osm"))
    c = graph.kept(c).withColumn("priority", order)
    stay = graph.greedy_dedup(c.select("osm", "kind", "lat", "lon", F.col("heading").cast("double").alias("heading"), "priority"), "osm", cfg.camera_dedup_m, cfg.turn_deg)
    return c.join(stay, "osm", "left_semi").select("osm", "kind", "lat", "lon", "maxspeed", "maxspeed_src", "heading", "heading_src", F.bround("road_bearing", 0).cast("int").alias("road_bearing"), F.round(F.when(F.col("node_way").isNull(), F.col("near_m")).otherwise(0.0), 1).alias("road_dist_m"), "road_class", "road_ref", "road_name", (F.coalesce("zone", F.lit("")) == "band").cast("int").alias("band"))


def hazards(nodes: DataFrame, ways: DataFrame, rings: dict[str, geo.Rings], rails: DataFrame, cfg: BuildConfig = BuildConfig()) -> DataFrame:
    """Bumps and level crossings that lie on a road for cars, a crossing only where a live railway passes too. rails: node."""
    t = F.col("tags")
    kinds = F.create_map(*[x for k, v in cfg.hazard_kinds.items() for x in (F.lit(k), F.lit(v))])
    h = nodes.withColumn("kind", F.try_element_at(kinds, F.coalesce(T.tag(t, "traffic_calming"), T.tag(t, "railway")))).where("kind is not null").select("osm", "id", "lat", "lon", "kind")
    h = zoned(h, rings).where(LEGAL)
    on = ways.where(T.car_access(t) != "no").select("way", "class_rank", T.tag(t, "highway").alias("road_class"), F.posexplode("refs").alias("pos", "id"), "line")
    ahead = lambda i, j: geo.bearing(F.get("line", i)["y"], F.get("line", i)["x"], F.get("line", j)["y"], F.get("line", j)["x"])
    turn = F.coalesce(ahead(F.col("pos"), F.col("pos") + 1), ahead(F.col("pos") - 1, F.col("pos")))
    best = on.join(h.select("id"), "id", "left_semi").groupBy("id").agg(F.min(F.struct(F.col("class_rank"), F.col("way"), F.col("road_class"), turn.alias("bearing"))).alias("b"))
    live = h.where("kind != 'rail'").unionByName(h.where("kind = 'rail'").join(rails.select(F.col("node").alias("id")), "id", "left_semi"))
    return live.join(best, "id").select("osm", "kind", "lat", "lon", F.bround("b.bearing", 0).cast("int").alias("road_bearing"), F.col("b.road_class").alias("road_class"), (F.coalesce("zone", F.lit("")) == "band").cast("int").alias("band"))


def final_ids(rows: DataFrame) -> DataFrame:
    """Rows with id: dense, by falling importance, then by their object."""
    return rank.row_ids(rows, [F.col("importance").desc(), F.coalesce("osm", F.lit("")).asc()], "id")


def search_names(brand_words: dict[str, list[str]] | None = None) -> Column:
    """All names of a row that it is found by, brand synonyms too."""
    words = F.create_map(*[x for k, v in (brand_words or {"-": []}).items() for x in (F.lit(k), F.array(*map(F.lit, v)) if v else F.array().cast("array<string>"))])
    own = [F.col(c) for c in ("name", "name_ka", "name_en", "name_ru")]
    return F.array_distinct(F.filter(F.concat(F.array_compact(F.array(*own)), F.split(F.coalesce("alt_names", F.lit("")), r"\|"), F.coalesce(F.try_element_at(words, F.col("brand")), F.array().cast("array<string>")) if brand_words else F.array().cast("array<string>")), lambda x: x != ""))


def extra_names(names_: Column, kind: Column, kind_words: dict[str, list[str]], joined: bool = True) -> Column:
    """Further names that a point of interest is found by, never shown: each name with each word for its kind that no name holds yet, and names of two Latin words as one."""
    words = F.create_map(*[x for k, v in kind_words.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    held = F.flatten(F.transform(names_, fold.keys))
    open_ = F.filter(F.coalesce(F.try_element_at(words, kind), F.array().cast("array<string>")), lambda w: ~F.exists(held, lambda h: F.exists(fold.keys(w), lambda k: F.startswith(h, k))))
    bases = F.filter(names_, lambda n, i: ~F.exists(F.slice(names_, 1, i), lambda m: fold.name_key(m) == fold.name_key(n)))
    with_word = F.flatten(F.transform(open_, lambda w: F.transform(bases, lambda n: F.concat_ws(" ", n, w))))
    one = F.transform(F.filter(names_, lambda n: n.rlike("^[A-Za-z]+ [A-Za-z]+$")), lambda n: F.replace(n, F.lit(" "), F.lit("")))
    return F.array_distinct(F.concat(with_word, F.filter(one, lambda n: ~F.array_contains(names_, n)))) if joined else F.array_distinct(with_word)


def with_aliases(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """rows (kind, name, alt_names) with the further names of well-known places; entries: name, kinds (empty: any), names. Few entries, so they are told to all tasks."""
    e = F.broadcast(entries.select(F.col("name").alias("_name"), F.col("kinds").alias("_kinds"), F.col("names").alias("_names")))
    fits = (F.col("name") == F.col("_name")) & ((F.size("_kinds") == 0) | F.array_contains("_kinds", F.col("kind")))
    have = F.filter(F.split(F.coalesce("alt_names", F.lit("")), r"\|"), lambda x: x != "")
    more = F.array_join(F.array_union(have, F.filter("_names", lambda n: n != F.col("name"))), "|")
    return rows.join(e, fits, "left").withColumn("alt_names", F.when(F.col("_names").isNotNull(), more).otherwise(F.col("alt_names"))).drop("_name", "_kinds", "_names")


def postings(rows: DataFrame, names_: Column, id_column: str = "id") -> DataFrame:
    """The inverted index: key and row id, a row for each; rows without keys have none."""
    keys = F.array_distinct(F.flatten(F.transform(names_, fold.index_keys)))
    return rows.select(F.col(id_column), F.explode(keys).alias("key"))
