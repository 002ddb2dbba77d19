"""Checks before a release, as tables of problems: bindings, pins, packaging, counts, rows, known queries, configuration; and the writers of reports."""

from __future__ import annotations

from dataclasses import fields, is_dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BuildConfig, SearchConfig
from ..functions import geo

BINDING_KEYS = ("osm_timestamp", "clipped_pbf_sha256", "clip_config_version", "source_commit")


def binding_problems(facts: DataFrame, reports: DataFrame, bound: tuple[str, ...] = ("routing", "geocoder", "basemap"), keys: tuple[str, ...] = BINDING_KEYS) -> DataFrame:
    """path, key, problem: reports that don't name the build that they were made from.

    facts: key, value of the manifest; reports: path, section, licence, binds (map, or null). A report of a bound
    section, or of data under a share-alike licence, must bind; what binds names all keys and no others.
    """
    must = F.col("section").isin(*bound) | F.coalesce(F.col("licence").startswith("ODbL"), F.lit(False))
    none = reports.where(F.col("binds").isNull() & must).select("path", F.lit(None).cast("string").alias("key"), F.lit("binds nothing").alias("problem"))
    empty = reports.where(F.size("binds") == 0).select("path", F.lit(None).cast("string").alias("key"), F.lit("binds nothing").alias("problem"))
    some = reports.where(F.size("binds") > 0)
    lacks = some.select("path", F.explode(F.array_except(F.array(*map(F.lit, keys)), F.map_keys("binds"))).alias("key"), F.lit("lacks").alias("problem"))
    own = some.select("path", F.explode("binds").alias("key", "value")).join(facts.select("key", F.col("value").alias("have")), "key", "left")
    known = F.col("key").isin(*keys)
    wrong = own.withColumn("problem", F.when(~known, "unknown").when(F.col("have").isNull() | ~F.col("value").eqNullSafe(F.col("have")), "other build")).where("problem is not null")
    return none.unionByName(empty).unionByName(lacks).unionByName(wrong.select("path", "key", "problem"))


def pin_problems(files: DataFrame, pins: DataFrame) -> DataFrame:
    """path, problem: pinned files that are missing or differ in size or hash, and files without a pin. files: path, content; pins: path, sha256, bytes."""
    have = files.select("path", F.sha2("content", 256).alias("own"), F.length("content").alias("size"))
    both = have.join(pins, "path", "full")
    why = F.when(F.col("own").isNull(), "missing").when(F.col("sha256").isNull(), "no pin").when(F.col("size") != F.col("bytes"), "size").when(F.col("own") != F.col("sha256"), "hash")
    return both.select("path", why.alias("problem")).where("problem is not null")


def packaging_problems(builds: DataFrame) -> DataFrame:
    """build, problem of releases: a row for each with what the parts say of one another.

    builds: build, gate_passed, db_sha, gate_sha, report_sha, source_sha, report_source, clipped_sha, osm_time,
    manifest_time, tag, manifest_tag, clip_version, own_clip_version.
    """
    differ = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    rules = {
        "gate did not pass": ~F.coalesce("gate_passed", F.lit(False)), "gate tested another database": differ("gate_sha", "db_sha"), "report is of another database": differ("report_sha", "db_sha"),
        "no clipped extract": F.col("clipped_sha").isNull(), "built from another extract": F.col("clipped_sha").isNotNull() & (differ("source_sha", "clipped_sha") | differ("report_source", "clipped_sha")),
        "another time": differ("osm_time", "manifest_time"), "another release": differ("tag", "manifest_tag"), "another clip version": differ("clip_version", "own_clip_version"),
    }
    return builds.select("build", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]))).alias("problem"))


def indexed_share(counts: DataFrame, least: float) -> DataFrame:
    """metric, n, indexed, passed: whether enough of a table's rows are in the search index; an empty table passes."""
    return counts.select("metric", "n", "indexed", ((F.col("n") == 0) | (F.col("indexed") >= F.col("n") * least)).alias("passed"))


def camera_rules(cfg: BuildConfig = BuildConfig(), speeds: tuple[int, int] = (5, 150)) -> dict[str, Column]:
    """What no camera row may be; a null makes no rule true."""
    c = F.col
    isnt = lambda x, *v: x.isNotNull() & ~x.isin(*v)
    half = lambda a, b: c(a).isNull() != c(b).isNull()
    section = c("osm").startswith("sec-")
    return {
        "kind": isnt(c("kind"), "fixed", "average_speed", "red_light"),
        "maxspeed": c("maxspeed").isNotNull() & (~c("maxspeed").between(*speeds) | c("maxspeed_src").isNull()),
        "maxspeed_src": c("maxspeed_src").isNotNull() & (c("maxspeed").isNull() | ~c("maxspeed_src").isin("camera", "relation", "road", "section")),
        "heading": c("heading").isNotNull() & (~c("heading").between(0, 359) | c("heading_src").isNull()),
        "heading_src": c("heading_src").isNotNull() & (c("heading").isNull() | ~c("heading_src").isin("oneway", "relation", "tag", "section")),
        "road": half("road_bearing", "road_dist_m") | half("road_bearing", "road_class") | F.coalesce(~c("road_bearing").between(0, 359) | ~c("road_dist_m").between(0, cfg.camera_road_m), F.lit(False)),
        "section_end": half("end_lat", "end_lon") | F.coalesce(c("end_lat").isNotNull() & (c("kind") != "average_speed"), F.lit(False)),
        "band": isnt(c("band"), 0, 1),
        "osm": ~c("osm").rlike("^(n[0-9]|r[0-9]|sec-[0-9]+-[0-9]).*"),
        "section": section & (F.coalesce(c("kind") != "average_speed", F.lit(True)) | c("end_lat").isNull() | c("heading").isNull() | F.coalesce(c("heading_src") != "section", F.lit(True)) | c("road_bearing").isNull()),
    }


def hazard_rules(classes: tuple[str, ...]) -> dict[str, Column]:
    c = F.col
    return {
        "kind": c("kind").isNotNull() & ~c("kind").isin("bump", "rail"), "road": F.coalesce(~c("road_bearing").between(0, 359), F.lit(False)) | F.coalesce(~c("road_class").isin(*classes), F.lit(False)),
        "band": c("band").isNotNull() & ~c("band").isin(0, 1), "osm": ~c("osm").rlike("^n[0-9].*"),
    }


def known_queries(cases: DataFrame, hits: DataFrame) -> DataFrame:
    """q, passed, problems: whether the top hit of each known query is what it should be.

    cases: q, and of tables (array), kind, occupied, name, attr, at_lat, at_lon, km what is asked; hits: q, rank,
    table, kind, occupied, names (array), attrs (array), lat, lon. A query without hits fails.
    """
    top = hits.where("rank = 1").select("q", F.struct("table", "kind", "occupied", "names", "attrs", "lat", "lon").alias("h"))
    c, km = cases.join(top, "q", "left"), geo.distance_m(F.col("at_lat"), F.col("at_lon"), F.col("h.lat"), F.col("h.lon")) / 1000
    asked = lambda col, bad: F.col(col).isNotNull() & F.coalesce(bad, F.lit(True))
    rules = {
        "table": asked("tables", ~F.array_contains("tables", F.col("h.table"))), "kind": asked("kind", F.col("kind") != F.col("h.kind")), "occupied": asked("occupied", F.col("occupied") != F.coalesce("h.occupied", F.lit(0))),
        "name": asked("name", ~F.array_contains("h.names", F.col("name"))), "attr": asked("attr", ~F.array_contains("h.attrs", F.col("attr"))), "far": asked("at_lat", km > F.col("km")),
    }
    found = F.when(F.col("h").isNull(), F.array(F.lit("nothing found"))).otherwise(F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in rules.items()])))
    return c.select("q", found.alias("problems")).select("q", (F.size("problems") == 0).alias("passed"), F.array_join("problems", ",").alias("problems"))


def offered_in_zone(hits: DataFrame, hard: Column) -> DataFrame:
    """Hits inside the hard zone that are no occupied place which can't be driven to."""
    shown = (F.col("table") == "places") & (F.coalesce("occupied", F.lit(0)) == 1) & ~F.coalesce("routable", F.lit(False))
    return hits.where(geo.contains(hard, F.col("lon"), F.col("lat")) & ~shown)


def trip_results(trips: DataFrame, legs: DataFrame, rings: dict[str, geo.Rings]) -> DataFrame:
    """trip, passed, problem. trips: trip, must ('fail' or 'pass'); legs: trip, line. No answer is what a trip that must fail has; a route must keep clear of the hard zone and inside the country."""
    line = F.col("line")
    why = F.when(geo.line_hits(rings["hard"], line), "enters the zone").when(geo.first_outside(line, rings["country"]).isNotNull(), "leaves the country")
    judged = legs.select("trip", why.alias("why")).groupBy("trip").agg(F.count(F.lit(1)).alias("legs"), F.min("why").alias("why"))
    t = trips.join(judged, "trip", "left")
    problem = F.when((F.col("must") == "fail") & F.col("legs").isNotNull(), "a route was found").when((F.col("must") == "pass") & F.col("legs").isNull(), "no route").when(F.col("must") == "pass", F.col("why"))
    return t.select("trip", problem.isNull().alias("passed"), problem.alias("problem"))


def test_points(points: DataFrame, rings: dict[str, geo.Rings]) -> DataFrame:
    """point, passed: whether the points of route tests lie where their tests need them: ends of trips that must pass on legal land, of others not. points: point, lat, lon, legal."""
    legal = geo.contains(rings["country"], F.col("lon"), F.col("lat")) & ~geo.contains_closed(rings["hard"], F.col("lon"), F.col("lat"))
    return points.select("point", (legal == F.col("legal")).alias("passed"))


def config_problems(cfg: BuildConfig | SearchConfig) -> list[str]:
    """What a configuration says that can't be: numbers below zero, shares over one, kinds that aren't there. Runs on the driver, over a few fields."""
    if not is_dataclass(cfg):
        return ["no configuration"]
    out = [f"{f.name}: below zero" for f in fields(cfg) if isinstance(v := getattr(cfg, f.name), (int, float)) and not isinstance(v, bool) and v < 0]
    if isinstance(cfg, SearchConfig):
        steps = (cfg.exact, cfg.stem, cfg.prefix_last, cfg.prefix)
        out += ["scores of words don't fall"] if list(steps) != sorted(steps, reverse=True) else []
        out += [f"{n}: over one" for n in ("coverage", "occupied_factor", "type_missing") if getattr(cfg, n) > 1]
        out += [f"categories: {w!r} is listed twice" for w in {w for w, _ in cfg.categories} if [x for x, _ in cfg.categories].count(w) > 1]
        return sorted(out)
    out += [f"place_kinds: {k} has no reach" for k, (_, km) in cfg.place_kinds.items() if km <= 0]
    out += [f"districts: {d!r} is no kind of place" for d in cfg.districts if d not in cfg.place_kinds]
    out += ["street_weights: don't add up to one"] if abs(sum(cfg.street_weights) - 1) > 1e-9 else []
    kinds = [r["kind"] for r in cfg.poi_rules]
    out += [f"poi_rules: {k!r} is listed twice" for k in sorted(set(kinds)) if kinds.count(k) > 1]
    out += [f"poi_rules: {r.get('kind')!r} matches nothing" for r in cfg.poi_rules if not r.get("match")]
    return sorted(out)


def free_edges(edges: DataFrame, exempt: tuple[str, ...]) -> DataFrame:
    """Edges of a restricted band that a route may use freely: not for a destination alone, and of no exempt class. edges: way, class, destination (null: no)."""
    open_ = ~F.coalesce("destination", F.lit(False)) & ~F.coalesce(F.col("class").isin(*exempt), F.lit(False))
    return edges.where(open_).withColumn("problem", F.concat(F.lit("way "), F.col("way").cast("string"), F.lit(" ("), F.coalesce("class", F.lit("None")), F.lit(")")))


def timed(rows: DataFrame, milliseconds: float, searches: int, most: float) -> DataFrame:
    """rows with in_time: whether searches that were made together took no longer, each, than they may."""
    return rows.withColumn("in_time", F.lit(milliseconds <= most * max(1, searches)))


def describe(hits: DataFrame) -> DataFrame:
    """What is shown of a hit: its label, whether it can be driven to, and why not."""
    label = F.coalesce("label_ka", "name", "name_en")
    occupied = F.coalesce("occupied", F.lit(0)) == 1
    return hits.select("q", "rank", "id", label.alias("label"), (~occupied).alias("routable"), F.when(occupied, "occupied").alias("reason"))


def requests(trips: DataFrame) -> DataFrame:
    """A row for each variant of a trip's options: trip, variant, costing, avoid. trips: trip, costing, variants (array<struct<name,avoid>>); a trip without variants has one."""
    plain = F.array(F.struct(F.lit("default").alias("name"), F.array().cast("array<string>").alias("avoid")))
    return trips.select("trip", "costing", F.explode(F.when(F.size("variants") > 0, F.col("variants")).otherwise(plain)).alias("v")).select("trip", F.col("v.name").alias("variant"), "costing", F.array_join(F.array_sort("v.avoid"), ",").alias("avoid"))


def manifest(parts: DataFrame, facts: DataFrame) -> DataFrame:
    """One row with the manifest's text: facts (key, value) and parts (path, sha256, bytes), both in order. As many parts as a release has files."""
    f = facts.agg(F.sort_array(F.collect_list(F.struct("key", "value"))).alias("f"))
    p = parts.agg(F.sort_array(F.collect_list(F.struct("path", "sha256", "bytes"))).alias("p"))
    both = f.withColumn("one", F.lit(1)).join(p.withColumn("one", F.lit(1)), "one")
    return both.select(F.to_json(F.struct(F.map_from_entries("f").alias("facts"), F.col("p").alias("parts"))).alias("text"))


def write_report(rows: DataFrame, path: str) -> None:
    """A table of results as lines of JSON."""
    rows.write.mode("overwrite").json(path)
