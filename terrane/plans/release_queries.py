"""Queries over extracts, areas, and the checks before a release."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BuildConfig, SearchConfig
from ..functions import geo
from ..operators import areas, checks, release, spatial
from ..runtime import forgotten, ship
from ..sources import extract
from ..sources import tables as src
from . import shapes as S
from .geo_queries import _SEGMENTS, _sql_crosses
from .registry import query, table

_LAT, _LON = S.sql_lat, S.sql_lon
_NAMES = ("aba", "ede", "imi", "olo", "unu")
_NAME_SQL = "list_extract(['aba', 'ede', 'imi', 'olo', 'unu'], ({} % 5 + 1)::INT)"


def _name(k: Column) -> Column:
    return F.get(F.array(*map(F.lit, _NAMES)), (k % 5).cast("int"))


# ---------------------------------------------------------------- extracts


def _extracts(spark: SparkSession, d: str) -> DataFrame:
    """A file for each nation: its suppliers as nodes, one way through them and one relation of that."""
    s = S.points(spark, d, "supplier", "s_suppkey").select("s_nationkey", "s_suppkey", "s_name", "lat", "lon")
    ship(spark)

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, nation = pdf.sort_values("s_suppkey"), int(pdf["s_nationkey"].iloc[0])
        nodes = [(int(k), a, o, {"name": n, "place": "town"} if k % 3 else {}) for k, n, a, o in zip(pdf["s_suppkey"], pdf["s_name"], pdf["lat"], pdf["lon"], strict=True)]
        refs = [n[0] for n in nodes]
        data = extract.written(nodes, [(1000 + nation, [*refs, 10**9], {"highway": "primary"})], [(nation, {"type": "multipolygon", "place": "town" if nation % 2 else "sea"}, [("w", 1000 + nation, "outer"), ("n", refs[0], "label")])], 1_700_000_000 + nation, nation % 2 == 0)
        return pd.DataFrame({"path": [f"extract-{nation}"], "content": [data]})

    return s.groupBy("s_nationkey").applyInPandas(make, "path string, content binary")


@query("extract_scan", "SRC01 SRC02", f"""SELECT 'n' AS kind, s_suppkey AS id, round(round({_LAT('s_suppkey')}, 7), 5) AS lat, round(round({_LON('s_suppkey')}, 7), 5) AS lon, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS name, 0 AS parts FROM supplier
    UNION ALL SELECT 'w', 1000 + s_nationkey, NULL, NULL, NULL, count(*) + 1 FROM supplier GROUP BY s_nationkey UNION ALL SELECT 'r', s_nationkey, NULL, NULL, NULL, 2 FROM supplier GROUP BY s_nationkey""")
def extract_scan(spark: SparkSession, d: str) -> DataFrame:
    rows = extract.read_objects(_extracts(spark, d))
    return rows.select("kind", "id", F.round("lat", 5).alias("lat"), F.round("lon", 5).alias("lon"), F.try_element_at("tags", F.lit("name")).alias("name"), (F.coalesce(F.size("refs"), F.lit(0)) + F.coalesce(F.size("members"), F.lit(0))).cast("int").alias("parts"))


@query("extract_header", "SRC06", "SELECT DISTINCT 'extract-' || s_nationkey AS path, 1700000000 + s_nationkey AS time, 'terrane' AS program FROM supplier")
def extract_header(spark: SparkSession, d: str) -> DataFrame:
    return extract.read_headers(_extracts(spark, d)).select("path", "time", "program")


@query("extract_lines", "SRC01 SRC03", "SELECT 1000 + s_nationkey AS id, count(*) AS placed, 1 AS lost FROM supplier GROUP BY s_nationkey")
def extract_lines(spark: SparkSession, d: str) -> DataFrame:
    """Ways with the places of their nodes, by id; a node that no file holds has none."""
    o = extract.split(extract.read_objects(_extracts(spark, d)))
    w = src.with_lines(o["ways"], o["nodes"])
    return w.select("id", F.size(F.filter("line", lambda p: p.isNotNull())).cast("long").alias("placed"), F.size(F.filter("line", lambda p: p.isNull())).alias("lost"))


@query("extract_wanted", "SRC04 FLT04", """WITH s AS (SELECT *, min(s_suppkey) OVER (PARTITION BY s_nationkey) AS first FROM supplier)
    SELECT 'relations' AS what, s_nationkey AS id FROM s WHERE s_nationkey % 2 = 1 GROUP BY 2 UNION ALL SELECT 'ways', 1000 + s_nationkey FROM s WHERE s_nationkey % 2 = 1 GROUP BY 2 UNION ALL SELECT 'nodes', s_suppkey FROM s WHERE s_suppkey % 3 > 0 OR (s_nationkey % 2 = 1 AND s_suppkey = first)""")
def extract_wanted(spark: SparkSession, d: str) -> DataFrame:
    """What two passes keep: wanted relations, their members, and objects with a key of interest."""
    o = extract.split(extract.read_objects(_extracts(spark, d)))
    kept = src.wanted_objects(o["nodes"], o["ways"], o["relations"], ("place", "amenity"), areas.wanted_relation(F.col("tags")))
    rows = [kept[k].select(F.lit(k).alias("what"), F.col("id")) for k in ("relations", "ways", "nodes")]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# ---------------------------------------------------------------- areas


def _square(k: Column, half: Column) -> Column:
    x, y = S.lon(k * 31 + 7), S.lat(k * 31 + 7)
    return F.array(F.array(geo.point(x - half, y - half), geo.point(x + half, y - half), geo.point(x + half, y + half), geo.point(x - half, y + half)))


def _place_rows(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    kind = F.when(k % 4 == 0, "city").when(k % 4 == 1, "town").otherwise("village")
    return S.points(spark, d, "customer", "c_custkey").select(F.concat(F.lit("n"), F.lpad(k.cast("string"), 9, "0")).alias("osm"), kind.alias("kind"), "lat", "lon", F.create_map(F.lit("name"), _name(k)).alias("tags"))


def _area_rows(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(F.concat(F.lit("w"), F.lpad(k.cast("string"), 9, "0")).alias("osm"), F.lit("town").alias("kind"), _square(k, 0.01 + (k % 4) * 0.03).alias("rings"), F.create_map(F.lit("name"), _name(k)).alias("tags"))


@query("area_of_place", "JN06 PIP02")
def area_of_place(spark: SparkSession, d: str) -> DataFrame:
    """Which area each place got, and the areas that became places."""
    return areas.link_areas(_place_rows(spark, d), _area_rows(spark, d)).select("osm", "area_osm", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


_ADMIN = f"""WITH p AS (SELECT c_custkey AS k, c_custkey % 4 AS kind, c_custkey % 5 AS name, {_LAT('c_custkey')} AS lat, {_LON('c_custkey')} AS lon FROM customer),
    a AS (SELECT s_suppkey AS a, s_suppkey % 5 AS name, 0.02 + (s_suppkey % 3) * 0.04 AS half, {_LAT('(s_suppkey * 31 + 7)')} AS y, {_LON('(s_suppkey * 31 + 7)')} AS x, (s_suppkey % 20) * 5 + s_suppkey % 5 AS label FROM supplier),
    l AS (SELECT a.*, p.k AS labelled FROM a LEFT JOIN p ON p.k = a.label AND p.name = a.name AND p.kind < 2),
    h AS (SELECT a.a, min(p.k) AS held FROM a JOIN p ON p.name = a.name AND p.kind < 2 AND p.lon >= x - half AND p.lon < x + half AND p.lat >= y - half AND p.lat < y + half GROUP BY 1)"""


@query("settlement_areas", "JN07 PIP02", f"{_ADMIN} SELECT 'n' || coalesce(labelled, held) AS osm, round(max(4 * half * half)::DOUBLE, 6) AS area FROM l LEFT JOIN h ON h.a = l.a WHERE coalesce(labelled, held) IS NOT NULL GROUP BY 1")
def settlement_areas(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    places = S.points(spark, d, "customer", "c_custkey").select(F.concat(F.lit("n"), "c_custkey").alias("osm"), F.when(F.col("c_custkey") % 4 == 0, "city").when(F.col("c_custkey") % 4 == 1, "town").otherwise("village").alias("kind"), "lat", "lon", _name(F.col("c_custkey")).alias("name"), F.lit(None).cast("array<array<struct<x:double,y:double>>>").alias("rings"))
    # of places of one name the first by number is the first by id too, if ids are padded for the join and bare in the result
    places = places.withColumn("osm", F.concat(F.lit("n"), F.lpad(F.expr("substring(osm, 2)"), 9, "0")))
    admins = table(spark, d, "supplier").select(F.concat(F.lit("r"), k).alias("osm"), _name(k).alias("name"), _square(k, 0.02 + (k % 3) * 0.04).alias("rings"), F.array(F.lpad(((k % 20) * 5 + k % 5).cast("string"), 9, "0")).alias("labels"))
    out = areas.settlement_areas(places, admins)
    return out.select(F.concat(F.lit("n"), F.expr("cast(substring(osm, 2) as bigint)")).alias("osm"), F.round("area", 6).alias("area"))


@query("object_dispatch", "PIP01", """SELECT osm, target FROM (SELECT 'n' || p_partkey AS osm, unnest([CASE WHEN p_partkey % 4 = 0 AND p_partkey % 3 > 0 AND p_partkey % 2 = 0 THEN 'place_areas' END, CASE WHEN p_partkey % 4 = 0 AND p_partkey % 3 > 0 AND p_partkey % 2 = 1 THEN 'places' END,
    CASE WHEN p_partkey % 5 = 0 AND p_partkey % 3 > 0 AND p_partkey % 2 = 0 THEN 'admin_areas' END, CASE WHEN p_partkey % 7 = 0 THEN 'pois' END, CASE WHEN p_partkey % 6 = 1 AND p_partkey % 11 > 0 THEN 'addresses' END]) AS target FROM part) WHERE target IS NOT NULL""")
def object_dispatch(spark: SparkSession, d: str) -> DataFrame:
    """Parts as objects with tags, every second one an area, sent to the tables that they feed."""
    k = F.col("p_partkey")
    tags = F.create_map(
        F.lit("place"), F.when(k % 4 == 0, "town"), F.lit("name"), F.when(k % 3 > 0, F.col("p_name")), F.lit("boundary"), F.when(k % 5 == 0, "administrative"), F.lit("admin_level"), F.when(k % 5 == 0, "6"),
        F.lit("amenity"), F.when(k % 7 == 0, "fuel"), F.lit("addr:housenumber"), F.when(k % 6 == 1, "1"), F.lit("addr:street"), F.when(k % 11 > 0, "x"),
    )
    area = F.when(k % 2 == 0, _square(k, F.lit(0.01)))
    o = S.points(spark, d, "part", "p_partkey").select(F.concat(F.lit("n"), k).alias("osm"), F.map_filter(tags, lambda _, v: v.isNotNull()).alias("tags"), "lat", "lon", area.alias("rings"), F.lit(1).alias("outer"), F.lit(False).alias("open"), F.lit(False).alias("is_way"))
    return areas.dispatch(o).select("osm", "target")


@query("box_filter", "FLT10 Q8 Q10 Q7", f"SELECT c_custkey FROM {S.sql_points('customer', 'c_custkey')} WHERE lat BETWEEN 41.6 AND 42.0 AND lon BETWEEN 44.2 AND 44.7 AND c_nationkey IN (1, 2, 3, 5, 8, 13) AND ';' || c_mktsegment || ';' LIKE '%;BUILDING;%'")
def box_filter(spark: SparkSession, d: str) -> DataFrame:
    """Rows of some cities and with an attribute in a box."""
    p = S.points(spark, d, "customer", "c_custkey").where(F.col("c_nationkey").isin(1, 2, 3, 5, 8, 13))
    return p.where(F.array_contains(F.split("c_mktsegment", ";"), "BUILDING") & F.col("lat").between(41.6, 42.0) & F.col("lon").between(44.2, 44.7)).select("c_custkey")


# ---------------------------------------------------------------- checks


@query("binding_check", "MAN01", """WITH r AS (SELECT s_suppkey, s_suppkey % 4 AS kind, s_suppkey % 3 AS wrong FROM supplier)
    SELECT 'report-' || s_suppkey AS path, key, problem FROM (SELECT s_suppkey, NULL AS key, 'binds nothing' AS problem FROM r WHERE kind = 0
    UNION ALL SELECT s_suppkey, 'source_commit', 'lacks' FROM r WHERE kind IN (1, 3) UNION ALL SELECT s_suppkey, 'osm_timestamp', 'other build' FROM r WHERE kind IN (1, 3) AND wrong = 0 UNION ALL SELECT s_suppkey, 'colour', 'unknown' FROM r WHERE kind IN (1, 3) AND wrong = 1)""")
def binding_check(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    facts = spark.createDataFrame([("osm_timestamp", "t0"), ("clipped_pbf_sha256", "s0"), ("clip_config_version", "3"), ("source_commit", "c0")], "key string, value string")
    binds = F.create_map(F.lit("osm_timestamp"), F.when(k % 3 == 0, "t1").otherwise("t0"), F.lit("clipped_pbf_sha256"), F.lit("s0"), F.lit("clip_config_version"), F.lit("3"), F.when(k % 3 == 1, "colour").otherwise("osm_timestamp2"), F.lit("x"))
    binds = F.map_filter(binds, lambda n, _: n != "osm_timestamp2")
    reports = table(spark, d, "supplier").select(F.concat(F.lit("report-"), k).alias("path"), F.when(k % 4 == 2, "fonts").otherwise("routing").alias("section"), F.lit("OFL").alias("licence"), F.when(k % 2 == 1, binds).alias("binds"))
    return release.binding_problems(facts, reports)


@query("pin_check", "MAN02 SRC22", "SELECT 'part-' || p_partkey AS path, CASE WHEN p_partkey % 9 = 0 THEN 'missing' WHEN p_partkey % 10 = 0 THEN 'no pin' WHEN p_partkey % 7 = 0 THEN 'size' ELSE 'hash' END AS problem FROM part WHERE (p_partkey % 9 = 0 AND p_partkey % 10 > 0) OR (p_partkey % 10 = 0 AND p_partkey % 9 > 0) OR (p_partkey % 9 > 0 AND p_partkey % 10 > 0 AND (p_partkey % 7 = 0 OR p_partkey % 11 = 0))")
def pin_check(spark: SparkSession, d: str) -> DataFrame:
    k, name = F.col("p_partkey"), F.col("p_name")
    p = table(spark, d, "part").withColumn("path", F.concat(F.lit("part-"), k))
    files = p.where(k % 9 > 0).select("path", F.encode(F.when(k % 7 == 0, F.concat(name, F.lit("!"))).when(k % 11 == 0, F.reverse(F.concat(F.lit("~"), F.substr(name, F.lit(2))))).otherwise(name), "utf-8").alias("content"))
    return release.pin_problems(files, p.where(k % 10 > 0).select("path", F.sha2(name, 256).alias("sha256"), F.length(F.encode(name, "utf-8")).alias("bytes")))


@query("packaging_check", "MAN03 MAN04", """SELECT o_orderkey AS build, problem FROM (SELECT o_orderkey, unnest([CASE WHEN o_orderstatus = 'P' THEN 'gate did not pass' END, CASE WHEN o_orderkey % 5 = 0 THEN 'gate tested another database' END, CASE WHEN o_custkey % 6 = 0 THEN 'no clipped extract' END,
    CASE WHEN o_custkey % 6 > 0 AND o_orderkey % 8 = 0 THEN 'built from another extract' END, CASE WHEN o_orderkey % 9 = 0 THEN 'another release' END, CASE WHEN o_orderkey % 13 = 0 THEN 'another clip version' END]) AS problem FROM orders) WHERE problem IS NOT NULL""")
def packaging_check(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    other = lambda n, c: F.concat(F.lit(c), F.when(k % n == 0, "x").otherwise(""))
    b = table(spark, d, "orders").select(
        k.alias("build"), (F.col("o_orderstatus") != "P").alias("gate_passed"), F.lit("d").alias("db_sha"), other(5, "d").alias("gate_sha"), F.lit("d").alias("report_sha"), other(8, "e").alias("source_sha"), F.lit("e").alias("report_source"),
        F.when(F.col("o_custkey") % 6 > 0, "e").alias("clipped_sha"), F.lit("t").alias("osm_time"), F.lit("t").alias("manifest_time"), other(9, "v").alias("tag"), F.lit("v").alias("manifest_tag"), other(13, "3").alias("clip_version"), F.lit("3").alias("own_clip_version"),
    )
    return release.packaging_problems(b)


@query("indexed_share", "GTE03", "SELECT p_brand AS metric, count(*) AS n, count_if(p_size > 5) AS indexed, count_if(p_size > 5) >= 0.9 * count(*) AS passed FROM part GROUP BY 1")
def indexed_share(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "part").groupBy(F.col("p_brand").alias("metric")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("p_size") > 5).alias("indexed"))
    return release.indexed_share(counts, 0.9)


@query("camera_rules", "GTE06 Q13", """SELECT rule, count(*) AS violations FROM (SELECT unnest([CASE WHEN p_size % 7 = 0 THEN 'kind' END, CASE WHEN p_partkey % 10 = 0 OR (p_partkey % 10 < 7 AND p_partkey % 6 = 0) THEN 'maxspeed' END, CASE WHEN p_partkey % 6 > 0 AND (p_partkey % 10 >= 7 OR p_partkey % 6 = 5) THEN 'maxspeed_src' END,
    CASE WHEN p_partkey % 8 = 0 THEN 'heading' END, CASE WHEN p_partkey % 12 = 0 THEN 'band' END, CASE WHEN p_partkey % 14 = 0 THEN 'osm' END, CASE WHEN p_partkey % 16 = 0 THEN 'road' END]) AS rule FROM part) WHERE rule IS NOT NULL GROUP BY 1""")
def camera_rules(spark: SparkSession, d: str) -> DataFrame:
    """Parts as camera rows, with planted faults."""
    k = F.col("p_partkey")
    none = lambda t: F.lit(None).cast(t)
    rows = table(spark, d, "part").select(
        F.when(F.col("p_size") % 7 == 0, "toy").otherwise("fixed").alias("kind"), F.when(k % 10 == 0, 200).when(k % 10 < 7, 60).cast("int").alias("maxspeed"), F.when(k % 6 == 5, "dream").when(k % 6 > 0, "camera").alias("maxspeed_src"),
        F.when(k % 8 == 0, 400).otherwise(90).alias("heading"), F.lit("tag").alias("heading_src"), F.when(k % 16 > 0, 10).alias("road_bearing"), F.lit(3.0).alias("road_dist_m"), F.lit("primary").alias("road_class"),
        none("double").alias("end_lat"), none("double").alias("end_lon"), F.when(k % 12 == 0, 2).otherwise(0).alias("band"), F.concat(F.when(k % 14 == 0, "x").otherwise("n"), k).alias("osm"),
    )
    return checks.violations(rows, release.camera_rules())


@query("hazard_rules", "GTE07", "SELECT rule, count(*) AS violations FROM (SELECT unnest([CASE WHEN p_size % 7 = 0 THEN 'kind' END, CASE WHEN p_partkey % 8 = 0 OR p_partkey % 5 = 0 THEN 'road' END, CASE WHEN p_partkey % 12 = 0 THEN 'band' END, CASE WHEN p_partkey % 14 = 0 THEN 'osm' END]) AS rule FROM part) WHERE rule IS NOT NULL GROUP BY 1")
def hazard_rules(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    rows = table(spark, d, "part").select(F.when(F.col("p_size") % 7 == 0, "toy").otherwise("bump").alias("kind"), F.when(k % 8 == 0, 400).otherwise(90).alias("road_bearing"), F.when(k % 5 == 0, "footway").otherwise("primary").alias("road_class"), F.when(k % 12 == 0, 2).otherwise(0).alias("band"), F.concat(F.when(k % 14 == 0, "x").otherwise("n"), k).alias("osm"))
    return checks.violations(rows, release.hazard_rules(("primary", "secondary")))


@query("known_queries", "GTE09", """SELECT c_custkey AS q, c_custkey % 10 > 0 AND problems = '' AS passed, CASE WHEN c_custkey % 10 = 0 THEN 'nothing found' ELSE problems END AS problems FROM (SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 4 = 0 THEN 'table' END, CASE WHEN c_custkey % 3 = 0 THEN 'name' END, CASE WHEN c_custkey % 7 = 0 THEN 'far' END) AS problems FROM customer)""")
def known_queries(spark: SparkSession, d: str) -> DataFrame:
    """Customers as known queries, whose recorded top hits are right or wrong in one way or another."""
    k = F.col("c_custkey")
    c = S.points(spark, d, "customer", "c_custkey")
    null = lambda t: F.lit(None).cast(t)
    cases = c.select(k.alias("q"), F.array(F.lit("pois"), F.lit("places")).alias("tables"), null("string").alias("kind"), F.lit(0).alias("occupied"), F.col("c_name").alias("name"), null("string").alias("attr"), F.col("lat").alias("at_lat"), F.col("lon").alias("at_lon"), F.lit(1.0).alias("km"))
    own = lambda rank: F.when(k % 4 == 0, "streets").otherwise("pois") if rank == 1 else F.lit("streets")
    hits = [c.where(k % 10 > 0).select(k.alias("q"), F.lit(rank).alias("rank"), own(rank).alias("table"), F.lit("x").alias("kind"), null("int").alias("occupied"), F.array(F.when(k % 3 == 0, F.upper("c_name")).otherwise(F.col("c_name"))).alias("names"), F.array().cast("array<string>").alias("attrs"), (F.col("lat") + F.when(k % 7 == 0, 0.1).otherwise(0.0)).alias("lat"), "lon") for rank in (1, 2)]
    return release.known_queries(cases, hits[0].unionByName(hits[1]))


def _hits() -> str:
    return f"(SELECT way, bool_or({_sql_crosses()}) AS hits FROM {_SEGMENTS} WHERE x2 IS NOT NULL GROUP BY way)"


@query("trip_results", "GTE11 GTE12", f"""WITH n AS (SELECT way, count(*) AS nodes, bool_or(NOT {S.sql_in('country', 'lat', 'lon')}) AS out, bool_or({S.sql_in('hard', 'lat', 'lon')}) AS node_in FROM {S.SQL_WAYNODES} GROUP BY way),
    t AS (SELECT o_orderkey AS trip, CASE WHEN o_orderkey % 3 = 0 THEN 'fail' ELSE 'pass' END AS must, nodes, out, CASE WHEN nodes > 1 THEN h.hits ELSE node_in END AS hits FROM orders LEFT JOIN n ON way = o_orderkey LEFT JOIN {_hits()} h ON h.way = o_orderkey),
    p AS (SELECT trip, CASE WHEN must = 'fail' AND nodes IS NOT NULL THEN 'a route was found' WHEN must = 'pass' AND nodes IS NULL THEN 'no route' WHEN must = 'pass' AND hits THEN 'enters the zone' WHEN must = 'pass' AND out THEN 'leaves the country' END AS problem FROM t)
    SELECT trip, problem IS NULL AS passed, problem FROM p""")
def trip_results(spark: SparkSession, d: str) -> DataFrame:
    """Orders as trips, and the ways of their items as the routes that were found for them."""
    trips = table(spark, d, "orders").select(F.col("o_orderkey").alias("trip"), F.when(F.col("o_orderkey") % 3 == 0, "fail").otherwise("pass").alias("must"))
    return release.trip_results(trips, S.ways(spark, d).select(F.col("way").alias("trip"), "line"), S.zone_rings())


@query("test_points", "GTE12", f"SELECT c_custkey AS point, ({S.sql_in('country', 'lat', 'lon')} AND NOT {S.sql_in('hard', 'lat', 'lon')}) = (c_custkey % 2 = 0) AS passed FROM {S.sql_points('customer', 'c_custkey')}")
def test_points(spark: SparkSession, d: str) -> DataFrame:
    p = S.points(spark, d, "customer", "c_custkey")
    return release.test_points(p.select(F.col("c_custkey").alias("point"), "lat", "lon", (F.col("c_custkey") % 2 == 0).alias("legal")), S.zone_rings())


@query("config_check", "GTE01 Q2", "SELECT s_suppkey, (CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END + CASE WHEN s_suppkey % 4 = 0 THEN 1 ELSE 0 END + CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END)::INT AS problems FROM supplier")
def config_check(spark: SparkSession, d: str) -> DataFrame:
    """How many problems each supplier's configuration has: a weight below zero, a kind without reach, a district that is no kind of place."""
    ship(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [BuildConfig(parent_weight=float(w), place_kinds={"city": (0.7, float(k % 4)), **({} if k % 3 == 0 else {"suburb": (0.3, 3.0)})}) for k, w in zip(pdf["s_suppkey"], pdf["s_acctbal"], strict=True)]
            yield pd.DataFrame({"s_suppkey": pdf["s_suppkey"], "problems": [len(release.config_problems(c)) for c in made]})

    return table(spark, d, "supplier").select("s_suppkey", "s_acctbal").mapInPandas(run, "s_suppkey long, problems int")


@query("hit_labels", "SNK10 PRJ06", "SELECT c_nationkey::BIGINT AS q, 1 AS rank, c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) ELSE c_name END AS label, c_custkey % 5 > 0 AS routable, CASE WHEN c_custkey % 5 = 0 THEN 'occupied' END AS reason FROM customer")
def hit_labels(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    hits = table(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("q"), F.lit(1).alias("rank"), k.alias("id"), F.when(k % 3 == 0, F.upper("c_name")).alias("label_ka"), F.col("c_name").alias("name"), F.lit("en").alias("name_en"), F.when(k % 5 == 0, 1).alias("occupied"))
    return release.describe(hits)


@query("route_requests", "PRJ08", "SELECT s_suppkey AS trip, unnest(CASE WHEN s_suppkey % 2 = 0 THEN ['default'] ELSE ['no tolls', 'plain'] END) AS variant, 'auto' AS costing, unnest(CASE WHEN s_suppkey % 2 = 0 THEN [''] ELSE ['ferry,toll', ''] END) AS avoid FROM supplier")
def route_requests(spark: SparkSession, d: str) -> DataFrame:
    none = F.array().cast("array<string>")
    two = F.array(F.struct(F.lit("no tolls").alias("name"), F.array(F.lit("toll"), F.lit("ferry")).alias("avoid")), F.struct(F.lit("plain").alias("name"), none.alias("avoid")))
    t = table(spark, d, "supplier").select(F.col("s_suppkey").alias("trip"), F.lit("auto").alias("costing"), F.when(F.col("s_suppkey") % 2 == 1, two).otherwise(F.slice(two, 1, 0)).alias("variants"))
    return release.requests(t)


@query("release_manifest", "SNK09 MAN01", """SELECT '{"facts":{' || (SELECT string_agg('"' || r_name || '":"' || r_regionkey || '"', ',' ORDER BY r_name) FROM region) || '},"parts":[' || (SELECT string_agg('{"path":"' || n_name || '","sha256":"' || sha256(n_name) || '","bytes":' || length(n_name) || '}', ',' ORDER BY n_name) FROM nation) || ']}' AS text""")
def release_manifest(spark: SparkSession, d: str) -> DataFrame:
    facts = table(spark, d, "region").select(F.col("r_name").alias("key"), F.col("r_regionkey").cast("string").alias("value"))
    parts = table(spark, d, "nation").select(F.col("n_name").alias("path"), F.sha2("n_name", 256).alias("sha256"), F.length("n_name").alias("bytes"))
    return release.manifest(parts, facts)


@query("city_of_area", "JN02 PIP02")
def city_of_area(spark: SparkSession, d: str) -> DataFrame:
    """The settlement of each part by its own or administrative area, else by reach; places with areas as the build has them."""
    rows = areas.link_areas(_place_rows(spark, d), _area_rows(spark, d)).withColumn("name", F.col("tags")["name"])
    occupied = F.when(F.coalesce(spatial.zone(S.zone_rings(), F.col("lat"), F.col("lon")).isin("occupied", "buffer"), F.lit(False)), 1).otherwise(0)
    rows = forgotten(rows.withColumn("occupied", occupied))
    own = areas.settlement_areas(rows, spark.createDataFrame([], "osm string, name string, rings array<array<struct<x:double,y:double>>>, labels array<string>"), ("city", "town", "village"))
    centres = rows.where("occupied = 0 and kind != 'village'").select(F.col("osm").alias("settlement"), F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"), F.lit(3000.0).alias("reach"))
    p = S.points(spark, d, "part", "p_partkey").select("p_partkey", "lat", "lon")
    return areas.city_by_area(p, rows, own, centres, "p_partkey", 3000.0)




@query("free_edges", "FLT13", "SELECT o_orderkey AS way, 'way ' || o_orderkey || ' (' || c || ')' AS problem FROM (SELECT *, list_extract(['motorway', 'trunk', 'primary', 'secondary', 'tertiary', 'residential', 'service', 'track'], (o_orderkey % 8 + 1)::INT) AS c FROM orders) WHERE o_custkey % 7 <> 2 AND o_orderkey % 8 > 1")
def free_edges(spark: SparkSession, d: str) -> DataFrame:
    """Orders as edges of the band, every seventh customer's for a destination alone; motorways and trunk roads are exempt."""
    k = F.col("o_orderkey")
    edges = table(spark, d, "orders").select(k.alias("way"), F.get(F.array(*map(F.lit, S.CLASSES)), (k % 8).cast("int")).alias("class"), F.when(F.col("o_custkey") % 7 == 2, True).alias("destination"))
    return release.free_edges(edges, ("motorway", "trunk")).select("way", "problem")
