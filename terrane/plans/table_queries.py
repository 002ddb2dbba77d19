"""Queries over plain tables: joins, aggregates, ranks, sets, and the constraints that hold a build to account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import tags as T
from ..operators import checks, graph, rank, spatial
from . import shapes as S
from .registry import query, table


def n() -> Column:
    return F.count(F.lit(1))


# ---------------------------------------------------------------- joins


@query("hash_lookup", "JN01", "SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey")
def hash_lookup(spark: SparkSession, d: str) -> DataFrame:
    o, c, na = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    return o.join(c, o.o_custkey == c.c_custkey).join(na, c.c_nationkey == na.n_nationkey).select("o_orderkey", "c_name", "n_name")


@query("address_street", "JN05", f"""WITH k AS (SELECT p_partkey, split_part(p_name, ' ', 1) AS w1, p_name FROM part), a AS (SELECT s_suppkey, (SELECT p_name FROM part WHERE p_partkey = s_suppkey * 3) AS nm, {S.sql_lat('s_suppkey')} lat, {S.sql_lon('s_suppkey')} lon FROM supplier),
    c AS (SELECT s_suppkey, p_partkey, CASE WHEN k.p_name = nm THEN 0 ELSE 1 END AS tier, round({S.sql_metres('a.lat', 'a.lon', S.sql_lat('p_partkey'), S.sql_lon('p_partkey'))}, 3) AS metres FROM a JOIN k ON k.w1 = split_part(nm, ' ', 1))
    SELECT s_suppkey, p_partkey, tier FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY tier, metres, p_partkey) rn FROM c WHERE metres <= 60000) WHERE rn = 1""")
def address_street(spark: SparkSession, d: str) -> DataFrame:
    """The nearest street of the very name, else the nearest that has the first word."""
    part = table(spark, d, "part")
    word = lambda c: F.split(F.col(c), " ")[0]
    streets = S.points(spark, d, "part", "p_partkey").select("p_partkey", "p_name", word("p_name").alias("word"), F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"))
    names = part.select((F.col("p_partkey") / 3).cast("long").alias("s_suppkey"), F.col("p_name").alias("nm")).where(F.col("p_partkey") % 3 == 0)
    a = S.points(spark, d, "supplier", "s_suppkey").join(names, "s_suppkey").select("s_suppkey", "nm", word("nm").alias("word"), "lat", "lon")
    # metres count to three digits, so a tie of those goes by the key
    near = lambda of, streets_, on: spatial.nearest(of, streets_, "s_suppkey", "p_partkey", None, 60_000.001, (on,), 3).where("metres <= 60000")
    exact = graph.kept(near(a, streets.select("p_partkey", F.col("p_name").alias("nm"), "r_lat", "r_lon"), "nm"))
    rest = graph.kept(a.join(exact, "s_suppkey", "left_anti"))
    begun = near(rest, streets.drop("p_name"), "word")
    row = lambda df, tier: df.select("s_suppkey", "p_partkey", F.lit(tier).alias("tier"))
    return row(exact, 0).unionByName(row(begun, 1))


@query("semi_join", "JN10 SRC01 FLT04", "SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')")
def semi_join(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, d, "part").select("p_partkey").join(li, "p_partkey", "left_semi")


@query("anti_join", "JN11", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def anti_join(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey").join(o, "c_custkey", "left_anti")


@query("postings_join", "JN12 Q3 Q4 Q5", "SELECT q, p_partkey FROM (SELECT w.q, p_partkey, row_number() OVER (PARTITION BY w.q ORDER BY p_retailprice DESC, p_partkey) rn FROM part JOIN (VALUES ('red'), ('blue'), ('green')) w(q) ON list_contains(string_split(p_name, ' '), w.q)) WHERE rn <= 8")
def postings_join(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    index = p.select("p_partkey", "p_retailprice", F.explode(F.array_distinct(F.split("p_name", " "))).alias("q"))
    hits = index.where(F.col("q").isin("red", "blue", "green"))
    return rank.top_per_group(hits, ["q"], [F.col("p_retailprice").desc(), F.col("p_partkey").asc()], 8).select("q", "p_partkey")


@query("fk_check", "JN13 Q14 GTE06", "SELECT 'orders.customer' AS link, count(*) AS violations FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE c_custkey IS NULL UNION ALL SELECT 'lineitem.part', count(*) FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE p_partkey IS NULL")
def fk_check(spark: SparkSession, d: str) -> DataFrame:
    a = checks.foreign_key("orders.customer", table(spark, d, "orders"), "o_custkey", table(spark, d, "customer"), "c_custkey")
    return a.unionByName(checks.foreign_key("lineitem.part", table(spark, d, "lineitem"), "l_partkey", table(spark, d, "part"), "p_partkey"))


@query("parent_importance", "JN14 AGG14 PRJ07", "WITH b AS (SELECT c_custkey, c_nationkey, least(greatest(log10(greatest(c_acctbal, 0) + 1) / log10(10001), 0), 1) AS own FROM customer), p AS (SELECT c_nationkey, max(own) AS parent FROM b GROUP BY 1) SELECT c_custkey, round(least(greatest(0.7 * own + 0.3 * parent, 0), 1), 4) AS importance FROM b JOIN p USING (c_nationkey)")
def parent_importance(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "customer").select("c_custkey", "c_nationkey", rank.log_share(F.col("c_acctbal"), 10_000.0).alias("own"))
    p = b.groupBy("c_nationkey").agg(F.max("own").alias("parent"))
    return b.join(p, "c_nationkey").select("c_custkey", F.round(T.clamp01(0.7 * F.col("own") + 0.3 * F.col("parent")), 4).alias("importance"))


@query("previous_drop", "JN19 GTE04", "WITH a AS (SELECT o_orderstatus AS metric, count(*) AS now FROM orders WHERE o_orderkey % 5 <> 0 GROUP BY 1), b AS (SELECT o_orderstatus AS metric, count(*) AS before FROM orders GROUP BY 1) SELECT metric, before, now, now >= before * 0.8 AS passed FROM a FULL JOIN b USING (metric)")
def previous_drop(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    count = lambda df, name: df.groupBy(F.col("o_orderstatus").alias("metric")).agg(n().alias(name))
    return checks.drop_against(count(o, "before"), count(o.where("o_orderkey % 5 <> 0"), "now"), 0.2)


# ---------------------------------------------------------------- aggregates


@query("dup_check", "AGG03 Q15", "SELECT count(*) AS n, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates FROM lineitem")
def dup_check(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").agg(n().alias("n"), (n() - F.countDistinct("l_orderkey", "l_linenumber")).alias("duplicates"))


@query("name_vote", "AGG04", "WITH s AS (SELECT l_suppkey, p_name, sum(l_quantity) AS w, min(l_orderkey) AS p FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) SELECT l_suppkey, p_name FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY w DESC, p, p_name DESC) rn FROM s) WHERE rn = 1")
def name_vote(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    sums = rows.groupBy("l_suppkey", "p_name").agg(F.sum("l_quantity").alias("w"), F.min("l_orderkey").alias("p"))
    return sums.groupBy("l_suppkey").agg(F.max_by("p_name", F.struct("w", (-F.col("p")).alias("p"), "p_name")).alias("p_name"))


@query("plain_mode", "AGG05", "SELECT c_nationkey, c_mktsegment FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY k DESC, p) rn FROM (SELECT c_nationkey, c_mktsegment, count(*) k, min(c_custkey) p FROM customer GROUP BY 1, 2)) WHERE rn = 1")
def plain_mode(spark: SparkSession, d: str) -> DataFrame:
    return rank.weighted_vote(table(spark, d, "customer").withColumn("one", F.lit(1)), ["c_nationkey"], "c_mktsegment", "one", "c_custkey")


@query("medoid_point", "AGG06", f"WITH p AS {S.sql_points('customer', 'c_custkey')}, m AS (SELECT c_nationkey, avg(lat) a, avg(lon) b FROM p GROUP BY 1) SELECT c_nationkey, c_custkey FROM (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY round(pow(lat - a, 2) + pow((lon - b) * cos(radians(a)), 2), 15), c_custkey) rn FROM p JOIN m USING (c_nationkey)) WHERE rn = 1")
def medoid_point(spark: SparkSession, d: str) -> DataFrame:
    return rank.medoid(S.points(spark, d, "customer", "c_custkey"), ["c_nationkey"], "c_custkey")


@query("max_class", "AGG08", "SELECT o_custkey, min(o_orderkey % 8) AS class_rank, count(*) AS n FROM orders GROUP BY 1")
def max_class(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.min(F.col("o_orderkey") % 8).alias("class_rank"), n().alias("n"))


@query("best_copy", "AGG09", "SELECT p_name, p_brand, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_size DESC, p_partkey) rn FROM part) WHERE rn = 1")
def best_copy(spark: SparkSession, d: str) -> DataFrame:
    best = F.max_by("p_partkey", F.struct(F.col("p_size"), (-F.col("p_partkey")).alias("k")))
    return table(spark, d, "part").groupBy("p_name", "p_brand").agg(best.alias("p_partkey"))


@query("band_check", "GTE03 AGG15", "SELECT metric, n, n BETWEEN lo AND hi AS passed FROM (SELECT 'customer' AS metric, count(*) AS n, 1000 AS lo, 2000 AS hi FROM customer UNION ALL SELECT 'part', count(*), 10, 500 FROM part UNION ALL SELECT 'orders', count(*), 1, 100000 FROM orders)")
def band_check(spark: SparkSession, d: str) -> DataFrame:
    bands = {"customer": (1000, 2000), "part": (10, 500), "orders": (1, 100_000)}
    counts = None
    for t in bands:
        one = table(spark, d, t).agg(F.lit(t).alias("metric"), n().alias("n"))
        counts = one if counts is None else counts.unionByName(one)
    return checks.bands(counts, bands)


@query("shares", "AGG15", "SELECT o_orderpriority, round(avg(CASE WHEN o_totalprice > 1500 THEN 1.0 ELSE 0 END), 6) AS share FROM orders GROUP BY 1")
def shares(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(F.round(F.avg((F.col("o_totalprice") > 1500).cast("double")), 6).alias("share"))


@query("examples", "AGG16", "SELECT p_brand, list(p_partkey ORDER BY p_partkey) AS first_keys FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) rn FROM part) WHERE rn <= 5 GROUP BY 1")
def examples(spark: SparkSession, d: str) -> DataFrame:
    top = rank.top_per_group(table(spark, d, "part").select("p_brand", "p_partkey"), ["p_brand"], [F.col("p_partkey")], 5)
    return top.groupBy("p_brand").agg(F.sort_array(F.collect_list("p_partkey")).alias("first_keys"))


@query("bounded_count", "AGG17 Q9", "SELECT w AS token, least(count(*), 50) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY 1")
def bounded_count(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("token"))
    return w.groupBy("token").agg(F.least(n(), F.lit(50).cast("long")).alias("n"))


@query("sha_bytes", "AGG19 SRC22", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def sha_bytes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


@query("tile_counts", "AGG18 GTE13", f"SELECT z, count(*) AS tiles, count(DISTINCT o) AS contents, max(l) AS longest FROM (SELECT l_linenumber AS z, l_partkey AS o, l_quantity AS l FROM lineitem) GROUP BY z")
def tile_counts(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.groupBy(F.col("l_linenumber").alias("z")).agg(n().alias("tiles"), F.countDistinct("l_partkey").alias("contents"), F.max("l_quantity").alias("longest"))


# ---------------------------------------------------------------- ranks


@query("importance_rank", "SRT01 AGG14", "SELECT c_custkey, round(least(greatest(log10(greatest(c_acctbal, 0) + 1) / log10(10001), 0), 1), 4) AS importance, row_number() OVER (ORDER BY round(least(greatest(log10(greatest(c_acctbal, 0) + 1) / log10(10001), 0), 1), 4) DESC, c_custkey) AS id FROM customer")
def importance_rank(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", F.round(rank.log_share(F.col("c_acctbal"), 10_000.0), 4).alias("importance"))
    return rank.row_ids(c, [F.col("importance").desc(), F.col("c_custkey").asc()], "id")


@query("topk_per_kind", "SRT03 SRT05", "SELECT p_brand, p_partkey, rank FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part) WHERE rank <= 10")
def topk_per_kind(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_brand", "p_partkey", "p_retailprice")
    return rank.top_per_group(p, ["p_brand"], [F.col("p_retailprice").desc(), F.col("p_partkey").asc()], 10).select("p_brand", "p_partkey", "rank")


@query("composite_order", "SRT02", "SELECT o_orderkey, rank FROM (SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END, o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 25")
def composite_order(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    order = [F.when(F.col("o_orderstatus") == "P", 0).otherwise(1), F.col("o_totalprice").desc(), F.col("o_orderkey")]
    top = o.orderBy(*order).limit(25)
    return top.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order))).select("o_orderkey", "rank")


@query("first_of_n", "SRT07", "SELECT q, bool_or(hit AND rn <= 3) AS passed FROM (SELECT p_brand AS q, p_size > 45 AS hit, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) GROUP BY q")
def first_of_n(spark: SparkSession, d: str) -> DataFrame:
    top = rank.top_per_group(table(spark, d, "part"), ["p_brand"], [F.col("p_retailprice").desc(), F.col("p_partkey").asc()], 3)
    return top.groupBy(F.col("p_brand").alias("q")).agg(F.bool_or(F.col("p_size") > 45).alias("passed"))


@query("running_offsets", "SRT08", "SELECT l_orderkey, pos, sum(l_partkey) OVER w AS offset_after, lag(l_partkey) OVER w AS before FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS pos FROM lineitem) WINDOW w AS (PARTITION BY l_orderkey ORDER BY pos)")
def running_offsets(spark: SparkSession, d: str) -> DataFrame:
    own = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    rows = table(spark, d, "lineitem").withColumn("pos", F.row_number().over(own))
    w = Window.partitionBy("l_orderkey").orderBy("pos")
    return rows.select("l_orderkey", "pos", F.sum("l_partkey").over(w).alias("offset_after"), F.lag("l_partkey").over(w).alias("before"))


@query("near_minimum", "SRT10", "SELECT o_custkey, o_orderkey FROM (SELECT *, min(o_totalprice) OVER (PARTITION BY o_custkey) AS m FROM orders) WHERE o_totalprice <= m + 100")
def near_minimum(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumn("m", F.min("o_totalprice").over(Window.partitionBy("o_custkey")))
    return o.where("o_totalprice <= m + 100").select("o_custkey", "o_orderkey")


# ---------------------------------------------------------------- sets


@query("union_sources", "SET01", "SELECT 'c' || c_custkey AS id, c_acctbal AS v FROM customer UNION ALL SELECT 's' || s_suppkey, s_acctbal FROM supplier")
def union_sources(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_acctbal").alias("v"))
    return c.unionByName(table(spark, d, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("id"), F.col("s_acctbal").alias("v")))


@query("union_keep_first", "SET02 ARR09", "SELECT k, min(pos) AS pos FROM (SELECT o_custkey AS k, 0 AS pos FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT c_custkey, 1 FROM customer WHERE c_nationkey = 3 UNION ALL SELECT c_custkey, 2 FROM customer WHERE c_acctbal > 9000) GROUP BY k")
def union_keep_first(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    parts = [table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k")), c.where("c_nationkey = 3").select(F.col("c_custkey").alias("k")), c.where("c_acctbal > 9000").select(F.col("c_custkey").alias("k"))]
    rows = parts[0].withColumn("pos", F.lit(0)).unionByName(parts[1].withColumn("pos", F.lit(1))).unionByName(parts[2].withColumn("pos", F.lit(2)))
    return rows.groupBy("k").agg(F.min("pos").alias("pos"))


@query("set_difference", "SET03", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 2000")
def set_difference(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey").subtract(table(spark, d, "orders").where("o_totalprice > 2000").select("o_custkey"))


@query("set_intersection", "SET04", "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def set_intersection(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).intersect(table(spark, d, "supplier").select("s_nationkey"))


@query("all_words", "ARR10 FTS01", "SELECT p_partkey FROM part WHERE list_contains(string_split(p_name, ' '), 'red') AND list_contains(string_split(p_name, ' '), 'blue') OR p_partkey < 0")
def all_words(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose posting lists for all the words meet."""
    index = table(spark, d, "part").select("p_partkey", F.explode(F.array_distinct(F.split("p_name", " "))).alias("w")).where(F.col("w").isin("red", "blue"))
    return index.groupBy("p_partkey").agg(n().alias("k")).where("k = 2").select("p_partkey")


# ---------------------------------------------------------------- tags

_ORDER_TAGS = """(SELECT o_orderkey AS way, list_extract(['motorway','trunk','primary','secondary','tertiary','residential','service','track'], (o_orderkey % 8 + 1)::INT) AS highway, CASE o_orderstatus WHEN 'F' THEN 'yes' WHEN 'O' THEN 'no' ELSE '-1' END AS oneway,
    CASE o_custkey % 7 WHEN 0 THEN 'private' WHEN 1 THEN 'no' WHEN 2 THEN 'agricultural;destination' ELSE 'yes' END AS access, CASE o_custkey % 11 WHEN 0 THEN 'no' WHEN 1 THEN 'delivery' ELSE '' END AS mv, o_orderkey % 9 * 10 + 20 AS speed, o_orderkey % 5 AS unit FROM orders)"""


@query("match_tags_any", "FLT01 FLT02 FLT09 Q7", f"SELECT way, (highway IN ('primary', 'trunk') AND oneway = 'yes') OR access LIKE '%destination%' AS matched, mv = '' AS no_vehicle_key FROM {_ORDER_TAGS}")
def match_tags_any(spark: SparkSession, d: str) -> DataFrame:
    t = S.order_tags(spark, d)
    rule = [{"highway": ["primary", "trunk"], "oneway": ["yes"]}, {"access": ["destination"]}]
    return t.select("way", T.matches(F.col("tags"), rule).alias("matched"), T.matches(F.col("tags"), [{"!motor_vehicle": []}]).alias("no_vehicle_key"))


@query("first_rule", "FLT03", f"SELECT way, CASE WHEN highway = 'motorway' THEN 'fast' WHEN oneway = 'yes' THEN CASE WHEN way % 2 = 0 THEN 'single' END WHEN access = 'no' THEN 'shut' END AS kind FROM {_ORDER_TAGS}")
def first_rule(spark: SparkSession, d: str) -> DataFrame:
    rules = [{"kind": "fast", "match": [{"highway": ["motorway"]}]}, {"kind": "single", "match": [{"oneway": ["yes"]}], "named": True}, {"kind": "shut", "match": [{"access": ["no"]}]}]
    return S.order_tags(spark, d).select("way", T.first_rule(F.col("tags"), rules, F.col("way") % 2 == 0).alias("kind"))


@query("car_access", "PRJ04 PRJ05", f"SELECT way, CASE WHEN mv = 'no' THEN 'no' WHEN mv <> 'delivery' AND access = 'no' THEN 'no' WHEN mv = 'delivery' OR access = 'private' OR access LIKE '%destination%' THEN 'destination' ELSE 'yes' END AS access, CASE WHEN mv = 'no' OR (mv <> 'delivery' AND access = 'no') THEN 'no' ELSE 'destination' END AS after_closing FROM {_ORDER_TAGS}")
def car_access(spark: SparkSession, d: str) -> DataFrame:
    t = S.order_tags(spark, d)
    shut = t.select("way", "tags", T.car_access(F.col("tags")).alias("access"), T.destination_only(F.col("tags")).alias("shut"))
    return shut.select("way", "access", T.car_access(F.col("shut")).alias("after_closing"))


@query("speed_parse", "STR18", f"SELECT way, CASE WHEN k BETWEEN 5 AND 150 THEN k END::INT AS kmh FROM (SELECT way, CASE WHEN unit = 0 THEN round_even(speed * 1.609344, 0) ELSE speed END AS k FROM {_ORDER_TAGS})")
def speed_parse(spark: SparkSession, d: str) -> DataFrame:
    return S.order_tags(spark, d).select("way", T.maxspeed(F.col("tags")["maxspeed"]).alias("kmh"))


@query("direction_parse", "STR19 STR20", f"SELECT way, CASE WHEN way % 6 = 0 THEN 'along' WHEN way % 6 = 5 THEN 'both' ELSE 'degrees' END AS kind, CASE way % 6 WHEN 0 THEN 1.0 WHEN 1 THEN 45.0 WHEN 2 THEN 292.5 WHEN 3 THEN ((way % 400) % 360)::DOUBLE WHEN 4 THEN 180.0 END AS value, CASE oneway WHEN 'yes' THEN 1 WHEN '-1' THEN -1 ELSE 0 END AS sign FROM {_ORDER_TAGS}")
def direction_parse(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("way") % 6
    text = F.when(k == 0, "forward").when(k == 1, "NE").when(k == 2, "wnw").when(k == 3, (F.col("way") % 400).cast("string")).when(k == 4, "180").otherwise("90;270")
    t = S.order_tags(spark, d).withColumn("p", T.direction(text))
    return t.select("way", F.col("p.kind").alias("kind"), F.col("p.value").alias("value"), T.oneway(F.col("tags")).alias("sign"))


@query("tile_road_class", "FLT07 FLT08", f"SELECT way, CASE WHEN way % 3 <> 1 AND highway IN ('primary', 'trunk', 'track') AND way % 4 <> 0 THEN highway END AS class, way % 2 = 0 AS matches FROM {_ORDER_TAGS}")
def tile_road_class(spark: SparkSession, d: str) -> DataFrame:
    t = S.order_tags(spark, d)
    kind = F.when(F.col("way") % 3 == 0, F.concat(F.col("tags")["highway"], F.lit("_construction"))).when(F.col("way") % 3 == 1, F.lit("other")).otherwise(F.col("tags")["highway"])
    own = F.map_concat(F.map_filter("tags", lambda k, v: F.lit(False)), F.create_map(F.lit("ref"), F.when(F.col("way") % 2 == 0, "S 1; E 60").otherwise("S 2")))
    return t.select("way", T.tile_road(kind, F.when(F.col("way") % 4 == 0, "footway"), ("primary", "trunk", "track"), ("footway",)).alias("class"), T.road_matches(own, ref="E 60").alias("matches"))


@query("value_rules", "GTE06 GTE07 Q13", "SELECT rule, count(*) AS violations FROM (SELECT unnest([CASE WHEN NOT regexp_matches(c_name, '^Customer#[0-9]+') THEN 'name' END, CASE WHEN c_acctbal < -500 THEN 'balance' END, CASE WHEN c_nationkey NOT BETWEEN 0 AND 20 THEN 'nation' END]) AS rule FROM customer) WHERE rule IS NOT NULL GROUP BY rule")
def value_rules(spark: SparkSession, d: str) -> DataFrame:
    rules = {"name": ~F.col("c_name").rlike("^Customer#[0-9]+"), "balance": F.col("c_acctbal") < -500, "nation": ~F.col("c_nationkey").between(0, 20)}
    return checks.violations(table(spark, d, "customer"), rules)


@query("meta_equality", "GTE02 SRC24 Q1 Q12", "SELECT 'rows' AS key, '25' AS expected, CAST(count(*) AS VARCHAR) AS actual, count(*) = 25 AS passed FROM nation UNION ALL SELECT 'regions', '6', CAST(count(*) AS VARCHAR), count(*) = 6 FROM region")
def meta_equality(spark: SparkSession, d: str) -> DataFrame:
    meta = table(spark, d, "nation").agg(F.lit("rows").alias("key"), n().cast("string").alias("value")).unionByName(table(spark, d, "region").agg(F.lit("regions").alias("key"), n().cast("string").alias("value")))
    return checks.meta_equals(meta, {"rows": "25", "regions": "6"})


@query("manifest_binding", "MAN01", "SELECT key, a.v AS expected, b.v AS actual, a.v IS NOT DISTINCT FROM b.v AS passed FROM (SELECT n_name AS key, n_nationkey AS v FROM nation WHERE n_nationkey < 20) a FULL JOIN (SELECT n_name AS key, n_nationkey + CASE WHEN n_nationkey % 7 = 0 THEN 1 ELSE 0 END AS v FROM nation WHERE n_nationkey > 3) b USING (key)")
def manifest_binding(spark: SparkSession, d: str) -> DataFrame:
    na = table(spark, d, "nation")
    a = na.where("n_nationkey < 20").select(F.col("n_name").alias("key"), F.col("n_nationkey").alias("value"))
    b = na.where("n_nationkey > 3").select(F.col("n_name").alias("key"), (F.col("n_nationkey") + F.when(F.col("n_nationkey") % 7 == 0, 1).otherwise(0)).alias("value"))
    return checks.binding(a, b)


@query("release_tag", "STR24", "SELECT o_orderkey, 'v' || strftime(o_orderdate, '%Y.%m.%d') || '-' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 7) AS tag FROM orders")
def release_tag(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select("o_orderkey", checks.release_tag(F.col("o_orderdate"), F.sha2(F.col("o_orderkey").cast("string"), 256)).alias("tag"))


@query("contrast", "STR25", "SELECT p_partkey, round((greatest(a, b) + 0.05) / (least(a, b) + 0.05), 3) AS contrast FROM (SELECT p_partkey, CASE WHEN v / 255.0 <= 0.04045 THEN v / 255.0 / 12.92 ELSE pow((v / 255.0 + 0.055) / 1.055, 2.4) END AS a, 1.0 AS b FROM (SELECT p_partkey, p_partkey % 256 AS v FROM part))")
def contrast(spark: SparkSession, d: str) -> DataFrame:
    v = F.lpad(F.hex(F.col("p_partkey") % 256), 2, "0")
    colour = F.concat(F.lit("#"), v, v, v)
    return table(spark, d, "part").select("p_partkey", F.round(checks.contrast(colour, F.lit("#ffffff")), 3).alias("contrast"))


@query("route_responses", "GTE11", "SELECT o_custkey AS trip, count(*) AS legs, bool_or(o_orderstatus = 'P') AS crosses, NOT bool_or(o_orderstatus = 'P') AS passed FROM orders GROUP BY 1")
def route_responses(spark: SparkSession, d: str) -> DataFrame:
    """Recorded answers of a routing service as a table of legs: a trip passes if no leg enters the zone."""
    legs = table(spark, d, "orders").select(F.col("o_custkey").alias("trip"), (F.col("o_orderstatus") == "P").alias("crosses"))
    return checks.trips(legs)


@query("shared_names", "AGG11 AGG13 JN18", "SELECT p_name, count(*) AS n, min(p_partkey) AS root FROM part GROUP BY 1")
def shared_names(spark: SparkSession, d: str) -> DataFrame:
    """Rows of one name tied together by a star each, and counted by component."""
    p = table(spark, d, "part").select("p_name", "p_partkey")
    star = p.join(p.groupBy("p_name").agg(F.min("p_partkey").alias("first")), "p_name").select(F.col("p_partkey").alias("a"), F.col("first").alias("b"))
    roots = graph.components(star)
    return p.join(roots, p.p_partkey == roots.node).groupBy("p_name").agg(n().alias("n"), F.min("root").alias("root"))
