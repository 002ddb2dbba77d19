"""Search: typed texts -> ranked rows, as joins over the inverted index.

A query is parsed on its own (few rows, plain Python); its words meet the index by the first letters of
their starts, and the starts are compared after; scores are aggregates per query and row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SearchConfig
from ..functions import fold, geo
from ..runtime import ship

HEAD = 2  # letters by which starts and keys are brought together


def parsed(queries: DataFrame, key: str = "q", text: str = "text") -> DataFrame:
    """A row for each word of each query: q, n (required words), pos, raw, keys, prefixes, is_number, required, last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = fold.folder()
        for batch in batches:
            rows = []
            for q, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                p = f.parse(t or "")
                words = [(w, True) for w in p.required] + [(w, False) for w in p.optional]
                for i, (w, required) in enumerate(words):
                    rows.append((q, len(p.required), i, w.raw, w.keys, w.prefixes, w.is_number, required, required and i == len(p.required) - 1, p.initials))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 10
            kinds = [batch.schema.field(0).type, pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.bool_(), pa.bool_(), pa.bool_(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[key, "n", "pos", "raw", "keys", "prefixes", "is_number", "required", "last", "initials"])

    kind = dict(queries.dtypes)[key]
    ship(queries.sparkSession)
    return queries.select(key, text).mapInArrow(run, f"{key} {kind}, n int, pos int, raw string, keys array<string>, prefixes array<string>, is_number boolean, required boolean, last boolean, initials array<string>")


def optional_numbers(words: DataFrame) -> DataFrame:
    """Words of a search among rows without house numbers: numbers are optional wherever other words are required."""
    out = words.withColumn("named", F.count_if(F.col("required") & ~F.col("is_number")).over(Window.partitionBy("q")).cast("int"))
    loose = (F.col("named") > 0) & F.col("is_number")
    return out.withColumn("n", F.when(F.col("named") > 0, F.col("named")).otherwise(F.col("n"))).withColumn("last", F.col("last") & ~loose).withColumn("required", F.col("required") & ~loose).drop("named")


def _starts(key: Column, prefix: Column, is_number: Column) -> Column:
    """Whether a key begins with a prefix; with letters only after it where that is a number."""
    return F.startswith(key, prefix) & (~is_number | ~F.substr(key, F.length(prefix) + 1).rlike("[^a-z]"))


def matches(words: DataFrame, index: DataFrame) -> DataFrame:
    """q, pos, id of rows that hold a key which begins with one of a word's prefixes; numbers must be equal up to a letter."""
    starts = words.where("required").select("q", "n", "pos", "is_number", F.explode("prefixes").alias("prefix"))
    head = lambda c: F.substring(c, 1, HEAD)
    short = starts.where(F.length("prefix") < HEAD)
    hits = starts.where(F.length("prefix") >= HEAD).withColumn("h", head("prefix")).join(index.withColumn("h", head("key")), "h").where(_starts(F.col("key"), F.col("prefix"), F.col("is_number"))).select("q", "n", "pos", "id")
    one = short.withColumn("h", F.substring("prefix", 1, 1)).join(index.withColumn("h", F.substring("key", 1, 1)), "h").where(_starts(F.col("key"), F.col("prefix"), F.col("is_number"))).select("q", "n", "pos", "id")
    return hits.unionByName(one).distinct()


def candidates(words: DataFrame, index: DataFrame, most: int = 80, rows: DataFrame | None = None, near: DataFrame | None = None, cities: DataFrame | None = None, cfg: SearchConfig = SearchConfig()) -> DataFrame:
    """q, id of rows that all required words match: the best `most` by id (ids follow importance), and as many as cfg.local of those in the box around the query's place.

    A query with cities has the best rows of those cities and of the box of each one's reach instead.
    rows: id, lat, lon, and city_id for cities; near: q, q_lat, q_lon; cities: q, city_id, c_lat, c_lon, reach_km.
    """
    every = matches(words, index).groupBy("q", "n", "id").agg(F.count(F.lit(1)).alias("k")).where("k = n").select("q", "id")

    def best(found: DataFrame, by: list[str], top: int) -> DataFrame:
        return found.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("id"))).where(F.col("r") <= top).select("q", "id")

    def inside(lat: str, lon: str, box: Column) -> Column:
        wide = box / F.greatest(F.lit(0.2), F.cos(F.radians(lat)))
        return F.col("lat").between(F.col(lat) - box, F.col(lat) + box) & F.col("lon").between(F.col(lon) - wide, F.col(lon) + wide)

    plain = every if cities is None else every.join(cities.select("q").distinct(), "q", "left_anti")
    if near is None:
        out = best(plain, ["q"], most)
    else:  # both ranks in one pass, since a plan that is used twice is computed twice
        box = F.lit(cfg.local_box_deg)
        placed = plain.join(near, "q", "left").join(rows.select("id", "lat", "lon"), "id", "left")
        placed = placed.withColumn("there", F.coalesce(inside("q_lat", "q_lon", box), F.lit(False)))
        both = placed.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy("id"))).withColumn("own", F.row_number().over(Window.partitionBy("q", "there").orderBy("id")))
        out = both.where((F.col("r") <= most) | (F.col("there") & (F.col("own") <= cfg.local))).select("q", "id")
        if cities is None:
            return out
    if cities is not None:
        there = every.join(cities, "q").join(rows.select("id", "lat", "lon", F.col("city_id").alias("own")), "id")
        out = out.unionByName(best(there.where("own = city_id").select("q", "id").distinct(), ["q"], most))
        km = geo.distance_m(F.col("c_lat"), F.col("c_lon"), F.col("lat"), F.col("lon")) / 1000
        boxed = there.where(inside("c_lat", "c_lon", F.col("reach_km") / 111.0))
        # of the box's best only those within the reach, or of a city of the query, are offered
        kept = boxed.withColumn("r", F.row_number().over(Window.partitionBy("q", "city_id").orderBy("id"))).where(F.col("r") <= cfg.local)
        out = out.unionByName(kept.where((km <= F.col("reach_km")) | F.coalesce(F.col("own") == F.col("city_id"), F.lit(False))).select("q", "id"))
        out = out.distinct()
    return out


def text_scores(words: DataFrame, found: DataFrame, names: DataFrame, cfg: SearchConfig = SearchConfig()) -> DataFrame:
    """q, id, text: the best name's score. names: id, name_pos, keys (array, in order).

    A word scores by its best key: whole, stem, or start (the last word is still being typed). A name
    needs all required words; what share of its own words is met counts by cfg.coverage.
    """
    keys = names.select("id", "name_pos", F.size("keys").alias("total"), F.posexplode("keys").alias("key_pos", "key"))
    pairs = found.join(keys, "id").join(words, "q")
    stems = fold.name_bases(F.col("key"))
    value = F.when(F.array_contains("keys", F.col("key")), cfg.exact).when(F.arrays_overlap(stems, F.col("prefixes")), cfg.stem).when(F.exists("prefixes", lambda p: _starts(F.col("key"), p, F.col("is_number"))), F.when(F.col("last"), cfg.prefix_last).otherwise(cfg.prefix)).otherwise(0.0)
    best = pairs.withColumn("v", value).where("v > 0").groupBy("q", "id", "name_pos", "total", "pos", "n", "required").agg(F.max("v").alias("v"), F.min_by("key_pos", F.struct((-F.col("v")).alias("v"), F.col("key_pos"))).alias("key_pos"))
    sums = best.groupBy("q", "id", "name_pos", "total", "n").agg(F.sum(F.when(F.col("required"), F.col("v")).otherwise(0.0)).alias("s"), F.count_if(F.col("required")).alias("k"), F.count_if(~F.col("required")).alias("opt"), F.count_distinct("key_pos").alias("met")).where("k = n")
    optional = words.where("not required").groupBy("q").agg(F.count(F.lit(1)).alias("typed"))
    share = F.least(F.lit(1.0), F.col("met") / F.greatest("total", F.lit(1)))
    score = (F.col("s") / F.col("n") * (1 - cfg.coverage + cfg.coverage * share) + cfg.optional_bonus * F.col("opt")) * F.when(F.coalesce("typed", F.lit(0)) > F.col("opt"), cfg.type_missing).otherwise(1.0)
    return sums.join(optional, "q", "left").groupBy("q", "id").agg(F.max(score).alias("text"))


def ranked(scores: DataFrame, rows: DataFrame, near: DataFrame | None = None, cfg: SearchConfig = SearchConfig(), limit: int | None = None) -> DataFrame:
    """q, rank, id, score: a weighted mean of text, importance and, where the query has a place, nearness. near: q, q_lat, q_lon."""
    out = scores.join(rows.select("id", "importance", "lat", "lon", *(["occupied"] if "occupied" in rows.columns else [])), "id")
    out = out.join(near, "q", "left") if near is not None else out.withColumn("q_lat", F.lit(None).cast("double")).withColumn("q_lon", F.lit(None).cast("double"))
    km = geo.distance_m(F.col("q_lat"), F.col("q_lon"), F.col("lat"), F.col("lon")) / 1000
    base = cfg.text * F.col("text") + cfg.importance * F.col("importance")
    score = F.when(F.col("q_lat").isNull(), base / (cfg.text + cfg.importance)).otherwise((base + cfg.near / (1 + km / cfg.near_km)) / (cfg.text + cfg.importance + cfg.near))
    if "occupied" in rows.columns:
        score = score * F.when(F.col("occupied") == 1, cfg.occupied_factor).otherwise(1.0)
    out = out.withColumn("score", F.round(score, 6))
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("id"))
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= (limit or cfg.limit)).select("q", "rank", "id", "score", F.round("text", 6).alias("text"))


def rarest(words: DataFrame, index: DataFrame, most: int = 500) -> DataFrame:
    """q, pos of the required word that the fewest rows match (counted up to `most`); of equals the later."""
    counts = matches(words, index).groupBy("q", "pos").agg(F.least(F.count(F.lit(1)), F.lit(most)).alias("k"))
    each = words.where("required").select("q", "pos").join(counts, ["q", "pos"], "left").withColumn("k", F.coalesce("k", F.lit(0)))
    return each.groupBy("q").agg(F.min_by("pos", F.struct(F.col("k"), (-F.col("pos")).alias("p"))).alias("pos"))


def search(queries: DataFrame, rows: DataFrame, names: DataFrame, index: DataFrame, near: DataFrame | None = None, cfg: SearchConfig = SearchConfig()) -> DataFrame:
    """q, rank, id, score, text, partial. A query that finds nothing is tried again without its rarest word."""
    words = optional_numbers(parsed(queries))
    first = ranked(text_scores(words, candidates(words, index, cfg.per_table, rows, near, cfg=cfg), names, cfg), rows, near, cfg)
    rest = words.where("n > 1").join(first.select("q").distinct(), "q", "left_anti")
    less = rest.join(rarest(rest, index).withColumnRenamed("pos", "out"), "q").where("pos != out").drop("out").withColumn("n", F.col("n") - 1)
    again = ranked(text_scores(less, candidates(less, index, cfg.per_table, rows, near, cfg=cfg), names, cfg), rows, near, cfg)
    return first.withColumn("partial", F.lit(False)).unionByName(again.withColumn("partial", F.lit(True)))


def categories(words: DataFrame, cfg: SearchConfig = SearchConfig()) -> DataFrame:
    """q, kind of queries with a category's word: whole before stem before start, the first listed of equals."""
    f = fold.folder()
    rules = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(f.keys(phrase)[0]).alias("phrase"), F.lit(kind).alias("kind")) for i, (phrase, kind) in enumerate(cfg.categories)])
    pairs = words.withColumn("c", F.explode(rules)).select("*", "c.*")  # a fixed list
    mode = F.when(F.array_contains("keys", F.col("phrase")), 0).when(F.array_contains("prefixes", fold.stem(F.col("phrase"))), 1).when(F.col("last") & F.exists("prefixes", lambda p: (F.length(p) >= 3) & F.startswith(F.col("phrase"), p)), 2)
    return pairs.withColumn("mode", mode).where("mode is not null").groupBy("q").agg(F.min(F.struct("mode", "rule", "kind"))["kind"].alias("kind"))


def exact_first(hits: DataFrame, exact: DataFrame, cfg: SearchConfig = SearchConfig()) -> DataFrame:
    """Scores of hits that an exact row of their query holds are put below it. exact: q, id, holds (ids that it holds)."""
    best = exact.join(hits.select("q", F.col("id"), F.col("score").alias("own")), ["q", "id"]).select("q", "own", F.explode("holds").alias("held"))
    caps = best.groupBy("q", F.col("held").alias("id")).agg((F.max("own") - cfg.margin).alias("cap"))
    out = hits.join(caps, ["q", "id"], "left").withColumn("held", F.least("score", F.coalesce("cap", "score")))
    order = Window.partitionBy("q").orderBy(F.col("held").desc(), F.col("score").desc(), F.col("id"))
    return out.withColumn("rank", F.row_number().over(order)).select("q", "rank", "id", F.col("held").alias("score"))


def house_fit(typed: Column, number: Column) -> Column:
    """How well a house number's key fits the typed one: equal, with a letter, longer, or not."""
    rest = F.substring(number, F.length(typed) + 1, F.lit(1))
    return F.when(number == typed, 1.0).when(F.startswith(number, typed), F.when(rest.rlike("[a-z]"), 0.85).otherwise(0.7)).otherwise(0.5)
