"""Hard negatives by branch and bound over ball trees, one tree for each partition of the rows.

A node of a tree holds the middle of its vectors, the largest distance of one from it and the labels below it, so an
anchor's inner product with anything below lies within |anchor| * radius of that with the middle, above and below.
Anchors come in blocks; each block meets each tree, and goes down it together: at each node only those are kept for
which something below can still count. For positives that is a node with the anchor's label whose upper bound is not
strictly beneath the k-th score so far; for negatives a node with another label, whose bounds meet the window of scores
and aren't strictly beneath the k-th. What trees find (k rows for each anchor at most) is ranked once more over all
trees, so a result is that of all rows.

A block is one row and so is a tree, and they meet in a join on the tree's number: no task holds more than one tree and
one block, and neither is broadcast. Scores are whole numbers, and summed exactly.

Defined cases: rows with a null key, label or vector, with no entries, or with an entry that is null, NaN or infinite take
no part, nor do those of another length than most (of equally frequent lengths the shorter). Repeated keys count once,
as the row with the smallest label, then the smallest vector. Ties go to the smaller key. An anchor without a row of its
label has no positive, one without rows in the window returns nothing; a score that a long can't hold is an error. A
positive with a score below zero has an empty window, one with zero takes scores of zero. No rows, an empty result.
Further columns are not looked at, whatever their names.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, quoted, saved

#: Rows that a tree is made for, about; rows of a leaf, at most; anchors of a block, about.
TREE, LEAF, BLOCK = 16_000, 64, 500
#: What entries are made of: floor(SCALE x).
SCALE = 256
#: Bits of the set that stands for the labels below a node.
BITS = 64


def whole_numbers(rows: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * np.asarray(rows, np.float64))


@dataclass
class Tree:
    """A ball tree as arrays: rows in the order of leaves; of each node its range of rows, its children (or -1), and its bounds."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    first: np.ndarray
    last: np.ndarray
    left: np.ndarray
    middle: np.ndarray
    radius: np.ndarray
    kinds: np.ndarray

    @staticmethod
    def build(ids: np.ndarray, labels: np.ndarray, x: np.ndarray, leaf: int = LEAF) -> Tree:
        """Nodes are cut in half along the line between two rows that lie far apart."""
        order, nodes, todo = np.arange(len(ids)), [], [(0, len(ids))]
        bit = np.uint64(1) << (labels % BITS).astype(np.uint64)
        while len(nodes) < len(todo):
            a, b = todo[len(nodes)]
            own = order[a:b]
            middle = x[own].mean(0)
            off = np.sqrt(((x[own] - middle) ** 2).sum(1))
            left = -1
            if b - a > leaf and off.max() > 0:
                pole = x[own[off.argmax()]]
                other = x[own[((x[own] - pole) ** 2).sum(1).argmax()]]
                along = x[own] @ (other - pole)
                half = (b - a) // 2
                order[a:b] = own[np.argpartition(along, half)]
                left = len(todo)
                todo += [(a, a + half), (a + half, b)]
            nodes.append((a, b, left, off.max(), np.bitwise_or.reduce(bit[own]), middle))
        cols = list(zip(*nodes, strict=True))
        return Tree(ids[order], labels[order], x[order], np.array(cols[0]), np.array(cols[1]), np.array(cols[2]), np.array(cols[5]), np.array(cols[3]), np.array(cols[4], np.uint64))


@dataclass
class Asked:
    """Questions of one block: which anchor each is of, between which scores, how many rows, with its label or with others."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    k: int
    same: bool


def search(tree: Tree, ask: Asked) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(question, id, score) of the first k rows of each question within the tree, and how many leaves' rows were scored."""
    n, k = len(ask.anchor), ask.k
    exact = max(np.abs(tree.x).max(initial=0), np.abs(ask.x).max(initial=0)) ** 2 * max(1, tree.x.shape[1])
    if exact >= 2.0**63:
        raise OverflowError("scores go beyond a long")
    kind = np.float64 if exact < 2.0**52 else np.int64
    rows, anchors = tree.x.astype(kind), ask.x.astype(kind)
    reach = np.sqrt((ask.x**2).sum(1))
    slack = 1e-9 * (1 + reach * np.sqrt((tree.x**2).sum(1)).max(initial=0))  # for the rounding of bounds
    bit = np.uint64(1) << (ask.labels % BITS).astype(np.uint64)
    low, high = ask.low.astype(np.float64), ask.high.astype(np.float64)
    ids = np.zeros((n, k), np.int64)
    scores = np.zeros((n, k), np.int64)
    have = np.zeros(n, np.int64)
    least = low.copy()  # what a row must reach: the window's lower end, or the k-th score so far
    scored, todo = 0, [(0, np.flatnonzero(low <= high))]
    while todo:
        node, q = todo.pop()
        who, inverse = np.unique(ask.anchor[q], return_inverse=True)
        mid = anchors[who].astype(np.float64) @ tree.middle[node]
        off = reach[who] * tree.radius[node] + slack[who]
        own, all_ = bit[who], tree.kinds[node]
        fits = (own & all_ != 0) if ask.same else (own != all_)
        alone = tree.labels[tree.first[node]] if not ask.same and tree.kinds[node] & (tree.kinds[node] - np.uint64(1)) == 0 else None
        if alone is not None:  # one bit may stand for several labels
            fits |= (tree.labels[tree.first[node] : tree.last[node]] != alone).any()
        keep = fits[inverse] & ((mid + off)[inverse] >= least[q]) & ((mid - off)[inverse] <= high[q])
        q, inverse = q[keep], inverse[keep]
        if not len(q):
            continue
        if tree.left[node] >= 0:
            children = [int(tree.left[node]), int(tree.left[node]) + 1]
            lean = anchors[who].astype(np.float64).sum(0) @ (tree.middle[children[0]] - tree.middle[children[1]])
            todo += [(c, q) for c in (children if lean < 0 else children[::-1])]  # the likelier one is taken first
            continue
        a, b = tree.first[node], tree.last[node]
        s = (anchors[who] @ rows[a:b].T)[inverse]
        of = ask.anchor[q]
        agree = tree.labels[a:b][None] == ask.labels[of][:, None]
        good = agree & (tree.ids[a:b][None] != ask.ids[of][:, None]) if ask.same else ~agree
        good &= (s >= least[q][:, None]) & (s <= high[q][:, None])
        scored += 1
        for i in np.flatnonzero(good.any(1)):
            j, at = q[i], np.flatnonzero(good[i])
            m = have[j]
            got_s, got_i = np.concatenate([scores[j, :m], s[i, at].astype(np.int64)]), np.concatenate([ids[j, :m], tree.ids[a:b][at]])
            best = np.lexsort((got_i, -got_s))[:k]
            m = have[j] = len(best)
            scores[j, :m], ids[j, :m] = got_s[best], got_i[best]
            if m == k:
                least[j] = max(low[j], scores[j, -1])
    there = np.arange(k)[None] < have[:, None]
    return np.nonzero(there)[0], ids[there], scores[there], scored


def _usable(rows: DataFrame, key: str, label: Column, vector: str) -> DataFrame:
    x = F.col(quoted(vector)).cast("array<double>")
    odd = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    got = rows.select(F.col(quoted(key)).cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"))
    return got.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & ~odd)


def _packed(ids, labels, x, **more) -> bytes:
    return pickle.dumps({"ids": ids, "labels": labels, "x": x, **more}, protocol=5)


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a task as one tree; keys are dealt by hash and distinct, so tasks have about TREE of them."""
    held = [b for b in batches if b.num_rows]
    if held:
        ids, labels = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in (0, 1))
        x = whole_numbers(np.concatenate([b.column(2).flatten().to_numpy(zero_copy_only=False) for b in held])).reshape(len(ids), -1)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Tree.build(ids, labels, x), protocol=5)], pa.binary())], names=["tree"])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: tuple[int, Tree | None] = (-1, None)
    for b in batches:
        for number, tree, block in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            if seen[0] != number:
                seen = number, pickle.loads(tree)
            ask = Asked(**pickle.loads(block))
            q, ids, scores, _ = search(seen[1], ask)
            who = ask.anchor[q]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (ask.ids[who], ask.low[q], ask.high[q], ids, scores)], names=["anchor", "low", "high", "id", "score"])


@dataclass
class Forest:
    """Trees over all rows, written down; the rows themselves, and how many trees there are."""

    rows: DataFrame
    trees: DataFrame
    count: int


def forest(rows: DataFrame, key: str, label: Column, vector: str) -> Forest:
    """rows -> trees of about TREE rows each, by the key's hash."""
    got = _usable(rows, key, label, vector).groupBy("id").agg(F.min(F.struct("label", "x")).alias("r")).select("id", "r.label", "r.x")
    got = saved(got)
    lengths = got.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    n = lengths["count"] if lengths else 0
    got = got.where(F.size("x") == (lengths["d"] if lengths else 0))
    trees = saved(map_arrow(got.repartition(max(1, -(-n // TREE)), "id"), _grow, "tree binary").select(F.spark_partition_id().cast("long").alias("number"), "tree"))
    return Forest(got, trees, (trees.agg(F.max("number")).first()[0] or 0) + 1)


def _blocks(questions: DataFrame, blocks: int, pack: Callable[[pd.DataFrame], bytes]) -> DataFrame:
    """questions (id, ...) -> one row for each block of anchors."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": [pack(pdf)]})

    return questions.groupBy(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("at")).applyInPandas(run, "block binary")


def _ranked(forest: Forest, blocks: DataFrame, k: int) -> DataFrame:
    """What the trees find, ranked over all of them: anchor, low, high, rank, id, score."""
    pairs = blocks.select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(forest.count - 1).cast("long"))).alias("number"))
    met = forest.trees.join(pairs, "number").select("number", "tree", "block")
    found = map_arrow(met, _find, "anchor long, low long, high long, id long, score long")
    order = Window.partitionBy("anchor", "low", "high").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def positives(forest: Forest, anchors: DataFrame, blocks: int, k: int = 5) -> DataFrame:
    """anchors (id, label, x) -> anchor, rank, id, score: the first k other rows of the same label."""

    def pack(pdf: pd.DataFrame) -> bytes:
        n, span = len(pdf), np.iinfo(np.int64)
        x = whole_numbers(np.stack(pdf["x"].to_list()))
        return _packed(pdf["id"].to_numpy(), pdf["label"].to_numpy(), x, anchor=np.arange(n), low=np.full(n, span.min), high=np.full(n, span.max), k=k, same=True)

    return _ranked(forest, _blocks(anchors, blocks, pack), k).select("anchor", "rank", "id", "score")


def mine(rows: DataFrame, key: str = "vec_id", label: Column | str = "label", vector: str = "embedding", anchor: Column | None = None, k: int = 10, near: int = 5, window: tuple[int, int] = (30, 90)) -> DataFrame:
    """For each anchor (rows of which `anchor`, a condition on `id`, holds) and each of its `near` positives the first k rows of other
    labels whose score, times 100, lies between window[0] and window[1] times the positive's."""
    trees = forest(rows, key, F.col(quoted(label)) if isinstance(label, str) else label, vector)
    anchors = trees.rows.where(F.col("id") % 100 == 0 if anchor is None else anchor)
    blocks = max(1, -(-anchors.count() // BLOCK))
    good = saved(positives(trees, anchors, blocks, near).select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    # one question for each distinct score: positives with the same score ask the same
    asked = good.groupBy("anchor").agg(F.collect_set("positive_score").alias("scores"))
    a, b = window

    def pack(pdf: pd.DataFrame) -> bytes:
        scores = [np.sort(np.asarray(s, np.int64)) for s in pdf["scores"]]
        at = np.repeat(np.arange(len(pdf)), [len(s) for s in scores])
        s = np.concatenate(scores).astype(object)
        low, high = np.array([-(-a * v // 100) for v in s], np.int64), np.array([b * v // 100 for v in s], np.int64)
        return _packed(pdf["id"].to_numpy(), pdf["label"].to_numpy(), whole_numbers(np.stack(pdf["x"].to_list())), anchor=at, low=low, high=high, k=k, same=False)

    found = _ranked(trees, _blocks(anchors.join(asked.withColumnRenamed("anchor", "id"), "id"), blocks, pack), k)
    exact = lambda share: F.lit(share).cast("decimal(20,0)") * F.col("positive_score")
    fits = good.select("*", F.ceil(exact(a) / 100).cast("long").alias("low"), F.floor(exact(b) / 100).cast("long").alias("high"))
    return fits.join(found, ["anchor", "low", "high"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
