"""Toxicity by multiple-instance learning: noisy-or of sentence scores, trained from document labels.

A document is a bag of sentences. A sentence's probability is a logistic function of the weights of
its words and word starts; the document's is 1 - prod(1 - p). Only document labels are learned from,
and the sentence probabilities then say where the offence is.

A sentence's features are a set: a word that is said twice in it counts once, in training as in scoring.
A stretch without a sentence end is cut after WINDOW pieces, so that a long text without full stops is
still located; no word is left out.

Defined cases: a null or empty text has no sentence, so its score is 0; no usable label, or labels of
one class only, gives a model without weights, whose score is 0 for all; repeated rows each get their
own result, and of repeated labels one counts; ties of the sample's hash go by the key; other columns pass
through `score` only if named in `keep`, and one that has the name of a result gives way to it; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import columns_of, map_texts, prepare, quoted

#: A sentence ends at a full stop, mark or line end.
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")
#: Lengths of the word starts that count as features beside the word.
STARTS = (4, 5, 6)
#: Words of a sentence that are scored together; a longer stretch is cut.
WINDOW = 48


def features(word: str) -> list[str]:
    return [f"{word} ", *(word[:k] for k in STARTS if len(word) >= k)]


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Start, end and words of each sentence, long ones cut after WINDOW pieces."""
    for m in SENTENCE.finditer(text):
        words = m.group().lower().split()
        if len(words) <= WINDOW:
            if words:
                yield m.start(), m.end(), words
            continue
        spans = [x.span() for x in re.finditer(r"\S+", m.group())]
        for i in range(0, len(spans), WINDOW):
            own = spans[i : i + WINDOW]
            a, b = own[0][0], own[-1][1]
            yield m.start() + a, m.start() + b, m.group()[a:b].lower().split()


@dataclass
class Model:
    bias: float = -30.0
    weights: dict[str, float] = field(default_factory=dict)


class _Known(dict):
    """The features with a weight of each piece between blanks; filled as pieces are met, and emptied when full."""

    def __init__(self, model: Model, most: int = 400_000):
        super().__init__()
        self.weights, self.most = model.weights, most

    def __missing__(self, piece: str) -> tuple[str, ...]:
        value = tuple({f for word in WORD.findall(piece) for f in features(word) if f in self.weights})
        if len(self) >= self.most:
            self.clear()
        self[piece] = value
        return value


def _chi2(seen: list[int], of: list[int]) -> float:
    a, b, c, d = seen[1], seen[0], of[1] - seen[1], of[0] - seen[0]
    gap = max(0.0, abs(a * d - b * c) - (a + b + c + d) / 2)
    return (a + b + c + d) * gap * gap / max(1, (a + b) * (c + d) * (a + c) * (b + d))


def fit(texts: list[str], labels: list[int], epochs: int = 120, rate: float = 0.1, least_chi2: float = 12.0, l1: float = 2e-3) -> Model:
    """Full-batch proximal Adam on the noisy-or likelihood.

    Only features whose document counts depend on the label (chi-square of at least least_chi2, with
    Yates' correction) are learned from: the others are words that few documents share, and would let
    the bags be told apart by heart.
    """
    if len(set(labels)) < 2:
        return Model()
    # two passes: the counts of all features first, then only the features that are learnt from are kept
    seen: dict[str, int] = {}  # documents of label 0, and above 20 bits those of label 1
    for t, y0 in zip(texts, labels, strict=True):
        one = 1 << 20 if y0 else 1
        for f in {f for _, _, words in sentences(t or "") for p in words for w in WORD.findall(p) for f in features(w)}:
            seen[f] = seen.get(f, 0) + one
    of = [labels.count(0), labels.count(1)]
    index = {f: i for i, f in enumerate(f for f, n in seen.items() if _chi2([n & 0xFFFFF, n >> 20], of) >= least_chi2)}
    del seen
    cols, rows, owner = [], [], []
    for d, t in enumerate(texts):
        for _, _, words in sentences(t or ""):
            ids = {index[f] for p in words for w in WORD.findall(p) for f in features(w) if f in index}
            cols += ids
            rows += [len(owner)] * len(ids)
            owner.append(d)
    cols, rows, owner = np.array(cols, np.int32), np.array(rows, np.int32), np.array(owner, np.int32)
    y, n = np.array(labels, float), len(labels)
    w, b, lift = np.zeros(len(index)), -5.0, 1e-12
    mean, square, mean_b, square_b = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, epochs + 1):
        z = b + np.bincount(rows, w[cols], len(owner))
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        none = np.bincount(owner, np.log1p(-np.minimum(p, 1 - lift)), n)
        whole = np.maximum(-np.expm1(none), lift)
        g = np.where(y[owner] == 1, -p * ((1 - whole) / whole)[owner], p) / n
        grad, grad_b = np.bincount(cols, g[rows], len(w)), g.sum()
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        mean_b, square_b = 0.9 * mean_b + 0.1 * grad_b, 0.999 * square_b + 0.001 * grad_b**2
        scale = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        pace = scale / (np.sqrt(square) + 1e-4)
        w -= pace * mean
        w = np.sign(w) * np.maximum(np.abs(w) - pace * l1 / 10, 0.0)
        b -= scale * mean_b / (np.sqrt(square_b) + 1e-9)
    return Model(float(b), {f: float(w[i]) for f, i in index.items() if w[i]})


def train(docs: DataFrame, labels: DataFrame, most: int = 3000, text: str = "text", key: str = "doc_id", label: str = "toxic", most_chars: int = 30_000_000) -> Model:
    """Fits on at most `most` labelled documents, half of each class where there are enough.

    The sample is those with the smallest hash of the key, so it doesn't depend on the order of rows. Of a
    key's labels the smaller one counts, so that a text is only toxic where nobody says that it isn't.
    Only its keys are broadcast, `most` of them, and only its texts come to the driver, as many in the
    order of the hash as have `most_chars` characters together (the first one in any case).
    """
    prepare(docs.sparkSession)
    known = labels.select(F.col(quoted(key)).alias("_k"), F.col(quoted(label)).cast("int").alias("_y")).where("_k is not null and _y in (0, 1)").groupBy("_k").agg(F.min("_y").alias("_y"))
    sizes = {r._y: r.n for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    hashed = known.withColumn("_h", F.pmod(F.xxhash64("_k"), F.lit(1 << 30)))

    def pick(label: int) -> DataFrame:
        # a bound on the hash that lets a little more than enough through, so that few rows are sorted however many there are
        bound = min(1.0, (0.75 * most + 50) / max(1, sizes.get(label, 0)))
        return hashed.where((F.col("_y") == label) & (F.col("_h") < int(bound * (1 << 30)))).orderBy("_h", "_k").limit(most // 2).drop("_h")

    sample = F.broadcast(pick(0).unionByName(pick(1)))
    found = docs.select(F.col(quoted(key)).alias("_k"), F.col(quoted(text)).alias("_t")).join(sample, "_k").withColumn("_h", F.xxhash64("_k")).orderBy("_h", "_k").limit(most)
    before = Window.orderBy("_h", "_k").rowsBetween(Window.unboundedPreceding, -1)  # over `most` rows
    held = found.withColumn("_n", F.coalesce(F.sum(F.length("_t")).over(before), F.lit(0))).where(F.col("_n") < most_chars)
    rows = held.orderBy("_h", "_k").select("_t", "_y").collect()
    return fit([r._t for r in rows], [r._y for r in rows])


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text", threshold: float = 0.5) -> DataFrame:
    """keep's columns, score, predicted, n_sentences, and the spans of the sentences at or over the threshold."""

    def make():
        known, w, b = _Known(model), model.weights, model.bias
        get = known.__getitem__

        def each(texts: list) -> tuple[list, None]:
            rows = []
            for t in texts:
                z, at = [], []
                for a, e, words in sentences(t or ""):
                    have = [x for x in map(get, words) if x]
                    z.append(b + sum([w[f] for f in set().union(*have)]) if have else b)
                    at.append((a, e))
                p = 1 / (1 + np.exp(-np.clip(np.array(z), -40, 40)))
                score = float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())) if w else 0.0
                rows.append((score, int(score >= threshold), len(z), [f"{at[i][0]}:{at[i][1]}" for i in np.flatnonzero(p >= threshold)]))
            return columns_of(rows, 4), None

        return each

    return map_texts(docs, make, "score double, predicted int, n_sentences int, toxic_spans array<string>", keep, text)
