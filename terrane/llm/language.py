"""Language identification as a mixture: EM over segment likelihoods, then a penalised choice of languages.

Each language has a smoothed model of letter trigrams within words (hashed to SLOTS), counted over
every training row. A document is cut into segments of a few words; EM finds the share of each
language, and the nested sets of the largest shares compete by log-likelihood, each with the shares that
EM finds for that set alone, less a BIC penalty.

Defined cases: a null or empty text, or one without a letter, is `und` with score 0; a long text is read
whole; without training rows all are `und`; equal shares go to the language first in order; repeated rows
each get their own result; a kept column that has the name of a result gives way to it; an empty table
gives an empty result, and as training rows a model that knows no language.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, map_arrow, map_texts, quoted, slices

SLOTS = 1 << 15
#: Words of a segment, whose language is taken to be one.
SEGMENT = 4
ROUNDS = 12
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        table = np.zeros(0x110000, bool)
        table[[i for i in range(0x110000) if unicodedata.category(chr(i))[0] == "L"]] = True
        _LETTER.append(table)
    return _LETTER[0]


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of all letter trigrams, the start of each word among them, and each word's text."""
    joined = " \n ".join(t.lower() for t in texts)
    codes = np.frombuffer((" " + joined + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    owner_of_char = None
    letter = _letters()[codes]
    c = np.where(letter, codes, 32).astype(np.uint64)
    at = np.flatnonzero(letter)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = c[at - 1] * np.uint64(0x9E3779B97F4A7C15) + c[at] * np.uint64(0xC2B2AE3D27D4EB4F) + c[at + 1] * np.uint64(0x165667B19E3779F9)
    slots = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - 15)).astype(np.int64)
    starts = np.flatnonzero(~letter[at - 1])
    # the text that a word is in, by where the texts begin in the joined string
    lengths = np.array([len(t.lower()) for t in texts])
    begins = 1 + np.concatenate([[0], np.cumsum(lengths + 3)[:-1]])
    owner_of_char = np.searchsorted(begins, at[starts], "right") - 1
    return slots, starts, owner_of_char


@dataclass
class Model:
    langs: list[str] = field(default_factory=list)
    table: np.ndarray = field(default_factory=lambda: np.zeros((SLOTS, 0), np.float32))


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts trigrams by language over all rows; what reaches the driver is SLOTS rows a language at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column("t").to_pylist(), batch.column("l").to_pylist()
            for a, b in slices(texts):
                for name in set(langs[a:b]):
                    own = [t for t, x in zip(texts[a:b], langs[a:b], strict=True) if x == name]
                    got = np.bincount(_grams(own)[0], minlength=SLOTS)
                    counts[name] = counts[name] + got if name in counts else got
        for name, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["l", "slot", "n"])

    rows = docs.select(F.col(quoted(text)).alias("t"), F.col(quoted(lang)).cast("string").alias("l")).where("t is not null and l is not null")
    found = map_arrow(rows, run, "l string, slot int, n long").groupBy("l", "slot").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(found.column("l").to_pylist()))
    table = np.zeros((SLOTS, len(names)))
    if names:
        place = {x: i for i, x in enumerate(names)}
        table[found.column("slot").to_numpy(), [place[x] for x in found.column("l").to_pylist()]] = found.column("n").to_numpy()
        table = np.log((table + 0.2) / (table.sum(0) + 0.2 * SLOTS))
    return Model(names, table.astype(np.float32))


def mixtures(texts: list[str], model: Model, penalty: float = 1.0) -> list[tuple[str, float, str, int]]:
    """For each text: the language, its share, the chosen set with shares, the number of segments."""
    out: list[tuple[str, float, str, int]] = [("und", 0.0, "", 0)] * len(texts)
    slots, starts, owner = _grams(texts)
    k = len(model.langs)
    if not len(starts) or not k:
        return out
    words = np.add.reduceat(model.table[slots], starts, axis=0, dtype=np.float32)
    first = np.flatnonzero(np.diff(owner, prepend=-1))  # first word of each text that has any
    rank = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
    cut = np.flatnonzero(rank % SEGMENT == 0)
    like, owner = np.add.reduceat(words, cut, axis=0).astype(np.float64), owner[cut]
    docs = owner[np.flatnonzero(np.diff(owner, prepend=-1))]
    head = np.flatnonzero(np.diff(owner, prepend=-1))
    size = np.diff(np.append(head, len(owner)))
    whose = np.repeat(np.arange(len(docs)), size)
    top = like.max(1, keepdims=True)
    e = np.exp(np.maximum(like - top, -60.0))
    share = np.full((len(docs), k), 1.0 / k)
    active = np.ones(len(docs), bool)
    for _ in range(ROUNDS):
        rows = active[whose]
        r = share[whose[rows]] * e[rows]
        r /= r.sum(1, keepdims=True)
        own = np.flatnonzero(active)
        begins = np.concatenate([[0], np.cumsum(size[own])[:-1]])
        new = np.add.reduceat(r, begins, axis=0) / size[own][:, None]
        moved = np.abs(new - share[own]).max(1)
        share[own] = new
        active[own[moved < 1e-3]] = False
        if not active.any():
            break
    order = np.argsort(-share, axis=1, kind="stable")
    best, count, shown = np.full(len(docs), -np.inf), np.ones(len(docs), int), share.copy()
    for n in range(1, k + 1):
        if n > 1 and not (np.take_along_axis(share, order[:, n - 1 : n], 1) > 1e-12).any():
            break  # more languages add nothing but the penalty
        mask = np.zeros_like(share)
        np.put_along_axis(mask, order[:, :n], 1.0, 1)
        part = share * mask
        part /= np.maximum(part.sum(1, keepdims=True), 1e-12)
        for _ in range(ROUNDS // 2 if 1 < n < k else 0):  # EM on this set alone; one language has nothing to share, all have been through it
            r = part[whose] * e
            r /= np.maximum(r.sum(1, keepdims=True), 1e-300)
            part = np.add.reduceat(r, head, axis=0) / size[:, None]
        ll = np.add.reduceat(np.log(np.maximum((part[whose] * e).sum(1), 1e-30)) + top[:, 0], head)
        value = ll - penalty * 0.5 * (2 * n - 1) * np.log(size + 1.0)
        better = value > best + 1e-9
        best[better], count[better] = value[better], n
        shown[better] = part[better]
    for i, d in enumerate(docs):
        chosen = order[i, : count[i]]
        p = shown[i, chosen] / shown[i, chosen].sum()
        out[d] = (model.langs[chosen[0]], float(min(1.0, share[i, chosen[0]])), ",".join(f"{model.langs[j]}:{x:.3f}" for j, x in zip(chosen, p, strict=True)), int(size[i]))
    return out


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text", penalty: float = 1.0) -> DataFrame:
    """keep's columns, lang_pred, score (the language's share), mixture and n_segments."""

    def make():
        def each(raw: list) -> tuple[list, None]:
            texts = [t or "" for t in raw]
            return columns_of([x for a, b in slices(texts, 400_000) for x in mixtures(texts[a:b], model, penalty)], 4), None

        return each

    return map_texts(docs, make, "lang_pred string, score double, mixture string, n_segments int", keep, text)
