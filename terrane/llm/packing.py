"""Best-fit packing of tokenised documents into fixed-length sequences under several capacities.

Each sequence has room for so many tokens, documents and so much attention cost (the sum of squared
lengths). Pieces go in order of falling length; of the open sequences that can hold a piece under every
constraint, the one is chosen whose remaining room is least (weighted norm) or whose room is most alike
to the piece's needs (weighted dot product). Full pieces are sequences of their own and aren't moved.

The others are dealt by a hash to groups of about GROUP_TOKENS, so the number of groups follows the
data, and a group's last sequences are all that packing apart can cost (under 0.1 % of sequences).

Defined cases: a null or empty text is one piece that holds only the end id; equal lengths go in order
of key and piece, a null key last; repeated rows are packed each; long texts are cut into pieces and lose
nothing; a kept column that has the name of a result gives way to it; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, fresh, map_texts, passed, prepare, quoted, saved, slices
from .wordids import tool

GROUP_TOKENS = 4_000_000


@dataclass(frozen=True)
class Limits:
    """What a sequence holds; the defaults beside tokens never bind before tokens do."""

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096 * 4096
    rule: str = "norm"
    weights: tuple[float, float, float] = (1.0, 0.02, 0.02)


def best_fit(lengths: np.ndarray, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of each piece. lengths: in the order in which to place them."""
    caps = np.array([limits.tokens, limits.documents, limits.attention], float)
    weights = np.array(limits.weights)
    if len(lengths) and (lengths.max() > limits.tokens or float(lengths.max()) ** 2 > limits.attention or limits.documents < 1):
        raise ValueError("a piece is larger than a sequence")
    least = np.minimum.accumulate(lengths[::-1])[::-1] if len(lengths) else lengths
    room = np.empty((64, 3))
    names = np.empty(64, np.int64)
    n = made = 0
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        need = np.array([size, 1.0, float(size) * size])
        at = -1
        if n:
            fits = np.flatnonzero((room[:n] >= need).all(1))
            if len(fits):
                if limits.rule == "norm":
                    cost = ((((room[fits] - need) / caps) ** 2) * weights).sum(1)
                    at = int(fits[cost.argmin()])
                else:
                    gain = ((room[fits] / caps) * (need / caps) * weights).sum(1)
                    at = int(fits[gain.argmax()])
        if at < 0:
            if n == len(room):
                room, names = np.concatenate([room, np.empty_like(room)]), np.concatenate([names, np.empty_like(names)])
            room[n], names[n], at = caps, made, n
            n, made = n + 1, made + 1
        sequence[i], offset[i] = names[at], limits.tokens - room[at, 0]
        room[at] -= need
        if room[at, 0] < least[i] or room[at, 1] < 1:  # nothing that is still to come fits
            n -= 1
            room[at], names[at] = room[n], names[n]
    return sequence, offset


def pieces(docs: DataFrame, path: str, end: int = 1, most: int = 4096, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """keep's columns and a row for each piece: piece, start, length, ids_crc32. Only longer documents are cut."""
    last = np.array([end], "<u4").tobytes()

    def make():
        encode = tool(path)

        def each(raw: list) -> tuple[list, list[int]]:
            texts = [t or "" for t in raw]
            rows, at = [], []
            for a, b in slices(texts, 4_000_000):
                for i, ids in enumerate(encode(texts[a:b]), a):
                    ids += last
                    for k in range(0, len(ids), 4 * most):
                        part = ids[k : k + 4 * most]
                        at.append(i)
                        rows.append((k // (4 * most), k // 4, len(part) // 4, zlib.crc32(part)))
            return columns_of(rows, 4), at

        return each

    return map_texts(docs, make, "piece int, start long, length long, ids_crc32 long", keep, text)


def pack(rows: DataFrame, limits: Limits = Limits(), order: tuple[str, ...] = ("doc_id", "piece"), group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """rows (with a column length) with sequence_id and offset."""
    prepare(rows.sparkSession)
    rows = saved(rows.select(*[F.col(quoted(c)) for c in passed(rows.columns, ("sequence_id", "offset"))]))
    partial = rows.where(F.col("length") < limits.tokens)
    total = partial.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // group_tokens))
    names, group = rows.columns, fresh(rows.columns, "_group")
    single = rows.where(F.col("length") >= limits.tokens).withColumn("sequence_id", -F.monotonically_increasing_id() - 1).withColumn("offset", F.lit(0).cast("long"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", *order], ascending=[False] + [True] * len(order), kind="stable")
        sequence, offset = best_fit(pdf["length"].to_numpy(np.int64), limits)
        out = pdf[names].copy()
        out["sequence_id"] = pdf[group].to_numpy(np.int64) * (1 << 32) + sequence
        out["offset"] = offset
        return out

    dealt = partial.withColumn(group, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return single.unionByName(dealt.groupBy(group).applyInPandas(run, single.schema))
