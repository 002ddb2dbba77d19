"""Whitening of embeddings by hierarchical merging of singular value decompositions.

Each task folds its vectors, batch by batch, into a summary: how many, their sums, their mean, and all singular
values and right vectors of the centred rows. Two summaries merge by stacking both sets of scaled vectors and one
further row, the difference of the means times sqrt(n1 n2 / (n1 + n2)), and decomposing that again. Nothing is cut
off, so the merged summary is that of all rows together; a summary has dimension^2 numbers however many rows it stands
for. Summaries merge eight at a time in tasks, level by level, until one is left, which the driver reads. Whitened
values come from a second pass over the rows; their covariance is measured in a further one and sent back as 8 x 8 sums.

Defined cases: rows whose vector is null, or has a null, a NaN or an infinity, are dropped; so are those of another
length than most rows have (of equally frequent lengths the shorter counts; a vector without entries has none). Entries
beyond +-2^50 saturate there. Repeated rows count and are returned as often as they come; a null id is kept.
A component whose eigenvalue is nothing but rounding (1e-13 of the largest, or less) has a null `whitened`, and no part in
identity_error. A deviation that no long can hold is null. Equal eigenvalues come in the order in which the decomposition
gives them, the same for all rows. No rows left, an empty result. A kept column that has the name of a result gives way.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from .common import fresh, map_arrow, passed, quoted, saved

#: What entries are made of: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: What whole numbers saturate at, so that sums of many stay within a long.
LIMIT = 2.0**50
#: Summaries that one task merges at a time.
FAN = 8
#: Eigenvalues at most this share of the largest are rounding.
LEAST = 1e-13
MADE = "component int, n long, deviation long, whitened double, explained double"
_STATE = "n long, sums array<long>, mean array<double>, values array<double>, vectors array<double>"


@dataclass
class Summary:
    """n rows with their exact sums, mean, and all singular values and right vectors (as rows) of what is left when the mean is taken off."""

    n: int
    sums: np.ndarray
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> Summary:
        """Of whole numbers as rows; the mean is taken off exactly, but for one rounding."""
        n, sums = len(x), x.sum(0, dtype=np.int64)
        low = sums // n
        rest = (sums - low * n) / n  # in [0, 1)
        _, values, vectors = np.linalg.svd((x - low).astype(np.float64) - rest, full_matrices=False)
        return Summary(n, sums, low + rest, values, vectors)

    def merge(self, other: Summary) -> Summary:
        n = self.n + other.n
        sums = self.sums + other.sums
        apart = (self.mean - other.mean) * np.sqrt(self.n / n * other.n)
        rows = np.concatenate([self.values[:, None] * self.vectors, other.values[:, None] * other.vectors, apart[None]])
        _, values, vectors = np.linalg.svd(rows, full_matrices=False)
        d = len(sums)
        return Summary(n, sums, sums / n, values[:d], vectors[:d])

    def row(self) -> tuple[int, list[int], list[float], list[float], list[float]]:
        return self.n, self.sums.tolist(), self.mean.tolist(), self.values.tolist(), self.vectors.ravel().tolist()

    @staticmethod
    def read(n: int, sums: list[int], mean: list[float], values: list[float], vectors: list[float]) -> Summary:
        d = len(sums)
        return Summary(int(n), np.array(sums, np.int64), np.array(mean, np.float64), np.array(values, np.float64), np.array(vectors, np.float64).reshape(-1, d))


def merged(parts: Iterable[Summary]) -> Summary | None:
    """All summaries as one, in their order."""
    out = None
    for p in parts:
        out = p if out is None else out.merge(p)
    return out


@dataclass
class Whitening:
    """The fit: eigenvalues of the covariance (falling) and their unit vectors, of n rows with these exact sums."""

    n: int
    sums: np.ndarray
    eigen: np.ndarray
    vectors: np.ndarray
    trace: float

    @staticmethod
    def of(s: Summary, most: int) -> Whitening:
        d = len(s.sums)
        eigen = np.zeros(d)
        eigen[: len(s.values)] = s.values**2 / s.n
        vectors = np.zeros((d, d))
        vectors[: len(s.vectors)] = s.vectors
        k = min(most, d)
        return Whitening(s.n, s.sums, eigen[:k], vectors[:k], float(eigen.sum()))

    @property
    def real(self) -> np.ndarray:
        return self.eigen > LEAST * max(self.eigen.max(initial=0.0), 0.0)

    def explained(self) -> list[float | None]:
        return (self.eigen / self.trace).tolist() if self.trace > 0 else [0.0] * len(self.eigen)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """A row for each vector, a column for each component; NaN where there is nothing to divide by."""
        low = self.sums // self.n
        centred = (x - low).astype(np.float64) - (self.sums - low * self.n) / self.n
        out = np.full((len(x), len(self.eigen)), np.nan)
        out[:, self.real] = centred @ self.vectors[self.real].T / np.sqrt(self.eigen[self.real])
        return out

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """sum((n x - S)^2), exact; None beyond a long."""
        low = self.sums // self.n  # n x - S = n (x - low) - rest, both small where values lie together
        rest, y = self.sums - low * self.n, x - low
        largest = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if largest * largest * x.shape[1] < 1 << 63:
            return ((self.n * y - rest) ** 2).sum(1).tolist()
        exact = [sum((self.n * a - b) ** 2 for a, b in zip(r, rest.tolist(), strict=True)) for r in y.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def whole_numbers(vectors: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    """floor(SCALE c) + SHIFT of vectors of length d, as longs."""
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, d)
    return np.clip(np.floor(SCALE * flat) + SHIFT, -LIMIT, LIMIT).astype(np.int64)


def usable(rows: DataFrame, vector: str, own: list[str]) -> DataFrame:
    """own's columns as one, and the vector as doubles (x), of rows whose vector has entries, all of them finite."""
    x = F.col(quoted(vector)).cast("array<double>")
    odd = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    held = rows.select(F.struct(F.lit(0).alias(fresh(own, "_")), *[F.col(quoted(c)) for c in own]).alias("own"), x.alias("x"))
    return held.where(F.col("x").isNotNull() & (F.size("x") > 0) & ~odd)


def fit(x: DataFrame, d: int, most: int = 8) -> Whitening | None:
    """x: one column of vectors of length d. Summaries of tasks merge level by level, in the order of their tasks."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = merged(Summary.of(whole_numbers(b.column(0), d)) for b in batches if b.num_rows)
        if got is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], to_arrow_type(f.dataType)) for v, f in zip(got.row(), schema, strict=True)], names=schema.names)

    def level(pdf: pd.DataFrame) -> pd.DataFrame:
        got = merged(Summary.read(*r) for r in pdf.sort_values("part")[schema.names].itertuples(index=False))
        return pd.DataFrame([(int(pdf["part"].min()) // FAN, *got.row())], columns=["part", *schema.names])

    schema = StructType.fromDDL(_STATE)
    parts = saved(map_arrow(x, fold, schema).select(F.spark_partition_id().cast("long").alias("part"), "*"))
    count = (parts.agg(F.max("part")).first()[0] or 0) + 1
    while count > 1:
        parts = parts.groupBy(F.floor(F.col("part") / FAN).alias("_at")).applyInPandas(level, StructType.fromDDL(f"part long, {_STATE}"))
        count = -(-count // FAN)
    last = parts.drop("part").collect()
    return Whitening.of(Summary.read(*last[0]), most) if last else None


def _moments(model: Whitening, d: int):
    k = int(model.real.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square = np.zeros(k), np.zeros((k, k))
        for b in batches:
            w = model.whitened(whole_numbers(b.column(0), d))[:, model.real]
            total += w.sum(0)
            square += w.T @ w
        flat = np.concatenate([total, square.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat)], names=["at", "v"])

    return run


def identity_error(x: DataFrame, model: Whitening, d: int) -> float:
    """The largest entry of the whitened rows' covariance minus the identity, measured over all rows."""
    k = int(model.real.sum())
    rows = {r.at: r.v for r in map_arrow(x, _moments(model, d), "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()}
    if not rows or not k:
        return 0.0
    flat = np.array([rows[i] for i in range(k + k * k)])
    mean = flat[:k] / model.n
    return float(np.abs(flat[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, vector: str = "embedding", keep: tuple[str, ...] = ("vec_id",), most: int = 8) -> DataFrame:
    """keep's columns and, a row for each of the first `most` components: component, n, deviation, whitened, explained, identity_error."""
    new = StructType.fromDDL(MADE)
    own = passed(keep, (*new.names, "identity_error"))
    held = usable(rows, vector, own)
    lengths = held.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = lengths["d"] if lengths else 0
    held = held.where(F.size("x") == d)
    schema = StructType([held.schema["own"], *new.fields])
    model = fit(held.select("x"), d, most) if d else None
    error = identity_error(held.select("x"), model, d) if model else 0.0
    kinds = [to_arrow_type(f.dataType) for f in new.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches if model else ():
            got = whole_numbers(b.column(1), d)
            m, k = len(got), len(model.eigen)
            at = pa.array(np.repeat(np.arange(m), k))
            white = model.whitened(got).ravel()
            made = [
                pa.array(np.tile(np.arange(1, k + 1), m), kinds[0]), pa.array(np.full(m * k, model.n), kinds[1]), pa.array(model.deviations(got), kinds[2]).take(at),
                pa.array(white, kinds[3], mask=np.isnan(white)), pa.array(np.tile(model.explained(), m), kinds[4]),
            ]
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), *made], names=schema.names)

    out = map_arrow(held, run, schema)
    return out.select(*[F.col(f"own.{quoted(c)}") for c in own], *new.names, F.lit(error).alias("identity_error"))
