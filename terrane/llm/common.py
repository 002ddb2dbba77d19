"""What the corpus operators share: tables, checkpoints, names that don't clash, Arrow maps over texts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from ..runtime import checkpointed, ship

#: Rows in one Arrow batch; texts may be long, so batches are small.
BATCH_ROWS = "1000"

saved = checkpointed


def prepare(spark: SparkSession) -> None:
    """Ships this package to the executors and bounds Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    ship(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def fresh(columns: Iterable[str], name: str) -> str:
    """A name that none of the columns has, in whatever case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def passed(keep: Iterable[str], made: Iterable[str]) -> list[str]:
    """The kept columns that pass through: those with the name of a result give way to it."""
    taken = {c.lower() for c in made}
    return [c for c in keep if c.lower() not in taken]


def whole_rows(df: DataFrame) -> tuple[DataFrame, str]:
    """df with all its columns once more in a struct of a name that clashes with none, and that name."""
    name = fresh(df.columns, "_whole")
    return df.withColumn(name, F.struct(*[F.col(quoted(c)) for c in df.columns])), name


def remainder(column: str, n: int) -> Column:
    """crc32 of the value as text, modulo n; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n


def map_arrow(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    prepare(df.sparkSession)
    return df.mapInArrow(f, schema)


#: texts -> values of each new column, and the text that each row is of where that isn't one to one.
Each = Callable[[list], tuple[list, list[int] | None]]


def map_texts(docs: DataFrame, make: Callable[[], Each], made: str, keep: Iterable[str], text: str = "text") -> DataFrame:
    """keep's columns and the new ones of `made`, by a function that make() gives once for each task.

    Columns are told apart by place, so the names of `docs` can't clash with any of this; a kept column
    that has the name of a new one gives way to it.
    """
    new = StructType.fromDDL(made)
    own = passed(keep, new.names)
    rows = docs.select(*[F.col(quoted(c)) for c in own], F.col(quoted(text)).alias(fresh([*own, *new.names], "_text")))
    schema = StructType([*rows.schema.fields[:-1], *new.fields])
    kinds, names, n = [to_arrow_type(f.dataType) for f in new.fields], schema.names, len(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            got, at = each(batch.column(n).to_pylist())
            kept = [batch.column(i) for i in range(n)]
            if at is not None:
                place = pa.array(at, pa.int64())
                kept = [c.take(place) for c in kept]
            yield pa.RecordBatch.from_arrays([*kept, *(c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(got, kinds, strict=True))], names=names)

    return map_arrow(rows, run, schema)


def columns_of(rows: list[tuple], n: int) -> list:
    """Rows as n columns."""
    return list(map(list, zip(*rows, strict=True))) if rows else [[] for _ in range(n)]


def slices(texts: list, limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Runs of texts whose lengths add up to about the limit."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t or "")
        if total >= limit:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
