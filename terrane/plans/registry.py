"""Where queries and their SQL twins are put by name."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
#: Operators of the inventory that a query stands for.
COVERS: dict[str, tuple[str, ...]] = {}


def shuffled(spark: SparkSession) -> None:
    """No join becomes a broadcast by itself: what is small as a file may be large once its rows are put into cells, goes through the driver then, and leaves the other side in as few tasks as its file has."""
    for conf in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(conf, "-1")


def query(name: str, covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries are called {name}")

        @functools.wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            shuffled(spark)
            return f(spark, sf_dir)

        QUERIES[name], COVERS[name] = run, tuple(covers.split())
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
