"""Every query against its SQL twin in DuckDB, on the smallest tables; the others must run."""

import math
import os

import duckdb
import pytest

from terrane.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Long builds have tests of their own.
SLOW = {"build_streets", "build_addresses", "build_pois", "build_cameras", "build_hazards", "build_ids", "label_check", "text_score", "search_near"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")
@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n in catalog.ORACLE_SQL])
def test_like_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    want = duck.execute(catalog.ORACLE_SQL[name])
    heads = [x[0] for x in want.description]
    assert sorted(heads) == cols
    at = [heads.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")
@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in catalog.ORACLE_SQL and n not in SLOW])
def test_runs(spark, name):
    df = catalog.QUERIES[name](spark, DATA)
    rows = df.collect()
    assert rows, name
    if "problem" in df.columns:
        assert not [r for r in rows if r["problem"]]
