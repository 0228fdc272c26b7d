"""Every catalogue query with oracle SQL agrees with DuckDB on sf0.001 (the driver's
correctness check runs the same comparison at sf0.01)."""

import hashlib
import json
import math
import os

import duckdb
import pytest

import __spark_entry__ as se
from disparo.plans.oracle import ORACLE
from tests.conftest import SF001

TABLES = "region nation customer supplier part orders lineitem events".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return v if v is None or isinstance(v, (int, str)) else str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(se.oracle_sql()) <= set(se.queries())
    assert len(se.oracle_sql()) >= 35


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0 and "TPR" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(se.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)
