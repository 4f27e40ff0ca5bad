"""Every registered query against its oracle SQL on DuckDB (sf0.001)."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = sorted(f[:-8] for f in os.listdir(SF) if f.endswith(".parquet")) if os.path.exists(SF) else []


def _norm(v):
    if v is None:
        return "\\N"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return [cols[i] for i in order], len(rows), hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    s = _digest(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    d = _digest([c[0] for c in res.description], res.fetchall())
    assert s == d


def test_every_reference_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["partition", "commit_ms", "committed_through", "released"]
    assert df.count() >= 0


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("name", ["offset_assign", "log_parse", "log_first_last"])
def test_session_time_zone_does_not_matter(spark, con, name):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = E.queries()[name](spark, SF)
        s = _digest(df.columns, [tuple(r) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    res = con.execute(E.oracle_sql()[name])
    assert s == _digest([c[0] for c in res.description], res.fetchall())
