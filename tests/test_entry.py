"""Driver contract: entry() smoke check, and every registered query against
its DuckDB oracle on the smallest driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from hirelens.plans.registry import QUERIES
from hirelens.sources.tables import DRIVER_TABLES

from conftest import SF0001


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["JOB_CATEGORY", "total_jobs"]
    assert len(rows) == 3


def test_every_query_has_oracle():
    q, s = E.queries(), E.oracle_sql()
    assert set(QUERIES) <= set(s) <= set(q)


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "asDict"):
        return str(v.asDict(recursive=True))
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(str(_norm(r[i])) for i in order) for r in rows))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF0001)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, rows) == _bag(ocols, orows)


@pytest.mark.parametrize("name", ["q_job_date", "q_daily", "q_wow", "q_feed_cap", "q_ingest", "q_seniority_rules"])
def test_session_settings_do_not_change_results(spark, duck, name):
    """The driver's session may use another time zone or ANSI off; the
    date, window and cast logic must not depend on either."""
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = E.queries()[name](spark, SF0001)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.unset("spark.sql.ansi.enabled")
    rel = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert _bag(cols, rows) == _bag(ocols, rel.fetchall())
