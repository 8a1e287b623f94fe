"""Every registered query against its DuckDB twin on the smallest data."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


SQL = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(rows) > 0
        return
    rel = con.sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, rows) == _rows(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 1
    assert df.columns[:2] == ["task_id", "session_count"]


def test_queries_restore_the_callers_time_zone(spark):
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, "America/Los_Angeles")
    try:
        df = entry.queries()["actions_per_hour"](spark, SF_SMALL)
        assert spark.conf.get(key) == "America/Los_Angeles"
        got = sorted(tuple(r) for r in df.collect())
    finally:
        spark.conf.set(key, before)
    want = sorted(tuple(r) for r in entry.queries()["actions_per_hour"](spark, SF_SMALL).collect())
    assert got == want


def test_ship_delay_uses_the_text_time_helpers(spark, monkeypatch):
    """Survey operators O-50..O-52 are exercised by a query."""
    from visitlens.plans import table_jobs

    used = set()
    for name in ("is_before", "is_after", "minus_seconds"):
        helper = getattr(table_jobs, name)
        monkeypatch.setattr(table_jobs, name, lambda a, b, n=name, f=helper: used.add(n) or f(a, b))
    table_jobs.ship_delay_profile_q(spark, SF_SMALL)
    assert used == {"is_before", "is_after", "minus_seconds"}
