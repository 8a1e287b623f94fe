"""Table jobs and their DuckDB twins agree on awkward inputs too, not
only on the generated test data."""

import datetime as dt
import math
import tempfile

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry

EVENTS = [
    # event_id, ts, user_id, event_type, value, props
    (0, dt.datetime(2024, 1, 3, 9, 5, 3, 250000), 1, "click", 1.005, '{"k": 7}'),
    (13, dt.datetime(2024, 1, 3, 23, 59, 59, 999999), 1, "a|b", 2.675, '{"k": 1.5}'),
    (17, dt.datetime(1969, 12, 31, 23, 59, 59, 500000), 2, "a=b", -0.5, '{"k": "7"}'),
    (19, None, 2, "", None, "{}"),
    (23, dt.datetime(2024, 1, 4, 0, 0, 0), None, None, 1e6, '{"k": -3, "a.b": 2}'),
    (None, dt.datetime(2024, 1, 4, 7, 0, 0), 3, "view", 0.125, None),
    (35, dt.datetime(2024, 1, 4, 7, 8, 9), 3, "purchase", 3.3, '{"k": 12, "s": "x"}'),
    (65, dt.datetime(2024, 1, 5, 1, 2, 3), 4, "click", 0.0, '{"k": 70}'),
]
JOBS = ("time_text_audit", "packed_attr_rollup", "json_props_rollup", "list_column_rollup",
        "label_counts", "ratio_rounding", "param_sql", "column_blank_profile")


@pytest.fixture(scope="module")
def edge_dir():
    d = tempfile.mkdtemp(prefix="visitlens-edges-")
    cols = list(zip(*EVENTS))
    table = pa.table({
        "event_id": pa.array(cols[0], pa.int64()),
        "ts": pa.array(cols[1], pa.timestamp("us")),
        "user_id": pa.array(cols[2], pa.int64()),
        "event_type": pa.array(cols[3], pa.string()),
        "value": pa.array(cols[4], pa.float64()),
        "props": pa.array(cols[5], pa.string()),
    })
    pq.write_table(table, f"{d}/events.parquet")
    return d


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", JOBS)
def test_job_matches_twin_on_edge_rows(spark, edge_dir, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{edge_dir}/events.parquet')")
    df = entry.queries()[name](spark, edge_dir)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())
