"""Session queries and their DuckDB twins agree on awkward logs and
dimensions (NULL ids and times, duplicated and dangling users, bounds)."""

import datetime as dt
import math
import tempfile

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from visitlens.plans.catalog import QUERIES

D = dt.datetime
EVENTS = [
    # event_id, ts, user_id, event_type, value, props
    (1, D(2024, 1, 3, 0, 0, 0), 1, "view", 1.0, '{"k": 1}'),        # start bound: in
    (2, D(2024, 1, 3, 0, 0, 5), 1, "click", 1.0, '{"k": 3}'),
    (3, D(2024, 1, 4, 10, 0, 0), 1, "view", 1.0, '{"k": 2}'),
    (4, D(2024, 1, 4, 10, 30, 0), 1, "view", 1.0, None),           # keyword NULL
    (5, D(2024, 1, 28, 0, 0, 0), 1, "view", 1.0, '{"k": 5}'),       # end bound: out
    (6, None, 1, "click", 1.0, '{"k": 9}'),                         # NULL time
    (7, D(2024, 1, 6, 8, 0, 0), None, "view", 1.0, '{"k": 8}'),     # NULL user
    (8, D(2024, 1, 10, 9, 0, 0), 2, "click", 2.0, '{"k": 12}'),
    (9, D(2024, 1, 10, 9, 0, 0, 700000), 2, "click", 2.0, '{"k": 1}'),
    (10, D(2024, 1, 11, 23, 59, 59), 2, "purchase", 2.0, '{"k": 14}'),
    (11, D(2024, 1, 12, 1, 0, 0), 5, "view", 3.0, '{"k": 7}'),      # duplicated customer
    (12, D(2024, 1, 12, 1, 5, 0), 5, "signup", 3.0, '{"k": 7}'),
    (13, D(2024, 1, 20, 4, 0, 0), 9, "view", 3.0, '{"k": 8}'),      # customer without nation
    (14, D(2024, 1, 21, 4, 0, 0), 6, "click", 3.0, '{"k": 1.5}'),   # NULL balance, bad k
    (15, D(1969, 12, 31, 23, 59, 59, 500000), 4, "view", 1.0, '{"k": 4}'),
    (16, D(2024, 1, 15, 12, 0, 0), 3, "view", 1.0, '{"k": 11}'),
    (17, D(2024, 1, 15, 12, 2, 0), 3, "view", 1.0, '{"k": 21}'),
    (18, D(2024, 1, 16, 0, 0, 0), 3, "click", 1.0, '{"k": 15}'),
    (19, D(2024, 1, 15, 6, 0, 0), 0, "click", 1.0, '{"k": 92}'),
    (20, D(2024, 1, 15, 6, 0, 0), -31, "view", 1.0, '{"k": 3}'),   # negative id: grain by pmod
    (21, D(2024, 1, 16, 6, 0, 0), -1, "click", 1.0, '{"k": 3}'),
]
CUSTOMERS = [
    (0, "Customer#0", 1, 15.5, "BUILDING"),
    (1, "Customer#1", 2, 25.0, "MACHINERY"),
    (2, "Customer#2", 3, -40.25, "HOUSEHOLD"),
    (3, "Customer#3", 4, 33.0, "FURNITURE"),
    (4, "Customer#4", 0, 12.0, "AUTOMOBILE"),
    (5, "Customer#5", 1, 20.0, "BUILDING"),
    (5, "Customer#5b", 2, 45.0, "MACHINERY"),
    (6, "Customer#6", 1, None, "BUILDING"),
    (9, "Customer#9", 99, 10.0, "BUILDING"),
]
NATIONS = [(i, f"NATION_{i}", i % 5) for i in range(5)]
SKIP = {"product_status", "ship_delay_profile",
        "time_text_audit", "packed_attr_rollup", "json_props_rollup", "list_column_rollup",
        "label_counts", "ratio_rounding", "param_sql", "column_blank_profile"}


@pytest.fixture(scope="module")
def edge_dir():
    d = tempfile.mkdtemp(prefix="visitlens-session-edges-")
    ev = list(zip(*EVENTS))
    pq.write_table(pa.table({
        "event_id": pa.array(ev[0], pa.int64()), "ts": pa.array(ev[1], pa.timestamp("us")),
        "user_id": pa.array(ev[2], pa.int64()), "event_type": pa.array(ev[3], pa.string()),
        "value": pa.array(ev[4], pa.float64()), "props": pa.array(ev[5], pa.string()),
    }), f"{d}/events.parquet")
    cu = list(zip(*CUSTOMERS))
    pq.write_table(pa.table({
        "c_custkey": pa.array(cu[0], pa.int64()), "c_name": pa.array(cu[1], pa.string()),
        "c_nationkey": pa.array(cu[2], pa.int32()), "c_acctbal": pa.array(cu[3], pa.float64()),
        "c_mktsegment": pa.array(cu[4], pa.string()),
    }), f"{d}/customer.parquet")
    na = list(zip(*NATIONS))
    pq.write_table(pa.table({
        "n_nationkey": pa.array(na[0], pa.int32()), "n_name": pa.array(na[1], pa.string()),
        "n_regionkey": pa.array(na[2], pa.int32()),
    }), f"{d}/nation.parquet")
    return d


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted((set(entry.oracle_sql()) & set(QUERIES)) - SKIP))
def test_session_query_matches_twin_on_edge_data(spark, edge_dir, name):
    con = duckdb.connect()
    for t in ("events", "customer", "nation"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{edge_dir}/{t}.parquet')")
    df = entry.queries()[name](spark, edge_dir)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())
