"""Physical plan checks: pushdown, pruning, no Python UDFs, hash aggregates."""

import contextlib
import io

from conftest import SF_SMALL
from visitlens.plans.catalog import QUERIES
from visitlens.plans.session_stat import session_aggr_stat


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_flagship_pushes_date_bounds_and_prunes_columns(spark):
    text = plan_text(session_aggr_stat(spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts,2024-01-03T00:00)" in text
    assert "LessThan(ts,2024-01-28T00:00)" in text
    events_schema = [line for line in text.splitlines()
                     if line.startswith("ReadSchema") and "props" in line]
    assert events_schema, text
    assert "value" not in events_schema[0] and "event_id" not in events_schema[0]


def test_flagship_uses_plain_hash_aggregates(spark):
    text = plan_text(session_aggr_stat(spark, SF_SMALL))
    assert "HashAggregate" in text
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_user_conditions_reach_the_customer_scan(spark):
    text = plan_text(session_aggr_stat(spark, SF_SMALL, task_id=6))
    assert "In(c_mktsegment, [AUTOMOBILE,FURNITURE])" in text


def test_no_python_udfs_anywhere(spark):
    for name, fn in QUERIES.items():
        text = plan_text(fn(spark, SF_SMALL))
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
            assert node not in text, (name, node)


def test_multi_task_scans_the_log_once(spark):
    text = plan_text(QUERIES["multi_task_stats"](spark, SF_SMALL))
    physical = text.split("\n\n")[0]
    assert physical.count("Scan parquet") == 3  # events once, customer, nation
    assert "SortAggregate" not in physical and "ObjectHashAggregate" not in physical


def test_sql_entry_binds_parameters_and_pushes_them(spark):
    text = plan_text(QUERIES["sql_action_range"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts,2024-01-03T00:00)" in text


def test_session_aggregate_is_partial_before_its_shuffle(spark):
    """A hot session reaches its reducer as one partial row per map task."""
    text = plan_text(session_aggr_stat(spark, SF_SMALL))
    nodes = text.split("\n\n")
    partial = [n for n in nodes if n.lstrip().startswith("(") and "HashAggregate" in n.splitlines()[0]
               and "partial_min(user_id" in n]
    assert partial, "no partial session aggregate below the exchange"
    assert "hashpartitioning(session_id" in text


def test_cluster_conf_scales_with_input():
    from visitlens.session import cluster_conf
    big, small = cluster_conf(100 * 2**40), cluster_conf(2**30)
    assert int(big["spark.sql.shuffle.partitions"]) > 10_000
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(128 * 2**20)


def test_register_views_serves_sql_text(spark):
    from visitlens.sources.tables import register_views
    register_views(spark, SF_SMALL)
    n = spark.sql(
        "SELECT count(*) AS n FROM user_visit_action a JOIN user_info u ON a.user_id = u.user_id "
        "WHERE get_json_object((SELECT first(extend_info) FROM product_info), '$.product_status') IS NOT NULL"
    ).first().n
    assert n > 0
