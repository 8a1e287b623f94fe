"""Statistics sink: output layout and idempotent re-runs."""

import tempfile

from conftest import SF_SMALL
from visitlens.plans.multi_task import multi_task_stats
from visitlens.sources.sinks import to_output_layout, write_stats
from visitlens.sources.tables import actions, users
from visitlens.sources.tasks import SAMPLE_TASKS, read_tasks, task_table


def test_output_layout_columns(spark):
    stats = multi_task_stats(actions(spark, SF_SMALL), users(spark, SF_SMALL), task_table(spark))
    cols = to_output_layout(stats).columns
    assert cols[:3] == ["task_id", "create_time", "session_count"]
    assert cols[3:] == ["1s_3s", "4s_6s", "7s_9s", "10s_30s", "30s_60s", "1m_3m", "3m_10m",
                        "10m_30m", "30m", "1_3", "4_6", "7_9", "10_30", "30_60", "60"]


def test_rerun_replaces_task_rows(spark):
    out = tempfile.mkdtemp(prefix="visitlens-sink-") + "/stats"
    stats = multi_task_stats(actions(spark, SF_SMALL), users(spark, SF_SMALL), task_table(spark))
    write_stats(stats, out)
    write_stats(stats.filter("task_id in (1, 2)"), out)
    back = spark.read.parquet(out)
    assert back.count() == stats.count()
    assert back.groupBy("task_id").count().filter("count > 1").count() == 0
    write_stats(stats.filter("task_id = 3"), out, mode="append")
    assert spark.read.parquet(out).filter("task_id = 3").count() == 2


def test_task_table_round_trip(spark):
    path = tempfile.mkdtemp(prefix="visitlens-tasks-") + "/tasks"
    task_table(spark).write.parquet(path)
    assert sorted(r.task_id for r in read_tasks(spark, path).collect()) == [t[0] for t in SAMPLE_TASKS]


def test_save_stats_table_appends(spark):
    from visitlens.sources.sinks import save_stats_table
    stats = multi_task_stats(actions(spark, SF_SMALL), users(spark, SF_SMALL), task_table(spark))
    save_stats_table(stats.filter("task_id = 1"), "session_aggr_stat_test")
    save_stats_table(stats.filter("task_id = 1"), "session_aggr_stat_test")
    assert spark.table("session_aggr_stat_test").count() == 2


def test_command_line_job_writes_one_row_per_task(spark):
    from visitlens import job
    from visitlens.plans.session_stat import session_aggr_stat
    out = tempfile.mkdtemp(prefix="visitlens-job-") + "/stats"
    job.main(["--sf-dir", SF_SMALL, "--out", out, "--task-id", "1", "--task-id", "2"])
    job.main(["--sf-dir", SF_SMALL, "--out", out, "--task-id", "2"])  # re-run replaces task 2
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 2
    back = {r.task_id: r for r in rows}
    assert sorted(back) == [1, 2]
    want = session_aggr_stat(spark, SF_SMALL, task_id=2).first()
    assert back[2].session_count == want.session_count
    assert back[2]["1s_3s"] == want.visit_1s_3s and back[2]["60"] == want.step_60


def test_command_line_job_rejects_unknown_ids_and_missing_task_table(spark):
    import pytest as _pytest

    from visitlens import job
    out = tempfile.mkdtemp(prefix="visitlens-job-") + "/stats"
    with _pytest.raises(LookupError):
        job.main(["--sf-dir", SF_SMALL, "--out", out, "--task-id", "999"])
    with _pytest.raises(SystemExit):
        job.main(["--out", out, "--task-id", "1"])


def test_written_values_are_those_of_the_duckdb_twin(spark):
    import duckdb

    from visitlens.operators.stats import RATIO_COLUMNS
    from visitlens.plans.oracle import multi_task_stats_sql
    out = tempfile.mkdtemp(prefix="visitlens-sink-") + "/stats"
    stats = multi_task_stats(actions(spark, SF_SMALL, "g", "dense"), users(spark, SF_SMALL), task_table(spark))
    write_stats(stats, out)
    back = spark.read.parquet(out)
    labels = to_output_layout(stats).columns[3:]
    got = sorted(tuple(r) for r in back.select("task_id", "session_count", *[f"`{c}`" for c in labels]).collect())
    con = duckdb.connect()
    for t in ("events", "customer", "nation"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = sorted(con.sql(f"SELECT task_id, session_count, {', '.join(RATIO_COLUMNS)} FROM ({multi_task_stats_sql()})").fetchall())
    assert got == want and len(got) == len(SAMPLE_TASKS)
    assert back.where("create_time IS NULL").count() == 0


def test_a_write_that_dies_half_way_can_be_run_again(spark):
    """The first run writes tasks 1 and 2; the second dies in one of its
    tasks after others have written; readers see the first run's rows until
    the third replaces them, one row a task."""
    import pytest
    from pyspark.sql import functions as F
    out = tempfile.mkdtemp(prefix="visitlens-sink-") + "/stats"
    stats = multi_task_stats(actions(spark, SF_SMALL, "g", "dense"), users(spark, SF_SMALL), task_table(spark))
    write_stats(stats.where("task_id <= 2").withColumn("session_count", F.lit(-1)), out)
    dying = stats.repartition(4, "task_id").withColumn("session_count", F.when(
        F.col("task_id") == 2, F.raise_error(F.lit("killed")).cast("bigint")).otherwise(F.col("session_count")))
    with pytest.raises(Exception, match="killed"):
        write_stats(dying, out)
    left = spark.read.parquet(out).collect()
    assert sorted(r.task_id for r in left) == [1, 2] and {r.session_count for r in left} == {-1}
    write_stats(stats, out)
    again = {r.task_id: r.session_count for r in spark.read.parquet(out).collect()}
    assert spark.read.parquet(out).count() == len(again) == len(SAMPLE_TASKS)
    assert again == {r.task_id: r.session_count for r in stats.collect()}
