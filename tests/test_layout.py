"""Bucketed, date-partitioned log: same results, no session shuffle."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, text_log
from visitlens.plans.session_stat import kept_sessions, run_session_task
from visitlens.sources.layout import save_action_log
from visitlens.sources.tables import actions, from_reference_layout, users
from visitlens.sources.tasks import TaskParams


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_bucketed_log_skips_the_session_shuffle(spark):
    raw = text_log(spark, day=dt.date(2024, 1, 15)).unionByName(
        text_log(spark, day=dt.date(2024, 1, 16), seed="second day"))
    save_action_log(raw, "action_log_bucketed", buckets=8)
    bucketed = from_reference_layout(spark.table("action_log_bucketed"))
    plain = from_reference_layout(raw)
    dim = users(spark, SF_SMALL)
    p = TaskParams(dt.date(2024, 1, 16), dt.date(2024, 1, 17), keywords=("kw1", "kw4"))
    a = run_session_task(bucketed, dim, p, 1).first()
    b = run_session_task(plain, dim, p, 1).first()
    assert a == b and a.session_count > 0
    text = plan_text(kept_sessions(bucketed, dim, p))
    assert "hashpartitioning(session_id" not in text      # no shuffle for the roll-up
    assert "PartitionFilters: [isnotnull(date" in text and "2024-01-16" in text  # pruning


def test_refresh_days_replaces_only_written_dates(spark):
    from visitlens.sources.layout import refresh_days
    d1 = text_log(spark, day=dt.date(2024, 2, 1), seed="a")
    d2 = text_log(spark, day=dt.date(2024, 2, 2), seed="b")
    save_action_log(d1.unionByName(d2), "action_log_refresh", buckets=4)
    again = text_log(spark, day=dt.date(2024, 2, 2), seed="c")
    refresh_days(again, "action_log_refresh", buckets=4)
    t = spark.table("action_log_refresh")
    assert t.filter("date = '2024-02-01'").count() == d1.count()
    assert t.filter("date = '2024-02-02'").exceptAll(again.select(*t.columns)).count() == 0
    per_date_files = {}
    for f in t.inputFiles():
        day = f.split("date=")[1].split("/")[0]
        per_date_files[day] = per_date_files.get(day, 0) + 1
    assert all(n <= 4 for n in per_date_files.values()), per_date_files


def test_user_bucketed_log_and_users_need_no_shuffle(spark):
    from visitlens.sources.layout import save_users
    raw = text_log(spark, day=dt.date(2024, 3, 1), seed="u")
    save_action_log(raw, "action_log_by_user", buckets=8, bucket_col="user_id")
    save_users(users(spark, SF_SMALL), "users_by_user", buckets=8)
    log = from_reference_layout(spark.table("action_log_by_user"))
    dim = spark.table("users_by_user")
    p = TaskParams(dt.date(2024, 3, 1), dt.date(2024, 3, 2), keywords=("kw1",), sex="female")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # show the bucketed sort-merge join
    try:
        fast = run_session_task(log, dim, p, 1, by_user=True)
        text = plan_text(fast)
        got = fast.first()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = run_session_task(from_reference_layout(raw), users(spark, SF_SMALL), p, 1).first()
    assert got == want and got.session_count > 0
    assert "SortMergeJoin" in text
    assert "hashpartitioning(" not in text  # neither the roll-up nor the join shuffles


def test_many_tasks_on_user_bucketed_tables(spark):
    from visitlens.plans.multi_task import multi_task_stats
    from visitlens.sources.layout import save_users
    from visitlens.sources.tasks import task_param_json, task_table
    raw = text_log(spark, day=dt.date(2024, 3, 5), seed="m").unionByName(
        text_log(spark, day=dt.date(2024, 3, 6), seed="n"))
    save_action_log(raw, "action_log_by_user_2", buckets=8, bucket_col="user_id")
    save_users(users(spark, SF_SMALL), "users_by_user_2", buckets=8)
    tasks = task_table(spark, [
        (1, "a", task_param_json(startDate="2024-03-05", endDate="2024-03-07", keywords="kw2")),
        (2, "b", task_param_json(startDate="2024-03-06", endDate="2024-03-07", sex="male")),
    ])
    log = from_reference_layout(spark.table("action_log_by_user_2"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fast = multi_task_stats(log, spark.table("users_by_user_2"), tasks, by_user=True)
        text = plan_text(fast)
        got = sorted(fast.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = sorted(multi_task_stats(from_reference_layout(raw), users(spark, SF_SMALL), tasks).collect())
    assert got == want and got[0].session_count > 0
    assert "hashpartitioning(user_id" not in text and "hashpartitioning(session_id" not in text


def test_refresh_days_on_a_user_bucketed_log(spark):
    from visitlens.sources.layout import refresh_days
    d1 = text_log(spark, day=dt.date(2024, 4, 1), seed="p")
    save_action_log(d1, "action_log_user_refresh", buckets=4, bucket_col="user_id")
    d2 = text_log(spark, day=dt.date(2024, 4, 2), seed="q")
    refresh_days(d2, "action_log_user_refresh", buckets=4, bucket_col="user_id")
    t = spark.table("action_log_user_refresh")
    assert t.count() == d1.count() + d2.count()
    assert "Bucketed: true" in plan_text(t.groupBy("user_id").count())


@pytest.mark.parametrize("one_session", [False, True])
def test_a_hot_user_is_spread_over_buckets(spark, one_session):
    """A user with a third of the log, in many sessions or in one: no bucket
    holds twice the median, the statistics are those of the plain log, and
    only combined rows are exchanged."""
    from visitlens.sources.layout import save_spread_log
    buckets = 4
    plain = actions(spark, SF_SMALL, "day", "dense").withColumn("date", F.date_format("action_date", "yyyy-MM-dd"))
    hot = plain.where("event_id % 2 = 0").withColumn("user_id", F.lit(7).cast("bigint")).withColumn(
        "session_id", F.lit("hot") if one_session else F.concat(F.lit("hot"), (F.col("event_id") % 199).cast("string")))
    log = plain.unionByName(hot)
    name = f"action_log_spread_{int(one_session)}"
    save_spread_log(log, name, buckets)
    table = spark.table(name)
    held = sorted(r["count"] for r in table.groupBy(F.pmod(F.hash("deal"), F.lit(buckets))).count().collect())
    median = (held[1] + held[2]) / 2
    assert len(held) == buckets and held[-1] <= 2 * median, held
    plainly = sorted(r["count"] for r in log.groupBy(F.pmod(F.hash("user_id"), F.lit(buckets))).count().collect())
    assert plainly[-1] > 2 * plainly[1]  # what bucketing by user would give
    dim = users(spark, SF_SMALL)
    p = TaskParams(dt.date(2024, 1, 3), dt.date(2024, 1, 28), keywords=("kw1", "kw2", "kw5"))
    fast = run_session_task(table, dim, p, 1, spread=True)
    assert fast.first() == run_session_task(log, dim, p, 1, by_user=True).first()
    assert fast.first().session_count > 0
    # Between the scan and the first exchange: both halves of the aggregate
    # per bucket and the first half of the merge.
    lines = plan_text(kept_sessions(table, dim, p, spread=True)).split("\n\n")[0].splitlines()
    scan = next(i for i, line in enumerate(lines) if f".{name}" in line)
    below = []
    while "Exchange" not in lines[scan - 1]:
        scan -= 1
        below.append(lines[scan])
    assert sum("HashAggregate" in line for line in below) == 3, lines


def test_a_log_without_hot_users_is_dealt_by_user(spark):
    from visitlens.sources.layout import spread
    log = actions(spark, SF_SMALL, "day", "dense")
    assert spread(log, 1).where("deal <> user_id").count() == 0
    assert spread(log.where("1 = 0"), 4).count() == 0
