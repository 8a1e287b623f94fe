"""Semantics of the session statistics job on hand-made tables."""

import datetime as dt

import pytest

from conftest import BASE, action, make_actions, make_users, user
from visitlens.operators.stats import STEP_BUCKETS, VISIT_BUCKETS
from visitlens.plans.session_stat import kept_sessions, run_session_task
from visitlens.sources.tasks import TaskParams, load_task, task_param_json, task_table

DAY = BASE.date()
ALL_DAYS = TaskParams(start_date=DAY, end_date=DAY + dt.timedelta(days=1))


def stat(spark, rows, users, params=ALL_DAYS):
    return run_session_task(make_actions(spark, rows), make_users(spark, users), params, 7).first().asDict()


def test_visit_bucket_edges(spark):
    lengths = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
    rows = []
    for i, v in enumerate(lengths):
        rows += [action(f"s{i}", 1, 0), action(f"s{i}", 1, v)] if v else [action(f"s{i}", 1, 0)]
    r = stat(spark, rows, [user(1)])
    n = len(lengths)
    assert r["task_id"] == 7 and r["session_count"] == n
    expected = {"1s_3s": 2, "4s_6s": 2, "7s_9s": 2, "10s_30s": 2, "30s_60s": 2,
                "1m_3m": 2, "3m_10m": 2, "10m_30m": 2, "30m": 1}
    from decimal import ROUND_HALF_UP, Decimal
    for name, _lo, _hi in VISIT_BUCKETS:
        want = float(Decimal(expected[name] / n).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
        assert r[f"visit_{name}"] == want, name
    # the zero-length visit is counted but in no bucket
    assert sum(expected.values()) == n - 1


def test_step_bucket_edges(spark):
    steps = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]
    rows = [action(f"s{i}", 1, k) for i, s in enumerate(steps) for k in range(s)]
    sessions = kept_sessions(make_actions(spark, rows), make_users(spark, [user(1)]), ALL_DAYS)
    got = {r.session_id: r.step_length for r in sessions.collect()}
    assert got == {f"s{i}": s for i, s in enumerate(steps)}
    r = stat(spark, rows, [user(1)])
    assert [r[f"step_{name}"] for name, _l, _h in STEP_BUCKETS] == [0.18, 0.18, 0.18, 0.18, 0.18, 0.09]


def test_end_date_is_exclusive_and_start_inclusive(spark):
    nxt = BASE + dt.timedelta(days=1)
    prev = BASE - dt.timedelta(days=1)
    rows = [action("a", 1, when=BASE), action("b", 1, when=nxt), action("c", 1, when=prev)]
    assert stat(spark, rows, [user(1)])["session_count"] == 1


def test_unknown_user_sessions_vanish(spark):
    rows = [action("a", 1), action("b", 2)]
    assert stat(spark, rows, [user(1)])["session_count"] == 1


def test_duplicated_user_repeats_session(spark):
    assert stat(spark, [action("a", 1)], [user(1), user(1)])["session_count"] == 2


def test_no_session_kept_gives_count_zero_and_null_ratios(spark):
    r = stat(spark, [action("a", 1)], [user(1)], TaskParams(DAY, DAY, keywords=("x",)))
    assert r["session_count"] == 0
    assert all(v is None for k, v in r.items() if k.startswith(("visit_", "step_")))


def test_one_sided_age_is_ignored(spark):
    rows = [action("a", 1), action("b", 2)]
    users = [user(1, age=10), user(2, age=70)]
    p = TaskParams(DAY, DAY + dt.timedelta(days=1), start_age=50)
    assert stat(spark, rows, users, p)["session_count"] == 2
    p = TaskParams(DAY, DAY + dt.timedelta(days=1), start_age=50, end_age=80)
    assert stat(spark, rows, users, p)["session_count"] == 1


def test_keyword_condition_drops_sessions_without_search(spark):
    rows = [action("a", 1, 0, keyword="kw1"), action("b", 1, 0), action("c", 1, 0, keyword="")]
    p = TaskParams(DAY, DAY + dt.timedelta(days=1), keywords=("kw1", "kw2"))
    assert stat(spark, rows, [user(1)], p)["session_count"] == 1


def test_distinct_sets_are_true_sets_not_substrings(spark):
    rows = [action("a", 1, 0, category=12), action("a", 1, 1, category=1),
            action("b", 1, 0, keyword="新辣道鱼火锅"), action("b", 1, 1, keyword="火锅")]
    p = TaskParams(DAY, DAY + dt.timedelta(days=1), category_ids=("1",))
    assert stat(spark, rows, [user(1)], p)["session_count"] == 1
    p = TaskParams(DAY, DAY + dt.timedelta(days=1), keywords=("火锅",))
    assert stat(spark, rows, [user(1)], p)["session_count"] == 1


def test_profession_condition_reads_profession_not_city(spark):
    rows = [action("a", 1), action("b", 2)]
    users = [user(1, professional="teacher", city="paris"), user(2, professional="paris", city="rome")]
    p = TaskParams(DAY, DAY + dt.timedelta(days=1), professionals=("paris",))
    sessions = kept_sessions(make_actions(spark, rows), make_users(spark, users), p)
    assert [r.session_id for r in sessions.collect()] == ["b"]


def test_null_attribute_fails_a_given_condition(spark):
    rows = [action("a", 1), action("b", 2)]
    users = [user(1, sex=None), user(2, sex="female")]
    p = TaskParams(DAY, DAY + dt.timedelta(days=1), sex="female")
    assert stat(spark, rows, users, p)["session_count"] == 1
    assert stat(spark, rows, users, ALL_DAYS)["session_count"] == 2


def test_result_does_not_depend_on_shuffle_partitions(spark):
    from conftest import SF_SMALL
    from visitlens.plans.session_stat import session_aggr_stat
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = session_aggr_stat(spark, SF_SMALL, task_id=2).first()
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        b = session_aggr_stat(spark, SF_SMALL, task_id=2).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b and a.session_count > 0


def test_load_task_errors(spark):
    tasks = task_table(spark, [(1, "t", task_param_json(startDate="2024-01-01")),
                               (2, "t", task_param_json(startDate="2024-01-01", endDate="2024-01-02"))])
    with pytest.raises(LookupError):
        load_task(tasks, 99)
    with pytest.raises(ValueError):
        load_task(tasks, 1)
    p = load_task(tasks, 2)
    assert p.start_date == dt.date(2024, 1, 1) and p.keywords is None


def test_task_params_parse_lists_and_blanks(spark):
    text = ('{"startDate":["2024-01-01"],"endDate":["2024-01-09"],"startAge":["x"],"endAge":["9"],'
            '"cities":["a,,b"],"sex":[""],"keywords":[],"categoryids":["3,14"]}')
    p = load_task(task_table(spark, [(5, "t", text)]), 5)
    assert p.start_age is None and p.end_age == 9
    assert p.cities == ("a", "b") and p.sex is None and p.keywords is None
    assert p.category_ids == ("3", "14")


def test_log_in_application_layout_runs_end_to_end(spark):
    """Text dates and times through the adapter."""
    from pyspark.sql import functions as F

    from conftest import SF_SMALL, text_log
    from visitlens.sources.tables import from_reference_layout, users

    log = from_reference_layout(text_log(spark, dt.date(2024, 1, 15)))
    dim = users(spark, SF_SMALL)
    p = TaskParams(dt.date(2024, 1, 15), dt.date(2024, 1, 16))
    r = run_session_task(log, dim, p, 1).first()
    n_sessions = log.select("session_id").distinct().count()
    assert r.session_count == n_sessions  # of known users only
    steps = [r[f"step_{name}"] for name, _l, _h in STEP_BUCKETS]
    assert abs(sum(steps) - 1.0) <= 0.005 * len(steps)  # every session is in one step bucket
    assert log.filter(F.col("action_time").isNull()).count() == 0


def test_profession_from_city_compat_switch(spark):
    rows = [action("a", 1), action("b", 2)]
    users = [user(1, professional="teacher", city="paris"), user(2, professional="paris", city="rome")]
    p = TaskParams(DAY, DAY + dt.timedelta(days=1), professionals=("paris",))
    compat = kept_sessions(make_actions(spark, rows), make_users(spark, users), p, profession_from_city=True)
    assert [r.session_id for r in compat.collect()] == ["a"]


def test_bad_time_text_counts_as_step_but_not_in_span(spark):
    from visitlens.operators.sessions import session_rollup
    from visitlens.sources.tables import from_reference_layout
    rows = [("2018-02-07", 1, "s", "2018-02-07 9:05:03"), ("2018-02-07", 1, "s", "2018-02-07 9:06:03"),
            ("2018-02-07", 1, "s", "2018-02-07 25:61:61"), ("2018-02-07", 1, "s", "junk")]
    log = from_reference_layout(spark.createDataFrame(rows, "date string, user_id bigint, session_id string, action_time string"))
    r = session_rollup(log, with_time_audit=True).first()
    assert (r.step_length, r.visit_length, r.bad_time_rows) == (4, 60, 2)


def test_long_form_and_flag_based_conditions_agree(spark):
    from visitlens.operators.filters import session_filter
    from visitlens.operators.sessions import (
        attach_users, session_categories, session_keywords, session_rollup, sessions_with,
    )
    rows = [action("a", 1, 0, keyword="kw1", category=3), action("a", 1, 5, category=7),
            action("b", 1, 0, keyword="kw2"), action("c", 2, 0, category=7), action(None, 2, 0, keyword="kw9", category=7)]
    users = [user(1), user(2, sex="female")]
    p = TaskParams(DAY, DAY + dt.timedelta(days=1), keywords=("kw1", "kw9"), category_ids=("7",))
    acts, dim = make_actions(spark, rows), make_users(spark, users)
    ids = lambda df: {r.session_id for r in df.collect()}
    by_pairs = ids(sessions_with(session_keywords(acts), "keyword", p.keywords)) & ids(
        sessions_with(session_categories(acts), "category_id", p.category_ids))
    by_flags = attach_users(session_rollup(acts, keywords=p.keywords, category_ids=p.category_ids), dim) \
        .filter(session_filter(p))
    assert by_pairs == ids(by_flags) == {"a", None}


@pytest.mark.parametrize("grain,unit", [("g", "dense"), ("day", "dense"), ("day", "raw")])
def test_bucket_counts_partition_the_sessions(spark, grain, unit):
    from pyspark.sql import functions as F

    from conftest import SF_ORACLE
    from visitlens.operators.sessions import session_rollup
    from visitlens.operators.stats import bucket_counts
    from visitlens.sources.tables import actions
    sessions = session_rollup(actions(spark, SF_ORACLE, grain, unit))
    c = bucket_counts(sessions).first().asDict()
    zero = sessions.filter(F.col("visit_length") == 0).count()
    visits = sum(c[f"n_visit_{n}"] for n, _l, _h in VISIT_BUCKETS)
    steps = sum(c[f"n_step_{n}"] for n, _l, _h in STEP_BUCKETS)
    assert steps == c["session_count"] > 0
    assert visits + zero == c["session_count"]


def test_application_layout_cuts_on_date_text_at_the_scan(spark):
    import contextlib
    import io

    from conftest import SF_SMALL, text_log
    from visitlens.sources.tables import from_reference_layout, users
    import tempfile
    path = tempfile.mkdtemp(prefix="visitlens-app-log-") + "/log"
    text_log(spark, dt.date(2024, 1, 15)).write.parquet(path)
    log = from_reference_layout(spark.read.parquet(path))
    p = TaskParams(dt.date(2024, 1, 15), dt.date(2024, 1, 16))
    stat = run_session_task(log, users(spark, SF_SMALL), p, 1)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        stat.explain(mode="formatted")
    assert "GreaterThanOrEqual(date,2024-01-15)" in buf.getvalue()
    assert stat.first().session_count == log.select("session_id").distinct().count()
    empty = run_session_task(log, users(spark, SF_SMALL), TaskParams(dt.date(2024, 1, 16), dt.date(2024, 1, 17)), 1)
    assert empty.first().session_count == 0


def test_stage_counts_style_left_join_ignores_duplicated_users(spark):
    from pyspark.sql import functions as F

    from visitlens.operators.sessions import session_rollup
    rows = [action("a", 1), action("a", 1, 5), action("b", 2)]
    dim = make_users(spark, [user(1), user(1), user(2)])
    wanted = dim.select("user_id").distinct().withColumn("ok", F.lit(True))
    joined = session_rollup(make_actions(spark, rows)).join(wanted, "user_id", "left")
    r = joined.agg(F.sum("step_length").alias("a"), F.count(F.lit(1)).alias("s")).first()
    assert (r.a, r.s) == (3, 2)


def test_application_layout_day_from_date_text_prefix(spark):
    from visitlens.plans.multi_task import multi_task_stats
    from visitlens.sources.tables import from_reference_layout
    from visitlens.sources.tasks import task_table
    rows = [("2024-01-15", 1, "s", "2024-01-15 9:00:00"), ("2024-01-15T00:00", 1, "s", "2024-01-15 9:00:30"),
            ("2024-01-15 ", 1, "t", "2024-01-15 10:00:00")]
    log = from_reference_layout(spark.createDataFrame(rows, "date string, user_id bigint, session_id string, action_time string"))
    assert log.filter("action_date is null").count() == 0
    p = TaskParams(dt.date(2024, 1, 15), dt.date(2024, 1, 16))
    dim = make_users(spark, [user(1)])
    single = run_session_task(log, dim, p, 1).first()
    tasks = task_table(spark, [(1, "t", task_param_json(startDate="2024-01-15", endDate="2024-01-16"))])
    multi = multi_task_stats(log, dim, tasks).first()
    assert single == multi and single.session_count == 2


def test_signed_age_parameter_like_integer_valueof(spark):
    text = '{"startDate":["2024-01-01"],"endDate":["2024-01-09"],"startAge":["+18"],"endAge":["40\\n"]}'
    p = load_task(task_table(spark, [(1, "t", text)]), 1)
    assert p.start_age == 18 and p.end_age is None
