"""The many-task job agrees with one run per task."""

import pytest

from conftest import SF_SMALL
from visitlens.plans.multi_task import multi_task_stats
from visitlens.plans.session_stat import session_aggr_stat
from visitlens.sources.tables import actions, users
from visitlens.sources.tasks import SAMPLE_TASKS, task_param_json, task_table


def test_multi_task_equals_single_task_runs(spark):
    tasks = task_table(spark)
    multi = {r.task_id: r for r in multi_task_stats(
        actions(spark, SF_SMALL, "g", "dense"), users(spark, SF_SMALL), tasks).collect()}
    assert set(multi) == {t[0] for t in SAMPLE_TASKS}
    for tid, _name, _p in SAMPLE_TASKS:
        single = session_aggr_stat(spark, SF_SMALL, task_id=tid, tasks=tasks).first()
        assert multi[tid] == single, tid


def test_disjoint_tasks_add_up(spark):
    rows = [
        (1, "a", task_param_json(startDate="2024-01-01", endDate="2024-01-11")),
        (2, "b", task_param_json(startDate="2024-01-11", endDate="2024-01-21")),
        (3, "c", task_param_json(startDate="2024-01-21", endDate="2024-01-31")),
        (4, "all", task_param_json(startDate="2024-01-01", endDate="2024-01-31")),
        (5, "empty range", task_param_json(startDate="2024-01-05", endDate="2024-01-05")),
    ]
    got = {r.task_id: r.session_count for r in multi_task_stats(
        actions(spark, SF_SMALL, "day", "raw"), users(spark, SF_SMALL), task_table(spark, rows)).collect()}
    assert got[1] + got[2] + got[3] == got[4] > 0
    assert got[5] == 0


def test_adding_a_condition_never_raises_the_count(spark):
    rows = [
        (1, "dates", task_param_json(startDate="2024-01-01", endDate="2024-01-31")),
        (2, "+sex", task_param_json(startDate="2024-01-01", endDate="2024-01-31", sex="male")),
        (3, "+kw", task_param_json(startDate="2024-01-01", endDate="2024-01-31", sex="male", keywords="kw1,kw2")),
    ]
    got = {r.task_id: r.session_count for r in multi_task_stats(
        actions(spark, SF_SMALL), users(spark, SF_SMALL), task_table(spark, rows)).collect()}
    assert got[1] >= got[2] >= got[3]


def test_undated_task_is_rejected(spark):
    rows = [(1, "x", task_param_json(startDate="2024-01-01"))]
    with pytest.raises(ValueError):
        multi_task_stats(actions(spark, SF_SMALL), users(spark, SF_SMALL), task_table(spark, rows))


def test_tasks_sharing_a_range_match_single_runs(spark):
    rows = [
        (1, "a", task_param_json(startDate="2024-01-02", endDate="2024-01-20")),
        (2, "b", task_param_json(startDate="2024-01-02", endDate="2024-01-20", sex="female", keywords="kw3")),
        (3, "c", task_param_json(startDate="2024-01-02", endDate="2024-01-20", categoryids="1,2,3,4,5")),
        (4, "a again", task_param_json(startDate="2024-01-02", endDate="2024-01-20")),
    ]
    tasks = task_table(spark, rows)
    log, dim = actions(spark, SF_SMALL, "g", "dense"), users(spark, SF_SMALL)
    multi = {r.task_id: r for r in multi_task_stats(log, dim, tasks).collect()}
    for tid in (1, 2, 3, 4):
        single = session_aggr_stat(spark, SF_SMALL, task_id=tid, tasks=tasks).first()
        assert multi[tid] == single, tid
    assert multi[1][1:] == multi[4][1:]


FAR_APART = [
    (1, "early", task_param_json(startDate="2024-01-02", endDate="2024-01-04", sex="male")),
    (2, "late", task_param_json(startDate="2024-01-27", endDate="2024-01-29", keywords="kw1,kw4")),
    (3, "overlaps late", task_param_json(startDate="2024-01-28", endDate="2024-01-30")),
]


def test_log_is_cut_to_the_union_of_task_ranges(spark):
    import contextlib
    import io
    df = multi_task_stats(actions(spark, SF_SMALL), users(spark, SF_SMALL), task_table(spark, FAR_APART))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    assert "2024-01-02T00:00" in text and "2024-01-04T00:00" in text and "2024-01-27T00:00" in text
    assert "2024-01-30T00:00" in text and "Or(" in text


def test_duplicate_task_ids_are_rejected(spark):
    rows = [(1, "a", task_param_json(startDate="2024-01-01", endDate="2024-01-05")),
            (1, "b", task_param_json(startDate="2024-01-01", endDate="2024-01-09"))]
    with pytest.raises(LookupError):
        multi_task_stats(actions(spark, SF_SMALL), users(spark, SF_SMALL), task_table(spark, rows))


def test_many_random_tasks_match_the_duckdb_twin(spark, monkeypatch):
    """A table of 120 random tasks (category vocabulary above 64; many
    shared and overlapping ranges) against
    the brute-force DuckDB query over the same task rows."""
    import random

    import duckdb

    from conftest import SF_ORACLE
    from visitlens.plans import oracle
    rnd = random.Random(11)
    rows = []
    for tid in range(1, 121):
        s = rnd.randint(1, 28)
        p = {"startDate": f"2024-01-{s:02d}", "endDate": f"2024-01-{min(31, s + rnd.randint(0, 9)):02d}"}
        if rnd.random() < 0.3:
            p["startAge"], p["endAge"] = str(rnd.randint(0, 30)), str(rnd.randint(30, 59))
        if rnd.random() < 0.3:
            p["sex"] = rnd.choice(["male", "female"])
        if rnd.random() < 0.3:
            p["cities"] = ",".join(f"NATION_{i}" for i in rnd.sample(range(25), 6))
        if rnd.random() < 0.4:
            p["keywords"] = ",".join(f"kw{i}" for i in rnd.sample(range(10), 3))
        if rnd.random() < 0.5:
            p["categoryids"] = ",".join(str(i) for i in rnd.sample(range(100), 8))
        rows.append((tid, f"t{tid}", task_param_json(**p)))
    got = sorted(tuple(r) for r in multi_task_stats(
        actions(spark, SF_ORACLE, "g", "dense"), users(spark, SF_ORACLE), task_table(spark, rows)).collect())
    monkeypatch.setattr(oracle, "SAMPLE_TASKS", tuple(rows))
    con = duckdb.connect()
    for t in ("events", "customer", "nation"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    want = sorted(tuple(r) for r in con.sql(oracle.multi_task_stats_sql()).fetchall())
    assert got == want and len(got) == 120


def test_profession_from_city_switch_in_many_task_job(spark):
    from visitlens.plans.session_stat import run_session_task
    from visitlens.sources.tasks import load_task
    rows = [(1, "p", task_param_json(startDate="2024-01-01", endDate="2024-01-31",
                                     professionals="NATION_1,NATION_2,NATION_3"))]
    tasks = task_table(spark, rows)
    log, dim = actions(spark, SF_SMALL), users(spark, SF_SMALL)
    multi = multi_task_stats(log, dim, tasks, profession_from_city=True).first()
    single = run_session_task(log, dim, load_task(tasks, 1), 1, profession_from_city=True).first()
    plain = multi_task_stats(log, dim, tasks).first()
    assert multi == single and multi.session_count > 0 and plain.session_count == 0


def plain_stats(rows, dim, tasks, by_user):
    """session_count per task, by loops over the rows."""
    import datetime as dt
    import json

    out = {}
    for tid, _n, text in tasks:
        p = {k: v[0] for k, v in json.loads(text).items()}
        lo, hi = dt.date.fromisoformat(p["startDate"]), dt.date.fromisoformat(p["endDate"])
        kept = [r for r in rows if lo <= r[1] < hi]
        sessions = {}
        for r in kept:
            sessions.setdefault((r[2], r[3]) if by_user else r[3], []).append(r)
        n = 0
        for rs in sessions.values():
            uid = min(r[2] for r in rs)
            if uid not in dim:
                continue
            if "keywords" in p and not {r[5] for r in rs} & set(p["keywords"].split(",")):
                continue
            if "categoryids" in p and not {str(r[6]) for r in rs} & set(p["categoryids"].split(",")):
                continue
            n += 1
        out[tid] = n
    return out


@pytest.mark.parametrize("by_user", [False, True])
@pytest.mark.parametrize("size", [1, 64, 65, 500])
def test_vocabularies_of_any_size_with_shared_session_ids(spark, by_user, size):
    import datetime as dt
    import random

    from conftest import action, make_actions, make_users, user
    rnd = random.Random(size)
    words = [f"w{i}" for i in range(size + 5)]
    rows = [action(f"s{rnd.randrange(12)}", rnd.randrange(1, 6), rnd.randrange(9000), keyword=rnd.choice(words + [None]),
                   category=rnd.choice([None, *range(size + 5)]),
                   when=dt.datetime(2024, 1, rnd.randrange(1, 15), 9)) for _ in range(250)]
    tasks = [(t, "t", task_param_json(
        startDate=f"2024-01-{a:02d}", endDate=f"2024-01-{a + rnd.randrange(0, 8):02d}",
        **({"keywords": ",".join(rnd.sample(words[:size], min(size, 1 + size // 3)))} if t % 2 else {}),
        **({"categoryids": ",".join(map(str, rnd.sample(range(size), min(size, 1 + size // 4))))} if t % 3 else {})))
        for t, a in ((t, rnd.randrange(1, 14)) for t in range(1, 9))]
    tasks.append((9, "all values", task_param_json(startDate="2024-01-01", endDate="2024-01-15",
                                                   keywords=",".join(words[:size]),
                                                   categoryids=",".join(map(str, range(size))))))
    got = multi_task_stats(make_actions(spark, rows), make_users(spark, [user(i) for i in range(1, 5)]),
                           task_table(spark, tasks), by_user=by_user)
    assert {r.task_id: r.session_count for r in got.collect()} == plain_stats(rows, set(range(1, 5)), tasks, by_user)


def test_one_scan_whatever_the_vocabulary(spark):
    for n in (3, 100):
        rows = [(1, "a", task_param_json(startDate="2024-01-01", endDate="2024-01-20",
                                         categoryids=",".join(map(str, range(n))), keywords="kw1"))]
        df = multi_task_stats(actions(spark, SF_SMALL), users(spark, SF_SMALL), task_table(spark, rows))
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("event_type") and df._jdf.queryExecution().executedPlan().toString().count("events.parquet") == 1


@pytest.mark.parametrize("n", [1, 300, 3000])
def test_many_ranges_give_the_rows_of_single_runs(spark, n):
    import datetime as dt
    import random

    from conftest import action, make_actions, make_users, user
    rnd = random.Random(n)
    first = dt.date(2020, 1, 1)
    rows = [action(f"s{rnd.randrange(30)}", rnd.randrange(1, 5), rnd.randrange(9000),
                   when=dt.datetime(2020, 1, 1, 9) + dt.timedelta(days=rnd.randrange(2000))) for _ in range(300)]
    tasks = []
    for t in range(n):
        a = first + dt.timedelta(days=rnd.randrange(1990))
        tasks.append((t, "t", task_param_json(startDate=str(a), endDate=str(a + dt.timedelta(days=rnd.randrange(1, 6))))))
    got = multi_task_stats(make_actions(spark, rows), make_users(spark, [user(i) for i in range(1, 5)]), task_table(spark, tasks))
    assert {r.task_id: r.session_count for r in got.collect()} == plain_stats(rows, {1, 2, 3, 4}, tasks, False)


def test_broken_dates_are_rejected_by_both_forms(spark):
    import datetime as dt

    from conftest import make_users, user
    from visitlens.plans.session_stat import run_session_task
    from visitlens.sources.tables import from_reference_layout, layout_audit
    from visitlens.sources.tasks import load_task
    raw = spark.createDataFrame(
        [("2024-01-0x", 1, "a", "2024-01-01 09:00:00", None, None), ("2024-01-05", 1, "b", "junk", "k", 3),
         ("2024-01-05", 1, "b", "2024-01-05 9:00:07", None, None), (None, 1, "c", None, None, None)],
        "date string, user_id bigint, session_id string, action_time string, search_keyword string, click_category_id bigint")
    log, dim = from_reference_layout(raw), make_users(spark, [user(1)])
    tasks = task_table(spark, [(1, "t", task_param_json(startDate="2024-01-01", endDate="2024-01-31"))])
    single = run_session_task(log, dim, load_task(tasks, 1), 1).first()
    assert multi_task_stats(log, dim, tasks).first() == single and single.session_count == 1
    assert {r.reason: r.n for r in layout_audit(raw).collect()} == {
        "kept_rows": 2, "sessions": 1, "bad_date": 2, "bad_time": 1}
    assert dt.date(2024, 1, 5) in {r.action_date for r in log.collect()}


def test_shuffle_does_not_grow_with_the_ranges(spark):
    """Sessions are dealt by session and day only; pairs of a session and a
    range are never exchanged."""
    df = multi_task_stats(actions(spark, SF_SMALL), users(spark, SF_SMALL), task_table(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("session_id" in line for line in dealt) and any("task_id" in line for line in dealt)
    assert not any("session_id" in line and "start_date" in line for line in dealt)


def random_log(rnd, n, sessions, days, words=("a", "b", None), categories=(1, 2, None)):
    import datetime as dt

    from conftest import action
    return [action(f"s{rnd.randrange(sessions)}", rnd.randrange(1, 6), rnd.randrange(9000), keyword=rnd.choice(words),
                   category=rnd.choice(categories), when=dt.datetime(2020, 1, 1, 9) + dt.timedelta(days=rnd.randrange(days)))
            for _ in range(n)]


def test_no_pair_of_session_and_range_is_exchanged(spark):
    """3,000 ranges, many of which cut sessions: planned in seconds, the same
    rows, and only (session, piece, value), session, user and counts are
    dealt."""
    import datetime as dt
    import random
    import time

    from conftest import make_actions, make_users, user
    rnd = random.Random(7)
    rows = random_log(rnd, 400, 60, 900)
    tasks = []
    for t in range(3000):
        a = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(890))
        p = {"startDate": str(a), "endDate": str(a + dt.timedelta(days=rnd.randrange(0, 400)))}
        if t % 5 == 0:
            p["keywords"] = rnd.choice(["a", "b", "a,b", "c"])
        if t % 7 == 0:
            p["categoryids"] = rnd.choice(["1", "2", "1,2", "3"])
        tasks.append((t, "t", task_param_json(**p)))
    log, dim = make_actions(spark, rows), make_users(spark, [user(i) for i in range(1, 5)])
    began = time.time()
    got = multi_task_stats(log, dim, task_table(spark, tasks))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert time.time() - began < 60
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("session_id" in line for line in dealt) == 2
    first, = [line for line in dealt if "session_id" in line and "piece" in line]
    assert "value" in first
    assert not any("start_date" in line or "end_date" in line for line in dealt)
    assert not any("session_id" in line and "task_id" in line for line in dealt)
    assert {r.task_id: r.session_count for r in got.collect()} == plain_stats(rows, {1, 2, 3, 4}, tasks, False)


def plan_size(df) -> int:
    return len(df._jdf.queryExecution().optimizedPlan().toString())


def test_listed_values_are_rows_not_plan(spark):
    import random

    from conftest import make_actions, make_users, user
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(100_000)]
    rows = random_log(rnd, 300, 40, 20, words[::1000] + ["other", None], [1, 2, 99_999, None])
    log, dim = make_actions(spark, rows), make_users(spark, [user(i) for i in range(1, 5)])
    sizes = []
    for n in (10, 100_000):
        tasks = [(t, "t", task_param_json(startDate="2020-01-01", endDate=f"2020-01-{10 + t}",
                                          keywords=",".join(words[t:n:1 + t]), categoryids=",".join(map(str, range(t, n)))))
                 for t in range(3)]
        got = multi_task_stats(log, dim, task_table(spark, tasks))
        assert {r.task_id: r.session_count for r in got.collect()} == plain_stats(rows, {1, 2, 3, 4}, tasks, False)
        sizes.append(plan_size(got))
    # The task table itself is data in the plan; nothing else is larger.
    assert sizes[1] < 1.2 * sizes[0] + 1000


def test_without_broadcast_the_rows_are_the_same(spark, monkeypatch):
    import random

    from conftest import make_actions, make_users, user
    from visitlens.plans import multi_task
    rnd = random.Random(5)
    rows = random_log(rnd, 200, 30, 15)
    tasks = [(t, "t", task_param_json(startDate=f"2020-01-{1 + t:02d}", endDate=f"2020-01-{6 + t:02d}",
                                      **({"keywords": "a,c"} if t % 2 else {}))) for t in range(6)]
    monkeypatch.setattr(multi_task, "TASK_BYTES", 0)
    got = multi_task_stats(make_actions(spark, rows), make_users(spark, [user(i) for i in range(1, 5)]), task_table(spark, tasks))
    assert {r.task_id: r.session_count for r in got.collect()} == plain_stats(rows, {1, 2, 3, 4}, tasks, False)


def test_distant_spans_are_joined_beyond_a_number():
    import datetime as dt

    from visitlens.plans.multi_task import _fewer
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    spans = [(day(0), day(2)), (day(5), day(6)), (day(7), day(9)), (day(30), day(31))]
    assert _fewer(spans, 4) == spans
    assert _fewer(spans, 3) == [spans[0], (day(5), day(9)), spans[3]]
    assert _fewer(spans, 1) == [(day(0), day(31))]


def test_bad_tasks_are_told_and_the_others_run(spark):
    import random

    from conftest import make_actions, make_users, user
    from visitlens.plans.multi_task import task_outcomes
    from visitlens.sources.tasks import rejected_tasks
    rnd = random.Random(9)
    rows = random_log(rnd, 200, 30, 15)
    good = [(t, "t", task_param_json(startDate=f"2020-01-{1 + t % 9:02d}", endDate=f"2020-01-{4 + t % 9:02d}")) for t in range(48)]
    bad = [(100, "no start", task_param_json(endDate="2020-01-09")), (101, "one", good[0][2]), (101, "two", good[1][2]),
           (102, "not a date", task_param_json(startDate="2020-02-31", endDate="soon")), (103, "no text", None),
           (104, "broken text", "{\"startDate\": [")]
    tasks = task_table(spark, good + bad)
    log, dim = make_actions(spark, rows), make_users(spark, [user(i) for i in range(1, 5)])
    with pytest.raises(ValueError):
        multi_task_stats(log, dim, tasks)
    stats = multi_task_stats(log, dim, tasks, bad_tasks="skip")
    told = sorted(tuple(r) for r in rejected_tasks(tasks).select("task_id", "reason").collect())
    undated = "no valid startDate / endDate"
    assert told == [(100, undated), (101, "task id is not unique"), (101, "task id is not unique"), (102, undated),
                    (103, undated), (104, undated)]
    out = task_outcomes(stats, rejected_tasks(tasks)).collect()
    assert {r.task_id: r.session_count for r in out if r.outcome == "done"} == plain_stats(rows, {1, 2, 3, 4}, good, False)
    assert len(out) == 54
    assert rejected_tasks(task_table(spark, good)).count() == 0


def test_job_writes_rejects_beside_the_statistics(spark):
    import tempfile

    from visitlens import job
    from visitlens.sources.tasks import TASKS_WITH_BAD_ONES
    top = tempfile.mkdtemp(prefix="visitlens-rejects-")
    task_table(spark, TASKS_WITH_BAD_ONES).write.parquet(f"{top}/tasks")
    args = ["--sf-dir", SF_SMALL, "--tasks", f"{top}/tasks", "--out", f"{top}/stats"]
    with pytest.raises(ValueError):
        job.main(args)
    job.main([*args, "--rejects", f"{top}/rejects"])
    assert sorted(r.task_id for r in spark.read.parquet(f"{top}/stats").collect()) == [t[0] for t in SAMPLE_TASKS]
    assert sorted(r.task_id for r in spark.read.parquet(f"{top}/rejects").collect()) == [90, 91, 91]


@pytest.mark.parametrize("by_user", [False, True])
def test_users_that_stand_several_times_repeat_their_sessions(spark, by_user):
    """As a join does, also where users share a session: each time that the
    smallest user of a range stands in the dimension and fits counts."""
    import random

    from conftest import make_actions, make_users, user
    rnd = random.Random(4)
    rows = random_log(rnd, 150, 25, 12)
    dim = [user(1), user(2, sex="female"), user(2, age=50), user(2, age=60), user(4), user(4, sex="female"), user(5, age=11)]
    tasks = [(t, "t", task_param_json(startDate=f"2020-01-{1 + t % 7:02d}", endDate=f"2020-01-{5 + t:02d}",
                                      **({"sex": "female"} if t % 2 else {}), **({"keywords": "a"} if t % 3 == 0 else {}),
                                      **({"startAge": "20", "endAge": "55"} if t % 4 == 0 else {}))) for t in range(8)]
    want = {}
    for tid, _n, text in tasks:
        import json
        p = {k: v[0] for k, v in json.loads(text).items()}
        sessions = {}
        for r in rows:
            if p["startDate"] <= str(r[1]) < p["endDate"]:
                sessions.setdefault((r[2], r[3]) if by_user else r[3], []).append(r)
        want[tid] = sum(
            sum(u[0] == min(r[2] for r in rs) and u[6] == p.get("sex", u[6])
                and int(p.get("startAge", 0)) <= u[3] <= int(p.get("endAge", 99)) for u in dim)
            for rs in sessions.values() if "keywords" not in p or p["keywords"] in {r[5] for r in rs})
    got = multi_task_stats(make_actions(spark, rows), make_users(spark, dim), task_table(spark, tasks), by_user=by_user)
    assert {r.task_id: r.session_count for r in got.collect()} == want and sum(want.values()) > 20
