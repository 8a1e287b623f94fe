"""Random small logs and tasks against a brute-force model of the rules."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import make_actions, make_users
from visitlens.operators.stats import STEP_BUCKETS, VISIT_BUCKETS
from visitlens.plans.multi_task import multi_task_stats
from visitlens.plans.session_stat import run_session_task
from visitlens.sources.tasks import TaskParams, task_param_json, task_table

D0 = dt.datetime(2024, 1, 1)
KWS = ["a", "b", "c", "ab"]
PROFS = ["p1", "p2"]
CITIES = ["c1", "c2", "c3"]

action_st = st.tuples(
    st.integers(0, 5),                                  # session number
    st.integers(0, 4),                                  # user id
    st.integers(0, 4 * 86400 - 1),                      # seconds from D0
    st.one_of(st.none(), st.sampled_from(KWS + [""])),  # keyword
    st.one_of(st.none(), st.integers(0, 12)),           # category
)
user_st = st.tuples(st.integers(0, 60), st.sampled_from(PROFS), st.sampled_from(CITIES),
                    st.one_of(st.none(), st.sampled_from(["male", "female"])))
opt_list = lambda pool: st.one_of(st.none(), st.lists(st.sampled_from(pool), min_size=1, max_size=3, unique=True))
params_st = st.builds(
    lambda s, n, a1, a2, pr, ci, sx, kw, ca: TaskParams(
        D0.date() + dt.timedelta(days=s), D0.date() + dt.timedelta(days=s + n), a1, a2,
        tuple(pr) if pr else None, tuple(ci) if ci else None, sx,
        tuple(kw) if kw else None, tuple(ca) if ca else None),
    st.integers(0, 3), st.integers(0, 3),
    st.one_of(st.none(), st.integers(0, 30)), st.one_of(st.none(), st.integers(20, 60)),
    opt_list(PROFS), opt_list(CITIES), st.one_of(st.none(), st.sampled_from(["male", "female"])),
    opt_list(KWS), opt_list([str(i) for i in range(13)]),
)


def half_up(c, n):
    return float(Decimal(c / n).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def model(actions, users, p):
    """Expected (session_count, ratios) by the documented rules."""
    sessions = {}
    for sess, uid, secs, kw, cat in actions:
        t = D0 + dt.timedelta(seconds=secs)
        if not (p.start_date <= t.date() < p.end_date):
            continue
        s = sessions.setdefault(sess, {"users": [], "times": [], "kws": set(), "cats": set()})
        s["users"].append(uid)
        s["times"].append(t)
        if kw:
            s["kws"].add(kw)
        if cat is not None:
            s["cats"].add(str(cat))
    kept = []
    for s in sessions.values():
        uid = min(s["users"])
        if uid not in users:
            continue
        age, prof, city, sex = users[uid]
        if p.start_age is not None and p.end_age is not None and not (p.start_age <= age <= p.end_age):
            continue
        if p.professionals is not None and prof not in p.professionals:
            continue
        if p.cities is not None and city not in p.cities:
            continue
        if p.sex is not None and sex != p.sex:
            continue
        if p.keywords is not None and not (s["kws"] & set(p.keywords)):
            continue
        if p.category_ids is not None and not (s["cats"] & set(p.category_ids)):
            continue
        visit = int((max(s["times"]) - min(s["times"])).total_seconds())
        kept.append((visit, len(s["times"])))
    n = len(kept)
    out = {"session_count": n}
    for name, lo, hi in VISIT_BUCKETS:
        c = sum(1 for v, _ in kept if v >= lo and (hi is None or v <= hi))
        out[f"visit_{name}"] = half_up(c, n) if n else None
    for name, lo, hi in STEP_BUCKETS:
        c = sum(1 for _, s in kept if s >= lo and (hi is None or s <= hi))
        out[f"step_{name}"] = half_up(c, n) if n else None
    return out


def to_rows(actions):
    rows = []
    for sess, uid, secs, kw, cat in actions:
        t = D0 + dt.timedelta(seconds=secs)
        rows.append((t, t.date(), uid, f"s{sess}", t, kw, cat))
    return rows


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(action_st, min_size=0, max_size=40), st.lists(user_st, min_size=5, max_size=5),
       st.sets(st.integers(0, 4), max_size=2), params_st)
def test_single_task_matches_model(spark, actions, user_attrs, missing_users, p):
    users = {i: a for i, a in enumerate(user_attrs) if i not in missing_users}
    user_rows = [(i, f"u{i}", f"n{i}", a[0], a[1], a[2], a[3]) for i, a in users.items()]
    got = run_session_task(make_actions(spark, to_rows(actions)), make_users(spark, user_rows), p, 1).first().asDict()
    got.pop("task_id")
    assert got == model(actions, users, p)


def _json(p: TaskParams) -> str:
    kw = {"startDate": p.start_date.isoformat(), "endDate": p.end_date.isoformat()}
    if p.start_age is not None:
        kw["startAge"] = str(p.start_age)
    if p.end_age is not None:
        kw["endAge"] = str(p.end_age)
    for key, val in (("professionals", p.professionals), ("cities", p.cities),
                     ("keywords", p.keywords), ("categoryids", p.category_ids)):
        if val is not None:
            kw[key] = ",".join(val)
    if p.sex is not None:
        kw["sex"] = p.sex
    return task_param_json(**kw)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(action_st, min_size=1, max_size=40), st.lists(user_st, min_size=5, max_size=5),
       st.lists(params_st, min_size=1, max_size=4))
def test_multi_task_matches_model(spark, actions, user_attrs, plist):
    users = dict(enumerate(user_attrs))
    user_rows = [(i, f"u{i}", f"n{i}", a[0], a[1], a[2], a[3]) for i, a in users.items()]
    tasks = task_table(spark, [(i + 1, "t", _json(p)) for i, p in enumerate(plist)])
    got = {r.task_id: r.asDict() for r in multi_task_stats(
        make_actions(spark, to_rows(actions)), make_users(spark, user_rows), tasks).collect()}
    for i, p in enumerate(plist):
        row = dict(got[i + 1])
        row.pop("task_id")
        assert row == model(actions, users, p), i + 1
