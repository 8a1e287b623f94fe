"""Session-level queries: roll-up pieces, single conditions, stage counts,
histograms and ratios.  Each takes (spark, sf_dir) and reads the whole log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.dates import format_date, previous_day
from visitlens.functions.numbers import safe_ratio
from visitlens.operators.filters import (
    age_between, all_of, any_of, cut_to_days, equals, user_conditions,
)
from visitlens.operators.sessions import (
    SESSION_COLUMNS, attach_users, session_categories, session_keywords, session_rollup, sessions_with,
)
from visitlens.operators.stats import (
    STEP_COLUMNS, VISIT_COLUMNS, label_counts, ratio_long_form, step_histogram, visit_histogram,
)
from visitlens.plans.session_stat import (
    FLAGSHIP_GRAIN, FLAGSHIP_TASK, FLAGSHIP_UNIT, kept_sessions, session_aggr_stat,
)
from visitlens.sources.tables import actions, read_table, users
from visitlens.sources.tasks import load_task, task_table

# Parameters of the single-condition queries (fixed test parameters).
AGE_RANGE = (20, 40)
PROFESSIONS = ("BUILDING", "MACHINERY")
CITIES = ("NATION_1", "NATION_2", "NATION_3", "NATION_5", "NATION_8", "NATION_13")
SEX = "female"
KEYWORDS = ("kw1", "kw7")
CATEGORIES = ("3", "14", "15", "92")
ALL_KEYWORDS = tuple(f"kw{i}" for i in range(10))
EVENT_LABELS = ("click", "view", "purchase", "signup", "refund")
RUN_DATE = dt.date(2024, 1, 16)
RATIO_TASK = 2


def _sessions(spark: SparkSession, sf: str, grain: str = "g", unit: str = "raw", **kw) -> DataFrame:
    return session_rollup(actions(spark, sf, grain, unit), **kw)


def session_rollup_q(spark, sf):
    return _sessions(spark, sf).select(*SESSION_COLUMNS)


def session_span_q(spark, sf):
    s = _sessions(spark, sf, "day", "dense")
    return s.select("session_id", "start_time", "end_time", "visit_length")


def session_steps_q(spark, sf):
    return actions(spark, sf).groupBy("session_id").agg(F.count(F.lit(1)).alias("step_length"))


def session_keywords_q(spark, sf):
    return session_keywords(actions(spark, sf))


def session_categories_q(spark, sf):
    return session_categories(actions(spark, sf))


def session_user_join_q(spark, sf):
    joined = attach_users(_sessions(spark, sf), users(spark, sf))
    return joined.select("session_id", "user_id", "age", "professional", "city", "sex")


def _with_users(spark, sf, **kw):
    return attach_users(_sessions(spark, sf, **kw), users(spark, sf))


def filter_age_q(spark, sf):
    return _with_users(spark, sf).filter(age_between(*AGE_RANGE)).select("session_id", "age")


def filter_profession_q(spark, sf):
    return _with_users(spark, sf).filter(any_of("professional", PROFESSIONS)).select("session_id", "professional")


def filter_city_q(spark, sf):
    return _with_users(spark, sf).filter(any_of("city", CITIES)).select("session_id", "city")


def filter_sex_q(spark, sf):
    return _with_users(spark, sf).filter(equals("sex", SEX)).select("session_id", "sex")


def filter_keywords_q(spark, sf):
    return sessions_with(session_keywords(actions(spark, sf)), "keyword", KEYWORDS)


def filter_categories_q(spark, sf):
    return sessions_with(session_categories(actions(spark, sf)), "category_id", CATEGORIES)


def filter_null_attr_q(spark, sf):
    """A given keyword condition drops sessions that never searched (no
    keyword to match), even though the list holds every keyword.  Counted
    in two levels, (session, keyword) then session, so no session's
    keywords are collected into one value."""
    kw = F.col("search_keyword")
    pairs = (actions(spark, sf).filter(kw.isNotNull() & (kw != ""))
             .select("session_id", "search_keyword").distinct())
    per_session = pairs.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n_keywords"),
        F.bool_or(kw.isin(list(ALL_KEYWORDS))).alias("hit"),
    )
    return per_session.filter("hit").select("session_id", "n_keywords")


def sample_params(spark: SparkSession, task_id: int):
    """Parameters of a sample task, read through Spark."""
    return load_task(task_table(spark), task_id)


def _flagship_inputs(spark, sf):
    params = sample_params(spark, FLAGSHIP_TASK)
    log = actions(spark, sf, FLAGSHIP_GRAIN, FLAGSHIP_UNIT)
    return params, log, users(spark, sf)


def filtered_sessions_q(spark, sf):
    params, log, user_dim = _flagship_inputs(spark, sf)
    kept = kept_sessions(log, user_dim, params)
    return kept.select("session_id", "user_id", "visit_length", "step_length",
                       "age", "professional", "city", "sex")


def session_count_q(spark, sf):
    params, log, user_dim = _flagship_inputs(spark, sf)
    n = kept_sessions(log, user_dim, params).agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.lit("kept_sessions").alias("stage"), "n")


def stage_counts_q(spark, sf):
    """Actions in range, sessions, kept sessions of the flagship task, as
    the application counts them: sessions after the inner join with the
    users (a user id listed twice repeats its sessions), kept sessions
    after the conditions.  One pass: users are first reduced to one row
    per id with its row count and the count of rows passing the user
    conditions, so the sessions join them without being multiplied."""
    params, log, user_dim = _flagship_inputs(spark, sf)
    in_range = cut_to_days(log, params.start_date, params.end_date)
    sessions = session_rollup(in_range, keywords=params.keywords, category_ids=params.category_ids)
    per_user = user_dim.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(all_of(user_conditions(params))).alias("n_pass"),
    )
    flags = [c for c in (F.col("keyword_hit") if params.keywords is not None else None,
                         F.col("category_hit") if params.category_ids is not None else None) if c is not None]
    joined = sessions.join(per_user, "user_id", "left")
    counts = joined.agg(
        F.coalesce(F.sum("step_length"), F.lit(0)).alias("actions_in_range"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("sessions"),
        F.coalesce(F.sum(F.when(all_of(flags), F.col("n_pass"))), F.lit(0)).alias("kept_sessions"),
    )
    return counts.unpivot([], ["actions_in_range", "sessions", "kept_sessions"], "stage", "n")


def visit_length_hist_q(spark, sf):
    return visit_histogram(_sessions(spark, sf, "day", "dense"))


def step_length_hist_q(spark, sf):
    return step_histogram(_sessions(spark, sf, "g", "raw"))


def visit_length_ratio_q(spark, sf):
    return ratio_long_form(session_aggr_stat(spark, sf, RATIO_TASK), VISIT_COLUMNS)


def step_length_ratio_q(spark, sf):
    return ratio_long_form(session_aggr_stat(spark, sf, RATIO_TASK), STEP_COLUMNS)


def ratio_rounding_q(spark, sf):
    """Share of clicks among each user's events, rounded half up on the
    exact double (many distinct count / total pairs)."""
    ev = read_table(spark, sf, "events")
    per_user = ev.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.col("event_type") == "click").alias("n_clicks"),
    )
    return per_user.select("user_id", "n_events", "n_clicks",
                           safe_ratio("n_clicks", "n_events").alias("click_share"))


def label_counts_q(spark, sf):
    return label_counts(read_table(spark, sf, "events"), "event_type", EVENT_LABELS)


def actions_in_range_q(spark, sf):
    params = sample_params(spark, FLAGSHIP_TASK)
    log = cut_to_days(actions(spark, sf), params.start_date, params.end_date)
    return log.select("event_id", "session_id", "user_id", "action_time")


def actions_previous_day_q(spark, sf):
    """Actions of the day before a run date (passed in, not read from the clock)."""
    prev = RUN_DATE - dt.timedelta(days=1)
    log = cut_to_days(actions(spark, sf), prev, RUN_DATE)
    return log.select("event_id", "session_id", "user_id", "action_time",
                      format_date("action_date").alias("action_date"))


def actions_day_over_day_q(spark, sf):
    """Actions of each day beside those of the day before it (0 if none)."""
    daily = actions(spark, sf).groupBy("action_date").agg(F.count(F.lit(1)).alias("n"))
    before = daily.select(F.col("action_date").alias("day_before"), F.col("n").alias("n_before"))
    return daily.join(before, previous_day("action_date") == F.col("day_before"), "left").select(
        "action_date", "n", F.coalesce("n_before", F.lit(0)).alias("n_before"))


def preview_sessions_q(spark, sf):
    """First 10 sessions by id: a repeatable preview (top-k by key)."""
    return session_rollup_q(spark, sf).orderBy("session_id").limit(10)
