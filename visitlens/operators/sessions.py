"""Roll actions up to sessions and attach user attributes.

The statistics path uses only algebraic aggregates (min, max, count,
bool_or), so Spark runs a partial aggregate before the shuffle: a session
holding a third of all actions reaches its reducer as one partial row per
map task.  Distinct keywords and categories are kept in long form, one row
per (session, value): no session's values are collected into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.functions.dates import seconds_between

# Bucket column of a log that is spread over buckets (sources.layout).
DEAL = "deal"
SESSION_COLUMNS = (
    "session_id", "user_id", "start_time", "end_time", "visit_length", "step_length",
)


def session_keywords(actions: DataFrame) -> DataFrame:
    """Distinct (session_id, keyword) of non-empty searched keywords."""
    return actions.where("length(search_keyword) > 0").select(
        "session_id", F.col("search_keyword").alias("keyword")).distinct()


def session_categories(actions: DataFrame) -> DataFrame:
    """Distinct (session_id, category_id) of clicked categories."""
    return actions.where("click_category_id IS NOT NULL").select(
        "session_id", F.col("click_category_id").alias("category_id")).distinct()


def sessions_with(pairs: DataFrame, column: str, values) -> DataFrame:
    """The pairs of sessions that have one of ``values`` (compared as
    text) among theirs.  A NULL session id is a session like any other."""
    hits = pairs.where(F.col(column).cast("string").isin(list(values))).select("session_id").distinct()
    return pairs.alias("p").join(hits.alias("h"), F.expr("p.session_id <=> h.session_id"), "left_semi")


def keyword_hit(keywords) -> Column:
    """The session searched at least one of ``keywords``."""
    return F.bool_or(F.coalesce(F.col("search_keyword").isin(list(keywords)), F.lit(False))).alias("keyword_hit")


def category_hit(category_ids) -> Column:
    """The session clicked at least one of ``category_ids`` (compared as text)."""
    hit = F.col("click_category_id").cast("string").isin(list(category_ids))
    return F.bool_or(F.coalesce(hit, F.lit(False))).alias("category_hit")


def session_rollup(
    actions: DataFrame,
    *,
    keywords=None,
    category_ids=None,
    with_time_audit: bool = False,
    by_user: bool = False,
    spread: bool = False,
    extra_aggs: tuple[Column, ...] = (),
) -> DataFrame:
    """One row per session: user, first / last action time, visit length
    in whole seconds, step length (number of actions).

    With ``keywords`` / ``category_ids`` the session carries a boolean flag
    per list; the aggregate stays a plain hash aggregate.
    ``with_time_audit`` adds ``bad_time_rows``, the session's actions
    whose time is NULL (unparsable in the source text).

    ``by_user=True`` groups by (user_id, session_id) instead.  The result
    is the same when every session has one user (the application's own
    assumption); a session seen with two users becomes two sessions.  On
    a log bucketed by ``user_id`` (sources.layout) this grouping and the
    user join then need no shuffle.

    ``spread=True`` reads a log bucketed by ``deal`` (sources.layout) and
    implies ``by_user``: each bucket combines its own part of a session, and
    a second aggregate merges the parts, one row per session and bucket.

    The session's user is the smallest user id seen in it (the log is
    assumed to have one user per session).  Actions with a NULL time are
    still steps but do not move the start or end.
    """
    if spread and extra_aggs:
        raise ValueError("extra aggregates cannot be merged")
    by_user = by_user or spread
    aggs = [] if by_user else [F.min("user_id").alias("user_id")]
    aggs += [
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
    ]
    if keywords is not None:
        aggs.append(keyword_hit(keywords))
    if category_ids is not None:
        aggs.append(category_hit(category_ids))
    if with_time_audit:
        aggs.append(F.count_if(F.col("action_time").isNull()).alias("bad_time_rows"))
    aggs += list(extra_aggs)
    keys = ("user_id", "session_id") if by_user else ("session_id",)
    rolled = actions.groupBy(*([DEAL] if spread else []), *keys).agg(*aggs)
    if spread:
        merge = {"start_time": F.min, "end_time": F.max, "step_length": F.sum, "keyword_hit": F.bool_or,
                 "category_hit": F.bool_or, "bad_time_rows": F.sum}
        rolled = rolled.groupBy(*keys).agg(*[merge[c](c).alias(c) for c in rolled.columns if c in merge])
    return rolled.withColumn("visit_length", seconds_between("start_time", "end_time"))


def attach_users(sessions: DataFrame, users: DataFrame, profession_from_city: bool = False,
                 keep: list[str] | None = None) -> DataFrame:
    """Inner equi-join on user_id: sessions of unknown users vanish; a
    duplicated user id would repeat the session.

    ``profession_from_city=True`` reproduces the analysed application,
    which fills the profession attribute from the city field.

    No broadcast hint: Catalyst broadcasts the user side only when its
    estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and
    AQE re-checks it at run time; beyond it the join is a sort-merge
    join whose skewed partitions AQE splits.  ``keep`` names the session
    columns that go along (all by default).
    """
    prof = F.col("city") if profession_from_city else F.col("professional")
    attrs = users.select("user_id", "age", prof.alias("professional"), "city", "sex")
    if keep is not None:
        sessions = sessions.select("user_id", *keep)
    return sessions.join(attrs, "user_id", "inner")
