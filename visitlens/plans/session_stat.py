"""The session statistics job: one task in, one statistics row out.

Plan (one action, two data exchanges):

    actions scan  -- PushedFilters: ts >= start, ts < end; ReadSchema: used columns only
      -> partial hash aggregate by session_id (min/max/count/bool_or)
      -> exchange on session_id -> final aggregate
      -> join users on user_id (broadcast if under the size threshold,
         else sort-merge with AQE skew splitting); age / profession /
         city / sex conditions are pushed into the user scan by Catalyst
      -> filter on the keyword / category flags
      -> partial aggregate of 16 counters -> single-partition final -> ratios
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.operators.filters import cut_to_days, session_filter
from visitlens.operators.sessions import attach_users, session_rollup
from visitlens.operators.stats import STAT_COLUMNS, aggr_stat
from visitlens.sources.tables import actions, users
from visitlens.sources.tasks import TaskParams, load_task, task_table

# Test-data configuration of the flagship query: multi-day sessions and
# minute-dense times fill every visit and step bucket.
FLAGSHIP_TASK = 1
FLAGSHIP_GRAIN = "g"
FLAGSHIP_UNIT = "dense"


def kept_sessions(action_log: DataFrame, user_dim: DataFrame, params: TaskParams,
                  cut_col: str | None = None, profession_from_city: bool = False,
                  by_user: bool = False, spread: bool = False) -> DataFrame:
    """Sessions of the task's date range that pass all its conditions,
    with user attributes attached.  The date cut is stated on ``cut_col``
    (default: the raw ``ts`` / ``date`` column, see raw_cut_column).
    ``by_user``, ``spread``: see operators.sessions.session_rollup."""
    in_range = cut_to_days(action_log, params.start_date, params.end_date, cut_col)
    sessions = session_rollup(in_range, keywords=params.keywords, category_ids=params.category_ids,
                              by_user=by_user, spread=spread)
    joined = attach_users(sessions, user_dim, profession_from_city)
    return joined.filter(session_filter(params))


def run_session_task(action_log: DataFrame, user_dim: DataFrame, params: TaskParams,
                     task_id: int, cut_col: str | None = None,
                     profession_from_city: bool = False, by_user: bool = False, spread: bool = False) -> DataFrame:
    """task_id, session_count and the 15 ratios for one task."""
    stat = aggr_stat(kept_sessions(action_log, user_dim, params, cut_col, profession_from_city, by_user, spread))
    return stat.select(F.lit(task_id).cast("bigint").alias("task_id"), *STAT_COLUMNS)


def session_aggr_stat(spark: SparkSession, sf_dir: str, task_id: int = FLAGSHIP_TASK,
                      grain: str = FLAGSHIP_GRAIN, unit: str = FLAGSHIP_UNIT,
                      tasks: DataFrame | None = None) -> DataFrame:
    tasks = tasks if tasks is not None else task_table(spark)
    params = load_task(tasks, task_id)
    return run_session_task(actions(spark, sf_dir, grain, unit), users(spark, sf_dir), params, task_id)
