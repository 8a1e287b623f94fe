"""Registry of the named queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from visitlens.plans import session_queries as sq
from visitlens.plans import table_jobs as tj
from visitlens.plans.multi_task import multi_task_stats, task_outcomes
from visitlens.plans.session_stat import session_aggr_stat
from visitlens.sources.tables import actions, users
from visitlens.sources.tasks import TASKS_WITH_BAD_ONES, rejected_tasks, task_table

Query = Callable[[SparkSession, str], DataFrame]


def multi_task_stats_q(spark: SparkSession, sf: str) -> DataFrame:
    return multi_task_stats(actions(spark, sf, "g", "dense"), users(spark, sf), task_table(spark))


def multi_task_outcomes_q(spark: SparkSession, sf: str) -> DataFrame:
    tasks = task_table(spark, TASKS_WITH_BAD_ONES)
    stats = multi_task_stats(actions(spark, sf, "g", "dense"), users(spark, sf), tasks, bad_tasks="skip")
    return task_outcomes(stats, rejected_tasks(tasks))


def session_aggr_stat_q(spark: SparkSession, sf: str) -> DataFrame:
    return session_aggr_stat(spark, sf)


QUERIES: dict[str, Query] = {
    "session_aggr_stat": session_aggr_stat_q,
    "multi_task_stats": multi_task_stats_q,
    "multi_task_outcomes": multi_task_outcomes_q,
    "session_rollup": sq.session_rollup_q,
    "session_span": sq.session_span_q,
    "session_steps": sq.session_steps_q,
    "session_keywords": sq.session_keywords_q,
    "session_categories": sq.session_categories_q,
    "session_user_join": sq.session_user_join_q,
    "filter_age": sq.filter_age_q,
    "filter_profession": sq.filter_profession_q,
    "filter_city": sq.filter_city_q,
    "filter_sex": sq.filter_sex_q,
    "filter_keywords": sq.filter_keywords_q,
    "filter_categories": sq.filter_categories_q,
    "filter_null_attr": sq.filter_null_attr_q,
    "filtered_sessions": sq.filtered_sessions_q,
    "session_count": sq.session_count_q,
    "stage_counts": sq.stage_counts_q,
    "visit_length_hist": sq.visit_length_hist_q,
    "step_length_hist": sq.step_length_hist_q,
    "visit_length_ratio": sq.visit_length_ratio_q,
    "step_length_ratio": sq.step_length_ratio_q,
    "ratio_rounding": sq.ratio_rounding_q,
    "label_counts": sq.label_counts_q,
    "actions_in_range": sq.actions_in_range_q,
    "actions_previous_day": sq.actions_previous_day_q,
    "actions_day_over_day": sq.actions_day_over_day_q,
    "preview_sessions": sq.preview_sessions_q,
    "actions_per_hour": tj.actions_per_hour_q,
    "actions_per_day": tj.actions_per_day_q,
    "actions_per_minute": tj.actions_per_minute_q,
    "hour_key_rollup": tj.hour_key_rollup_q,
    "ship_delay_profile": tj.ship_delay_profile_q,
    "time_text_audit": tj.time_text_audit_q,
    "column_blank_profile": tj.column_blank_profile_q,
    "packed_attr_rollup": tj.packed_attr_rollup_q,
    "list_column_rollup": tj.list_column_rollup_q,
    "param_sql": tj.param_sql_q,
    "sql_action_range": tj.sql_action_range_q,
    "view_city_sessions": tj.view_city_sessions_q,
    "product_status": tj.product_status_q,
    "json_props_rollup": tj.json_props_rollup_q,
    "text_layout_audit": tj.text_layout_audit_q,
}
