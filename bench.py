"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.

Each query is executed to completion through the ``noop`` sink (the whole
plan runs, nothing is pulled to the driver).  The reported time per query
is the best of $BENCH_REPEAT runs (default 3, after one untimed
warm-up run of the flagship); ``value`` is the sum over
the headline queries, ``all_sec`` the sum over every query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from visitlens.operators.filters import cut_to_days, session_filter  # noqa: E402
from visitlens.operators.sessions import attach_users  # noqa: E402
from visitlens.operators.stats import aggr_stat  # noqa: E402
from visitlens.plans.catalog import QUERIES  # noqa: E402
from visitlens.plans.session_stat import (  # noqa: E402
    FLAGSHIP_GRAIN, FLAGSHIP_TASK, FLAGSHIP_UNIT, session_aggr_stat,
)
from visitlens.session import build_session  # noqa: E402
from visitlens.sources.tables import actions, users  # noqa: E402
from visitlens.sources.tasks import SAMPLE_TASKS, load_task, task_table  # noqa: E402

HEADLINE = (
    "session_aggr_stat", "multi_task_stats", "stage_counts", "session_rollup",
    "visit_length_hist", "step_length_hist", "filtered_sessions", "session_user_join",
)


def application_shaped_run(spark, sf_dir: str) -> None:
    """The flagship task computed with the analysed application's job
    shape, for comparison only: five separate actions on an uncached
    lineage, and whole session groups shipped before they are folded
    (``collect_list`` of full rows, like ``groupByKey``), then the
    statistics as one more job."""
    params = load_task(task_table(spark), FLAGSHIP_TASK)
    log = cut_to_days(actions(spark, sf_dir, FLAGSHIP_GRAIN, FLAGSHIP_UNIT),
                      params.start_date, params.end_date)
    log.count()
    rows = F.struct("user_id", "action_time", "search_keyword", "click_category_id")
    grouped = log.groupBy("session_id").agg(F.collect_list(rows).alias("r"))
    kws = [F.lit(k) for k in (params.keywords or ())]
    cats = [F.lit(c) for c in (params.category_ids or ())]
    sessions = grouped.select(
        "session_id",
        F.col("r")[0]["user_id"].alias("user_id"),
        F.timestamp_diff("SECOND", F.array_min("r.action_time"), F.array_max("r.action_time")).alias("visit_length"),
        F.size("r").cast("bigint").alias("step_length"),
        F.coalesce(F.arrays_overlap(F.col("r.search_keyword"), F.array(*kws)), F.lit(False)).alias("keyword_hit"),
        F.coalesce(F.arrays_overlap(F.transform("r.click_category_id", lambda x: x.cast("string")),
                                    F.array(*cats)), F.lit(False)).alias("category_hit"),
    )
    sessions.count()
    sessions.take(10)
    kept = attach_users(sessions, users(spark, sf_dir)).filter(session_filter(params))
    kept.count()
    kept.take(10)
    aggr_stat(kept).collect()


def one_job_per_task(spark, sf_dir: str) -> None:
    """The sample tasks run the application's way, one job per task (the
    many-task query computes the same rows in one job)."""
    for task_id, _name, _param in SAMPLE_TASKS:
        session_aggr_stat(spark, sf_dir, task_id).collect()


def _best(fn, spark, sf_dir: str, repeat: int) -> float:
    best = float("inf")
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn(spark, sf_dir)
        best = min(best, time.perf_counter() - t0)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    conf = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    event_dir = os.environ.get("BENCH_EVENT_LOG")  # stage / task times without the UI
    if event_dir:
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus), extra_conf=conf)
    spark.sparkContext.setLogLevel("ERROR")
    names = only or list(QUERIES)
    # Untimed warm-up (JIT, file listing caches) on the flagship.
    QUERIES["session_aggr_stat"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
        times[name] = round(best, 3)
    shaped = per_task = None
    if not only or os.environ.get("BENCH_COMPARE"):
        shaped = _best(application_shaped_run, spark, sf_dir, repeat)
        per_task = _best(one_job_per_task, spark, sf_dir, repeat)
    headline = [n for n in HEADLINE if n in times]
    value = round(sum(times[n] for n in headline), 3) if headline else round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total_sec",
        "value": value,
        "unit": "sec",
        "queries": times,
        "all_sec": round(sum(times.values()), 3),
        "headline": headline,
        # Same task as session_aggr_stat, run with the application's job
        # shape on this session (see application_shaped_run); not a query.
        "application_shaped_flagship_sec": shaped,
        # The sample tasks as one job each (the application's model) versus
        # multi_task_stats above, which computes the same rows in one job.
        "one_job_per_task_sec": per_task,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
