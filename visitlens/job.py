"""Command-line job: compute and store the statistics rows of tasks.

    spark-submit --py-files visitlens.zip visitlens/job.py --tasks <task table> --out <stats path> [--task-id N ...]

Production tables are read from the catalog (``--actions-table`` /
``--users-table``, Hive when ``--hive``); ``--sf-dir`` reads the test
tables instead.  All requested tasks run as one Spark job.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from visitlens.plans.multi_task import multi_task_stats
from visitlens.session import build_session, cluster_conf
from visitlens.sources import tables
from visitlens.sources.sinks import write_stats
from visitlens.sources.tasks import read_tasks, rejected_tasks, task_table


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--task-id", type=int, action="append", help="task to run (repeatable); default all")
    ap.add_argument("--tasks", help="task table path (Parquet); required unless --sf-dir")
    ap.add_argument("--out", required=True, help="statistics output path (Parquet, partitioned by task_id)")
    ap.add_argument("--sf-dir", help="read the test tables of this directory")
    ap.add_argument("--actions-table", default="user_visit_action")
    ap.add_argument("--users-table", default="user_info")
    ap.add_argument("--hive", action="store_true")
    ap.add_argument("--input-tb", type=float, default=100.0,
                    help="approximate action-log size, sizes shuffle and scan partitions")
    ap.add_argument("--rejects", help="write tasks that cannot run, with the reason, to this path (Parquet, "
                                      "replaced) and run the others; without it one such task stops the job")
    ap.add_argument("--append", action="store_true", help="append instead of replacing the tasks' rows")
    ap.add_argument("--by-user", action="store_true",
                    help="key sessions by (user, session): no shuffle on user-bucketed tables")
    ap.add_argument("--profession-from-city", action="store_true",
                    help="compatibility: take the profession attribute from the city field")
    ap.add_argument("--explain", action="store_true",
                    help="print the formatted physical plan and exit without writing")
    args = ap.parse_args(argv)

    sized = None if args.sf_dir else cluster_conf(int(args.input_tb * 2**40))
    if not args.tasks and not args.sf_dir:
        ap.error("--tasks is required with catalog tables (the sample tasks only fit --sf-dir)")
    spark = build_session(hive=args.hive, extra_conf=sized)
    tasks = read_tasks(spark, args.tasks) if args.tasks else task_table(spark)
    if args.task_id:
        tasks = tasks.filter(F.col("task_id").isin(args.task_id))
        found = {r.task_id for r in tasks.select("task_id").distinct().collect()}  # <= len(ids) rows
        missing = sorted(set(args.task_id) - found)
        if missing:
            raise LookupError(f"unknown task id(s): {missing}")
    if args.sf_dir:
        log = tables.actions(spark, args.sf_dir, "g", "dense")
        dim = tables.users(spark, args.sf_dir)
    else:
        log = tables.from_reference_layout(tables.catalog_table(spark, args.actions_table))
        dim = tables.catalog_table(spark, args.users_table)
    stats = multi_task_stats(log, dim, tasks, by_user=args.by_user,
                             profession_from_city=args.profession_from_city,
                             bad_tasks="skip" if args.rejects else "raise")
    if args.explain:
        stats.explain(mode="formatted")
        return
    if args.rejects:
        rejected_tasks(tasks).write.mode("overwrite").parquet(args.rejects)
    write_stats(stats, args.out, mode="append" if args.append else "replace_tasks")


if __name__ == "__main__":
    main()
