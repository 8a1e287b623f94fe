"""Writers for the statistics rows (one row per task).

The output table layout of the analysed application is
``task_id, create_time, session_count, 1s_3s .. 30m, 1_3 .. 60``.
:func:`to_output_layout` renames our ``visit_`` / ``step_`` columns to
it.  Re-running a task must not leave two rows for it, so the file sink
writes Parquet partitioned by ``task_id`` with dynamic partition
overwrite: a re-run replaces exactly the partitions of the tasks it
computed, and the commit protocol makes each write atomic per job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.operators.stats import STEP_BUCKETS, VISIT_BUCKETS


def to_output_layout(stats: DataFrame) -> DataFrame:
    """task_id, create_time, session_count and the 15 ratios under the
    bucket labels of the output table (``1s_3s`` ... ``60``)."""
    cols = [
        F.col("task_id").cast("bigint").alias("task_id"),
        F.current_timestamp().alias("create_time"),
        F.col("session_count").cast("bigint").alias("session_count"),
    ]
    cols += [F.col(f"visit_{name}").alias(name) for name, _l, _h in VISIT_BUCKETS]
    cols += [F.col(f"step_{name}").alias(name) for name, _l, _h in STEP_BUCKETS]
    return stats.select(*cols)


def write_stats(stats: DataFrame, path: str, mode: str = "replace_tasks") -> None:
    """Write statistics rows as Parquet under ``path``.

    ``replace_tasks`` (default): partitions of the written task ids are
    replaced, others kept, so re-runs are idempotent.  ``append``: rows
    are added as they are (the application's plain insert).
    """
    out = to_output_layout(stats)
    writer = out.write.format("parquet").partitionBy("task_id")
    if mode == "replace_tasks":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "append":
        writer = writer.mode("append")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    writer.save(path)


def save_stats_table(stats: DataFrame, table: str) -> None:
    """Append to a catalog table (Hive metastore when enabled)."""
    to_output_layout(stats).write.mode("append").saveAsTable(table)


def append_stats_jdbc(stats: DataFrame, url: str, table: str, properties: dict[str, str],
                      batch_size: int = 1000) -> None:
    """Append through JDBC in one transaction: the rows (one per task, a
    bounded set) are written from one partition, which Spark's JDBC
    writer commits as a single batch transaction."""
    (to_output_layout(stats).coalesce(1).write.mode("append")
     .option("batchsize", str(batch_size))
     .option("isolationLevel", "READ_COMMITTED")
     .jdbc(url, table, properties=properties))
