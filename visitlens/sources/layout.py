"""Physical layout of the action log for repeated analysis.

Tasks are run again and again over the same log.  Writing the log once
partitioned by ``date`` and bucketed by ``session_id`` moves the work of
the largest shuffle into that one write:

- a task's date cut on ``date`` becomes partition pruning;
- Spark's bucketed scan already satisfies the ``session_id`` distribution
  of the session roll-up (and of the many-task job's per (session, day)
  partials), so those aggregates run without an exchange.

Rows are shuffled by (date, bucket number) before the write (the bucket
number computed with Spark's own bucketing hash), so each date directory
gets one file per bucket and write tasks are sized by the data, not by
the bucket count.  ``refresh_days`` replaces only the dates it writes.

One bucket of one task's range is read as one task, with no exchange that
AQE could split, so in the two bucketed layouts a hot session or user stays
whole.  ``save_spread_log`` is the layout for logs with hot users: it is
bucketed by ``deal``, a number that is the user's id for most users, a hash of
user and session for users with more rows than a bucket should hold, and a
hash of the single action for sessions as large as that.  The roll-up
(``session_rollup(spread=True)``) combines each part where it lies, without an
exchange of actions, and merges the parts of a session in a second partial
aggregate over what is left, one row per session and part.  Size buckets with
``buckets_for``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.operators.sessions import DEAL


def buckets_for(range_bytes: int, bucket_bytes: int = 2**30) -> int:
    """Buckets so that each holds about ``bucket_bytes`` of the longest
    range of days that one job reads."""
    return max(1, -(-range_bytes // bucket_bytes))


def _bucket_id(buckets: int, col: str):
    """Spark's bucket number of a row: Murmur3 hash (seed 42) of ``col``,
    modulo the bucket count."""
    return F.pmod(F.hash(col), F.lit(buckets))


def _layout(log: DataFrame, buckets: int, partition_col: str | None, bucket_col: str) -> DataFrame:
    if partition_col:
        # One shuffle group per (date, bucket): with the default (large)
        # shuffle partition count every group lands in one task, so each
        # date directory gets one file per bucket and task sizes follow the
        # data, not the bucket count.
        return log.repartition(partition_col, _bucket_id(buckets, bucket_col))
    return log.repartition(buckets, bucket_col)


def save_action_log(log: DataFrame, table: str, buckets: int,
                    partition_col: str | None = "date", bucket_col: str = "session_id") -> None:
    """Create (or replace) catalog table ``table`` (Parquet), partitioned
    by ``partition_col`` and bucketed / sorted by ``bucket_col``:
    ``session_id`` (no shuffle for the session roll-up) or ``user_id``
    (with save_users and ``by_user=True``, neither the roll-up nor the
    user join shuffles)."""
    writer = _layout(log, buckets, partition_col, bucket_col).write.mode("overwrite").format("parquet")
    if partition_col:
        writer = writer.partitionBy(partition_col)
    writer.bucketBy(buckets, bucket_col).sortBy(bucket_col).saveAsTable(table)


def save_users(users: DataFrame, table: str, buckets: int) -> None:
    """User dimension bucketed by ``user_id`` with the log's bucket count,
    so the session-user join is a bucketed sort-merge join."""
    (users.repartition(buckets, "user_id").write.mode("overwrite").format("parquet")
     .bucketBy(buckets, "user_id").sortBy("user_id").saveAsTable(table))


def hot_groups(log: DataFrame, keys: list[str], buckets: int, total: int) -> DataFrame:
    """The groups that hold more than an even bucket's rows: fewer than
    ``buckets`` of them."""
    return log.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * buckets > total).select(*keys)


def spread(log: DataFrame, buckets: int) -> DataFrame:
    """The log with ``deal``, the number that its rows are bucketed by.
    Counting is combined before its shuffle; both lists of hot groups are
    shorter than ``buckets`` and are broadcast."""
    total = log.count()
    users = hot_groups(log, ["user_id"], buckets, total).select(F.col("user_id").alias("_user"))
    sessions = hot_groups(log, ["user_id", "session_id"], buckets, total).select(
        F.col("user_id").alias("_s_user"), F.col("session_id").alias("_session"))
    told = log.join(F.broadcast(users), F.col("user_id") == F.col("_user"), "left").join(
        F.broadcast(sessions), (F.col("user_id") == F.col("_s_user")) & F.col("session_id").eqNullSafe(F.col("_session")), "left")
    deal = (F.when(F.col("_s_user").isNotNull(), F.xxhash64("user_id", "session_id", F.monotonically_increasing_id()))
            .when(F.col("_user").isNotNull(), F.xxhash64("user_id", "session_id"))
            .otherwise(F.col("user_id").cast("bigint")))
    return told.withColumn(DEAL, deal).select(*log.columns, DEAL)


def save_spread_log(log: DataFrame, table: str, buckets: int, partition_col: str | None = "date") -> None:
    """save_action_log for logs with hot users or sessions."""
    save_action_log(spread(log, buckets), table, buckets, partition_col, DEAL)


def refresh_days(log: DataFrame, table: str, buckets: int, partition_col: str = "date",
                 bucket_col: str = "session_id") -> None:
    """Replace only the dates present in ``log`` in an existing table made
    by save_action_log (dynamic partition overwrite); other dates stay."""
    spark = log.sparkSession
    previous = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        cols = spark.table(table).columns
        _layout(log, buckets, partition_col, bucket_col).select(*cols).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", previous)
