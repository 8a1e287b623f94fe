"""SparkSession construction."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on. Session time zone is pinned so that
# date_format / casts between timestamp kinds do not depend on the host.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def cluster_conf(input_bytes: int = 100 * 2**40, scan_split_bytes: int = 256 * 2**20,
                 shuffle_partition_bytes: int = 128 * 2**20) -> dict[str, str]:
    """SQL settings sized for a large input (default 100 TB).

    Scan splits of 256 MB keep the task count of a 100 TB scan near
    400k.  Shuffles start from enough partitions for the shuffled bytes
    at ``shuffle_partition_bytes`` each (after partial aggregation the
    session shuffle is a fraction of the input; 1/20 is assumed) and AQE
    coalesces them down to the advisory size, so small stages do not pay
    for the big ones.  Skewed partitions above 4x the median and 512 MB
    are split by AQE in sort-merge joins.
    """
    shuffled = max(input_bytes // 20, shuffle_partition_bytes)
    initial = max(200, min(200_000, shuffled // shuffle_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 2**20),
    }


def session_builder(
    master: str | None = None,
    app_name: str = "visitlens",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    hive: bool = False,
) -> SparkSession.Builder:
    """A builder with the defaults above; nothing is started.

    ``master`` and ``shuffle_partitions`` are left to the cluster when not
    given (spark-submit decides them there); tests pass ``local[*]`` / 8.
    ``hive=True`` reads catalog tables from the Hive metastore.
    """
    builder = SparkSession.Builder().appName(app_name)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder


def build_session(
    master: str | None = None,
    app_name: str = "visitlens",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    hive: bool = False,
) -> SparkSession:
    """Get or create a session, see session_builder."""
    return session_builder(master, app_name, shuffle_partitions, extra_conf, hive).getOrCreate()
