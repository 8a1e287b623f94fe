"""Readers for the action log and the user / product dimensions.

Production jobs read catalog tables (``user_visit_action``, ``user_info``,
``product_info``) through :func:`catalog_table`.  The test data holds a
TPC-H-like schema plus an ``events`` table instead; the functions below
derive the three tables from it with column expressions only, so the
parquet scan still sees pushed filters and a pruned read schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.dates import epoch_minutes, from_epoch_seconds, parse_time, truncate_to_second
from visitlens.functions.json import json_int_field

ACTION_COLUMNS = (
    "action_date", "user_id", "session_id", "page_id", "action_time",
    "search_keyword", "click_category_id", "click_product_id",
    "order_category_ids", "order_product_ids", "pay_category_ids",
    "pay_product_ids", "city_id",
)
USER_COLUMNS = ("user_id", "username", "name", "age", "professional", "city", "sex")

# Session grains for the test log, which has no session column.
#   "g":   user + block of g days, g = 1 + user_id % 30 (long, multi-day sessions)
#   "day": user + calendar day
SESSION_GRAINS = ("g", "day")
# Time units: "raw" keeps seconds; "dense" reads whole minutes as seconds,
# which spreads the long gaps of the test log over all visit buckets.
TIME_UNITS = ("raw", "dense")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the session catalog (Hive metastore when enabled)."""
    return spark.table(name)


def from_reference_layout(log: DataFrame) -> DataFrame:
    """Adapt an action log in the application's own layout (``date`` as
    ``yyyy-MM-dd`` text, ``action_time`` as ``yyyy-MM-dd H:mm:ss`` text)
    to the typed columns the operators use.  The raw ``date`` text is kept:
    date cuts are stated on it (text bounds reach the scan and partition
    pruning).  Unparsable times become NULL: such actions still count as
    steps but do not move a session's start or end.  A ``date`` text whose
    first 10 characters are no date gets a NULL ``action_date``; such rows
    are rejected by the date cut of the single-task and the many-task job
    alike.  :func:`layout_audit` counts both."""
    others = [c for c in log.columns if c not in ("date", "action_time")]
    return log.select(
        "date",
        # the day of the first 10 characters: every text that passes a
        # yyyy-MM-dd text cut of one day starts with that day
        F.try_to_date(F.substring("date", 1, 10), "yyyy-MM-dd").alias("action_date"),
        parse_time("action_time").cast("timestamp_ntz").alias("action_time"),
        *others,
    )


def layout_audit(log: DataFrame) -> DataFrame:
    """What reading a log in the application's layout keeps and rejects:
    reason, n.  ``kept_rows`` stand on a day, in ``sessions``; ``bad_date``
    rows are rejected; ``bad_time`` rows are kept as steps without a time.
    One pass; the counts of a session are combined before the shuffle."""
    read = from_reference_layout(log)
    placed = F.col("action_date").isNotNull()
    per = read.groupBy("session_id").agg(
        F.count_if(placed).alias("kept"), F.count_if(~placed).alias("bad_date"),
        F.count_if(placed & F.col("action_time").isNull()).alias("bad_time"))
    total = per.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (
        ("kept", "kept_rows"), ("bad_date", "bad_date"), ("bad_time", "bad_time"))],
        F.count_if(F.col("kept") > 0).alias("sessions"))
    return total.unpivot([], ["kept_rows", "sessions", "bad_date", "bad_time"], "reason", "n")


def _grain_days(grain: str) -> Column:
    if grain == "g":
        return F.pmod(F.col("user_id"), F.lit(30)) + 1  # >= 1 also for negative ids
    if grain == "day":
        return F.lit(1).cast("bigint")
    raise ValueError(f"unknown session grain {grain!r}; use one of {SESSION_GRAINS}")


def _action_time(unit: str) -> Column:
    if unit == "raw":
        return truncate_to_second("ts")
    if unit == "dense":
        return from_epoch_seconds(epoch_minutes("ts"))
    raise ValueError(f"unknown time unit {unit!r}; use one of {TIME_UNITS}")


def actions(spark: SparkSession, sf_dir: str, grain: str = "g", unit: str = "raw") -> DataFrame:
    """The action log (``user_visit_action`` shape) derived from ``events``.

    Besides the 13 columns of the action log it keeps ``event_id`` and the
    raw event time ``ts``: date cuts are stated on ``ts`` so that both
    bounds reach the parquet reader as pushed filters.
    """
    ev = read_table(spark, sf_dir, "events")
    k = json_int_field("props", "k")
    kind = F.col("event_type")
    day_no = F.unix_date(F.to_date("ts")).cast("bigint")
    keyed = ev.select(
        "event_id", "ts", "user_id", "event_type",
        k.alias("k"),
        day_no.alias("day_no"),
        _grain_days(grain).alias("grain_days"),
    )
    return keyed.select(
        "event_id",
        "ts",
        F.to_date("ts").alias("action_date"),
        "user_id",
        F.concat(
            F.col("user_id").cast("string"), F.lit("_"),
            F.expr("day_no div grain_days").cast("string"),
        ).alias("session_id"),
        (F.col("event_id") % 10).alias("page_id"),
        _action_time(unit).alias("action_time"),
        F.when(kind == "view", F.concat(F.lit("kw"), (F.col("k") % 10).cast("string"))).alias("search_keyword"),
        F.when(kind == "click", F.col("k")).alias("click_category_id"),
        F.when(kind == "click", F.col("event_id") % 100).alias("click_product_id"),
        F.when(kind == "signup", F.col("k").cast("string")).alias("order_category_ids"),
        F.when(kind == "signup", (F.col("event_id") % 100).cast("string")).alias("order_product_ids"),
        F.when(kind == "purchase", F.col("k").cast("string")).alias("pay_category_ids"),
        F.when(kind == "purchase", (F.col("event_id") % 100).cast("string")).alias("pay_product_ids"),
        (F.col("user_id") % 10).alias("city_id"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user dimension (``user_info`` shape) from the whole ``customer``
    table and ``nation``."""
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    joined = cust.join(nation, cust.c_nationkey == nation.n_nationkey, "inner")
    return joined.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (F.floor(F.abs("c_acctbal")) % 60).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.col("n_name").alias("city"),
        F.when(F.col("c_custkey") % 2 == 0, "male").otherwise("female").alias("sex"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product dimension (``product_info`` shape) from ``part``, with
    a JSON attribute column ``{"product_status": 0|1}``."""
    part = read_table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(
            F.lit('{"product_status": '), (F.col("p_partkey") % 2).cast("string"), F.lit("}")
        ).alias("extend_info"),
    )


VIEWS = ("user_visit_action", "user_info", "product_info")


def register_views(spark: SparkSession, sf_dir: str, grain: str = "g", unit: str = "raw",
                   names: tuple[str, ...] = VIEWS) -> None:
    """Register ``user_visit_action``, ``user_info`` and ``product_info``,
    or those of them in ``names``, as temporary views over the test tables
    (for SQL entry points)."""
    frames = {"user_visit_action": lambda: actions(spark, sf_dir, grain, unit), "user_info": lambda: users(spark, sf_dir),
              "product_info": lambda: products(spark, sf_dir)}
    for name in names:
        frames[name]().createOrReplaceTempView(name)
