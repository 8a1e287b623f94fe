"""Table jobs built around the per-row helpers of the analysed application
(time keys and text times, blank checks, comma lists, packed k=v text,
JSON fields).  Each reads a whole table and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.dates import (
    date_hour_key, format_date, format_date_key, format_minute_key, format_time,
    is_after, is_before, minus_seconds, parse_date_key, parse_time,
)
from visitlens.functions.json import json_int_field, json_objects
from visitlens.functions.strings import (
    is_blank, lists_overlap, pack_fields, packed_field, set_packed_field,
    split_list, trim_one_comma, zero_fill_2,
)
from visitlens.sources.tables import actions, layout_audit, products, read_table, register_views

# Fixed test parameters.
SHIP_DEADLINE_DAYS = 60
LIST_FILTER = "1,2,3"
BLANK_PROFILE_COLUMNS = (
    "session_id", "search_keyword", "order_category_ids", "order_product_ids",
    "pay_category_ids", "pay_product_ids",
)


def actions_per_hour_q(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per ``yyyy-MM-dd_HH`` key cut from the formatted time text."""
    key = date_hour_key(format_time("action_time"))
    return actions(spark, sf).groupBy(key.alias("hour_key")).agg(F.count(F.lit(1)).alias("n"))


def actions_per_day_q(spark, sf):
    log = actions(spark, sf)
    return log.groupBy("action_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("action_time").alias("last_time"),
    ).select(
        format_date("action_date").alias("day"),
        format_date_key("action_date").alias("day_key"),
        "n",
        format_time("last_time").alias("last_action"),
    )


def actions_per_minute_q(spark, sf):
    key = format_minute_key("action_time")
    return actions(spark, sf).groupBy(key.alias("minute_key")).agg(F.count(F.lit(1)).alias("n"))


def hour_key_rollup_q(spark, sf):
    """Counts per ``yyyy-MM-dd HH`` key whose hour is zero-filled from the
    unpadded hour number."""
    hh = zero_fill_2(F.hour("action_time").cast("string"))
    key = F.concat(format_date("action_date"), F.lit(" "), hh)
    return actions(spark, sf).groupBy(key.alias("hour_key")).agg(F.count(F.lit(1)).alias("n"))


def ship_delay_profile_q(spark, sf):
    """Per order priority: line items shipped before / after a deadline
    (order date + 60 days) and total seconds from order to shipment, all
    through the text-time helpers."""
    # Each text is written below the join; above it the helpers read it.
    ship = format_time("l_shipdate").alias("ship")
    placed = format_time("o_orderdate").alias("placed")
    deadline = format_time(F.timestamp_add("DAY", F.lit(SHIP_DEADLINE_DAYS), F.col("o_orderdate"))).alias("deadline")
    li = read_table(spark, sf, "lineitem").select("l_orderkey", ship)
    od = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", placed, deadline)
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    flags = j.select(
        "o_orderpriority",
        is_before("ship", "deadline").alias("early"),
        is_after("ship", "deadline").alias("late"),
        minus_seconds("ship", "placed").alias("secs"),
    )
    return flags.groupBy("o_orderpriority").agg(
        F.count_if("early").alias("n_before"),
        F.count_if("late").alias("n_after"),
        F.sum("secs").alias("total_seconds"),
    )


def time_text_audit_q(spark, sf):
    """Parse a text time column with unpadded hours, trailing text and
    broken rows (made from events.ts by rule) and count parsed / rejected
    rows per day."""
    ev = read_table(spark, sf, "events").select("event_id", "ts")
    eid = F.col("event_id")
    unpadded = F.concat(format_date("ts"), F.lit(" "), F.hour("ts").cast("string"),
                        F.lit(":"), F.date_format("ts", "mm:ss"))
    # Broken rows: '/' instead of '-' (rejected).  Trailing text and
    # unpadded hours are accepted, as by the application's parser.
    text = (F.when(eid % 17 == 0, F.translate(format_time("ts"), "-", "/"))
            .when(eid % 13 == 0, F.concat(format_time("ts"), F.lit(" UTC")))
            .when(eid % 5 == 0, unpadded)
            .otherwise(format_time("ts")))
    key = (F.when(eid % 23 == 0, F.concat(F.lit("?"), format_date_key("ts")))
           .when(eid % 19 == 0, F.concat(format_date_key("ts"), F.lit("?")))
           .otherwise(format_date_key("ts")))
    parsed = parse_time(text)
    return ev.groupBy(format_date("ts").alias("day")).agg(
        F.count_if(parsed.isNotNull()).alias("n_ok"),
        F.count_if(parsed.isNull()).alias("n_bad"),
        F.count_if(parse_date_key(key).isNull()).alias("n_bad_key"),
    )


def column_blank_profile_q(spark, sf):
    """NULL / empty / filled counts for each text column of the action log,
    in one aggregate pass."""
    log = actions(spark, sf)
    aggs = []
    for c in BLANK_PROFILE_COLUMNS:
        aggs += [
            F.count_if(F.col(c).isNull()).alias(f"{c}__null"),
            F.count_if(F.col(c) == "").alias(f"{c}__empty"),
            F.count_if(~is_blank(c)).alias(f"{c}__filled"),
        ]
    wide = log.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__null").alias("n_null"),
                 F.col(f"{c}__empty").alias("n_empty"), F.col(f"{c}__filled").alias("n_filled"))
        for c in BLANK_PROFILE_COLUMNS
    ]))
    return wide.select(rows.alias("r")).select("r.*")


def packed_attr_rollup_q(spark, sf):
    """Pack event attributes into ``k=v|k=v`` text, rewrite one field, read
    fields back and aggregate by them."""
    ev = read_table(spark, sf, "events")
    k = json_int_field("props", "k")
    packed = pack_fields({"event_type": F.col("event_type"), "user": F.col("user_id"), "k": k})
    rewritten = set_packed_field(packed, "k", (k % 10).cast("string"))
    rows = ev.select(
        packed_field(rewritten, "event_type").alias("event_type"),
        packed_field(rewritten, "k").alias("k_bucket"),
        # whole cents by double arithmetic (same in every engine), summed exactly
        F.floor(F.col("value") * 100 + 0.5).cast("bigint").alias("cents"),
    )
    return rows.groupBy("event_type", "k_bucket").agg(
        F.count(F.lit(1)).alias("n"),
        (F.sum("cents").cast("double") / 100).alias("total_value"),
    )


def list_column_rollup_q(spark, sf):
    """Comma-list column: strip one comma each side, keep rows whose list
    overlaps a given list, explode, count per element."""
    ev = read_table(spark, sf, "events")
    k = json_int_field("props", "k")
    raw = F.concat(F.lit(","), (k % 7).cast("string"), F.lit(","), (k % 11).cast("string"), F.lit(","))
    lists = ev.select(trim_one_comma(raw).alias("ids"))
    # The condition sits inside the explode (a NULL array yields no rows)
    # rather than in a filter: Catalyst would push a filter below the
    # projection and re-derive the list there for every reference.
    kept = F.when(lists_overlap("ids", F.lit(LIST_FILTER)), split_list("ids"))
    return (lists.select(F.explode(kept).alias("element"))
            .groupBy("element").agg(F.count(F.lit(1)).alias("n")))


def param_sql_q(spark, sf):
    """Parameterised SQL text: values are bound, never pasted into the text."""
    ev = read_table(spark, sf, "events")
    return spark.sql(
        "SELECT user_id, count(*) AS n FROM {ev} WHERE event_type = :kind GROUP BY user_id",
        args={"kind": "purchase"}, ev=ev,
    )


def view_city_sessions_q(spark, sf):
    """SQL text over the registered views of log and users: sessions and
    actions per city."""
    register_views(spark, sf, names=("user_visit_action", "user_info"))
    return spark.sql(
        "SELECT u.city, count(DISTINCT a.session_id) AS sessions, count(*) AS actions "
        "FROM user_visit_action a JOIN user_info u ON a.user_id = u.user_id GROUP BY u.city")


def sql_action_range_q(spark, sf):
    """The application's SQL entry: the action log cut to a date range by
    SQL text, with the bounds bound as parameters (typed, so they reach the
    parquet scan).  The log is passed to the text as a frame; nothing is
    registered in the session."""
    return spark.sql(
        "SELECT session_id, count(*) AS n, min(action_time) AS first_time "
        "FROM {log} "
        "WHERE ts >= CAST(:start AS TIMESTAMP_NTZ) AND ts < CAST(:end AS TIMESTAMP_NTZ) "
        "GROUP BY session_id",
        args={"start": "2024-01-03 00:00:00", "end": "2024-01-28 00:00:00"}, log=actions(spark, sf),
    )


def product_status_q(spark, sf):
    p = products(spark, sf).select(json_int_field("extend_info", "product_status").alias("product_status"))
    return p.groupBy("product_status").agg(F.count(F.lit(1)).alias("n"))


def json_props_rollup_q(spark, sf):
    """JSON array of objects -> one row per key / value; integer values
    are summed (other values counted only)."""
    ev = read_table(spark, sf, "events")
    text = F.concat(F.lit("["), F.col("props"), F.lit("]"))
    objs = ev.select(F.explode(json_objects(text)).alias("obj"))
    kv = objs.select(F.explode("obj").alias("key", "value"))
    whole = F.when(F.col("value").rlike(r"^[+-]?\d+\z"), F.col("value").try_cast("bigint"))
    return kv.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(whole).alias("total"),
    )


def text_layout_audit_q(spark, sf):
    """The whole log as text in the application's layout, some of it broken
    by rule, read back and rolled up: kept rows, sessions, and rejects per
    reason."""
    log = actions(spark, sf)
    day = format_date("action_date")
    broken = F.col("event_id")
    text = log.select(
        F.when(broken % 101 == 0, None).when(broken % 97 == 0, F.concat(F.substring(day, 1, 9), F.lit("x")))
        .when(broken % 103 == 0, F.concat(F.substring(day, 1, 5), F.lit("13-01"))).otherwise(day).alias("date"),
        F.when(broken % 89 == 0, F.lit("junk")).when(broken % 83 == 0, None)
        .otherwise(format_time("action_time")).alias("action_time"),
        "user_id", "session_id")
    return layout_audit(text)
