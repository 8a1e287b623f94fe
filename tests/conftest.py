import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

from visitlens.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    warehouse = tempfile.mkdtemp(prefix="visitlens-warehouse-")
    s = build_session("local[*]", app_name="visitlens-tests", shuffle_partitions=8,
                      extra_conf={"spark.sql.warehouse.dir": warehouse})
    s.sparkContext.setLogLevel("ERROR")
    yield s


ACTION_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("action_date", T.DateType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("action_time", T.TimestampNTZType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),
])

USER_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("professional", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("sex", T.StringType()),
])

BASE = dt.datetime(2024, 1, 5, 9, 0, 0)


def action(session, user, seconds=0, keyword=None, category=None, when=BASE):
    t = when + dt.timedelta(seconds=seconds)
    return (t, t.date(), user, session, t, keyword, category)


def make_actions(spark, rows):
    return spark.createDataFrame(rows, ACTION_SCHEMA)


def make_users(spark, rows):
    return spark.createDataFrame(rows, USER_SCHEMA)


def user(uid, age=30, professional="P", city="C", sex="male"):
    return (uid, f"user{uid}", f"name{uid}", age, professional, city, sex)


def text_log(spark, day, seed=""):
    """The events of known users as one day's log in the application's
    layout: date and times as text, sessions of ``seed``."""
    from pyspark.sql import functions as F

    from visitlens.sources.tables import actions, users
    log = actions(spark, SF_SMALL, "day", "raw").join(users(spark, SF_SMALL).select("user_id"), "user_id", "left_semi")
    text = day.isoformat()
    return log.select(
        F.lit(text).alias("date"), "user_id", F.concat(F.lit(seed), "session_id").alias("session_id"), "page_id",
        F.concat(F.lit(text + " "), F.date_format("action_time", "HH:mm:ss")).alias("action_time"), "search_keyword",
        "click_category_id", "click_product_id", "order_category_ids", "order_product_ids", "pay_category_ids",
        "pay_product_ids", "city_id")
