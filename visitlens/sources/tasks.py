"""Analysis tasks: a task row holds a JSON ``task_param`` text.

Parameter names and meaning (fixed values of the task format):

    startDate, endDate      action date range, start inclusive, end exclusive
    startAge, endAge        age range, both ends inclusive, only used when both are given
    professionals           comma list, any-match
    cities                  comma list, any-match
    sex                     single value, equality
    keywords                comma list, any-match with the session's searched keywords
    categoryids             comma list, any-match with the session's clicked categories

Every JSON value is an array whose first element is used; an absent name,
an empty array or an empty first element means "no condition".
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.functions.json import first_param
from visitlens.functions.strings import split_list

TASK_SCHEMA = T.StructType([
    T.StructField("task_id", T.LongType(), False),
    T.StructField("task_name", T.StringType(), True),
    T.StructField("task_param", T.StringType(), True),
])

# Typed parameter columns produced by parse_tasks().
PARAM_COLUMNS = (
    "start_date", "end_date", "start_age", "end_age",
    "professionals", "cities", "sex", "keywords", "category_ids",
)


@dataclass(frozen=True)
class TaskParams:
    start_date: dt.date
    end_date: dt.date
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] | None = None
    cities: tuple[str, ...] | None = None
    sex: str | None = None
    keywords: tuple[str, ...] | None = None
    category_ids: tuple[str, ...] | None = None


def task_param_json(**params: str) -> str:
    """Build a ``task_param`` text: each value wrapped in a one-element array."""
    return json.dumps({k: [v] for k, v in params.items()}, ensure_ascii=False)


# Tasks used with the test data (there is no task table in it).  They are
# joined with the whole action log; each exercises a different filter mix.
SAMPLE_TASKS = (
    (1, "all conditions", task_param_json(
        startDate="2024-01-03", endDate="2024-01-28", startAge="10", endAge="50",
        professionals="BUILDING,MACHINERY,HOUSEHOLD,FURNITURE",
        cities=",".join(f"NATION_{i}" for i in range(0, 25, 2)) + ",NATION_7,NATION_9",
        sex="male", keywords="kw1,kw2,kw3,kw5,kw8",
        categoryids=",".join(str(i) for i in range(0, 100, 3)))),
    (2, "dates only", task_param_json(startDate="2024-01-01", endDate="2024-01-31")),
    (3, "one-sided age", task_param_json(
        startDate="2024-01-10", endDate="2024-01-25", startAge="30", sex="female")),
    (4, "matches nothing", task_param_json(
        startDate="2024-01-01", endDate="2024-01-31", keywords="no-such-keyword")),
    (5, "categories only", task_param_json(
        startDate="2024-01-01", endDate="2024-01-16",
        categoryids=",".join(str(i) for i in range(5, 100, 10)))),
    (6, "profession and city", task_param_json(
        startDate="2024-01-05", endDate="2024-01-30",
        professionals="AUTOMOBILE,FURNITURE",
        cities="NATION_3,NATION_7,NATION_11,NATION_19,NATION_23")),
    (7, "shares the range of task 2", task_param_json(
        startDate="2024-01-01", endDate="2024-01-31", sex="female", keywords="kw0,kw9")),
)


# The sample tasks among three that cannot run.
TASKS_WITH_BAD_ONES = SAMPLE_TASKS + (
    (90, "no end", task_param_json(startDate="2024-01-03", sex="male")),
    (91, "an id twice", task_param_json(startDate="2024-01-03", endDate="2024-01-28")),
    (91, "an id twice, other days", task_param_json(startDate="2024-01-10", endDate="2024-01-12")),
)


def task_table(spark: SparkSession, rows=SAMPLE_TASKS) -> DataFrame:
    return spark.createDataFrame(list(rows), TASK_SCHEMA)


def parse_tasks(tasks: DataFrame) -> DataFrame:
    """Add one typed column per parameter (names in PARAM_COLUMNS).

    Dates must be ``yyyy-MM-dd`` and ages whole numbers, else they count
    as absent.  Lists become arrays of their non-empty elements.
    """
    def text(name: str):
        return first_param("task_param", name)

    def day(name: str):
        v = text(name)
        return F.when(v.rlike(r"^\d{4}-\d{2}-\d{2}\z"), F.try_to_date(v, "yyyy-MM-dd"))

    def whole(name: str):
        v = text(name)
        return F.when(v.rlike(r"^[+-]?\d+\z"), v.try_cast("int"))  # Integer.valueOf accepts "+18"

    return tasks.select(
        *tasks.columns,
        day("startDate").alias("start_date"),
        day("endDate").alias("end_date"),
        whole("startAge").alias("start_age"),
        whole("endAge").alias("end_age"),
        split_list(text("professionals")).alias("professionals"),
        split_list(text("cities")).alias("cities"),
        text("sex").alias("sex"),
        split_list(text("keywords")).alias("keywords"),
        split_list(text("categoryids")).alias("category_ids"),
    )


def task_problem() -> Column:
    """Why a parsed task cannot run, or NULL."""
    same = F.count(F.lit(1)).over(Window.partitionBy("task_id"))
    return (F.when(F.col("task_id").isNull(), "no task id")
            .when(F.col("start_date").isNull() | F.col("end_date").isNull(), "no valid startDate / endDate")
            .when(same > 1, "task id is not unique"))


def rejected_tasks(tasks: DataFrame) -> DataFrame:
    """task_id, task_name and reason of the tasks that cannot run; all rows
    of a repeated id are among them, as none of them is the task meant."""
    return parse_tasks(tasks).withColumn("reason", task_problem()).where("reason IS NOT NULL").select(
        "task_id", "task_name", "reason")


def load_task(tasks: DataFrame, task_id: int) -> TaskParams:
    """Read one task by id (a bounded, one-row read) and return its
    parameters.  Raises LookupError for an unknown id and ValueError when
    a date bound is missing or malformed."""
    rows = parse_tasks(tasks.filter(F.col("task_id") == F.lit(task_id))).limit(2).collect()
    if not rows:
        raise LookupError(f"no task with id {task_id}")
    if len(rows) > 1:
        raise LookupError(f"task id {task_id} is not unique")
    r = rows[0]
    if r.start_date is None or r.end_date is None:
        raise ValueError(f"task {task_id}: startDate and endDate (yyyy-MM-dd) are both required")

    def tup(v):
        return tuple(v) if v is not None else None

    return TaskParams(
        start_date=r.start_date, end_date=r.end_date,
        start_age=r.start_age, end_age=r.end_age,
        professionals=tup(r.professionals), cities=tup(r.cities), sex=r.sex,
        keywords=tup(r.keywords), category_ids=tup(r.category_ids),
    )


def read_tasks(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A task table stored as files (task_id, task_name, task_param, ...)."""
    return spark.read.format(fmt).load(path).select("task_id", "task_name", "task_param")


def read_tasks_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
                    task_ids=None) -> DataFrame:
    """The task table of a relational database.  A filter on ``task_id``
    is pushed into the database query by Spark's JDBC source."""
    tasks = spark.read.jdbc(url, table, properties=properties).select("task_id", "task_name", "task_param")
    if task_ids is not None:
        tasks = tasks.filter(F.col("task_id").isin(list(task_ids)))
    return tasks
