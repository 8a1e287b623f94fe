"""Many tasks in one job: one statistics row per task.

The analysed application runs one job per task.  Here a whole task table
is matched against the log at once, in one pass over it:

1. The bounds of all task ranges cut the calendar into pieces; every range
   is a whole number of pieces.  The scan gets the spans of days that any
   task asks for.
2. Actions are pre-aggregated per (session, piece): min / max / count are
   combinable.  Listed keywords and categories ride along in long form, as
   rows (session, piece, value) of the same aggregate, so neither a session
   nor the plan grows with the number of listed values.  This is the one
   exchange of the log before the users are joined, and both it and the
   next carry combined rows only: dealing raw actions by session once would
   save an exchange and lose the map-side combine that a hot session needs.
3. Users are joined, and the combined rows are dealt by session.  Nothing
   after this point leaves its task before it is counted.
4. A session in one piece (nearly all) is whole in every range that holds
   it: it becomes a cell (piece, user attributes, buckets), no row per range.
   Only sessions that a range's bound cuts meet every task, and only listed
   values meet the tasks that list them (posting lists, broadcast).  These
   rows are folded per (session, task) in place.
5. Cells and folded rows are counted where they are, so the exchange that
   follows carries counts, never pairs of a session and a range.  Cells meet
   the tasks without lists last.  A zero row per task is added, so a task
   with no session still gets its row (count 0, NULL ratios).

Tasks are broadcast where their texts hold at most TASK_BYTES together (the
sum is taken first); beyond it the same joins shuffle.

Rows whose date text is no date are rejected here as in the single-task job
(see sources.tables.layout_audit for their count).  Tasks without a valid
range or with a repeated id stop the job, or are left out with
``bad_tasks="skip"`` and told by sources.tasks.rejected_tasks.
"""

from __future__ import annotations

import json
from operator import or_
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitlens.functions.dates import seconds_between
from visitlens.functions.strings import empty_to_null
from visitlens.operators.filters import day_range_on, placed_on_a_day, raw_cut_column
from visitlens.operators.stats import STAT_COLUMNS, STEP_BUCKETS, VISIT_BUCKETS, in_bucket, ratio_columns
from visitlens.sources.tasks import parse_tasks, task_problem

# Task texts of so many bytes are sent to all executors.
TASK_BYTES = 32 * 2**20
# So many spans at most reach the scan; beyond it the smallest gaps between
# them are read too, and the days of the pieces decide.
SPANS = 64
ATTRIBUTES = ("age", "professional", "city", "sex")


def task_facts(parsed: DataFrame) -> SimpleNamespace:
    """What the plan is built from, read in one small job over the task
    table: counts, bytes, the bounds of the ranges and the disjoint spans of
    days that any task asks for.  At most one row a day of the calendar
    reaches the driver; none grows with the log."""
    step = lambda day, n: F.struct(F.col(day).alias("day"), F.lit(n).cast("bigint").alias("n"))
    steps = parsed.where("start_date < end_date").select(
        F.inline(F.array(step("start_date", 1), step("end_date", -1)))).groupBy("day").agg(F.sum("n").alias("n"))
    profile = parsed.agg(
        F.count(F.lit(1)).alias("n_tasks"), F.count_distinct("task_id").alias("n_ids"),
        F.count_if(F.col("start_date").isNull() | F.col("end_date").isNull()).alias("n_undated"),
        F.coalesce(F.sum(F.octet_length("task_param")), F.lit(0)).alias("n_bytes"),
        F.count_if(F.col("keywords").isNotNull()).alias("n_kw"), F.count_if(F.col("category_ids").isNotNull()).alias("n_cat"))
    rows = profile.select(F.lit(None).cast("date").alias("day"), F.to_json(F.struct("*")).alias("v")).unionByName(
        steps.select("day", F.col("n").cast("string").alias("v"))).collect()
    bounds = sorted((r.day, int(r.v)) for r in rows if r.day is not None)
    spans, open_, began = [], 0, None
    for day, n in bounds:
        if not open_:
            began = day
        open_ += n
        if not open_:
            spans.append((began, day))
    facts = next(json.loads(r.v) for r in rows if r.day is None)
    return SimpleNamespace(**facts, bounds=[day for day, _ in bounds], spans=spans)


def _balanced(conds: list[Column]) -> Column:
    """OR of many conditions without a deep tree."""
    while len(conds) > 1:
        conds = [or_(*pair) if len(pair) == 2 else pair[0] for pair in
                 (conds[i:i + 2] for i in range(0, len(conds), 2))]
    return conds[0]


def _fewer(spans, most: int = SPANS):
    """At most ``most`` spans, the smallest gaps between them closed."""
    gaps = sorted(range(1, len(spans)), key=lambda i: spans[i][0] - spans[i - 1][1])
    closed = set(gaps[:max(0, len(spans) - most)])
    out = []
    for i, (lo, hi) in enumerate(spans):
        if i in closed:
            out[-1] = (out[-1][0], hi)
        else:
            out.append((lo, hi))
    return out


def _cut_log(action_log: DataFrame, spans, cut_col: str | None) -> DataFrame:
    """The log cut to the spans on the raw column, pushed to the scan, so
    row groups and partitions between them are skipped."""
    if not spans:
        return action_log.filter(F.lit(False))
    col = cut_col or raw_cut_column(action_log)
    return action_log.filter(_balanced([day_range_on(action_log, col, lo, hi) for lo, hi in _fewer(spans)])
                             & placed_on_a_day(action_log))


def pieces_of(spark: SparkSession, facts: SimpleNamespace) -> DataFrame:
    """Every day that a task asks for (day) and the first day of its piece
    (piece): at most one row a day of the calendar."""
    ends = {hi for _, hi in facts.spans}
    cuts = [(a, b) for a, b in zip(facts.bounds, facts.bounds[1:], strict=False) if a not in ends]
    rows = spark.createDataFrame(cuts, "piece date, upto date")
    return rows.select(F.explode(F.sequence("piece", F.date_sub("upto", 1))).alias("day"), "piece")


def listed_values(tasks: DataFrame, kind: str, column: str) -> DataFrame:
    """The posting list of a task column: value, task_id and its range."""
    return tasks.where("start_date < end_date").select(
        F.lit(kind).alias("kind"), F.explode(F.array_distinct(column)).alias("value"), "task_id", "start_date", "end_date")


def session_pieces(log: DataFrame, pieces: DataFrame, listed: dict[str, DataFrame], by_user: bool, small: bool) -> DataFrame:
    """Combined rows of sessions: per piece one of kind ``all`` with user,
    first and last time and steps, and one per listed value (``kw`` or
    ``cat``) that was used in it."""
    placed = log.join(F.broadcast(pieces), F.col("action_date") == F.col("day"))
    used = [F.struct(F.lit("all").alias("kind"), F.lit("").alias("value"))]
    for kind, value in (("kw", empty_to_null("search_keyword")), ("cat", F.col("click_category_id").cast("string"))):
        if kind in listed:
            values = listed[kind].select(F.col("value").alias(f"{kind}_listed")).distinct()
            placed = placed.withColumn(f"{kind}_value", value).join(
                F.broadcast(values) if small else values, F.col(f"{kind}_value") == F.col(f"{kind}_listed"), "left")
            used.append(F.when(F.col(f"{kind}_listed").isNotNull(),
                               F.struct(F.lit(kind).alias("kind"), F.col(f"{kind}_listed").alias("value"))))
    key = ["user_id", "session_id"] if by_user else ["session_id"]
    rows = placed.select("user_id", "session_id", "piece", "action_time", F.explode(F.array(*used)).alias("used")).where(
        "used IS NOT NULL").select("user_id", "session_id", "piece", "action_time", "used.kind", "used.value")
    whole = F.col("kind") == "all"
    aggs = [] if by_user else [F.min("user_id").alias("uid")]
    return rows.groupBy(*key, "piece", "kind", "value").agg(
        *aggs, F.min(F.when(whole, F.col("action_time"))).alias("lo"), F.max(F.when(whole, F.col("action_time"))).alias("hi"),
        F.count_if(whole).alias("steps"))


def with_users(rows: DataFrame, users: DataFrame, by_user: bool, profession_from_city: bool) -> DataFrame:
    """User attributes and whether the user is known.  Unknown users stay:
    a session belongs to the smallest user in a range, known or not.  A user
    that the dimension holds several times repeats its sessions, as a join
    does: every time is a ``copy`` of the session, and what a copy lacks (the
    parts of other users, listed values) it gets from the first."""
    prof = F.col("city") if profession_from_city else F.col("professional")
    same = Window.partitionBy("u_id")
    attrs = users.select(F.col("user_id").alias("u_id"), "age", prof.alias("professional"), "city", "sex",
                         F.lit(True).alias("known"))
    attrs = attrs.withColumns({"copy": F.row_number().over(same.orderBy(*ATTRIBUTES)),
                               "copies": F.count(F.lit(1)).over(same).cast("int")})
    uid = "user_id" if by_user else "uid"
    joined = rows.join(attrs, F.col(uid) == F.col("u_id"), "left").drop("u_id")
    if by_user:
        joined = joined.withColumn("uid", F.col(uid))
    session = Window.partitionBy(*(["user_id", "session_id"] if by_user else ["session_id"]))
    most = F.max(F.coalesce("copies", F.lit(1))).over(session)
    told = joined.withColumns({"copy": F.coalesce("copy", F.lit(1)), "copies": F.coalesce("copies", F.lit(1)), "most": most})
    whole, first = F.col("kind") == "all", F.col("copy") == 1
    lacking = F.when(first & (F.col("most") > F.col("copies")), F.sequence(F.col("copies") + 1, "most")).otherwise(F.array())
    to = F.when(whole, F.concat(F.array("copy"), lacking)).when(first, F.sequence(F.lit(1), "most")).otherwise(F.array())
    dealt = told.withColumn("to", F.explode(to.cast("array<int>")))
    return dealt.withColumns({"known": F.col("known") & (F.col("to") <= F.col("copies")), "copy": F.col("to")}).drop(
        "copies", "most", "to")


def _wanted(p: str = "p_") -> Column:
    """A task's conditions on the user."""
    def c(name: str) -> Column:
        return F.col(p + name)

    age = c("start_age").isNull() | c("end_age").isNull() | F.col("age").between(c("start_age"), c("end_age"))
    prof = c("professionals").isNull() | F.array_contains(c("professionals"), F.col("professional"))
    city = c("cities").isNull() | F.array_contains(c("cities"), F.col("city"))
    sex = c("sex").isNull() | (F.col("sex") == c("sex"))
    return F.coalesce(age & prof & city & sex & F.col("known"), F.lit(False))


def _bucket(col: str, buckets) -> Column:
    """Number of the bucket, -1 for none."""
    number = F.lit(-1)
    for i, (_, lo, hi) in reversed(list(enumerate(buckets))):
        number = F.when(in_bucket(col, lo, hi), i).otherwise(number)
    return number


def folded(rows: DataFrame, asked: DataFrame, key: list[str]) -> DataFrame:
    """Sessions as cells (task_id NULL: piece and user attributes) where one
    piece holds them, else folded per task; visit and step buckets, whether
    the task's lists are hit, and whether the user fits (NULL in cells and
    in rows with attributes: not decided yet).  All in place: rows are dealt
    by session already, and stay so."""
    session = Window.partitionBy(*key)
    whole = F.col("kind") == "all"
    only = {c: F.max(F.when(whole, F.col(c))).over(session) for c in ("lo", "hi", "steps", *ATTRIBUTES, "known")}
    many = (F.count_if(whole).over(session) > 1).alias("many")
    told = rows.select(*key, "piece", "kind", "value", "uid", "lo", "hi", "steps", *ATTRIBUTES, "known", many,
                       *[c.alias(f"only_{n}") for n, c in only.items()])
    met = told.join(asked, (F.col("kind") == F.col("p_kind")) & (F.col("value") == F.col("p_value"))
                    & (F.col("piece") >= F.col("p_start_date")) & (F.col("piece") < F.col("p_end_date"))
                    & (F.col("many") | (F.col("kind") != "all")), "left")
    met = met.where(F.col("p_task_id").isNotNull() | (whole & ~F.col("many")))
    # The user of a cut session in a range is the smallest there; whether it
    # fits rides in the last bit.
    fits = F.when(whole & F.col("many"), F.col("uid").cast("decimal(21,0)") * F.lit(2).cast("decimal(1,0)")
                  + F.when(_wanted(), 0).otherwise(1).cast("decimal(1,0)"))
    single = lambda c: F.when(~F.col("many"), F.col(f"only_{c}"))
    times = {c: F.coalesce(single(c), F.when(whole, F.col(c))) for c in ("lo", "hi", "steps")}
    rows = met.select(
        *key, "many", F.col("p_task_id").alias("task_id"), F.when(F.col("p_task_id").isNull(), F.col("piece")).alias("cell"),
        *[single(c).alias(c) for c in (*ATTRIBUTES, "known")], *[c.alias(n) for n, c in times.items()],
        fits.alias("fits"), "kind")
    one = rows.groupBy(*key, "many", "task_id", "cell", *ATTRIBUTES, "known").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.when(F.col("many"), F.sum("steps")).otherwise(F.max("steps")).alias("step_length"), F.min("fits").alias("fits"),
        F.max(F.col("kind") == "kw").alias("kw_hit"), F.max(F.col("kind") == "cat").alias("cat_hit"))
    one = one.withColumn("visit_length", seconds_between("lo", "hi"))
    return one.select(
        "task_id", "cell", *ATTRIBUTES, "known", "kw_hit", "cat_hit",
        F.when(F.col("many"), F.coalesce(F.pmod("fits", F.lit(2)) == 0, F.lit(False))).alias("fit"),
        _bucket("visit_length", VISIT_BUCKETS).alias("visit"), _bucket("step_length", STEP_BUCKETS).alias("step"))


def task_outcomes(stats: DataFrame, rejected: DataFrame) -> DataFrame:
    """task_id, outcome (``done`` or why not) and session_count of all tasks
    of a run that leaves bad ones out."""
    return stats.select("task_id", F.lit("done").alias("outcome"), "session_count").unionByName(
        rejected.select("task_id", F.col("reason").alias("outcome"), F.lit(None).cast("bigint").alias("session_count")))


def multi_task_stats(action_log: DataFrame, user_dim: DataFrame, tasks: DataFrame,
                     cut_col: str | None = None, by_user: bool = False,
                     profession_from_city: bool = False, bad_tasks: str = "raise") -> DataFrame:
    """task_id, session_count and the 15 ratios, one row per task.

    ``cut_col`` names the raw column the date cut is stated on (default:
    ``ts``, else ``date``, else ``action_date``; see raw_cut_column).
    ``by_user`` keys sessions by (user, session) (see session_rollup).
    ``profession_from_city`` reproduces the application's profession
    attribute (see attach_users).  ``bad_tasks`` is ``raise`` or ``skip``."""
    if bad_tasks not in ("raise", "skip"):
        raise ValueError(f"unknown bad_tasks {bad_tasks!r}")
    parsed = parse_tasks(tasks)
    if bad_tasks == "skip":
        parsed = parsed.withColumn("problem", task_problem()).where("problem IS NULL").drop("problem")
    facts = task_facts(parsed)
    if facts.n_undated:
        raise ValueError(f"{facts.n_undated} task(s) without a valid startDate / endDate")
    if facts.n_ids != facts.n_tasks:
        raise LookupError(f"task ids are not unique ({facts.n_tasks} rows, {facts.n_ids} ids)")
    small = facts.n_bytes <= TASK_BYTES
    sent = F.broadcast if small else (lambda df: df)
    listed = {}
    if facts.n_kw:
        listed["kw"] = listed_values(parsed, "kw", "keywords")
    if facts.n_cat:
        listed["cat"] = listed_values(parsed, "cat", "category_ids")

    log = _cut_log(action_log, facts.spans, cut_col)
    key = ["user_id", "session_id", "copy"] if by_user else ["session_id", "copy"]
    rows = with_users(session_pieces(log, pieces_of(action_log.sparkSession, facts), listed, by_user, small), user_dim,
                      by_user, profession_from_city)
    predicates = ("start_age", "end_age", "professionals", "cities", "sex")
    dated = parsed.where("start_date < end_date")
    asked = dated.select(F.lit("all").alias("kind"), F.lit("").alias("value"), "task_id", "start_date", "end_date", *predicates)
    for values in listed.values():
        asked = asked.unionByName(values, allowMissingColumns=True)
    asked = asked.select(*[F.col(c).alias(f"p_{c}") for c in asked.columns])
    counted = folded(rows, sent(asked), key)
    counted = counted.groupBy(*counted.columns).agg(F.count(F.lit(1)).alias("n"))

    # Cells meet every task without a list; folded rows their own.
    needs = [F.col("keywords").isNotNull().alias("p_kw"), F.col("category_ids").isNotNull().alias("p_cat")]
    own = dated.select("task_id", *[F.col(c).alias(f"p_{c}") for c in ("start_date", "end_date", *predicates)], *needs)
    own = own.select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("p_cells")).where(
        ~(F.col("p_cells") & (F.col("p_kw") | F.col("p_cat")))).withColumn("p_at", F.when(~F.col("p_cells"), F.col("task_id")))
    at = counted.withColumnRenamed("task_id", "c_task_id").withColumn("cells", F.col("cell").isNotNull())
    inside = ~F.col("cells") | ((F.col("cell") >= F.col("p_start_date")) & (F.col("cell") < F.col("p_end_date")))
    met = at.join(sent(own), (F.col("cells") == F.col("p_cells"))
                  & (F.coalesce("c_task_id", F.lit(0)) == F.coalesce("p_at", F.lit(0))) & inside)
    hit = (~F.col("p_kw") | F.col("kw_hit")) & (~F.col("p_cat") | F.col("cat_hit"))
    kept = met.where(hit & F.coalesce("fit", _wanted()))
    names = ["session_count"] + [f"n_{c}" for c in STAT_COLUMNS[1:]]
    zero = F.lit(0).cast("bigint")
    sums = [F.col("n")] + [F.when(F.col(column) == i, F.col("n")).otherwise(zero)
                           for column, buckets in (("visit", VISIT_BUCKETS), ("step", STEP_BUCKETS))
                           for i in range(len(buckets))]
    per = kept.select("task_id", *[c.alias(n) for c, n in zip(sums, names, strict=True)]).unionByName(
        parsed.select("task_id", *[zero.alias(n) for n in names]))
    totals = per.groupBy("task_id").agg(*[F.sum(n).alias(n) for n in names])
    return totals.select("task_id", "session_count", *ratio_columns())
