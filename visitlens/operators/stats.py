"""Session statistics: session count, visit-length and step-length
histograms, and their ratios to the session count.

All 16 counters are computed by one aggregate over the kept sessions
(partial aggregate per task, one tiny final exchange), which is the
fused "filter and count in one pass" of the analysed application.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.functions.numbers import safe_ratio

# Fixed bucket edges of the analysed application (integer seconds / steps,
# both bounds inclusive, None = open).  A visit of 0 seconds lands in no
# bucket but still counts as a session.
VISIT_BUCKETS = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)
STEP_BUCKETS = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)

VISIT_COLUMNS = tuple(f"visit_{name}" for name, _, _ in VISIT_BUCKETS)
STEP_COLUMNS = tuple(f"step_{name}" for name, _, _ in STEP_BUCKETS)
RATIO_COLUMNS = VISIT_COLUMNS + STEP_COLUMNS
STAT_COLUMNS = ("session_count",) + RATIO_COLUMNS


def in_bucket(col: str, lo: int, hi: int | None) -> Column:
    c = F.col(col)
    return c >= lo if hi is None else c.between(lo, hi)


def counter_aggs() -> list[Column]:
    """session_count plus one count per bucket, named n_<ratio column>."""
    aggs = [F.count(F.lit(1)).alias("session_count")]
    aggs += [
        F.count_if(in_bucket("visit_length", lo, hi)).alias(f"n_visit_{name}")
        for name, lo, hi in VISIT_BUCKETS
    ]
    aggs += [
        F.count_if(in_bucket("step_length", lo, hi)).alias(f"n_step_{name}")
        for name, lo, hi in STEP_BUCKETS
    ]
    return aggs


def ratio_columns() -> list[Column]:
    return [safe_ratio(f"n_{c}", "session_count").alias(c) for c in RATIO_COLUMNS]


def bucket_counts(sessions: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return sessions.groupBy(*by).agg(*counter_aggs())


def aggr_stat(sessions: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``by`` + session_count + 15 rounded ratios.  With no grouping the
    result is exactly one row, also when no session is kept (count 0,
    ratios NULL)."""
    counts = bucket_counts(sessions, by)
    return counts.select(*by, "session_count", *ratio_columns())


def _long_form(wide: DataFrame, cols, value_name: str) -> DataFrame:
    return wide.unpivot([], list(cols), "bucket", value_name)


def visit_histogram(sessions: DataFrame) -> DataFrame:
    """(bucket, n) for the 9 visit buckets, zero-filled (one aggregate,
    the same counters as the statistics row)."""
    wide = bucket_counts(sessions).select(*[F.col(f"n_{c}").alias(c) for c in VISIT_COLUMNS])
    return _long_form(wide, VISIT_COLUMNS, "n")


def step_histogram(sessions: DataFrame) -> DataFrame:
    """(bucket, n) for the 6 step buckets, zero-filled."""
    wide = bucket_counts(sessions).select(*[F.col(f"n_{c}").alias(c) for c in STEP_COLUMNS])
    return _long_form(wide, STEP_COLUMNS, "n")


def ratio_long_form(stat: DataFrame, cols) -> DataFrame:
    """(bucket, ratio) from a one-row statistics frame."""
    return _long_form(stat.select(*cols), cols, "ratio")


def label_counts(df: DataFrame, col: str, labels) -> DataFrame:
    """Occurrences of each listed label in ``col``; unseen labels get 0 and
    values not in the list are ignored.  One pass, one output row per
    label (the label list is a fixed, bounded parameter)."""
    wide = df.agg(*[F.count_if(F.col(col) == F.lit(lab)).alias(f"_{i}") for i, lab in enumerate(labels)])
    stacked = wide.select(F.explode(F.array(*[
        F.struct(F.lit(lab).alias("label"), F.col(f"_{i}").alias("n")) for i, lab in enumerate(labels)
    ])).alias("x"))
    return stacked.select("x.label", "x.n")
