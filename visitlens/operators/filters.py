"""Task conditions as Column predicates.

A condition whose parameter is absent is left out (it passes every row).
A given condition fails on a missing data value: NULL in a ``filter``
drops the row.  All conditions are combined into one conjunction so that
Catalyst can push the user-attribute parts below the session/user join.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.sources.tasks import TaskParams


def _ts_literal(day: dt.date) -> Column:
    return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")


def raw_cut_column(df: DataFrame) -> str:
    """The column a date cut should be stated on so that it reaches the
    scan: the raw event time ``ts`` of the test log, else the raw ``date``
    text of the application's layout, else the typed ``action_date``."""
    for name in ("ts", "date", "action_date"):
        if name in df.columns:
            return name
    raise ValueError("the action log has no ts, date or action_date column")


def day_range_on(df: DataFrame, col: str, start: dt.date, end: dt.date) -> Column:
    """[start, end) on ``col`` in its own type: timestamp bounds at
    midnight, date bounds, or ``yyyy-MM-dd`` text bounds (fixed-width text
    orders like the date; this is also how the application compares)."""
    kind = df.schema[col].dataType
    c = F.col(col)
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        lo, hi = _ts_literal(start), _ts_literal(end)
        if isinstance(kind, T.TimestampType):
            lo, hi = lo.cast("timestamp"), hi.cast("timestamp")
        return (c >= lo) & (c < hi)
    if isinstance(kind, T.StringType):
        return (c >= F.lit(start.isoformat())) & (c < F.lit(end.isoformat()))
    return (c >= F.lit(start)) & (c < F.lit(end))


def cut_to_days(df: DataFrame, start: dt.date, end: dt.date, col: str | None = None) -> DataFrame:
    """Rows of ``df`` whose day is in [start, end), stated on the raw column
    (see raw_cut_column) so the bounds are pushed to the scan."""
    col = col or raw_cut_column(df)
    return df.filter(day_range_on(df, col, start, end) & placed_on_a_day(df))


def placed_on_a_day(df: DataFrame) -> Column:
    """Of a log with date text, rows whose text is a date; every other log
    is typed and needs no test."""
    if {"date", "action_date"} <= set(df.columns):
        return F.col("action_date").isNotNull()
    return F.lit(True)


def age_between(start_age: int | None, end_age: int | None, col: str = "age") -> Column | None:
    """Both ends inclusive; ignored unless both ends are given."""
    if start_age is None or end_age is None:
        return None
    return F.col(col).between(start_age, end_age)


def any_of(col: str, values: tuple[str, ...] | None) -> Column | None:
    """Single-valued column equals one of the listed values."""
    if values is None:
        return None
    return F.col(col).isin(list(values))


def equals(col: str, value: str | None) -> Column | None:
    if value is None:
        return None
    return F.col(col) == F.lit(value)


def all_of(preds) -> Column:
    """Conjunction of the given predicates; None entries are skipped."""
    return reduce(and_, [p for p in preds if p is not None], F.lit(True))


def user_conditions(p: TaskParams) -> list[Column]:
    return [
        age_between(p.start_age, p.end_age),
        any_of("professional", p.professionals),
        any_of("city", p.cities),
        equals("sex", p.sex),
    ]


def behaviour_conditions_on_flags(p: TaskParams) -> list[Column]:
    """Keyword / category conditions on the per-session flags made by
    session_rollup()."""
    return [
        F.col("keyword_hit") if p.keywords is not None else None,
        F.col("category_hit") if p.category_ids is not None else None,
    ]


def session_filter(p: TaskParams) -> Column:
    """All task conditions of a session joined with its user."""
    return all_of(user_conditions(p) + behaviour_conditions_on_flags(p))
