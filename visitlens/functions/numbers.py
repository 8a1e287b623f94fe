"""Numeric helpers.

Ratios in the statistics row are rounded to two places *half up on the
exact binary value of the double* (the value a ``BigDecimal`` built from
the double holds).  Spark's ``round`` rounds the decimal text of the
double instead and disagrees on values such as 3/40 (0.075 is stored as
0.07499999999999999722...).  The form below is exact for ratios in
[0, 1]: scaling by 2^62 is exact for every double in [2^-9, 1], and
values below 2^-9 round to 0 either way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_62 = 4611686018427387904
_TWO_61 = 2305843009213693952


def ratio_half_up_sql(expr: str, places: int = 2) -> str:
    """SQL text rounding ``expr`` (a double in [0, 1]) half up at ``places``."""
    scale = 10**places
    return (
        f"cast((cast(cast(({expr}) * {_TWO_62}D as bigint) as decimal(20,0)) * {scale}BD"
        f" + {_TWO_61}BD) div {_TWO_62}BD as double) / {scale}D"
    )


def ratio_half_up(expr: str, places: int = 2) -> Column:
    return F.expr(ratio_half_up_sql(expr, places))


def safe_ratio_sql(numerator: str, denominator: str, places: int = 2) -> str:
    """Rounded numerator / denominator; NULL when the denominator is 0.

    Under ANSI mode a plain division by zero raises, so the denominator is
    guarded with ``nullif``.
    """
    return ratio_half_up_sql(f"({numerator}) / nullif({denominator}, 0)", places)


def safe_ratio(numerator: str, denominator: str, places: int = 2) -> Column:
    return F.expr(safe_ratio_sql(numerator, denominator, places))
