"""JSON Column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitlens.functions.strings import empty_to_null

# Task parameters: every value is a JSON array and its first element is
# used; a multi-value parameter is comma text inside that one element.


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_param(task_param: Column | str, name: str) -> Column:
    """First element of the JSON array under ``name`` as text (numbers as
    their text); NULL when the name is absent, the array is empty, or the
    element is the empty string.  Read per field, so one malformed field
    does not hide the others."""
    return empty_to_null(F.get_json_object(_col(task_param), f"$.{name}[0]"))


def json_int_field(text: Column | str, field: str) -> Column:
    """Whole-number field of a JSON object text (a number or a numeric
    string); NULL when absent or not a whole number (1.5 is NULL)."""
    v = F.get_json_object(_col(text), f"$.{field}")
    return F.when(v.rlike(r"^[+-]?\d+\z"), v.try_cast("bigint"))


def json_objects(text: Column | str) -> Column:
    """JSON array of flat objects -> array<map<string,string>> (explode it
    to get one row per object).  Single-quoted JSON is accepted."""
    return F.from_json(_col(text), "array<map<string,string>>", {"allowSingleQuotes": "true"})
