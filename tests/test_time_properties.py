"""Lenient time-text parsing against a Python model of the rule: a
leading "y-M-d H:m:s" (year 1-4 digits, other fields any digits) is read
and trailing text ignored; impossible dates and times give NULL."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from visitlens.functions.dates import parse_time

PREFIX = re.compile(r"^(\d{1,4})-(\d+)-(\d+) (\d+):(\d+):(\d+)")


def model(text: str):
    m = PREFIX.match(text)
    if not m:
        return None
    y, mo, d, h, mi, s = (int(g) for g in m.groups())
    try:
        return dt.datetime(y, mo, d, h, mi, s)
    except ValueError:
        return None


def field(lo: int, hi: int, pad: int):
    return st.tuples(st.integers(lo, hi), st.integers(0, 2)).map(
        lambda t: str(t[0]).zfill(min(pad, len(str(t[0])) + t[1])))


texts = st.builds(
    lambda y, mo, d, h, mi, s, tail: f"{y}-{mo}-{d} {h}:{mi}:{s}{tail}",
    field(1, 9999, 4), field(0, 13, 2), field(0, 32, 2), field(0, 25, 2), field(0, 61, 2), field(0, 61, 2),
    st.sampled_from(["", "x", " UTC", ".250", ":7", "-"]),
) | st.text(alphabet="0123456789-: x", max_size=22)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=1, max_size=80))
def test_parse_time_matches_model(spark, batch):
    df = spark.createDataFrame([(t,) for t in batch], "s string")
    for r in df.select("s", parse_time("s").alias("t")).collect():
        assert r.t == model(r.s), r.s


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 10**12), st.floats(0, 1)), min_size=1, max_size=200))
def test_ratio_rounding_on_large_counts(spark, pairs):
    from decimal import ROUND_HALF_UP, Decimal

    from visitlens.functions.numbers import safe_ratio
    rows = [(int(n * f), n) for n, f in pairs]
    df = spark.createDataFrame(rows, "c bigint, n bigint")
    for r in df.select("c", "n", safe_ratio("c", "n").alias("x")).collect():
        want = float(Decimal(r.c / r.n).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
        assert r.x == want, (r.c, r.n)
