"""Packed k=v|k=v helpers against a Python model of the documented rules
(Java String.split: trailing empty pieces dropped, "" -> [""])."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from visitlens.functions import strings


def jsplit(s: str, pattern: str) -> list[str]:
    if s == "":
        return [""]
    parts = re.split(pattern, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def model_get(s: str, field: str):
    for piece in jsplit(s, r"\|"):
        kv = jsplit(piece, "=")
        if len(kv) == 2 and kv[0] == field:
            return kv[1]
    return None


def model_set(s: str, field: str, value: str) -> str:
    pieces = jsplit(s, r"\|")
    for i, piece in enumerate(pieces):
        if jsplit(piece, "=")[0] == field:
            pieces[i] = f"{field}={value}"
            break
    return "|".join(pieces)


def _ok_for_set(s: str) -> bool:
    # the Java rule throws on a piece made only of '=' (no name at all)
    return not any(p and set(p) == {"="} for p in jsplit(s, r"\|"))


texts = st.text(alphabet="ak=|x", max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=1, max_size=60), st.sampled_from(["a", "k"]))
def test_packed_helpers_follow_the_rules(spark, batch, field):
    df = spark.createDataFrame([(t,) for t in batch], "s string")
    rows = df.select("s", strings.packed_field("s", field).alias("g"),
                     strings.set_packed_field("s", field, F.lit("v")).alias("w")).collect()
    for r in rows:
        assert r.g == model_get(r.s, field), r.s
        if _ok_for_set(r.s):
            assert r.w == model_set(r.s, field, "v"), r.s
