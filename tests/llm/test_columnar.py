import numpy as np
import pytest
from pyspark.sql import functions as F

from visitlens.llm import columnar as C


def plain(rows, k):
    """All pairs in whole numbers."""
    def ints(v):
        return [int(np.floor(64 * x)) if abs(x) < 1e15 else 64 * int(x) for x in v]
    fine = [(i, ints(v)) for i, v in rows if i is not None and v is not None
            and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for (i, v), (_, raw) in zip(fine, [r for r in rows if r[0] is not None and r[1] is not None
                                       and all(x is not None and np.isfinite(x) for x in r[1])], strict=True):
        if i % 5 == 0 and (i not in asked or raw < asked[i][1]):
            asked[i] = (v, raw)
    out = set()
    for i, (v, _) in asked.items():
        clip = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
        scored = sorted((-clip(sum(a * b for a, b in zip(v, w))), j) for j, w in fine if j != i and len(w) == len(v))
        out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])}
    return out


def odd_vectors(seed=3, n=300, dim=40):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(6, dim))
    rows = [(i, (base[i % 6] + rng.normal(size=dim) * 0.3).tolist()) for i in range(n)]
    same = rows[7][1]
    rows += [(n + i, same) for i in range(150)]  # a third of all are one vector
    m = 1000
    rows += [(m, None), (m + 5, [0.0] * dim), (m + 1, [float("nan")] * dim), (m + 2, [None] + [1.0] * (dim - 1)),
             (m + 3, [float("inf")] * dim), (m + 10, []), (m + 11, []), (m + 15, [1.5, -2.5]), (m + 16, [1.0, 1.0]),
             (None, same), (5, same), (5, same), rows[10], rows[10]]
    return rows


@pytest.mark.parametrize("huge", [False, True])
def test_scores_against_all_pairs(spark, huge):
    rows = odd_vectors()
    if huge:  # products beyond 2^53, and beyond 64 bits
        rows += [(2000, [1e9] * 40), (2005, [-3e8] * 40), (2010, [1e300] + [1.0] * 39), (2011, [1.7e308] * 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    df = df.select("*", *[F.lit(1).alias(c) for c in ("id", "v", "n", "part", "asks")])
    got = C.highest(df, F.col("vec_id") % 5 == 0, k=9)
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    got = [tuple(r) for r in got.collect()]
    want = plain(rows, 9)
    ranked = lambda found: sorted((q, r, s) for q, r, _, s in found)
    assert ranked(got) == ranked(want)
    # Ties go to the smaller id; a repeated id may stand twice.
    assert set(got) == want


def test_few_candidates_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (3, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in C.highest(df, F.col("vec_id") % 5 == 0).collect()] == [(0, 1, 3, 64 * 32 + 128 * 32)]
    assert C.highest(df.where("1 = 0"), F.col("vec_id") % 5 == 0).count() == 0
    assert C.highest(df.where("vec_id = 3"), F.col("vec_id") % 5 == 0).count() == 0


def test_bounds_drop_candidates_and_keep_ties():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(4000, 64)) * np.linspace(4, 0.01, 64)
    pack = C.Candidates(np.arange(4000), x, 64)
    widths = []
    strips = pack.strips
    pack.strips = [Watched(s, widths) for s in strips]
    query = C.Query(-1, x[17], -np.inf, 64)
    query.search(pack, 5)
    whole = np.floor(64 * x)
    scores = whole @ whole[17]
    best = sorted(zip((-scores).tolist(), range(4000)))[:5]
    assert query.ids.tolist() == [i for _, i in best] and query.scores.tolist() == [-s for s, _ in best]
    assert widths and min(widths) < 400  # the last strips see a tenth


class Watched:
    def __init__(self, strip, widths):
        self.strip, self.widths = strip, widths

    def __getitem__(self, at):
        self.widths.append(len(at[1]))
        return self.strip[at]

    def __rmatmul__(self, other):
        return other @ self.strip

    __array_ufunc__ = None
