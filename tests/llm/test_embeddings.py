import numpy as np
import pytest
from pyspark.sql import functions as F

from visitlens.llm import cross_polytope as C, multi_index as M


def vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 20))
    rows = [b + rng.normal(size=20) * s for b in base for s in (0, 0, 0.02, 0.05, 0.1, 0.2, 0.4)]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(rows)]
    n = len(rows)
    rows += [(n, None), (n + 1, [0.0] * 20), (n + 2, [float("nan")] * 20), (n + 3, [None] + [1.0] * 19),
             (n + 4, [float("inf")] * 20), (n + 5, []), (n + 6, rows[0][1][:10]), (n + 7, [2 * x for x in rows[3][1]]),
             (None, rows[0][1]), rows[5], (n + 8, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return rows, df.select("*", F.lit(1).alias("id"), F.lit(2).alias("v"))


def usable(v, n=None):
    ok = bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    return ok and (n is None or len(v) == n)


@pytest.mark.parametrize("chunk", [C.CHUNK, 4])
def test_links_against_all_pairs(spark, chunk):
    rows, df = vectors(spark)
    known = [(i, np.array(v)) for i, v in rows if i is not None and usable(v)]
    links, reach = {i: 0 for i, _ in known}, {i: {i} for i, _ in known}
    for a, (i, x) in enumerate(known):
        for b, (j, y) in enumerate(known):
            if a != b and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.95:
                links[i] += 1
                reach[i].add(j)
    low = {i: i for i in links}
    for _ in range(len(low)):
        low = {i: min(low[j] for j in reach[i]) for i in low}
    got = C.near_duplicates(df, chunk=chunk).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_links, r.component_id) == (links.get(r.vec_id, 0), low.get(r.vec_id, r.vec_id)), r
        assert r.kept == (r.vec_id == r.component_id)
    assert C.near_duplicates(df.where("1 = 0")).count() == 0


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(C.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(C.hadamard(C.hadamard(x)), x)


def test_traverse_order():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.normal(size=5), rng.normal(size=7)
        counts = rng.integers(0, 4, (5, 7))
        wanted = int(rng.integers(1, counts.sum() + 2))
        taken = M.traverse(a, b, counts, wanted)
        sums = (a[:, None] + b[None, :]).ravel()
        order = np.argsort(sums)
        n = min(35, int(np.searchsorted(np.cumsum(counts.ravel()[order]), wanted)) + 1)
        assert set(np.flatnonzero(taken.ravel())) == set(order[:n])


def test_search_of_everything_is_exact(spark):
    rows, df = vectors(spark)
    known = [(i, np.array(v)) for i, v in rows if i is not None and usable(v, 20)]
    got = M.nearest_neighbours(df, F.col("vec_id") % 5 == 0, k=20, centroids=4, share=1.0).collect()
    for i in {i for i, _ in known if i % 5 == 0}:
        q = next(v for j, v in known if j == i)
        best = sorted((-float(q @ v), j) for j, v in known if j != i)[:20]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == i)
        assert [m[0] for m in mine] == list(range(1, 21))
        assert np.allclose([m[2] for m in mine], [-s for s, _ in best])
    assert M.nearest_neighbours(df.where("1 = 0"), F.col("vec_id") % 5 == 0).count() == 0
    few = M.nearest_neighbours(df.where("vec_id < 4"), F.col("vec_id") == 0, k=20, centroids=4).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3]
    score = {j: float(dict(known)[0] @ v) for j, v in known if 0 < j < 4}
    assert [r.vec_id for r in sorted(few, key=lambda r: r.rank)] == sorted(score, key=lambda j: (-score[j], j))


@pytest.mark.parametrize("same", range(7))
def test_one_id_on_all_rows(spark, same):
    rng = np.random.default_rng(same)
    rows = [(same * 5, rng.normal(size=8).tolist()) for _ in range(40)] + [(same * 5 + 1, [1.0] * 8)] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = M.nearest_neighbours(df, F.col("vec_id") % 5 == 0, k=20, centroids=4, share=1.0, fit_rows=4).collect()
    assert [r.vec_id for r in got] == [same * 5 + 1] * 2


def test_each_length_has_its_own_ranks(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6 if i % 3 else 4).tolist()) for i in range(60)] + [(61, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = M.nearest_neighbours(df, F.col("vec_id") % 5 == 0, k=3, centroids=4, share=1.0).collect()
    for i, v in rows:
        if i % 5 == 0:
            best = sorted((-float(np.dot(v, w)), j) for j, w in rows if j != i and len(w) == len(v))[:3]
            assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == i] == [j for _, j in best]


def test_very_large_and_small_components(spark):
    rows = [(0, [1e200, 2e200]), (1, [1e200, 2.01e200]), (2, [1e-200, -2e-200]), (3, [1.01e-200, -2e-200]),
            (4, [1.0, 2.0]), (5, [5e-324, 1e-323]), (6, [2.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in C.near_duplicates(df).collect()}
    assert got == {0: (3, 0), 1: (3, 0), 2: (1, 2), 3: (1, 2), 4: (3, 0), 5: (3, 0), 6: (0, 6)}


def test_recall(spark):
    from cases import SF_ORACLE
    from visitlens.llm.queries import op4_multi_index

    table = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], float)
    found = op4_multi_index(spark, SF_ORACLE).collect()
    hit = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        score[q] = -np.inf
        best = set(ids[np.lexsort((ids, -score))[:20]])
        hit += len(best & {r.vec_id for r in found if r.query_id == ids[q]})
        total += 20
    assert hit / total >= 0.9
