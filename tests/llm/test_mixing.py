import re

from pyspark.sql import functions as F

from cases import SF_SMALL, empty, odd  # noqa: F401
from visitlens.llm import mixing
from visitlens.llm.queries import op9_mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water(sizes):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    rest, target, open_ = 1.5 * sum(sizes.values()), {s: 0.0 for s in names}, set(names)
    while open_:
        unit = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] >= 2 * sizes[s]}
        if not full:
            for s in open_:
                target[s] = unit * weight[s]
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            rest -= target[s]
        open_ -= full
    return target


def holds(rows, docs, fan_in_error=0.5):
    sizes, longest, taken = {}, {}, {}
    size = {}
    for d in docs:
        n = len(WORD.findall(d.text or ""))
        size.setdefault(d.doc_id, set()).add(n)
        sizes[d.source] = sizes.get(d.source, 0) + n
        longest[d.source] = max(longest.get(d.source, 0), n)
    target = water(sizes)
    for r in rows:
        assert r.size in size[r.doc_id]
        assert 0 <= r.taken <= 2 * r.size and (not r.size or r.taken % r.size == 0)
    return sizes, longest, target, taken


def test_query_against_plain(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    rows = op9_mixing(spark, SF_SMALL).collect()
    again = op9_mixing(spark, SF_SMALL).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    assert sorted(r.doc_id for r in rows) == sorted(d.doc_id for d in docs)
    sizes, longest, target, taken = holds(rows, docs)
    source = {d.doc_id: d.source for d in docs}
    for r in rows:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6 * max(1, target[s])
        taken[s] = taken.get(s, 0) + r.taken
        ratio = r.target / r.source_size if r.source_size else 0
        assert r.copies in (int(ratio + 1e-9), int(ratio + 1e-9) + 1, int(ratio - 1e-9), int(ratio - 1e-9) + 1)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= longest[s] / 2 + 1e-6


def mixed(df, **kw):
    rows = df.select(F.struct("*").alias("row"), "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.mix(rows, mixing.source_targets(rows), ["doc_id"], **kw)


def test_odd_rows(odd, empty):
    for fan_in in (2, 5, 96):
        got = mixed(odd, fan_in=fan_in)
        rows = got.select("row.doc_id", "size", "source_size", "target", "copies",
                          (F.col("copies") * F.col("size")).alias("taken"), "row.source", "row._nth").collect()
        docs = odd.collect()
        assert len(rows) == len(docs)
        sizes, longest, target, taken = holds(rows, docs)
        for r in rows:
            assert abs(r.target - target[r.source]) < 1e-6 and r._nth == 11
            taken[r.source] = taken.get(r.source, 0) + r.taken
        for s in sizes:
            assert abs(taken[s] - target[s]) <= longest[s] / 2 + 1e-6, (s, taken[s], target[s])
    assert mixed(empty).count() == 0


def test_water_levels(spark):
    import random

    rng = random.Random(1)
    for _ in range(6):
        sizes = {f"s{i}": rng.choice([0, 1, 5, 100, 10_000, rng.randrange(1, 500)]) for i in range(rng.randrange(1, 9))}
        if rng.random() < 0.5:
            sizes[None] = 40
        df = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        for s, t in water(sizes).items():
            assert abs(got[s] - t) < 1e-6 * max(1, t), sizes


def test_draws_are_unbiased(spark):
    """Over many seeds a row is taken as often as its probability says."""
    df = spark.createDataFrame([(i, "a b c d"[:1 + 2 * (i % 4)], "ab"[i % 2]) for i in range(40)],
                               "doc_id long, text string, source string").cache()
    total = 0
    for seed in range(12):
        total += mixed(df, seed=seed, fan_in=8).agg(F.sum("copies")).first()[0]
    expected = mixed(df).agg(F.sum(F.col("target") / F.col("source_size"))).first()[0]
    assert abs(total / 12 - expected) < 3


def test_repeated_keys_are_units_of_their_own(spark):
    """A third of the rows shares a key or has none: chunks stay small,
    blank rows draw alone, targets are met and reruns agree."""
    for key in (7, None):
        rows = ([(1000 + i, "a b c"[:1 + 2 * (i % 3)], "ab"[i % 2]) for i in range(200)]
                + [(key, "a b c d", "a")] * 200 + [(key, "", "a")] * 100 + [(900, "a b", "b")])
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        units = mixing.numbered(df, [F.col("doc_id")])
        assert units.where("nth IS NULL").select("doc_id").distinct().count() == 201
        assert units.where("nth IS NOT NULL").select("nth").distinct().count() == 300
        placed = units.select("source", F.xxhash64("doc_id", "nth").alias("place"))
        held = placed.groupBy("source", mixing.chunk(0, 63)).count().agg(F.max("count")).first()[0]
        assert held < 30, held
        got = [tuple(r) for r in mixed(df, fan_in=8).select(
            "row.doc_id", "row.source", "size", "copies", "target").collect()]
        assert len(got) == len(rows)
        assert len({c for k, s, n, c, t in got if not n}) == 2
        for s in "ab":
            taken, target = sum(n * c for _, x, n, c, _ in got if x == s), [t for _, x, _, _, t in got if x == s][0]
            assert abs(taken - target) <= 2 + 1e-6
        again = [tuple(r) for r in mixed(df, fan_in=8).select(
            "row.doc_id", "row.source", "size", "copies", "target").collect()]
        assert sorted(map(str, got)) == sorted(map(str, again))


def test_native_plan(odd):
    plan = mixed(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
