"""Near-duplicate vectors by cross-polytope hashing.

A hash turns the unit vector by three rounds of random signs and a fast
Hadamard transform and takes the nearest vertex of the cross-polytope: the
largest coordinate and its sign.  HASHES of them are a table's bucket.  Every
vector stands in its own bucket and probes the PROBES next likely ones, where
one hash takes its second vertex.  Pairs that meet are verified by cosine in
double precision.

Equal vectors are one class and go on as one with its size.  A pair may meet
in several buckets; it counts in the first table only, and there in one
bucket, which both sides know from their codes.  Buckets are compared in
blocks of CHUNK x CHUNK, so a hot one becomes many tasks, and a block gives
counts and component labels, never its pairs.

Defined cases: a vector that is null, zero or holds null or non-finite
components links with nothing; vectors of other lengths don't link; rows
that share a vec_id are one node whose links add up; a null vec_id is its
own, kept, without a component; no rows give none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from visitlens.llm.common import cut
from visitlens.llm.graph import components, labels
from visitlens.llm.vectors import by_length, levelled, lists

TABLES = 10
HASHES = 2
PROBES = 2
CHUNK = 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast transform of the rows; their length is a power of two."""
    n, half = x.shape[1], 1
    while half < n:
        y = x.reshape(len(x), -1, 2, half)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], 2).reshape(len(x), n)
        half *= 2
    return x / np.sqrt(n)


def codes(unit: np.ndarray, tables: int = TABLES) -> tuple[np.ndarray, np.ndarray]:
    """Own bucket (rows x tables) and probed ones (rows x tables x PROBES)
    as numbers; vectors of different lengths never share one."""
    rows, dim = unit.shape
    width = 1 << max(1, (dim - 1).bit_length())
    rng = np.random.default_rng(71)
    own = np.empty((rows, tables), np.int64)
    probe = np.empty((rows, tables, PROBES), np.int64)
    for t in range(tables):
        best, value = [], []
        for _ in range(HASHES):
            x = np.zeros((rows, width))
            x[:, :dim] = unit
            for _ in range(3):
                x = hadamard(x * rng.choice([-1.0, 1.0], width))
            size = np.abs(x)
            top = np.argsort(-size, axis=1, kind="stable")[:, :2]
            sign = np.take_along_axis(x, top, 1) < 0
            best.append(2 * top + sign)
            value.append(np.take_along_axis(size, top, 1))
        base = dim * tables + t
        name = lambda a, b: (base * 2 * width + a) * 2 * width + b  # noqa: E731, B023
        own[:, t] = name(best[0][:, 0], best[1][:, 0])
        probe[:, t, 0] = name(best[0][:, 1], best[1][:, 0])
        probe[:, t, 1] = name(best[0][:, 0], best[1][:, 1])
    return own, probe


def _coded(tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows, matrix in by_length(batch.column("v")):
                level = levelled(matrix)
                unit = level / np.sqrt((level * level).sum(axis=1))[:, None]
                own, probe = codes(unit, tables)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(rows)), batch.column("size").take(pa.array(rows)), lists(matrix),
                     lists(own), lists(probe.reshape(len(rows), -1))], ["id", "size", "v", "own", "probe"])
    return run


def _block(least: float):
    def run(key, t):
        bucket, ci, cj = (k.as_py() for k in key)
        t = t.sort_by("id")
        ids, chunk = t["id"].to_numpy(), t["chunk"].to_numpy()
        sizes, is_own = t["size"].to_numpy(), t["is_own"].to_numpy(zero_copy_only=False)
        square = lambda name, kind: np.array(t[name].combine_chunks().flatten().to_numpy(), kind).reshape(len(ids), -1)
        v, own, probe = square("v", float), square("own", np.int64), square("probe", np.int64)
        probe = probe.reshape(len(ids), own.shape[1], -1)
        v = levelled(v)
        norm = np.sqrt((v * v).sum(axis=1))
        unit = v / norm[:, None]
        left, right = np.flatnonzero(chunk == ci), np.flatnonzero(chunk == cj)
        links = np.zeros(len(ids), np.int64)
        a_all, b_all = [], []
        for s in range(0, len(left), 256):
            rows = left[s:s + 256]
            # A matrix product finds the pairs near enough, whose cosine
            # is then taken pair by pair.
            near = unit[rows] @ unit[right].T >= least - 1e-9
            a, b = np.nonzero(near & (is_own[rows][:, None] | is_own[right][None, :]))
            a, b = rows[a], right[b]
            once = a < b if ci == cj else np.ones(len(a), bool)
            a, b = a[once], b[once]
            for p in range(0, len(a), 1 << 16):
                x, y = a[p:p + (1 << 16)], b[p:p + (1 << 16)]
                sure = np.einsum("pd,pd->p", v[x], v[y]) / norm[x] / norm[y] >= least
                a_all.append(x[sure])
                b_all.append(y[sure])
        a, b = np.concatenate([*a_all, np.zeros(0, np.int64)]), np.concatenate([*b_all, np.zeros(0, np.int64)])
        for s in range(0, len(a), 1 << 16):
            x, y = a[s:s + (1 << 16)], b[s:s + (1 << 16)]
            x, y = np.where(ids[x] < ids[y], x, y), np.where(ids[x] < ids[y], y, x)
            # The bucket that counts a pair: of the first table where the
            # two meet, their own bucket, else that of the smaller id, else
            # that of the larger.
            same = own[x] == own[y]
            low = (probe[y] == own[x][:, :, None]).any(axis=2)
            high = (probe[x] == own[y][:, :, None]).any(axis=2)
            first = (same | low | high).argmax(axis=1)
            at = np.arange(len(x))
            here = np.where(same[at, first] | low[at, first], own[x, first], own[y, first])
            x, y = x[here == bucket], y[here == bucket]
            np.add.at(links, x, sizes[y])
            np.add.at(links, y, sizes[x])
        label = labels(len(ids), a, b)
        keep = np.flatnonzero((links > 0) | (label != np.arange(len(ids))))
        return pa.table({"id": ids[keep], "links": links[keep], "low": ids[label[keep]]})
    return run


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.95,
                    tables: int = TABLES, chunk: int = CHUNK) -> DataFrame:
    """key, n_links, component_id and kept of every row."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    known = rows.where("id IS NOT NULL AND v IS NOT NULL")
    classes = known.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("size"))
    coded = cut(classes.mapInArrow(_coded(tables), "id long, size long, v array<double>, own array<long>, probe array<long>"))
    places = F.concat(F.transform("own", lambda k: F.struct(k.alias("bucket"), F.lit(True).alias("is_own"))),
                      F.transform("probe", lambda k: F.struct(k.alias("bucket"), F.lit(False).alias("is_own"))))
    slim = coded.select("id", F.explode(places).alias("p")).select("id", "p.*")
    # Buckets where two meet, and the blocks that each is cut into.
    buckets = slim.groupBy("bucket").agg(F.count("*").alias("c"), F.max("is_own").alias("any_own")).where(
        "c > 1 AND any_own").select("bucket", F.ceil(F.col("c") / chunk).cast("int").alias("chunks"))
    met = slim.join(buckets, "bucket").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.struct(
        F.least(j, F.col("chunk")).alias("ci"), F.greatest(j, F.col("chunk")).alias("cj")))
    blocks = met.select("*", F.explode(pairs).alias("ij")).select("id", "bucket", "is_own", "chunk", "ij.*")
    done = cut(blocks.join(coded, "id").groupBy("bucket", "ci", "cj").applyInArrow(
        _block(least), "id long, links long, low long"))
    counts = done.groupBy("id").agg(F.sum("links").alias("links"))
    found = components(done.select(F.col("id").alias("a"), F.col("low").alias("b")))
    usable = coded.select(F.col("id").alias("rep"), "v", "size")
    member = known.join(usable, "v").select("id", "rep", (F.col("size") - 1).alias("copies"))
    ties = member.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    whole = components(ties.unionByName(found.select(F.col("id").alias("a"), F.col("component").alias("b"))))
    linked = member.join(counts.withColumnRenamed("id", "rep"), "rep", "left").groupBy("id").agg(
        F.sum(F.col("copies") + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = rows.select("id").join(linked, "id", "left").join(whole, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
