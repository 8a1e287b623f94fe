"""Nearest neighbours by inner product with an inverted multi-index.

Vectors of each length have an index of their own.  They are cut in two halves and each half has its own codebook of
CENTROIDS centroids (k-means on a sample of at most FIT_ROWS vectors, chosen
by a hash of their id).  Every vector is indexed in the cell of its two
nearest centroids.  A query takes cells in the order of their summed
distance (the negative inner products of its halves with the centroids),
with a heap over pairs of the two sorted lists, until the cells hold SHARE
of all vectors and more than k; their entries are then ranked by the exact
inner product.

Entries are dealt by their first centroid and, where one holds many, into
chunks; queries into blocks; each task ranks a block of queries against a
chunk of entries, so neither a hot cell nor many queries fill one task.  A
query crosses the network once per first centroid, with the second ones it
visits as a bit mask.

Defined cases: vectors that are null, zero or hold null or non-finite
components, and rows without an id, take no part; vectors of different
lengths are never each other's neighbours; rows that repeat an id are entries of their
own, never of a query with that id, and queries that repeat an id are asked
once for each length, with the least vector; fewer than k candidates are all returned.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from visitlens.llm.common import cut, pieces, sample
from visitlens.llm.vectors import by_length, lists

CENTROIDS = 64
FIT_ROWS = 16_384
SHARE = 0.55
ENTRIES = 8_192
QUERIES = 4_096
TRAVERSED = 256


def k_means(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centre = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = nearest(x, centre)
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=len(centre))
        centre = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centre)
    return centre


def nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return ((centre * centre).sum(axis=1)[None, :] - 2 * x @ centre.T).argmin(axis=1)


def traverse(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: float) -> np.ndarray:
    """Mask of the cells taken: pairs in ascending order of first[u] +
    second[v] until they hold ``wanted`` entries."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[a].tolist(), second[b].tolist()
    held = counts[a][:, b].tolist()
    taken = np.zeros(counts.shape, bool)
    heap, got, picked = [(x[0] + y[0], 0, 0)], 0, []
    while heap and got < wanted:
        _, i, j = heapq.heappop(heap)
        picked.append((i, j))
        got += held[i][j]
        # Each pair is pushed once: along the row, and down from its start.
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
    i, j = np.array(picked).T
    taken[a[i], b[j]] = True
    return taken


def _assign(dim: int, books: list[np.ndarray]):
    half = dim // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, rows, x in by_length(batch.column("v")):
                if n == dim:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(pa.array(rows)), batch.column("asks").take(pa.array(rows)), lists(x),
                         pa.array(nearest(x[:, :half], books[0]).astype(np.int32)),
                         pa.array(nearest(x[:, half:], books[1]).astype(np.int32))], ["id", "asks", "v", "u", "w"])
    return run


def _visits(dim: int, books: list[np.ndarray], counts: np.ndarray, wanted: float):
    half = dim // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows, x in by_length(batch.column("v")):
                one, two = -x[:, :half] @ books[0].T, -x[:, half:] @ books[1].T
                at, us, masks = [], [], []
                for r in range(len(rows)):
                    taken = traverse(one[r], two[r], counts, wanted)
                    u = np.flatnonzero(taken.any(axis=1))
                    at.append(np.full(len(u), r))
                    us.append(u)
                    masks.append(np.packbits(taken[u], axis=1))
                at = np.concatenate(at)
                masks = np.concatenate(masks)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(rows[at])), lists(x[at]),
                     pa.array(np.concatenate(us).astype(np.int32)), pa.array([m.tobytes() for m in masks], pa.binary())],
                    ["id", "v", "u", "mask"])
    return run


def _rank(k: int):
    def run(left, right):
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        right = right.sort_by("id")
        square = lambda t: t["v"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
        q, e = square(left), square(right)
        q_id, e_id, w = left["id"].to_numpy(), right["id"].to_numpy(), right["w"].to_numpy()
        masks = np.unpackbits(np.frombuffer(b"".join(left["mask"].to_pylist()), np.uint8).reshape(len(q), -1), axis=1)
        out = []
        for s in range(0, len(q), 256):
            score = np.einsum("qd,ed->qe", q[s:s + 256], e)
            score[(masks[s:s + 256][:, w] == 0) | (q_id[s:s + 256, None] == e_id[None, :])] = -np.inf
            best = np.argsort(-score, axis=1, kind="stable")[:, :k]  # equal scores: ids ascend
            value = np.take_along_axis(score, best, 1)
            i, j = np.nonzero(np.isfinite(value))
            out.append((q_id[s + i], e_id[best[i, j]], value[i, j]))
        a, b, c = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table({"query_id": a, "vec_id": b, "score": c})
    return run


def nearest_neighbours(df: DataFrame, asks: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20,
                       centroids: int = CENTROIDS, share: float = SHARE, fit_rows: int = FIT_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found for every row
    where ``asks`` holds."""
    spark = df.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    rows = df.select(F.col(key).cast("long").alias("id"), F.coalesce(asks, F.lit(False)).alias("asks"),
                     F.col(vector).cast("array<double>").alias("v")).where("id IS NOT NULL")
    fine = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
                      & F.exists("v", lambda x: x != 0))
    lengths = fine.groupBy(F.size("v").alias("n")).count().orderBy("n").collect()
    if not lengths:
        return spark.createDataFrame([], result)
    found = [_of_length(fine.where(F.size("v") == r.n), r.n, r["count"], k, centroids, share, fit_rows) for r in lengths]
    return functools.reduce(DataFrame.unionByName, found)


def _of_length(rows: DataFrame, dim: int, total: int, k: int, centroids: int, share: float, fit_rows: int) -> DataFrame:
    spark = rows.sparkSession
    half = dim // 2
    fitted = sample(rows, ["id", "v"], fit_rows, total).select("v").toArrow()
    (_, _, x), = by_length(fitted["v"])
    books = [k_means(x[:, :half], centroids, 1), k_means(x[:, half:], centroids, 2)]
    index = cut(rows.mapInArrow(_assign(dim, books), "id long, asks boolean, v array<double>, u int, w int"))
    # One count per cell: at most CENTROIDS^2 numbers.
    cells = index.groupBy("u", "w").count().toArrow()
    counts = np.zeros((len(books[0]), len(books[1])), np.int64)
    counts[cells["u"].to_numpy(), cells["w"].to_numpy()] = cells["count"].to_numpy()
    wanted = max(share * counts.sum(), k + 1)
    n_asked = index.where("asks").count()
    # Few bytes, much work: the traversal is dealt by the number of queries.
    asked = index.where("asks").groupBy("id").agg(F.min("v").alias("v")).repartition(pieces(n_asked, TRAVERSED), "id")
    n_blocks = F.lit(pieces(n_asked, QUERIES))
    per = spark.createDataFrame([(u, max(1, -(-int(n) // ENTRIES))) for u, n in enumerate(counts.sum(axis=1))],
                                "u int, chunks int")
    visits = asked.mapInArrow(_visits(dim, books, counts, wanted), "id long, v array<double>, u int, mask binary")
    visits = visits.join(F.broadcast(per), "u").select(
        "id", "v", "u", "mask", F.pmod(F.xxhash64("id"), n_blocks).alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    entries = index.join(F.broadcast(per), "u").select(
        "id", "v", "u", "w", F.pmod(F.xxhash64("id", "v"), F.col("chunks")).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0).cast("long"), n_blocks.cast("long") - 1)).alias("block"))
    visits = visits.withColumn("block", F.col("block").cast("long"))
    near = visits.groupBy("u", "chunk", "block").cogroup(entries.groupBy("u", "chunk", "block")).applyInArrow(
        _rank(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
