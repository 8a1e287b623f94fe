"""Exact top-k by inner product: columnar branch and bound.

Components become integers, floor(scale * x).  Candidates are packed in
blocks in vertical layout: the matrix of a block is cut by dimensions into
strips, each contiguous.  A query takes the strips in the order of its own
mass in them and adds up partial scores; by Cauchy and Schwarz the strips to
come can add at most the product of what mass is left on both sides.
Candidates whose partial score plus that bound stays below the query's k-th
best so far go, and the survivors are compacted before the next strip.

Every LEAD-th vector of a pack is searched first.  The k-th best score there
is a proven least score, with which the search of all other vectors starts;
so a cell of queries and candidates returns few rows, and their number grows
with the queries, not with queries times cells.  Queries are dealt into
blocks and packs into stripes, both of bounded bytes; a task takes the packs
of one stripe one after another past one block of queries.

Arithmetic is exact: in doubles where no sum can reach 2^53, in whole numbers
of any size otherwise.

Defined cases: vectors that are null or hold null or non-finite components,
and rows without an id, take no part; a zero vector scores 0; an empty one
scores 0 with other empty ones; vectors of different lengths have no score
together, each length is ranked among its own; rows that repeat an id are
candidates of their own, never of a query with that id; queries that repeat
an id are asked once, with the least of their vectors; fewer than k
candidates are all returned; a score beyond 64 bits counts as the nearest
long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from visitlens.llm.common import cut, pieces

SCALE = 64
STRIP = 16
LEAD = 16
PACK = 4_096
LEAST_QUERIES, LEAST_CANDIDATES = 64, 2_048
BLOCK_BYTES = 16 << 20
_EXACT = float(1 << 53)
_LONG = (-(1 << 63), (1 << 63) - 1)

_PACKS = pa.schema([("n", pa.int32()), ("lead", pa.bool_()), ("stripe", pa.int32()), ("ids", pa.binary()),
                    ("body", pa.binary())])
_ASKED = pa.schema([("n", pa.int32()), ("block", pa.int32()), ("ids", pa.binary()), ("body", pa.binary()),
                    ("least", pa.binary())])
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _body(x: np.ndarray) -> bytes:
    """A matrix as bytes: single precision where that loses nothing."""
    with np.errstate(over="ignore"):
        single = x.astype(np.float32)
    same = (single.astype(np.float64) == x).all()
    return (b"f" if same else b"d") + (single if same else np.ascontiguousarray(x)).tobytes()


def _matrix(body: bytes, rows: int, n: int) -> np.ndarray:
    kind = np.float32 if body[:1] == b"f" else np.float64
    return np.frombuffer(body, kind, offset=1).astype(np.float64).reshape(rows, n)


def _matrices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix) for each length in a column of full vectors."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    first = np.cumsum(sizes) - sizes
    for n in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == n)
        yield n, rows, values[first[rows][:, None] + np.arange(n)]


def _pack(stripes: int):
    """Packs of candidates as they come from the scan, dealt to stripes by
    their place there: no row is shuffled alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth = 0
        for batch in batches:
            ids, part = batch.column("id").to_numpy(), batch.column("part")
            rows = []
            for n, at, x in _matrices(batch.column("v")):
                for a in range(0, len(at), PACK):
                    lead = np.arange(a, min(a + PACK, len(at)))
                    for first, some in ((True, lead[::LEAD]), (False, lead[lead % LEAD != a % LEAD])):
                        if len(some):
                            stripe = (part[0].as_py() * 7919 + nth) % stripes
                            rows.append((n, first, stripe, ids[at[some]].tobytes(), _body(x[some])))
                    nth += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PACKS.types,
                                                                             strict=True)], schema=_PACKS)
    return run


def _pack_queries(t: pa.Table) -> pa.Table:
    x = _matrices(t["v"].combine_chunks())
    (n, _, matrix), = x
    least = t["least"].cast(pa.float64(), safe=False).fill_null(-np.inf).to_numpy()
    return pa.table([[n], [t["block"][0].as_py()], [t["id"].to_numpy().tobytes()], [_body(matrix)],
                     [least.tobytes()]], schema=_ASKED)


class Candidates:
    """A pack in vertical layout: strips of dimensions, and the mass (sum of
    squares) of every vector in each."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, scale: int):
        self.ids, self.x, self.scale = ids, x, scale
        with np.errstate(over="ignore"):
            whole = np.floor(scale * x)
        self.most = float(np.abs(whole).max(initial=0))
        cuts = range(0, max(1, x.shape[1]), STRIP)
        self.strips = [np.ascontiguousarray(whole[:, a:a + STRIP].T) for a in cuts]
        with np.errstate(over="ignore"):
            self.mass = [np.einsum("dn,dn->n", s, s) for s in self.strips]
        self.total = np.sum(self.mass, axis=0)


class Query:
    def __init__(self, number: int, x: np.ndarray, least: float, scale: int):
        self.id, self.x, self.least = number, x, least
        with np.errstate(over="ignore"):
            whole = np.floor(scale * x)
        self.most = float(np.abs(whole).max(initial=0))
        self.strips = [whole[a:a + STRIP] for a in range(0, max(1, len(x)), STRIP)]
        with np.errstate(over="ignore"):
            self.mass = np.array([float(s @ s) for s in self.strips])
        self.order = np.argsort(-self.mass, kind="stable").tolist()
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def search(self, pack: Candidates, k: int) -> None:
        """Bring the best of a pack into the query's k best."""
        others = np.flatnonzero(pack.ids != self.id)
        if not len(others):
            return
        most = len(self.x) * self.most * pack.most
        if not most < _EXACT:  # inf and nan too
            ids, scores = pack.ids[others], self._wide(pack, others)
        else:
            ids, scores = self._bounded(pack, others, k)
        if not len(ids):
            return
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        best = np.lexsort((ids, np.invert(scores)))[:k]  # ~score falls as score rises, without overflow
        self.ids, self.scores = ids[best], scores[best]
        if len(best) == k:
            self.least = max(self.least, float(self.scores[-1]))

    def _bounded(self, pack: Candidates, alive: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        whole = len(alive) == len(pack.ids)
        score, rest, mass = np.zeros(len(alive)), pack.total[alive], float(self.mass.sum())
        for nth, s in enumerate(self.order):
            strip, own = pack.strips[s], pack.mass[s]
            score = score + self.strips[s] @ (strip if whole else strip[:, alive])
            if nth + 1 == len(self.order):
                break
            rest = rest - (own if whole else own[alive])
            mass -= float(self.mass[s])
            # Whole numbers below 2^53: the sums are exact, the root is
            # rounded up by more than its error.
            slack = np.sqrt(rest * max(mass, 0.0)) * (1 + 1e-9) + 1e-3
            least = self.least
            if least == -np.inf and len(score) > k:
                least = float(np.partition(score - slack, -k)[-k])
            keep = np.flatnonzero(score + slack >= least)
            if len(keep) < len(alive):
                alive, score, rest, whole = alive[keep], score[keep], rest[keep], False
            if not len(alive):
                break
        keep = score >= self.least
        return pack.ids[alive[keep]], score[keep].astype(np.int64)

    def _wide(self, pack: Candidates, rows: np.ndarray) -> np.ndarray:
        ints = lambda x: [int(np.floor(pack.scale * v)) if abs(v) < 1e15 else pack.scale * int(v) for v in x]
        mine = ints(self.x.tolist())
        scores = [sum(a * b for a, b in zip(mine, ints(x), strict=True)) for x in pack.x[rows].tolist()]
        return np.array([min(max(s, _LONG[0]), _LONG[1]) for s in scores], np.int64)


def _cells(k: int, scale: int):
    """Cells come sorted, each with its queries before its packs."""
    def found(queries: list[Query]) -> pa.RecordBatch:
        counts = [len(q.ids) for q in queries]
        join = lambda x: np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.array([q.id for q in queries], np.int64), counts)),
            pa.array(join([q.ids for q in queries])), pa.array(join([q.scores for q in queries]))], schema=_FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, queries = None, []
        for batch in batches:
            for n, block, stripe, ids, body, least in zip(*(batch.column(c) for c in (
                    "n", "block", "stripe", "ids", "body", "least")), strict=True):
                here = (n.as_py(), block.as_py(), stripe.as_py())
                if here != cell:
                    if queries:
                        yield found(queries)
                    cell, queries = here, []
                ids = np.frombuffer(ids.as_py(), np.int64)
                x = _matrix(body.as_py(), len(ids), here[0])
                if least.is_valid:
                    bounds = np.frombuffer(least.as_py(), np.float64).tolist()
                    queries += [Query(i, v, b, scale) for i, v, b in zip(ids.tolist(), x, bounds, strict=True)]
                elif queries:
                    pack = Candidates(ids, x, scale)
                    for query in queries:
                        query.search(pack, k)
        if queries:
            yield found(queries)
    return run


def _searched(asked: DataFrame, packs: DataFrame, blocks: int, stripes: int, k: int, scale: int) -> DataFrame:
    """The k best of every query in every cell; ``asked`` has id, v, least."""
    dealt = asked.select("id", "v", "least", F.size("v").alias("n"),
                         F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))
    queries = dealt.groupBy("n", "block").applyInArrow(_pack_queries, from_arrow_schema(_ASKED))
    each = lambda name, count: F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)
    cells = queries.select("n", "block", each("stripe", stripes), "ids", "body", "least").unionByName(
        packs.select("n", each("block", blocks), F.pmod("stripe", F.lit(stripes)).alias("stripe"), "ids", "body",
                     F.lit(None).cast("binary").alias("least")))
    return (cells.repartition(blocks * stripes, "n", "block", "stripe")
            .sortWithinPartitions("n", "block", "stripe", F.col("least").isNull())
            .mapInArrow(_cells(k, scale), from_arrow_schema(_FOUND)))


def highest(df: DataFrame, asks: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20,
            scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score of the k highest scores of every row
    where ``asks`` holds."""
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("id"), F.coalesce(asks, F.lit(False)).alias("asks"),
                     F.col(vector).cast("array<double>").alias("v")).where("id IS NOT NULL")
    fine = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    size = fine.agg(F.count(F.lit(1)).alias("rows"), F.count_if("asks").alias("asks"),
                    F.sum(F.size("v").cast("long")).alias("parts")).first()
    if not size.asks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # Blocks grow with the table up to a number of bytes.
    most = max(1, BLOCK_BYTES * size.rows // (8 * max(1, size.parts)))
    blocks = pieces(size.asks, min(most, max(LEAST_QUERIES, pieces(size.asks, 4))))
    stripes = pieces(size.rows, min(most, max(LEAST_CANDIDATES, pieces(size.rows, 4))))
    packs = fine.select("id", "v", F.spark_partition_id().alias("part")).mapInArrow(
        _pack(stripes), from_arrow_schema(_PACKS))
    asked = fine.where("asks").groupBy("id").agg(F.min("v").alias("v"))
    unknown = F.lit(None).cast("long").alias("least")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
    lead = cut(ranked(_searched(asked.select("id", "v", unknown), packs.where("lead"), blocks, pieces(stripes, LEAD), k,
                                scale)))
    bound = lead.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    others = _searched(asked.join(bound, "id", "left"), packs.where("NOT lead"), blocks, stripes, k, scale)
    return ranked(lead.drop("rank").unionByName(others)).select("query_id", "rank", "vec_id", "score")
