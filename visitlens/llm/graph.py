"""Connected components of a link table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from visitlens.llm.common import cut, pieces

# A table of so many pairs of ids (16 bytes each) is sent to all executors;
# a larger one is joined by shuffle.
BROADCAST_ROWS = 200_000
PART_ROWS = 50_000


def _stars(edges: DataFrame, large: bool, small_table: bool) -> DataFrame:
    """One star step over edges (a > b): every node sends the smallest id
    that it sees to its larger neighbours (large star), or to its smaller
    ones and itself (small star)."""
    near_least = F.broadcast if small_table else lambda df: df
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # Larger neighbours v of u are the edges (v, u).
        sent = edges.join(near_least(least.withColumnRenamed("a", "b")), "b").select("a", F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        near = edges.join(near_least(least), "a")
        sent = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return sent.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Columns id and component (the smallest id that it reaches) of all ids
    in ``links`` (columns a and b) that are not the smallest themselves.

    Large and small stars alternate until nothing changes; then every edge
    goes to the smallest id.  Each round is cut by a checkpoint.  Null ids
    and loops are left out.
    """
    edges = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut(edges)
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    before = None
    while True:
        now = edges.agg(mark).first()[0]
        if now == before or not now[0]:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        before, rows = now, now[0]
        small_table = rows <= BROADCAST_ROWS
        edges = cut(_stars(_stars(edges, True, small_table), False, small_table).coalesce(pieces(rows, PART_ROWS)))


def labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest place that each of n places reaches over the pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
