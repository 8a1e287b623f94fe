"""Near-duplicate documents by min-max hashing.

Under every random permutation of the shingles both the smallest and the
largest value are kept, so PERMUTATIONS evaluations give twice as many
signature values, each an unbiased witness of the Jaccard similarity.  BAND
values make a band; documents that agree in a band are candidates, and a
link counts only if the full sets confirm it.  At 0.85 a pair agrees in none
of the 24 bands of 4 with probability 2e-8, at 0.8 with 3e-6.

Documents with equal sets form one class and go on as one.  No group is
expanded into all pairs.  In each bucket every class is compared with one
leader; confirmed links make components, and all pairs of at least FAMILY
percent make families.  A family whose classes are not one component yet is
compared in blocks of CHUNK x CHUNK classes, which give component labels and
never their pairs, so a large family is many tasks.  What is left are
classes that meet in a bucket but are of different families, as texts with
a common passage do: such a bucket is compared in the same blocks.  So no
link among the candidates is missed.

Defined cases: texts without words have an empty set and link with nothing;
fewer words than a shingle are one shingle; rows that share a key are one
node; a null key is its own, kept, without a component; other columns are
left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from visitlens.llm import fingerprints as fp
from visitlens.llm.common import cut, release
from visitlens.llm.graph import components, labels
from visitlens.llm.substring import word_units

SHINGLE = 5
PERMUTATIONS = 48
BAND = 4
FAMILY = 40
CHUNK = 256
COLUMNS = 8192
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def shingle_sets(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, offsets): the distinct shingles of each text in ascending
    order, for successive runs of texts."""
    for _, _, data, off in fp.chunks(texts):
        _, _, units, first = word_units(_LOWER[data], off)
        n = np.diff(first)
        room = fp.starts_with_room(first, SHINGLE)
        long = fp.window_hash(units, SHINGLE)[room]
        owner = np.searchsorted(first, np.flatnonzero(room), "right") - 1
        # Short texts: one hash over all words and their number.
        few, of = [], []
        for size in range(1, SHINGLE):
            rows = np.flatnonzero(n == size)
            if len(rows):
                few.append(fp.mix64(fp.window_hash(units, size)[first[:-1][rows]] + np.uint64(size)))
                of.append(rows)
        h, owner = np.concatenate([long, *few]), np.concatenate([owner, *of])
        order = np.lexsort((h, owner))
        h, owner = h[order], owner[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        h, owner = h[new], owner[new]
        yield h, np.searchsorted(owner, np.arange(len(n) + 1))


def signatures(h: np.ndarray, off: np.ndarray, permutations: int) -> np.ndarray:
    """Smallest and largest value of each set (none empty) under each
    permutation, side by side."""
    rng = np.random.default_rng(20240229)
    out = np.empty((len(off) - 1, 2 * permutations), np.uint64)
    for k in range(permutations):
        a = np.uint64(int(rng.integers(1 << 62)) * 2 + 1)
        x = h ^ np.uint64(int(rng.integers(1 << 63)))
        x = x * a
        x ^= x >> np.uint64(32)
        x = x * a
        out[:, 2 * k] = np.minimum.reduceat(x, off[:-1])
        out[:, 2 * k + 1] = np.maximum.reduceat(x, off[:-1])
    return out


def _describe(permutations: int, band: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for h, off in shingle_sets(batch.column("text")):
                n = np.diff(off)
                full = np.flatnonzero(n)
                starts = np.append(off[:-1][full], len(h))
                bands = 2 * permutations // band
                keys = np.zeros((len(n), bands), np.int64)
                prints = np.zeros((len(n), 2), np.int64)
                if len(full):
                    # Deal values out so that a band mixes permutations.
                    signature = signatures(h, starts, permutations).reshape(len(full), band, bands)
                    key = np.full((len(full), bands), 7, np.uint64)
                    for r in range(band):
                        key = fp.mix64(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, r, :])
                    keys[full] = key.view(np.int64)
                    for k, seed in enumerate((0x1234567, 0x89ABCDEF)):
                        prints[full, k] = np.add.reduceat(fp.mix64(h + np.uint64(seed)), starts[:-1]).view(np.int64)
                ends = pa.array(np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(at, len(n)), pa.array(n.astype(np.int64)), pa.array(prints[:, 0]),
                     pa.array(prints[:, 1]), pa.ListArray.from_arrays(ends, pa.array(keys[full].ravel()))],
                    ["key", "n", "p1", "p2", "bands"])
                at += len(n)
        release()
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for h, off in shingle_sets(batch.column("text")):
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").slice(at, len(off) - 1),
                 pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(h.view(np.int64)))], ["key", "s"])
            at += len(off) - 1


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with the sizes of what their full sets share and of
    what either holds."""
    left = sets.select(F.col("key").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("key").alias("b"), F.col("s").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.select("a", "b", shared.alias("shared"), (F.size("sa") + F.size("sb") - shared).alias("either"))


def _block(percent: int):
    """Labels of the classes of one block of a family or bucket."""
    def run(key, t):
        ci, cj = key[-2].as_py(), key[-1].as_py()
        t = t.sort_by("rep")
        ids, chunk = t["rep"].to_pylist(), t["chunk"].to_numpy()
        lists = t["s"].combine_chunks()
        off = lists.offsets.to_numpy().astype(np.int64)
        off -= off[0]
        sizes = np.diff(off)
        _, column = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        owner = np.repeat(np.arange(len(ids)), sizes)
        left, right = np.flatnonzero(chunk == ci), np.flatnonzero(chunk == cj)
        shared = np.zeros((len(left), len(right)), np.float32)
        # Incidence matrices, some columns (shingles) at a time.
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        for a in range(0, int(column[-1]) + 1, COLUMNS):
            x, y = np.searchsorted(column, [a, a + COLUMNS])
            holds = np.zeros((len(ids), COLUMNS), np.float32)
            holds[owner[x:y], column[x:y] - a] = 1
            shared += holds[left] @ holds[right].T
        either = sizes[left][:, None] + sizes[right][None, :] - shared
        i, j = np.nonzero(shared.astype(np.int64) * 100 >= either.astype(np.int64) * percent)
        label = labels(len(ids), left[i], right[j])
        moved = np.flatnonzero(label != np.arange(len(ids)))
        kind = t.schema.field("rep").type
        return pa.table({"a": pa.array([ids[k] for k in moved], kind), "b": pa.array([ids[label[k]] for k in moved], kind)})
    return run


def _blocks(classes: DataFrame, by: list[str], sets: DataFrame, percent: int) -> DataFrame:
    """Labels (a, b) of classes (rep) that are compared with all others of
    their group, which is dealt into ``chunks`` parts."""
    inner = classes.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.struct(
        F.least(j, F.col("chunk")).alias("ci"), F.greatest(j, F.col("chunk")).alias("cj")))
    blocks = inner.select("rep", *by, "chunk", F.explode(pairs).alias("ij")).select("rep", *by, "chunk", "ij.*")
    kind = dict(classes.dtypes)["rep"]
    return blocks.join(sets.toDF("rep", "s"), "rep").groupBy(*by, "ci", "cj").applyInArrow(
        _block(percent), f"a {kind}, b {kind}")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85,
                    permutations: int = PERMUTATIONS, band: int = BAND) -> DataFrame:
    """key, n_shingles, component_id and kept of every row; documents are
    linked if their shingle sets share ``percent`` of a hundred or more."""
    kind = dict(df.dtypes)[key]
    narrow = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    told = cut(narrow.mapInArrow(_describe(permutations, band), f"key {kind}, n long, p1 long, p2 long, bands array<long>"))
    full = told.where("n > 0 AND key IS NOT NULL")
    classes = full.groupBy("p1", "p2", "n").agg(F.min_by(F.struct("key", "bands"), "key").alias("x"))
    classes = classes.select("p1", "p2", "n", F.col("x.key").alias("rep"), F.col("x.bands").alias("bands"))
    in_band = classes.select("rep", "n", F.posexplode("bands").alias("band", "bucket"))
    shared = in_band.groupBy("band", "bucket").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    in_band = cut(in_band.join(shared, ["band", "bucket"]))
    # Full sets of the classes that have a candidate at all.
    wanted = in_band.select(F.col("rep").alias("key")).distinct()
    sets = cut(narrow.where("key IS NOT NULL").join(wanted, "key", "left_semi").mapInArrow(
        _sets, f"key {kind}, s array<long>"))
    rep = cut(full.join(classes.drop("bands"), ["p1", "p2", "n"]).select("key", "rep").distinct())
    # A key with several texts is one node: its classes meet in it.
    several = rep.groupBy("key").agg(F.min("rep").alias("b"), F.max("rep").alias("x")).where("b <> x")
    ties = cut(rep.join(several, "key").select(F.col("rep").alias("a"), "b"))

    # Every class against the leader of each of its buckets.
    close = F.least("n", "m") * 100 >= F.greatest("n", "m") * FAMILY
    first = F.min(F.struct(F.col("rep").alias("b"), F.col("n").alias("m")))
    lead = in_band.groupBy("band", "bucket").agg(first.alias("x")).select("band", "bucket", "x.*")
    stars = in_band.join(lead, ["band", "bucket"]).where("rep <> b").where(close)
    told_pairs = cut(_similar(stars.select(F.col("rep").alias("a"), "b").distinct(), sets))
    links = told_pairs.where(F.col("shared") * 100 >= F.col("either") * percent).select("a", "b").unionByName(ties)
    kin = told_pairs.where(F.col("shared") * 100 >= F.col("either") * FAMILY).select("a", "b").unionByName(ties)
    linked, families = components(links), components(kin)

    # Families of several components, block by block.
    everyone = sets.select(F.col("key").alias("rep"))
    member = everyone.join(families.toDF("rep", "family"), "rep", "left").join(
        linked.toDF("rep", "component"), "rep", "left")
    member = cut(member.select("rep", F.coalesce("family", "rep").alias("family"),
                               F.coalesce("component", "rep").alias("component")))
    parts = member.groupBy("family").agg(F.count("*").alias("c"), F.min("component").alias("x"), F.max("component").alias("y"))
    parts = parts.where("x <> y").select("family", F.ceil(F.col("c") / CHUNK).cast("int").alias("chunks"))
    inside = _blocks(member.join(parts, "family"), ["family"], sets, percent)

    # Classes of different families that meet in a bucket.
    here = cut(in_band.join(member.select("rep", "family"), "rep"))
    apart = here.groupBy("band", "bucket").agg(
        F.min("family").alias("x"), F.max("family").alias("y"), F.min("n").alias("n"), F.max("n").alias("m"),
        F.count("*").alias("c"), F.min("rep").alias("low"), F.max("rep").alias("high"),
        F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("all")).where("x <> y")
    # Two classes of too different sizes cannot link; buckets with the same
    # classes are compared once.
    apart = apart.where((F.col("c") > 2) | (F.col("n") * 100 >= F.col("m") * percent))
    apart = apart.groupBy("c", "low", "high", "all").agg(F.min(F.struct("band", "bucket")).alias("at")).select(
        "at.*", F.ceil(F.col("c") / CHUNK).cast("int").alias("chunks"))
    across = _blocks(here.join(apart, ["band", "bucket"]), ["band", "bucket"], sets, percent)
    found = components(linked.toDF("a", "b").unionByName(inside).unionByName(across))
    # Every class of a key is in one component by now.
    own = rep.groupBy("key").agg(F.min("rep").alias("rep"))
    known = own.join(found.select(F.col("id").alias("rep"), "component"), "rep", "left").select(
        "key", F.coalesce("component", "rep").alias("component"))
    out = told.select("key", "n").join(known, "key", "left")
    component = F.coalesce("component", "key")
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"))
