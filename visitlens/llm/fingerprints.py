"""Window fingerprints of texts, and their exchange between blocks.

Documents are dealt into blocks by a hash.  A block sends the sorted,
distinct fingerprints of its windows to buckets by fingerprint, packed in
one binary row per bucket; a bucket adds up what all blocks sent and answers
each block with one code per fingerprint sent.  So a fingerprint, however
common, crosses the network once per block, a bucket's share is even, and no
group of copies meets in one task.  The answers are small and return to the
block by its number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from visitlens.llm.common import cut, row_bytes, utf8

CHUNK_BYTES = 1 << 20
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits (splitmix64's last steps)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hash(units: np.ndarray, length: int, base: int = 0) -> np.ndarray:
    """Polynomial hash mod 2^64 of every ``length`` successive units, by
    joining windows of powers of two."""
    b = _BASES[base]
    part, size, whole, done = units, 1, None, 0
    while length:
        if length & 1:
            if whole is None:
                whole, done = part, size
            else:
                n = len(units) - done - size + 1
                whole = whole[:max(n, 0)] * np.uint64(pow(b, size, 1 << 64)) + part[done:done + max(n, 0)]
                done += size
        length >>= 1
        if length:
            n = max(0, len(units) - 2 * size + 1)
            part = part[:n] * np.uint64(pow(b, size, 1 << 64)) + part[size:size + n]
            size *= 2
    return mix64(whole)


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: bool = False) -> np.ndarray:
    """Hash of the bytes from each start to its end, eight bytes a step, all
    mixed before the next; ``other`` gives a second, independent one."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    odd = np.uint64(_BASES[other])
    left = ends - starts
    out = mix64(left.astype(np.uint64) * odd + np.uint64(1 + other))
    at, rows = starts, np.arange(len(starts))
    while len(rows):
        value, n = eight[at], left[rows]
        if other:
            value = value * odd
        short = n < 8
        if short.any():
            few = eight[at[short]] & ((np.uint64(1) << (n[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1))
            value[short] = few * odd if other else few
        out[rows] = mix64((out[rows] ^ value) + odd)
        left[rows] -= 8
        more = n > 8
        rows, at = rows[more], at[more] + 8
    return out


def sliding(op: Callable, x: np.ndarray, width: int) -> np.ndarray:
    """Minimum or maximum of every ``width`` successive values."""
    size = 1
    while 2 * size <= width:
        x = op(x[:max(0, len(x) - size)], x[size:])
        size *= 2
    rest = width - size
    return op(x[:max(0, len(x) - rest)], x[rest:]) if rest else x


def starts_with_room(offsets: np.ndarray, window: int) -> np.ndarray:
    """Mask over the starts of all windows of the joined units: True where
    the window stays in its document."""
    n = int(offsets[-1])
    mask = np.zeros(max(0, n - window + 1), bool)
    step = np.zeros(n + 1, np.int32)
    long = np.diff(offsets) >= window
    np.add.at(step, offsets[:-1][long], 1)
    np.add.at(step, offsets[1:][long] - window + 1, -1)
    mask[:] = np.cumsum(step)[: len(mask)] > 0
    return mask


def minimizers(gram: np.ndarray, windows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every window in the mask, the least of its ``width`` gram hashes
    (0 outside the mask); the places that hold one of these minima, and
    their values.  Minima are small numbers: values are mixed once more, so
    that buckets by value are even."""
    least = sliding(np.minimum, gram, width)
    least = np.where(windows, least, np.uint64(0))
    pad = np.zeros(width - 1, np.uint64)
    most = sliding(np.maximum, np.concatenate([pad, least, pad]), width)
    places = np.flatnonzero(most == gram)
    return mix64(least), places, mix64(gram[places])


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Place of each value in the sorted array ``known``, -1 if absent;
    equal neighbours are looked up once."""
    if not len(values) or not len(known):
        return np.full(len(values), -1, np.int64)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    at = np.searchsorted(known, values[first])
    at[at == len(known)] = 0
    at = np.where(known[at] == values[first], at, -1)
    return np.repeat(at, np.diff(np.append(first, len(values))))


def bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the high half; ascending with the value."""
    return ((values >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def bucket_cuts(values: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the runs of sorted values."""
    if not len(values):
        return
    own = bucket_of(values, buckets)
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    for a, b in zip(first, np.append(first[1:], len(values)), strict=True):
        yield int(own[a]), int(a), int(b)


def cover(starts: np.ndarray, window: int, n: int) -> np.ndarray:
    """Mask of the units that the windows at ``starts`` cover."""
    step = np.zeros(n + 1, np.int32)
    step[starts] += 1
    np.add.at(step, starts + window, -1)
    return np.cumsum(step[:n]) > 0


def chunks(texts: pa.ChunkedArray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of about ``size``
    bytes; a longer document is a run of its own."""
    data, off = utf8(texts)
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + size, "right")) - 1)
        yield a, b, data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


# What blocks send and what buckets answer.
SENT = "bucket int, block int, level int, body binary"
ANSWER = "block int, level int, bucket int, body binary"


def sent(block: int, level: int, rows: list[tuple[int, bytes]]) -> pa.Table:
    n = len(rows)
    return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "block": pa.array([block] * n, pa.int32()),
                     "level": pa.array([level] * n, pa.int32()), "body": pa.array([r[1] for r in rows], pa.binary())})


def answers(level: int, bucket: int, rows: list[tuple[int, bytes]]) -> pa.Table:
    n = len(rows)
    return pa.table({"block": pa.array([r[0] for r in rows], pa.int32()), "level": pa.array([level] * n, pa.int32()),
                     "bucket": pa.array([bucket] * n, pa.int32()), "body": pa.array([r[1] for r in rows], pa.binary())})


def bodies(table: pa.Table, level: int) -> dict[int, bytes]:
    """Answers of one level by bucket."""
    return {b: x for lv, b, x in zip(table["level"].to_pylist(), table["bucket"].to_pylist(), table["body"].to_pylist(),
                                     strict=True) if lv == level}


def bits(mask: np.ndarray) -> bytes:
    return np.packbits(mask).tobytes()


def unbits(body: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(body, np.uint8), count=n).astype(bool)


def dealt(df: DataFrame, text: str, key: str | None, blocks: int,
          most: int | None = None) -> tuple[DataFrame, list[str]]:
    """All columns under names of their own (c0, c1, ...), text as txt, key
    as num, and block: rows are dealt by a hash of key and text.  Rows that
    agree in both go to one block, unless ``most`` is given and they hold
    more than that many bytes together: then each of them is dealt by a
    number of its own, which a checkpoint of these rows fixes."""
    columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns) if c != text]
    txt = F.col(f"`{text}`").cast("string")
    num = F.col(f"`{key}`").cast("long") if key else F.lit(None).cast("long")
    place = lambda *more: F.pmod(F.xxhash64("num", "txt", *more), F.lit(blocks)).cast("int")
    docs = df.select(*columns, txt.alias("txt"), num.alias("num"))
    whole = docs.withColumn("block", place())
    if most is None:
        return whole, df.columns
    same = F.xxhash64("num", "txt")
    held = docs.groupBy(same.alias("same")).agg(F.sum(row_bytes("txt")).alias("held"))
    # Fewer rows than blocks.
    hot = cut(held.where(F.col("held") > most).select("same"))
    if hot.isEmpty():
        return whole, df.columns
    numbered = docs.withColumn("nth", F.monotonically_increasing_id()).withColumn("same", same)
    spread = cut(numbered.join(F.broadcast(hot), "same", "left_semi").withColumn("block", place("nth")))
    rest = whole.withColumn("same", same).join(F.broadcast(hot), "same", "left_anti")
    return rest.select(whole.columns).unionByName(spread.select(whole.columns)), df.columns
