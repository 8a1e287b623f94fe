"""Removal of repeated word windows by level-wise doubling.

A window of ``window`` words can repeat only if the shorter windows in it
do.  Level 1 looks at windows of a quarter of the length: of every full
window, the one with the least hash stands for it, so equal windows have
equal, equally placed short ones.  Only full windows whose short window
repeats go on to the next level, where the short length is doubled; the last
doubling (two halves that may overlap) reaches the full window, all of whose
survivors are compared by 128-bit fingerprints: two hashes of every word, each
of whole words by mixed steps of eight bytes, joined with two bases.  The levels
end early where no candidates survive.  Words are removed where a repeated
window covers them; windows are judged on the input.

Defined cases: null, empty and blank texts have no words and keep an empty
text; texts with fewer words than a window keep them all; a repeated row is
another place where its windows start; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from visitlens.llm import fingerprints as fp
from visitlens.llm.common import pieces, row_bytes

WINDOW = 35
BLOCK_BYTES = 4 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of joined texts, and the number
    of the first word of each text (with the total at the end)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return starts, ends, fp.hash_runs(data, starts, ends), np.searchsorted(starts, offsets)


def gram_lengths(window: int) -> list[int]:
    """Lengths of the short windows: doubled while they stay shorter."""
    first = max(1, -(-window // 4))
    return [k for k in (first, 2 * first) if k < window]


class _Block:
    """The chunks of a block with the windows that have survived so far."""

    def __init__(self, texts: pa.ChunkedArray, window: int, buckets: int):
        self.window, self.buckets = window, buckets
        self.chunks = []
        for a, b, data, off in fp.chunks(texts):
            starts, ends, units, first = word_units(data, off)
            self.chunks.append((a, b, data, off, starts, ends, units, first))
        self.alive = [fp.starts_with_room(c[7], window) for c in self.chunks]

    def short(self, k: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Distinct minima of the surviving windows, whether one stands at
        two places of this block, and each window's minimum."""
        found, least = [], []
        for chunk, alive in zip(self.chunks, self.alive, strict=True):
            if not alive.any():
                least.append(np.zeros(len(alive), np.uint64))
                continue
            gram = fp.window_hash(chunk[6], k)
            low, _, values = fp.minimizers(gram, alive, self.window - k + 1)
            found.append(values)
            least.append(low)
        values, counts = np.unique(np.concatenate([*found, np.zeros(0, np.uint64)]), return_counts=True)
        return values, counts > 1, least

    def full(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct fingerprints (two words) of the surviving windows,
        whether one stands twice, and which one each window has."""
        one, two = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for chunk, alive in zip(self.chunks, self.alive, strict=True):
            if alive.any():
                one.append(fp.window_hash(chunk[6], self.window)[alive])
                again = fp.hash_runs(chunk[2], chunk[4], chunk[5], True)
                two.append(fp.window_hash(again, self.window, 1)[alive])
        h, g = np.concatenate(one), np.concatenate(two)
        order = np.lexsort((g, h))
        h, g = h[order], g[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        number = np.empty(len(h), np.int64)
        number[order] = np.cumsum(new) - 1
        counts = np.diff(np.append(np.flatnonzero(new), len(h)))
        return h[new], g[new], counts > 1, number, order

    def narrow(self, values: np.ndarray, least: list[np.ndarray], got: dict[int, bytes]) -> None:
        repeated = decode(values, got, self.buckets)
        known = values[repeated]
        self.alive = [alive & (fp.among(low, known) >= 0) for alive, low in zip(self.alive, least, strict=True)]


def decode(values: np.ndarray, got: dict[int, bytes], buckets: int) -> np.ndarray:
    out = np.zeros(len(values), bool)
    for bucket, a, b in fp.bucket_cuts(values, buckets):
        out[a:b] = fp.unbits(got[bucket], b - a)
    return out


def _survivors(texts: pa.ChunkedArray, replies: pa.Table | None, upto: int, window: int, buckets: int):
    block = _Block(texts, window, buckets)
    for level, k in enumerate(gram_lengths(window)[:upto]):
        values, twice, least = block.short(k)
        block.narrow(values, least, fp.bodies(replies, level))
    return block


def _send(block_no: int, texts, replies, level: int, window: int, buckets: int) -> pa.Table:
    lengths = gram_lengths(window)
    block = _survivors(texts, replies, level, window, buckets)
    rows = []
    if level < len(lengths):
        values, twice, _ = block.short(lengths[level])
        for bucket, a, b in fp.bucket_cuts(values, buckets):
            rows.append((bucket, values[a:b].tobytes() + fp.bits(twice[a:b])))
    else:
        values, second, twice, _, _ = block.full()
        for bucket, a, b in fp.bucket_cuts(values, buckets):
            rows.append((bucket, values[a:b].tobytes() + second[a:b].tobytes() + fp.bits(twice[a:b])))
    return fp.sent(block_no, level, rows)


def _answer(table: pa.Table, level: int, words: int) -> pa.Table:
    """Per bucket: a fingerprint repeats if it came from two blocks or
    stands twice in one."""
    bodies = table["body"].to_pylist()
    # n fingerprints of 8 * words bytes, then n bits.
    sizes = [8 * len(x) // (64 * words + 1) for x in bodies]
    keys = [np.concatenate([np.frombuffer(x, np.uint64, n, 8 * n * w) for x, n in zip(bodies, sizes, strict=True)])
            for w in range(words)]
    twice = np.concatenate([fp.unbits(x[8 * words * n:], n) for x, n in zip(bodies, sizes, strict=True)])
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    first = np.flatnonzero(new)
    total = np.add.reduceat(1 + twice[order].astype(np.int64), first)
    repeated = np.empty(len(order), bool)
    repeated[order] = np.repeat(total > 1, np.diff(np.append(first, len(order))))
    ends = np.cumsum(sizes)
    rows = [(b, fp.bits(repeated[e - n:e])) for b, e, n in zip(table["block"].to_pylist(), ends, sizes, strict=True)]
    return fp.answers(level, table["bucket"][0].as_py(), rows)


def _finish(texts, replies, window: int, buckets: int):
    """Per row: words, removed words and the kept text."""
    block = _survivors(texts, replies, len(gram_lengths(window)), window, buckets)
    values, _, _, number, _ = block.full()
    repeated = decode(values, fp.bodies(replies, len(gram_lengths(window))), buckets)[number]
    n_words, n_removed, kept, at = [], [], [], 0
    for (a, b, data, off, starts, ends, units, first), alive in zip(block.chunks, block.alive, strict=True):
        places = np.flatnonzero(alive)
        hit = places[repeated[at:at + len(places)]]
        at += len(places)
        gone = fp.cover(hit, window, len(units))
        n_words.append(np.diff(first))
        removed = np.concatenate([[0], np.cumsum(gone)])[first]
        n_removed.append(np.diff(removed))
        # Keep the bytes of the kept words and one space after each but the
        # last of its text.
        left = np.flatnonzero(~gone)
        step = np.zeros(len(data) + 1, np.int32)
        step[starts[left]] += 1
        np.add.at(step, ends[left], -1)
        keep = np.cumsum(step)[: len(data)] > 0
        text_of = np.searchsorted(first, left, "right")
        more = np.append(text_of[1:] == text_of[:-1], False) if len(left) else np.zeros(0, bool)
        blank = ends[left][more]
        data = data.copy()
        data[blank] = 0x20
        keep[blank] = True
        out_off = np.concatenate([[0], np.cumsum(keep)])[off]
        out = data[keep].tobytes()
        kept += [out[x:y] for x, y in zip(out_off[:-1], out_off[1:], strict=True)]
    join = lambda x: np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64)
    return join(n_words), join(n_removed), kept


def _sender(level: int, window: int, buckets: int, again: bool):
    def first(key, t):
        return _send(key[0].as_py(), t["txt"], None, level, window, buckets)

    def later(key, t, r):
        # A block all of whose documents sent nothing still has its rows.
        return _send(key[0].as_py(), t["txt"], r, level, window, buckets)

    return later if again else first


def _answerer(level: int, words: int):
    def answer(t):
        return _answer(t, level, words)

    return answer


def remove_repeats(df: DataFrame, text: str = "text", window: int = WINDOW,
                   block_bytes: int = BLOCK_BYTES, key: str | None = None) -> DataFrame:
    """All columns of ``df`` but the text, then n_words, n_removed and
    kept_text, in fields ``row`` (struct) and beside it.  ``key`` names a
    number that tells copies of a text apart, so that these are dealt to
    blocks without being counted out."""
    total = df.agg(F.sum(row_bytes(text))).first()[0] or 0
    blocks = pieces(total, block_bytes)
    docs, names = fp.dealt(df, text, key, blocks, block_bytes)
    lengths = gram_lengths(window)
    replies = None
    for level in range(len(lengths) + 1):
        if replies is None:
            out = docs.groupBy("block").applyInArrow(_sender(level, window, blocks, False), fp.SENT)
        else:
            out = docs.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
                _sender(level, window, blocks, True), fp.SENT)
        answer = out.groupBy("bucket").applyInArrow(_answerer(level, 1 if level < len(lengths) else 2), fp.ANSWER)
        replies = answer if replies is None else replies.unionByName(answer)

    carried = [f"c{i}" for i, c in enumerate(names) if c != text]

    def finish(t, r):
        n_words, n_removed, kept = _finish(t["txt"], r, window, blocks)
        out = t.select(carried)
        for name, values in (("n_words", pa.array(n_words, pa.int64())), ("n_removed", pa.array(n_removed, pa.int64())),
                             ("kept_text", pa.array([x.decode() for x in kept], pa.string()))):
            out = out.append_column(name, values)
        return out

    kinds = dict(docs.dtypes)
    schema = ", ".join([f"{c} {kinds[c]}" for c in carried] + ["n_words long", "n_removed long", "kept_text string"])
    done = docs.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(finish, schema)
    row = F.struct(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names) if c != text]) if carried else F.struct(F.lit(None))
    return done.select(row.alias("row"), "n_words", "n_removed", "kept_text")
