"""Removal of repeated byte strings with suffix arrays by two-stage sorting.

A string of ``length`` bytes is removed where it also starts in a document
with a smaller key.  Strings that can repeat are gathered first: of every
window of ``length`` bytes the least hash of its short grams stands for it,
equal windows have equal ones, and blocks tell buckets which hashes they
hold (module fingerprints).  Successive windows with one such hash form a
piece of text.  A bucket gets the distinct pieces of all blocks, hash by
hash; where a hash has several pieces, it joins them and builds their suffix
array: suffixes smaller than their successors are sorted directly, all
others are induced by one scan over the buckets of first bytes, and common
prefixes of neighbours then show which windows are equal and which document
has each first.  Blocks get one bit per window back.

Hashes in more than ``HOT`` documents would bring many pieces to one bucket;
their windows are compared one by one by 128-bit fingerprints instead, each
sent once per block.

Defined cases: null and empty texts have no bytes; a null key counts as
larger than any; rows with one key are one document and don't remove each
other; texts shorter than ``length`` keep all bytes; other columns pass
through.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from visitlens.llm import fingerprints as fp
from visitlens.llm.common import pieces, release, row_bytes

LENGTH = 50
GRAM = 20
HOT = 256
PIECE_WINDOWS = 64
BLOCK_BYTES = 4 << 20
CHUNK_BYTES = 1 << 18
SORT_BYTES = 1 << 20
_LAST = np.iinfo(np.int64).max


def suffix_array(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Starts of all suffixes of ``text`` (uint8) in order.

    With ``depth``, order is by the first ``depth`` bytes at least (suffixes
    that agree in these may stand in any order); without, it is whole.  Stage
    one sorts the suffixes that are smaller than their successors; stage two
    induces the others from left to right, bucket by bucket: a suffix larger
    than its successor follows as soon as that successor's place is known.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    rise = np.empty(n, np.int16)
    rise[:-1] = text[1:].astype(np.int16) - text[:-1]
    rise[-1] = -1  # the end is smaller than any byte
    # Equal neighbours take the kind of the end of their run.
    at = np.where(rise != 0, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    small = rise[at] > 0
    direct = _sort_direct(text, np.flatnonzero(small), depth or n)
    first = text[direct]
    cuts = np.searchsorted(first, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[int(text[-1])].append(np.array([n - 1]))
    out = []
    for c in range(256):
        layer = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        parts = []
        while len(layer):
            parts.append(layer)
            layer = layer[layer > 0] - 1
            layer = layer[(text[layer] == c) & ~small[layer]]
        bucket = np.concatenate([*parts, direct[cuts[c]:cuts[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        kind = text[before]
        before, kind = before[kind > c], kind[kind > c]
        if not len(kind):
            continue
        order = np.argsort(kind, kind="stable")
        before, kind = before[order], kind[order]
        edges = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
        for a, b in zip(edges, np.append(edges[1:], len(kind)), strict=True):
            waiting[int(kind[a])].append(before[a:b])
    return np.concatenate(out)


def _rows(text: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` bytes from each start, zeros behind the end."""
    padded = np.concatenate([text, np.zeros(width, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, width)[starts]


def _sort_direct(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Starts by the bytes that follow them: 56 at a time, later ones only
    where the earlier agree.  Bytes count from 1, so the end is smaller."""
    shifted = text.astype(np.uint16) + 1 if len(text) and text.max() == 255 else (text + 1).astype(np.uint8)
    if shifted.dtype == np.uint16:
        # Keep the order in two bytes each.
        shifted = np.stack([shifted >> 8, shifted & 255], 1).astype(np.uint8).ravel()
        per = 2
    else:
        per = 1
    width = 56
    groups, order, done = np.zeros(len(starts), np.int64), starts, 0
    while done < depth and len(order):
        key = _rows(shifted, np.minimum((order + done) * per, len(shifted)), width)
        by = np.ascontiguousarray(key).view(f"S{width}").ravel()
        if done:
            # Only starts that share a group are open.
            open_ = np.zeros(len(order), bool)
            same = groups[1:] == groups[:-1]
            open_[1:] |= same
            open_[:-1] |= same
            if not open_.any():
                break
            places = np.flatnonzero(open_)
            sub = np.argsort(by[places], kind="stable")
            sub = sub[np.argsort(groups[places][sub], kind="stable")]
            perm = np.arange(len(order))
            perm[places] = places[sub]
        else:
            perm = np.argsort(by, kind="stable")
        order, by, groups = order[perm], by[perm], groups[perm]
        new = np.ones(len(order), bool)
        new[1:] = (groups[1:] != groups[:-1]) | (by[1:] != by[:-1])
        groups = np.cumsum(new)
        done += width // per
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each place of ``order``, the length of the prefix that its suffix
    shares with the one before, up to ``most``; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    for a in range(1, len(order), 1 << 16):
        b = min(len(order), a + (1 << 16))
        rows = _rows(text, order[a - 1:b], most)
        differ = rows[1:] != rows[:-1]
        out[a:b] = np.where(differ.any(axis=1), differ.argmax(axis=1), most)
        # Suffixes end at the end of the text.
        out[a:b] = np.minimum(out[a:b], len(text) - np.maximum(order[a:b], order[a - 1:b - 1]))
    return out


class _Block:
    def __init__(self, table: pa.Table, length: int, buckets: int):
        self.length, self.buckets = length, buckets
        self.keys = table["num"].combine_chunks().fill_null(_LAST).to_numpy(zero_copy_only=False).astype(np.int64)
        self.chunks = list(fp.chunks(table["txt"], CHUNK_BYTES))
        gram = min(GRAM, length)
        self.least, counts, found = [], [], []
        for a, b, data, off in self.chunks:
            alive = fp.starts_with_room(off, length)
            units = data.astype(np.uint64) + np.uint64(1)
            if not alive.any():
                self.least.append(np.zeros(len(alive), np.uint64))
                continue
            low, places, value = fp.minimizers(fp.window_hash(units, gram), alive, length - gram + 1)
            self.least.append(low)
            doc = np.searchsorted(off, places, "right")
            order = np.argsort(value, kind="stable")  # documents ascend within a value
            value, doc = value[order], doc[order]
            new = np.ones(len(value), bool)
            new[1:] = value[1:] != value[:-1]
            first = np.flatnonzero(new)
            other = new.copy()
            other[1:] |= doc[1:] != doc[:-1]
            found.append(value[first])
            counts.append(np.add.reduceat(other.astype(np.int64), first))
        value, count = np.concatenate([*found, np.zeros(0, np.uint64)]), np.concatenate([*counts, np.zeros(0, np.int64)])
        self.values, inverse = np.unique(value, return_inverse=True)
        self.docs = np.bincount(inverse, count, len(self.values)).astype(np.int64)

    def send_hashes(self) -> list[tuple[int, bytes]]:
        few = np.minimum(self.docs, 255).astype(np.uint8)
        return [(k, self.values[a:b].tobytes() + few[a:b].tobytes())
                for k, a, b in fp.bucket_cuts(self.values, self.buckets)]

    def classify(self, got: dict[int, bytes]) -> None:
        """Pieces and hot windows of this block, from the answers."""
        repeated, hot = np.zeros(len(self.values), bool), np.zeros(len(self.values), bool)
        for k, a, b in fp.bucket_cuts(self.values, self.buckets):
            both = fp.unbits(got[k], 2 * (b - a))
            repeated[a:b], hot[a:b] = both[: b - a], both[b - a:]
        known, is_hot = self.values[repeated], hot[repeated]
        length = self.length
        v, h, size, owner, text, place = [], [], [], [], [], []
        self.hot = []
        for i, ((a, b, data, off), low) in enumerate(zip(self.chunks, self.least, strict=True)):
            at = fp.among(low, known)
            cold = (at >= 0) & ~(is_hot[at] if len(is_hot) else np.zeros(len(at), bool))
            hot_places = np.flatnonzero((at >= 0) & ~cold)
            row = lambda p: a + np.searchsorted(off, p, "right") - 1  # noqa: E731, B023
            if len(hot_places):
                units = data.astype(np.uint64) + np.uint64(1)
                self.hot.append((i, hot_places, fp.window_hash(units, length)[hot_places],
                                 fp.window_hash(units, length, 1)[hot_places], self.keys[row(hot_places)]))
            # Runs of windows with one hash; a gap, as between documents,
            # has hash 0.  Long runs are cut.
            edge = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]])) if len(low) else np.zeros(0, np.int64)
            ends = np.append(edge[1:], len(low))
            keep = cold[edge] if len(edge) else np.zeros(0, bool)
            edge, ends = edge[keep], ends[keep]
            n = -(-(ends - edge) // PIECE_WINDOWS)
            start = np.repeat(edge, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * PIECE_WINDOWS
            width = np.minimum(np.repeat(ends, n) - start, PIECE_WINDOWS)
            if not len(start):
                continue
            v.append(low[start])
            h.append(fp.hash_runs(data, start, start + width + length - 1))
            size.append(width)
            owner.append(self.keys[row(start)])
            place.append(np.stack([np.full(len(start), i), start], 1))
        join = lambda x, kind: np.concatenate([*x, np.zeros(0, kind)])
        self.v, self.h = join(v, np.uint64), join(h, np.uint64)
        self.size, self.owner = join(size, np.int64), join(owner, np.int64)
        self.place = np.concatenate([*place, np.zeros((0, 2), np.int64)]).astype(np.int64)
        # Distinct pieces, in the order of their hashes, with the smallest key.
        order = np.lexsort((self.owner, self.h, self.v))
        vs, hs = self.v[order], self.h[order]
        new = np.ones(len(order), bool)
        new[1:] = (vs[1:] != vs[:-1]) | (hs[1:] != hs[:-1])
        self.first = order[new]
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.cumsum(new) - 1
        # Distinct hot windows with the smallest key.
        one = join([x[2] for x in self.hot], np.uint64)
        two = join([x[3] for x in self.hot], np.uint64)
        key = join([x[4] for x in self.hot], np.int64)
        order = np.lexsort((key, two, one))
        new = np.ones(len(order), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        self.hot_first = order[new]
        self.hot_number = np.empty(len(order), np.int64)
        self.hot_number[order] = np.cumsum(new) - 1
        self.hot_one, self.hot_two, self.hot_key = one, two, key

    def send_pieces(self) -> list[tuple[int, bytes]]:
        out = []
        values = self.v[self.first]
        for k, a, b in fp.bucket_cuts(values, self.buckets):
            own = self.first[a:b]
            texts = [self.chunks[i][2][s:s + w + self.length - 1].tobytes()
                     for (i, s), w in zip(self.place[own].tolist(), self.size[own].tolist(), strict=True)]
            out.append((k, struct.pack("<I", len(own)) + values[a:b].tobytes() + self.owner[own].tobytes()
                        + self.size[own].astype(np.uint8).tobytes() + zlib.compress(b"".join(texts), 1)))
        return out

    def send_hot(self) -> list[tuple[int, bytes]]:
        one, two, key = (x[self.hot_first] for x in (self.hot_one, self.hot_two, self.hot_key))
        return [(k, one[a:b].tobytes() + two[a:b].tobytes() + key[a:b].tobytes())
                for k, a, b in fp.bucket_cuts(one, self.buckets)]

    def removed(self, piece_bits: dict[int, bytes], hot_bits: dict[int, bytes]) -> list[np.ndarray]:
        """Mask over the bytes of each chunk."""
        values = self.v[self.first]
        widths = self.size[self.first]
        base = np.cumsum(widths) - widths
        told = np.zeros(int(widths.sum()), bool)
        for k, a, b in fp.bucket_cuts(values, self.buckets):
            n = int(widths[a:b].sum())
            told[base[a]:base[a] + n] = fp.unbits(piece_bits[k], n)
        hits: list[list[np.ndarray]] = [[] for _ in self.chunks]
        # Windows of a piece: the first document's as told, later ones' all.
        later = self.owner > self.owner[self.first][self.number] if len(self.v) else np.zeros(0, bool)
        reps = self.size
        inner = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        gone = told[np.repeat(base[self.number], reps) + inner] | np.repeat(later, reps) if len(reps) else np.zeros(0, bool)
        chunk = np.repeat(self.place[:, 0], reps)[gone]
        start = (np.repeat(self.place[:, 1], reps) + inner)[gone]
        cut = np.searchsorted(chunk, np.arange(len(self.chunks) + 1))
        for i in range(len(self.chunks)):
            hits[i].append(start[cut[i]:cut[i + 1]])
        one = self.hot_one[self.hot_first]
        told = np.zeros(len(one), bool)
        for k, a, b in fp.bucket_cuts(one, self.buckets):
            told[a:b] = fp.unbits(hot_bits[k], b - a)
        gone = told[self.hot_number] | (self.hot_key > self.hot_key[self.hot_first][self.hot_number]) \
            if len(one) else np.zeros(0, bool)
        at = 0
        for i, places, *_ in self.hot:
            hits[i].append(places[gone[at:at + len(places)]])
            at += len(places)
        return [fp.cover(np.unique(np.concatenate(x)), self.length, len(c[2]))
                for x, c in zip(hits, self.chunks, strict=True)]


def _answer_hashes(t: pa.Table, hot: int) -> pa.Table:
    bodies = t["body"].to_pylist()
    sizes = [len(x) // 9 for x in bodies]
    value = np.concatenate([np.frombuffer(x, np.uint64, n) for x, n in zip(bodies, sizes, strict=True)])
    count = np.concatenate([np.frombuffer(x, np.uint8, n, 8 * n) for x, n in zip(bodies, sizes, strict=True)])
    _, inverse = np.unique(value, return_inverse=True)
    total = np.bincount(inverse, count)[inverse]
    ends = np.cumsum(sizes)
    rows = [(b, fp.bits(np.concatenate([total[e - n:e] > 1, total[e - n:e] > hot])))
            for b, e, n in zip(t["block"].to_pylist(), ends, sizes, strict=True)]
    return fp.answers(0, t["bucket"][0].as_py(), rows)


def _window_minima(v, owner, size, texts: list[bytes], length: int) -> np.ndarray:
    """For every window of distinct pieces (sorted by hash v), the smallest
    owner of any piece that holds it."""
    base = np.cumsum(size) - size
    out = np.repeat(owner, size)
    new = np.concatenate([[True], v[1:] != v[:-1]])
    group = np.cumsum(new) - 1
    several = np.flatnonzero(np.bincount(group)[group] > 1)
    if not len(several):
        return out
    # Batches of whole groups of about SORT_BYTES.
    run = np.cumsum(size[several] + length)
    batch = (run - 1) // SORT_BYTES
    g = group[several]
    batch = np.maximum.reduceat(batch, np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])))[
        np.cumsum(np.concatenate([[True], g[1:] != g[:-1]])) - 1]
    for b in np.unique(batch):
        own = several[batch == b]
        # Bytes of UTF-8 end at 0xF4: counted from 1, 0 parts the pieces.
        joined = np.frombuffer(b"\xff".join(texts[i] for i in own), np.uint8) + np.uint8(1)
        lengths = size[own] + length - 1
        begin = np.cumsum(lengths + 1) - lengths - 1
        window = np.zeros(len(joined) + 1, np.int32)
        window[begin] += 1
        np.add.at(window, begin + size[own], -1)
        is_start = np.cumsum(window[:-1]) > 0
        order = suffix_array(joined, length)
        order = order[is_start[order]]
        fresh = common_prefixes(joined, order, length) < length
        first = np.flatnonzero(fresh)
        piece = own[np.searchsorted(begin, order, "right") - 1]
        least = np.minimum.reduceat(owner[piece], first)
        least = np.repeat(least, np.diff(np.append(first, len(order))))
        inside = order - begin[np.searchsorted(begin, order, "right") - 1]
        out[base[piece] + inside] = least
    return out


def _answer_pieces(t: pa.Table, length: int) -> pa.Table:
    v, owner, size, texts, counts = [], [], [], [], []
    for body in t["body"].to_pylist():
        n = struct.unpack_from("<I", body)[0]
        v.append(np.frombuffer(body, np.uint64, n, 4))
        owner.append(np.frombuffer(body, np.int64, n, 4 + 8 * n))
        size.append(np.frombuffer(body, np.uint8, n, 4 + 16 * n).astype(np.int64))
        joined, at = zlib.decompress(body[4 + 17 * n:]), 0
        for w in size[-1].tolist():
            texts.append(joined[at:at + w + length - 1])
            at += w + length - 1
        counts.append(n)
    v, owner, size = np.concatenate(v), np.concatenate(owner), np.concatenate(size)
    # Distinct texts of each hash, with the smallest owner.
    number: dict[tuple[int, bytes], int] = {}
    ids = np.array([number.setdefault(x, len(number)) for x in zip(v.tolist(), texts, strict=True)], np.int64)
    order = np.lexsort((owner, ids))
    order = order[np.concatenate([[True], ids[order][1:] != ids[order][:-1]])]
    order = order[np.argsort(v[order], kind="stable")]
    least = _window_minima(v[order], owner[order], size[order], [texts[i] for i in order], length)
    base = np.empty(len(number), np.int64)
    base[ids[order]] = np.cumsum(size[order]) - size[order]
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    gone = least[np.repeat(base[ids], size) + inner] < np.repeat(owner, size)
    rows, at, k = [], 0, 0
    for block, n in zip(t["block"].to_pylist(), counts, strict=True):
        w = int(size[k:k + n].sum())
        rows.append((block, fp.bits(gone[at:at + w])))
        at, k = at + w, k + n
    return fp.answers(1, t["bucket"][0].as_py(), rows)


def _answer_hot(t: pa.Table) -> pa.Table:
    bodies = t["body"].to_pylist()
    sizes = [len(x) // 24 for x in bodies]
    one, two, key = (np.concatenate([np.frombuffer(x, kind, n, 8 * n * k) for x, n in zip(bodies, sizes, strict=True)])
                     for k, kind in enumerate((np.uint64, np.uint64, np.int64)))
    order = np.lexsort((key, two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    first = np.flatnonzero(new)
    least = np.empty(len(order), np.int64)
    least[order] = np.repeat(key[order][first], np.diff(np.append(first, len(order))))
    gone = least < key
    ends = np.cumsum(sizes)
    rows = [(b, fp.bits(gone[e - n:e])) for b, e, n in zip(t["block"].to_pylist(), ends, sizes, strict=True)]
    return fp.answers(2, t["bucket"][0].as_py(), rows)


def _kept(t: pa.Table, r: pa.Table, length: int, buckets: int):
    block = _Block(t, length, buckets)
    block.classify(fp.bodies(r, 0))
    n_bytes, n_removed, n_spans, kept, spans = [], [], [], [], []
    for (a, b, data, off), gone in zip(
            block.chunks, block.removed(fp.bodies(r, 1), fp.bodies(r, 2)), strict=True):
        inside = np.concatenate([[False], gone, [False]])
        edge = np.zeros(len(data) + 1, bool)
        edge[off] = True
        starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
        ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
        count = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[off])
        cuts = np.searchsorted(starts, off)
        n_bytes.append(np.diff(off))
        n_removed.append(count(gone))
        n_spans.append(np.diff(cuts))
        where = np.concatenate([[0], np.cumsum(~gone)])[off]
        out = data[~gone].tobytes()
        kept += [out[x:y] for x, y in zip(where[:-1], where[1:], strict=True)]
        for d, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            spans.append(np.stack([starts[x:y], ends[x:y]], 1).ravel() - off[d])
    join = lambda x: pa.array(np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64))
    return join(n_bytes), join(n_removed), join(n_spans), kept, spans


def remove_earlier(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                   block_bytes: int = BLOCK_BYTES, as_text: bool = False, hot: int = HOT, with_spans: bool = True) -> DataFrame:
    """row (all columns but the text), n_bytes, n_removed, n_spans, spans
    (from and to of the removed runs, one after another; null where not asked
    for) and kept (bytes, or with ``as_text`` a string without the characters
    that a cut parts)."""
    blocks = pieces(df.agg(F.sum(row_bytes(text))).first()[0] or 0, block_bytes)
    docs, names = fp.dealt(df, text, key, blocks, block_bytes)
    # As many tasks as blocks, whatever the session's number.
    docs = docs.repartition(blocks, "block")

    def hashes(k, t):
        out = fp.sent(k[0].as_py(), 0, _Block(t, length, blocks).send_hashes())
        release()
        return out

    def windows(k, t, r):
        block = _Block(t, length, blocks)
        block.classify(fp.bodies(r, 0))
        number = k[0].as_py()
        out = pa.concat_tables([fp.sent(number, 1, block.send_pieces()), fp.sent(number, 2, block.send_hot())])
        del block
        release()
        return out

    def answer_hashes(t):
        return _answer_hashes(t, hot)

    def answer(k, t):
        out = _answer_pieces(t, length) if k[0].as_py() == 1 else _answer_hot(t)
        release()
        return out

    carried = [f"c{i}" for i, c in enumerate(names) if c != text]

    def finish(t, r):
        n_bytes, n_removed, n_spans, kept, spans = _kept(t, r, length, blocks)
        out = t.select(carried)
        for name, values in (("n_bytes", n_bytes), ("n_removed", n_removed), ("n_spans", n_spans),
                             ("spans", pa.array(spans if with_spans else [None] * t.num_rows, pa.list_(pa.int64()))),
                             ("kept", pa.array([x.decode(errors="ignore") for x in kept], pa.string()) if as_text
                              else pa.array(kept, pa.binary()))):
            out = out.append_column(name, values)
        release()
        return out

    first = docs.groupBy("block").applyInArrow(hashes, fp.SENT).groupBy("bucket").applyInArrow(
        answer_hashes, fp.ANSWER)
    second = docs.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(windows, fp.SENT)
    second = second.groupBy("level", "bucket").applyInArrow(answer, fp.ANSWER)
    replies = first.unionByName(second)
    kinds = dict(docs.dtypes)
    schema = ", ".join([f"{c} {kinds[c]}" for c in carried]
                       + ["n_bytes long, n_removed long, n_spans long, spans array<long>, kept " + ("string" if as_text else "binary")])
    done = docs.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(finish, schema)
    fields = [F.col(f"c{i}").alias(c) for i, c in enumerate(names) if c != text] or [F.lit(None).alias("none")]
    return done.select(F.struct(*fields).alias("row"), "n_bytes", "n_removed", "n_spans", "spans", "kept")
