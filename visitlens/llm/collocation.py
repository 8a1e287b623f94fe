"""Collocations: phrases of two and three words, counted in a burst trie.

1. Texts are cut into words once.  Each block of about BLOCK_BYTES becomes a
   row of local word numbers, with marks where a piece ends, and a dictionary
   of its different words with their counts.
2. Dictionaries meet in buckets by a hash of the word.  A bucket sums the
   counts per language and word, gives every word found often enough a number
   (exact words are compared, hashes only deal them) and answers each block
   with the numbers of the words it sent.  A phrase cannot be more frequent
   than its words, so phrases with other words need no counting.
3. A task reads its blocks one after another and counts phrases in a shallow
   trie over word numbers: containers, each a hash table for a range of first
   and second words, in order of the range.  A container that grows beyond
   BURST is split by prefix; when the trie as a whole is beyond LIMIT, whole
   containers are spilled, the largest first, as sorted runs.
4. Runs are dealt by prefix to partitions, some HELD phrases at once, and
   merged there; a prefix of two words has SPREAD places by its third, so a
   hot pair has no task to itself.
5. The phrases that are frequent, few by now, are joined with the counts of
   their parts and ranked.

Nothing of the dictionary is broadcast, and no limit depends on how often a
word occurs.  Defined cases: null texts are empty, a null language counts as
``und``; texts without words give no rows; equal rows count each; a text is
cut into blocks where a piece ends, and a piece longer than a block is one
block; an empty table gives no rows; extra columns play no part.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from visitlens.llm import fingerprints as fp
from visitlens.llm.common import cut, pieces, release, text_bytes, utf8

LEAST = 10
BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 48 << 20
MERGE_BYTES = 4 << 20
RUN = 1 << 20
BURST = 1 << 18
LIMIT = 1 << 20
HELD = 1 << 21
FAN = 16
SPREAD = 64
MILLION = 1_000_000

_END = np.zeros(256, bool)
_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _END.copy()
_GAP[[0x20, 0x09]] = True


_ZSTD = pa.Codec("zstd")


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, in as few bytes as the largest takes: the
    width, then all first bytes, all second bytes and so on."""
    most = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return bytes([width]) + np.ascontiguousarray(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()


def packed(**columns: np.ndarray | pa.Array) -> bytes:
    """Columns of whole numbers from 0 on, or of bytes, compressed together.
    The reader knows their names: tasks times partitions of these are
    written, so each has a few bytes besides its values."""
    parts = []
    for c in columns.values():
        if isinstance(c, pa.Array):
            data, a, b = _bytes_of(c)
            parts += [_planes(b - a), data[a[0]:b[-1]].tobytes() if len(a) else b""]
        else:
            parts.append(_planes(c))
    raw = b"".join(parts)
    rows = len(next(iter(columns.values())))
    return struct.pack("<II", rows, len(raw)) + _ZSTD.compress(raw, asbytes=True)


def unpacked(body: bytes, **columns: type) -> pa.Table:
    """The columns of a packed body, of the types named; ``bytes`` for
    bytes."""
    rows, size = struct.unpack_from("<II", body)
    raw = np.frombuffer(_ZSTD.decompress(body[8:], size, asbytes=True), np.uint8)
    at, out = 0, {}
    for name, kind in columns.items():
        width = int(raw[at])
        planes = raw[at + 1:at + 1 + width * rows].reshape(width, rows)
        values = np.ascontiguousarray(planes.T).view(f"<u{width}").ravel()
        at += 1 + width * rows
        if kind is bytes:
            off = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
            data = raw[at:at + int(off[-1])]
            at += len(data)
            out[name] = pa.Array.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(off), pa.py_buffer(data)])
        else:
            out[name] = pa.array(values.astype(kind))
    return pa.table(out)


# Step 1: words.

def blocks_of(data: np.ndarray, off: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, offsets, rows) of blocks of texts; longer texts are parted
    where a piece ends."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, "right")) - 1)
        if off[b] - off[a] <= most:
            yield data[off[a]:off[b]], off[a:b + 1] - off[a], np.arange(a, b)
        else:
            text = data[off[a]:off[b]]
            ends = np.append(np.flatnonzero(_END[text]) + 1, len(text))
            at = 0
            while at < len(text):
                nth = max(int(np.searchsorted(ends, at + most, "right")) - 1, int(np.searchsorted(ends, at, "right")))
                yield text[at:ends[nth]], np.array([0, ends[nth] - at]), np.array([a])
                at = int(ends[nth])
        a = b


def words_of(data: np.ndarray, off: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The lower-cased words, how many each text has, and whether a word
    begins a piece."""
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_GAP[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    piece = np.cumsum(_END[data] | edge[:-1])
    fresh = np.ones(len(starts), bool)
    fresh[1:] = piece[starts[1:]] != piece[starts[:-1]]
    ends_at = np.concatenate([[0], np.cumsum(ends - starts)])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(ends_at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[inside[1:-1]]))])
    return words, np.diff(np.searchsorted(starts, off)), fresh


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Joined bytes, starts and ends of a binary column."""
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, off[:-1], off[1:]


_BLOCKS = "block long, bucket int, body binary"


def _tokenised(buckets: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            langs = pc.dictionary_encode(batch.column("lang").cast(pa.large_binary()))
            data, off = utf8(batch.column("text"))
            for part, ends, rows in blocks_of(data, off, block_bytes):
                words, counts, fresh = words_of(part, ends)
                if not len(words):
                    continue
                # Numbers of the different (language, word) of the block.
                coded = words.dictionary_encode()
                key = np.repeat(langs.indices.to_numpy()[rows].astype(np.int64) << 32, counts) | coded.indices.to_numpy()
                own, local, n = np.unique(key, return_inverse=True, return_counts=True)
                names = pc.binary_join_element_wise(langs.dictionary.take(pa.array(own >> 32)),
                                                    coded.dictionary.take(pa.array(own & 0xFFFFFFFF)), pa.scalar(b" ", pa.large_binary()))
                to = fp.hash_runs(*_bytes_of(names)) % np.uint64(buckets)
                order = np.argsort(to, kind="stable")
                place = np.empty(len(order), np.int32)  # dictionaries list words by bucket
                place[order] = np.arange(len(order))
                to, names, n = to[order].astype(np.int32), names.take(pa.array(order)), n[order]
                firsts = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
                sent = [(block, int(to[a]), packed(word=names[a:b], n=n[a:b]))
                        for a, b in zip(firsts, np.append(firsts[1:], len(to)), strict=True)]
                sent.append((block, -1, packed(word=place[local], fresh=fresh)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*sent, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)], ["block", "bucket", "body"])
                block += 1
            release()
    return run


# Step 2: numbers for frequent words.

_NUMBERED = "block long, bucket int, body binary, id long, lang string, word string, f long"


def _numbered(buckets: int, least: int):
    def run(t: pa.Table) -> pa.Table:
        bucket = t["bucket"][0].as_py()
        sent = [unpacked(b, word=bytes, n=np.int64) for b in t["body"].to_pylist()]
        every = pa.concat_tables(sent)
        coded = every["word"].combine_chunks().dictionary_encode()
        total = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(total, coded.indices.to_numpy(), every["n"].to_numpy())
        # By falling count, so frequent words have small numbers, then by
        # word: the same numbers in a repeated task.
        order = pc.sort_indices(coded.dictionary).to_numpy()
        often = order[total[order] >= least]
        often = often[np.argsort(-total[often], kind="stable")]
        number = np.full(len(total), -1, np.int64)
        number[often] = bucket + buckets * np.arange(len(often))
        if len(often) and number[often[-1]] >= 1 << 32:
            raise OverflowError("more than 2^32 frequent words")
        answer = number[coded.indices.to_numpy()]
        ends = np.cumsum([s.num_rows for s in sent])
        names = coded.dictionary.to_pylist()
        split = [names[i].rsplit(b" ", 1) for i in range(len(names))]
        sums: dict[bytes, int] = {}
        for (lang, _), n in zip(split, total.tolist(), strict=True):
            sums[lang] = sums.get(lang, 0) + n
        rows = [{"block": b, "bucket": bucket, "body": packed(id=answer[e - s.num_rows:e] + 1)}
                for b, e, s in zip(t["block"].to_pylist(), ends, sent, strict=True)]
        rows += [{"id": int(number[i]), "lang": split[i][0].decode(), "word": split[i][1].decode(), "f": int(total[i])}
                 for i in often]
        rows += [{"lang": lang.decode(), "f": n} for lang, n in sums.items()]
        return pa.Table.from_pylist(rows, _arrow(_NUMBERED))
    return run


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


# Step 3: the trie.

class Container:
    """A hash table from phrases to counts.  ``pair`` holds the first two
    words, ``third`` the third + 1, or 0."""

    def __init__(self):
        self.table, self.fresh, self.waiting = None, [], 0

    def __len__(self) -> int:
        return self.waiting + (self.table.num_rows if self.table is not None else 0)

    def add(self, pair: np.ndarray, third: np.ndarray, n: np.ndarray) -> None:
        self.fresh.append(pa.table({"pair": pair, "third": third, "n": n}))
        self.waiting += len(pair)

    def settle(self) -> pa.Table:
        """All counts, each phrase once."""
        if self.fresh:
            every = pa.concat_tables(([self.table] if self.table is not None else []) + self.fresh)
            self.table = every.group_by(["pair", "third"], use_threads=False).aggregate([("n", "sum")]).rename_columns(
                {"n_sum": "n"}).select(["pair", "third", "n"])
            self.fresh, self.waiting = [], 0
        return self.table


class Trie:
    """Containers in the order of their least prefix; a container's range
    ends where the next begins."""

    def __init__(self, burst: int = BURST, limit: int = LIMIT):
        self.burst, self.limit = burst, limit
        self.lows, self.containers = np.zeros(1, np.uint64), [Container()]

    def __len__(self) -> int:
        return sum(map(len, self.containers))

    def add(self, pair: np.ndarray, third: np.ndarray, n: np.ndarray) -> Iterator[pa.Table]:
        """Count phrases, sorted by pair; gives the subtrees spilled."""
        cuts = np.append(np.searchsorted(pair, self.lows, "left"), len(pair))
        grown = []
        for c, a, b in zip(self.containers, cuts[:-1], cuts[1:], strict=True):
            if a < b:
                c.add(pair[a:b], third[a:b], n[a:b])
                if c.waiting > max(self.burst, len(c) // 2):
                    c.settle()
                    if len(c) > self.burst:
                        grown.append(c)
        for c in grown:
            self._split(c)
        if len(self) > self.limit:
            yield from self._spill(self.limit // 2)

    def _split(self, c: Container) -> None:
        """Burst a container into children by prefix; one that holds a
        single pair stays."""
        t = c.settle()
        pair, third, n = (t[x].to_numpy() for x in ("pair", "third", "n"))
        order = np.argsort(pair, kind="stable")
        pair, third, n = pair[order], third[order], n[order]
        at = self.containers.index(c)
        lows = np.unique(pair[np.arange(1, FAN) * len(pair) // FAN])
        lows = lows[lows > pair[0]]
        if not len(lows):
            return
        cuts = np.concatenate([[0], np.searchsorted(pair, lows, "left"), [len(pair)]])
        children = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            child = Container()
            child.table = pa.table({"pair": pair[a:b], "third": third[a:b], "n": n[a:b]})
            children.append(child)
        self.containers[at:at + 1] = children
        self.lows = np.concatenate([self.lows[:at + 1], lows, self.lows[at + 1:]])

    def _spill(self, down_to: int) -> Iterator[pa.Table]:
        """Whole subtrees as sorted runs, the largest first, until no more
        than ``down_to`` entries are left."""
        held = len(self)
        for at in np.argsort([-len(c) for c in self.containers], kind="stable").tolist():
            if held <= down_to:
                break
            c = self.containers[at]
            if len(c):
                held -= len(c)
                t = c.settle()
                order = np.lexsort((t["third"].to_numpy(), t["pair"].to_numpy()))
                self.containers[at] = Container()
                yield t.take(pa.array(order))

    def drain(self) -> Iterator[pa.Table]:
        yield from self._spill(0)


def phrases(ids: np.ndarray, fresh: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs, thirds and counts of the phrases of numbered words (-1: not
    frequent), sorted, by runs of words."""
    ids, joined = np.append(ids, [-1, -1]), np.append(~fresh, [False, False])
    for a in range(0, len(fresh), RUN):
        part, on = ids[a:a + RUN + 2], joined[a:a + RUN + 2]
        own, rank = np.unique(part, return_inverse=True)  # < 2^21 different ones
        rank = rank.astype(np.uint64)
        good = part >= 0
        two = good[:-2] & good[1:-1] & on[1:-1]
        three = two & good[2:] & on[2:]
        key = (rank[:-2] << np.uint64(42)) | (rank[1:-1] << np.uint64(21))
        both = np.concatenate([key[two], key[three] | (rank[2:][three] + np.uint64(1))])
        keys, n = np.unique(both, return_counts=True)
        low = np.uint64((1 << 21) - 1)
        own = own.astype(np.int64).astype(np.uint64)  # -1 is in no key
        third = (keys & low).astype(np.int64)
        pair = (own[keys >> np.uint64(42)] << np.uint64(32)) | own[(keys >> np.uint64(21)) & low]
        third = np.where(third > 0, own[third - 1] + np.uint64(1), np.uint64(0))
        yield pair, third, n


_RUNS = "part int, body binary"


def _runs(tables: Iterator[pa.Table], parts: int, held: int = HELD) -> Iterator[pa.RecordBatch]:
    """The subtrees' runs, parted by prefix: each part stays sorted.  About
    ``held`` phrases are dealt at once, so a task writes a row or few for each
    part, however many subtrees it spills."""
    waiting: list[pa.Table] = []

    def dealt() -> pa.RecordBatch:
        t = pa.concat_tables(waiting)
        waiting.clear()
        pair, third, n = (t[x].to_numpy() for x in ("pair", "third", "n"))
        to = fp.mix64(pair * np.uint64(SPREAD) + third % np.uint64(SPREAD)) % np.uint64(parts)
        order = np.lexsort((third, pair, to))
        to, pair, third, n = to[order], pair[order], third[order], n[order]
        # A phrase of several subtrees is counted together.
        own = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (third[1:] != third[:-1])]))
        to, pair, third, n = to[own], pair[own], third[own], np.add.reduceat(n, own)
        firsts = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
        low, one = pair & np.uint64(0xFFFFFFFF), pair >> np.uint64(32)
        step = np.diff(one, prepend=np.uint64(0))
        step[firsts] = one[firsts]
        rows = [packed(step=step[a:b], low=low[a:b], third=third[a:b], n=n[a:b])
                for a, b in zip(firsts, np.append(firsts[1:], len(to)), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(to[firsts].astype(np.int32)), pa.array(rows, pa.binary())],
                                          ["part", "body"])

    for t in tables:
        waiting.append(t)
        if sum(w.num_rows for w in waiting) >= held:
            yield dealt()
    if any(w.num_rows for w in waiting):
        yield dealt()


def run_of(body: bytes) -> pa.Table:
    """pair, third and n of a part of a run."""
    t = unpacked(body, step=np.uint64, low=np.uint64, third=np.uint64, n=np.int64)
    pair = np.cumsum(t["step"].to_numpy(), dtype=np.uint64) << np.uint64(32) | t["low"].to_numpy()
    return pa.table({"pair": pair, "third": t["third"], "n": t["n"]})


def _counted(parts: int):
    """Blocks come with their answers first (bucket ascends), then the row of
    word numbers."""
    def spilled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        trie, block, known = Trie(), None, []
        for batch in batches:
            for b, nth, body in zip(batch.column("block").to_pylist(), batch.column("nth").to_pylist(),
                                    batch.column("body"), strict=True):
                if b != block:
                    block, known = b, []
                if nth >= 0:
                    known.append(unpacked(body.as_py(), id=np.int64)["id"].to_numpy() - 1)
                    continue
                t = unpacked(body.as_py(), word=np.int64, fresh=bool)
                ids = np.concatenate(known)[t["word"].to_numpy()]
                for some in phrases(ids, t["fresh"].to_numpy()):
                    yield from trie.add(*some)
                release()
        yield from trie.drain()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _runs(spilled(batches), parts)
    return run


# Step 4: merged runs.

def _merged(least: int):
    def run(t: pa.Table) -> pa.Table:
        every = Container()
        for body in t["body"].to_pylist():
            every.fresh.append(run_of(body))
        found = every.settle()
        found = found.filter(pc.greater_equal(found["n"], least))
        del every
        release()
        pair, third = found["pair"].to_numpy(), found["third"].to_numpy().astype(np.int64)
        return pa.table({"a": (pair >> np.uint64(32)).astype(np.int64), "b": (pair & np.uint64(0xFFFFFFFF)).astype(np.int64),
                         "c": pa.array(third - 1, mask=third == 0), "f": found["n"].cast(pa.int64())})
    return run


# Step 5: scores.

def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)) in whole numbers of 38 digits: exact for
    counts below 10^16."""
    wide = lambda c: f"CAST({c} AS DECIMAL(16,0))"
    return F.expr(f"(CAST({MILLION} AS DECIMAL(7,0)) * ({wide(a)} * {wide(a)})) DIV ({wide(left)} * {wide(right)})")


def counted(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
            block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent phrases (a, b, c, f by word numbers; c null in pairs), words
    (id, lang, word, f) and sums (lang, n)."""
    docs = df.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                     F.col(text).cast("string").alias("text"))
    total = text_bytes(docs)
    buckets, parts = pieces(total, BUCKET_BYTES), pieces(total, MERGE_BYTES)
    blocks = cut(docs.mapInArrow(_tokenised(buckets, block_bytes), _BLOCKS))
    numbered = cut(blocks.where("bucket >= 0").repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_numbered(buckets, least), _NUMBERED))
    words = numbered.where("id IS NOT NULL").select("id", "lang", "word", "f")
    sums = numbered.where("id IS NULL AND lang IS NOT NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    last = (1 << 31) - 1
    both = numbered.where("body IS NOT NULL").select("block", F.col("bucket").alias("nth"), "body").unionByName(
        blocks.where("bucket < 0").select("block", F.lit(-1).alias("nth"), "body"))
    by_block = both.repartition(pieces(total, 4 * block_bytes), "block").sortWithinPartitions(
        "block", F.when(F.col("nth") < 0, last).otherwise(F.col("nth")))
    runs = by_block.mapInArrow(_counted(parts), _RUNS)
    found = cut(runs.repartition(parts, "part").groupBy("part").applyInArrow(_merged(least), "a long, b long, c long, f long"))
    return found, words, sums


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = 2000,
                 inside_percent: int = 50, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's ``top``
    phrases."""
    found, words, sums = counted(df, text, lang, least, block_bytes)
    pairs, triples = found.where("c IS NULL"), found.where("c IS NOT NULL")

    def word(place: str, *more: str) -> DataFrame:
        return words.select(F.col("id").alias(place), F.col("word").alias(f"word_{place}"), F.col("f").alias(f"f_{place}"),
                            *more)

    longer = triples.select("a", "b", "f").unionByName(
        triples.select(F.col("b").alias("a"), F.col("c").alias("b"), "f")).groupBy("a", "b").agg(F.max("f").alias("longer"))
    two = pairs.drop("c").join(longer, ["a", "b"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("f")))
    two = two.join(word("a", "lang"), "a").join(word("b"), "b").select(
        "lang", F.concat_ws(" ", "word_a", "word_b").alias("phrase"), F.col("f").alias("a"), F.col("f_a").alias("l"),
        F.col("f_b").alias("r"), _score("f", "f_a", "f_b").alias("score"))
    first = pairs.select("a", "b", F.col("f").alias("f_ab"))
    last = pairs.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("f").alias("f_bc"))
    three = (triples.join(first, ["a", "b"]).join(last, ["b", "c"]).join(word("a", "lang"), "a").join(word("b"), "b")
             .join(word("c"), "c").withColumn("one", _score("f", "f_a", "f_bc"))
             .withColumn("two", _score("f", "f_ab", "f_c")))
    early = F.col("one") <= F.col("two")
    three = three.select(
        "lang", F.concat_ws(" ", "word_a", "word_b", "word_c").alias("phrase"), F.col("f").alias("a"),
        F.when(early, F.col("f_a")).otherwise(F.col("f_ab")).alias("l"),
        F.when(early, F.col("f_bc")).otherwise(F.col("f_c")).alias("r"), F.least("one", "two").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = two.unionByName(three).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(sums, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                          F.col("score").cast("long").alias("score"))
