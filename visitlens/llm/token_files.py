"""Token files: documents as ids, entropy-coded by static range asymmetric
numeral systems.

A file holds the documents of one range of doc_id, in ascending order.
Its frequency table is counted over all ids of the file and shared by all of
its blocks.  A block is coded on its own in LANES interleaved streams, so a
numpy vector holds one step of all of them; it carries its final states, a
checkpoint (states and read position) every CHECK_ROWS steps from which
decoding can start inside the block, and a CRC-32 of its ids.

Layout of a file (little-endian):
  magic "VRA1", u32 number of symbols, blocks, documents, u64 ids;
  symbols (u32 each), frequencies (u32 each, sum 2^16);
  per block: u32 ids, u32 checkpoints, u32 words, u32 CRC-32, u64 place;
  per document: u8 has an id, i64 doc_id, u32 ids;
  blocks: checkpoints (u32 read position, LANES u64 states), words (u32).

Files are the rows of a Parquet table in the shared folder (``image``
binary, with its range and counts beside it): Spark's writer commits them
and any executor reads any of them back.

Defined cases: null and empty texts have the end id alone; a null doc_id
sorts first; rows that repeat a doc_id are written one after another, in the
order of a hash of their text, and may lie in several files; no rows give no
files.  Reading files whole starts every block at its head; the checkpoints
are for readers that want a part (TokenFile.part).
"""

from __future__ import annotations

import codecs
import functools
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from visitlens.llm.bpe import byte_symbols, slices
from visitlens.llm.common import KEPT, pieces, shared_dir, text_bytes, utf8

LANES = 512
CHECK_ROWS = 128
BLOCK_ROWS = 512
BITS = 16
LOW = np.uint64(1 << 31)
FILE_TEXT_BYTES = 8 << 20
FILE_IDS = 4 << 20
WORD_MEMORY = 400_000
PART_ROWS, WORD_ROWS = 50, 1000
SLICE_BYTES = 4 << 20
BROADCAST_FILES = 500_000
_HEAD = struct.Struct("<4sIIIQ")


def shared_table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and frequencies that sum to 2^BITS, each at least 1."""
    symbols, counts = np.unique(ids, return_counts=True)
    whole = 1 << BITS
    if len(symbols) > whole:
        raise ValueError(f"more than {whole} different ids in a file")
    share = counts * ((whole - len(symbols)) / max(1, counts.sum()))
    freq = 1 + np.floor(share).astype(np.int64)
    rest = whole - int(freq.sum())
    if len(symbols):
        freq[np.argsort(np.floor(share) - share, kind="stable")[:rest]] += 1
    return symbols.astype(np.uint32), freq.astype(np.uint32)


def encode_block(index: np.ndarray, freq: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Read positions and states of the checkpoints, and words, of one
    block; index: symbol numbers."""
    rows = -(-len(index) // LANES)
    full = np.zeros(rows * LANES, np.int64)
    full[: len(index)] = index
    full = full.reshape(rows, LANES)
    state = np.full(LANES, LOW, np.uint64)
    words: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    each, add = freq[full], first[full]
    most, step = each << np.uint64(47), np.uint64(1 << BITS) - each
    for r in range(rows - 1, -1, -1):
        over = np.flatnonzero(state >= most[r])
        out = state[over]
        words.append(out.astype(np.uint32))
        state[over] = out >> np.uint64(32)
        # (state // f << BITS) + state % f + first
        state = state + state // each[r] * step[r] + add[r]
        if r % CHECK_ROWS == 0:
            marks.append((len(words), state.copy()))
    sizes = np.cumsum([len(w) for w in words]) if words else np.zeros(1, np.int64)
    total = int(sizes[-1])
    # Decoding reads the last written row first.
    places = np.array([total - int(sizes[k - 1]) for k, _ in marks][::-1], np.uint32)
    states = np.array([s for _, s in marks][::-1], np.uint64).reshape(-1, LANES)
    return places, states, np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)


def decode_rows(state: np.ndarray, place: int, words: np.ndarray, rows: int, freq: np.ndarray, first: np.ndarray,
                slot: np.ndarray) -> np.ndarray:
    """Symbol numbers of the rows that follow a checkpoint."""
    out = np.empty((rows, LANES), np.int64)
    mask, bits = np.uint64((1 << BITS) - 1), np.uint64(BITS)
    for r in range(rows):
        low = state & mask
        k = slot[low]
        out[r] = k
        state = freq[k] * (state >> bits) + low - first[k]
        under = np.flatnonzero(state < LOW)
        if len(under):
            state[under] = state[under] << np.uint64(32) | words[place:place + len(under)]
            place += len(under)
    return out.ravel()


def file_image(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    flat = np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.uint32)
    symbols, freq = shared_table(flat)
    wide, first = freq.astype(np.uint64), (np.cumsum(freq) - freq).astype(np.uint64)
    heads, bodies, place = [], [], 0
    step = LANES * BLOCK_ROWS
    small = len(symbols) and symbols[-1] < 1 << 20
    if small:
        number = np.zeros(int(symbols[-1]) + 1, np.int64)
        number[symbols] = np.arange(len(symbols))
    for a in range(0, len(flat), step):
        own = flat[a:a + step]
        at, states, words = encode_block(number[own] if small else np.searchsorted(symbols, own), wide, first)
        body = b"".join(struct.pack("<I", p) + s.tobytes() for p, s in zip(at, states, strict=True)) + words.tobytes()
        heads.append(struct.pack("<IIIIQ", len(own), len(at), len(words), zlib.crc32(own.tobytes()), place))
        bodies.append(body)
        place += len(body)
    docs = b"".join(struct.pack("<BqI", d is not None, d or 0, len(x)) for d, x in zip(doc_ids, ids, strict=True))
    head = _HEAD.pack(b"VRA1", len(symbols), len(heads), len(doc_ids), len(flat))
    return head + symbols.tobytes() + freq.tobytes() + b"".join(heads) + docs + b"".join(bodies)


class TokenFile:
    """Reads a file image, whole or from any checkpoint."""

    def __init__(self, image: bytes):
        self.image = image
        magic, n_symbols, n_blocks, n_docs, self.n_ids = _HEAD.unpack_from(image)
        if magic != b"VRA1":
            raise ValueError("not a token file")
        at = _HEAD.size
        self.symbols = np.frombuffer(image, np.uint32, n_symbols, at)
        freq = np.frombuffer(image, np.uint32, n_symbols, at + 4 * n_symbols)
        at += 8 * n_symbols
        self.freq, self.first = freq.astype(np.uint64), (np.cumsum(freq) - freq).astype(np.uint64)
        self.slot = np.repeat(np.arange(n_symbols), freq)
        self.blocks = [struct.unpack_from("<IIIIQ", image, at + 24 * i) for i in range(n_blocks)]
        at += 24 * n_blocks
        docs = np.frombuffer(image, np.dtype([("has", "u1"), ("doc", "<i8"), ("n", "<u4")]), n_docs, at)
        self.docs = [int(d) if h else None for h, d in zip(docs["has"], docs["doc"], strict=True)]
        self.sizes = docs["n"].astype(np.int64)
        self.body = at + 13 * n_docs

    def block(self, k: int, mark: int = 0) -> np.ndarray:
        """Ids of block k from its checkpoint ``mark`` on."""
        n, marks, n_words, crc, place = self.blocks[k]
        at = self.body + place
        each = 4 + 8 * LANES
        words = np.frombuffer(self.image, np.uint32, n_words, at + marks * each).astype(np.uint64)
        read = struct.unpack_from("<I", self.image, at + mark * each)[0]
        state = np.frombuffer(self.image, np.uint64, LANES, at + mark * each + 4).copy()
        skip = mark * CHECK_ROWS
        got = decode_rows(state, read, words, -(-n // LANES) - skip, self.freq, self.first, self.slot)
        got = self.symbols[got[: n - skip * LANES]]
        if not mark and zlib.crc32(got.tobytes()) != crc:
            raise ValueError(f"checksum of block {k} differs")
        return got

    def part(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to ``stop`` of the file, decoded from the last
        checkpoint before ``start`` in each block that they lie in."""
        out, at = [np.zeros(0, np.uint32)], 0
        for k, (n, marks, *_) in enumerate(self.blocks):
            a, b = max(start - at, 0), min(stop - at, n)
            if a < b:
                mark = min(marks - 1, a // (LANES * CHECK_ROWS))
                skip = mark * CHECK_ROWS * LANES
                out.append(self.block(k, mark)[a - skip:b - skip])
            at += n
        return np.concatenate(out)

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, place in the file, and ids, block after block."""
        held, blocks, place = np.zeros(0, np.uint32), iter(range(len(self.blocks))), 0
        for doc, n in zip(self.docs, self.sizes, strict=True):
            parts, missing = [], int(n)
            while missing:
                if not len(held):
                    held = self.block(next(blocks))
                parts.append(held[:missing])
                held, missing = held[missing:], missing - len(parts[-1])
            yield doc, place, np.concatenate([*parts, np.zeros(0, np.uint32)])
            place += int(n)


# Classes of bytes in the byte-level pattern, where these are beyond doubt:
# Latin letters (up to U+024F), digits, ASCII punctuation, ASCII white space.
_LETTER, _DIGIT, _MARK, _WHITE, _OTHER = range(5)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[[*b"0123456789"]] = _DIGIT
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = _LETTER
_KIND[[0x20, *range(0x09, 0x0E)]] = _WHITE


def parts_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the parts of texts begin, and which of these hold a character
    of another class.

    Parts are the matches of the byte-level pattern; those of the other kind
    reach from a space, or the head of a text, to the next space."""
    n = len(data)
    head = np.zeros(n + 1, bool)
    head[off] = True
    kind = _KIND[data]
    at = np.flatnonzero(data[:-1] == 0xC3)
    kind[at[(data[at + 1] == 0x97) | (data[at + 1] == 0xB7)]] = _OTHER
    at = np.flatnonzero(data[:-1] == 0xC9)
    kind[at[data[at + 1] >= 0x90]] = _OTHER
    cut = head[:-1].copy()
    cut[1:] |= kind[1:] != kind[:-1]
    # The last of several white-space characters stands apart; a space goes
    # with what follows it.
    white = kind == _WHITE
    turn = np.flatnonzero(white[:-1] & ~white[1:] & ~head[1:-1]) + 1
    cut[turn] = data[turn - 1] != 0x20
    cut[turn - 1] = True
    # 's 't 'm 'd 're 've 'll, where a match begins at the apostrophe
    at = np.flatnonzero(data == 0x27)
    at = at[cut[at]]
    ends = np.concatenate([data, np.zeros(2, np.uint8)])
    ends[off[(off > 0) & (off < n)]] |= 0x80  # no suffix reaches into the next text
    one, two = ends[at + 1], ends[at + 2]
    single = np.isin(one, [*b"stmd"])
    double = ((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)
    for found, size in ((single, 2), (double, 3)):
        cut[at[found] + 1] = False
        stop = at[found] + size
        cut[stop[stop < n]] = True
    other = np.flatnonzero(kind == _OTHER)
    if len(other):
        begins = np.flatnonzero((data == 0x20) | head[:-1])
        nth = np.unique(np.searchsorted(begins, other, "right") - 1)
        a, b = begins[nth], np.append(begins, n)[nth + 1]
        inside = np.zeros(n + 1, np.int8)
        inside[a] += 1
        inside[b] -= 1
        cut &= np.cumsum(inside[:-1], dtype=np.int8) == 0
        cut[a] = True
        cut[b[b < n]] = True
    starts = np.flatnonzero(cut)
    return starts, np.unique(np.searchsorted(starts, other, "right") - 1)


class Words:
    """Ids of whole texts by the tokenizers library, part by part.

    The byte-level pattern is matched by classes of bytes.  Every different
    part of a batch is looked up once; new ones go to the library, spelled
    by its symbols, behind a plain white-space cut.  Words with characters
    of other classes go to it as they are: the pattern always ends a match
    before a space that stands between two other characters than white
    space.  Texts where other white space meets such a cut, or with the
    special tokens' strings, go whole to the library.

    New parts go joined, and the ids are parted again by the bytes that they
    stand for.  What a part gives is kept, in two generations of bounded
    size."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.own, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # No text holds the byte 0xFF: it stands for the gap between parts.
        self.symbols = "".join(byte_symbols()[:-1]) + " "
        self.special = [t.content for t in self.own.get_added_tokens_decoder().values()]
        vocab = self.own.get_vocab()
        self.size = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.size[i] = len(token)  # one symbol per byte
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.own.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _learn(self, tokenizer, rows: list[bytes], texts: list[str], each: int) -> None:
        """Ids of the rows, which stand in texts, ``each`` in one."""
        for a in range(0, len(texts), 64):
            some = rows[a * each:(a + 64) * each]
            got = tokenizer.encode_batch_fast(texts[a:a + 64], add_special_tokens=False)
            ids = np.array([i for e in got for i in e.ids], np.uint32)
            ends = np.cumsum(list(map(len, some)))
            cuts = (4 * np.searchsorted(np.cumsum(self.size[ids]), ends, "left") + 4).tolist()
            data, at = ids.tobytes(), 0
            for row, to in zip(some, cuts, strict=True):
                self.young[row] = data[at:to]
                at = to

    def _learn_parts(self, parts: list[bytes]) -> None:
        texts = [codecs.charmap_decode(b"\xff".join(parts[a:a + PART_ROWS]), "strict", self.symbols)[0]
                 for a in range(0, len(parts), PART_ROWS)]
        self._learn(self.plain, parts, texts, PART_ROWS)

    def _learn_words(self, words: list[bytes]) -> None:
        """Empty for those that don't stand alone."""
        led = []
        for word in words:
            text = word.decode()
            if text[-1].isspace() or text[0] == " " and text[1].isspace():
                self.young[word] = b""
            elif text[0] == " ":
                led.append(word)
            else:
                self.young[word] = self._whole(text)
        self._learn(self.own, led, [b"".join(led[a:a + WORD_ROWS]).decode() for a in range(0, len(led), WORD_ROWS)],
                    WORD_ROWS)

    def __call__(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        column = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        data, off = utf8(column)
        if not len(data):
            return [np.zeros(0, np.uint32)] * len(column)
        whole = np.zeros(len(column), bool)
        for s in self.special:
            whole |= pc.match_substring(column, s).fill_null(False).to_numpy(zero_copy_only=False)
        starts, other = parts_of(data, off)
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)),
            pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        words, nth = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        if len(self.young) >= WORD_MEMORY:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, words))
        missing = [i for i, f in enumerate(found) if f is None]
        if missing:
            odd, fresh = set(np.unique(nth[other]).tolist()), []
            for i in missing:
                known = self.old.get(words[i])
                if known is None:
                    fresh.append(i)
                else:
                    self.young[words[i]] = known
            self._learn_parts([words[i] for i in fresh if i not in odd])
            self._learn_words([words[i] for i in fresh if i in odd])
            for i in missing:
                found[i] = self.young[words[i]]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.searchsorted(starts, off)
        if not sizes.all():
            before = np.concatenate([[0], np.cumsum(sizes[nth] == 0)])
            whole |= before[first[1:]] > before[first[:-1]]
        # The ids of all parts, gathered from those of the different ones.
        blob = np.frombuffer(b"".join(found), np.uint32)
        n = sizes[nth]
        before = np.concatenate([[0], np.cumsum(n)])
        place = np.repeat((np.cumsum(sizes) - sizes)[nth] - before[:-1], n)
        place += np.arange(len(place))
        ids = blob[place]
        cuts = before[first].tolist()
        return [np.frombuffer(self._whole(column[i].as_py()), np.uint32) if odd else ids[a:b]
                for i, (odd, a, b) in enumerate(zip(whole.tolist(), cuts[:-1], cuts[1:], strict=True))]


@functools.lru_cache(2)
def words(path: str) -> Words:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Words(path)


KEPT.append(words.cache_clear)


def write_files(docs: DataFrame, target: str, tokenizer: str, end_id: int, key: str = "doc_id",
                text: str = "text", file_text_bytes: int = FILE_TEXT_BYTES) -> None:
    """Encode the texts and write files in ascending order of ``key``.

    Ranges of the key deal the documents out; a range that is longer than
    FILE_IDS ids is written as several files."""
    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    n = pieces(text_bytes(narrow), file_text_bytes)
    # Rows that share a key, or all they hold, are told apart by hash and by
    # place, so a range may end between them.
    by = [F.col("key").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    told = narrow.withColumns({"_h": by[1], "_n": by[2]})
    ordered = told.repartitionByRange(n, by[0], "_h", "_n").sortWithinPartitions(by[0], "_h", "_n").drop(
        "_h", "_n").withColumn("part", F.spark_partition_id())
    names = ["part", "seq", "n_docs", "n_ids", "image"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = words(tokenizer)
        keys, ids, size, seq, part = [], [], 0, 0, 0

        def image() -> pa.RecordBatch:
            row = [[part], [seq], [len(keys)], [size], [file_image(keys, ids)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                part = some.column("part")[0].as_py()
                keys += some.column("key").to_pylist()
                got = [np.append(x, np.uint32(end_id)) for x in tokens(some.column("text"))]
                ids += got
                size += sum(map(len, got))
                if size >= FILE_IDS:
                    yield image()
                    keys, ids, size, seq = [], [], 0, seq + 1
        if keys:
            yield image()

    ordered.mapInArrow(run, "part int, seq int, n_docs long, n_ids long, image binary").write.parquet(target)


def read_files(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids
    (little-endian unsigned 32-bit integers) of every document."""
    files = spark.read.parquet(target)
    # One row per file: the window's input is the files' counts.
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    base = files.select("part", "seq", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "seq", "doc_id", "place", "n_tokens", "ids"]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for part, seq, image in zip(*(batch.column(c) for c in ("part", "seq", "image")), strict=True):
                rows, size = [], 0
                for doc, place, ids in TokenFile(image.as_py()).documents():
                    rows.append((part.as_py(), seq.as_py(), doc, place, len(ids), ids.tobytes()))
                    size += len(ids)
                    if size > 1 << 19:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(v, k) for v, k in zip(zip(*rows), kinds, strict=True)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, k) for v, k in zip(zip(*rows), kinds, strict=True)], names)

    docs = files.select("part", "seq", "image").mapInArrow(
        run, "part int, seq int, doc_id long, place long, n_tokens long, ids binary")
    # 16 bytes a file: sent to all executors where that is little, else
    # joined by shuffle.
    if files.count() <= BROADCAST_FILES:
        base = F.broadcast(base)
    return docs.join(base, ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids")


def new_target(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
