"""BPE encoding and decoding of whole texts.

Encoding is the backtracking encoder: an Aho-Corasick automaton over the
vocabulary finds every token inside a word; from the left, the longest
match that is compatible with the token before it is taken, and where none
is, the last token is taken back and shortened.  Two neighbours are
compatible if undoing their merges never meets a merge across their border
that ranks before the ones undone; a sequence of compatible neighbours is
exactly what applying the merges by rank gives.  Positions from which no
compatible way on exists are marked, so each is tried once and the work is
linear in the word.  Decoding gathers the tokens' bytes from one blob by an
offset table.

The vocabulary file is one of the public ``tokenizers`` JSON files with NFC,
white-space and lower-case normalisation, a word pattern, byte-level
symbols and an end-of-word suffix; its path is a parameter.  Words repeat,
so results are kept per word, in a table of bounded size per process.

Defined cases: null and empty texts give no tokens; the special tokens'
own strings are those tokens, wherever they stand; rows are independent, so
repeated rows, empty tables and extra columns change nothing.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from visitlens.llm.common import KEPT, trim

WORD_MEMORY = 150_000
MEMORY_CHARS = 64
SLICE_BYTES = 1 << 20
_END = ""  # end of a word inside this module; no byte symbol
_SPACES = regex.compile(r"\p{White_Space}+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is
    a visible Latin-1 character, else the next free one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    free = iter(range(256, 512))
    return [chr(b if b in shown else next(free)) for b in range(256)]


class Memory:
    """What was computed lately, by key; at most 2 x limit entries.  A full
    generation becomes the old one, whose entries move up when asked for."""

    def __init__(self, compute, limit: int):
        self.compute, self.limit = compute, limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __call__(self, key: str) -> bytes:
        got = self.young.get(key)
        if got is None:
            got = self.old.get(key)
            if got is None:
                got = self.compute(key)
                if len(key) > MEMORY_CHARS:
                    return got
            if len(self.young) >= self.limit:
                self.old, self.young = self.young, {}
            self.young[key] = got
        return got


class BpeCodec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split.replace(r"\s", r"\p{White_Space}")).findall
        self.symbols = byte_symbols()
        self.table = dict(enumerate(self.symbols))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split
        vocab = model["vocab"]
        # Tokens in the order in which they arise: symbols, then merges.
        forms, spelled = {}, {}
        self.ids: list[int] = []
        self.halves: list[tuple[int, int]] = []
        texts: list[str] = []
        for s in self.symbols:
            for form, spelling in ((s, s), (s + _END, s + suffix)):
                if spelling in vocab:
                    forms[form] = spelled[spelling] = len(texts)
                    texts.append(form)
                    self.ids.append(vocab[spelling])
                    self.halves.append((len(texts) - 1,) * 2)
        self.pairs: dict[tuple[int, int], int] = {}
        for left, right in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            a, b, k = spelled[left], spelled[right], len(texts)
            self.pairs[a, b] = k
            forms.setdefault(texts[a] + texts[b], k)
            spelled.setdefault(left + right, k)
            texts.append(texts[a] + texts[b])
            self.ids.append(vocab[left + right])
            self.halves.append((a, b))
        self.fits = functools.lru_cache(WORD_MEMORY)(self._fits)
        # The automaton finds tokens that the merges themselves produce.
        self.automaton = ahocorasick.Automaton()
        for form, k in forms.items():
            if self._own(k):
                self.automaton.add_word(form, (len(form), k))
        self.automaton.make_automaton()
        self.word = Memory(lambda w: np.array(self.word_ids(w), np.int32).tobytes(), WORD_MEMORY)
        self.chunk = Memory(lambda c: b"".join(map(self.word, self.words(c))), WORD_MEMORY // 2)
        # Offset table for decoding: a token's bytes, with the space that
        # joins tokens in front.
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        parts = [(" " + names.get(i, "")).encode() for i in range(max(names) + 1)]
        self.blob = np.frombuffer(b"".join(parts), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _own(self, k: int) -> bool:
        a, b = self.halves[k]
        return a == k or self._fits(a, b, k)

    def _fits(self, left: int, right: int, limit: int = 1 << 60) -> bool:
        """Whether merging by rank leaves the border of left and right.

        limit: the rank of the merge that joins them, for a token's own
        halves."""
        pairs, halves = self.pairs, self.halves
        while True:
            if pairs.get((left, right), limit) < limit:
                return False
            # Undo the later of the two merges; a symbol has none.
            whole_left, whole_right = halves[left][0] == left, halves[right][0] == right
            if whole_left and whole_right:
                return True
            if whole_right or not whole_left and left > right:
                limit, left = left, halves[left][1]
            else:
                # At equal rank the left merge is done first.
                limit, right = right + 1, halves[right][0]

    def word_ids(self, word: str) -> list[int]:
        """Vocabulary ids of one word."""
        s = "".join([self.table[b] for b in word.encode()])
        s = s + _END
        n = len(s)
        at: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, hit in self.automaton.iter(s):
            at[end - hit[0] + 1].append(hit)  # from each place: ascending length
        dead = bytearray(n + 1)
        out: list[int] = []
        path: list[tuple[int, int]] = []
        pos, k = 0, len(at[0]) - 1
        while pos < n:
            if k >= 0:
                size, token = at[pos][k]
                if not dead[pos + size] and (not out or self.fits(out[-1], token)):
                    out.append(token)
                    path.append((pos, k))
                    pos += size
                    k = len(at[pos]) - 1 if pos < n else 0
                else:
                    k -= 1
            else:
                dead[pos] = 1
                if not path:
                    raise ValueError(f"no tokens for {word!r}")
                pos, k = path.pop()
                out.pop()
                k -= 1
        return [self.ids[t] for t in out]

    def _plain(self, text: str) -> list[bytes]:
        text = unicodedata.normalize("NFC", text)
        # Lower case is taken per character: a final sigma is like any.
        text = "".join([c.lower() for c in text]) if "Σ" in text else text.lower()
        odd = any(c in text for c in "\x1c\x1d\x1e\x1f")
        chunks = _SPACES.split(text) if odd else text.split()
        known = self.chunk.young.get
        return [known(c) or self.chunk(c) for c in chunks if c]

    def encode(self, text: str) -> np.ndarray:
        parts: list[bytes] = []
        for i, piece in enumerate(self.cut(text) if "<|" in text else [text]):
            parts += [np.int32(self.special[piece]).tobytes()] if i % 2 else self._plain(piece)
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        start, size = self.offset[ids], self.offset[ids + 1] - self.offset[ids]
        place = np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)
        return self.blob[place[1:]].tobytes()


@functools.lru_cache(2)
def codec(path: str) -> BpeCodec:
    return BpeCodec(path)


KEPT.append(codec.cache_clear)


def slices(batch: pa.RecordBatch, column: str, each: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``each`` bytes of text."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(sizes) - sizes) // each
    cuts = np.flatnonzero(np.diff(group, prepend=-1)) if len(sizes) else []
    for a, b in zip(cuts, [*cuts[1:], len(sizes)], strict=True):
        yield batch.slice(a, b - a)


def encode_texts(df: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 decode: bool = True) -> DataFrame:
    """key, token_ids (array of int) and decoded (the text of the ids, if
    asked for) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = [own.encode(t or "") for t in part.column("text").to_pylist()]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = pa.array(np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int32))
                columns = [part.column("key"), pa.ListArray.from_arrays(pa.array(ends), flat)]
                if decode:
                    columns.append(pa.array([own.decode(x).decode() for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["key", "token_ids", "decoded"][: len(columns)])
            trim()

    kind = dict(df.dtypes)[key]
    narrow = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = f"key {kind}, token_ids array<int>" + ", decoded string" * decode
    return narrow.mapInArrow(run, schema).withColumnRenamed("key", key)
