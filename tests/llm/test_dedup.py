import hashlib
import random
import re

import numpy as np
import pytest

from cases import empty, odd  # noqa: F401
from visitlens.llm import fingerprints as fp, graph, minmax, substring, suffix

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def words_of(text, lower=False):
    data = (text or "").encode()
    if lower:
        data = bytes(c + 32 if 65 <= c <= 90 else c for c in data)
    return WORDS.findall(data)


# ---- shared parts


def test_window_hashes_tell_windows_apart():
    rng = np.random.default_rng(1)
    units = rng.integers(0, 3, 400).astype(np.uint64)
    for n in (1, 2, 5, 9, 35):
        h = fp.window_hash(units, n)
        assert len(h) == 400 - n + 1
        seen = {}
        for i, x in enumerate(h.tolist()):
            assert seen.setdefault(x, tuple(units[i:i + n])) == tuple(units[i:i + n])
        assert len(seen) == len({tuple(units[i:i + n]) for i in range(len(h))})
    assert len(fp.window_hash(units[:3], 5)) == 0


def thue_morse(n):
    """A word of n letters and its complement: any polynomial in an odd base
    mod 2^64 gives both one value from 1,024 letters on."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_run_hashes_tell_words_apart():
    rng = random.Random(4)
    words = {w for n in (1024, 2048, 4096) for w in thue_morse(n)}
    words |= {"a" * n for n in range(1, 40)} | {"a" * n + "b" for n in range(40)} | {"", "\0", "\0\0", "ab\0"}
    words |= {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 30))) for _ in range(3000)}
    words = sorted(words)
    data = "".join(words).encode()
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    for other in (False, True):
        h = fp.hash_runs(np.frombuffer(data, np.uint8), starts, ends, other)
        assert len(set(h.tolist())) == len(words)
        alone = fp.hash_runs(np.frombuffer(words[-1].encode(), np.uint8), np.array([0]), np.array([len(words[-1])]), other)
        assert alone[0] == h[-1]


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_that_share_a_polynomial(spark, n):
    """Two documents of 41 words that differ in one such word: every window
    of 35 covers it, and 32 of 42 shingles are shared; two that share none."""
    x, y = thue_morse(n)
    rest = [f"w{i}" for i in range(40)]
    rows = [(k, " ".join([*rest[:20], w, *rest[20:]])) for k, w in enumerate((x, y))]
    rows += [(2, " ".join([x] * 5)), (3, " ".join([y] * 5))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.n_removed for r in substring.remove_repeats(df).collect()] == [0] * 4
    got = minmax.near_duplicates(df, percent=85).collect()
    assert all(r.kept for r in got)
    found = suffix.remove_earlier(df.select("doc_id", "text")).collect()
    assert sum(r.n_removed for r in found) > 0  # strings of 50 letters do repeat


def test_sliding():
    x = np.random.default_rng(2).integers(0, 99, 50)
    for w in (1, 2, 3, 7, 16, 50):
        assert fp.sliding(np.minimum, x, w).tolist() == [min(x[i:i + w]) for i in range(51 - w)]


def test_words_and_room():
    texts = ["", "a", " two  words ", "é\tb\x0bc\x1cd", "same a same"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    starts, ends, units, first = substring.word_units(data, off)
    assert [bytes(data[a:b]) for a, b in zip(starts, ends)] == [w for t in texts for w in words_of(t)]
    assert np.diff(first).tolist() == [len(words_of(t)) for t in texts]
    assert len(set(units.tolist())) == len({w for t in texts for w in words_of(t)})
    room = fp.starts_with_room(np.array([0, 3, 3, 4, 9]), 3)
    assert np.flatnonzero(room).tolist() == [0, 4, 5, 6]


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(5, 5)]
    label = {}
    for a, b in edges:
        label.setdefault(a, a), label.setdefault(b, b)
    for _ in range(400):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    df = spark.createDataFrame(edges + [(None, 3)], "a long, b long")
    got = {r.id: r.component for r in graph.components(df).collect()}
    assert {k: got.get(k, k) for k in label} == label
    assert graph.components(df.where("1 = 0")).count() == 0


# ---- min-max hashing


def sets_of(rows):
    out = []
    for r in rows:
        w = words_of(r.text, True)
        out.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


@pytest.mark.parametrize("percent", [85, 50])
def test_near_duplicates_against_all_pairs(spark, odd, empty, percent):
    rows = odd.collect()
    sets = sets_of(rows)
    low = {r.doc_id: r.doc_id for r in rows if r.doc_id is not None}
    links = [(rows[a].doc_id, rows[b].doc_id) for a in range(len(rows)) for b in range(a)
             if sets[a] and sets[b] and None not in (rows[a].doc_id, rows[b].doc_id)
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in range(len(links)):
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    assert any(low[k] != k for k in low)
    got = minmax.near_duplicates(odd, percent=percent, band=4 if percent == 85 else 2).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles) for r in got) == sorted(
        (r.doc_id is None, r.doc_id or 0, len(s)) for r, s in zip(rows, sets))
    for r in got:
        assert r.component_id == low.get(r.doc_id, r.doc_id)
        assert r.kept == (r.doc_id == r.component_id)
    assert minmax.near_duplicates(empty).count() == 0


def test_chain_of_near_copies(spark):
    """Neighbours are similar, ends are not; one bucket's leader is not
    enough."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words[rng.randrange(300)] = f"n{i}"
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in minmax.near_duplicates(df).collect()} == {0}


def test_common_passage_makes_no_pairs(spark, monkeypatch):
    """Texts that share a passage only meet in buckets; their pairs are not
    made, and near copies among them are found."""
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(50))
    rows = []
    for i in range(120):
        own = [f"w{rng.randrange(10**9)}" for _ in range(60)]
        rows.append((2 * i, f"{passage} {' '.join(own)}"))
        if i % 3 == 0:
            rows.append((2 * i + 1, f"{passage} {' '.join(own[:-2])}"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made, similar = [], minmax._similar
    monkeypatch.setattr(minmax, "_similar", lambda pairs, sets: made.append(pairs.count()) or similar(pairs, sets))
    monkeypatch.setattr(minmax, "CHUNK", 32)
    got = {r.doc_id: r.component_id for r in minmax.near_duplicates(df, permutations=4, band=1).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}
    assert sum(made) < 8 * len(rows), made


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 62, 1000).astype(np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 1 << 62, 200).astype(np.uint64)])
    s = minmax.signatures(np.concatenate([a, b]), np.array([0, 1000, 2000]), 400)
    assert abs((s[0] == s[1]).mean() - 800 / 1200) < 0.06


# ---- suffix arrays


def test_suffix_array():
    rng = random.Random(3)
    for _ in range(300):
        text = bytes(rng.choice(b"ab\xff\x00c"[:rng.randrange(1, 6)]) for _ in range(rng.randrange(70)))
        order = sorted(range(len(text)), key=lambda i: text[i:])
        a = np.frombuffer(text, np.uint8)
        got = suffix.suffix_array(a)
        assert got.tolist() == order
        prefixes = [0]
        for x, y in zip(order[1:], order):
            k = 0
            while max(x, y) + k < len(text) and text[x + k] == text[y + k]:
                k += 1
            prefixes.append(k)
        assert suffix.common_prefixes(a, got, 100).tolist() == prefixes[:len(text)]


def plain_earlier(rows, length):
    first = {}
    texts = [(r.text or "").encode() for r in rows]
    ids = [r.doc_id if r.doc_id is not None else 1 << 62 for r in rows]
    for i, t in zip(ids, texts):
        for a in range(len(t) - length + 1):
            s = t[a:a + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, t in zip(ids, texts):
        gone = bytearray(len(t))
        for a in range(len(t) - length + 1):
            if first[t[a:a + length]] < i:
                gone[a:a + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(t), sum(gone), runs, bytes(c for c, g in zip(t, gone) if not g)))
    return out


@pytest.mark.parametrize("hot,block", [(suffix.HOT, 4 << 20), (1, 4000), (3, 20_000)])
def test_remove_earlier_against_plain(spark, odd, empty, hot, block):
    rows = odd.collect()
    expected = sorted((r.doc_id is not None, r.doc_id or 0, *x) for r, x in zip(rows, plain_earlier(rows, 50)))
    assert sum(x[3] for x in expected) > 1000
    got = suffix.remove_earlier(odd, hot=hot, block_bytes=block).collect()
    assert sorted((r["row"].doc_id is not None, r["row"].doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
                  for r in got) == expected
    for r in got:
        assert len(r.spans) == 2 * r.n_spans and sum(r.spans[1::2]) - sum(r.spans[::2]) == r.n_removed
        assert r["row"].block == 4 and r["row"].txt == 2
    assert suffix.remove_earlier(empty).count() == 0


# ---- word windows


def plain_windows(rows, window):
    seen = {}
    texts = [words_of(r.text) for r in rows]
    for w in texts:
        for a in range(len(w) - window + 1):
            k = tuple(w[a:a + window])
            seen[k] = seen.get(k, 0) + 1
    out = []
    for w in texts:
        gone = bytearray(len(w))
        for a in range(len(w) - window + 1):
            if seen[tuple(w[a:a + window])] > 1:
                gone[a:a + window] = b"\1" * window
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


@pytest.mark.parametrize("window,block", [(35, 4 << 20), (35, 3000), (4, 3000), (1, 9000)])
def test_remove_repeats_against_plain(spark, odd, empty, window, block):
    rows = odd.collect()
    expected = sorted((r.doc_id is not None, r.doc_id or 0, *x) for r, x in zip(rows, plain_windows(rows, window)))
    got = substring.remove_repeats(odd, window=window, block_bytes=block).collect()
    assert sorted((r["row"].doc_id is not None, r["row"].doc_id or 0, r.n_words, r.n_removed, r.kept_text)
                  for r in got) == expected
    assert sum(x[3] for x in expected) > 1000 and got[0]["row"].block == 4
    assert substring.remove_repeats(empty).count() == 0


def test_copies_are_dealt_to_many_blocks(spark, monkeypatch):
    """A third of the rows is one text, with keys of their own, one key or
    none, or another third has no text at all: no block holds a group."""
    most, dealt = 4000, fp.dealt
    rng = random.Random(8)
    one = " ".join(f"w{rng.randrange(99)}" for _ in range(40))
    other = [" ".join(f"w{rng.randrange(999)}" for _ in range(40)) for _ in range(200)]
    for keys, blank in ((range(200), 0), ([7] * 200, 0), ([None] * 200, 0), ([None] * 200, 200)):
        rows = ([(k, one) for k in keys] + [(1000 + i, t) for i, t in enumerate(other)]
                + [(None, None if i % 2 else "") for i in range(blank)] + [(2000 + i, f"x {one} y{i}") for i in range(200)])
        df = spark.createDataFrame(rows, "doc_id long, text string")
        seen = []
        monkeypatch.setattr(fp, "dealt", lambda *a: seen.append(dealt(*a)) or seen[-1])
        got = substring.remove_repeats(df, block_bytes=most, key="doc_id").collect()
        held = [0] * 999
        for r in seen[0][0].collect():
            held[r.block] += len((r.txt or "").encode()) + 32
        assert max(held) < 3 * most, (keys[:1], blank, max(held))
        expected = sorted((r[0] is not None, r[0] or 0, *x) for r, x in zip(
            rows, plain_windows(df.collect(), 35), strict=True))
        assert sorted((r["row"].doc_id is not None, r["row"].doc_id or 0, r.n_words, r.n_removed, r.kept_text)
                      for r in got) == expected


def test_digest(spark, odd):
    from pyspark.sql import functions as F

    got = substring.remove_repeats(odd).select("kept_text", F.sha2("kept_text", 256).alias("d")).collect()
    assert all(r.d == hashlib.sha256(r.kept_text.encode()).hexdigest() for r in got)
