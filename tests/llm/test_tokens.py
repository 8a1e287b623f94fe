import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from cases import SF_SMALL, byte_tokenizer, empty, odd, word_tokenizer  # noqa: F401
from visitlens.llm import bpe, queries, token_files as T


def strange(seed, n):
    rng = random.Random(seed)
    parts = ["a", "The", " ", "  ", "\n", "\t", "é", "é", "　", "\xa0", "'s", "'LL", "12", "!?", "日本", "<|endoftext|>",
             "<|start", "\x1c", "Σ", "ΑΣ", "İ", "ß", "</w>", "ﬁ", "😀", "\x00", " and"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 25))) for _ in range(n)]


def test_backtracking_encoder_is_exact(word_tokenizer):
    own, library = bpe.BpeCodec(word_tokenizer), Tokenizer.from_file(word_tokenizer)
    rng = random.Random(5)
    texts = strange(6, 1500) + ["".join(rng.choice("abcdehilnorst'") for _ in range(rng.randrange(60))) for _ in range(800)]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t).tolist() == ids, t
        assert own.decode(own.encode(t)).decode() == library.decode(ids, skip_special_tokens=False), t


def test_long_word_is_linear(word_tokenizer):
    own = bpe.BpeCodec(word_tokenizer)
    library = Tokenizer.from_file(word_tokenizer)
    word = "abcab" * 4000
    assert own.encode(word).tolist() == library.encode(word, add_special_tokens=False).ids


def test_memory_keeps_two_generations():
    calls = []
    memory = bpe.Memory(lambda k: calls.append(k) or k.encode(), 3)
    for k in "abcabcdefa":
        assert memory(k) == k.encode()
    assert len(memory.young) <= 3 and len(memory.old) <= 3 and len(calls) < 10


def test_encode_odd_rows(odd, empty, word_tokenizer):
    library = Tokenizer.from_file(word_tokenizer)
    rows = bpe.encode_texts(odd.selectExpr("struct(text) AS key", "text"), word_tokenizer, key="key").collect()
    assert len(rows) == odd.count()
    for r in rows:
        ids = library.encode(r["key"].text or "", add_special_tokens=False).ids
        assert r.token_ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode_texts(empty, word_tokenizer).count() == 0


def test_words_of_the_library(byte_tokenizer):
    library = Tokenizer.from_file(byte_tokenizer)
    texts = strange(8, 2000)
    for t, ids in zip(texts, T.Words(byte_tokenizer)(texts)):
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_parts_are_the_matches_of_the_pattern():
    """Texts of clear characters are cut as the library cuts them."""
    from tokenizers import pre_tokenizers

    pattern = pre_tokenizers.ByteLevel(add_prefix_space=False)
    rng = random.Random(11)
    some = ["a", "The", " ", "  ", "\n", "\t", "\r\n", "é", "ß", "ɏ", "12", "!?", ".", "'", "''", "'s", "'t", "'re", "'ve", "'ll",
            "'LL", "'m", "'d", "l", "e", " and", "\x0b"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(25))) for _ in range(3000)]
    data, off = T.utf8(T.pa.array(texts))
    starts, other = T.parts_of(data, off)
    assert not len(other)
    expected = []
    for t, a in zip(texts, off.tolist()):
        expected += [a + len(t[:place].encode()) for _, (place, _) in pattern.pre_tokenize_str(t)]
    assert starts.tolist() == expected


def test_library_gets_each_part_once(byte_tokenizer):
    """Words that differ only by marks, line ends or their place in the
    text cost the library one new part."""
    library, own, asked = Tokenizer.from_file(byte_tokenizer), T.Words(byte_tokenizer), []
    plain = own.plain.encode_batch_fast
    own.plain = type("Counting", (), {"encode_batch_fast": staticmethod(
        lambda texts, **kw: asked.extend(w for t in texts for w in t.split()) or plain(texts, **kw))})()
    texts = ["the wxqzzk. wxqzzk, wxqzzk! wxqzzk\n the (wxqzzk) wxqzzk's", "the wxqzzk", "", "wxqzzk wxqzzk…  wxqzzk"]
    for _ in range(2):
        for t, ids in zip(texts, own(texts), strict=True):
            assert ids.tolist() == library.encode(t, add_special_tokens=False).ids
    assert sorted(asked) == sorted(set(asked)) and sum("wxqzzk" in w for w in asked) == 2


def test_file_round_trip_and_checkpoints():
    rng = np.random.default_rng(9)
    step = T.LANES * T.BLOCK_ROWS
    docs = [rng.zipf(1.3, n).clip(1, 50_000).astype(np.uint32) for n in (0, 1, 7, T.LANES, step - 500, step + 12345, 3)]
    keys = [None, -5, 0, 1, 2, 3, 3]
    read = T.TokenFile(T.file_image(keys, docs))
    place = 0
    for (key, at, ids), k, d in zip(read.documents(), keys, docs, strict=True):
        assert (key, at) == (k, place) and (ids == d).all()
        place += len(d)
    whole = read.block(0)
    for mark in range(read.blocks[0][1]):
        assert (read.block(0, mark) == whole[mark * T.CHECK_ROWS * T.LANES:]).all()
    every = np.concatenate(docs)
    for a, b in ((0, 0), (0, 5), (step - 3, step + 3), (T.LANES * T.CHECK_ROWS + 1, T.LANES * T.CHECK_ROWS + 9),
                 (2 * step - 700, len(every)), (0, len(every)), (len(every), len(every) + 5)):
        assert (read.part(a, b) == every[a:b]).all(), (a, b)
    assert list(T.TokenFile(T.file_image([], [])).documents()) == []
    one = T.TokenFile(T.file_image([1], [np.full(70_000, 7, np.uint32)]))
    assert (next(one.documents())[2] == 7).all()


def test_damage_is_found():
    image = bytearray(T.file_image([1], [np.arange(5000, dtype=np.uint32) % 97]))
    image[-3] ^= 64
    try:
        list(T.TokenFile(bytes(image)).documents())
        raise AssertionError("not found")
    except ValueError:
        pass


def test_frequencies_sum():
    for n in (1, 2, 50_000):
        symbols, freq = T.shared_table(np.arange(n).repeat(2))
        assert freq.sum() == 1 << T.BITS and freq.min() >= 1 and len(symbols) == n


def test_files_of_odd_rows(spark, odd, empty, byte_tokenizer):
    library = Tokenizer.from_file(byte_tokenizer)
    target = T.new_target(spark, "odd")
    T.write_files(odd, target, byte_tokenizer, end_id=2, file_text_bytes=4000)
    got = T.read_files(spark, target).collect()
    expected = sorted(((r.doc_id is not None, r.doc_id or 0), library.encode(r.text or "", add_special_tokens=False).ids + [2])
                      for r in odd.collect())
    got.sort(key=lambda r: r.start)
    assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == [e[0] for e in expected]
    assert sum(r.n_tokens for r in got) == sum(len(e[1]) for e in expected)
    for r, before in zip(got[1:], got):
        assert r.start == before.start + before.n_tokens
    by_id = {}
    for (_, doc), ids in expected:
        by_id.setdefault(doc, set()).add(zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert all(zlib.crc32(r.ids) in by_id[r.doc_id or 0] for r in got)
    none = T.new_target(spark, "none")
    T.write_files(empty, none, byte_tokenizer, end_id=2)
    assert T.read_files(spark, none).count() == 0


def test_one_id_on_many_rows(spark, byte_tokenizer):
    """Rows of one id, most of them equal, lie in several files; a second
    run writes the same."""
    rows = [(7, f"word {i % 5} and more words") for i in range(4000)] + [(i, "x") for i in range(20)] + [(None, "y")] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    runs = []
    for name in ("one", "two"):
        target = T.new_target(spark, name)
        T.write_files(df, target, byte_tokenizer, end_id=2, file_text_bytes=9000)
        files = spark.read.parquet(target)
        assert files.count() >= 8 and files.agg({"n_docs": "max"}).first()[0] < 1600
        got = sorted(tuple(r) for r in T.read_files(spark, target).select("start", "doc_id", "n_tokens", "ids").collect())
        assert len(got) == len(rows) and [r[0] for r in got] == [sum(x[2] for x in got[:k]) for k in range(len(got))]
        assert [r[1] for r in got] == [None] * 300 + list(range(7)) + [7] * 4001 + list(range(8, 20))
        runs.append([tuple(r[1:]) for r in got])
    assert runs[0] == runs[1]


def test_queries_against_library(spark, word_tokenizer, byte_tokenizer):
    import hashlib

    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    library = Tokenizer.from_file(word_tokenizer)
    for r in queries.op5_bpe(spark, SF_SMALL).collect():
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == digest(" ".join(map(str, ids)))
        assert r.decoded_sha256 == digest(library.decode(ids, skip_special_tokens=False))
    library, start = Tokenizer.from_file(byte_tokenizer), 0
    rows = sorted(queries.op6_token_files(spark, SF_SMALL).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == sorted(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
