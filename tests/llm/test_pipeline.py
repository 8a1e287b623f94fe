import random

import corpus_pipeline as P
from cases import SF_SMALL, empty, odd, word_tokenizer  # noqa: F401
from test_dedup import plain_earlier, sets_of, words_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_the_given_table(spark, word_tokenizer):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").cache()
    before = docs.collect()
    told = P.identify_language(spark, docs, SF_SMALL)
    rows = told.collect()
    assert told.columns == COLUMNS
    # Clean documents stay: every text with letters that is not junk.
    gone = {r.doc_id for r in before} - {r.doc_id for r in rows}
    assert len(gone) <= 0.02 * len(before)
    assert all(any(c.isalpha() for c in r.text) for r in rows)

    kept = P.drop_near_duplicates(spark, told, SF_SMALL)
    sets, low = sets_of(rows), {r.doc_id: r.doc_id for r in rows}
    links = [(rows[a].doc_id, rows[b].doc_id) for a in range(len(rows)) for b in range(a)
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in range(30):
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    rows = kept.collect()
    assert kept.columns == COLUMNS and sorted(r.doc_id for r in rows) == sorted(k for k in low if low[k] == k)

    cut = P.drop_repeated_strings(spark, kept, SF_SMALL)
    expected = {r.doc_id: x[3].decode(errors="ignore") for r, x in zip(rows, plain_earlier(rows, 50))}
    rows = cut.collect()
    assert cut.columns == COLUMNS
    assert {r.doc_id: r.text for r in rows} == expected
    assert all(r.n_chars == len(r.text) for r in rows)

    mixed = P.mix_sources(spark, cut, SF_SMALL)
    assert mixed.columns == COLUMNS
    times = {}
    for r in mixed.collect():
        assert r.text == expected[r.doc_id]
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert max(times.values()) == 2
    words = sum(len(words_of(r.text)) for r in rows)
    taken = sum(n * len(words_of(expected[d])) for d, n in times.items())
    assert abs(taken - 1.5 * words) < 0.05 * words

    library = Tokenizer.from_file(word_tokenizer)
    coded = P.encode(spark, mixed, SF_SMALL).collect()
    assert sorted(r.doc_id for r in coded) == sorted(d for d, n in times.items() for _ in range(n))
    for r in coded[:40]:
        assert r.token_ids == library.encode(expected[r.doc_id], add_special_tokens=False).ids


def test_stages_on_odd_rows(spark, odd, empty):
    for docs in (odd, empty):
        n = docs.count()
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns == docs.columns, name
            assert out.count() <= 2 * n
        assert P.encode(spark, docs, SF_SMALL).count() == n
    kept = P.drop_near_duplicates(spark, odd, SF_SMALL).collect()
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and sum(r.doc_id is None for r in kept) == 2


def test_run_is_repeatable(spark):
    one, two = (sorted(map(str, P.run(spark, SF_SMALL).collect())) for _ in range(2))
    assert one == two and len(one) > 100
    assert P.ORACLE_SQL is None and len(P.STAGES) == 5
    random.seed(0)


def test_run_on_empty_and_null_only_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    tables = {"empty": [], "nulls": [(i, None, None, None, None) for i in range(5)] + [(None, None, "en", "a", 0)],
              "blank": [(1, "", "en", "a", 0), (1, "  ", "en", "a", 2), (2, "?!", None, None, 2)]}
    for name, rows in tables.items():
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
        got = P.run(spark, folder)
        assert got.columns == ["doc_id", "source", "n_tokens", "token_ids", "decoded_sha256"]
        assert got.count() == 0  # texts without a letter are in no language


def test_texts_that_share_an_id_stay(spark):
    rng = random.Random(2)
    text = lambda: " ".join(f"w{rng.randrange(9999)}" for _ in range(60))
    a, b, c = text(), text(), text()
    rows = [(5, a), (5, b), (5, b), (7, a), (7, c), (9, c + " more"), (-3, b + " end"), (None, a), (None, a)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(((r.doc_id is None, r.doc_id or 0), r.text) for r in P.drop_near_duplicates(spark, docs, SF_SMALL).collect())
    assert kept == sorted([((False, 5), a), ((False, -3), b + " end"), ((False, 7), c), ((True, 0), a), ((True, 0), a)])
