"""The dealt operators as queries over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from visitlens.llm import bpe, collocation, columnar, conversation, cross_polytope, html_text, language, minmax, mixing, multi_index, substring, suffix, token_files
from visitlens.llm.common import cut, table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    texts = html_text.extract(pages.select("page_id", "url", "html"), html_text.fit(pages))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op2_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.95)


def held_out(key: str = "doc_id") -> Column:
    """Documents that no language model learns from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_network(docs: DataFrame) -> language.Network | None:
    return language.fit(docs.where(~held_out()).select(
        F.col("doc_id").alias("key"), "text", F.col("lang").alias("label")))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = language.identify(docs.select("doc_id", "text"), language_network(docs))
    return told.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op4_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return multi_index.nearest_neighbours(vectors, F.col("vec_id") % 20 == 0, k=20)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = bpe.encode_texts(docs, tokenizer_file("word_bpe_49k.json"))
    ids = F.concat_ws(" ", F.col("token_ids").cast("array<string>"))
    return coded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                        F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    target = token_files.new_target(spark, "tokens")
    token_files.write_files(docs, target, tokenizer_file("byte_bpe_50k.json"), end_id=2)
    read = token_files.read_files(spark, target)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op8_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = suffix.remove_earlier(docs)
    return done.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = cut(docs.select(F.struct("doc_id").alias("row"), "source", mixing.word_count(F.col("text")).alias("size")))
    mixed = mixing.mix(rows, mixing.source_targets(rows), ["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = substring.remove_repeats(docs, key="doc_id")
    return done.select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_columnar(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return columnar.highest(vectors, F.col("vec_id") % 20 == 0, k=20)


def op12_conversation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation.audit(rows, conversation.damage(rows))


def op13_collocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(table(spark, sf_dir, "documents"), least=10, top=2000)


QUERIES = {
    "op1_html": op1_html,
    "op2_cross_polytope": op2_cross_polytope,
    "op3_language": op3_language,
    "op4_multi_index": op4_multi_index,
    "op5_bpe": op5_bpe,
    "op6_token_files": op6_token_files,
    "op7_minmax": op7_minmax,
    "op8_suffix": op8_suffix,
    "op9_mixing": op9_mixing,
    "op10_substring": op10_substring,
    "op11_columnar": op11_columnar,
    "op12_conversation": op12_conversation,
    "op13_collocation": op13_collocation,
}

ORACLES: dict[str, str] = {
    "op2_cross_polytope": """
        WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM e a JOIN e b ON a.vec_id <> b.vec_id
            AND list_cosine_similarity(a.v, b.v) >= 0.95),
        r AS (SELECT vec_id AS x, vec_id AS y FROM e UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
        k AS (SELECT x, min(y) AS component_id FROM r GROUP BY x),
        n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM e JOIN k ON k.x = vec_id LEFT JOIN n ON n.x = vec_id""",
    "op7_minmax": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS h FROM
            (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id
            GROUP BY ALL),
        l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
            WHERE 100 * i >= 85 * (p.n + q.n - i)),
        r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
        k AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM d JOIN k ON k.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op8_suffix": r"""
        WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
        s AS (SELECT doc_id, unnest(generate_series(1, len(x) // 2 - 49)) AS i FROM d WHERE len(x) >= 100),
        h AS (SELECT s.doc_id, i, substr(x, 2 * i - 1, 100) AS win FROM s JOIN d USING (doc_id)),
        r AS (SELECT h.doc_id, i FROM h JOIN (SELECT win, min(doc_id) AS first_doc FROM h GROUP BY win) m USING (win)
            WHERE first_doc < h.doc_id),
        o AS (SELECT doc_id, i, CASE WHEN i <= 50 + lag(i) OVER (PARTITION BY doc_id ORDER BY i) THEN 0 ELSE 1 END AS fresh
            FROM r),
        g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM o),
        p AS (SELECT doc_id, run, min(i) AS a, max(i) + 49 AS z FROM g GROUP BY doc_id, run),
        q AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM p),
        k AS (SELECT doc_id, count(*) AS n_spans, CAST(sum(z - a + 1) AS BIGINT) AS n_removed, max(z) AS last_z,
            string_agg(substr(x, 2 * before + 1, 2 * (a - 1 - before)), '' ORDER BY a) AS front
            FROM q JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
            coalesce(n_spans, 0) AS n_spans,
            sha256(unhex(coalesce(front, '') || substr(x, 2 * coalesce(last_z, 0) + 1))) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)""",
    "op10_substring": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, len(w) AS n, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35),
        h AS (SELECT s.doc_id, i, array_to_string(w[i:i + 34], ' ') AS win FROM s JOIN d USING (doc_id)),
        r AS (SELECT doc_id, i FROM h WHERE win IN (SELECT win FROM h GROUP BY win HAVING count(*) > 1)),
        g AS (SELECT doc_id, list_distinct(flatten(list(generate_series(i, i + 34)))) AS gone FROM r GROUP BY doc_id),
        k AS (SELECT d.doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN g USING (doc_id))
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
            sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(gone, i)), ' ')) AS kept_sha256
        FROM k""",
    "op11_columnar": """
        WITH e AS (SELECT vec_id, len(embedding) AS n,
            list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[]))
            AS BIGINT) AS score FROM e q JOIN e c ON q.vec_id <> c.vec_id AND q.n = c.n WHERE q.vec_id % 20 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20""",
    "op12_conversation": r"""
        WITH RECURSIVE t AS (SELECT [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
            3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108] AS t),
        k AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS x
            FROM conversations),
        c AS (SELECT k.*, xor(4294967295, list_reduce(
            list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(x, ''), lambda y: CAST(ord(y) AS BIGINT))),
            lambda a, b: xor(t[1 + (xor(xor(t[1 + (xor(a, b) & 15)], a >> 4), b >> 4) & 15)],
                xor(t[1 + (xor(a, b) & 15)], a >> 4) >> 4))) % 20 AS kind FROM k, t),
        d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g')
                ELSE coalesce(text, ' ') END AS text, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS n FROM c),
        o AS (SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text
                ORDER BY turn NULLS FIRST, n) AS same, lag(role[1]) OVER w AS past,
            regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS z FROM d
            WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(octet_length(encode(role)) || ':' || role || text), n)),
        f AS (SELECT *, CASE WHEN z = '' THEN 'b' WHEN same > 1 THEN 'd' WHEN z NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
            role[1] AS r FROM o),
        m AS (SELECT conv_id, max(i) AS n FROM f GROUP BY conv_id),
        w AS (SELECT conv_id, 0 AS i, {'c': 0, 'a': ''} AS s0, {'c': 1000000000, 'a': ''} AS s1,
                {'c': 2, 'a': 'I'} AS s2, {'c': 4, 'a': 'II'} AS s3 FROM m
            UNION ALL
            SELECT conv_id, i, s0, s1, s2, least(s3, {'c': s2.c + 2, 'a': s2.a || 'I'}) FROM (
            SELECT conv_id, i, s0, s1, least(s2, {'c': s0.c + 2, 'a': s0.a || 'I'}, {'c': s1.c + 2, 'a': s1.a || 'I'},
                {'c': s3.c + 2, 'a': s3.a || 'I'}) AS s2, s3 FROM (
            SELECT w.conv_id, f.i, {'c': s0.c + 3, 'a': s0.a || 'D'} AS s0,
                least({'c': s1.c + 3, 'a': s1.a || 'D'}, CASE WHEN fault IN ('', 't') AND r = 's'
                    THEN {'c': s0.c + CAST(fault = 't' AS INTEGER), 'a': s0.a || 'K'} END) AS s1,
                least({'c': s2.c + 3, 'a': s2.a || 'D'}, CASE WHEN fault IN ('', 't') THEN
                    {'c': least(s0, s1, s3).c + CAST(fault = 't' AS INTEGER) + CASE r WHEN 'u' THEN 0 ELSE 2 END,
                     'a': least(s0, s1, s3).a || CASE r WHEN 'u' THEN 'K' ELSE 'R' END} END) AS s2,
                least({'c': s3.c + 3, 'a': s3.a || 'D'}, CASE WHEN fault IN ('', 't') THEN
                    {'c': s2.c + CAST(fault = 't' AS INTEGER) + CASE r WHEN 'a' THEN 0 ELSE 2 END,
                     'a': s2.a || CASE r WHEN 'a' THEN 'K' ELSE 'R' END} END) AS s3
            FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1))),
        b AS (SELECT w.conv_id, least(s0, s3).c AS cost, least(s0, s3).a AS audit FROM w JOIN m
            ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.n = w.i),
        l AS (SELECT conv_id, j, audit[j] AS e FROM (SELECT conv_id, audit, unnest(generate_series(1, len(audit))) AS j FROM b)),
        g AS (SELECT *, sum(CAST(e <> 'I' AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY j) AS i,
            sum(CAST(e <> 'D' AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY j) AS q FROM l),
        h AS (SELECT g.*, f.role, f.text, max(CASE WHEN q = 1 AND e = 'K' AND f.r = 's' THEN 1 ELSE 0 END)
            OVER (PARTITION BY g.conv_id) AS lead FROM g LEFT JOIN f
            ON f.conv_id IS NOT DISTINCT FROM g.conv_id AND f.i = g.i AND g.e <> 'I' WHERE e <> 'D'),
        y AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role || ':' || text ELSE
            CASE WHEN (q - lead) % 2 = 1 THEN 'user:' ELSE 'assistant:' END || coalesce(text, '') END, chr(10) ORDER BY j) AS z
            FROM h GROUP BY conv_id),
        v AS (SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
            count_if(fault = 'b') AS blank, count_if(fault = 'd') AS duplicate, count_if(fault = 't') AS truncated,
            count_if(i > 1 AND coalesce(past, '') || coalesce(r, '') NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
        SELECT a.conv_id, coalesce(gaps, 0) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
            CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
            CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
            coalesce(audit, '') AS audit, sha256(coalesce(z, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN v ON v.conv_id IS NOT DISTINCT FROM a.conv_id
        LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN y ON y.conv_id IS NOT DISTINCT FROM a.conv_id""",
    "op13_collocation": r"""
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
        i AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM w WHERE len(w) > 0),
        g AS MATERIALIZED (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p, count(*) AS f FROM i, generate_series(1, 3) s(k)
            WHERE i + k - 1 <= len(w) GROUP BY ALL),
        n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
        c AS MATERIALIZED (SELECT lang, k, p, f, string_split(p, ' ') AS q FROM g WHERE k > 1 AND f >= 10),
        v AS MATERIALIZED (SELECT lang, k, p, f AS a, h, array_to_string(q[1:h], ' ') AS x,
            array_to_string(q[h + 1:k], ' ') AS y FROM (SELECT *, unnest(CASE k WHEN 2 THEN [1] ELSE [1, 2] END) AS h FROM c)),
        f AS MATERIALIZED (SELECT lang, p, f FROM g WHERE f >= 10),
        u AS (SELECT v.lang, v.k, v.p, a, e.f AS l, y.f AS r, h,
            CAST(1000000 AS HUGEINT) * a * a // (CAST(e.f AS HUGEINT) * y.f) AS score
            FROM v JOIN f e ON e.lang = v.lang AND e.p = v.x JOIN f y ON y.lang = v.lang AND y.p = v.y),
        b AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, h) = 1),
        o AS (SELECT lang, p, max(f) AS f FROM (
            SELECT lang, array_to_string(q[1:2], ' ') AS p, f FROM c WHERE k = 3
            UNION ALL SELECT lang, array_to_string(q[2:3], ' '), f FROM c WHERE k = 3) GROUP BY lang, p),
        z AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.p) AS rank
            FROM b LEFT JOIN o ON o.lang = b.lang AND o.p = b.p WHERE o.f IS NULL OR 100 * o.f < 50 * a)
        SELECT lang, rank, p AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM z JOIN n USING (lang)
        WHERE rank <= 2000""",
}
