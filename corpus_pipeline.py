"""A training corpus from raw documents, in five stages.

Each stage works on all rows that its predecessor kept, is written as
Parquet to the shared folder and read again.  Its decisions take effect:
documents go, texts get shorter, documents are repeated.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from visitlens.llm import bpe, language, minmax, mixing, suffix
from visitlens.llm.common import table
from visitlens.llm.queries import language_network, tokenizer_file
from visitlens.llm.token_files import new_target

# A text counts as language if some learned label gets this much of the
# mean probability; there are few labels, so this rejects little.
LEAST_SCORE = 0.35
SIMILAR_PERCENT = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language.  Texts without a letter, null ones
    among them, and texts that the network places nowhere go."""
    told = language.identify(docs, language_network(docs))
    return told.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select("row.*")


def _node() -> Column:
    """A number for each document, in the order of doc_id: rows that share
    an id but hold another text are documents of their own."""
    wide = lambda c: c.cast("decimal(38,0)")
    texts = 1 << 60
    return wide(F.col("doc_id").cast("long")) * F.lit(texts).cast("decimal(19,0)") + wide(
        F.pmod(F.xxhash64("text"), F.lit(texts)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest
    doc_id.  A row is a document: of rows that share a doc_id only those with
    one text are the same, and one of them stays.  Rows without a doc_id
    stay."""
    node, nth = "_node", "_nth"
    while {node, nth} & set(docs.columns):
        node, nth = node + "_", nth + "_"
    known = docs.where("doc_id IS NOT NULL").withColumn(node, _node())
    kept = minmax.near_duplicates(known, key=node, percent=SIMILAR_PERCENT).where("kept").select(node).distinct()
    one = Window.partitionBy(node).orderBy("lang", "source")
    first = known.join(kept, node, "left_semi").withColumn(nth, F.row_number().over(one)).where(F.col(nth) == 1)
    return first.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 50 bytes that a document with a smaller
    doc_id holds; a character that a cut parts goes whole."""
    done = suffix.remove_earlier(docs, as_text=True, with_spans=False)
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns if c != "text"} | {"text": F.col("kept")}
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length("kept").cast(dict(docs.dtypes)["n_chars"])
    return done.select(*[columns[c].alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, once or twice."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "source",
                       mixing.word_count(F.col("text")).alias("size"))
    mixed = mixing.mix(rows, mixing.source_targets(rows), ["doc_id"])
    return mixed.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and a digest of the text that they stand
    for."""
    keyed = docs.select(F.struct("doc_id", "source").alias("doc"), "text")
    coded = bpe.encode_texts(keyed, tokenizer_file("word_bpe_49k.json"), key="doc")
    return coded.select("doc.doc_id", "doc.source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language identification", identify_language),
    ("min-max near-duplicates", drop_near_duplicates),
    ("suffix-array duplicates", drop_repeated_strings),
    ("mixing sources", mix_sources),
    ("bpe encoding", encode),
]

# Trained weights, hashed draws and byte offsets: not for SQL.  The tests
# hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        target = new_target(spark, f"stage{k}")
        stage(spark, docs, sf_dir).write.parquet(target)
        docs = spark.read.parquet(target)
    return STAGES[-1][1](spark, docs, sf_dir)
