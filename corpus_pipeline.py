"""A corpus from raw documents: five stages, each on all rows its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm import langid, line_dedup, minhash, packing, secrets
from starmill.scratch import stage

LEAST_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is unknown or uncertain; a missing ``lang`` is filled in.

    Null texts and texts without a letter have no language and go. Repeated rows are judged each,
    and alike; rows without a doc_id like any. No rows: none.
    """
    rated = langid.annotate(docs, langid.train(docs))
    known = rated.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that stand on many pages of their source; n_chars follows the text.

    Every row is a page and stays, with a null or empty text as it was. Rows without a source are
    pages of one source. No rows: none.
    """
    return line_dedup.drop_lines(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five words a shingle, similarity 0.8.

    Null or empty texts, and rows without a doc_id, belong to no group and stay. Rows that share a
    doc_id are one document, of which the least row (by all columns) stays. No rows: none.
    """
    docs = _one_row_each(docs)
    groups = minhash.near_duplicates(docs, size=5, percent=80)
    gone = groups.filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def _one_row_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row per doc_id; only rows that share theirs with another are moved for it."""
    repeated = stage(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return docs
    least = docs.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("__row"))
    others = docs.join(repeated, "doc_id", "left_anti").select(docs.columns)
    return stage(others.unionByName(least.select("__row.*")), "documents")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every row stays, with a null or empty text as it was. No rows: none."""
    known = secrets.context(docs)
    forest = secrets.train(secrets.planted(docs, known).filter("not held_out"))
    clean = secrets.redact(docs, known, forest)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all rows in sequences of at most 4096, a row per piece.

    A null or empty text is its end mark alone; repeated rows are packed each. No rows: none.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_boilerplate),
    ("near_duplicates", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

# SQL can express neither the forest nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents below ``sf_dir``, each written to the shared folder before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, step) in enumerate(STAGES, 1):
        docs = step(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stage(docs, name)
    return docs
