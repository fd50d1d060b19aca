"""The registered queries of this subpackage and, where there is one, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm import collocations, decontaminate, fingerprints, langid, line_dedup, minhash, packing, pieces, quality, search, secrets, suffixes, warc
from starmill.llm.oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = langid.train(docs.filter(~F.coalesce(held_out, F.lit(False))))
    return langid.predict(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.repeated_spans(table(spark, folder, "documents"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op4_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), size=4, percent=80)


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    derived = warc.derivatives(warc.responses(table(spark, folder, "pages")))
    return derived.select(
        "record_id", "warc_type", "target_uri", "refers_to", "content_type", "payload_digest", "block_digest",
        "content_length", F.col("headers")["X-Source-Payload-Digest"].alias("source_digest"),
        F.col("headers")["X-Source-Content-Type"].alias("source_content_type"),
        F.when(F.col("warc_type") == "conversion", F.col("block").cast("string")).alias("text"),
    )


def op6_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = public_tokenizers.path("piece_bpe_32k.model")
    best = pieces.encode(docs, model, n=2)
    digest = F.when(F.col("ids").isNotNull(), F.xxhash64("ids"))  # as a CRC-32 their bytes would have to be spelled first
    best = best.withColumns({"n_pieces": F.size("ids"), "ids_xxhash64": digest})
    back = pieces.decode(best, model)
    return back.select("doc_id", "rank", "score", "n_pieces", "ids_xxhash64", F.crc32(F.col("text").cast("binary")).alias("text_crc32"))


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    known = secrets.context(docs)
    forest = secrets.train(secrets.planted(docs, known).filter("not held_out"))
    return secrets.score(secrets.findings(docs, known), forest)


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    rated, _ = quality.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return rated


def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.with_next(table(spark, folder, "documents"))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.drop_lines(table(spark, folder, "documents")).select("doc_id", "source", "text")


def op11_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last_word"] - s["first_word"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(table(spark, folder, "documents"))


def op13_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def queries() -> dict[str, Query]:
    return {
        "op1_langid": op1_langid,
        "op2_suffixes": op2_suffixes,
        "op3_packing": op3_packing,
        "op4_minhash": op4_minhash,
        "op5_warc": op5_warc,
        "op6_pieces": op6_pieces,
        "op7_secrets": op7_secrets,
        "op8_quality": op8_quality,
        "op9_fingerprints": op9_fingerprints,
        "op10_line_dedup": op10_line_dedup,
        "op11_decontaminate": op11_decontaminate,
        "op12_collocations": op12_collocations,
        "op13_search": op13_search,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
