"""Quality rules: base counts, and a hashed n-gram likelihood ratio.

Words and runs of signs, alone and in pairs, are hashed into ``buckets``. Two
multinomials are counted: the raw corpus over all documents, and the trusted
target over those labelled good, ``TARGET_DOCS`` of them at most (if there are
more, those whose doc_id has a low hash; the sample is small enough to meet the
texts where they are read). A document's score is the mean over
its n-grams of log p(target) - log p(raw). The threshold is where the labelled
documents part best, taken from a histogram over all of them, in which a good
document is scored without its own n-grams; every document at or above it is
kept. No chance is involved.

Cases: null or empty text: no words, base_failed, not kept, null score. No
labels of a kind: the threshold is minus infinity, so the base rules decide
alone. Null labels are ignored; a document labelled both ways counts for both.
Repeated rows count once each. Null doc_id: never labelled, returned as null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm import blocks

BUCKETS = 1 << 14
TARGET_DOCS = 200_000
WINDOW = 8
SCALE = 4000  # histogram cells for a score of 1
_CELLS = 20_000  # scores beyond +-5 fall into the outer cells

SYMBOLS = np.zeros(256, np.int64)
SYMBOLS[list(b"#*$%&|<>")] = 1
_BLANK = " \t\n\r\x0b\x0c"

BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return np.diff(total[bounds])


def base_counts(texts: pa.Array) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of every text."""
    words = blocks.tokens(texts)
    n_words = np.diff(words.first)
    points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    chars = _sums(points[words.ends] - points[words.starts], words.first)
    symbols = _sums(SYMBOLS[words.data], words.texts)

    hashes, at = blocks.grams(words, WINDOW)
    bounds = blocks.per_text(words, at)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    keys = blocks.mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
    again = at[count[inverse] > 1]
    cover = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    repeated = _sums(np.cumsum(cover)[:-1] > 0, words.first)

    doubled = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts.to_pylist()):
        lines = [line for line in (text or "").split("\n") if line.strip(_BLANK)]
        doubled[k] = len(lines) - len(set(lines))
    return [n_words, chars, symbols, doubled, repeated]


def ngram_buckets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all n-grams, and the bounds of each text among them."""
    found = blocks.tokens(texts, classes=blocks.SIGNS, letters=blocks.LOWER)
    pairs, at = blocks.grams(found, 2)
    keys = np.concatenate([found.hashes, pairs])
    place = np.concatenate([np.arange(len(found.hashes)), at])
    order = np.argsort(place, kind="stable")
    return (keys[order] % np.uint64(size)).astype(np.int64), np.searchsorted(place[order], found.first)


def trusted_sample(labels: DataFrame, most: int = TARGET_DOCS) -> DataFrame:
    """doc_id of documents labelled good: all, or about nine tenths of ``most`` where there are more."""
    good = labels.filter("quality > 0 and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    count = good.count()
    if count <= most:
        return good
    return good.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(900_000 * most / count))


def corpus_counts(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """n-grams per bucket in all rows of ``docs`` (doc_id, text), and in those whose doc_id is in ``target``.

    ``target`` is of bounded size (``trusted_sample``), so no text is moved. Each
    task sends one row per bucket; the driver receives ``buckets`` rows.
    """
    trusted = F.broadcast(target.select("doc_id").withColumn("trusted", F.lit(True)))
    marked = docs.join(trusted, "doc_id", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, buckets), np.int64)
        for block in blocks.blocks(batches):
            keys, bounds = ngram_buckets(block.column("text"), buckets)
            counts[0] += np.bincount(keys, minlength=buckets)
            good = np.repeat(block.column("trusted").to_numpy(zero_copy_only=False).astype(bool), np.diff(bounds))
            counts[1] += np.bincount(keys[good], minlength=buckets)
        columns = [pa.array(np.arange(buckets)), pa.array(counts[0]), pa.array(counts[1])]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "raw", "good"])

    rows = (
        marked.mapInArrow(run, "bucket bigint, raw bigint, good bigint")
        .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).collect()
    )
    counts = np.zeros((2, buckets))
    for row in rows:
        counts[:, row.bucket] = row.raw, row.good
    return counts


def log_ratios(raw: np.ndarray, good: np.ndarray, raw_total: float, good_total: float, size: int) -> np.ndarray:
    """log p(target) - log p(raw); the target's prior is the raw corpus, worth one n-gram per bucket."""
    prior = (raw + 1) / (raw_total + size)
    return np.log((good + size * prior) / (good_total + size)) - np.log(prior)


def scores(docs: DataFrame, counts: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the base counts and ``llr``, the mean log ratio (null without n-grams)."""
    ratios = log_ratios(*counts, *counts.sum(axis=1), counts.shape[1])

    def work(block: pa.RecordBatch) -> list:
        texts = block.column("text")
        keys, bounds = ngram_buckets(texts, len(ratios))
        n = np.diff(bounds)
        mean = _sums(ratios[keys], bounds) / np.maximum(n, 1)
        return [block.column("doc_id"), *base_counts(texts), pa.array(mean, pa.float64(), mask=n == 0)]

    return blocks.map_texts(docs, work, f"doc_id bigint, {BASE}, llr double", doc_id=doc_id, text=text)


def left_out_scores(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """(doc_id, llr, left_out): the score, and that without the document's own n-grams in either count."""
    size = counts.shape[1]
    totals = counts.sum(axis=1)
    ratios = log_ratios(*counts, *totals, size)

    def work(block: pa.RecordBatch) -> list:
        keys, bounds = ngram_buckets(block.column("text"), size)
        n = np.diff(bounds)
        means = [_sums(ratios[keys], bounds) / np.maximum(n, 1), np.zeros(len(n))]
        for k in np.flatnonzero(n):
            used, own = np.unique(keys[bounds[k] : bounds[k + 1]], return_counts=True)
            raw, good = counts[0][used] - own, np.maximum(counts[1][used] - own, 0)
            means[1][k] = log_ratios(raw, good, totals[0] - n[k], max(0, totals[1] - n[k]), size) @ own / n[k]
        return [block.column("doc_id"), *(pa.array(m, pa.float64(), mask=n == 0) for m in means)]

    return blocks.map_texts(docs, work, "doc_id bigint, llr double, left_out double")


def threshold(scored: DataFrame, labels: DataFrame, target: DataFrame) -> float:
    """The score from which balanced accuracy on the labelled documents is largest; those of ``target`` count as left out."""
    scored = scored.join(F.broadcast(target.select("doc_id").withColumn("trusted", F.lit(True))), "doc_id", "left")
    score = F.when(F.col("trusted"), F.col("left_out")).otherwise(F.col("llr"))
    cell = F.greatest(F.lit(-_CELLS), F.least(F.lit(_CELLS), F.round(score * SCALE))).cast("int").alias("cell")
    known = labels.select("doc_id", "quality").filter("doc_id is not null and quality is not null").distinct()
    rows = scored.filter("llr is not null").join(known, "doc_id").groupBy(cell, "quality").count().collect()
    histogram = np.zeros((2, 2 * _CELLS + 1))
    for row in rows:
        histogram[int(row.quality > 0), row.cell + _CELLS] += row["count"]
    if not histogram.sum(axis=1).all():
        return float("-inf")
    shares = histogram / histogram.sum(axis=1, keepdims=True)
    gain = np.cumsum(shares[0]) - np.cumsum(shares[1])  # bad ones below less good ones below
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return (best[len(best) // 2] + 0.5 - _CELLS) / SCALE  # the middle of the gap between the two


def assess(
    docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, doc_id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, float]:
    """doc_id, base counts, llr, base_failed and kept of every document, and the threshold taken."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    target = trusted_sample(labels)
    counts = corpus_counts(rows, target, buckets)
    least = threshold(left_out_scores(rows, counts), labels, target)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("llr") >= F.lit(least), F.lit(False))
    return scores(rows, counts).withColumn("base_failed", failed).withColumn("kept", kept), least
