from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import docs, edges, empty

from starmill.llm import quality, queries

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)]


def test_base_counts(spark, tiny):
    texts = [r.text for r in queries.table(spark, tiny, "documents").collect()]
    texts += [None, "", " \n ", "a b\na b\n\n", "# é* 漢字|\n漢字", "x " * 40, " ".join("abcdefgh" * 3) + " z " + " ".join("abcdefgh")]
    made = np.array(quality.base_counts(pa.array(texts, pa.string()))).T
    assert made.tolist() == [brute(t) for t in texts]


def test_junk_goes_and_good_documents_stay(spark, small):
    made = queries.op8_quality(spark, small)
    labels = queries.table(spark, small, "labels")
    rows = made.join(labels, "doc_id").filter("not base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.98
    assert sum(bad) / len(bad) < 0.1
    rest = made.join(labels, "doc_id", "left_anti").filter("not base_failed").collect()
    assert sum(r.kept for r in rest) / len(rest) > 0.85


def test_ratios_and_scores_against_plain_counting(spark):
    rows = [(1, "good words here"), (2, "bad ### words"), (3, "good good ###")]
    counts = quality.corpus_counts(docs(spark, rows), spark.createDataFrame([(1,), (3,)], "doc_id bigint"), 64)
    found = [quality.ngram_buckets(pa.array([t]), 64)[0] for _, t in rows]
    assert [len(k) for k in found] == [5, 5, 5]
    raw = np.bincount(np.concatenate(found), minlength=64)
    good = np.bincount(np.concatenate([found[0], found[2]]), minlength=64)
    assert (counts == [raw, good]).all()
    prior = (raw + 1) / (15 + 64)
    want = np.log((good + 64 * prior) / (10 + 64)) - np.log(prior)
    made = {r.doc_id: r.llr for r in quality.scores(docs(spark, rows), counts).collect()}
    assert made == pytest.approx({k: want[f].mean() for (k, _), f in zip(rows, found)})


def test_threshold_parts_the_labels(spark):
    scored = spark.createDataFrame([(k, k / 100, k / 100) for k in range(20)], "doc_id bigint, llr double, left_out double")
    labels = spark.createDataFrame([(k, int(k >= 8)) for k in range(20)] + [(99, None), (None, 1)], "doc_id bigint, quality int")
    target = quality.trusted_sample(labels)
    assert {r.doc_id for r in target.collect()} == set(range(8, 20))
    assert 0.07 < quality.threshold(scored, labels, target) < 0.08
    assert quality.threshold(scored, labels.filter("quality = 1"), target) == float("-inf")


def test_target_sample_is_bounded(spark):
    labels = spark.range(20_000).selectExpr("id as doc_id", "1 as quality")
    for most in (100, 5000):
        assert 0.7 * most < quality.trusted_sample(labels, most).count() <= most
    assert quality.trusted_sample(labels, 20_000).count() == 20_000


def test_edge_cases(spark):
    labels = spark.createDataFrame([(5, 1), (6, 0), (None, 1)], "doc_id bigint, quality int")
    made, _ = quality.assess(edges(spark), labels)
    rows = made.collect()
    assert len(rows) == 10
    by_id = {r.doc_id: r for r in rows}
    for k in (1, 2, 3):
        assert by_id[k].base_failed and not by_id[k].kept and by_id[k].llr is None
    assert by_id[5].kept and by_id[5].n_words == 30_000
    assert quality.assess(empty(spark), labels)[0].collect() == []
    alone, least = quality.assess(edges(spark), labels.filter("false"))
    assert least == float("-inf") and {r.doc_id for r in alone.filter("kept").collect()} == {5}
