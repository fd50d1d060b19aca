from __future__ import annotations

import os
from collections import Counter

import corpus_pipeline
import pytest
from compare import differences, duck
from helpers import docs, edges, empty

import __spark_entry__ as entry
from starmill.llm import queries, secrets

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    assert differences(entry.queries()[name](spark, FOLDER), duck(FOLDER), entry.oracle_sql()[name]) == []


def test_all_are_registered():
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert "pipeline" in names


def test_stages_keep_the_columns_and_take_effect(spark, tiny):
    table = queries.table(spark, tiny, "documents")
    plain = " ".join(f"stone{i % 7} river{i}" for i in range(60))
    extra = [
        (10_001, plain, "en"), (10_002, plain + " one more", "en"), (10_003, "12345 !!!", None), (10_004, None, None),
        *((10_010 + k, f'note {k} about hill{k} token = "{"0a1b2c3d4e" * 4}" end{k} {k}', "en") for k in range(8)),
    ]
    now = table.unionByName(docs(spark, extra))
    for _, step in corpus_pipeline.STAGES[:-1]:
        now = step(spark, now, tiny)
        assert now.columns == table.columns
    kept = {r.doc_id: r.text for r in now.collect()}
    assert 10_001 in kept and not {10_002, 10_003, 10_004} & set(kept)
    assert all(secrets.MARK in kept[10_010 + k] and "0a1b2c" not in kept[10_010 + k] for k in range(8))
    assert len(kept) > 0.6 * table.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, now, tiny)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(kept)


def test_pipeline_runs_whole(spark, tiny):
    assert corpus_pipeline.run(spark, tiny).count() > 0


def test_stages_take_edge_cases(spark, tiny):
    """Nulls, empty and very long texts, repeated rows, clashing columns; then no rows at all."""
    table = queries.table(spark, tiny, "documents").limit(150)
    odd = edges(spark).select(table.columns)
    now = table.unionByName(odd)
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = now
        now = step(spark, before, tiny)
        assert now.columns == table.columns
        ids = Counter(r.doc_id for r in now.select("doc_id").collect())
        if name == "language_id":
            assert not {1, 2, 3} & {k for k in ids if k is not None and k < 4 and ids[k] > 1} and None in ids
        if name == "line_dedup":
            assert ids == Counter(r.doc_id for r in before.select("doc_id").collect())
        if name == "near_duplicates":
            assert max(n for k, n in ids.items() if k is not None) == 1 and ids[None] == 1
    assert corpus_pipeline.STAGES[-1][1](spark, now, tiny).count() >= now.count()
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty(spark), tiny).count() == 0


def test_near_duplicates_keep_one_row_of_a_name(spark, tiny):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, text), (2, text + " more"), (3, "something else"), (3, "something other"), (4, None), (4, None), (None, text), (None, text)]
    kept = sorted((str(r.doc_id), str(r.text)[:12]) for r in corpus_pipeline.drop_near_duplicates(spark, docs(spark, rows), tiny).collect())
    assert kept == sorted([("1", text[:12]), ("3", "something el"), ("4", "None"), ("None", text[:12]), ("None", text[:12])])
