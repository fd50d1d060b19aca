from __future__ import annotations

import random
import re

import numpy as np
import pytest
from helpers import docs, edges, empty

from starmill.llm import blocks, decontaminate, lookup

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def brute(rows, items, size):
    """Every window of every item at every place of every text."""
    windows = {}
    for name, text in items:
        words = terms(text)
        for k in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[k : k + size]), set()).add(name)
    lengths = {len(w) for w in windows}
    found = []
    for key, text in rows:
        words, hit, names = terms(text), set(), set()
        for k in range(len(words)):
            for n in lengths:
                owners = windows.get(tuple(words[k : k + n]))
                if owners and k + n <= len(words):
                    hit |= set(range(k, k + n))
                    names |= {str(o) for o in owners if o is not None}
        found.append((key, len(words), len(hit), sorted(names)))
    return sorted(found, key=str)


def operator(spark, rows, items, size, limit=lookup.PART_BYTES):
    table = spark.createDataFrame(items, "item_id bigint, text string")
    result = decontaminate.find(docs(spark, rows).repartition(3), table, size, limit).collect()
    return sorted([(r.doc_id, r.n_words, sum(s.last_word - s.first_word for s in r.spans), r["items"]) for r in result], key=str)


def random_rows(seed, n=150):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "Of", "a", "b", "é", "x1", "漢", "to", "in", "rare" + str(rng.randrange(30))])
    items = [(k % 17, " ".join(word() for _ in range(rng.randrange(0, 30)))) for k in range(20)] + [(None, "a b a b a"), (50, None), (51, "--")]
    rows = []
    for k in range(n):
        parts = [rng.choice([" ", ", ", "\n", "-"]).join(word() for _ in range(rng.randrange(0, 40)))]
        for _ in range(rng.randrange(3)):
            parts.append(rng.choice(items)[1] or "")
        rows.append((k, " ".join(rng.sample(parts, len(parts)))))
    return rows + [(900 + k, rows[3][1]) for k in range(30)] + [(None, rows[5][1])], items


@pytest.mark.parametrize("size", [1, 2, 4, 10])
def test_equals_brute_force(spark, size):
    rows, items = random_rows(size)
    assert operator(spark, rows, items, size) == brute(rows, items, size)


def test_phrases_in_several_parts_and_small_shards(spark, monkeypatch):
    rows, items = random_rows(77)
    assert operator(spark, rows, items, 4, limit=300) == brute(rows, items, 4)
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 7)
    part = decontaminate.phrases([type("Row", (), {"item_id": i, "text": t or ""}) for i, t in items], 4)
    table = blocks.Places(part.vocabulary)
    for _, text in rows:
        hashes = lookup.term_hashes(text)
        symbols = table.find(hashes).astype(np.int32) + 1
        place, phrase = decontaminate.occurrences(symbols, np.array([0, len(symbols)]), part)
        got = set(zip(place.tolist(), phrase.tolist()))
        want = {
            (k, p) for p, (words, n) in enumerate(zip(part.words, part.lengths))
            for k in range(len(symbols) - n + 1) if (symbols[k : k + n] == words[len(words) - n :]).all()
        }
        assert got == want


def test_index_parts():
    rng = np.random.default_rng(5)
    symbols = rng.integers(0, 9, 3000)
    tree = decontaminate.WaveletTree(symbols, 4)
    at, asked = rng.integers(0, 3001, 500), rng.integers(0, 9, 500)
    assert tree.rank(asked, at).tolist() == [int((symbols[:a] == s).sum()) for a, s in zip(at, asked)]
    runs = [rng.integers(1, 3, n).tolist() for n in (1, 5, 90, 90, 400, 3)] * 3
    text = np.array([x for r in runs for x in [*r, 0]])
    marks = np.flatnonzero(text == 0)
    ends = np.repeat(marks, np.diff(marks, prepend=-1))
    order = decontaminate.suffix_order(text, ends, 2)
    want = sorted(range(len(text)), key=lambda i: (text[i : ends[i] + 1].tolist(), i))
    assert order.tolist() == want


def test_edge_cases(spark):
    benchmark = spark.createDataFrame([(1, "the same words stand here in two rows of the table"), (2, "one")], "item_id long, text string")
    found = decontaminate.find(edges(spark), benchmark).collect()
    assert len(found) == 10 and sum(bool(r.spans) for r in found) == 4
    long = next(r for r in found if r.doc_id == 5)
    assert long.n_words == 30_000 and not long.spans
    assert decontaminate.find(empty(spark), benchmark).count() == 0
    assert all(not r.spans for r in decontaminate.find(edges(spark), benchmark.limit(0)).collect())


def test_removal_cuts_the_spans(spark):
    benchmark = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    rows = [(1, "é Alpha, beta gamma; delta. End"), (2, "nothing"), (3, None), (4, "alpha beta gamma delta alpha beta gamma delta")]
    kept = {r.doc_id: r.text for r in decontaminate.remove(docs(spark, rows), benchmark, 4).collect()}
    assert kept == {1: "é . End", 2: "nothing", 3: None, 4: ""}
