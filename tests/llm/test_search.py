from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import docs, edges, empty

from starmill.llm import lookup, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(rows, items, k):
    counts = [(key, Counter(terms(text))) for key, text in rows]
    N, L = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for name, text in items:
        asked = set(terms(text))
        made = []
        for key, c in counts:
            score = 0
            for t in asked & set(c):
                m = 100 - 50 + 50 * c.total() * N // L
                score += math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                made.append((-score, key is not None, key))
        out += [(name, rank, key, -s) for rank, (s, _, key) in enumerate(sorted(made)[:k], 1)]
    return sorted(out, key=str)


def random_rows(seed, n=300):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "Of", "a", "é", "x1", "漢"] + [f"t{int(rng.paretovariate(0.6))}" for _ in range(4)])
    text = lambda most: rng.choice([" ", ", ", "\n"]).join(word() for _ in range(rng.randrange(most)))
    rows = [(k * 3 % 301, text(60)) for k in range(n)] + [(1000 + k, "the copied t1 t2 t3") for k in range(100)]
    rows += [(None, "t1 t2"), (None, None), (5000, None), (5001, ""), (7, rows[3][1])]
    items = [(k, text(30)) for k in range(25)] + [(100, None), (101, "??"), (102, "the copied"), (3, "t1 the the")]
    return rows, items


@pytest.mark.parametrize("k", [1, 5, 50])
def test_equals_brute_force(spark, k, monkeypatch):
    monkeypatch.setattr(search, "AT_ONCE", 4)
    rows, items = random_rows(k)
    table = spark.createDataFrame(items, "item_id int, text string")
    found = search.search(docs(spark, rows).repartition(3), table, k).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, items, k)


def test_items_in_several_parts(spark):
    rows, items = random_rows(9)
    table = spark.createDataFrame(items, "item_id int, text string")
    found = search.search(docs(spark, rows), table, 4, limit=1000).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, items, 4)


def test_treap_finds_the_best_columns():
    rng = np.random.default_rng(8)
    for size in (1, 7, 300):
        points = {(int(r), int(c)): int(v) for r, c, v in zip(rng.integers(0, 40, 900), rng.integers(0, size, 900), rng.integers(1, 30, 900))}
        rows, columns = (np.array(x) for x in zip(*points))
        treap = search.Treap(rows, columns, np.array(list(points.values())))
        for _ in range(20):
            asked = rng.choice(40, 12, replace=False)
            weights = rng.integers(0, 9, 12)
            sums = Counter()
            for r, w in zip(asked.tolist(), weights.tolist()):
                sums.update({c: w * v for (q, c), v in points.items() if q == r})
            want = sorted((-s, c) for c, s in sums.items() if s > 0)[:10]
            assert treap.top(asked, weights, 10) == [(-s, c) for s, c in want]


def test_long_text_is_read_in_parts(monkeypatch):
    monkeypatch.setattr(search.blocks, "BLOCK_BYTES", 50)
    text = "one two, three one é " * 100
    table = np.unique(lookup.term_hashes("one é"))
    n, doc, term, tf = search.Postings(search.blocks.Places(table), 2).read(search.pa.array([text], search.pa.large_string()))
    assert n.tolist() == [500] and doc.tolist() == [0, 0] and sorted(tf.tolist()) == [100, 200]


def test_large_numbers_stay_exact():
    n, tf = np.array([10**9, 3]), np.array([7, 1])
    docs_, total = 10**12, 10**17
    want = [10**9 * t // (1000 * t + 20 * (50 + 50 * x * docs_ // total)) for x, t in zip(n.tolist(), tf.tolist())]
    assert search.impacts(tf, n, docs_, total).tolist() == want


def test_edge_cases(spark):
    items = spark.createDataFrame([(1, "the same words"), (None, "one")], "item_id long, text string")
    found = [tuple(r) for r in search.search(edges(spark), items).orderBy("item_id", "rank").collect()]
    assert [(i, r, d) for i, r, d, _ in found] == [(None, 1, 4), (1, 1, 6), (1, 2, 6), (1, 3, 7)]
    assert search.search(empty(spark), items).count() == 0
    assert search.search(edges(spark), items.limit(0)).count() == 0
