from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import docs, edges, empty

from starmill.llm import collocations


def brute(rows, least, limit, percent=50):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for size in (1, 2, 3):
                counts[lang or "und"].update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        made = []
        for p, a in frequent.items():
            if any(len(q) > len(p) and 100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in frequent.items()):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            made.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(made)[:limit], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def random_rows(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        words = [rng.choice(["a", "B", "b", "new", "york", "é", "x-1"] + [f"w{rng.randrange(40)}"]) for _ in range(rng.randrange(60))]
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " \r"]) for w in words)
        text += rng.choice(["", "New York City ", "of the, of the people"])
        rows.append((k, rng.choice([text, text, text, None, ""]), rng.choice(["en", "de", None])))
    return rows + [(500 + k, "copied rows stand here often", "en") for k in range(40)]


@pytest.mark.parametrize("limit", [3, 25, 2000])
def test_equals_brute_force(spark, limit):
    rows = random_rows(limit)
    found = collocations.mine(docs(spark, rows).repartition(5), least=4, limit=limit, slack=1)
    assert sorted(map(tuple, found.collect())) == brute(rows, 4, limit)


def test_small_blocks_and_many_languages(spark, monkeypatch):
    rows = random_rows(1)
    for name, value in (("BLOCK_BYTES", 60), ("HELD", 10), ("LANGUAGES", 1)):
        monkeypatch.setattr(collocations, name, value)
    parts = list(collocations._parts(iter(docs(spark, rows).select("text", "lang").fillna("und", ["lang"]).toArrow().to_batches())))
    assert sum(len(p.hashes) for p in parts) == sum(len(re.findall(r"[^ \t.,;:!?\n-\r]+", r[1] or "")) for r in rows)
    assert sorted(map(tuple, collocations.mine(docs(spark, rows), least=5, limit=9).collect())) == brute(rows, 5, 9)


def test_large_counts_stay_exact(spark):
    words = spark.createDataFrame([("en", "a", 1, 4_000_000_000_000), ("en", "b", 2, 3_999_999_999_999)], "lang string, word string, key long, n long")
    pairs = spark.createDataFrame([(1, 2, 3_999_999_999_998)], "k1 long, k2 long, n long")
    threes = spark.createDataFrame([], "k1 long, k2 long, k3 long, n long")
    row = collocations.candidates(words, pairs, threes).first()
    assert row.score == 10**6 * 3_999_999_999_998**2 // (4_000_000_000_000 * 3_999_999_999_999)


def test_trie_counts_every_state():
    rng = np.random.default_rng(3)
    phrases = {tuple(int(x) for x in rng.integers(-50, 50, rng.integers(1, 4))) for _ in range(400)}
    trie = collocations.Trie(phrases)
    text = rng.integers(-60, 60, 5000)
    joined = rng.random(5000) < 0.9
    joined[-1] = False
    place = {int(k): i for i, k in enumerate(trie.symbols)}
    counts = trie.count(np.array([place.get(int(x), -1) for x in text]), joined)
    for phrase, state in trie.states.items():
        n = len(phrase)
        want = sum(tuple(text[i : i + n]) == phrase and joined[i : i + n - 1].all() for i in range(len(text) - n + 1))
        assert not n or counts[state] == want


def test_edge_cases(spark):
    found = collocations.mine(edges(spark), least=2).collect()
    assert {r.lang for r in found} == {"en"} and {r.phrase for r in found} >= {"the same words", "of the table"}
    assert collocations.mine(empty(spark)).count() == 0
    assert collocations.mine(docs(spark, [(1, "a b")])).count() == 0
