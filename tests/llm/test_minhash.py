from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from helpers import docs, edges, empty

from starmill.llm import blocks, minhash
from starmill.llm.graph import components


def brute(rows, size, percent=80):
    sets = {}
    for key, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = [w.decode() for w in low.encode().split()]
        grams = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        sets[key] = grams or ({tuple(words)} if words else set())
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(sets[k]), find(k), find(k) == k) for k in keys}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_same_components_as_all_pairs(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for family in range(12):
        base = rng.choices(vocabulary, k=rng.randint(3, 120))
        rows.append((len(rows), " ".join(base)))
        for _ in range(15):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    for size in (4, 5):
        assert found(minhash.near_duplicates(docs(spark, rows), size=size)) == brute(rows, size)


def test_links_that_miss_the_centre_of_their_bucket_are_found(spark):
    # a chain: each text is like the next only, so most members are not like the centre
    words = [f"v{i}" for i in range(400)]
    rows = [(100 + k, " ".join(words[8 * k : 8 * k + 100])) for k in range(30)]
    expected = brute(rows, 4)
    assert len({c for _, c, _ in expected.values()}) == 1
    assert found(minhash.near_duplicates(docs(spark, rows), size=4)) == expected


def test_a_doc_id_with_several_texts_links_what_they_are_like(spark):
    words = lambda k: [f"t{k}x{i}" for i in range(40)]
    a, b, c = words(1), words(2), words(3)
    rows = [(5, a), (5, b), (5, b), (8, [*b, "more"]), (3, [*a, "else"]), (9, c), (9, c), (2, c[:-1]), (7, a), (7, c[1:]), (11, words(4))]
    rows = [(k, " ".join(w)) for k, w in rows] + [(5, None), (12, None), (12, "x")]
    made = minhash.near_duplicates(docs(spark, rows).repartition(3), size=4).collect()
    assert len(made) == len(rows)
    # 3 - 5 by a, 8 - 5 by b, 7 - 5 by a, 2 - 9 by c, 7 - 9 by c: one component
    assert {(r.doc_id, r.component_id) for r in made if r.n_shingles} == {*((k, 2) for k in (2, 3, 5, 7, 8, 9)), (11, 11), (12, 12)}
    assert {(r.doc_id, r.component_id) for r in made if not r.n_shingles} == {(5, 5), (12, 12)}
    assert all(r.kept == (r.doc_id == r.component_id) for r in made)


def test_edge_cases(spark):
    rows = minhash.near_duplicates(edges(spark), size=4).collect()
    assert len(rows) == 10
    by_id = {r.doc_id: r for r in rows}
    for key in (1, 2, 3):
        assert (by_id[key].n_shingles, by_id[key].component_id, by_id[key].kept) == (0, key, True)
    assert by_id[4].n_shingles == 1
    assert by_id[5].n_shingles == 30_000 - 3
    assert by_id[7].component_id == 6 and not by_id[7].kept
    assert sum(r.doc_id == 6 and r.kept for r in rows) == 2
    assert by_id[None].component_id is None and by_id[None].kept


def test_empty_table(spark):
    assert minhash.near_duplicates(empty(spark)).collect() == []


def test_outlines_never_count_less_than_the_sets_share():
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64)) for _ in range(2))
    b[:2500] = a[:2500]
    lows = [np.sort((s & np.uint64(0xFFFF)).astype("<u2")).tobytes() for s in (a, b)]
    values, bounds = minhash._numbered(lows)
    parts = [values[bounds[i] : bounds[i + 1]] for i in (0, 1)]
    assert len(np.intersect1d(*parts)) >= len(np.intersect1d(a, b))
    assert len(set(parts[0])) == len(a)


def test_components_of_paths_stars_and_cycles(spark):
    edges_ = [(i + 1, i) for i in range(40)] + [(100, k) for k in range(101, 120)] + [(200, 201), (201, 202), (202, 200)]
    made = components(spark.createDataFrame(edges_, "x bigint, y bigint")).collect()
    assert {r.component_id for r in made if r.doc_id <= 40} == {0}
    assert {r.component_id for r in made if 100 <= r.doc_id < 120} == {100}
    assert {r.component_id for r in made if r.doc_id >= 200} == {200}
    assert len(made) == len({r.doc_id for r in made}) == 41 + 20 + 3
    assert components(spark.createDataFrame([], "x bigint, y bigint")).collect() == []


def test_words_of_a_block_are_those_of_bytes_split():
    texts = ["a b\x0bc\x0cd\re\nf\tg", "", None, "é x  y", " ", "z"]
    words = blocks.tokens(pa.array(texts, pa.string()))
    got = [[bytes(words.data[s:e]) for s, e in zip(words.starts[a:b], words.ends[a:b])] for a, b in zip(words.first, words.first[1:])]
    assert got == [(t or "").encode().split() for t in texts]
    hashes = dict(zip((bytes(words.data[s:e]) for s, e in zip(words.starts, words.ends)), words.hashes))
    again = blocks.tokens(pa.array(["z é x", "b a"]))
    assert list(again.hashes) == [hashes[w] for w in (b"z", "é x".encode(), b"b", b"a")]


def test_runs_of_words_have_equal_hashes_wherever_they_stand():
    for size in (4, 12):
        words = [f"q{i}" for i in range(30)]
        one = blocks.tokens(pa.array([" ".join(words), "x y " + " ".join(words[:size])]))
        hashes, at = blocks.grams(one, size)
        bounds = blocks.per_text(one, at)
        assert np.diff(bounds).tolist() == [31 - size, 3]
        assert hashes[0] == hashes[-1]
        assert len(np.unique(hashes)) == len(hashes) - 1
