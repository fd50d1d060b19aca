from __future__ import annotations

import itertools
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import EDGES, docs, edges, empty

from starmill.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(PATH)


def brute(vocabulary, text, mark=True):
    """All segmentations of a short text, best first."""
    text = pieces.normal(text) if mark else text
    paths = [[] for _ in range(len(text) + 1)]
    paths[0] = [(0.0, ())]
    for end in range(1, len(text) + 1):
        paths[end] = [(s + score, ids + own) for start, score, own in vocabulary.arcs_to(text, end) for s, ids in paths[start]]
    return sorted(paths[-1], key=lambda p: (-p[0], p[1]))


@pytest.mark.parametrize("text", ["hello world", "aaaa b", "über  alles", "a 漢 b", "the then", " x", "x\ny", "zzz zzz"])
def test_n_best_are_the_best_of_all(vocabulary, text):
    every = brute(vocabulary, text)
    for n in (1, 2, 5, 9):
        made = vocabulary.nbest(text, n)
        assert [s for s, _ in made] == [s for s, _ in every[:n]]
        assert len({ids for _, ids in made}) == len(made)
        assert all(m in every for m in made)


@pytest.mark.parametrize("word", ["--------", "=-=-=-=", "▁▁▁▁▁▁▁", "aaaaaaaa", "▁the", "0000000", "漢漢é"])
def test_ties_within_a_word_are_settled_by_the_ids(vocabulary, word):
    every = brute(vocabulary, word, mark=False)
    for n in (1, 2, 7, 50):
        assert vocabulary.word_nbest(word, n) == every[:n]
    assert list(vocabulary._forward_all([word])) == [vocabulary._forward(word)] if vocabulary._letters_known.issuperset(word) else True


def test_words_side_by_side_equal_words_alone(vocabulary):
    rng = random.Random(4)
    words = ["".join(rng.choice("▁▁aeinst-=0é.X") for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    assert list(vocabulary._forward_all(words)) == [vocabulary._forward(w) for w in words]


def test_long_runs_of_one_sign_end_soon(vocabulary):
    for sign in "-=_*.#a0 \n":
        before = time.process_time()
        (best, ids), *others = vocabulary.nbest_bytes(sign * 100_000, 2)
        assert all(best >= second for second, _ in others) and len(others) == (sign not in "0\n")
        assert time.process_time() - before < 30  # some 50 microseconds a sign, no more for longer runs
        assert vocabulary.decode(np.frombuffer(ids, np.int32)) == sign * 100_000


def test_every_segmentation_decodes_to_the_text(vocabulary):
    for text in ["hello  world ", "", " a", "tab\tnew\nline", "漢字🙂é", "\x00"]:
        for _, ids in vocabulary.nbest(text, 4):
            assert vocabulary.decode(ids) == text
    assert vocabulary.nbest("", 3) == [(0.0, ())]


def test_a_full_cache_changes_nothing(vocabulary):
    small = pieces.Vocabulary(PATH, cached=2)
    text = "one two three four one two"
    assert small.nbest(text, 5) == vocabulary.nbest(text, 5)


def test_order_of_scores_and_ranks(spark):
    rows = pieces.encode(docs(spark, [(1, "some words"), (2, "q")]), PATH, n=4).collect()
    by_doc = {k: sorted((r.rank, r.score) for r in rows if r.doc_id == k) for k in (1, 2)}
    assert [rank for rank, _ in by_doc[1]] == [1, 2, 3, 4]
    assert all(a[1] >= b[1] for a, b in itertools.pairwise(by_doc[1]))


def test_edge_cases(spark):
    made = pieces.decode(pieces.encode(edges(spark), PATH, n=2), PATH).collect()
    texts = {k: t for k, t, *_ in EDGES}
    for r in made:
        assert r.text == texts[r.doc_id]
    assert [(r.rank, r.score) for r in made if r.doc_id == 1] == [(1, None)]
    assert [(r.rank, r.score) for r in made if r.doc_id == 2] == [(1, 0.0)]
    assert sum(r.doc_id == 6 for r in made) == 4
    assert pieces.decode(pieces.encode(empty(spark), PATH), PATH).collect() == []


def test_parts_of_a_text_equal_the_text_as_a_whole(vocabulary):
    rng = random.Random(8)
    texts = ["".join(rng.choice("  aeinst,.-=0éßçX漢\n_{") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    for text, made in zip(texts, vocabulary.nbest_all(texts, 2)):
        score, ids, lost = vocabulary._forward(pieces.normal(text))
        assert made[0] == (score, ids) and [s for s, _ in made[1:]] == [score - lost] * (lost < np.inf)
        assert made == vocabulary.nbest_bytes(text, 2)
        assert all(vocabulary.decode(np.frombuffer(own, np.int32)) == text for _, own in made)


def test_a_word_beside_other_signs_is_learned_once():
    vocabulary = pieces.Vocabulary(PATH)
    vocabulary.nbest("plain, plain. plain! plain?", 2)
    assert {part for part in vocabulary._known if "plain" in part} == {"▁plain"}


@pytest.mark.parametrize("n", range(6))
def test_the_first_of_equally_small_losses(n):
    loss = np.array([3, 1, np.inf, 1, 0, 1, 3.0])
    want = [4, 1, 3, 5, 0, 6][:n]
    assert pieces.Vocabulary._least(loss, n).tolist() == sorted(want)
    assert pieces.Vocabulary._least(loss[:0], n).tolist() == []


@pytest.mark.parametrize("text", ["a-- -- a--", "an in an", "a a a a", "the -- the", "in-- in", "=-=- =-", "zz0 zz0", "é the é"])
def test_ties_between_words_are_settled_by_the_ids(vocabulary, text):
    """of words that lose alike the first ones were taken, whatever ids their changes give."""
    every = brute(vocabulary, text)
    for n in (1, 2, 3, 6, 20):
        assert vocabulary.nbest(text, n) == every[:n]


def test_short_texts_equal_all_segmentations(vocabulary):
    rng = random.Random(1)
    signs = ["a", "the", "zz", "--", "=-", "0", "é", "in", "an", "\n", "==", "ab", " ", " "]
    for _ in range(300):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(1, 6)))
        every = brute(vocabulary, text)
        for n in (2, 3, 9):
            assert vocabulary.nbest(text, n) == every[:n]


def test_the_query_returns_what_every_text_is_cut_into(spark, tiny, vocabulary):
    """the ids themselves left no trace in the result."""
    rows = queries.op6_pieces(spark, tiny).collect()
    made = [
        (doc_id, rank, score, list(ids), zlib.crc32(text.encode()))
        for doc_id, text in queries.table(spark, tiny, "documents").select("doc_id", "text").collect()
        for rank, (score, ids) in enumerate(vocabulary.nbest(text, 2), 1)
    ]
    want = spark.createDataFrame(made, "doc_id bigint, rank int, score double, ids array<int>, text_crc32 bigint")
    want = want.selectExpr("doc_id", "rank", "score", "size(ids) as n_pieces", "xxhash64(ids) as ids_xxhash64", "text_crc32")
    assert sorted(rows) == sorted(want.collect()) and rows[0].__fields__ == want.columns
