from __future__ import annotations

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import docs, edges, empty
from tokenizers import Tokenizer

from starmill.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def restored(pieces):
    """The ids of every document, in any order of documents; checks the places on the way."""
    sequences, parts = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(bytes(p.ids), "<u4")
        assert len(ids) == p.length > 0
        sequences[p.sequence_id].append((p.offset, p.length))
        parts[p.doc_id].append((p.start, p.doc_tokens, ids))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    return parts, [sum(n for _, n in places) for places in sequences.values()]


def test_every_id_is_in_exactly_one_piece(spark):
    rng = random.Random(5)
    tokenizer = Tokenizer.from_file(PATH)
    texts = [" ".join(rng.choice(["The", "tokens'll", "<|endoftext|>", "x1y2", "é ß", "\n\n", "don't"]) for _ in range(rng.randint(0, 4000))) for _ in range(60)]
    pieces = packing.pack(docs(spark, list(enumerate(texts))), PATH).collect()
    parts, lengths = restored(pieces)
    for key, text in enumerate(texts):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        at = 0
        for start, total, own in sorted(parts[key], key=lambda p: p[0]):
            assert start == at and total == len(ids)
            assert own.tolist() == ids[start : start + len(own)]
            at += len(own)
        assert at == len(ids)
    assert sum(map(packing.padding, lengths)) == 0


def test_edge_cases(spark):
    table = edges(spark)
    parts, _ = restored(packing.pack(table, PATH).collect())
    assert [p[2].tolist() for p in parts[1]] == [p[2].tolist() for p in parts[2]] == [[2]]
    assert sum(len(p[2]) for p in parts[6]) == 2 * parts[6][0][1] and None in parts
    assert sum(len(p[2]) for p in parts[5]) == parts[5][0][1]
    assert packing.pack(empty(spark), PATH).collect() == []


@pytest.mark.parametrize("seed", range(30))
def test_fill_is_the_closest_of_all_choices(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 30) for _ in range(9)]
    capacity = rng.randint(5, 90)
    best = max(sum(c) for n in range(10) for c in itertools.combinations(lengths, n) if sum(c) <= capacity)
    chosen = packing.fill(Counter(lengths), capacity)
    assert sum(n * k for n, k in chosen.items()) == best
    assert all(k <= lengths.count(n) for n, k in chosen.items())


def test_pool_keeps_its_bound_when_nothing_fits_exactly():
    made = list(packing.pack_documents(((k, bytes(4 * 2731)) for k in range(500)), pool_tokens=20_000))
    assert sum(len(p[3]) // 4 for s in made for p in s) == 500 * 2731
    sizes = [sum(len(p[3]) // 4 for p in s) for s in made]
    assert sum(map(packing.padding, sizes)) == 0


def test_padding():
    assert [packing.padding(n) for n in (4096, 2048, 1, 4095, 3)] == [0, 0, 0, 1, 4093]


def test_parts_are_encoded_together(monkeypatch):
    """One call for the new parts of a block, not one encoding of each; without end-of-word marks, one by one again."""
    texts = ["Plain words, Étés d'été x1y2 <|endoftext|> </w> a</w>b", "ŐÄ 漢字🙂 e\u0301 \x1c ª º ÷ × (a.b) plain", "", None]
    tokenizer = Tokenizer.from_file(PATH)
    want = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    encode, alone = packing.WordEncoder(PATH), []
    word_by_word = packing.WordEncoder._encode
    monkeypatch.setattr(packing.WordEncoder, "_encode", lambda self, how, some: alone.extend(some) or word_by_word(self, how, some))
    assert encode(texts) == want == encode(texts)
    assert "ŐÄ" in alone and not {"plain", "words", "été", "étés", ","} & set(alone)
    unmarked = packing.WordEncoder(PATH)
    unmarked._ends[:] = False
    assert unmarked(texts) == want


def test_no_letter_of_a_word_with_signs_is_lost():
    """As the tokenizer itself, for every letter below U+0300 beside signs, digits, letters and others; each part is learned once."""
    tokenizer = Tokenizer.from_file(PATH)
    texts = [f"{a}{chr(c)}{b}" for c in range(1, 0x300) for a, b in (("", ""), ("", "."), ("(x", "1,"), ("E", " e,é 漢, z"), ("x y'", "s ,z"))]
    encode = packing.WordEncoder(PATH)
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert [t for t, ids, made in zip(texts, want, encode(texts)) if ids != made] == []
    encode = packing.WordEncoder(PATH)
    encode(["plain, Plain! (PLAIN) plain1", "Groß. groß, GROSS"])
    assert set(encode._known) == {"plain", ",", "!", "(", ")", "1", "groß", ".", "gross"}
