from __future__ import annotations

import hashlib
import random

import pytest
from helpers import docs, edges, empty

from starmill.llm import fingerprints as fp

WORDS = [f"w{i}" for i in range(500)]


def text(seed, n=400):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def plain_signature(data: bytes, size: int) -> int:
    """Chunks of a signature, by the rolling hash of each window computed anew."""
    import numpy as np

    ends = 0
    for i in range(len(data)):
        window = np.frombuffer(data[max(0, i - fp.RUN + 1) : i + 1], np.uint8)
        if fp._rolling(window)[-1] % np.uint64(size) == size - 1:
            ends += 1
            last = i + 1 == len(data)
    return ends + (0 if ends and last else 1)


def test_triggers_depend_on_seven_bytes_only():
    data = text(1, 200).encode()
    one, two, _ = fp.fingerprint(data.decode()).split(":")[0], *fp.fingerprint(data.decode()).split(":")[1:]
    assert len(two) == min(fp.LETTERS, plain_signature(data, int(one)))


@pytest.mark.parametrize("seed", range(8))
def test_an_edit_changes_only_its_surroundings(seed):
    own = text(seed)
    changed = own[:700] + "an edit " + own[700:]
    assert fp.likeness(fp.fingerprint(own), fp.fingerprint(changed)) > 0.8
    assert fp.likeness(fp.fingerprint(own), fp.fingerprint(text(seed + 100))) == 0


def test_common_subsequence_against_dynamic_programming():
    rng = random.Random(2)
    for _ in range(50):
        a, b = ("".join(rng.choices("abcd", k=rng.randint(0, 20))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            row = [0] + [0] * len(b) if not row else row
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        assert fp._common(a, b) == row[-1]


def test_block_sizes():
    assert fp.likeness("6:abcdefgh:xyz", "12:abcdefgh:q") == 0
    assert fp.likeness("6:zzz:abcdefgh", "12:abcdefgh:q") == 1
    assert fp.likeness("3:abcdefgh:x", "12:abcdefgh:x") == 0
    assert fp.likeness("3::", "3::") == 1 and fp.likeness("3::", "3:a:a") == 0


def test_every_document_meets_the_next(spark):
    rows = [(3 * k, text(k, 10 + k)) for k in range(90)]
    random.Random(1).shuffle(rows)
    made = {r.doc_id: r for r in fp.with_next(docs(spark, rows).repartition(7)).collect()}
    ordered = sorted(rows)
    assert len(made) == 90
    for (key, own), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(own) // 2
        changed = own[: len(own) - half] + following[:half]
        row = made[key]
        assert row.n_chars == len(own)
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert (row.fingerprint, row.edited_fingerprint) == (fp.fingerprint(own), fp.fingerprint(changed))
        assert row.near_edited == fp.likeness(row.fingerprint, row.edited_fingerprint)
        assert row.near_next == fp.likeness(row.fingerprint, fp.fingerprint(following))


def test_edge_cases(spark):
    rows = fp.with_next(edges(spark)).collect()
    assert len(rows) == 10
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].fingerprint == by_id[2].fingerprint == "3::" and by_id[1].near_next == 1
    assert by_id[6].fingerprint == by_id[7].fingerprint and None in by_id
    assert by_id[8].n_chars == len("é ß 漢字 🙂   ́x")
    assert fp.with_next(empty(spark)).collect() == []
    assert len(fp.with_next(docs(spark, [(1, "abc")])).collect()) == 1
    assert len(fp.fingerprints(edges(spark)).collect()) == 10
