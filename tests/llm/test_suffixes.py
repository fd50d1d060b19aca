from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from helpers import docs, edges, empty
from pyspark.sql import functions as F

from starmill.llm import suffixes


def brute(rows, least):
    """All spans covered by windows of ``least`` words that occur twice or more."""
    split = [(k, t, [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\x20\x09-\x0D]+", t or "")]) for k, t in rows]
    seen = Counter(tuple(w[2] for w in words[s : s + least]) for _, _, words in split for s in range(len(words) - least + 1))
    copies = Counter(t for _, t in rows)
    spans, parts = set(), []
    for key, text, words in split:
        if copies[text] > 1 and len(words) >= least:
            spans.add((key, 0, len(text), True))
            continue
        now = None
        for s in range(len(words) - least + 1):
            if seen[tuple(w[2] for w in words[s : s + least])] > 1:
                start, end = words[s][0], words[s + least - 1][1]
                if now and start <= now[1]:
                    now[1] = end
                else:
                    now = [start, end]
                    parts.append((key, now))
    return spans | {(k, s, e, False) for k, (s, e) in parts}


def found(df):
    return {tuple(r) for r in df.collect()}


def test_same_spans_as_all_windows(spark):
    rng = random.Random(9)
    vocabulary = [f"é{i}" for i in range(60)]
    passage = rng.choices(vocabulary, k=40)
    rows = []
    for k in range(120):
        words = rng.choices(vocabulary, k=rng.randint(0, 80))
        if k % 3 == 0:  # near copies of a passage, with edits to both sides of every place
            own = list(passage)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(40)] = rng.choice(vocabulary)
            at = rng.randint(0, len(words))
            words[at:at] = own
        rows.append((k, rng.choice([" ", "\n", "  "]).join(words)))
    rows += [(200, rows[5][1]), (201, rows[6][1]), (202, " ".join(passage * 2))]
    want = brute(rows, 12)
    assert len(want) > 30
    assert found(suffixes.repeated_spans(docs(spark, rows).repartition(5), least=12, anchor=6)) == want
    # runs that do not fit a task: some of them, and all
    assert found(suffixes.repeated_spans(docs(spark, rows).repartition(5), least=12, anchor=6, run=30)) == want
    assert found(suffixes.repeated_spans(docs(spark, rows).repartition(5), least=12, anchor=6, run=0)) == want


def test_extension_is_that_of_all_pairs():
    rng = random.Random(5)
    texts, lead, split = [], [], []
    for k in range(200):  # all around the same four words, few words beside them
        left, right = rng.choices(["é", "bb"], k=rng.randint(0, 6)), rng.choices(["a", "ab"], k=rng.randint(0, 6))
        words = left + ["x", "y", "x", "z" if k % 9 else "v"] + right
        split.append((left[::-1], words[len(left) :]))
        texts.append(rng.choice([" ", " \t"]).join(words))
        lead.append(len(left))

    def common(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    want = {}
    for i, (left, right) in enumerate(split):
        reach = [(common(left, other[0]), common(right, other[1])) for j, other in enumerate(split) if j != i]
        if met := [d for d in range(7) if any(b >= d and f >= 10 - d for b, f in reach)]:
            at = [m.span() for m in re.finditer(r"\S+", texts[i])]
            want[i] = (at[lead[i] - max(met)][0], at[lead[i] + 10 - min(met) - 1][1])
    rows, starts, ends = suffixes.extend(pa.array(texts), np.array(lead), 10, 4)
    assert dict(zip(rows.tolist(), zip(starts.tolist(), ends.tolist()))) == want
    assert 20 < len(want) < 200


def test_two_texts_under_one_name(spark):
    passage = [f"p{i}" for i in range(60)]
    a, b = " ".join(["one"] + passage), " ".join(["some", "more"] + passage[:50])
    assert found(suffixes.repeated_spans(docs(spark, [(1, a), (1, b)]))) == {
        (1, 4, len("one " + " ".join(passage[:50])), False), (1, 10, len(b), False)
    }
    copied = found(suffixes.repeated_spans(docs(spark, [(1, a), (1, b), (2, a)])))
    assert copied == {(1, 0, len(a), True), (2, 0, len(a), True), (1, 10, len(b), False)}


def test_least_of_every_window():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 9, 200).astype(np.uint64)
    bounds = np.array([0, 3, 3, 90, 200])
    for width in (1, 2, 7, 26, 120):
        starts, at = suffixes.minimisers(hashes, bounds, width)
        want = [s for a, b in zip(bounds, bounds[1:]) for s in range(a, b - width + 1)]
        assert starts.tolist() == want
        assert at.tolist() == [s + int(np.argmin(hashes[s : s + width])) for s in want]


def test_a_neighbour_in_another_partition_is_met(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(k, f"only{k} " + passage + f" end{k}") for k in range(300)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        made = found(suffixes.repeated_spans(docs(spark, rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert made == {(k, len(f"only{k} "), len(f"only{k} " + passage), False) for k, _ in rows}


def test_edge_cases(spark):
    assert found(suffixes.repeated_spans(edges(spark))) == set()
    short = found(suffixes.repeated_spans(edges(spark), least=8, anchor=4))
    assert short == {(6, 0, 50, True), (7, 0, 50, True)}
    assert found(suffixes.repeated_spans(empty(spark))) == set()


def test_passages_that_stand_twice_are_found_without_a_join(spark):
    """Sorted and compared with their neighbours, also across borders; a passage in most rows is split over tasks."""
    rng = random.Random(3)
    rows = [(rng.choice([7, 7, 7, rng.randrange(2000)]), rng.choice([1, 1, 1, 2]), k % 900, k % 3, k, k + 9) for k in range(3000)]
    rows += [(-1, 5, 0, 0, 1, 2), (1 << 62, 5, 0, 0, 1, 2)]
    count = Counter(r[:2] for r in rows)
    table = spark.createDataFrame(rows, "passage bigint, check bigint, doc_id bigint, digest bigint, start bigint, end bigint")
    names = ("shuffle.partitions", "adaptive.coalescePartitions.enabled", "autoBroadcastJoinThreshold")
    old = {f"spark.sql.{name}": spark.conf.get(f"spark.sql.{name}") for name in names}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for tasks in ("1", "7", "300"):
            spark.conf.set("spark.sql.shuffle.partitions", tasks)
            made = suffixes.twice(table)
            assert sorted(map(tuple, made.collect())) == sorted(r[2:] for r in rows if count[r[:2]] > 1)
            assert "SortMergeJoin" not in made._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    assert suffixes.twice(table.limit(0)).collect() == []


def test_passages_of_near_copies_grow_with_the_copies_alone(spark):
    """Not with the pairs of a group: twice the near copies, twice the rows."""
    passage = " ".join(f"p{i}" for i in range(60))

    def rows(n):
        found = suffixes.passages(places(docs(spark, [(k, f"only{k} {passage} end{k}") for k in range(n)])), 50, 25)
        return suffixes.twice(found).count()

    def places(table):
        read = table.select("doc_id", "text", suffixes.digest())
        met = suffixes.retained(read, 50, 25).groupBy("doc_id", "digest")
        return read.join(met.agg(F.collect_set("place").alias("places")), ["doc_id", "digest"])

    assert 0 < 2 * rows(200) == rows(400)


def test_equal_passages_of_a_block_are_combined(spark):
    """Four times the near copies of a passage in as many blocks: no more passages are sorted but those of the edits, and the same spans are found."""
    passage = [f"p{i}" for i in range(120)]

    def texts(n):
        rows = [(k, " ".join([f"only{k}", *passage[: 50 + k % 3], *([f"edit{k}"] if k % 3 else []), *passage[50 + k % 3 :]])) for k in range(n)]
        read = docs(spark, rows).select("doc_id", "text", suffixes.digest())
        met = suffixes.retained(read, 50, 25).groupBy("doc_id", "digest")
        return read.join(met.agg(F.collect_set("place").alias("places")), ["doc_id", "digest"]).repartition(2, "doc_id").cache()

    def joined(found):
        spans = {}
        for doc, _, start, end in sorted(map(tuple, found.collect())):
            own = spans.setdefault(doc, [])
            if own and start <= own[-1][1]:
                own[-1][1] = max(own[-1][1], end)
            else:
                own.append([start, end])
        return spans

    made = {}
    for n in (100, 400):
        table = texts(n)
        combined = suffixes.passages(table, 50, 25, combine=True).cache()
        every = suffixes.passages(table, 50, 25)
        made[n] = every.count(), combined.filter("passage is not null").groupBy("passage", "check").count().filter("count > 1").agg(F.max("count")).first()[0]
        assert combined.count() < every.count()
        assert joined(suffixes.twice(combined)) == joined(suffixes.twice(every)) != {}
    assert made[400][0] > 3.9 * made[100][0] and made[400][1] == made[100][1] == 2  # one row of a block
