"""Ranked lexical search over K2-treaps of term-document grids.

A task cuts its documents into shards. In a shard's grid the rows are the terms
asked for, the columns its documents by rising doc_id, and a point holds the
impact of a term in a document. The grid is kept as a compressed quadtree: a
cell that holds points has four bits that tell which quarters do, its quarters
follow one another in the list of cells, and of each cell's largest impact the
distance from its parent's is stored.

An item's terms are paths that descend together. A state is a range of
documents with the cell of every term's path there; its bound is the sum of the
terms' weights times the cells' largest impacts. Best bounds first, a range
is halved, a path goes on in the quarter of its row, and ends where the quarter is
empty. Ranges of one document have their exact score as the bound. The search ends
when no range could still enter the first ``k``; equal bounds
go by document, so the result is exact.

Score: terms are runs of digits, letters and non-ASCII characters, A-Z in lower
case. N documents have a term; L counts all terms, n those of a document, df the
documents with a term, tf its occurrences in one. A term weighs
``w = floor(1000 ln((2N+2) / (2df+1)))``; with ``m = 50 + (50 n N) div L`` a
document scores the sum of ``w (10^9 tf div (1000 tf + 20 m))`` over an item's
distinct terms.

Items reach the tasks in parts of bounded size, each with a pass for the counts and one
for the search. A task sends ``k`` rows per item and shard; they are cut to
``k`` per item within each task before the shuffle. Terms are compared by 64-bit hashes.

Cases: null or wordless documents: count nowhere, are never found. Null or wordless
items: no rows. Fewer than ``k`` documents with a score above 0: all there are. Repeated
rows of documents are documents of their own, those of items are ranked each. Null doc_id:
ranked like any, before all others of its score. Null item_id: returned as null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm import blocks, lookup

K = 50
SHARD_DOCS = 1 << 14
SHARD_POINTS = 4 << 20
AT_ONCE = 64  # ranges that are halved together

_COUNT = np.array([bin(x).count("1") for x in range(16)], np.int64)


class Postings:
    """(document, term, tf) of blocks of texts, as arrays."""

    def __init__(self, table: blocks.Places, terms: int):
        self._table, self._terms = table, terms

    def read(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The number of terms of each text, and the points (text, term, tf) of terms asked for."""
        column = texts
        if len(texts) == 1 and texts[0].is_valid and len(texts[0].as_buffer()) > 2 * blocks.BLOCK_BYTES:
            column = pa.array(list(blocks.cut(texts[0].as_buffer().to_pybytes(), blocks.BLOCK_BYTES, lookup.TERMS)), pa.large_binary())
        counts, keys = [], []
        for k in range(0, len(column), 1 if column is not texts else max(1, len(column))):
            found = blocks.tokens(column if column is texts else column.slice(k, 1), lookup.TERMS, blocks.LOWER)
            own = np.diff(found.first)
            term = self._table.find(found.hashes).astype(np.int64)
            doc = np.repeat(np.arange(len(own)), own)
            asked = term >= 0
            counts.append(own)
            keys.append(doc[asked] * self._terms + term[asked])
        n = counts[0] if column is texts else np.array([sum(int(c.sum()) for c in counts)])
        key, tf = np.unique(np.concatenate(keys), return_counts=True)
        doc, term = np.divmod(key, max(1, self._terms))
        return n, doc, term, tf


class Treap:
    """The quadtree of points (row, column, value), values above 0."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray):
        self.depth = max(1, int(max(rows.max(initial=0), columns.max(initial=0))).bit_length())
        code = np.zeros(len(rows), np.int64)
        for bit in range(self.depth):
            code |= (rows >> bit & 1) << (2 * bit + 1) | (columns >> bit & 1) << (2 * bit)
        order = np.argsort(code)
        code, most = code[order], values[order].astype(np.int64)
        masks, levels = [], [most]
        while len(masks) < self.depth and len(code):
            parent = code >> 2
            first = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
            masks.append(np.bitwise_or.reduceat(np.uint8(1) << (code & 3).astype(np.uint8), first))
            most = np.maximum.reduceat(most, first)
            code = parent[first]
            levels.append(most)
        levels.reverse()
        self.masks = np.concatenate(masks[::-1]) if masks else np.zeros(0, np.uint8)
        # the quarters of the cells follow in the order of their cells, the root's from place 1
        quarters = _COUNT[self.masks]
        self._first = 1 + np.cumsum(quarters) - quarters
        below = [levels[0][:0]]
        for upper, lower, mask in zip(levels, levels[1:], masks[::-1]):
            below.append(np.repeat(upper, _COUNT[mask]) - lower)
        self.root = int(levels[0][0]) if len(levels[0]) else 0
        self.less = np.concatenate([np.zeros(1, np.int64), *below]).astype(np.uint32)

    def top(self, rows: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The ``k`` best (score, column) for a weighted set of rows, scores above 0, best first, then by column."""
        if not len(self.masks) or not len(rows):
            return []
        # ranges that are open, and their paths side by side: term, cell, largest impact
        start, level = np.zeros(1, np.int64), np.zeros(1, np.int64)
        bound = np.array([int(weights.sum()) * self.root], np.int64)
        owner, term = np.zeros(len(rows), np.int64), np.arange(len(rows))
        cell, most = np.zeros(len(rows), np.int64), np.full(len(rows), self.root, np.int64)
        best_score, best_column = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while True:
            if len(best_score) == k:
                open_ = (bound > best_score[-1]) | (bound == best_score[-1]) & (start < best_column[-1])
            else:
                open_ = bound > 0
            if not open_.any():
                return list(zip(best_score.tolist(), best_column.tolist()))
            order = np.flatnonzero(open_)
            if len(order) > AT_ONCE:
                order = order[np.lexsort((start[order], -bound[order]))]
            now, later = order[:AT_ONCE], order[AT_ONCE:]
            place = np.full(len(bound), -1, np.int64)
            place[now] = np.arange(len(now))
            mine = place[owner] >= 0
            o, t, c, m = place[owner[mine]], term[mine], cell[mine], most[mine]
            here, depth = start[now], level[now]
            shift = self.depth - 1 - depth[o]
            side = (rows[t] >> shift & 1) * 2
            mask, first = self.masks[c], self._first[c]
            made = []
            for half in (0, 1):
                quarter = side + half
                there = mask >> quarter.astype(np.uint8) & 1 > 0
                child = first[there] + _COUNT[mask[there] & ((1 << quarter[there]) - 1)]
                made.append((o[there] * 2 + half, t[there], child, m[there] - self.less[child]))
            o, t, c, m = (np.concatenate(x) for x in zip(*made))
            size = 2 * len(now)
            sums = np.zeros(size, np.int64)
            np.add.at(sums, o, weights[t] * m)
            starts = np.repeat(here, 2)
            starts[1::2] += 1 << (self.depth - 1 - depth)
            levels = np.repeat(depth + 1, 2)
            done = (levels == self.depth) & (sums > 0)
            if done.any():
                score, column = np.concatenate([best_score, sums[done]]), np.concatenate([best_column, starts[done]])
                turn = np.lexsort((column, -score))[:k]
                best_score, best_column = score[turn], column[turn]
            on = (levels < self.depth) & (sums > 0)
            # what stays open: ranges not halved now, and halves that go on
            place[:] = -1
            place[later] = np.arange(len(later))
            old = place[owner] >= 0
            fresh = np.full(size, -1, np.int64)
            fresh[on] = len(later) + np.arange(on.sum())
            new = fresh[o] >= 0
            owner = np.concatenate([place[owner[old]], fresh[o[new]]])
            term, cell, most = np.concatenate([term[old], t[new]]), np.concatenate([cell[old], c[new]]), np.concatenate([most[old], m[new]])
            start, level = np.concatenate([start[later], starts[on]]), np.concatenate([level[later], levels[on]])
            bound = np.concatenate([bound[later], sums[on]])


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """What one occurrence pattern is worth, whatever the term: an integer below 10^6."""
    if 50 * int(n.max(initial=0)) * docs < 1 << 63:
        m = 50 + 50 * n * docs // total
    else:
        m = np.array([50 + 50 * int(x) * docs // total for x in n], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def _counts(texts: DataFrame, shared, terms: int) -> tuple[int, int, np.ndarray]:
    """N, L and every term's df; a task sends one row per term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        postings = Postings(blocks.Places(shared.value), terms)
        df = np.zeros(terms + 2, np.int64)
        for block in blocks.blocks(batches):
            n, _, term, _ = postings.read(block.column("text"))
            df[:terms] += np.bincount(term, minlength=terms)
            df[terms:] += [(n > 0).sum(), n.sum()]
        there = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(df[there])], ["term", "n"])

    rows = texts.select("text").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(terms + 2, np.int64)
    for row in rows:
        df[row.term] = row.n
    return int(df[terms]), int(df[terms + 1]), df[:terms]


def _found(texts: DataFrame, shared, queries, counts, k: int) -> DataFrame:
    """(item, doc_id, score): the ``k`` best of every shard for every item."""
    docs, total, terms = counts

    def shard(ids: np.ndarray, null: np.ndarray, held: list) -> pa.RecordBatch | None:
        of_items, weights = queries.value
        turn = np.lexsort((ids, ~null))  # nulls first
        column = np.empty(len(ids), np.int64)
        column[turn] = np.arange(len(ids))
        doc, term, value = (np.concatenate(x) for x in zip(*held))
        value = value.astype(np.int64)
        # terms that carry no weight, and items' terms in the order of their frequency, have neighbours alike
        useful = weights[term] > 0
        rows, at = np.unique(term[useful], return_inverse=True)
        frequent = np.argsort(-np.bincount(at, minlength=len(rows)), kind="stable")
        row_of = np.full(terms, -1, np.int64)
        row_of[rows[frequent]] = np.arange(len(rows))
        treap = Treap(row_of[term[useful]], column[doc[useful]], value[useful])
        out = []
        for item, own in enumerate(of_items):
            own = own[row_of[own] >= 0]
            out += [(item, c, s) for s, c in treap.top(row_of[own], weights[own], k)]
        if not out:
            return None
        items, columns, scores = (np.array(x, np.int64) for x in zip(*out))
        at = turn[columns]
        names = pa.array(ids[at], mask=null[at])
        return pa.RecordBatch.from_arrays([pa.array(items), names, pa.array(scores)], ["item", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        postings = Postings(blocks.Places(shared.value), terms)
        ids, nulls, held, size, points = [], [], [], 0, 0

        def flush():
            if points and (made := shard(np.concatenate(ids), np.concatenate(nulls), held)) is not None:
                yield made

        for block in blocks.blocks(batches):
            n, doc, term, tf = postings.read(block.column("text"))
            held.append((doc + size, term, impacts(tf, n[doc], docs, total)))
            column = block.column("doc_id")
            nulls.append(column.is_null().to_numpy(zero_copy_only=False))
            ids.append(column.fill_null(0).to_numpy())
            size, points = size + len(n), points + len(doc)
            if size >= SHARD_DOCS or points >= SHARD_POINTS:
                yield from flush()
                ids, nulls, held, size, points = [], [], [], 0, 0
        yield from flush()

    return texts.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def search(
    docs: DataFrame, items: DataFrame, k: int = K, limit: int = lookup.PART_BYTES,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): for every item its ``k`` best documents, best first."""
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).filter("text is not null")
    kind = items.select(F.col(item_id).alias("item_id")).schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, rank int, doc_id bigint, score bigint"
    ranked = [spark.createDataFrame([], schema)]
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    for part in lookup.parts(items, item_id, item_text, limit):
        hashes = [np.unique(lookup.term_hashes(row.text)) for row in part]
        terms = np.unique(np.concatenate(hashes))
        if not len(terms):
            continue
        shared = spark.sparkContext.broadcast(terms)  # of bounded size, as all that follows
        n, total, df = _counts(texts, shared, len(terms))
        if not n:
            continue
        weights = np.array([weight(n, int(x)) for x in df], np.int64)
        queries = spark.sparkContext.broadcast(([np.searchsorted(terms, h) for h in hashes], weights))
        found = _found(texts, shared, queries, (n, total, len(terms)), k)
        top = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(number, row.item_id) for number, row in enumerate(part)], f"item bigint, item_id {kind}")
        ranked.append(top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    result = ranked[0]
    for more in ranked[1:]:
        result = more if result is ranked[0] else result.unionByName(more)
    return result
