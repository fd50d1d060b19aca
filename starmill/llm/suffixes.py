"""Repeated passages by sparse suffix arrays.

Of every text only the suffixes at minimisers are retained: the word positions
where a run of ``ANCHOR`` words has the least hash among the runs of some
passage of ``least`` words. The choice depends on the passage's words alone, so
wherever it stands, a passage retains the same suffix.

1. The retained suffixes of all documents are brought into the order of the hash
   of their first ``anchor`` words over the whole cluster, and neighbours are
   compared. Suffixes that begin like no other drop out; of exact copies of a
   text only the first takes part.
2. The others travel with their words, ``least`` to the right and as many to the
   left as a passage can have there. Suffixes with the same beginning (a run) meet
   in a task, are sorted by their words, and neighbours tell how far they agree to
   the right; sorted by the words before them, how far to the left.
3. A suffix is extended by all others of its run: for each length to the left, the
   order says which of them agree so far there and for the rest of ``least``
   words to the right. Its neighbour alone would not do: among near copies the one
   that agrees furthest to the right is rarely the one that agrees to the left.
   The furthest of both ends, one span for each suffix, are joined per document.

Runs of more than ``RUN`` suffixes would not fit a task. Their passages are
sorted over the cluster by 128 bits of two hashes of their words and compared with
their neighbours; of equal passages of a block one is sorted. The spans are the same.

Documents with an exact copy and at least ``least`` words are spans themselves.
The sort of step 1 splits suffixes that a third of all texts share over many tasks;
a run that touches a border is kept as a candidate, and step 2 decides.

Cases: null or empty text, or fewer than ``least`` words: no span. Null doc_id:
takes no part. A row that stands twice is a copy of itself. Different texts under
one doc_id: each has its own spans, listed under that doc_id. A passage repeated
within one document counts. Words are compared as they are, letter case and all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm import blocks
from starmill.scratch import stage

LEAST = 50  # words of a passage
ANCHOR = 25  # words by which suffixes are first compared
RUN = 2_000  # suffixes with the same beginning that one task compares: about 1 MB of text, so that no task stands out


def minimisers(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of ``width`` hashes within a text, and the place of the least (first of equals) of each."""
    n = len(hashes)
    at, span = np.arange(n), 1
    while span * 2 <= width:
        left, right = at[: len(at) - span], at[span:]
        at = np.where(hashes[left] <= hashes[right], left, right)
        span *= 2
    if span < width and len(at) > width - span:
        left, right = at[: len(at) - (width - span)], at[width - span :]
        at = np.where(hashes[left] <= hashes[right], left, right)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    starts = np.arange(max(0, n - width + 1))
    starts = starts[starts + width <= ends[: len(starts)]]
    return starts, at[starts]


def _windows(texts: pa.Array, least: int, anchor: int):
    """The words; window starts and their minimisers, as word numbers; the hashes at the minimisers."""
    words = blocks.tokens(texts)
    hashes, at = blocks.grams(words, anchor)
    starts, lowest = minimisers(hashes, blocks.per_text(words, at), least - anchor + 1)
    return words, at[starts], at[lowest], hashes[lowest]


def digest():
    return F.xxhash64("text").alias("digest")


def retained(docs: DataFrame, least: int, anchor: int) -> DataFrame:
    """(anchor, digest, doc_id, place): the retained suffixes; place is the word's number in its text."""

    def work(block: pa.RecordBatch) -> list:
        words, _, lowest, hashes = _windows(block.column("text"), least, anchor)
        places, first = np.unique(lowest, return_index=True)
        owner = np.searchsorted(words.first, places, "right") - 1
        columns = [block.column(c).to_numpy(zero_copy_only=False)[owner] for c in ("digest", "doc_id")]
        return [hashes[first].view(np.int64), *columns, (places - words.first[owner]).astype(np.int32)]

    texts = docs.filter("doc_id is not null")
    return blocks.map_texts(texts, work, "anchor bigint, digest bigint, doc_id bigint, place int", digest())


def neighbours(suffixes: DataFrame) -> DataFrame:
    """(anchor, digest, doc_id, place) of suffixes that begin like the one before or after them in the sorted order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copy = None  # anchor, digest and doc_id of the first of a text's copies
        held = None  # the last suffix so far, and whether it is a candidate
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, digest, doc, place = (c.to_numpy() for c in batch.columns)
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (digest[1:] != digest[:-1])
            same = copy is not None and copy[:2] == (anchor[0], digest[0])
            new[0] = not same
            group = np.cumsum(new) - 1
            owners = doc[new]
            own = np.where(group >= 0, owners[group] if len(owners) else 0, copy[2] if same else 0)
            copy = (anchor[-1], digest[-1], own[-1])
            keep = doc == own
            anchor, digest, doc, place = anchor[keep], digest[keep], doc[keep], place[keep]
            if not len(anchor):
                continue
            equal = np.zeros(len(anchor) + 1, bool)  # to the one before
            equal[1:-1] = anchor[1:] == anchor[:-1]
            equal[0] = held is None or held[0] == anchor[0]  # before the first of all nothing is known
            found = equal[:-1] | equal[1:]
            if held is not None and (held[4] or equal[0]):
                yield _rows(*([x] for x in held[:4]))
            yield _rows(*(x[:-1][found[:-1]] for x in (anchor, digest, doc, place)))
            held = (anchor[-1], digest[-1], doc[-1], place[-1], found[-1])
        if held is not None:  # nor after the last
            yield _rows(*([x] for x in held[:4]))

    order = ["anchor", "digest", "doc_id", "place"]
    return suffixes.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, "anchor bigint, digest bigint, doc_id bigint, place int")


def _rows(anchors, digests, docs, places) -> pa.RecordBatch:
    names = ["anchor", "digest", "doc_id", "place"]
    return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (anchors, digests, docs)), pa.array(places, pa.int32())], names)


def _numbers(block: pa.RecordBatch, words: blocks.Tokens) -> np.ndarray:
    """The ``places`` of every text, as word numbers."""
    places = block.column("places")
    counts = pa.compute.list_value_length(places).to_numpy(zero_copy_only=False)
    return places.flatten().to_numpy(zero_copy_only=False) + np.repeat(words.first[:-1], counts)


def _points(words: blocks.Tokens) -> np.ndarray:
    """How many code points stand before each byte."""
    return np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])


def contexts(texts: DataFrame, least: int, anchor: int) -> DataFrame:
    """(anchor, doc_id, digest, lead, origin, context) of the suffixes at ``places``.

    The context is the text from ``lead`` words before the suffix to its last
    word that a passage can hold; it begins at code point ``origin``.
    """

    def work(block: pa.RecordBatch) -> list:
        words = blocks.tokens(block.column("text"))
        hashes, at = blocks.grams(words, anchor)
        numbers = _numbers(block, words)
        owner = np.searchsorted(words.first, numbers, "right") - 1
        left = np.maximum(words.first[owner], numbers - (least - anchor))
        right = np.minimum(words.first[owner + 1], numbers + least)
        raw = words.data.tobytes()
        slices = [raw[a:b] for a, b in zip(words.starts[left].tolist(), words.ends[right - 1].tolist())]
        points = _points(words)
        columns = [block.column(c).to_numpy(zero_copy_only=False)[owner] for c in ("doc_id", "digest")]
        return [
            hashes[np.searchsorted(at, numbers)].view(np.int64), *columns, (numbers - left).astype(np.int32),
            points[words.starts[left]] - points[words.texts[owner]], pa.array(slices, pa.binary()).cast(pa.string()),
        ]

    schema = "anchor bigint, doc_id bigint, digest bigint, lead int, origin bigint, context string"
    return blocks.map_texts(texts, work, schema, "digest", "places")


def _word_numbers(words: blocks.Tokens) -> np.ndarray:
    """A number from 1 for every word, equal for equal words and in the order of their bytes."""
    sizes = words.ends - words.starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    letters = words.data[np.repeat(words.starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = parts.dictionary_encode()
    rank = np.empty(len(coded.dictionary), np.int32)
    rank[pa.compute.array_sort_indices(coded.dictionary).to_numpy()] = np.arange(1, len(rank) + 1)
    return rank[coded.indices.to_numpy()]


def _sorted(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of word numbers, and how many words each has in common with the one before it there."""
    keys = np.ascontiguousarray(rows.astype(">i4")).view(f"S{4 * rows.shape[1]}").ravel()
    order = np.argsort(keys, kind="stable")
    common = np.zeros(len(rows), np.int32)
    same = rows[order[1:]] == rows[order[:-1]]
    common[1:] = np.where(same.all(axis=1), rows.shape[1], same.argmin(axis=1))
    return order, common


def extend(texts: pa.Array, lead: np.ndarray, least: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which suffixes stand in a passage that another one has too, and that span's ends in code points of the context.

    ``texts`` are contexts of whole runs; every passage holds the suffix's first ``anchor`` words.
    """
    words = blocks.tokens(texts)
    numbers = np.append(_word_numbers(words), np.int32(0))
    place = words.first[:-1] + lead
    after = words.first[1:] - place  # words to the right, the suffix's own first one included

    def around(steps: np.ndarray, inside: np.ndarray) -> np.ndarray:
        return numbers[np.where(inside, place[:, None] + steps, len(numbers) - 1)]

    reach = least - anchor
    forth, back = np.arange(least), np.arange(1, reach + 1)
    n = len(place)
    order, common = _sorted(around(forth, forth < after[:, None]))
    order_back, common_back = _sorted(around(-back, back <= lead[:, None])) if reach else (np.arange(n), np.zeros(n, np.int32))
    furthest, nearest = np.full(n, -1), np.full(n, reach + 1)
    right, left = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(reach + 1):  # words of the passage before the suffix
        right[order] = np.cumsum(common < least - d)
        left[order_back] = np.cumsum(common_back < d)
        valid = np.flatnonzero((lead >= d) & (after >= least - d))
        _, which, counts = np.unique(right[valid] * (n + 1) + left[valid], return_inverse=True, return_counts=True)
        met = valid[counts[which] > 1]
        furthest[met] = d
        nearest[met] = np.minimum(nearest[met], d)
    found = np.flatnonzero(furthest >= 0)
    points = _points(words)
    origin = points[words.texts[found]]
    starts = points[words.starts[place[found] - furthest[found]]] - origin
    ends = points[words.ends[place[found] + least - nearest[found] - 1]] - origin
    return found, starts, ends


def runs(suffixes: DataFrame, least: int, anchor: int) -> DataFrame:
    """(doc_id, digest, start, end): the spans by which the suffixes of each run are extended."""

    def spans(table: pa.Table) -> pa.RecordBatch:
        lead, origin, doc, digest = (table.column(c).to_numpy() for c in ("lead", "origin", "doc_id", "digest"))
        found, starts, ends = extend(table.column("context").combine_chunks(), lead.astype(np.int64), least, anchor)
        columns = [doc[found], digest[found], origin[found] + starts, origin[found] + ends]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["doc_id", "digest", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the run that may go on
        for batch in batches:
            for block in blocks.blocks(iter([batch]), 4 * blocks.BLOCK_BYTES, "context"):
                anchors = block.column("anchor").to_numpy()
                last = int(np.searchsorted(anchors, anchors[-1]))
                if last or held and held[-1].column("anchor")[0].as_py() != anchors[0]:
                    done = [*held, block.slice(0, last)]
                    yield spans(pa.Table.from_batches(done))
                    held = []
                held.append(block.slice(last))
        if held:
            yield spans(pa.Table.from_batches(held))
        pa.default_memory_pool().release_unused()  # the worker goes on with other tasks

    return suffixes.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "doc_id bigint, digest bigint, start bigint, end bigint")


def _combined(passage: np.ndarray, check: np.ndarray, owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first of every passage's rows, and where the joined spans of those that stand twice begin and end; rows are in the order of the texts."""
    order = np.lexsort((check, passage))
    new = np.ones(len(order), bool)
    new[1:] = (passage[order[1:]] != passage[order[:-1]]) | (check[order[1:]] != check[order[:-1]])
    counts = np.diff(np.append(np.flatnonzero(new), len(order)))
    met = np.empty(len(order), bool)
    met[order] = np.repeat(counts > 1, counts)
    at = np.flatnonzero(met)
    opens = np.ones(len(at), bool)
    opens[1:] = (owner[at[1:]] != owner[at[:-1]]) | (start[at[1:]] > end[at[:-1]])
    closes = np.append(opens[1:], True)[: len(at)]
    return np.sort(order[new]), at[opens], at[closes]


def passages(texts: DataFrame, least: int, anchor: int, combine: bool = False) -> DataFrame:
    """(passage, check, doc_id, digest, start, end) around the suffixes at ``places`` of every text, in code points.

    With ``combine`` only the first of a block's equal passages has a row. What stands twice in the block is found
    by that, whatever the others hold: its joined spans are rows without a passage.
    """

    def work(block: pa.RecordBatch) -> list:
        words, starts, lowest, _ = _windows(block.column("text"), least, anchor)
        wanted = np.zeros(len(words.hashes) + 1, bool)
        wanted[_numbers(block, words)] = True
        starts = starts[wanted[lowest]]
        hashes, at = blocks.grams(words, least)
        checks, _ = blocks.grams(words._replace(hashes=blocks.mix(words.hashes + np.uint64(1))), least)
        points = _points(words)
        owner = np.searchsorted(words.first, starts, "right") - 1
        origin = points[words.texts[owner]]
        row = np.searchsorted(at, starts)
        passage, check = hashes[row].view(np.int64), checks[row].view(np.int64)
        columns = [block.column(c).to_numpy(zero_copy_only=False)[owner] for c in ("doc_id", "digest")]
        start, end = points[words.starts[starts]] - origin, points[words.ends[starts + least - 1]] - origin
        if not combine:
            return [passage, check, *columns, start, end]
        first, opens, closes = _combined(passage, check, owner, start, end)
        begin, without = np.append(first, opens), np.repeat([False, True], [len(first), len(opens)])
        named = [pa.array(x[begin], mask=without) for x in (passage, check)]
        return [*named, *(x[begin] for x in (*columns, start)), end[np.append(first, closes)]]

    schema = "passage bigint, check bigint, doc_id bigint, digest bigint, start bigint, end bigint"
    return blocks.map_texts(texts, work, schema, "digest", "places")


def twice(found: DataFrame) -> DataFrame:
    """(doc_id, digest, start, end) of the passages that stand twice or more, and of the spans without a passage.

    As the suffixes, they are sorted over the whole cluster and compared with their neighbours, so a passage that many
    texts share is split over many tasks. What stands at a border of a task has its other neighbour
    behind it: these rows, two of a task at most, are compared with one another.
    """
    names = found.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(columns: list, met: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
            keep = met | edge
            return pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (*columns, met, edge)], [*names, "met", "edge"])

        held = None  # the last row so far, whether it is met and whether it is the first of all
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy() for c in batch.columns]
            met, edge = np.zeros(batch.num_rows, bool), np.zeros(batch.num_rows, bool)
            if held is None:
                edge[0] = True
            else:
                *columns, met, edge = (np.concatenate(pair) for pair in zip(held, (*columns, met, edge)))
            same = (columns[0][1:] == columns[0][:-1]) & (columns[1][1:] == columns[1][:-1])
            met[1:] |= same
            met[:-1] |= same
            yield rows([c[:-1] for c in columns], met[:-1], edge[:-1])
            held = [c[-1:] for c in (*columns, met, edge)]
        if held is not None:
            yield rows(held[:-2], held[-2], np.ones(1, bool))

    order = ["passage", "check", "doc_id", "digest", "start"]
    found = stage(found, "passages")
    dealt = found.filter("passage is not null").repartitionByRange(*order).sortWithinPartitions(*order)
    schema = ", ".join(f"{name} bigint" for name in names)
    compared = stage(dealt.mapInArrow(run, f"{schema}, met boolean, edge boolean"), "compared")
    key = order[:2]
    many = compared.filter("edge").groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").select(*key)
    settled = compared.filter("edge and not met").join(F.broadcast(many), key, "left_semi").select(*names)
    every = compared.filter("met").select(*names).unionByName(settled).unionByName(found.filter("passage is null"))
    return every.select("doc_id", "digest", "start", "end")


def _copies(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, exact, n_chars, n_words); exact is a hash of 128 bits."""

    def work(block: pa.RecordBatch) -> list:
        texts = block.column("text")
        words = blocks.tokens(texts)
        digests = [hashlib.blake2b((t or "").encode(), digest_size=16).digest() for t in texts.to_pylist()]
        return [block.column("doc_id"), block.column("digest"), pa.array(digests, pa.binary()), pa.compute.utf8_length(texts).cast(pa.int64()), np.diff(words.first)]

    return blocks.map_texts(docs.filter("doc_id is not null"), work, "doc_id bigint, digest bigint, exact binary, n_chars bigint, n_words bigint", digest())


def repeated_spans(
    docs: DataFrame, least: int = LEAST, anchor: int = ANCHOR, doc_id: str = "doc_id", text: str = "text", run: int = RUN
) -> DataFrame:
    """(doc_id, start, end, whole): the passages of ``least`` words or more that stand elsewhere too, in code points."""
    read = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sizes = stage(_copies(read), "copies")
    classes = sizes.groupBy("exact").agg(F.min("doc_id").alias("first_id"), F.min("digest").alias("digest"), F.count("*").alias("copies"))
    many = classes.filter("copies > 1").select("exact")
    whole = sizes.filter(F.col("n_words") >= least).join(many, "exact", "left_semi").select("doc_id", "digest", "n_chars").distinct()

    met = stage(neighbours(retained(read, least, anchor)), "met")
    large = stage(met.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > run).select("anchor"), "large")
    few = large.isEmpty()
    key = ["doc_id", "digest"]
    # of copies that the sort has dealt to two tasks the first is kept here
    firsts = classes.select(F.col("first_id").alias("doc_id"), "digest")
    marked = read.withColumn("digest", digest())

    places = F.collect_set("place").alias("places")
    if few:
        listed = met.groupBy(*key).agg(places).join(firsts, key, "left_semi")
    else:  # a text's suffixes are told apart and listed at once, those of large runs in a list of their own
        told = met.join(large.withColumn("crowded", F.lit(True)), "anchor", "left")
        place = lambda crowded: F.collect_set(F.when(F.col("crowded").isNotNull() == crowded, F.col("place")))
        told = told.groupBy(*key).agg(place(False).alias("places"), place(True).alias("crowded"))
        listed = stage(told.join(firsts, key, "left_semi"), "listed")

    def at(lists: DataFrame) -> DataFrame:
        return marked.join(lists.hint("merge"), key)  # the lists grow with the texts, so they are never broadcast

    some = listed if few else listed.filter(F.size("places") > 0).drop("crowded")
    found = runs(contexts(at(some), least, anchor), least, anchor)
    if not few:
        crowded = listed.filter(F.size("crowded") > 0).select(*key, F.col("crowded").alias("places"))
        found = found.unionByName(twice(passages(at(crowded), least, anchor, combine=True)))
    alone = found.join(whole, ["doc_id", "digest"], "left_anti")

    by_start = Window.partitionBy("doc_id", "digest").orderBy("start")
    before = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = (before.isNull() | (F.col("start") > before)).cast("int")
    merged = (
        alone.withColumn("opens", opens).withColumn("span", F.sum("opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc_id", "digest", "span").agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select("doc_id", "start", "end", F.lit(False).alias("whole"))
    )
    return merged.unionByName(whole.select("doc_id", F.lit(0).cast("bigint").alias("start"), F.col("n_chars").alias("end"), F.lit(True).alias("whole")))
