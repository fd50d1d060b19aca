"""Benchmark decontamination with an FM-index for every shard of the training texts.

The phrases are all windows of ``size`` consecutive words of the benchmark
items; an item of fewer words, but not none, is one phrase. A task cuts its
texts into shards of bounded size and indexes each:

1. Words that no phrase has can't be part of an occurrence. They end a run;
   runs shorter than the shortest phrase are left out, all others are the
   shard's text, each closed by an end mark.
2. The suffixes of that text are sorted (doubling the compared length until
   nothing is tied), which gives its Burrows-Wheeler transform, kept as a wavelet
   tree: one bit vector per bit of a symbol, with counts for rank.
3. Backward search takes all phrases through the ranks at once, a word per
   step, and drops those whose range has become empty.
4. An occurrence goes back through the transform until it meets a sampled suffix,
   whose position is stored; every ``RATE``-th position and every beginning of a run is.
5. Occurrences are merged to removal spans: a word inside any occurrence is hit.

Phrases reach the tasks in parts of bounded size; each further part is one more
pass, and its spans are merged with those found before. Nothing is shuffled.
Words are compared by 64-bit hashes of their bytes.

Cases: null or empty text, or no words: no words, no spans. Null or wordless
item: no phrase. Null item_id: its occurrences are hit, and it is named by no
document. Items with one item_id count once. Repeated rows, and rows without a
doc_id: searched once each. No items: nothing is hit. Very long text: read
in parts, indexed in several shards that overlap by the longest phrase less one word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm import blocks, lookup
from starmill.scratch import stage

SIZE = 10
SHARD_BYTES = 8 << 20  # of text, unless one text is longer
SHARD_WORDS = 2 << 20
RATE = 8


class Phrases(NamedTuple):
    vocabulary: np.ndarray  # hashes of the words
    words: np.ndarray  # phrases x size: symbols, the last word in the last column; 0 fills short ones on the left
    lengths: np.ndarray
    first: np.ndarray  # of each phrase's items
    items: np.ndarray  # numbers of items, by phrase
    names: list[str | None]


def phrases(rows: list, size: int = SIZE) -> Phrases:
    """The distinct phrases of (item_id, text) rows, and the items that have them."""
    made, owners = [], []
    for k, row in enumerate(rows):
        found = lookup.term_hashes(row.text)
        if len(found) >= size:
            windows = np.lib.stride_tricks.sliding_window_view(found, size)
        elif len(found):
            windows = found[None, :]
        else:
            continue
        padded = np.zeros((len(windows), size), np.uint64)
        padded[:, size - windows.shape[1] :] = windows
        filled = np.zeros((len(windows), size), bool)
        filled[:, size - windows.shape[1] :] = True
        made.append((padded, filled))
        owners += [k] * len(windows)
    if not made:
        none = np.zeros(0, np.int64)
        return Phrases(np.zeros(0, np.uint64), np.zeros((0, size), np.int32), none, np.zeros(1, np.int64), none, [])
    hashes, filled = (np.concatenate(x) for x in zip(*made))
    vocabulary, numbers = np.unique(hashes[filled], return_inverse=True)
    symbols = np.zeros(hashes.shape, np.int32)
    symbols[filled] = numbers + 1
    words, which = np.unique(symbols, axis=0, return_inverse=True)
    pairs = np.unique(np.stack([which.ravel(), np.array(owners)], 1), axis=0)
    first = np.searchsorted(pairs[:, 0], np.arange(len(words) + 1))
    names = [None if r.item_id is None else str(r.item_id) for r in rows]
    return Phrases(vocabulary, words, (words > 0).sum(1), first, pairs[:, 1], names)


class Bits:
    """A bit vector that tells how many bits are set before a place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self._words = np.packbits(padded, bitorder="little").view(np.uint64)
        self._before = np.concatenate([[0], np.cumsum(np.bitwise_count(self._words), dtype=np.int64)[:-1]])

    def rank(self, at: np.ndarray) -> np.ndarray:
        inside = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self._before[at >> 6] + np.bitwise_count(self._words[at >> 6] & inside)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self._words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0


class WaveletTree:
    """Symbols of ``bits`` bits; a level holds one bit of each, those with a 0 above first."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels: list[tuple[Bits, int, int]] = []
        for shift in range(bits - 1, -1, -1):
            ones = (symbols >> shift & 1).astype(bool)
            self.levels.append((Bits(ones), len(ones) - int(ones.sum()), shift))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        # where the places of each symbol begin on the lowest level
        every = np.arange(1 << bits, dtype=np.int64)
        self._begin = self._down(every, np.zeros(1 << bits, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, zeros, shift in self.levels:
            ones = level.rank(at)
            at = np.where(symbols >> shift & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        return self._down(symbols, at) - self._begin[symbols]

    def at(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at the places, and how often each stands before."""
        symbols = np.zeros(len(place), np.int64)
        for level, zeros, _ in self.levels:
            bit, ones = level.get(place), level.rank(place)
            place = np.where(bit, zeros + ones, place - ones)
            symbols = symbols << 1 | bit
        return symbols, place - self._begin[symbols]


def suffix_order(text: np.ndarray, ends: np.ndarray, bits: int) -> np.ndarray:
    """The suffixes in order. Each is compared up to the end of its run (``ends``); equal ones stand by position."""
    n = len(text)
    key, length = text.astype(np.int64), 1
    while 2 * length * bits <= 62:
        after = np.zeros(n, np.int64)
        after[: max(0, n - length)] = key[length:]
        after[np.arange(n) + length > ends] = 0
        key = key << (length * bits) | after
        length *= 2
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    tied = ~new
    tied[:-1] |= ~new[1:]
    at = np.flatnonzero(tied)
    while True:
        who = order[at]
        still = who + length <= ends[who]  # the members of a tied group are compared to the end together, or none is
        at, who = at[still], who[still]
        if not len(at):
            return order
        key = rank[who] * n + rank[who + length]
        turn = np.argsort(key, kind="stable")
        order[at], key = who[turn], key[turn]
        new = np.ones(len(at), bool)
        new[1:] = key[1:] != key[:-1]
        rank[order[at]] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = at[tied]
        length *= 2


class Shard:
    """The FM-index of one shard: runs of symbols (1 and up), a 0 after each."""

    def __init__(self, text: np.ndarray, symbols: int, rate: int = RATE):
        bits = max(1, int(symbols).bit_length())
        marks = np.flatnonzero(text == 0)
        order = suffix_order(text, np.repeat(marks, np.diff(marks, prepend=-1)), bits)
        before = np.where(order > 0, text[order - 1], 0)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))])
        self.tree = WaveletTree(before, bits)
        sampled = (order % rate == 0) | (before == 0)
        self._sampled, self._positions = Bits(sampled), order[sampled].astype(np.int32)

    def search(self, found: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search: the phrases that occur, and the range of their suffixes."""
        last = found.words[:, -1].astype(np.int64)
        low, high = self.first[last], self.first[last + 1]
        live = np.flatnonzero(low < high)
        low, high = low[live], high[live]
        for column in range(found.words.shape[1] - 2, -1, -1):
            if not len(live):
                break
            symbols = found.words[live, column].astype(np.int64)
            more = symbols > 0  # the others are found already
            a, b, c = low[more], high[more], symbols[more]
            low[more] = self.first[c] + self.tree.rank(c, a)
            high[more] = self.first[c] + self.tree.rank(c, b)
            full = low < high
            live, low, high = live[full], low[full], high[full]
        return live, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The positions of suffixes, by the sampled ones before them."""
        position = np.empty(len(rows), np.int64)
        left, step = np.arange(len(rows)), 0
        while len(left):
            known = self._sampled.get(rows)
            position[left[known]] = self._positions[self._sampled.rank(rows[known])] + step
            left, rows = left[~known], rows[~known]
            symbols, before = self.tree.at(rows)
            rows = self.first[symbols] + before
            step += 1
        return position


def occurrences(symbols: np.ndarray, first: np.ndarray, found: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(place, phrase) of every occurrence within the texts that begin at ``first``; a symbol of 0 belongs to no phrase."""
    shortest, longest = int(found.lengths.min()), int(found.lengths.max())
    known = np.zeros(len(symbols) + 2, bool)
    known[1:-1] = symbols > 0
    begins = known[1:] & ~known[:-1]
    stops = known[:-1] & ~known[1:]
    begins[first] |= known[1:][first]  # a run does not leave its text
    stops[first] |= known[:-1][first]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    long = ends - starts >= shortest
    starts, ends = starts[long], ends[long]
    # what one index takes in: whole runs, or a part of a long one that overlaps the next by what a phrase can cross
    cuts = [(a, b) for a, b in zip(starts.tolist(), ends.tolist()) if b - a > SHARD_WORDS]
    if cuts:
        whole = ends - starts <= SHARD_WORDS
        extra = [(k, min(k + SHARD_WORDS + longest - 1, b)) for a, b in cuts for k in range(a, b, SHARD_WORDS)]
        starts = np.concatenate([starts[whole], [a for a, _ in extra]]).astype(np.int64)
        ends = np.concatenate([ends[whole], [b for _, b in extra]]).astype(np.int64)
    places, which = [], []
    bounds = np.concatenate([[0], np.cumsum(ends - starts + 1)])
    k = 0
    while k < len(starts):
        stop = max(k + 1, int(np.searchsorted(bounds, bounds[k] + SHARD_WORDS, "right")) - 1)
        lengths = ends[k:stop] - starts[k:stop] + 1
        own = np.repeat(starts[k:stop] - (bounds[k:stop] - bounds[k]), lengths) + np.arange(bounds[stop] - bounds[k])
        text = symbols[np.minimum(own, len(symbols) - 1)]
        text[bounds[k + 1 : stop + 1] - bounds[k] - 1] = 0
        shard = Shard(text, len(found.vocabulary))
        phrase, low, high = shard.search(found)
        count = high - low
        rows = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        places.append(own[shard.locate(rows)])
        which.append(np.repeat(phrase, count))
        k = stop
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(which)


class Words(NamedTuple):
    symbols: np.ndarray
    starts: np.ndarray  # bytes in the word's text
    ends: np.ndarray
    first: np.ndarray  # the first word of each text, and their number


def read(texts: pa.Array, table: blocks.Places) -> Words:
    """The words of the texts as symbols; hashes are made for a bounded number of bytes at a time."""
    made: list[tuple] = []
    counts = [0]
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    for block in blocks.blocks(iter([batch])):
        column, base = block.column("text"), 0
        if block.num_rows == 1 and column[0].is_valid and len(column[0].as_buffer()) > 2 * blocks.BLOCK_BYTES:
            pieces = [pa.array([p], pa.large_binary()) for p in blocks.cut(column[0].as_buffer().to_pybytes(), blocks.BLOCK_BYTES, lookup.TERMS)]
        else:
            pieces = [column]
        numbers = np.zeros(block.num_rows, np.int64)
        for piece in pieces:
            found = blocks.tokens(piece, lookup.TERMS, blocks.LOWER)
            numbers += np.diff(found.first)
            shift = np.repeat(found.texts[:-1], np.diff(found.first)) - base
            made.append((table.find(found.hashes).astype(np.int32) + 1, found.starts - shift, found.ends - shift))
            base += len(found.data)
        counts += numbers.tolist()
    symbols, starts, ends = (np.concatenate(x) for x in zip(*made)) if made else (np.zeros(0, np.int32), *[np.zeros(0, np.int64)] * 2)
    return Words(symbols, starts, ends, np.cumsum(counts))


SPANS = "array<struct<first_word:bigint,last_word:bigint,first_byte:bigint,last_byte:bigint>>"
_FIELDS = ["first_word", "last_word", "first_byte", "last_byte"]


def _search(texts: pa.Array, earlier: pa.Array, named: pa.Array, table: blocks.Places, found: Phrases) -> list[pa.Array]:
    """n_words, spans and items of the texts, with those found in earlier passes."""
    words = read(texts, table)
    n = len(words.symbols)
    place, phrase = occurrences(words.symbols, words.first, found) if n and len(found.lengths) else (np.zeros(0, np.int64),) * 2
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, place, 1)
    np.add.at(depth, place + found.lengths[phrase], -1)
    before = earlier.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    if before.sum():
        flat, base = earlier.flatten(), np.repeat(words.first[:-1], before)
        np.add.at(depth, base + flat.field("first_word").to_numpy(), 1)
        np.add.at(depth, base + flat.field("last_word").to_numpy(), -1)
    hit = np.zeros(n + 2, np.int8)
    hit[1:-1] = np.cumsum(depth[:-1]) > 0
    edge = np.diff(hit) != 0
    inner = words.first[1:-1]  # a text begins: what is hit on both sides are two spans
    cut = inner[(inner > 0) & (inner < n)]
    cut = np.unique(cut[(hit[cut] > 0) & (hit[cut + 1] > 0)])
    edges = np.sort(np.concatenate([np.flatnonzero(edge), np.repeat(cut, 2)]))
    starts, ends = edges[0::2], edges[1::2]
    owner = np.searchsorted(words.first, starts, "right") - 1
    spans = pa.StructArray.from_arrays(
        [starts - words.first[owner], ends - words.first[owner], words.starts[starts], words.ends[ends - 1]], _FIELDS
    )
    lists = pa.ListArray.from_arrays(np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32), spans)
    # (text, item) pairs, once each
    pairs = np.unique((np.searchsorted(words.first, place, "right") - 1) * max(1, len(found.lengths)) + phrase)
    rows, kinds = np.divmod(pairs, max(1, len(found.lengths)))
    count = found.first[kinds + 1] - found.first[kinds]
    own = found.items[np.repeat(found.first[kinds] - np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64), count) + np.arange(count.sum())]
    items: list[set] = [set(x or ()) for x in named.to_pylist()]
    for row, item in zip(np.repeat(rows, count).tolist(), own.tolist()):
        if found.names[item] is not None:
            items[row].add(found.names[item])
    return [pa.array(np.diff(words.first)), lists, pa.array([sorted(x, key=str.encode) for x in items], pa.list_(pa.string()))]


def find(
    docs: DataFrame, benchmark: DataFrame, size: int = SIZE, limit: int = lookup.PART_BYTES, keep_text: bool = False,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, spans, items), and ``text`` with ``keep_text``; a row per document.

    Spans count words and bytes from 0, ends excluded; items are sorted by their bytes.
    """
    spark = docs.sparkSession
    now = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast(SPANS).alias("spans"), F.array().cast("array<string>").alias("items"),
    )
    names = now.columns
    schema = now.schema

    def search(shared):
        held: list = []

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if not held:
                held.extend([blocks.Places(shared.value.vocabulary), shared.value])
            for block in blocks.blocks(batches, SHARD_BYTES):
                made = _search(block.column("text"), block.column("spans"), block.column("items"), *held)
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("text"), *made], names)

        return run

    passes = 0
    for part in lookup.parts(benchmark, item_id, item_text, limit):
        if passes:
            now = stage(now, "decontaminated")
        now = now.mapInArrow(search(spark.sparkContext.broadcast(phrases(part, size))), schema)  # of bounded size
        passes += 1
    if not passes:  # no items: words are still counted
        now = now.mapInArrow(search(spark.sparkContext.broadcast(phrases([], size))), schema)
    return now if keep_text else now.drop("text")


def remove(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, n_words, spans, items), the spans cut out of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks.blocks(iter([batch])):
                clean = []
                for body, spans in zip(block.column("text").to_pylist(), block.column("spans").to_pylist()):
                    if spans:
                        data, at, kept = body.encode(), 0, []
                        for span in spans:
                            kept.append(data[at : span["first_byte"]])
                            at = span["last_byte"]
                        body = b"".join([*kept, data[at:]]).decode()
                    clean.append(body)
                yield block.set_column(block.schema.get_field_index("text"), "text", pa.array(clean, pa.string()))

    found = find(docs, benchmark, size, keep_text=True, doc_id=doc_id, text=text)
    return found.mapInArrow(run, found.schema)
