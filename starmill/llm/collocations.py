"""Phrase collocations, counted by double-array tries of the phrases that can matter.

A-Z in lower case; texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, these at
spaces and tabs into words. Within a language a phrase of two or three words is a
candidate if it stands in pieces ``least`` times or more. Its score is
``floor(1000000 a a / (l r))`` at the cut with the lowest (the first of equal
ones), with the counts of phrase, part before and part after the cut. A candidate inside a
longer one that has at least half its count is dropped.

1. Level by level, as frequent phrases have frequent parts only: words are
   counted; pairs of frequent words are counted by their hashes; then threes of
   frequent pairs. What is frequent travels to the next level's tasks as a bitmap
   of fixed size, whose false members cost time and change nothing.
   Each task sums before it sends a row.
2. These counts are bounds, by which each language's candidates are put in order.
   The first ``slack * limit`` go on, with all their parts and, for each,
   the longer candidate that comes closest to drop it.
3. Their double-array trie, of bounded size, travels to the tasks. All positions
   of a block hold a state of it and move on by a word at once; the states
   reached at each level are counted (every state is a phrase), and the
   tasks' counts are summed. All numbers returned come from these counts.
4. If a candidate that was left out could still stand among the first
   ``limit``, more go on, four times as many each time.

Words are compared by 64-bit hashes of word and language, products are exact
(decimals in Spark, integers of any size in Python).

Cases: null or empty text, or no words: nothing. Null language: ``und``. A
language without candidates has no rows. Repeated rows count once each; doc_id
is not read. Equal scores: larger counts first, then the phrase by its bytes. A very
long text is read in parts that end with a piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm import blocks
from starmill.scratch import stage

LEAST = 10
LIMIT = 2000
SLACK = 4
PERCENT = 50
UNKNOWN = "und"
BLOCK_BYTES = 2 << 20
HELD = 2 << 20  # pairs or threes a task holds before it sends their counts
BITS = 26  # of a bitmap's places: 8 MB
LANGUAGES = 25  # in one trie

_CUTS = np.zeros(256, np.uint8)
_CUTS[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = 1
_WORDS = 1 - _CUTS
_WORDS[[32, 9]] = 0


class Part(NamedTuple):
    hashes: np.ndarray  # of the words with their language
    joined: np.ndarray  # the next word stands in the same piece
    languages: np.ndarray  # numbers into ``names``
    names: list[str]
    found: blocks.Tokens


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[Part]:
    """The words of (text, lang) batches, a bounded number at a time."""
    for block in blocks.blocks(batches, BLOCK_BYTES):
        texts, langs = block.column("text"), block.column("lang").to_pylist()
        if block.num_rows == 1 and texts[0].is_valid and len(texts[0].as_buffer()) > 2 * BLOCK_BYTES:
            pieces = [pa.array([p], pa.large_binary()) for p in blocks.cut(texts[0].as_buffer().to_pybytes(), BLOCK_BYTES, 1 - _CUTS)]
        else:
            pieces = [texts]
        names = sorted(set(langs))
        salts = np.array([int.from_bytes(hashlib.blake2b(n.encode(), digest_size=8).digest(), "little") for n in names], np.uint64)
        of_text = np.array([names.index(n) for n in langs], np.int64)
        for piece in pieces:
            found = blocks.tokens(piece, _WORDS, blocks.LOWER)
            counts = np.diff(found.first)
            languages = np.repeat(of_text, counts)
            cuts = np.cumsum(_CUTS[found.data], dtype=np.int64)[found.starts]
            joined = np.zeros(len(found.hashes), bool)
            joined[:-1] = cuts[1:] == cuts[:-1]
            joined[found.first[1:][counts > 0] - 1] = False
            yield Part(blocks.mix(found.hashes + salts[languages]), joined, languages, names, found)


def _spelled(found: blocks.Tokens, at: np.ndarray) -> pa.Array:
    """The words at some places, as strings."""
    lengths = found.ends[at] - found.starts[at]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    data = found.data[np.repeat(found.starts[at] - ends[:-1], lengths) + np.arange(ends[-1])]
    return pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data.tobytes())])


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    language = F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN))
    return docs.select(F.col(text).cast("string").alias("text"), language.alias("lang")).filter("text is not null")


def word_counts(texts: DataFrame, least: int) -> DataFrame:
    """(lang, word, key, n): the frequent words, and with a null word each language's number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            keys, at, n = np.unique(part.hashes, return_index=True, return_counts=True)
            totals = np.bincount(part.languages, minlength=len(part.names))
            there = np.flatnonzero(totals)
            names = pa.array(part.names, pa.string()).take(pa.array(np.concatenate([part.languages[at], there])))
            words = pa.concat_arrays([_spelled(part.found, at), pa.nulls(len(there), pa.string())])
            keys = np.concatenate([keys.view(np.int64), np.zeros(len(there), np.int64)])
            yield pa.RecordBatch.from_arrays([names, words, pa.array(keys), pa.array(np.concatenate([n, totals[there]]))], ["lang", "word", "key", "n"])

    counted = texts.mapInArrow(run, "lang string, word string, key bigint, n bigint")
    return counted.groupBy("lang", "word").agg(F.min("key").alias("key"), F.sum("n").alias("n")).filter(F.col("word").isNull() | (F.col("n") >= least))


def _pair_column(a: str, b: str) -> Column:
    turned = F.shiftleft(b, 17).bitwiseOR(F.shiftrightunsigned(b, 47))
    return F.col(a).bitwiseXOR(turned)


def _pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a ^ (b << np.uint64(17) | b >> np.uint64(47))


class Members:
    """A bitmap of fixed size over the first bits of 64-bit keys."""

    def __init__(self, rows: list):
        self._bits = np.zeros(1 << (BITS - 3), np.uint8)
        for row in rows:
            self._bits[row.part << 12 : (row.part + 1) << 12] = np.frombuffer(row.bits, np.uint8)

    @staticmethod
    def of(frame: DataFrame, key: Column) -> Members:
        place = F.shiftrightunsigned(key, 64 - BITS)
        rows = frame.select(F.shiftright(place, 15).cast("int").alias("part"), (place % 32768).alias("place"))
        return Members(rows.groupBy("part").agg(F.bitmap_construct_agg("place").alias("bits")).collect())

    def has(self, keys: np.ndarray) -> np.ndarray:
        place = (keys >> np.uint64(64 - BITS)).astype(np.int64)
        return (self._bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def _run_counts(texts: DataFrame, size: int, members: Members) -> DataFrame:
    """(k1, .., n): runs of ``size`` words, all of whose parts of one word less are members."""
    shared = texts.sparkSession.sparkContext.broadcast(members)  # of fixed size
    names = [f"k{i + 1}" for i in range(size)]

    def summed(held: list[np.ndarray]) -> pa.RecordBatch:
        runs = np.concatenate(held)
        held.clear()
        key = runs[:, 0].copy()
        for i in range(1, size):
            key = blocks.mix(key * np.uint64(31) + runs[:, i])
        order = np.argsort(key)
        key, runs = key[order], runs[order]
        new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (runs[1:] != runs[:-1]).any(1)]))
        n = np.diff(np.append(new, len(runs)))
        columns = [pa.array(np.ascontiguousarray(runs[new, i]).view(np.int64)) for i in range(size)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(n)], [*names, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for part in _parts(batches):
            h = part.hashes
            last = len(h) - size + 1
            if last <= 0:
                continue
            good = np.ones(last, bool)
            for i in range(size - 1):
                good &= part.joined[i : i + last]
            known = shared.value.has(h) if size == 2 else shared.value.has(_pair_keys(h[:-1], h[1:]))
            good &= known[:last] & known[1 : last + 1]
            at = np.flatnonzero(good)
            held.append(np.stack([h[at + i] for i in range(size)], 1))
            if sum(map(len, held)) > HELD:
                yield summed(held)
        if sum(map(len, held)):
            yield summed(held)

    counted = texts.mapInArrow(run, ", ".join(f"{k} bigint" for k in [*names, "n"]))
    return counted.groupBy(*names).agg(F.sum("n").alias("n"))


def _score(a: str, l: str, r: str) -> Column:  # noqa: E741
    wide = lambda c: f"cast({c} as decimal(19,0))"
    return F.expr(f"(cast(1000000 as decimal(38,0)) * ({wide(a)} * {wide(a)})) div ({wide(l)} * {wide(r)})")


def candidates(words: DataFrame, pairs: DataFrame, threes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(lang, phrase, a, score, keys, longer) by the counts of hashes, without what they drop.

    ``longer`` holds the keys of the most frequent three that contains a pair.
    """
    known = words.filter("word is not null")
    named = lambda i: known.select(
        *([F.col("lang")] if i == 1 else []), F.col("key").alias(f"k{i}"), F.col("word").alias(f"w{i}"), F.col("n").alias(f"n{i}")
    )
    three = F.struct(F.col("n").alias("n"), "k1", "k2", "k3")
    around = (
        threes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), three.alias("three"))
        .unionByName(threes.select(F.col("k2").alias("p1"), F.col("k3").alias("p2"), three.alias("three")))
        .groupBy("p1", "p2").agg(F.max("three").alias("three"))
        .withColumnsRenamed({"p1": "k1", "p2": "k2"})
    )
    two = (
        pairs.join(around, ["k1", "k2"], "left")
        .filter(F.col("three").isNull() | (F.col("three.n") * 100 < F.col("n") * percent))
        .join(named(1), "k1").join(named(2), "k2")
        .select(
            "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("n").alias("a"), _score("n", "n1", "n2").alias("score"),
            F.array("k1", "k2").alias("keys"), F.when(F.col("three").isNotNull(), F.array("three.k1", "three.k2", "three.k3")).alias("longer"),
        )
    )
    front = pairs.select("k1", "k2", F.col("n").alias("n12"))
    back = pairs.select(F.col("k1").alias("k2"), F.col("k2").alias("k3"), F.col("n").alias("n23"))
    long = (
        threes.join(front, ["k1", "k2"]).join(back, ["k2", "k3"]).join(named(1), "k1").join(named(2), "k2").join(named(3), "k3")
        .select(
            "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("n").alias("a"),
            F.least(_score("n", "n1", "n23"), _score("n", "n12", "n3")).alias("score"),
            F.array("k1", "k2", "k3").alias("keys"), F.lit(None).cast("array<bigint>").alias("longer"),
        )
    )
    return two.unionByName(long)


class Trie:
    """A double array: from state s by symbol c to base[s] + c, if check there is s."""

    def __init__(self, phrases: set[tuple[int, ...]]):
        self.symbols = np.array(sorted({k for p in phrases for k in p}), np.int64)
        number = {k: i for i, k in enumerate(self.symbols.tolist())}
        below: dict[tuple[int, ...], set[int]] = {}
        for phrase in phrases:
            for k in range(len(phrase)):
                below.setdefault(phrase[:k], set()).add(number[phrase[k]])
        self.states: dict[tuple[int, ...], int] = {(): 0}
        size = len(self.symbols) + 2
        base, check = [0] * size, [-1] * size
        check[0] = 0
        free = 1  # no free place before it
        names = self.symbols.tolist()
        for node in sorted(below, key=lambda p: (len(p), -len(below[p]), p)):
            mine = sorted(below[node])
            while free < len(check) and check[free] >= 0:
                free += 1
            place = free
            while True:
                shift = place - mine[0]
                check += [-1] * (shift + mine[-1] + 1 - len(check))
                if all(check[shift + c] < 0 for c in mine):
                    break
                place += 1
            state = self.states[node]
            base += [0] * (len(check) - len(base))
            base[state] = shift
            for c in mine:
                check[shift + c] = state
                self.states[(*node, names[c])] = shift + c
        base += [0] * (len(check) - len(base))
        self.base, self.check = np.array(base, np.int64), np.array(check, np.int64)
        self.depth = max((len(p) for p in phrases), default=0)

    def count(self, symbols: np.ndarray, joined: np.ndarray) -> np.ndarray:
        """How often each state is reached; ``symbols`` holds -1 for words that no phrase has."""
        counts = np.zeros(len(self.check), np.int64)
        at, state = np.arange(len(symbols)), np.zeros(len(symbols), np.int64)
        for _ in range(self.depth):
            symbol = symbols[at]
            to = self.base[state] + symbol
            good = (symbol >= 0) & (to > 0) & (to < len(self.check))
            good[good] = self.check[to[good]] == state[good]
            at, state = at[good], to[good]
            counts += np.bincount(state, minlength=len(counts))
            on = joined[at]
            at, state = at[on] + 1, state[on]
        return counts


def phrase_counts(texts: DataFrame, phrases: set[tuple[int, ...]]) -> dict[tuple[int, ...], int]:
    """How often every beginning of the phrases stands in the texts."""
    trie = Trie(phrases)
    states, trie.states = trie.states, {}
    shared = texts.sparkSession.sparkContext.broadcast(trie)  # of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        table = blocks.Places(own.symbols.view(np.uint64))
        counts = np.zeros(len(own.check), np.int64)
        for part in _parts(batches):
            counts += own.count(table.find(part.hashes).astype(np.int64), part.joined)
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there])], ["state", "n"])

    rows = texts.mapInArrow(run, "state bigint, n bigint").groupBy("state").agg(F.sum("n").alias("n")).collect()
    counts = {r.state: r.n for r in rows}
    return {phrase: counts.get(state, 0) for phrase, state in states.items() if phrase}


def _parts_of(keys: tuple[int, ...]) -> list[tuple[int, ...]]:
    return [keys[i:j] for i in range(len(keys)) for j in range(i + 1, len(keys) + 1)]


def _exact(keys: tuple[int, ...], counts: dict) -> tuple[int, int, int, int]:
    """(score, a, l, r) at the cut with the lowest score, the first of equal ones."""
    a = counts[keys]
    cuts = [(counts[keys[:k]], counts[keys[k:]]) for k in range(1, len(keys))]
    l, r = min(cuts, key=lambda c: 1_000_000 * a * a // (c[0] * c[1]))  # noqa: E741
    return 1_000_000 * a * a // (l * r), a, l, r


def mine(
    docs: DataFrame, least: int = LEAST, limit: int = LIMIT, percent: int = PERCENT, slack: int = SLACK, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``limit`` of every language."""
    spark = docs.sparkSession
    texts = _texts(docs, text, lang)
    words = stage(word_counts(texts, least), "words")
    pairs = stage(_run_counts(texts, 2, Members.of(words.filter("word is not null"), F.col("key"))).filter(F.col("n") >= least), "pairs")
    threes = stage(_run_counts(texts, 3, Members.of(pairs, _pair_column("k1", "k2"))).filter(F.col("n") >= least), "threes")
    bounds = stage(candidates(words, pairs, threes, percent), "candidates")
    totals = {r.lang: r.n for r in words.filter("word is null").collect()}
    out = []
    for k in range(0, len(totals), LANGUAGES):
        names = sorted(totals, key=str.encode)[k : k + LANGUAGES]
        out += _ranked(texts, bounds.filter(F.col("lang").isin(names)), names, totals, least, limit, percent, slack)
    return spark.createDataFrame(out, "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")


def _ranked(texts, bounds, names, totals, least, limit, percent, slack) -> list[tuple]:
    """The result of some languages, from the counts of a trie."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    while True:
        taken = bounds.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= slack * limit).collect()
        wanted = {part for row in taken for keys in (row["keys"], row["longer"] or ()) for part in _parts_of(tuple(keys))}
        counts = phrase_counts(texts, wanted) if wanted else {}
        out, whole = [], True
        for name in names:
            made = []
            for row in (r for r in taken if r.lang == name):
                keys = tuple(row["keys"])
                a = counts[keys]
                if a < least or row["longer"] and (n := counts[tuple(row["longer"])]) >= least and 100 * n >= percent * a:
                    continue
                score, a, l, r = _exact(keys, counts)  # noqa: E741
                made.append(((-score, -a, row.phrase.encode()), (name, row.phrase, a, l, r, totals[name], score)))
            made.sort()
            out += [(row[0], rank, *row[1:]) for rank, (_, row) in enumerate(made[:limit], 1)]
            last = max(((-r.score, -r.a, r.phrase.encode()) for r in taken if r.lang == name and r.place == slack * limit), default=None)
            whole &= last is None or len(made) >= limit and made[limit - 1][0] <= last
        if whole:
            return out
        slack *= 4
