"""Texts as bytes: splitting and hashing whole blocks of documents at once.

A task sees a few thousand documents per Arrow batch. The helpers here cut a
batch into blocks of bounded size and work on the UTF-8 bytes of all its texts
together, so that no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20

# Classes of bytes: 0 parts, every other value joins equal neighbours.
_SPACES = [0x20, *range(0x09, 0x0E)]
WORDS = np.ones(256, np.uint8)
WORDS[_SPACES] = 0
# Letters, digits and all of non-ASCII against other signs.
SIGNS = np.full(256, 2, np.uint8)
SIGNS[_SPACES] = 0
SIGNS[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = 1

SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[65:91] += 32

_TABLE = np.random.default_rng(20240607).integers(1, 1 << 64, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_powers = {BASE: np.ones(1, np.uint64), INVERSE: np.ones(1, np.uint64)}


def power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    have = _powers[base]
    while len(have) < n:
        step = np.uint64(pow(base, len(have), 1 << 64))
        have = np.concatenate([have, have * step])
    if len(have) <= 4 * BLOCK_BYTES:  # an unusually long text does not stay in memory
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit depends on every bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Tokens(NamedTuple):
    data: np.ndarray  # the bytes of all texts
    texts: np.ndarray  # where each text begins, and the end
    starts: np.ndarray  # of the tokens, in bytes
    ends: np.ndarray
    first: np.ndarray  # the first token of each text, and their number
    hashes: np.ndarray


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts and where each begins; a null text is empty."""
    array = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    values = array.buffers()[2]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def tokens(texts: pa.Array, classes: np.ndarray = WORDS, letters: np.ndarray = SAME) -> Tokens:
    """Runs of bytes of one class within each text, with a 64-bit hash of each."""
    data, offsets = text_bytes(texts)
    n = len(data)
    data = letters[data]
    kind = classes[data]
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    before[1:] = kind[:-1]
    after[:-1] = kind[1:]
    edges = offsets[offsets < n]
    before[edges] = 0
    after[edges[edges > 0] - 1] = 0
    starts = np.flatnonzero((kind != 0) & (kind != before))
    ends = np.flatnonzero((kind != 0) & (kind != after)) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[data] * power(BASE, n), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * power(INVERSE, n)[starts] + (ends - starts).astype(np.uint64))
    return Tokens(data, offsets, starts, ends, np.searchsorted(starts, offsets), hashes)


def grams(found: Tokens, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` tokens, and the first token of each; no run leaves its text."""
    count = len(found.hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if size <= 8:
        rolled = found.hashes[:count].copy()
        for k in range(1, size):
            rolled *= np.uint64(BASE)
            rolled += found.hashes[k : k + count]
    else:
        n = len(found.hashes)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(found.hashes * power(INVERSE, n), out=sums[1:])
        rolled = (sums[size:] - sums[:count]) * power(BASE, n + 1)[size : n + 1]
    ends = np.repeat(found.first[1:], np.diff(found.first))[:count]
    at = np.flatnonzero(np.arange(size, size + count) <= ends)
    return mix(rolled[at] + np.uint64(size)), at


def per_text(found: Tokens, at: np.ndarray) -> np.ndarray:
    """The bounds of each text in ``at``, a rising list of token numbers."""
    return np.searchsorted(at, found.first)


class Places:
    """Where 64-bit hashes stand in a list of distinct ones: a table with open addressing."""

    def __init__(self, hashes: np.ndarray):
        bits = max(4, (2 * len(hashes)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.append(hashes.astype(np.uint64), np.uint64(0))
        self._slots = np.full(1 << bits, -1, np.int32)
        left = np.arange(len(hashes), dtype=np.int32)
        at = (hashes >> self._shift).astype(np.int64)
        while len(left):
            free = self._slots[at] < 0
            self._slots[at[free]] = left[free]
            out = self._slots[at] != left
            left, at = left[out], (at[out] + 1) & self._mask

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 for one that is not in the list."""
        at = (hashes >> self._shift).astype(np.int64)
        found = self._slots[at]
        left = np.flatnonzero((found >= 0) & (self._keys[found] != hashes))
        at = at[left]
        while len(left):
            at = (at + 1) & self._mask
            found[left] = self._slots[at]
            wrong = (found[left] >= 0) & (self._keys[found[left]] != hashes[left])
            left, at = left[wrong], at[wrong]
        return found


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES, text: str | int = "text") -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about ``limit`` bytes of text, at least one row each."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def cut(data: bytes, limit: int, classes: np.ndarray) -> Iterator[bytes]:
    """A long text in parts of about ``limit`` bytes that end where no token runs on."""
    start = 0
    while len(data) - start > limit:
        stop = start + limit
        while stop < len(data) and classes[data[stop]]:
            stop += 1
        yield data[start:stop]
        start = stop
    yield data[start:]


_kept: list = []


def kept(key: tuple, make: Callable):
    """What ``make`` gives, held by the worker for its next tasks, until another key is asked for."""
    if not _kept or _kept[0] != key:
        _kept.clear()  # what was held goes before the new one is made
        _kept.extend([key, make()])
    return _kept[1]


def map_texts(docs: DataFrame, work: Callable, schema: str, *more: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``work`` takes a block with columns doc_id, text and ``more``, and returns arrays in the order of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            made = work(block)
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in made], names)
        pa.default_memory_pool().release_unused()  # the worker goes on with other tasks

    names = [part.split()[0] for part in schema.split(", ")]
    read = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), *more)
    return read.mapInArrow(run, schema)
