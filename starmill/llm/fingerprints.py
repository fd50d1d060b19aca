"""Context-triggered piecewise hashing.

A rolling hash over seven bytes ends a chunk where it hits a trigger that
depends on the block size; each chunk adds one of 64 letters, so a local edit
changes only the letters around it. A fingerprint holds the signatures for a
block size and for twice that size: ``size:letters:letters``. Two fingerprints
are compared at the block sizes they share: a run of seven letters in common is
required, then the likeness is 1 - (insertions + deletions) / (both lengths),
replacements counting as one of each.

The block size is the smallest power of two times ``LEAST`` that makes at most
about 64 chunks; it is halved while the text gives fewer than 32.

Cases: null or empty text: ``3::``, alike only to itself. Equal texts have equal
fingerprints and likeness 1. Null doc_id: fingerprinted like any other; in
``with_next`` nulls come first in the order. Repeated rows each have a
fingerprint; documents with one doc_id follow each other by their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm import blocks
from starmill.scratch import stage

LEAST = 3  # smallest block size
LETTERS = 64  # of a signature, at most
RUN = 7  # bytes of the rolling hash; letters two signatures must share
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_ROLL = np.random.default_rng(77).integers(1, 1 << 32, 256, dtype=np.uint64)
_BYTE = np.random.default_rng(78).integers(1, 1 << 64, 256, dtype=np.uint64)
_FACTOR = np.uint64(0x9E3779B1)


def _rolling(data: np.ndarray) -> np.ndarray:
    """A hash of the last seven bytes at every byte."""
    rolled = np.zeros(len(data), np.uint64)
    values = _ROLL[data]
    for k in range(RUN):
        rolled *= _FACTOR
        back = RUN - 1 - k
        rolled[back:] += values[: max(0, len(values) - back)]
    return blocks.mix(rolled) >> np.uint64(16)


def _signature(sums: np.ndarray, rolled: np.ndarray, size: int) -> str:
    """A letter per chunk; all chunks beyond the last letter but one share the last."""
    n = len(rolled)
    ends = np.flatnonzero(rolled % np.uint64(size) == size - 1) + 1
    ends = ends[: LETTERS - 1]
    if n and (len(ends) == 0 or ends[-1] < n):
        ends = np.append(ends, n)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    # equal chunks have equal sums of (byte, place in the chunk) only if the place counts from the chunk's start
    chunks = (sums[ends] - sums[starts]) * blocks.power(blocks.INVERSE, n + 1)[starts]
    return _ALPHABET[(blocks.mix(chunks) & np.uint64(63)).astype(np.int64)].tobytes().decode()


def fingerprint(text: str | None) -> str:
    data = np.frombuffer((text or "").encode(), np.uint8)
    n = len(data)
    size = LEAST
    while size * LETTERS < n:
        size *= 2
    rolled = _rolling(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * blocks.power(blocks.BASE, n), out=sums[1:])
    while size > LEAST and np.count_nonzero(rolled % np.uint64(size) == size - 1) + 1 < LETTERS // 2:
        size //= 2
    return f"{size}:{_signature(sums, rolled, size)}:{_signature(sums, rolled, 2 * size)}"


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, all columns of a row at once in the bits of an integer."""
    where: dict[str, int] = {}
    for i, letter in enumerate(a):
        where[letter] = where.get(letter, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for letter in b:
        hit = row & where.get(letter, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def signature_likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    runs = {a[i : i + RUN] for i in range(len(a) - RUN + 1)}
    if not any(b[i : i + RUN] in runs for i in range(len(b) - RUN + 1)):
        return 0.0
    return 2.0 * _common(a, b) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1; 0 if the block sizes are not equal, half or double."""
    if a == b:
        return 1.0
    size_a, one_a, two_a = a.split(":")
    size_b, one_b, two_b = b.split(":")
    if not one_a or not one_b:  # an empty text is like nothing else
        return 0.0
    x, y = int(size_a), int(size_b)
    if x == y:
        return max(signature_likeness(one_a, one_b), signature_likeness(two_a, two_b))
    if x == 2 * y:
        return signature_likeness(one_a, two_b)
    if y == 2 * x:
        return signature_likeness(two_a, one_b)
    return 0.0


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every text."""

    def work(block: pa.RecordBatch) -> list:
        return [block.column("doc_id"), pa.array([fingerprint(t) for t in block.column("text").to_pylist()], pa.string())]

    return blocks.map_texts(docs, work, "doc_id bigint, fingerprint string", doc_id=doc_id, text=text)


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_DIGEST = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(doc_id, text: str, own: str, following: str, other: str) -> tuple:
    changed = edited(text, following)
    made = fingerprint(changed)
    sha = hashlib.sha256(changed.encode()).hexdigest()
    return doc_id, len(text), sha, own, made, likeness(own, made), likeness(own, other)


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint against that of its edited text and of the next document.

    The table is dealt out in ranges of doc_id and sorted within them, so the
    next document is the next row. A range's first and last texts are set aside
    (two rows a range) and joined across ranges in a second, small step.
    """
    names = [part.split()[0] for part in _DIGEST.split(", ")]
    schema = f"{_DIGEST}, part int, head boolean, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before = None
        types = [pa.int64(), pa.int64()] + [pa.string()] * 3 + [pa.float64()] * 2 + [pa.int32(), pa.bool_(), pa.string()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [*names, "part", "head", "text"])

        def aside(row, head):
            return (row[0], None, None, row[2], None, None, None, part, head, row[1])

        for block in blocks.blocks(batches):
            rows = []
            for key, body in zip(block.column("doc_id").to_pylist(), block.column("text").to_pylist()):
                now = (key, body or "", fingerprint(body))
                rows.append(aside(now, True) if before is None else (*_compared(*before, *now[1:]), part, None, None))
                before = now
            yield batch(rows)
        if before is not None:
            yield batch([aside(before, False)])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in batches:
            for row in found.to_pylist():
                made = _compared(row["doc_id"], row["text"], row["fingerprint"], row["other"], row["other_fingerprint"])
                yield pa.RecordBatch.from_pylist([dict(zip(names, made))], schema=pa.schema([
                    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]))

    read = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    dealt = read.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    made = stage(dealt.mapInArrow(run, schema), "fingerprints")
    inside = made.filter("head is null").select(names)

    # ranges are few: their order, and what follows each, is one small window without texts
    edge = made.filter("head is not null")
    order = edge.filter("head").select("part").orderBy("part").collect()
    parts = [row.part for row in order]
    links = made.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    tails = edge.filter("not head").select("doc_id", "text", "fingerprint", "part")
    heads = edge.filter("head").select(F.col("part").alias("next"), F.col("text").alias("other"), F.col("fingerprint").alias("other_fingerprint"))
    across = tails.join(links, "part").join(heads, "next").mapInArrow(join, _DIGEST)
    return inside.unionByName(across)
