"""Packing token sequences by minimum bin slack.

Documents become token ids with an end mark. Whole windows are cut off a
document first; what remains, less than a window, waits in a pool. From the
pool's histogram of lengths, subset sums are kept as the bits of one integer
per length considered, and the multiset of lengths that fills the window
closest to its capacity is traced back with its counts. Every task packs the
documents of its own partition, pool by pool, so nothing is shuffled, and
memory is bounded by the pool.

At the end of a partition the pool no longer fills windows exactly; its rest is
cut at powers of two, the lengths that need no padding.

Cases: null or empty text: the end mark alone. Null doc_id: kept as null.
Repeated rows are packed once each. No row, no sequence. Results depend on the
partitioning of the input (which documents meet), never on chance: a task that
runs again makes the same rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections import Counter, deque
from collections.abc import Iterator
from itertools import compress, repeat
from operator import is_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm import blocks

WINDOW = 4096
END_ID = 2
POOL_TOKENS = 1 << 20
CACHED_WORDS = 400_000  # of each of two generations

SCHEMA = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
_TASK_BITS = 36  # sequences of a task


# What the vocabulary takes apart anyway: letters, single digits and signs, in lower case each a word of its own to it.
# Words with other characters go to it whole.
_SIGNS = re.compile(r"[!-/:-`{-~][!-/:-`{-~]*")  # beginning with one class, it is searched for faster
_DIGIT = re.compile(r"[0-9]")
_ODD = re.compile(r"[^ !-&(-;=-~ªµºÀ-ÖØ-öø-ÿ]")


def _parts(text: str) -> list[str]:
    """The parts of plain words."""
    return _DIGIT.sub(r" \g<0> ", _SIGNS.sub(r" \g<0> ", text.lower())).split()


def _split(text: str) -> list[str]:
    """The parts of a text's plain words, in lower case, and its other words whole; what stands between them is left out."""
    text = text.replace("\n", " ").replace("\t", " ")
    found, done = [], 0
    while odd := _ODD.search(text, done):
        start = max(done, text.rfind(" ", done, odd.start()) + 1)
        found += _parts(text[done:start])
        done = text.find(" ", odd.end())
        if done < 0:
            done = len(text)
        found.append(text[start:done])
    found += _parts(text[done:])
    return found


class WordEncoder:
    """Token ids as little-endian unsigned 32-bit bytes, word by word.

    The vocabulary drops white space between words, so a text's ids are those
    of its words one after another, and those of a plain word are its parts'; what a text is split into is looked up once.
    Parts need neither its normalizer nor its splitting, and are encoded together, their letters
    spelled as it spells their bytes: where a part's last id alone has the vocabulary's
    end-of-word mark, it tells where the next begins.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self._tokenizer = Tokenizer.from_str(json.dumps(settings))
        settings |= {"normalizer": None, "pre_tokenizer": settings["pre_tokenizer"]["pretokenizers"][-1]}
        spell = Tokenizer.from_str(json.dumps(settings)).pre_tokenizer.pre_tokenize_str
        self._spelled = {c: spell(chr(c))[0][0] for c in range(128, 256)}
        self._bare = Tokenizer.from_str(json.dumps(settings | {"pre_tokenizer": None, "added_tokens": []}))
        mark = settings["model"].get("end_of_word_suffix")
        vocabulary = self._bare.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        if mark:
            self._ends[[n for token, n in vocabulary.items() if token.endswith(mark)]] = True
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}  # words not met since the last turn are let go at the next

    def _encode(self, tokenizer, some: list[str]) -> Iterator[tuple[str, bytes]]:
        for word, made in zip(some, tokenizer.encode_batch_fast(some, add_special_tokens=False)):
            yield word, array("I", made.ids).tobytes()

    def _encode_parts(self, parts: list[str]) -> Iterator[tuple[str, bytes]]:
        for k in range(0, len(parts), 10_000):
            some = parts[k : k + 10_000]
            spelled = [part if part.isascii() else part.translate(self._spelled) for part in some]
            made = np.array(self._bare.encode_batch_fast([spelled], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
            ends = ((np.flatnonzero(self._ends[made]) + 1) * 4).tolist()
            if len(ends) != len(some) or ends[-1] != made.nbytes:  # a vocabulary without such marks
                yield from zip(some, [ids for _, ids in self._encode(self._bare, spelled)])
                continue
            ids = made.tobytes()
            yield from zip(some, map(ids.__getitem__, map(slice, [0, *ends], ends)))

    def _learn(self, words: set[str]) -> None:
        known, older = self._known, self._older
        known.update((word, older[word]) for word in words.intersection(older))
        words = words.difference(known)
        whole = [word for word in words if _ODD.search(word)]
        known.update(self._encode_parts(list(words.difference(whole))))
        for k in range(0, len(whole), 10_000):
            known.update(self._encode(self._tokenizer, whole[k : k + 10_000]))

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        if len(self._known) > CACHED_WORDS:
            self._known, self._older = {}, self._known
        split = [_split(t or "") for t in texts]
        found = [list(map(self._known.get, words)) for words in split]
        new = [list(compress(range(len(own)), map(is_, own, repeat(None)))) for own in found]
        self._learn({words[k] for words, places in zip(split, new) for k in places})
        for words, own, places in zip(split, found, new):
            for k in places:
                own[k] = self._known[words[k]]
        return list(map(b"".join, found))


def fill(counts: Counter, capacity: int) -> dict[int, int]:
    """Of the lengths in ``counts``, the multiset with the largest sum up to ``capacity``: length -> how often.

    Bit s of ``reached[k]`` says that some choice among the first k items sums
    to s. A length that occurs c times counts as 1, 2, 4, ... copies, so all
    numbers of it up to c are covered. The search stops at the first exact fill;
    long pieces come first, since they are the hardest to place.
    """
    mask = (1 << (capacity + 1)) - 1
    reached, items = [1], []
    goal = 1 << capacity
    for length in sorted(counts, reverse=True):
        left, copies = min(counts[length], capacity // length), 1
        while left > 0:
            take = min(copies, left)
            left -= take
            copies *= 2
            now = reached[-1] | (reached[-1] << (take * length)) & mask
            if now == reached[-1]:
                continue
            reached.append(now)
            items.append((length, take))
        if reached[-1] & goal:
            break
    total = reached[-1].bit_length() - 1
    chosen: dict[int, int] = {}
    for k in range(len(items), 0, -1):
        length, take = items[k - 1]
        if not reached[k - 1] >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= take * length
    return chosen


class _Pool:
    """Pieces shorter than a window, by length."""

    def __init__(self, window: int):
        self.window, self.tokens, self.by_length = window, 0, {}
        self.counts: Counter = Counter()

    def add(self, piece: tuple) -> None:
        n = len(piece[3]) // 4
        self.by_length.setdefault(n, deque()).append(piece)
        self.counts[n] += 1
        self.tokens += n

    def take(self, length: int) -> tuple:
        queue = self.by_length[length]
        piece = queue.popleft()
        self.counts[length] -= 1
        if not queue:
            del self.by_length[length], self.counts[length]
        self.tokens -= length
        return piece

    def windows(self, until: int) -> Iterator[list[tuple]]:
        """Windows filled exactly, as long as there are more than ``until`` tokens."""
        while self.tokens > until:
            chosen = fill(self.counts, self.window)
            if sum(n * k for n, k in chosen.items()) < self.window:
                return
            times = min(self.counts[n] // k for n, k in chosen.items())
            for _ in range(max(1, times)):
                if self.tokens <= until:
                    return
                yield [self.take(n) for n, k in chosen.items() for _ in range(k)]

    def rest(self) -> Iterator[list[tuple]]:
        """What cannot be filled exactly: windows cut out of the remaining pieces, then powers of two."""
        queue = deque(self.take(n) for n in sorted(self.by_length, reverse=True) for _ in range(self.counts[n]))
        left = sum(len(p[3]) // 4 for p in queue)
        while left:
            size = self.window if left >= self.window else 1 << (left.bit_length() - 1)
            left -= size
            sequence = []
            while size:
                doc_id, start, total, ids = queue.popleft()
                n = min(size, len(ids) // 4)
                sequence.append((doc_id, start, total, ids[: 4 * n]))
                if 4 * n < len(ids):
                    queue.appendleft((doc_id, start + n, total, ids[4 * n :]))
                size -= n
            yield sequence


def pack_documents(docs: Iterator[tuple[int, bytes]], window: int = WINDOW, pool_tokens: int = POOL_TOKENS) -> Iterator[list[tuple]]:
    """Sequences of pieces (doc_id, start, doc_tokens, ids) out of documents (doc_id, ids as bytes)."""
    pool = _Pool(window)
    for doc_id, ids in docs:
        total = len(ids) // 4
        whole = total // window * window
        for start in range(0, whole, window):
            yield [(doc_id, start, total, ids[4 * start : 4 * (start + window)])]
        if whole < total:
            pool.add((doc_id, whole, total, ids[4 * whole :]))
        if pool.tokens > pool_tokens:
            yield from pool.windows(pool_tokens // 2)
            if pool.tokens > pool_tokens:  # lengths that never fill a window exactly
                yield from pool.rest()
    yield from pool.windows(0)
    yield from pool.rest()


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece; ``ids`` holds its token ids, ``sequence_id`` and ``offset`` its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = blocks.kept(("packing", tokenizer), lambda: WordEncoder(tokenizer))
        end = np.array([end_id], "<u4").tobytes()

        def encoded():
            for block in blocks.blocks(batches):
                yield from zip(block.column("doc_id").to_pylist(), (ids + end for ids in encode(block.column("text").to_pylist())))

        number = TaskContext.get().partitionId() << _TASK_BITS
        rows: list[tuple] = []
        held = 0
        for sequence in pack_documents(encoded(), window):
            offset = 0
            for name, start, total, ids in sequence:
                n = len(ids) // 4
                rows.append((name, start, n, total, number, offset, ids))
                offset += n
            number += 1
            held += 4 * offset
            if held > 1 << 22:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)

    read = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return read.mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    types = [pa.int64()] * 6 + [pa.binary()]
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def padding(length: int, window: int = WINDOW) -> int:
    """Tokens of padding behind a sequence; none at a power of two."""
    return 0 if length & (length - 1) == 0 else window - length


def ids_crc32(ids: bytes) -> int:
    return zlib.crc32(ids)
