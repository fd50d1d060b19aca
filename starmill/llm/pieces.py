"""Encoding and decoding with a piece vocabulary, N best segmentations each.

The pieces of a model make a lattice over a text; a segmentation's score is the
sum of its pieces' scores. A forward Viterbi pass gives every position the best
score of reaching it; going backward from the end, that score is the exact
remaining cost, so A* takes the segmentations off its queue in order of score.

Two characters that stand side by side in no piece have none across them, so the
lattice falls apart there: at the beginnings of words, and within a word mostly at its signs.
Every distinct part has its forward pass once, which also tells what its second best
loses, and is remembered; the best of a word are its parts' together, and it loses what the
part that loses least does. A text's N best differ from its best in the N - 1
words that lose least; only these are searched by A*, and their alternatives
put together in order of what they lose. Of words that lose alike those count whose change
gives the least ids: the first ones where it lowers them, then the last ones where it raises them.

A character without a piece becomes the pieces of its UTF-8 bytes, at
``UNKNOWN_STEP`` below the worst score. Scores are sums of floats that are
whole numbers for rank vocabularies, so they are exact there; equal scores are
ordered by the ids of the whole text.

Cases: null text: no segmentation, a row of rank 1 with null ids and score.
Empty text: one segmentation without ids, score 0. Fewer than N segmentations:
all there are. Repeated rows: encoded once each. Null doc_id: returned as null.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterator
from itertools import compress, repeat
from operator import is_, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm import blocks

SPACE = "▁"
UNKNOWN_STEP = 10.0
CACHED_PARTS = 110_000  # of each of two generations
TOGETHER = 40  # characters of a part that is segmented beside others

Segmentation = tuple[float, tuple[int, ...]]
Choice = tuple[float, bytes, float]
DECODED_IDS = 1 << 18  # at once


class Speller:
    """The pieces' bytes, for decoding."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        spelled = [bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(self.names)]
        self._lengths = np.array([len(x) for x in spelled], np.int64)
        self._places = np.cumsum(self._lengths) - self._lengths
        self._letters = np.frombuffer(b"".join(spelled), np.uint8)

    def decode_all(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of many segmentations: those between each two of ``bounds``."""
        lengths = self._lengths[ids]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        letters = self._letters[np.repeat(self._places[ids] - ends[:-1], lengths) + np.arange(ends[-1])].tobytes()
        cuts = ends[bounds].tolist()
        texts = [letters[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]
        return [t[1:] if t.startswith(" ") else t for t in texts]

    def decode(self, ids) -> str:
        """The text of a segmentation."""
        return self.decode_all(np.array(ids, np.int64), np.array([0, len(ids)]))[0]


class Vocabulary(Speller):
    """Pieces, scores and byte pieces of a model file, and N-best search with them."""

    def __init__(self, path: str, cached: int = CACHED_PARTS):
        super().__init__(path)
        model = self.model
        self.bytes: dict[int, int] = {}
        self.ids: dict[str, tuple[int, float]] = {}
        for i, name in enumerate(self.names):
            if model.is_byte(i):
                self.bytes[int(name[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[name] = (i, model.get_score(i))
        self.unknown = min(s for _, s in self.ids.values()) - UNKNOWN_STEP
        if any(SPACE in name.lstrip(SPACE) for name in self.ids):
            raise ValueError("a piece runs across the beginning of a word")
        # every beginning of a piece, with the piece if it is one
        self._begins: dict[str, tuple[float, tuple[int, ...]] | None] = {}
        for name, (i, score) in self.ids.items():
            for end in range(1, len(name)):
                self._begins.setdefault(name[:end], None)
            self._begins[name] = (score, (i,))
        # the same for many words at once: hashes of the beginnings, and the place of the piece each is
        self._longest = max(map(len, self.ids))
        hashes = []
        # of unknown characters those of one byte take part
        single = {chr(b): i for b, i in self.bytes.items() if b < 128 and chr(b) not in self.ids}
        for name in (table := {**dict.fromkeys(single), **self._begins}):
            key = np.zeros(1, np.uint64)
            for letter in name:
                key = blocks.mix(key * np.uint64(31) + np.uint64(ord(letter) + 1))
            hashes.append(key[0])
        self._parts = blocks.Places(np.array(hashes, np.uint64))
        self._piece_of = np.array([own[1][0] if own else single.get(name, -1) for name, own in table.items()], np.int64)
        self._scores = np.array([self.unknown if model.is_byte(i) else model.get_score(i) for i in range(len(self.names))])
        self._letters_known = {name for name in self.ids if len(name) == 1} | set(single)
        # characters with neighbours in pieces by number, 0 for all others, and which stand side by side
        pairs = sorted({name[k : k + 2] for name in self.ids for k in range(len(name) - 1)})
        numbers = {letter: k for k, letter in enumerate(sorted(set("".join(pairs))), 1)}
        self._numbers = np.zeros(0x110000, np.int32)
        self._numbers[[ord(letter) for letter in numbers]] = list(numbers.values())
        self._beside = np.zeros((len(numbers) + 1, len(numbers) + 1), bool)
        for a, b in pairs:
            self._beside[numbers[a], numbers[b]] = True
        self._cached = cached
        self._known: dict[str, Choice] = {}
        self._older: dict[str, Choice] = {}  # parts not met since the last turn go at the next
        self._falling: dict[str, bool] = {}

    def arcs_to(self, word: str, end: int) -> list[tuple[int, float, tuple[int, ...]]]:
        """The arcs that end at a place of the word: (start, score, ids)."""
        found = []
        for start in range(end - 1, max(0, end - self._longest) - 1, -1):
            piece = self.ids.get(word[start:end])
            if piece is not None:
                found.append((start, piece[1], (piece[0],)))
        if word[end - 1] not in self.ids:
            found.append((end - 1, self.unknown, tuple(self.bytes[b] for b in word[end - 1].encode())))
        return found

    def word_nbest(self, word: str, n: int) -> list[Segmentation]:
        """The n best segmentations of one word, best first, equal scores by their ids.

        Of the tails that begin at a place only the n best can be part of the n best,
        so a place is left alone after its n-th visit, and a tail is known by the
        number of its visit. Of a place's arcs each brings the next one onto the queue.
        Equal costs are taken from the end of the word: all tails of one cost
        that begin at a place are then on the queue before the first is taken.
        """
        best = self._forward_pass(word)[0]
        sorted_arcs: dict[int, list] = {}
        # a visit: what its tail scores, the ids of its first arc, the visit behind it
        visits: list[list[tuple]] = [[] for _ in range(len(word) + 1)]
        queue = [(-best[-1], -len(word), 0, 0, 0.0, (), 0, 0)]
        while queue and len(visits[0]) < n:
            minus, at, _, rank, behind, ids, after, which = heapq.heappop(queue)
            at = -at
            if after:  # the next arc that ends where this one does
                arcs = sorted_arcs[after]
                if which + 1 < len(arcs):
                    heapq.heappush(queue, self._entry(arcs, which + 1, best, visits[after][rank][0], after, rank))
            if len(visits[at]) == n:
                continue
            visits[at].append((behind, ids, after, rank))
            if at:
                if at not in sorted_arcs:
                    sorted_arcs[at] = sorted(self.arcs_to(word, at), key=lambda arc: (-(best[arc[0]] + arc[1]), -arc[0]))
                heapq.heappush(queue, self._entry(sorted_arcs[at], 0, best, behind, at, len(visits[at]) - 1))
        found = []
        for rank in range(len(visits[0])):
            score, at, ids = visits[0][rank][0], 0, []
            while at < len(word):
                _, own, after, rank = visits[at][rank]
                ids += own
                at = after
            found.append((score, tuple(ids)))
        return found

    @staticmethod
    def _entry(arcs: list, which: int, best: list[float], behind: float, after: int, rank: int) -> tuple:
        """An arc before a tail on the queue: cost, place, first id and the tail's number settle its turn."""
        start, score, ids = arcs[which]
        return (-(best[start] + score + behind), -start, ids[0], rank, score + behind, ids, after, which)

    def _forward_pass(self, word: str) -> tuple[list, list, list]:
        """For every place the best score of reaching it, what the second arc loses there, and the best arc."""
        size = len(word)
        best = [-math.inf] * (size + 1)
        best[0] = 0.0
        gap = [math.inf] * (size + 1)
        back: list[tuple[int, tuple[int, ...]]] = [(0, ())] * (size + 1)
        begins = self._begins
        for start in range(size):
            base = best[start]
            for end in range(start + 1, size + 1):
                piece = begins.get(word[start:end], ())
                if piece:
                    loss = best[end] - base - piece[0]
                    if loss < 0:
                        best[end], gap[end], back[end] = base + piece[0], -loss, (start, piece[1])
                    elif loss < gap[end]:
                        gap[end] = loss
                elif piece is not None:
                    break
            if word[start] not in self.ids:
                loss = best[start + 1] - base - self.unknown
                if loss < 0:
                    ids = tuple([self.bytes[b] for b in word[start].encode()])
                    best[start + 1], gap[start + 1], back[start + 1] = base + self.unknown, -loss, (start, ids)
                elif loss < gap[start + 1]:
                    gap[start + 1] = loss
        return best, gap, back

    def _forward(self, word: str) -> Choice:
        """The best segmentation, and what the second best loses against it.

        Every segmentation but the best leaves it, seen from the end, at some
        position for another arc; from there the forward scores are exact. So
        the least loss is the least gap between the first and the second arc
        at the positions of the best.
        """
        best, gap, back = self._forward_pass(word)
        at, least, parts = len(word), math.inf, []
        while at:
            least = min(least, gap[at])
            at, ids = back[at]
            parts.append(ids)
        ids = [i for part in reversed(parts) for i in part]
        if least == 0:
            ids = self._least_ids(word)
        return best[len(word)], array("i", ids).tobytes(), least

    def _least_ids(self, word: str) -> list[int]:
        """Of the best segmentations the one with the least ids: the best tails from the end, of equal ones the least first id."""
        size = len(word)
        tail = [-math.inf] * size + [0.0]
        first: list[tuple[int, tuple[int, ...]]] = [(0, ())] * size
        begins = self._begins
        for start in range(size - 1, -1, -1):
            for end in range(start + 1, size + 1):
                piece = begins.get(word[start:end], ())
                if piece:
                    score = piece[0] + tail[end]
                    if score > tail[start] or score == tail[start] and piece[1] < first[start][1]:
                        tail[start], first[start] = score, (end, piece[1])
                elif piece is not None:
                    break
            if word[start] not in self.ids:
                ids = tuple([self.bytes[b] for b in word[start].encode()])
                score = self.unknown + tail[start + 1]
                if score > tail[start] or score == tail[start] and ids < first[start][1]:
                    tail[start], first[start] = score, (start + 1, ids)
        at, found = 0, []
        while at < size:
            at, ids = first[at]
            found += ids
        return found

    def _forward_all(self, words: list[str]) -> Iterator[Choice]:
        """As ``_forward``, for many words of up to ``TOGETHER`` characters whose unknown ones have one byte, side by side.

        The same passes, each step taken for all words at once: pieces are found by
        the hashes of ever longer parts, positions settled in order, and the best
        read back from the ends.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
        first = np.cumsum(sizes) - sizes
        last = np.repeat(first + sizes, sizes)
        at, key = np.arange(len(letters)), np.zeros(len(letters), np.uint64)
        starts, ends, pieces = [], [], []
        for length in range(1, self._longest + 1):
            inside = at + length <= last[at]
            at, key = at[inside], key[inside]
            key = blocks.mix(key * np.uint64(31) + letters[at + (length - 1)] + np.uint64(1))
            row = self._parts.find(key)
            at, key, row = at[row >= 0], key[row >= 0], row[row >= 0]
            piece = self._piece_of[row]
            starts.append(at[piece >= 0])
            ends.append(at[piece >= 0] + length)
            pieces.append(piece[piece >= 0])
        start, end, piece = (np.concatenate(x) for x in (starts, ends, pieces))
        # places of a word: its start and the end of each of its letters
        word = np.repeat(np.arange(len(words)), sizes)[start]
        start, end = start + word, end + word
        base = first + np.arange(len(words))
        turn = np.lexsort((end, end - base[word]))
        start, end, piece, word = start[turn], end[turn], piece[turn], word[turn]
        total = len(letters) + len(words)
        best, gap = np.zeros(total), np.full(total, np.inf)
        back, back_piece = np.zeros(total, np.int64), np.zeros(total, np.int64)
        step = end - base[word]
        bounds = np.searchsorted(step, np.arange(1, int(sizes.max()) + 2))
        for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
            score = best[start[a:b]] + self._scores[piece[a:b]]
            to = end[a:b]
            runs = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            counts = np.diff(np.append(runs, b - a))
            most = np.maximum.reduceat(score, runs)
            hit = np.flatnonzero(score == np.repeat(most, counts))
            own = np.searchsorted(hit, runs)  # the first best arc of each place
            chosen = hit[own]
            place = to[runs]
            best[place], back[place], back_piece[place] = most, start[a:b][chosen], piece[a:b][chosen]
            score[chosen] = -np.inf
            gap[place] = most - np.maximum.reduceat(score, runs)
        at = base + sizes
        least = np.full(len(words), np.inf)
        made: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        live = np.arange(len(words))
        scores = best[at]
        while len(live):
            here = at[live]
            least[live] = np.minimum(least[live], gap[here])
            made.append(back_piece[here])
            owners.append(live)
            at[live] = back[here]
            live = live[at[live] > base[live]]
        owner, flat = np.concatenate(owners[::-1]), np.concatenate(made[::-1])
        turn = np.argsort(owner, kind="stable")
        data = flat[turn].astype(np.int32).tobytes()
        cuts = (4 * np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))])).tolist()
        for k, (name, score, lost) in enumerate(zip(words, scores.tolist(), least.tolist())):
            if lost == 0:  # of equal scores the least ids
                yield score, array("i", self._least_ids(name)).tobytes(), lost
            else:
                yield score, data[cuts[k] : cuts[k + 1]], lost

    def learn(self, parts: list[str]) -> list[Choice]:
        """Every part's best, and what its second choice loses; the more parts at once, the less each costs."""
        if len(self._known) > self._cached:
            self._known, self._older = {}, self._known
        known, older = self._known, self._older
        found = list(map(known.get, parts))
        new = list(compress(range(len(found)), map(is_, found, repeat(None))))
        together = []
        for part in {parts[k] for k in new}:
            if choice := older.get(part):
                known[part] = choice
            elif len(part) <= TOGETHER and self._letters_known.issuperset(part):
                together.append(part)
            else:
                known[part] = self._forward(part)
        if together:
            known.update(zip(together, self._forward_all(together)))
        for k in new:
            found[k] = known[parts[k]]
        return found

    def nbest_bytes(self, text: str, n: int) -> list[tuple[float, bytes]]:
        """The n best segmentations of a text, best first, ids as 32-bit bytes."""
        return next(self.nbest_all([text], n))

    def nbest_all(self, texts: list[str], n: int) -> Iterator[list[tuple[float, bytes]]]:
        """``nbest_bytes`` of many texts; their parts are learned together."""
        spelled = list(map(normal, texts))
        joined = "".join(spelled)
        bounds = np.cumsum([0, *map(len, spelled)])
        letters = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        opens = np.ones(len(letters) + 1, bool)  # a part, and behind the last one
        numbers = self._numbers[letters]
        opens[1:-1] = ~self._beside[numbers[:-1], numbers[1:]]
        opens[bounds] = True
        space = letters == ord(SPACE)
        word_opens = space.copy()
        word_opens[1:] &= ~space[:-1]
        word_opens[bounds[:-1][np.diff(bounds) > 0]] = True
        at, words = np.flatnonzero(opens), np.append(np.flatnonzero(word_opens), len(letters))
        cuts = at.tolist()
        parts = [joined[a:b] for a, b in zip(cuts, cuts[1:])]
        choices = self.learn(parts)
        scores, ids = list(map(itemgetter(0), choices)), list(map(itemgetter(1), choices))
        loss = np.fromiter(map(itemgetter(2), choices), float, len(choices))
        own = np.searchsorted(at, words)  # the first part of each word
        lost = np.minimum.reduceat(loss, own[:-1]) if len(loss) else loss
        for a, b, c, d in zip(*(x.tolist() for k in (np.searchsorted(at, bounds), np.searchsorted(words, bounds)) for x in (k[:-1], k[1:]))):
            leaving = self._leaving(lost[c:d], n - 1, own[c:d] - a, parts[a:b], loss[a:b]) + c
            word = [(joined[words[i] : words[i + 1]], own[i] - a, own[i + 1] - a) for i in leaving]
            yield self._put_together(sum(scores[a:b]), ids[a:b], word, n)

    def _leaving(self, lost: np.ndarray, n: int, own: np.ndarray, parts: list[str], loss: np.ndarray) -> np.ndarray:
        """The places of the n words whose changes come first, in their order in the text; ``own`` is the first part of each."""
        at = self._least(lost, n)
        if len(at) == 0:
            return at
        most = lost[at].max()
        tied, below = np.flatnonzero(lost == most), at[lost[at] < most]
        count = len(at) - len(below)
        if count == len(tied):
            return at
        falling = tied[:0]
        if most:  # a best that is one of several has the least ids, so its changes raise them
            alike = np.flatnonzero(loss == most).tolist()
            down = set(filter(self._falls, {parts[k] for k in alike}))
            if down:
                falling = np.intersect1d(tied, np.searchsorted(own, [k for k in alike if parts[k] in down], "right") - 1)[:count]
        rising = np.setdiff1d(tied, falling)
        return np.sort(np.concatenate([below, falling, rising[len(rising) - count + len(falling) :]]))

    def _falls(self, part: str) -> bool:
        """Whether the part's second best has smaller ids than its best."""
        if part not in self._falling:
            if len(self._falling) >= self._cached:
                self._falling.clear()
            best, second = self.word_nbest(part, 2)
            self._falling[part] = second[1] < best[1]
        return self._falling[part]

    @staticmethod
    def _least(loss: np.ndarray, n: int) -> np.ndarray:
        """The places of the n least that are finite, the first of equal ones; in their order in the text."""
        if n < len(loss):
            bound = np.partition(loss, n - 1)[n - 1] if n else -math.inf
            below = np.flatnonzero(loss < bound)
            at = np.sort(np.append(below, np.flatnonzero(loss == bound)[: n - len(below)]))
        else:
            at = np.arange(len(loss))
        return at[loss[at] < math.inf]

    def _put_together(self, total: float, first: list[bytes], words: list[tuple[str, int, int]], n: int) -> list[tuple[float, bytes]]:
        """The n best of a text from its best and the words in which others differ, each with the places of its parts."""
        every = [self.word_nbest(word, n) for word, _, _ in words]

        def entry(lost: float, ranks: tuple[int, ...]) -> tuple[float, list[tuple[int, ...]], tuple[int, ...]]:
            """What is lost settles the turn, then the ids, from the first word on."""
            return lost, [own[rank][1] for own, rank in zip(every, ranks)], ranks

        queue = [entry(0.0, (0,) * len(words))]
        seen = set()
        made: list[tuple[float, bytes]] = []
        while queue and len(made) < n:
            lost, _, ranks = heapq.heappop(queue)
            if ranks in seen:
                continue
            seen.add(ranks)
            ids = list(first) if any(ranks) else first
            for place, rank in enumerate(ranks):
                if rank:
                    _, a, b = words[place]
                    ids[a:b] = [array("i", every[place][rank][1]).tobytes(), *[b""] * (b - a - 1)]
            made.append((total - lost, b"".join(ids)))
            for place, rank in enumerate(ranks):
                if rank + 1 < len(every[place]):
                    now = (*ranks[:place], rank + 1, *ranks[place + 1 :])
                    heapq.heappush(queue, entry(lost + every[place][rank][0] - every[place][rank + 1][0], now))
        return made

    def nbest(self, text: str, n: int) -> list[Segmentation]:
        """The n best segmentations of a text, best first."""
        return [(score, tuple(np.frombuffer(ids, np.int32).tolist())) for score, ids in self.nbest_bytes(text, n)]


def normal(text: str) -> str:
    """The text as the vocabulary spells it: a mark before the first word and for every space."""
    return (SPACE + text.replace(" ", SPACE)) if text else ""


def encode(docs: DataFrame, model: str, n: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, rank, score, ids): the ``n`` best segmentations of every whole text."""

    def work(block: pa.RecordBatch) -> list:
        vocabulary = blocks.kept(("pieces", model), lambda: Vocabulary(model))
        keys, ranks, scores, ids = [], [], [], []
        texts = block.column("text").to_pylist()
        best = vocabulary.nbest_all([body or "" for body in texts], n)
        for key, body, made in zip(block.column("doc_id").to_pylist(), texts, best):
            if body is None:
                made = [(None, None)]
            keys += [key] * len(made)
            ranks += range(1, len(made) + 1)
            scores += [score for score, _ in made]
            ids += [own for _, own in made]
        ends = np.cumsum([0] + [len(own or b"") // 4 for own in ids]).astype(np.int32)
        lists = pa.ListArray.from_arrays(
            ends, np.frombuffer(b"".join(own or b"" for own in ids), np.int32), mask=pa.array([own is None for own in ids])
        )
        return [pa.array(keys, pa.int64()), pa.array(ranks, pa.int32()), pa.array(scores, pa.float64()), lists]

    return blocks.map_texts(docs, work, "doc_id bigint, rank int, score double, ids array<int>", doc_id=doc_id, text=text)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``text`` for ``ids``; the other columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = blocks.kept(("speller", model), lambda: Speller(model))
        for batch in batches:
            counts = batch.column("__ids").value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(counts)])
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + DECODED_IDS, "right")) - 1)
                part = batch.slice(start, stop - start)
                cells = part.column("__ids")
                texts = speller.decode_all(cells.flatten().to_numpy(zero_copy_only=False), ends[start : stop + 1] - ends[start])
                texts = [None if null else t for null, t in zip(cells.is_null().to_pylist(), texts)]
                kept = [c for c in part.schema.names if c != "__ids"]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(texts, pa.string())], [*kept, "text"])
                start = stop

    rest = [c for c in encoded.columns if c not in ("ids", "text")]
    read = encoded.select(*rest, F.col("ids").alias("__ids"))
    schema = read.drop("__ids").schema.add("text", "string")
    return read.mapInArrow(run, schema)
