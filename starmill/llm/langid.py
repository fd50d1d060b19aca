"""Language identification: words first, shorter and shorter character n-grams for the rest.

Training counts the words of every labelled text per language. A word that
the model knows scores its log frequency in each language; an unseen word
falls back to the longest of its character n-grams the model knows at all
(4 characters, then 3, 2, 1), each shorter step paying ``PENALTY``. A text's
language has the largest sum over all its words; ``score`` is its share of
the languages' likelihoods, sharpened by at most ``EVIDENCE`` words.

Counts cover all training texts. The model keeps the ``VOCABULARY`` most
frequent words and ``GRAMS`` n-grams (of equally frequent ones those that sort
first), a fixed size that is sent to the tasks; all further words take the n-gram
path. A language all of whose words are rarer is still one of the model's.

Cases: null text, or a text without letters: ``und``, score 0. Null language:
not a training row. No training rows: everything is ``und``. Ties go to the
language that sorts first. Repeated rows count, and are scored, once each.
Null doc_id: scored, and returned with a null doc_id.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from starmill.llm import blocks
from starmill.scratch import stage

VOCABULARY = 100_000
GRAMS = 50_000
LONGEST = 4
PENALTY = math.log(0.4)
EVIDENCE = 12
UNKNOWN = "und"
CACHED_WORDS = 200_000
_FLUSH = 200_000  # counted words a task holds

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """The letter runs in lower case; empty if there is no letter."""
    words = _WORD.findall((text or "").lower())
    return words if any(c.isalpha() for w in words for c in w) else []


class Model(NamedTuple):
    languages: list[str]
    words: list[str]
    word_scores: np.ndarray  # log frequencies, words x languages
    grams: list[str]
    gram_scores: np.ndarray


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(word, lang, n) over all rows; counted within tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        held = 0

        def flush():
            for name, found in counts.items():
                keys = list(found)
                for k in range(0, len(keys), 50_000):
                    part = keys[k : k + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part), pa.array([name] * len(part)), pa.array([found[w] for w in part], pa.int64())],
                        ["word", "lang", "n"],
                    )

        for block in blocks.blocks(batches):
            for body, name in zip(block.column("text").to_pylist(), block.column("lang").to_pylist()):
                counts.setdefault(name, Counter()).update(words_of(body))
            held = sum(map(len, counts.values()))
            if held > _FLUSH:
                yield from flush()
                counts.clear()
        yield from flush()

    labelled = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text is not null and lang is not null")
    return labelled.mapInArrow(run, "word string, lang string, n bigint").groupBy("word", "lang").agg(F.sum("n").alias("n"))


_STEPS = 64  # of a frequency scale, per doubling


def most_frequent(counts: DataFrame, most: int, name: str) -> DataFrame:
    """The ``most`` rows with the largest ``n``, of equal ones those whose ``name`` sorts first.

    A histogram of log2(n) in steps, of some thousand rows at any size of the
    table, shows from which step on the rows are few enough. Those go whole, and only the
    step that does not fit is sorted; no task sorts or sends more than the rows taken.
    """
    step = F.floor(F.log2("n") * _STEPS)
    rows = counts.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).orderBy(F.desc("step")).collect()
    taken, whole = 0, None
    for row in rows:
        if taken + row.rows > most:
            part = counts.filter(step == row.step).orderBy(F.desc("n"), name).limit(most - taken)
            return part if whole is None else counts.filter(step >= whole).unionByName(part)
        taken, whole = taken + row.rows, row.step
    return counts


def _gram_column(size: int):
    padded = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    return F.transform(F.sequence(F.lit(1), F.length(padded) - size + 1), lambda i: F.substring(padded, i, size))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", vocabulary: int = VOCABULARY, grams: int = GRAMS) -> Model:
    """The model; only tables of at most ``vocabulary`` and ``grams`` rows reach the driver."""
    per_word = (
        word_counts(docs, text, lang).groupBy("word")
        .agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
    )
    per_word = stage(per_word, "word-counts")  # read for words and for n-grams
    top = sorted(most_frequent(per_word, vocabulary, "word").collect(), key=lambda r: (-r.n, r.word))
    # an n-gram longer than its padded word does not exist
    sizes = [
        F.when(F.length("word") + 2 >= size, _gram_column(size)).otherwise(F.array().cast("array<string>"))
        for size in range(1, LONGEST + 1)
    ]
    pieces = (
        per_word.select("by", F.explode(F.concat(*sizes)).alias("gram"))
        .select("gram", F.explode("by").alias("lang", "n"))
    )
    per_gram = (
        pieces.groupBy("gram", "lang").agg(F.sum("n").alias("n")).groupBy("gram")
        .agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
    )
    top_grams = sorted(most_frequent(stage(per_gram, "gram-counts"), grams, "gram").collect(), key=lambda r: (-r.n, r.gram))
    # all that have words, whether or not any of these is among the most frequent
    languages = sorted(r.lang for r in per_word.select(F.explode(F.map_keys("by")).alias("lang")).distinct().collect())
    names = {name: i for i, name in enumerate(languages)}

    def scores(rows, groups) -> np.ndarray:
        table = np.full((len(rows), len(languages)), 0.1)
        for k, row in enumerate(rows):
            for name, n in row.by.items():
                table[k, names[name]] += n
        # frequencies among words, or among n-grams of one length
        for group in groups:
            table[group] /= table[group].sum(axis=0, keepdims=True)
        return np.log(table).astype(np.float32)

    lengths = np.array([len(row.gram) for row in top_grams])
    groups = [np.flatnonzero(lengths == size) for size in range(1, LONGEST + 1)]
    return Model(
        languages,
        [row.word for row in top],
        scores(top, [slice(None)] if top else []),
        [row.gram for row in top_grams],
        scores(top_grams, [g for g in groups if len(g)]),
    )


class Scorer:
    """Log scores of words, known or backed off."""

    def __init__(self, model: Model, cached: int = CACHED_WORDS):
        self.model = model
        self._fixed = len(model.words)
        self._rows = dict(zip(model.words, range(self._fixed)))
        self._grams = dict(zip(model.grams, range(len(model.grams))))
        self._cached = cached
        self._table = np.concatenate([model.word_scores, np.zeros((cached, len(model.languages)), np.float32)])

    def back_off(self, word: str) -> np.ndarray:
        """The mean score of the word's longest known n-grams."""
        padded = f"^{word}$"
        penalty = 0.0
        for size in range(LONGEST, 0, -1):
            penalty += PENALTY
            rows = [r for i in range(len(padded) - size + 1) if (r := self._grams.get(padded[i : i + size])) is not None]
            if rows:
                return self.model.gram_scores[rows].mean(axis=0) + penalty
        return np.zeros(len(self.model.languages), np.float32)

    def rows(self, words: list[str]) -> np.ndarray:
        """The words' rows in the table; new words are scored and remembered."""
        known = self._rows
        for word in set(words).difference(known):
            if len(known) == self._fixed + self._cached:
                self._rows = known = dict(zip(self.model.words, range(self._fixed)))
                return self.rows(words)
            self._table[len(known)] = self.back_off(word)
            known[word] = len(known)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.model.languages:
            return UNKNOWN, 0.0
        total = np.zeros(len(self.model.languages))
        for k in range(0, len(words), 100_000):
            total += self._table[self.rows(words[k : k + 100_000])].sum(axis=0, dtype=np.float64)
        best = int(total.argmax())
        shares = np.exp((total - total[best]) * min(1.0, EVIDENCE / len(words)))
        return self.model.languages[best], float(1.0 / shares.sum())


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of bounded size
    scorer: list[Scorer] = []

    def work(block: pa.RecordBatch) -> list:
        if not scorer:
            scorer.append(Scorer(shared.value))
        found = [scorer[0].predict(t) for t in block.column("text").to_pylist()]
        return [block.column("doc_id"), pa.array([n for n, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]

    return blocks.map_texts(docs, work, "doc_id bigint, lang_pred string, score double", doc_id=doc_id, text=text)


def annotate(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with columns ``lang_pred`` and ``score`` (replaced where they exist); no row moves."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of bounded size
    rest = docs.drop("lang_pred", "score")
    place = rest.columns.index(text)
    scorer: list[Scorer] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not scorer:
            scorer.append(Scorer(shared.value))
        for block in blocks.blocks(batches, text=place):
            found = [scorer[0].predict(t) for t in block.column(place).to_pylist()]
            made = [pa.array([n for n, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*block.columns, *made], [*block.schema.names, "lang_pred", "score"])

    schema = StructType([*rest.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rest.mapInArrow(run, schema)
