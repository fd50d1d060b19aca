"""Secret scans: patterns propose, a random forest removes the false ones.

Patterns find candidates: values assigned to a credential's name, key formats,
private key blocks, and any opaque run of 20 characters or more. For each, the
forest sees its length, its character transitions (changes of class, and the
log probability of its letter pairs among dictionary words), the share that
dictionary words cover, its path, and the words beside it. It is trained from
labelled findings, at most ``TRAIN_ROWS`` of each label.

Where nobody has labelled findings, ``planted`` makes some whose label is known
because they were put there: into ``PLANTED`` snippets of the corpus, chosen by
hash, it writes freshly drawn credentials of many forms (secrets) or what resembles them
(checksums, file names, placeholders, references to variables, long words). One of
``HELD_OUT`` snippets is kept from training; ``measure`` tells precision and recall on those.

Cases: null or empty text: no candidates. Null path: an empty one. No labelled
findings, or of one label only: the forest gives that label (0 without any).
No text of the corpus is longer than a few words: snippets are what there is.
Repeated rows give their candidates once each. Null doc_id: returned as null.
Overlapping candidates: the one that starts first, then the longer one.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm import blocks
from starmill.llm.langid import most_frequent, word_counts
from starmill.scratch import stage

TRAIN_ROWS = 5_000  # of each label
PLANTED = 8_000  # snippets of the corpus with a planted finding
SNIPPET = 240  # characters
TIMES = 50  # a snippet of a small corpus is used
HELD_OUT = 4  # one of so many snippets measures
DICTIONARY = 20_000  # words, the most frequent of three letters or more
TREES = 20
DEPTH = 6
LEAST_SCORE = 0.5
MARK = "[SECRET]"

_NAMES = r"token|secret|passwd|password|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth[_-]?key"
_BEGIN = re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----")
_END = re.compile(r"-----END [A-Z ]{0,30}PRIVATE KEY-----")
_FORMAT = re.compile(
    r"\b(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abp]-[A-Za-z0-9-]{10,})|(?<![\w-])eyJ[\w-]{8,}+\.[\w-]{8,}+\.[\w-]{8,}"
)
_RULES = (
    ("format", _FORMAT),
    ("assigned", re.compile(rf"(?i:{_NAMES})[\w.-]{{0,40}}\s{{0,3}}[:=]\s{{0,3}}[\"']?(?P<value>[^\s\"']{{8,}})")),
    ("opaque", re.compile(r"[A-Za-z0-9+/=_-]{20,}")),
)
_NAMED = re.compile(rf"(?i:{_NAMES})")
_DUMMY = re.compile(r"(?i)example|sample|dummy|changeme|placeholder|your[_-]|xxxx|test")
_PATH = re.compile(r"(?i)test|example|sample|fixture|mock|docs?/")
_BESIDE = 40  # characters looked at on each side

FEATURES = (
    "length", "digits", "upper", "distinct", "class_changes", "pair_log_probability", "dictionary",
    "path_of_samples", "named_before", "assigned", "quoted", "dummy", "words_beside", "key_format",
)


class Context(NamedTuple):
    """What features need of the corpus; of fixed size."""

    words: frozenset[str]
    pairs: np.ndarray  # log probabilities of letter pairs, 27 x 27, the last for all else


def _letters(text: str) -> np.ndarray:
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32).astype(np.int64) - 97
    return np.where((codes >= 0) & (codes < 26), codes, 26)


def context(docs: DataFrame, text: str = "text", size: int = DICTIONARY) -> Context:
    """Counted over all texts; ``size`` words come to the driver."""
    counts = word_counts(docs.select(F.col(text).alias("text"), F.lit("").alias("lang"))).filter(F.length("word") >= 3)
    rows = most_frequent(stage(counts.select("word", "n"), "word-counts"), size, "word").collect()
    pairs = np.ones((27, 27))
    for row in rows:
        codes = _letters(row.word)
        np.add.at(pairs, (codes[:-1], codes[1:]), row.n)
    return Context(frozenset(row.word for row in rows), np.log(pairs / pairs.sum(axis=1, keepdims=True)))


def _blocks(text: str) -> Iterator[tuple[int, int, str]]:
    """Private key blocks, from a header to the first end mark behind it."""
    at = 0
    while (begin := _BEGIN.search(text, at)) and (end := _END.search(text, begin.end())):
        at = end.end()
        yield begin.start(), at, "block"


def candidates(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, rule) in code points, in order and without overlap."""
    text = text or ""
    found = list(_blocks(text))
    for rule, pattern in _RULES:
        group = "value" if rule == "assigned" else 0
        found += [(m.start(group), m.end(group), rule) for m in pattern.finditer(text)]
    rank = {rule: i for i, rule in enumerate(("block", *(rule for rule, _ in _RULES)))}
    found.sort(key=lambda c: (c[0], -c[1], rank[c[2]]))
    kept: list[tuple[int, int, str]] = []
    for one in found:
        if not kept or one[0] >= kept[-1][1]:
            kept.append(one)
    return kept


def _covered(value: str, words: frozenset[str]) -> float:
    """The share of the value that dictionary words cover, longest first from the left."""
    low, at, total = value.lower(), 0, 0
    while at < len(low) - 2:
        for end in range(min(len(low), at + 12), at + 2, -1):
            if low[at:end] in words:
                total += end - at
                at = end
                break
        else:
            at += 1
    return total / len(low)


def features(text: str, start: int, end: int, path: str, known: Context) -> list[float]:
    value = text[start:end]
    before, after = text[max(0, start - _BESIDE) : start], text[end : end + _BESIDE]
    n = len(value)
    kinds = [0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3 for c in value]
    codes = _letters(value)
    pairs = known.pairs[codes[:-1], codes[1:]].mean() if n > 1 else 0.0
    bare = before.rstrip(" \"'")
    beside = re.findall(r"\w+", before + " " + after)
    return [
        math.log(end - start),
        kinds.count(0) / n,
        kinds.count(1) / n,
        len(set(value)) / n,
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n,
        float(pairs),
        _covered(value, known.words),
        float(bool(_PATH.search(path))),
        float(bool(_NAMED.search(before))),
        float(bare.endswith(("=", ":"))),
        float(before.endswith(('"', "'")) and after.startswith(('"', "'"))),
        float(bool(_DUMMY.search(value) or _DUMMY.search(before))),
        sum(w.lower() in known.words for w in beside) / max(1, len(beside)),
        float(bool(_FORMAT.fullmatch(value) or _BEGIN.match(value))),
    ]


# Names that credentials and other values go by where findings are planted.
_CREDENTIALS = ("token", "secret", "password", "api_key", "access_key", "client_secret", "auth_key", "db_passwd", "private_key", "api-key")
_OTHERS = ("checksum", "commit", "sha256", "etag", "build", "file", "session", "id", "ref", "digest", "version", "path")
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_BASE64 = _LETTERS + _LETTERS.upper() + "0123456789+/"


def _drawn(draw: random.Random, letters: str, least: int, most: int) -> str:
    return "".join(draw.choices(letters, k=draw.randint(least, most)))


def _planted_secret(draw: random.Random, words: list[str]) -> tuple[str, str]:
    """(text, the secret in it)."""
    alphabet = draw.choice(["0123456789abcdef", _LETTERS + "0123456789", _BASE64, _BASE64 + "!#%&*-_"])
    value = _drawn(draw, alphabet, 12, 48)
    form = draw.randrange(8)
    if form == 0:
        value = draw.choice(["AKIA", "ASIA"]) + _drawn(draw, _LETTERS.upper() + "0123456789", 16, 16)
        return draw.choice([value, f"key {value}", f'"{value}"']), value
    if form == 1:
        value = draw.choice(["ghp_", "gho_", "ghs_"]) + _drawn(draw, _BASE64[:62], 36, 40)
        return draw.choice([value, f"use {value} here"]), value
    if form == 2:
        value = "eyJ" + ".".join(_drawn(draw, _BASE64[:62], 15, 40) for _ in range(3))
        return draw.choice([value, f"Bearer {value}"]), value
    if form == 3:
        value = "-----BEGIN RSA PRIVATE KEY-----\n" + _drawn(draw, _BASE64, 60, 200) + "\n-----END RSA PRIVATE KEY-----"
        return value, value
    name, sign = draw.choice(_CREDENTIALS), draw.choice([" = ", "=", ": ", ":"])
    quote = draw.choice(['"', "'", ""])
    return f"{name}{sign}{quote}{value}{quote}", value


def _planted_other(draw: random.Random, words: list[str]) -> tuple[str, str]:
    """(text, what resembles a secret in it)."""
    some = lambda least, most, sign: sign.join(draw.choices(words or ["word"], k=draw.randint(least, most)))
    form = draw.randrange(8)
    if form == 0:  # a checksum, named as one or not at all
        value = _drawn(draw, "0123456789abcdef", 32, 64)
        return draw.choice([f"{draw.choice(_OTHERS)} {value}", f"{draw.choice(_OTHERS)}: {value}", value]), value
    if form == 1:  # a placeholder
        name = draw.choice(_CREDENTIALS)
        value = draw.choice([f"your_{name}_here", f"<{name}-goes-here>", "xxxxxxxxxxxxxxxx", "changeme-please", f"example_{name}", "****************"])
        return f'{name} = "{value}"', value
    if form == 2:  # a reference
        name = draw.choice(_CREDENTIALS)
        value = draw.choice([f"${{{name.upper()}}}", f"os.environ[{name}]", f"config.{name}.value", f"get_{name}()", f"settings.{name}"])
        return f"{name}{draw.choice([' = ', ': ', '='])}{value}", value
    if form == 3:  # words after a credential's name
        value = some(1, 1, "")
        value = value if len(value) >= 8 else some(3, 4, draw.choice("_-"))
        return f"{draw.choice(_CREDENTIALS)}: {value}", value
    if form == 4:  # a path
        value = "/" + some(4, 7, "/") + draw.choice([".html", ".png", "", "/index"])
        return draw.choice(["see ", "", "href="]) + value, value
    if form == 5:  # words without blanks
        value = some(4, 7, draw.choice(["", "_", "-"]))
        return value, value
    if form == 6:  # an identifier
        value = "-".join(_drawn(draw, "0123456789abcdef", n, n) for n in (8, 4, 4, 4, 12))
        return draw.choice([f"id {value}", f"/{draw.choice(_OTHERS)}/{value}", value]), value
    value = draw.choice("=-_") * draw.randint(20, 60)  # a rule
    return value, value


def planted(
    docs: DataFrame, known: Context, rows: int = PLANTED, doc_id: str = "doc_id", text: str = "text", path: str = "source"
) -> DataFrame:
    """(label, held_out, kind, features): about ``rows`` findings put into snippets of the texts, half of them secrets.

    Only the snippets are moved: the least by hash, cut out of the texts where they are read. So
    that no task sends more than its share, hashes beyond twice that share are left out first.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)  # of bounded size
    body = F.col(text).cast("string")
    place = F.xxhash64(F.col(doc_id), body)  # copies of a text have places of their own
    texts = max(1, docs.count())
    share, times = min(1.0, 2 * rows / texts), max(1, min(TIMES, rows // texts))
    start = F.pmod(place, F.greatest(F.length(body) - SNIPPET, F.lit(1))).cast("int") + 1
    snippets = (
        docs.filter(F.pmod(place, F.lit(1 << 40)) <= int(share * (1 << 40))).filter(F.length(body) > 0)
        .select(F.substring(body, start, F.lit(SNIPPET)).alias("text"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), place.alias("seed"))
        .orderBy(F.xxhash64("seed"), "seed", "path").limit(rows)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sorted(shared.value.words)
        for batch in batches:
            made = []
            for body, path, seed in zip(*(batch.column(c).to_pylist() for c in ("text", "path", "seed"))):
                draw = random.Random(seed)
                held_out = draw.randrange(HELD_OUT) == 0
                for _ in range(times):
                    label = draw.randrange(2)
                    put, value = (_planted_secret if label else _planted_other)(draw, words)
                    at = body.rfind(" ", 0, draw.randint(0, len(body)) + 1) + 1
                    whole = f"{body[:at]} {put} {body[at:]}"
                    first = at + 1 + put.index(value)
                    for start, end, rule in candidates(whole):
                        if start < first + len(value) and first < end:
                            made.append((label, held_out, rule, features(whole, start, end, path, shared.value)))
            columns = list(zip(*made)) or [()] * 4
            types = [pa.int32(), pa.bool_(), pa.string(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["label", "held_out", "kind", "features"])

    made = snippets.coalesce(1).mapInArrow(run, "label int, held_out boolean, kind string, features array<double>")
    return stage(made, "planted")


def findings(docs: DataFrame, known: Context, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(doc_id, start, end, rule, features): every candidate."""
    shared = docs.sparkSession.sparkContext.broadcast(known)  # of bounded size

    def work(block: pa.RecordBatch) -> list:
        rows = []
        columns = (block.column(c).to_pylist() for c in ("doc_id", "text", "path"))
        for key, body, place in zip(*columns):
            for start, end, rule in candidates(body):
                rows.append((key, start, end, rule, features(body, start, end, place or "", shared.value)))
        columns = list(zip(*rows)) or [()] * 5
        types = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.float64())]
        return [pa.array(c, t) for c, t in zip(columns, types)]

    schema = "doc_id bigint, start bigint, end bigint, rule string, features array<double>"
    return blocks.map_texts(docs, work, schema, F.col(path).cast("string").alias("path"), doc_id=doc_id, text=text)


class Forest(NamedTuple):
    """Trees as arrays: at a node the feature, the threshold and both children, or at a leaf (feature -1) the chance of a secret."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        for feature, least, left, right, chance in self.trees:
            at = np.zeros(len(rows), np.int64)
            while (inner := feature[at] >= 0).any():
                low = rows[np.arange(len(rows)), np.maximum(feature[at], 0)] <= least[at]
                at = np.where(inner, np.where(low, left[at], right[at]), at)
            total += chance[at]
        return total / len(self.trees)


def _constant(chance: float) -> Forest:
    one = np.zeros(1, np.int64)
    return Forest([(one - 1, np.zeros(1), one, one, np.array([chance]))])


def _tree(root) -> tuple:
    nodes: list[list] = []

    def walk(node) -> int:
        here = len(nodes)
        nodes.append([-1, 0.0, 0, 0, 0.0])
        if node.subtreeDepth() > 0:
            nodes[here][:2] = [node.split().featureIndex(), node.split().threshold()]
            nodes[here][2] = walk(node.leftChild())
            nodes[here][3] = walk(node.rightChild())
        else:
            stats = list(node.impurityStats().stats())
            nodes[here][4] = stats[1] / sum(stats)
        return here

    walk(root)
    kinds = (np.int64, float, np.int64, np.int64, float)
    return tuple(np.array(c, k) for c, k in zip(zip(*nodes), kinds))


def train(labelled: DataFrame, rows: int = TRAIN_ROWS, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """A forest from labelled findings (label 0 or 1, features), at most ``rows`` of each label."""
    order = F.xxhash64("features")
    parts = [labelled.filter(F.col("label") == k).select("label", "features").orderBy(order).limit(rows) for k in (0, 1)]
    sample = parts[0].unionByName(parts[1]).toPandas()
    seen = sorted(set(sample.label))
    if len(seen) < 2:
        return _constant(float(seen[0]) if seen else 0.0)
    # at most 2 * rows rows, in one order and one partition: the same trees every time
    data = labelled.sparkSession.createDataFrame(
        [(float(label), [float(x) for x in f]) for label, f in zip(sample.label, sample.features)], "label double, features array<double>"
    ).coalesce(1)
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, subsamplingRate=0.8).fit(
        data.select("label", array_to_vector("features").alias("features"))
    )
    return Forest([_tree(t._call_java("rootNode")) for t in model.trees])


def measure(labelled: DataFrame, forest: Forest, least: float = LEAST_SCORE) -> tuple[float, float]:
    """Precision and recall on labelled findings, a bounded number of them."""
    rows = labelled.select("label", "features").toPandas()
    if not len(rows):
        return 1.0, 1.0
    said = forest.scores(np.array([list(f) for f in rows.features])) >= least
    true = rows.label.to_numpy() == 1
    both = int((said & true).sum())
    return both / max(1, int(said.sum())), both / max(1, int(true.sum()))


def score(found: DataFrame, forest: Forest, least: float = LEAST_SCORE) -> DataFrame:
    """(doc_id, start, end, rule, score, secret) of findings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("features").flatten().to_numpy(zero_copy_only=False)
            made = forest.scores(flat.reshape(-1, len(FEATURES)))
            columns = [batch.column(c) for c in ("doc_id", "start", "end", "rule")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(made), pa.array(made >= least)], ["doc_id", "start", "end", "rule", "score", "secret"])

    schema = "doc_id bigint, start bigint, end bigint, rule string, score double, secret boolean"
    return found.select("doc_id", "start", "end", "rule", "features").mapInArrow(run, schema)


def redact(docs: DataFrame, known: Context, forest: Forest, text: str = "text", path: str = "source", least: float = LEAST_SCORE) -> DataFrame:
    """``docs`` with every secret replaced by ``MARK``; all columns and rows stay."""
    shared = docs.sparkSession.sparkContext.broadcast((known, forest))
    place = docs.columns.index(text)

    def clean(body: str | None, where: str | None) -> str | None:
        spans = candidates(body)
        if not spans:
            return body
        known, forest = shared.value
        rows = np.array([features(body, s, e, where or "", known) for s, e, _ in spans])
        for (start, end, _), chance in reversed(list(zip(spans, forest.scores(rows)))):
            if chance >= least:
                body = body[:start] + MARK + body[end:]
        return body

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks.blocks(batches, text=place):
            made = [clean(b, p) for b, p in zip(block.column(place).to_pylist(), block.column(path).to_pylist())]
            columns = [pa.array(made, pa.string()) if i == place else c for i, c in enumerate(block.columns)]
            yield pa.RecordBatch.from_arrays(columns, block.schema.names)

    return docs.mapInArrow(run, docs.schema)
