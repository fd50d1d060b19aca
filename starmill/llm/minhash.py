"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes gives two values of the signature, its
minimum and its maximum: 64 permutations make 128 values, banded 32 times 4.
Two documents of similarity 0.8 miss every band with a chance below 1e-7.

1. One scan makes the bands, the set size and a digest of the set. Documents
   with equal sets become one class; only its least doc_id goes on.
2. Each bucket links its members to one of them, the one that has the most
   neighbours; that is a pair per member, not a pair per two members.
3. Pairs are confirmed on the full sets, and joined to components.
4. Buckets that still hold several components are compared in blocks of
   members: all those outside the bucket's largest component against all. A
   block holds bands, and of every set the low 16 bits of its hashes. What two
   sets share of these is never less than what they share, so a pair below the
   similarity by that measure cannot be a link. A pair is looked at if it
   shares ``shared`` bands, at the first of them; what is left of it leaves the
   block and is confirmed too. Pairs within one component change nothing.

Nothing is capped: any two documents that share bands are in one component,
or compared.

Cases: null or empty text, or no words: no shingles, no link, kept. Fewer words
than a shingle: the whole sequence is the only shingle. Repeated rows with one
doc_id are one document; rows of one doc_id with different texts as well, which links
what any of them is like; a row without words stands for itself. Null doc_id: the row comes back with a null
component_id and is kept. Ties go to the smaller doc_id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm import blocks
from starmill.llm.graph import components
from starmill.scratch import stage

BANDS = 32
ROWS = 4  # values of a band: minimum and maximum of two permutations
CELL_BYTES = 1 << 20  # bands and outlines of a bucket's members that are compared at once, on each side

_random = np.random.default_rng(4711)
_FACTORS = _random.integers(1, 1 << 63, BANDS * ROWS // 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _random.integers(0, 1 << 64, BANDS * ROWS // 2, dtype=np.uint64)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text (A-Z lower-cased)."""
    words = blocks.tokens(texts, letters=blocks.LOWER)
    hashes, at = blocks.grams(words, size)
    bounds = blocks.per_text(words, at)
    sets = []
    for i in range(len(texts)):
        if bounds[i] < bounds[i + 1]:
            sets.append(np.unique(hashes[bounds[i] : bounds[i + 1]]))
        else:
            few = words.hashes[words.first[i] : words.first[i + 1]]
            whole = hashlib.blake2b(few.tobytes(), digest_size=8).digest()
            sets.append(np.frombuffer(whole, np.uint64) if len(few) else np.zeros(0, np.uint64))
    return sets


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """The band hashes (documents x BANDS) of non-empty sets."""
    values = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    made = np.empty((len(sets), BANDS), np.uint64)
    moved = np.empty_like(values)
    for band in range(BANDS):
        key = np.full(len(sets), band + 1, np.uint64)
        for k in range(band * ROWS // 2, (band + 1) * ROWS // 2):
            np.multiply(values, _FACTORS[k], out=moved)
            np.add(moved, _TERMS[k], out=moved)
            key = blocks.mix(key * np.uint64(31) + np.minimum.reduceat(moved, starts))
            key = blocks.mix(key * np.uint64(31) + np.maximum.reduceat(moved, starts))
        made[:, band] = key
    return made


def signatures(docs: DataFrame, size: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, digest, bands, text_hash); digest and bands are null for an empty set."""

    def work(block: pa.RecordBatch) -> list:
        sets = shingle_sets(block.column("text"), size)
        filled = [i for i, s in enumerate(sets) if len(s)]
        digests: list = [None] * len(sets)
        rows: list = [None] * len(sets)
        if filled:
            for i, row in zip(filled, bands([sets[i] for i in filled]).view(np.int64)):
                digests[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                rows[i] = row
        return [
            block.column("doc_id"),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array(digests, pa.binary()),
            pa.array(rows, pa.list_(pa.int64())),
            block.column("text_hash"),
        ]

    schema = "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>, text_hash bigint"
    return blocks.map_texts(docs, work, schema, _text_hash(text), doc_id=doc_id, text=text)


def _text_hash(text: str) -> Column:
    return F.xxhash64(F.col(text).cast("string")).alias("text_hash")


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (x, y) whose sets overlap by ``percent`` of their union."""

    def work(batches):
        kept: dict[int, np.ndarray] = {}  # the y of many pairs is the same
        for batch in batches:
            for part in blocks.blocks(iter([batch])):
                x, y = part.column("x"), part.column("y")
                new = [i for i, k in enumerate(y.to_pylist()) if k not in kept]
                fresh: dict[int, int] = {y[i].as_py(): i for i in new}
                if fresh:
                    order = list(fresh.values())
                    kept.update(zip(fresh, shingle_sets(part.column("other").take(pa.array(order)), size)))
                ok = []
                for mine, k in zip(shingle_sets(part.column("text"), size), y.to_pylist()):
                    other = kept[k]
                    both = len(np.intersect1d(mine, other, assume_unique=True))
                    ok.append(bool(both) and 100 * both >= percent * (len(mine) + len(other) - both))
                yield pa.RecordBatch.from_arrays([x, y], ["x", "y"]).filter(pa.array(ok))
                while len(kept) > 256:
                    kept.pop(next(iter(kept)))

    left = texts.select(F.col("doc_id").alias("x"), "text")
    right = texts.select(F.col("doc_id").alias("y"), F.col("text").alias("other"))
    return pairs.join(left, "x").join(right, "y").select("x", "y", "text", "other").mapInArrow(work, "x bigint, y bigint")


def _alike(a: str, b: str, percent: int):
    """Set sizes between which the similarity can be reached."""
    return (F.col(a) * percent <= F.col(b) * 100) & (F.col(b) * percent <= F.col(a) * 100)


def _outlines(texts: DataFrame, size: int) -> DataFrame:
    """(doc_id, outline): the low 16 bits of every shingle hash, sorted, as bytes."""

    def work(block: pa.RecordBatch) -> list:
        sets = shingle_sets(block.column("text"), size)
        return [block.column("doc_id"), pa.array([np.sort((s & np.uint64(0xFFFF)).astype("<u2")).tobytes() for s in sets], pa.binary())]

    return blocks.map_texts(texts, work, "doc_id bigint, outline binary")


def _numbered(outlines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All values, equal ones within an outline told apart by their number, and the bounds of each outline."""
    bounds = np.cumsum([0] + [len(o) // 2 for o in outlines])
    values = np.frombuffer(b"".join(outlines), "<u2").astype(np.int64)
    place = np.arange(len(values))
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[bounds[:-1][bounds[:-1] < len(values)]] = True
    return values + (place - np.maximum.accumulate(np.where(new, place, 0)) << 16), bounds


def _block_pairs(mixed: DataFrame, percent: int, shared: int) -> DataFrame:
    """Pairs (x, y) of one bucket and two components, x outside the bucket's largest, that may be links.

    ``mixed``: (key, doc_id, n_shingles, bands, outline, component_id, largest, total, outside), the last
    two in bytes. A side of a cell holds about ``CELL_BYTES``, however long the texts are.
    """
    cells = mixed.withColumns(
        {
            "rows": F.ceil(F.col("outside") / CELL_BYTES).cast("int"),
            "columns": F.ceil(F.col("total") / CELL_BYTES).cast("int"),
        }
    )
    packed = F.struct("doc_id", "n_shingles", "component_id", "bands", "outline")
    dealt = F.abs(F.xxhash64("doc_id", F.lit("cell")))
    left = (
        cells.filter("component_id <> largest")
        .withColumn("i", (dealt % F.col("rows")).cast("int"))
        .groupBy("key", "i").agg(F.collect_list(packed).alias("left"), F.first("columns").alias("columns"))
        .select("key", "i", F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("j"), "left")
    )
    right = (
        cells.withColumn("j", (dealt % F.col("columns")).cast("int"))
        .groupBy("key", "j").agg(F.collect_list(packed).alias("right"), F.first("rows").alias("rows"))
        .select("key", "j", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), "right")
    )

    def columns(cell: pa.Array) -> tuple:
        flat = cell.flatten()
        rows = flat.field("bands").flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS)
        named = tuple(flat.field(n).to_numpy(zero_copy_only=False) for n in ("doc_id", "n_shingles", "component_id"))
        return (*named, rows, flat.field("outline").to_pylist())

    def compare(key: int, left: pa.Array, right: pa.Array) -> tuple[list, list]:
        a, na, ca, ba, oa = columns(left)
        b, nb, cb, bb, ob = columns(right)
        values, bounds = _numbered(ob)
        x, y = [], []
        for k in range(len(a)):
            j = np.flatnonzero((ca[k] != cb) & (na[k] * percent <= nb * 100) & (nb * percent <= na[k] * 100))
            equal = ba[k] == bb[j]
            j = j[(ba[k][equal.argmax(1)] == key) & (equal.sum(1) >= shared)]
            if not len(j):
                continue
            own, _ = _numbered([oa[k]])
            parts = [values[bounds[m] : bounds[m + 1]] for m in j]
            seen = np.zeros(max(own.max(), max(p.max() for p in parts)) + 1, bool)
            seen[own] = True
            both = np.add.reduceat(seen[np.concatenate(parts)], np.cumsum([0] + [len(p) for p in parts[:-1]]), dtype=np.int64)
            good = b[j[100 * both >= percent * (na[k] + nb[j] - both)]]
            x += [a[k]] * len(good)
            y += good.tolist()
        return x, y

    def work(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                x, y = compare(batch.column("key")[r].as_py(), *(batch.column(c).slice(r, 1) for c in ("left", "right")))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["x", "y"])

    found = left.join(right, ["key", "i", "j"]).select("key", "left", "right").mapInArrow(work, "x bigint, y bigint")
    return found.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, shared: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (the least doc_id of its component)."""
    signed = stage(signatures(docs, size, doc_id, text), "signatures")
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), _text_hash(text))
    sets = signed.filter("digest is not null and doc_id is not null")
    several = sets.groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).filter("a <> b").select("doc_id")
    several = stage(several, "several")
    if several.isEmpty():
        result = _grouped(signed, source, size, percent, shared)
    else:
        result = _named_apart(signed, source, several, size, percent, shared)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _named_apart(signed: DataFrame, source: DataFrame, several: DataFrame, size: int, percent: int, shared: int) -> DataFrame:
    """As ``_grouped``, where some doc_ids (``several``) have more than one set: each set goes by a number of its own.

    The numbers lie above all doc_ids. Sets of one doc_id are linked, and each component is named
    by its least doc_id at the end.
    """
    above = signed.agg(F.max("doc_id")).first()[0] + 1
    sets = signed.filter("digest is not null").join(several, "doc_id", "left_semi")
    apart = sets.groupBy("doc_id", "digest").agg(F.min("text_hash").alias("text_hash"))
    apart = stage(apart.withColumn("number", F.monotonically_increasing_id() + F.lit(above)), "apart")
    numbers = apart.select(F.col("doc_id").alias("name"), F.col("digest").alias("of"), "number")
    own = (F.col("doc_id") == F.col("name")) & (F.col("digest") == F.col("of"))
    numbered = signed.join(numbers, own, "left").withColumn("doc_id", F.coalesce("number", "doc_id")).select(signed.columns)
    # of rows with one set the text of one, the others by a doc_id that takes no part
    texts = apart.select(F.col("doc_id").alias("name"), F.col("text_hash").alias("of"), "number")
    own = (F.col("doc_id") == F.col("name")) & (F.col("text_hash") == F.col("of"))
    source = source.join(texts, own, "left").withColumn("doc_id", F.coalesce("number", "doc_id")).select(source.columns)
    least = apart.groupBy("doc_id").agg(F.min("number").alias("y"))
    links = apart.join(least, "doc_id").filter("number <> y").select(F.col("number").alias("x"), "y")

    joined = stage(_grouped(stage(numbered, "numbered"), source, size, percent, shared, links), "joined")
    names = apart.select(F.col("number").alias("doc_id"), F.col("doc_id").alias("name"))
    named = joined.join(names, "doc_id", "left").withColumn("name", F.coalesce("name", "doc_id"))
    least = named.filter("component_id is not null").groupBy("component_id").agg(F.min("name").alias("least"))
    return named.join(least, "component_id", "left").select(F.col("name").alias("doc_id"), "n_shingles", F.col("least").alias("component_id"))


def _grouped(signed: DataFrame, source: DataFrame, size: int, percent: int, shared: int, also: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row, null without a set; each doc_id has one set. ``also``: links known before."""
    sets = signed.filter("digest is not null and doc_id is not null")
    classes = sets.groupBy("digest").agg(F.min("doc_id").alias("class_id"))
    firsts = classes.select(F.col("class_id").alias("doc_id"))
    heads = sets.join(firsts, "doc_id", "left_semi").select("doc_id", "n_shingles", "bands").dropDuplicates(["doc_id"])

    members = heads.select("doc_id", "n_shingles", F.explode("bands").alias("key"))
    full = members.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    mates = stage(members.join(full, "key"), "buckets")

    degrees = mates.groupBy("doc_id").agg(F.sum("members").alias("degree"))
    centres = (
        mates.join(degrees, "doc_id")
        .groupBy("key").agg(F.max(F.struct("degree", (-F.col("doc_id")).alias("minus"), "n_shingles")).alias("c"))
        .select("key", (-F.col("c.minus")).alias("y"), F.col("c.n_shingles").alias("size_y"))
    )
    stars = (
        mates.join(centres, "key").filter("doc_id <> y").filter(_alike("n_shingles", "size_y", percent))
        .select(F.greatest("doc_id", "y").alias("x"), F.least("doc_id", "y").alias("y")).distinct()
    )
    wanted = mates.select("doc_id").distinct()
    texts = stage(source.select("doc_id", "text").join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "candidates")
    links = stage(_confirmed(stars, texts, size, percent), "links")
    if also is not None:  # between classes, by the number of each
        of = signed.join(classes, "digest").select("doc_id", "class_id").distinct()
        ends = also.join(of.withColumnsRenamed({"doc_id": "x", "class_id": "cx"}), "x").join(of.withColumnsRenamed({"doc_id": "y", "class_id": "cy"}), "y")
        links = stage(links.unionByName(ends.filter("cx <> cy").select(F.greatest("cx", "cy").alias("x"), F.least("cx", "cy").alias("y"))), "links")

    # buckets that are not yet of one component
    joined = components(links)
    placed = mates.join(joined, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    size_of = 2 * F.col("n_shingles") + 8 * (BANDS + 4)  # bytes of a member in a cell
    shares = placed.groupBy("key", "component_id").agg(F.sum(size_of).alias("share"))
    split = (
        shares.groupBy("key")
        .agg(F.sum("share").alias("total"), F.max(F.struct("share", "component_id")).alias("top"), F.count("*").alias("parts"))
        .filter("parts > 1")
        .select("key", F.col("top.component_id").alias("largest"), "total", (F.col("total") - F.col("top.share")).alias("outside"))
    )
    mixed = stage(placed.join(split, "key"), "mixed")
    inside = mixed.select("doc_id").distinct()
    outlined = _outlines(texts.join(inside, "doc_id", "left_semi"), size).join(heads.select("doc_id", "bands"), "doc_id")
    mixed = mixed.join(outlined, "doc_id")
    more = stage(_confirmed(_block_pairs(mixed, percent, shared), texts, size, percent), "links")

    final = components(links.unionByName(more)).withColumnRenamed("doc_id", "class_id").withColumnRenamed("component_id", "root")
    named = classes.join(final, "class_id", "left").select("digest", F.coalesce("root", "class_id").alias("component_id"))
    return signed.select("doc_id", "n_shingles", "digest").join(named, "digest", "left").select("doc_id", "n_shingles", "component_id")
