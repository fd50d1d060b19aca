"""Documents for the edge cases that every operator must take."""

from __future__ import annotations

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))

EDGES = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", None, "a", 3),
    (4, "one", "en", None, 3),
    (5, LONG, "en", "a", len(LONG)),
    (6, "the same words stand here in two rows of the table", "en", "a", 50),
    (6, "the same words stand here in two rows of the table", "en", "a", 50),
    (7, "the same words stand here in two rows of the table", "en", "b", 50),
    (None, "a row without a name", "en", "a", 20),
    (8, "é ß 漢字 🙂   ́x", "fr", "b", 14),
]

# names that operators use for columns of their own
CLASHING = (
    "component_id kept digest bands key members host line dropped total lang_pred score start end length ids "
    "sequence_id offset trusted llr places passage n fingerprint word by label features path __host __dropped joined0 Joined1"
).split()


def edges(spark):
    """The edge cases, with many more columns than any operator asks for."""
    df = spark.createDataFrame(EDGES, SCHEMA).repartition(3)
    return df.selectExpr("*", *[f"'x' as {name}" for name in CLASHING])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def docs(spark, rows):
    """(doc_id, text) or (doc_id, text, lang, source) rows as documents."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0", None) for r in rows]
    return spark.createDataFrame(full, SCHEMA)
