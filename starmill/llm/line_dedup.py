"""Site-relative line frequency: boilerplate lines go, page by page.

Within each host, the number of pages that hold a line is divided by the
host's number of pages; lines above ``ratio`` are boilerplate there and are
dropped from every page of the host. Built-in functions only.

Lines are compared without surrounding spaces, by a 64-bit hash. Lines without
a word are never counted and never dropped. Cases:

* null host: the pages without a host are a host of their own;
* null or empty text: returned as it is, nothing dropped;
* a host with fewer than ``min_pages`` pages: all lines stay, since one page
  that repeats nothing would have every line at ratio 1;
* repeated rows: each row is a page; a line twice on a page counts once;
* a page all of whose lines go keeps an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.scratch import stage

RATIO = 0.1
MIN_PAGES = 10
BROADCAST_LINES = 500_000  # boilerplate lines up to which the lists travel to the pages, some MB

_BLANK = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"


def line_key(line: Column) -> Column:
    return F.xxhash64(F.regexp_replace(line, _BLANK, ""))


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per host: ``host`` and the keys of its boilerplate lines, at most (lines per page / ratio) of them.

    Both counts are summed within tasks before the shuffle, so a host with a
    third of all pages leaves each task as one row per distinct line.
    """
    pages = docs.select(F.col(host).alias("host"), F.col(text).alias("text"))
    keys = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), _has_word), line_key))
    # a host's own row goes with its lines: one scan counts both
    marked = pages.select("host", F.explode(F.concat(F.array(F.lit(None).cast("bigint")), F.coalesce(keys, F.array().cast("array<bigint>")))).alias("line"))
    counts = marked.groupBy("host", "line").agg(F.count("*").alias("pages"))
    totals = counts.filter(F.col("line").isNull()).select("host", F.col("pages").alias("total")).filter(F.col("total") >= min_pages)
    heavy = (
        counts.filter(F.col("line").isNotNull() & (F.col("pages") > 1))
        .join(totals.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of")))
        .filter(F.col("pages") / F.col("total") > ratio)
    )
    return heavy.groupBy("host").agg(F.collect_list("line").alias("dropped"))


def drop_lines(docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` with the boilerplate lines of their host taken out of ``text``; other columns stay."""
    lists = stage(boilerplate(docs, text, host, ratio, min_pages), "boilerplate")
    fit = (lists.agg(F.sum(F.size("dropped"))).first()[0] or 0) <= BROADCAST_LINES
    # what is joined goes by names that no column of the pages has
    free = [name for k in range(len(docs.columns) + 2) if (name := f"joined{k}").lower() not in map(str.lower, docs.columns)]
    of, gone = free[:2]
    lists = lists.select(F.col("host").alias(of), F.col("dropped").alias(gone))
    # with more lists than that the pages move to them, and AQE splits a hot host; the result is the same
    if fit:
        lists = F.broadcast(lists)
    lines = _lines(F.col(text))
    kept = F.filter(lines, lambda line: ~(_has_word(line) & F.array_contains(F.col(gone), line_key(line))))
    clean = F.when(F.col(gone).isNull() | F.col(text).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    joined = docs.join(lists, F.col(host).eqNullSafe(F.col(of)), "left")
    return joined.select(*[(clean if c == text else F.col(f"`{c}`")).alias(c) for c in docs.columns])
