"""Exact distinct counts that can be folded: sets of whole numbers as bitmaps of 64.

A number's word is the number without its last six bits, and each number one
bit of its word. Within a group the words' bits are united by ``bit_or``, which
Spark folds within tasks, again after every join, and over any coarser
groups; at last the bits are counted. Unlike a distinct count, which needs all
rows of a group until its end, a hot key leaves each task as one row per 64
numbers. Any numbers will do; the closer those of a group, the fewer words.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = "order_word"
BITS = "order_bits"


def word(number: str) -> Column:
    """Which 64 numbers it belongs to; NULL for NULL."""
    return F.shiftright(F.col(number).cast("bigint"), 6).alias(WORD)


def bits(number: str) -> Column:
    """Aggregates the numbers of one word; NULL where there is none."""
    return F.expr(f"bit_or(shiftleft(1L, cast(`{number}` & 63 as int)))").alias(BITS)


def united() -> Column:
    """Aggregates words that have been folded before."""
    return F.bit_or(BITS).alias(BITS)


def counted() -> Column:
    """Aggregates the words of a group, each of which stands once, to the number of its numbers."""
    return F.coalesce(F.sum(F.bit_count(BITS)), F.lit(0)).cast("bigint")
