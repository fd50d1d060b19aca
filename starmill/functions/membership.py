"""Which rows may be among others: a bitmap of fixed size that travels, whatever the tables hold.

A key's hash points at one of 2 ** PLACES bits, stored as words of 64. The bitmap of a
table of keys has at most 2 ** (PLACES - 6) rows of 16 bytes, about 16 MB, so it may be
broadcast without a look at its size. A key whose bit is not set is not there; one
whose bit is set may be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACES = 26


def _place(key: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - PLACES)


def members(keys: DataFrame, key: str) -> DataFrame:
    """The bitmap of a table's keys, summed within tasks before it is shuffled."""
    places = keys.filter(F.col(key).isNotNull()).select(_place(key).alias("place"))
    bit = F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))")
    return places.groupBy(F.shiftright("place", 6).alias("_word")).agg(bit.alias("_bits"))


def marked(rows: DataFrame, key: str, bitmap: DataFrame, mark: str) -> DataFrame:
    """``rows`` with a column that is true where the key may be a member, and false where it is not."""
    place = rows.withColumn("_place", _place(key))
    joined = place.join(F.broadcast(bitmap), F.shiftright("_place", 6) == F.col("_word"), "left")
    bit = F.expr("shiftright(_bits, cast(_place & 63 as int)) & 1")
    return joined.withColumn(mark, F.coalesce(bit == 1, F.lit(False))).drop("_place", "_word", "_bits")
