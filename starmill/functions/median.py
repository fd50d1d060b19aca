"""Exact median of a decimal column without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.scratch import stage

# Buckets a range of values is cut into, and distinct values at which the cutting
# ends. Both bound what the driver and the last, single task receive.
PARTS = 1000
FEW = 50_000


def exact_median(df: DataFrame, column: str, parts: int = PARTS, few: int = FEW) -> Column:
    """The median of the non-null values, interpolated, as a literal; NULL without values.

    ``median`` merges the set of all distinct values in a single task. Here the
    distinct values are counted in parallel and stored. Their range is cut into
    ``parts`` buckets, again and again around the middle ranks, until the bucket
    that holds them has at most ``few`` values, however they are spread.
    """
    # One row per distinct value: a price shared by a third of the rows is
    # folded before it is shuffled.
    values = stage(
        df.select(F.col(column).alias("v"))
        .filter(F.col("v").isNotNull())
        .groupBy("v")
        .agg(F.count(F.lit(1)).alias("n")),
        "median-values",
    )
    total = values.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if not total:
        return F.lit(None)
    # 1-based ranks of the middle rows; equal when the count is odd
    low, high = (total + 1) // 2, (total + 2) // 2
    first = _at_rank(values, low, parts, few)
    last = first if low == high else _at_rank(values, high, parts, few)
    return F.lit((first + last) / 2)


def _at_rank(values: DataFrame, rank: int, parts: int, few: int):
    """The value whose rows include the ``rank``-th."""
    whole = values.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("rows")).first()
    low, high, rows, before = whole.low, whole.high, whole.rows, 0
    while rows > few:
        width = (float(high) - float(low)) / parts
        if width == 0:  # closer than a double can tell; these are few
            break
        # rounding keeps the order, so a bucket is a range of values
        bucket = F.floor((F.col("v").cast("double") - float(low)) / width)
        cells = (
            values.filter(F.col("v").between(low, high))
            .groupBy(bucket.alias("bucket"))
            .agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("rows"), F.sum("n").alias("n"))
            .orderBy("bucket")
            .collect()  # parts + 1 rows at most
        )
        for cell in cells:
            if before + cell.n >= rank:
                break
            before += cell.n
        low, high, rows = cell.low, cell.high, cell.rows
    upto = F.sum("n").over(Window.orderBy("v"))
    return (
        values.filter(F.col("v").between(low, high))
        .withColumn("upto", upto + before)
        .filter(F.col("upto") >= rank)
        .agg(F.min("v"))
        .first()[0]
    )
