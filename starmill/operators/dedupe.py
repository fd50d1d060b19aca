"""Duplicate removal that keeps a defined copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of every ``key`` by ``order``; NULL keys form one group.

    ``dropDuplicates`` would keep an arbitrary copy. The ``= 1`` filter lets
    Catalyst cut each task down to one row per key before the shuffle, so a
    key that holds a third of all rows sends one row per task.
    """
    by_key = Window.partitionBy(key).orderBy(order)
    return df.withColumn("_copy", F.row_number().over(by_key)).filter("_copy = 1").drop("_copy")
