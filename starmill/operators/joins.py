"""Join strategies where Spark's own choice is not enough."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows a hinted broadcast may have; at about 100 bytes each some 50 MB.
BROADCAST_ROWS = 500_000
# A key with a third of the rows is left with a fiftieth of them per task.
SALTS = 16


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows.

    A plain count: each task sends one number, where a limit would send up to
    ``max_rows`` rows per task to a single one.
    """
    return df.count() <= max_rows


def broadcast_if_fits(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast after counting; otherwise leave the join to Spark."""
    return F.broadcast(df) if fits(df, max_rows) else df


def as_lookup(keyed: DataFrame) -> DataFrame:
    """A table to be met by many more rows: broadcast where it fits, else hashed by partition.

    So the many rows are not sorted. The table should hold its key once and be stored, as it is counted.
    """
    return F.broadcast(keyed) if fits(keyed) else keyed.hint("shuffle_hash")


def row_salt(rows: DataFrame, salts: int = SALTS) -> Column:
    """A salt per row; equal copies differ if ``rows`` carries ``file_place``.

    It is a hash, not random: a task that runs again gives the same salts.
    """
    return F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
