"""Text to number and date, with NULL for whatever cannot be read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmill.schemas import COERCED


def to_number(text: Column) -> Column:
    """A decimal, or NULL. Rounding to the target type is left to the sink."""
    return text.try_cast(COERCED)


# Forms of a date, tried in this order after ISO. Of two readings of a date with
# slashes the month comes first, unless that is no month.
DATE_FORMATS = ("yyyyMMdd", "M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "d.M.yyyy", "yyyy/M/d", "d MMM yyyy", "MMM d, yyyy")


def to_date(text: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """The first form that fits, ISO first, or NULL (also for days the calendar lacks)."""
    # a cast would take eight digits for a year
    iso = F.when(~text.rlike(r"^\s*[0-9]{5,}\s*$"), text.try_cast("date"))
    plain = F.trim(text.cast("string"))
    return F.coalesce(iso, *[F.try_to_timestamp(plain, F.lit(form)).cast("date") for form in formats])


def to_int(value: Column) -> Column:
    """A whole number of 32 bits, or NULL where it does not fit."""
    return F.round(value).try_cast("int")


def to_key(text: Column) -> Column:
    """A 64-bit id, or NULL; ``7.0`` reads as 7."""
    return F.coalesce(text.try_cast("bigint"), F.round(to_number(text)).cast("bigint"))
