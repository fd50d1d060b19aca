"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months of each season.
SEASONS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Fall": (9, 10, 11),
}


def season(month: Column) -> Column:
    label = F.lit(None).cast("string")
    for name, months in SEASONS.items():
        label = F.when(month.isin(*months), name).otherwise(label)
    return label


def calendar_attributes(day: Column) -> dict[str, Column]:
    """Everything dim_date holds besides its key, by column name."""
    iso_day = F.weekday(day) + 1  # Monday 1 ... Sunday 7
    return {
        "day_of_week": iso_day,
        "is_weekend": (iso_day >= 6).cast("int"),
        "week_of_year": F.weekofyear(day),  # ISO week beside the calendar year
        "day_of_month": F.dayofmonth(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "quarter": F.quarter(day),
        "year": F.year(day),
        "season": season(F.month(day)),
        "is_holiday": F.lit(0),
    }


def day_type(is_weekend: Column) -> Column:
    return F.when(is_weekend == 1, "Weekend").otherwise("Weekday")
