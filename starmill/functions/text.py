"""Text normalisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators that count as blank.
_BLANK = r"[\s\x1c-\x1f]"
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"


def strip(text: Column) -> Column:
    """Remove white space of every kind from both ends."""
    return F.regexp_replace(text, rf"(?U)^{_BLANK}+|{_BLANK}+$", "")


def title_case(text: Column) -> Column:
    """Capitalise every run of letters, so ``wal-mart`` gives ``Wal-Mart``.

    ``initcap`` alone only sees words between blanks; here it is applied to
    each run of cased letters on its own.
    """
    runs = F.regexp_extract_all(text, F.lit(rf"([{_CASED}]+|[^{_CASED}]+)"), F.lit(1))
    # array_join gives NULL for a NULL text, unlike concat_ws
    return F.array_join(F.transform(runs, F.initcap), "")
