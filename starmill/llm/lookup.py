"""Small tables that travel to the tasks: read on the driver in parts of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm import blocks

# Runs of digits, letters and all of non-ASCII; A-Z count as a-z.
TERMS = np.zeros(256, np.uint8)
TERMS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1

PART_BYTES = 8 << 20


def parts(items: DataFrame, item_id: str, text: str, limit: int = PART_BYTES) -> Iterator[list]:
    """All rows (item_id, text) as lists of about ``limit`` bytes of text, one at a time, in a fixed order."""
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text")).filter("text is not null")
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    count = -(-size // limit)
    for k in range(count):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k) if count > 1 else rows
        if found := sorted(part.collect(), key=lambda r: (str(r.item_id), r.text)):
            yield found


def term_hashes(text: str | bytes) -> np.ndarray:
    """The hashes of one text's terms, whatever its length."""
    data = text.encode() if isinstance(text, str) else text
    made = [blocks.tokens(pa.array([part], pa.large_binary()), TERMS, blocks.LOWER).hashes for part in blocks.cut(data, blocks.BLOCK_BYTES, TERMS)]
    return np.concatenate(made)
