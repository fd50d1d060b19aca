"""The star the analytical queries run on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Star:
    """Enriched sales and their dimensions.

    Each dimension holds its key once (operators.quality checks that). The
    queries rely on it when they aggregate sales by key before joining. They
    only use the names below, so anything that has them will do.
    """

    sales: DataFrame
    dim_date: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_store: DataFrame
    dim_supplier: DataFrame
