"""Transactions joined with the product master; batch and streaming alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill import schemas
from starmill.functions.coerce import to_int


def with_amount(joined: DataFrame) -> DataFrame:
    """The columns of the enriched fact, the amount computed; NULL where it does not fit."""
    amount = F.try_multiply("quantity", "unit_price").try_cast(schemas.PRICE)
    return joined.withColumn("total_amount", amount).withColumn("quantity", to_int(F.col("quantity"))).select(*schemas.FACT_ENRICHED.names)


def enrich(transactions: DataFrame, master: DataFrame, collation: str | None = None) -> DataFrame:
    """Matched transactions with price, store, supplier and amount.

    The transactions are taken as they come: repeated orders and quantities
    of zero or less stay in. Products the master does not know drop out.

    Ids are compared byte by byte. A ``collation``, such as ``UNICODE_CI``, makes ids match as a
    database of that collation would (``p1`` and ``P1`` are one product); the id of the
    transaction is kept. The master must hold one row per id in that sense (``one_per_key``).
    """
    lookup = master.select("product_id", "unit_price", "store_id", "supplier_id")
    if collation is None:
        return with_amount(transactions.join(lookup, "product_id"))
    lookup = lookup.withColumnRenamed("product_id", "_id")
    same = F.collate("product_id", collation) == F.collate("_id", collation)
    return with_amount(transactions.join(lookup, same).drop("_id"))


def one_per_key(master: DataFrame, collation: str) -> DataFrame:
    """Of products whose ids are equal under the collation, the one whose id sorts first by its bytes."""
    least = F.min_by(F.struct(*master.columns), "product_id").alias("_row")
    return master.groupBy(F.collate("product_id", collation).alias("_key")).agg(least).select("_row.*")


def unmatched(transactions: DataFrame, master: DataFrame) -> DataFrame:
    """Transactions whose product the master does not know."""
    known = master.select("product_id")
    return transactions.join(known, "product_id", "left_anti").select(
        *schemas.FACT_SALES.names
    )
