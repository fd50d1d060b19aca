"""Cleaning of the customer, product and transaction data.

Raw frames carry the delivered column names plus ``file_order``, any sortable
value (or struct) that says which of two rows came first in the file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill import schemas
from starmill.functions.coerce import to_date, to_int, to_key, to_number
from starmill.functions.median import exact_median
from starmill.functions.text import strip, title_case
from starmill.operators.dedupe import keep_first
from starmill.scratch import stage

# Codes in the customer file and what they stand for.
GENDERS = {"M": "Male", "F": "Female"}
MARITAL = {"0": "Single", "1": "Married"}
UNKNOWN = "Unknown"


def decode(code: Column, labels: dict[str, str]) -> Column:
    """Replace known codes; other values stay as they are."""
    text = code.cast("string")
    decoded = text
    for value, label in labels.items():
        decoded = F.when(text == value, label).otherwise(decoded)
    return decoded


def clean_customers(raw: DataFrame) -> DataFrame:
    renamed = raw.withColumnsRenamed(schemas.CUSTOMER_NAMES).withColumn(
        "customer_id", to_key(F.col("customer_id"))
    )
    first = keep_first(renamed, "customer_id", "file_order")
    return (
        first.withColumns(
            {
                "gender": decode(F.col("gender"), GENDERS),
                # taken before the fill: an unknown age has no age group
                "age_group": F.col("age").cast("string"),
                "age": F.col("age").cast("string"),
                "city_category": strip(F.upper("city_category")),
                "marital_status": decode(F.col("marital_status"), MARITAL),
            }
        )
        .fillna(UNKNOWN, subset=["gender", "city_category", "age"])
        .select(*schemas.DIM_CUSTOMER.names)
    )


def coerced_products(raw: DataFrame) -> DataFrame:
    """One row per product with its price as delivered (NULL if unreadable)."""
    renamed = raw.withColumnsRenamed(schemas.PRODUCT_NAMES)
    return keep_first(renamed, "product_id", "file_order").withColumn(
        "unit_price", to_number(F.col("unit_price"))
    )


def impute_price(products: DataFrame) -> DataFrame:
    """Fill missing prices with the median of the known ones."""
    median = exact_median(products, "unit_price")
    return products.withColumn(
        "unit_price", F.coalesce(F.col("unit_price").try_cast(schemas.PRICE), median.cast("decimal(30,10)").try_cast(schemas.PRICE))
    )


def clean_products(raw: DataFrame) -> DataFrame:
    # read for the rows and for the median
    first = stage(coerced_products(raw), "products")
    return impute_price(first).select(
        "product_id",
        strip(title_case(F.col("product_category"))).alias("product_category"),
        "unit_price",
        to_key(F.col("store_id")).try_cast("int").alias("store_id"),
        to_key(F.col("supplier_id")).try_cast("int").alias("supplier_id"),
        strip(title_case(F.col("store_name"))).alias("store_name"),
        strip(title_case(F.col("supplier_name"))).alias("supplier_name"),
    )


def coerced_transactions(raw: DataFrame) -> DataFrame:
    """Canonical names and types; unreadable values become NULL."""
    return raw.withColumnsRenamed(schemas.TRANSACTION_NAMES).withColumns(
        {
            "order_id": to_key(F.col("order_id")),
            "customer_id": to_key(F.col("customer_id")),
            "quantity": to_number(F.col("quantity")),
            "date_id": to_date(F.col("date_id")),
        }
    )


def fill_and_require_keys(transactions: DataFrame) -> DataFrame:
    """Default quantity 1; rows without customer or product go."""
    return transactions.fillna(1, subset=["quantity"]).dropna(
        subset=["customer_id", "product_id"]
    )


def good_quantity() -> Column:
    """Whether a filled quantity is positive and fits the table; one that does not fit is rejected, as NULL."""
    return (F.col("quantity") > 0) & to_int(F.col("quantity")).isNotNull()


@dataclass(frozen=True)
class Transactions:
    kept: DataFrame
    rejected: DataFrame


def clean_transactions(raw: DataFrame) -> Transactions:
    """Coerce, de-duplicate, fill, require keys, split by quantity.

    The order matters: duplicates go first, so an order whose first copy is
    bad is lost even if a later copy was good.
    """
    first = keep_first(coerced_transactions(raw), "order_id", "file_order")
    usable = fill_and_require_keys(first)

    def at_sink(rows: DataFrame) -> DataFrame:
        # the test above sees the exact value; only the stored one is rounded
        return rows.withColumn("quantity", to_int(F.col("quantity"))).select(*schemas.FACT_SALES.names)

    good = good_quantity()
    return Transactions(kept=at_sink(usable.filter(good)), rejected=at_sink(usable.filter(~good)))
