"""The five dimensions and the product master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill import schemas
from starmill.functions.calendar import calendar_attributes


def dim_date(rows: DataFrame) -> DataFrame:
    """One row per distinct ``date_id``; rows without a date add none."""
    days = rows.select("date_id").filter("date_id is not null").distinct()
    return days.withColumns(calendar_attributes(F.col("date_id"))).select(
        *schemas.DIM_DATE.names
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(*schemas.DIM_CUSTOMER.names).distinct()


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(*schemas.DIM_PRODUCT.names).distinct()


def dim_store(products: DataFrame) -> DataFrame:
    """Stores named by the product master; the region is not delivered."""
    return (
        products.select("store_id", "store_name")
        .distinct()
        .withColumn("region", F.lit(None).cast("string"))
    )


def dim_supplier(products: DataFrame) -> DataFrame:
    return products.select("supplier_id", "supplier_name").distinct()


def product_master(products: DataFrame) -> DataFrame:
    """What enrichment looks up: price, store and supplier of each product."""
    return products.select(*schemas.PRODUCT_MASTER.names).distinct()
