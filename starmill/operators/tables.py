"""Warehouse tables as parquet folders: load, read, recreate, inspect."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from starmill import schemas
from starmill.operators import versions
from starmill.plans.star import Star
from starmill.schemas import SALE_YEAR
from starmill.scratch import exists, remove

# Loading order: nothing refers to a later table.
DIMENSIONS = {
    "dim_customer": schemas.DIM_CUSTOMER,
    "dim_store": schemas.DIM_STORE,
    "dim_supplier": schemas.DIM_SUPPLIER,
    "dim_product": schemas.DIM_PRODUCT,
    "dim_date": schemas.DIM_DATE,
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types."""
    return df.select(*[F.col(field.name).cast(field.dataType) for field in schema])


def append(df: DataFrame, path: str, schema: StructType) -> None:
    conform(df, schema).write.mode("append").parquet(path)


def with_load_time(df: DataFrame, column: str = "load_time") -> DataFrame:
    """Stamp rows with the time they are loaded."""
    return df.withColumn(column, F.current_timestamp())


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def recreate(spark: SparkSession, path: str, schema: StructType, *split_by: str) -> None:
    """Drop what the table held and leave it empty."""
    spark.createDataFrame([], schema).write.mode("overwrite").partitionBy(*split_by).parquet(path)


STORED_ENRICHED = StructType(
    [*schemas.FACT_ENRICHED, StructField("load", StringType()), StructField(SALE_YEAR, IntegerType())]
)


def with_sale_year(df: DataFrame) -> DataFrame:
    return df.withColumn(SALE_YEAR, F.year("date_id"))


def append_enriched(df: DataFrame, path: str, load: str | None = None) -> None:
    """Append enriched sales as one load, one folder per year of sale in it.

    A load that is named replaces what an earlier attempt of that name left.
    ``rebalance`` lets AQE cut a year that holds most rows into several files
    and join small ones, instead of every task writing a file for every year.
    Within a file rows are sorted by date, so a range of dates skips row groups.
    """
    (
        with_sale_year(conform(df, schemas.FACT_ENRICHED))
        .hint("rebalance", SALE_YEAR)
        .sortWithinPartitions(SALE_YEAR, "date_id")
        .write.mode("overwrite")
        .partitionBy(SALE_YEAR)
        .parquet(f"{path}/load={load or uuid.uuid4().hex}")
    )


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    """Enriched sales as stored, with the year their folder is named after."""
    return spark.read.schema(STORED_ENRICHED).parquet(path)


def recreate_enriched(spark: SparkSession, path: str, checkpoint: str | None = None) -> None:
    """Drop the enriched sales, and with them how far a stream had come."""
    recreate(spark, path, STORED_ENRICHED, "load", SALE_YEAR)
    if checkpoint:
        remove(spark, checkpoint)


def ensure(spark: SparkSession, path: str, schema: StructType, *split_by: str) -> None:
    """Leave a table as it is, or make it empty where there is none."""
    if not exists(spark, path):
        recreate(spark, path, schema, *split_by)


def ensure_enriched(spark: SparkSession, path: str) -> None:
    ensure(spark, path, STORED_ENRICHED, "load", SALE_YEAR)


def stored_star(spark: SparkSession, base: str) -> Star:
    """The star of a loaded warehouse, its published version if it has any; file sizes are known to the planner."""
    base = versions.current(spark, base)
    dims = {name: read(spark, f"{base}/{name}", schema) for name, schema in DIMENSIONS.items()}
    return Star(sales=read_enriched(spark, f"{base}/fact_sales_enriched"), **dims)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Create or recreate a view and return it as a table."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def preview(df: DataFrame, limit: int = 20) -> DataFrame:
    """The first rows in the order of all columns, so that it repeats."""
    return df.orderBy(*df.columns).limit(limit)


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def describe(spark: SparkSession, name: str) -> DataFrame:
    """Column names, types and comments of a table or view; reads no rows."""
    return spark.sql(f"DESCRIBE TABLE {name}")
