"""Readers of the delivered customer, product and transaction files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmill import schemas

# Field contents that mean "missing" in the delivered files.
MISSING = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def with_file_order(df: DataFrame) -> DataFrame:
    """Add where each row stands in the files.

    A file split is read by one task from front to back, so the split's start
    and a counter that grows within the task give the order of the rows.
    """
    return df.withColumn(
        "file_order",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def _missing_to_null(df: DataFrame, schema: StructType) -> DataFrame:
    # the dollar sign of one column name needs no quoting, a dot would
    known = {name: F.when(~F.col(f"`{name}`").isin(MISSING), F.col(f"`{name}`")) for name in schema.names}
    return df.withColumns(known)


def _format(path: str) -> str:
    return "parquet" if path.rstrip("/").endswith(".parquet") else "csv"

BATCH_BYTES = 64 << 30  # of files in a micro-batch


def _delivered(spark: SparkSession, path: str, schema: StructType, file_format: str | None) -> StructType:
    """The schema of the files as they are: their own columns in their own order, all text in CSV.

    Only a header or footer is read. The wanted columns must be there, under
    their names; where they stand, and what else there is, does not matter.
    """
    kind = file_format or _format(path)
    reader = spark.read.option("header", True) if kind == "csv" else spark.read
    found = reader.format(kind).load(path).schema
    missing = [name for name in schema.names if name not in found.names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; it has {', '.join(found.names)}")
    return found


def _wanted(rows: DataFrame, schema: StructType, place: str) -> DataFrame:
    columns = [F.col(f"`{name}`").cast("string").alias(name) for name in schema.names]
    return _missing_to_null(rows.select(*columns, place), schema)


def _read(spark: SparkSession, path: str, schema: StructType, file_format: str | None) -> DataFrame:
    """The columns of ``schema`` by name; ``file_format`` (csv or parquet) is told from the path if not given.

    All files below one path have the columns in one order, which CSV checks
    (``enforceSchema`` is off): a file in another order is an error, not a mix-up.
    """
    found = _delivered(spark, path, schema, file_format)
    reader = spark.read.schema(found).option("header", True).option("enforceSchema", False)
    rows = reader.format(file_format or _format(path)).load(path)
    return _wanted(with_file_order(rows), schema, "file_order")


def read_customers(spark: SparkSession, path: str, file_format: str | None = None) -> DataFrame:
    return _read(spark, path, schemas.CUSTOMER_FILE, file_format)


def read_products(spark: SparkSession, path: str, file_format: str | None = None) -> DataFrame:
    return _read(spark, path, schemas.PRODUCT_FILE, file_format)


def read_transactions(spark: SparkSession, path: str, file_format: str | None = None) -> DataFrame:
    return _read(spark, path, schemas.TRANSACTION_FILE, file_format)


def stream_transactions(
    spark: SparkSession,
    path: str,
    files_per_batch: int | None = None,
    file_format: str | None = None,
    bytes_per_batch: int = BATCH_BYTES,
) -> DataFrame:
    """The same files as a stream, in bounded micro-batches; the first file's columns hold for all.

    A micro-batch takes files up to ``bytes_per_batch`` in all, or one file that is larger
    by itself. ``files_per_batch`` bounds their number instead, which bounds the
    volume only where files are of one size.
    """
    bound = ("maxFilesPerTrigger", files_per_batch) if files_per_batch else ("maxBytesPerTrigger", bytes_per_batch)
    found = _delivered(spark, path, schemas.TRANSACTION_FILE, file_format)
    rows = (
        spark.readStream.schema(found)
        .option("header", True)
        .option("enforceSchema", False)
        .option(*bound)
        .format(file_format or _format(path))
        .load(path)
    )
    # Streams cannot count rows. A number drawn while a split is scanned (from a
    # fixed seed, so a repeated scan draws it again) tells equal rows apart.
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.rand(0))
    return _wanted(rows.withColumn("file_place", place), schemas.TRANSACTION_FILE, "file_place")
