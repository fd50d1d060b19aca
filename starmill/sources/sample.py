"""Maps a folder of order/lineitem/part tables to retail inputs.

Two mappings: a clean one for the star and the streams, and a dirty one that
plants duplicates, codes, blanks and unreadable values for the cleaning.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill import schemas
from starmill.operators import dimensions, enrich

AGE_BANDS = ["0-17", "18-25", "26-35", "36-45", "46-50", "51-55", "55+"]
CITIES = ["A", "B", "C"]
STAYS = ["0", "1", "2", "3", "4+"]


# Stated rather than read from the files: no footer is opened to plan a query.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _pick(labels: list[str], key: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, labels)), (key % len(labels) + 1).cast("int"))


def _product_id(part_key: Column) -> Column:
    # eight digits, or more where the keys need them
    digits = part_key.cast("string")
    padded = F.when(part_key < 100_000_000, F.lpad(digits, 8, "0")).otherwise(digits)
    return F.concat(F.lit("P"), padded)


def _order_id() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def _line_order() -> Column:
    return F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")


# Clean mapping


def customers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    band = _pick(AGE_BANDS, key)
    return table(spark, folder, "customer").select(
        key.alias("customer_id"),
        _pick(["Male", "Female"], key).alias("gender"),
        band.alias("age"),
        band.alias("age_group"),
        F.col("c_mktsegment").alias("occupation"),
        _pick(CITIES, F.col("c_nationkey")).alias("city_category"),
        _pick(STAYS, key).alias("stay_in_current_city_years"),
        F.when(key % 4 < 2, "Single").otherwise("Married").alias("marital_status"),
    )


def master(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier").select(F.count("*").alias("n")).scalar()
    return table(spark, folder, "part").select(
        _product_id(F.col("p_partkey")).alias("product_id"),
        F.col("p_type").alias("product_category"),
        F.col("p_retailprice").cast(schemas.PRICE).alias("unit_price"),
        (F.col("p_partkey") % 25).cast("int").alias("store_id"),
        (F.col("p_partkey") % suppliers).cast("int").alias("supplier_id"),
    )


def master_partial(spark: SparkSession, folder: str) -> DataFrame:
    """The master without every tenth product."""
    return master(spark, folder).filter(~F.col("product_id").endswith("9"))


def stores(spark: SparkSession, folder: str) -> DataFrame:
    regions = table(spark, folder, "region")
    return (
        table(spark, folder, "nation")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").alias("store_id"),
            F.col("n_name").alias("store_name"),
            F.col("r_name").alias("region"),
        )
    )


def suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("int").alias("supplier_id"), F.col("s_name").alias("supplier_name")
    )


ORDERS_PER_TASK = 1 << 18


def _with_orders(lines: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Lines with their order's customer and date.

    AQE does not plan a stream's joins, and all lines may come in one micro-batch, so there
    the orders say how many tasks share the work; counting them opens footers only.
    """
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if lines.isStreaming:
        tasks = orders.count() // ORDERS_PER_TASK
        if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
            orders = orders.repartition(tasks, "o_orderkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def transactions(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Order lines as transactions; ``lines`` may be a stream of them."""
    lines = table(spark, folder, "lineitem") if lines is None else lines
    return _with_orders(lines, spark, folder).select(
        _order_id().alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _product_id(F.col("l_partkey")).alias("product_id"),
        F.col("o_orderdate").cast("date").alias("date_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        *[c for c in lines.columns if c == "file_place"],
    )


def sales(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.enrich(transactions(spark, folder), master(spark, folder))


def dates(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar of all order dates, read off the orders alone.

    Dates of orders without lines match no sale, so they change no query.
    """
    days = table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("date_id"))
    return dimensions.dim_date(days)


class SampleStar:
    """The star of a folder; a query only plans the tables it asks for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._source = (spark, folder)

    @functools.cached_property
    def sales(self) -> DataFrame:
        return sales(*self._source)

    @functools.cached_property
    def dim_date(self) -> DataFrame:
        return dates(*self._source)

    # the keys below are unique as generated, so no distinct is needed

    @functools.cached_property
    def dim_customer(self) -> DataFrame:
        return customers(*self._source)

    @functools.cached_property
    def dim_product(self) -> DataFrame:
        return master(*self._source).select(*schemas.DIM_PRODUCT.names)

    @functools.cached_property
    def dim_store(self) -> DataFrame:
        return stores(*self._source)

    @functools.cached_property
    def dim_supplier(self) -> DataFrame:
        return suppliers(*self._source)


def line_stream(
    spark: SparkSession, folder: str, files_per_batch: int = 1000, pattern: str = "lineitem*.parquet"
) -> DataFrame:
    """Order lines as a stream, each with its place in the files."""
    rows = (
        spark.readStream.schema(TABLES["lineitem"])
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(f"{folder}/{pattern}")
    )
    # the path's hash, as the place goes through shuffles with its row
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return rows.withColumn("file_place", place)


# Dirty mapping, under the delivered column names


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    source = table(spark, folder, "customer")
    first = source.select(
        key.alias("Customer_ID"),
        F.when(key % 41 != 0, _pick(["M", "F"], key)).alias("Gender"),
        F.when(key % 53 != 0, _pick(AGE_BANDS, key)).alias("Age"),
        F.col("c_mktsegment").alias("Occupation"),
        F.when(key % 37 != 0, _pick([" a ", " b ", " c "], F.col("c_nationkey"))).alias(
            "City_Category"
        ),
        _pick(STAYS, key).alias("Stay_In_Current_City_Years"),
        F.when(key % 43 != 0, F.when(key % 4 < 2, 0).otherwise(1)).alias("Marital_Status"),
        F.lit(1).alias("file_order"),
    )
    second = first.filter("Customer_ID % 50 = 0").withColumns(
        {"Age": F.lit("99"), "City_Category": F.lit("z"), "file_order": F.lit(2)}
    )
    return first.unionByName(second).withColumns(
        {name: F.col(name).cast("string") for name in schemas.CUSTOMER_FILE.names}
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    supplier = table(spark, folder, "supplier")
    n_suppliers = supplier.select(F.count("*").alias("n")).scalar()
    first = (
        table(spark, folder, "part")
        .withColumns({"store": key % 25, "supplier": key % n_suppliers})
        .join(table(spark, folder, "nation"), F.col("store") == F.col("n_nationkey"))
        .join(supplier, F.col("supplier") == F.col("s_suppkey"))
        .select(
            _product_id(key).alias("Product_ID"),
            F.concat(F.lit(" "), F.lower("p_type")).alias("Product_Category"),
            F.when(key % 29 == 0, "n/a")
            .otherwise(F.col("p_retailprice").cast(schemas.PRICE).cast("string"))
            .alias("price$"),
            F.col("store").cast("string").alias("storeID"),
            F.col("supplier").cast("string").alias("supplierID"),
            F.concat(
                F.lit("  "), F.lower(F.replace("n_name", F.lit("_"), F.lit("-"))), F.lit(" ")
            ).alias("storeName"),
            F.lower("s_name").alias("supplierName"),
            F.lit(1).alias("file_order"),
            key.alias("key"),
        )
    )
    second = first.filter("key % 40 = 0").withColumns(
        {"Product_Category": F.lit("dup"), "price$": F.lit("1.00"), "file_order": F.lit(2)}
    )
    return first.unionByName(second).drop("key")


def raw_transactions(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Order lines with planted faults; ``lines`` may be a stream of them."""
    lines = table(spark, folder, "lineitem") if lines is None else lines
    streamed = "file_place" in lines.columns
    place = F.col("file_place") if streamed else _line_order().alias("file_order")
    key = F.col("l_orderkey")
    quantity = (
        F.when(key % 97 == 0, "n/a")
        .when(key % 89 == 0, "-1")
        .when(key % 83 == 0, F.lit(None))
        .when(key % 79 == 0, "0")
        .when(key % 73 == 0, "99999999999")
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
    )
    return _with_orders(lines, spark, folder).select(
        _order_id().cast("string").alias("orderID"),
        F.when(key % 71 != 0, F.col("o_custkey").cast("string")).alias("Customer_ID"),
        F.when(key % 67 != 0, _product_id(F.col("l_partkey"))).alias("Product_ID"),
        quantity.alias("quantity"),
        F.when(key % 61 == 0, "not-a-date")
        .otherwise(F.col("o_orderdate").cast("date").cast("string"))
        .alias("date"),
        place,
    )
