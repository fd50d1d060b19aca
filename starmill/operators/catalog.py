"""The warehouse as tables and views of the catalog, which other sessions see.

Tables are declared with their types and defaults; an insert that leaves a column
out stores its default. Views are stored as SQL text over these tables, so they show what the
tables hold when they are read (``read`` looks up files that other sessions have added). With a metastore behind the catalog, both
outlive the cluster; without one, they are shared by the sessions of an application.

``bucketed`` tables hold the rows of a customer in one bucket, and sales and customers in
as many buckets: queries that fold by customer and join customers need no shuffle
of the fact. A customer with a large share of all sales would make one bucket, and
so one task, too large; such sales are refused, and stay in plain tables, where the
fold before the shuffle takes care of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from starmill import schemas
from starmill.operators import tables
from starmill.plans.star import Star

ENRICHED = "fact_sales_enriched"
LOAD_TIME = "load_time"
# What a column holds where an insert leaves it out.
DEFAULTS = {"is_holiday": "0", LOAD_TIME: "current_timestamp()"}
UNEVEN = 4  # times the mean that a bucket may hold


def create_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")


def create_table(spark: SparkSession, table: str, schema: StructType, load_time: bool = False) -> None:
    """A table of the catalog, empty, its defaults declared; with ``load_time`` a column that tells when a row came.

    Parquet tables take keys and NOT NULL without enforcing them, so they are left to operators.quality.
    """
    if load_time:
        schema = StructType([*schema, StructField(LOAD_TIME, TimestampType())])
    default = lambda name: f" DEFAULT {DEFAULTS[name]}" if name in DEFAULTS else ""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{default(f.name)}" for f in schema)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet")


def insert(df: DataFrame, table: str) -> None:
    """Append rows by column name; columns that ``df`` lacks get their default, or NULL."""
    spark = df.sparkSession
    names = [c for c in spark.table(table).columns if c in df.columns]
    listed = ", ".join(f"`{c}`" for c in names)
    spark.sql(f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {{rows}}", rows=df)


def read(spark: SparkSession, name: str) -> DataFrame:
    """A table or view as it is now: a session remembers a table's files, so what others inserted since is looked up."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def publish_star(star: Star, database: str) -> None:
    """The star's dimensions and sales as tables of a database, declared and filled."""
    spark = star.sales.sparkSession
    for name, schema in tables.DIMENSIONS.items():
        create_table(spark, f"{database}.{name}", schema)
        insert(getattr(star, name), f"{database}.{name}")
    create_table(spark, f"{database}.{ENRICHED}", schemas.FACT_ENRICHED, load_time=True)
    insert(star.sales, f"{database}.{ENRICHED}")


def published_star(spark: SparkSession, database: str) -> Star:
    dims = {name: read(spark, f"{database}.{name}") for name in tables.DIMENSIONS}
    return Star(sales=read(spark, f"{database}.{ENRICHED}"), **dims)


def create_store_view(spark: SparkSession, database: str, name: str = "store_quarterly_sales") -> str:
    """Create or replace the view of stores and quarters over the database's tables; returns its full name."""
    spark.sql(
        f"""
        CREATE OR REPLACE VIEW {database}.{name} AS
        SELECT f.store_id, s.store_name, f.year, f.quarter, f.total_sales, f.total_qty
        FROM (
          SELECT store_id, year, quarter, sum(total_amount) AS total_sales, sum(quantity) AS total_qty
          FROM {database}.{ENRICHED} JOIN {database}.dim_date USING (date_id)
          GROUP BY store_id, year, quarter
        ) f JOIN {database}.dim_store s ON s.store_id = f.store_id"""
    )
    return f"{database}.{name}"


def largest_share(sales: DataFrame, buckets: int) -> float:
    """The fullest bucket's rows, as a multiple of the mean."""
    bucket = F.pmod(F.hash("customer_id"), F.lit(buckets))
    counts = sales.groupBy(bucket.alias("b")).count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    return counts.most * buckets / counts["all"] if counts["all"] else 0.0


def bucketed_star(star: Star, database: str, buckets: int) -> Star:
    """The star with sales and customers stored in buckets of customer_id, sorted within.

    ValueError where a bucket would hold more than ``UNEVEN`` times the mean.
    """
    spark = star.sales.sparkSession
    share = largest_share(star.sales, buckets)
    if share > UNEVEN:
        raise ValueError(f"a bucket would hold {share:.1f} times the mean; leave the sales in plain tables")
    for name, rows in ((ENRICHED, star.sales), ("dim_customer", star.dim_customer)):
        # dealt as the buckets are, so that a bucket is written by one task, as one file
        dealt = rows.repartition(buckets, "customer_id")
        dealt.write.bucketBy(buckets, "customer_id").sortBy("customer_id").saveAsTable(f"{database}.{name}_by_customer")
    stored = {"sales": spark.table(f"{database}.{ENRICHED}_by_customer"), "dim_customer": spark.table(f"{database}.dim_customer_by_customer")}
    return Star(**{**{name: getattr(star, name) for name in tables.DIMENSIONS}, **stored})
