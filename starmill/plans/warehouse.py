"""From the three input files to a loaded warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmill import schemas
from starmill.operators import cleaning, dimensions, loads, quality, tables, versions
from starmill.plans.star import Star
from starmill.scratch import exists, remove, stage
from starmill.sources import files
from starmill.streaming.enrichment import stream_enrich

ENRICHED = "fact_sales_enriched"
TABLES = [*tables.DIMENSIONS, "fact_sales", ENRICHED]


def build_warehouse(
    spark: SparkSession,
    customers: str,
    products: str,
    transactions: str,
    base: str,
    replace: bool = False,
) -> Star:
    """Clean, load dimensions and facts into a new version of the warehouse at ``base``, then publish it.

    The stream reads the transaction files again as delivered; only the product
    master it meets is cleaned. What is used more than once is written first.

    A warehouse that is there already is left alone and an error raised, unless
    ``replace`` is given. The old version answers until the new one is complete and its
    declared keys are checked; if a build fails, it stays, and what the build has written goes.
    """
    present = [name for name in [*TABLES, "checkpoints"] if exists(spark, f"{base}/{name}")]
    if not replace and (present or versions.is_published(spark, base)):
        raise FileExistsError(f"{base} already holds a warehouse; give replace=True to build it anew")
    version = versions.new_version(base)
    try:
        _build(spark, customers, products, transactions, version)
        versions.publish(spark, base, version)
    except BaseException:
        remove(spark, version)
        raise
    for name in present:  # tables from before there were versions
        remove(spark, f"{base}/{name}")
    return tables.stored_star(spark, base)


def _build(spark: SparkSession, customers: str, products: str, transactions: str, base: str) -> None:
    cleaned = stage(cleaning.clean_products(files.read_products(spark, products)), "products")
    load_facts(spark, transactions, base)
    facts = tables.read(spark, f"{base}/fact_sales", schemas.FACT_SALES)
    stored = loads.load_dimensions(
        {
            "dim_customer": dimensions.dim_customer(
                cleaning.clean_customers(files.read_customers(spark, customers))
            ),
            "dim_store": dimensions.dim_store(cleaned),
            "dim_supplier": dimensions.dim_supplier(cleaned),
            "dim_product": dimensions.dim_product(cleaned),
            "dim_date": dimensions.dim_date(facts),
        },
        base,
    )
    quality.require_keys(stored | {"fact_sales": facts})
    target, checkpoint = f"{base}/{ENRICHED}", f"{base}/checkpoints/{ENRICHED}"
    tables.recreate_enriched(spark, target, checkpoint)
    stream_enrich(
        cleaning.coerced_transactions(files.stream_transactions(spark, transactions)),
        dimensions.product_master(cleaned),
        target,
        checkpoint,
    )


def stored_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Every table of a warehouse by name."""
    star = tables.stored_star(spark, base)
    facts = tables.read(spark, f"{versions.current(spark, base)}/fact_sales", schemas.FACT_SALES)
    return {name: getattr(star, name) for name in tables.DIMENSIONS} | {"fact_sales": facts, ENRICHED: star.sales}


def load_facts(spark: SparkSession, transactions: str, base: str) -> None:
    """Clean the transaction files and load the orders that are not stored yet."""
    raw = files.read_transactions(spark, transactions)
    loads.load_keyed(
        cleaning.clean_transactions(raw).kept, f"{base}/fact_sales", schemas.FACT_SALES, "order_id", f"{base}/rejects/fact_sales"
    )
