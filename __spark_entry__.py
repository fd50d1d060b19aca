
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from starmill import oracles, schemas
from starmill.functions.coerce import to_date, to_number
from starmill.functions.text import strip, title_case
from starmill.operators import catalog, cleaning, dimensions, loads, quality, tables
from starmill.operators.dedupe import keep_first
from starmill.operators.enrich import enrich, one_per_key
from starmill.operators.numbering import numbered_star
from starmill.plans import affinity, olap
from starmill.plans.star import Star
from starmill.plans.warehouse import build_warehouse, stored_tables
from starmill.scratch import scratch_path, stage
from starmill.sources import files, sample
from starmill.streaming import enrichment, parking
from starmill.streaming.sinks import each_batch

try:
    from starmill.llm import queries as corpus
except ModuleNotFoundError as missing:
    if missing.name not in ("starmill.llm", "starmill.llm.queries", "corpus_pipeline"):
        raise
    corpus = None

YEAR = oracles.YEAR

Query = Callable[[SparkSession, str], DataFrame]


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the one numeric type both engines hash alike."""
    decimals = [f.name for f in df.schema if isinstance(f.dataType, DecimalType)]
    return df.withColumns({name: F.col(name).cast("double") for name in decimals})


def _on_star(query: Callable, **parameters) -> Query:
    return lambda spark, folder: query(sample.SampleStar(spark, folder), **parameters)


# Cleaned inputs


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_customers(sample.raw_customers(spark, folder))


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_products(sample.raw_products(spark, folder))


def _transactions(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_transactions(sample.raw_transactions(spark, folder)).kept


def _rejected(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_transactions(sample.raw_transactions(spark, folder)).rejected


def _dimensions(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    products = stage(_products(spark, folder), "products")  # read by three dimensions
    return {
        "dim_customer": dimensions.dim_customer(_customers(spark, folder)),
        "dim_store": dimensions.dim_store(products),
        "dim_supplier": dimensions.dim_supplier(products),
        "dim_product": dimensions.dim_product(products),
        "dim_date": dimensions.dim_date(_transactions(spark, folder)),
    }


# Scans and loads


def _delivered_csv(spark: SparkSession, raw: DataFrame, columns: list[str], name: str) -> str:
    """The rows as CSV files in delivery order, so that first copies are where they should be."""
    return _written_csv(spark, raw.repartitionByRange("file_order"), columns, name)


def _written_csv(spark: SparkSession, raw: DataFrame, columns: list[str], name: str) -> str:
    path = scratch_path(spark, name)
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw.sortWithinPartitions("file_order").select(*columns).write.options(header=True, **blanks).csv(path)
    return path


LINES_PER_TASK = 1 << 20


def _delivered_transactions(spark: SparkSession, folder: str) -> str:
    """The transactions as CSV files, each in delivery order, with all copies of an order in one of them.

    The lines are dealt by order once, which the join with the orders needs as well, to as many
    tasks as keep their sorts small.
    """
    lines = sample.table(spark, folder, "lineitem")
    tasks = lines.count() // LINES_PER_TASK
    many = tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = lines.repartition(tasks, "l_orderkey") if many else lines.repartition("l_orderkey")
    return _written_csv(spark, sample.raw_transactions(spark, folder, lines), schemas.TRANSACTION_FILE.names, "transactions")


def scan_transactions_csv(spark: SparkSession, folder: str) -> DataFrame:
    names = schemas.TRANSACTION_FILE.names
    path = _delivered_csv(spark, sample.raw_transactions(spark, folder), names, "transactions-csv")
    return files.read_transactions(spark, path).select(*names)


def scan_customers(spark: SparkSession, folder: str) -> DataFrame:
    """A master delivered as parquet."""
    names = schemas.CUSTOMER_FILE.names
    path = scratch_path(spark, "customers") + ".parquet"
    sample.raw_customers(spark, folder).select(*names).write.parquet(path)
    return files.read_customers(spark, path).select(*names)


def _scan_products(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    path = _delivered_csv(spark, sample.raw_products(spark, folder), columns, "products-csv")
    return files.read_products(spark, path).select(*schemas.PRODUCT_FILE.names)


def scan_products(spark: SparkSession, folder: str) -> DataFrame:
    return _scan_products(spark, folder, schemas.PRODUCT_FILE.names)


def scan_products_reordered(spark: SparkSession, folder: str) -> DataFrame:
    """Files whose columns stand in another order than expected."""
    return _scan_products(spark, folder, schemas.PRODUCT_FILE.names[::-1])


def warehouse_build_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per table after a second build in place of the first."""
    inputs = [
        _delivered_csv(spark, raw, schema.names, name)
        for name, raw, schema in (
            ("customers", sample.raw_customers(spark, folder), schemas.CUSTOMER_FILE),
            ("products", sample.raw_products(spark, folder), schemas.PRODUCT_FILE),
        )
    ] + [_delivered_transactions(spark, folder)]
    base = scratch_path(spark, "warehouse")
    for _ in range(2):
        build_warehouse(spark, *inputs, base, replace=True)
    return quality.row_counts(stored_tables(spark, base))


def load_dimensions(spark: SparkSession, folder: str) -> DataFrame:
    stored = loads.load_dimensions(_dimensions(spark, folder), scratch_path(spark, "warehouse"))
    return quality.row_counts(stored)


def load_dimensions_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Rows stored and turned away per table, after half of the rows were loaded first and all of them, changed, later."""
    base = scratch_path(spark, "warehouse")
    dims = {name: stage(df, name) for name, df in _dimensions(spark, folder).items()}
    half = {
        "dim_customer": "customer_id % 2 = 0", "dim_store": "store_id % 2 = 0", "dim_supplier": "supplier_id % 2 = 0",
        "dim_product": "cast(substr(product_id, 2) as bigint) % 2 = 0", "dim_date": "day(date_id) % 2 = 0",
    }
    changed = {
        "dim_customer": "gender", "dim_store": "store_name", "dim_supplier": "supplier_name", "dim_product": "product_category", "dim_date": "season",
    }
    loads.load_dimensions({name: df.filter(half[name]) for name, df in dims.items()}, base)
    late = {name: df.withColumn(changed[name], F.concat(changed[name], F.lit(" late"))) for name, df in dims.items()}
    stored = loads.load_dimensions(late, base)
    counts = []
    for name, df in stored.items():
        rejects = loads.read_rejects(spark, f"{base}/rejects/{name}", tables.DIMENSIONS[name])
        late = F.coalesce(F.col(changed[name]).endswith(" late"), F.lit(False)).cast("bigint")
        kept = df.select(F.lit(1).cast("bigint").alias("row_count"), late.alias("late_count"), F.lit(0).cast("bigint").alias("rejected_count"))
        both = kept.unionAll(rejects.select(F.lit(0), F.lit(0), "copies"))
        counts.append(both.agg(F.lit(name).alias("table_name"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in kept.columns]))
    return reduce(DataFrame.unionByName, counts)


def fact_sales_load(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_path(spark, "fact-sales")
    loads.load_keyed(_transactions(spark, folder), f"{base}/table", schemas.FACT_SALES, "order_id", f"{base}/rejects")
    return tables.read(spark, f"{base}/table", schemas.FACT_SALES)


def describe_table(spark: SparkSession, folder: str) -> DataFrame:
    tables.create_view(_customers(spark, folder), "dim_customer")
    return tables.describe(spark, "dim_customer")


def _database(spark: SparkSession) -> str:
    """A database of its own, below the scratch folder."""
    path = scratch_path(spark, "catalog")
    name = "starmill_" + path.rsplit("-", 1)[1]
    catalog.create_database(spark, name, path)
    return name


def catalog_store_view(spark: SparkSession, folder: str) -> DataFrame:
    """The store view as a view of the catalog, read in another session."""
    name = _database(spark)
    catalog.publish_star(sample.SampleStar(spark, folder), name)
    view = catalog.create_store_view(spark, name)
    return catalog.read(spark.newSession(), view)


def catalog_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar and sales inserted without the columns that have a default."""
    name = _database(spark)
    star = sample.SampleStar(spark, folder)
    catalog.create_table(spark, f"{name}.dim_date", schemas.DIM_DATE)
    catalog.insert(star.dim_date.drop("is_holiday"), f"{name}.dim_date")
    catalog.create_table(spark, f"{name}.fact_sales", schemas.FACT_SALES, load_time=True)
    catalog.insert(sample.transactions(spark, folder).select(*schemas.FACT_SALES.names), f"{name}.fact_sales")
    return (
        spark.table(f"{name}.fact_sales").join(spark.table(f"{name}.dim_date"), "date_id")
        .groupBy("year", "is_holiday").agg(F.count("*").alias("rows"), F.count("load_time").alias("stamped"))
    )


def bucketed_demographics(spark: SparkSession, folder: str) -> DataFrame:
    """q02 on sales and customers that are stored in buckets of customers."""
    return olap.q02_demographics_city(catalog.bucketed_star(sample.SampleStar(spark, folder), _database(spark), 8))


def numbered_category_by_occupation(spark: SparkSession, folder: str) -> DataFrame:
    """q03 on stored sales whose orders have dense numbers."""
    star = numbered_star(sample.SampleStar(spark, folder), scratch_path(spark, "numbered"))
    return olap.q03_category_by_occupation(star)


def enrich_case_insensitive(spark: SparkSession, folder: str) -> DataFrame:
    """Product ids in other cases than the master's, which itself holds some twice."""
    sold = sample.transactions(spark, folder).withColumn(
        "product_id", F.when(F.col("order_id") % 3 == 0, F.lower("product_id")).otherwise(F.col("product_id"))
    )
    master = sample.master(spark, folder)
    doubled = master.filter("store_id % 5 = 0").withColumns({"product_id": F.lower("product_id"), "unit_price": F.lit(1).cast(schemas.PRICE)})
    return enrich(sold, one_per_key(master.unionByName(doubled), "UNICODE_CI"), collation="UNICODE_CI")


# Cleaning steps on their own


def coerce_numeric(spark: SparkSession, folder: str) -> DataFrame:
    return sample.raw_transactions(spark, folder).select(
        F.col("orderID").cast("bigint").alias("order_id"),
        F.col("quantity").alias("quantity_text"),
        to_number(F.col("quantity")).alias("quantity"),
    )


def coerce_date(spark: SparkSession, folder: str) -> DataFrame:
    """Dates in three forms: ISO, month/day/year and eight digits."""
    raw = sample.raw_transactions(spark, folder)
    day, key = F.col("date").try_cast("date"), F.col("orderID").cast("bigint")
    text = F.coalesce(
        F.when(key % 3 == 1, F.date_format(day, "M/d/yyyy")).when(key % 3 == 2, F.date_format(day, "yyyyMMdd")),
        F.col("date"),
    )
    return raw.select(key.alias("order_id"), text.alias("date_text")).withColumn("date_id", to_date(F.col("date_text")))


def impute_median_price(spark: SparkSession, folder: str) -> DataFrame:
    known = cleaning.coerced_products(sample.raw_products(spark, folder))
    return cleaning.impute_price(known.withColumn("delivered_price", F.col("unit_price"))).select(
        "product_id", "delivered_price", "unit_price"
    )


def cleaning_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.cleaning_report(
        _customers(spark, folder), _products(spark, folder), _transactions(spark, folder)
    )


def dedup_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    raw = cleaning.coerced_transactions(sample.raw_transactions(spark, folder))
    return keep_first(raw, "order_id", "file_order").select(*schemas.FACT_SALES.names)


def title_case_texts(spark: SparkSession, folder: str) -> DataFrame:
    return sample.table(spark, folder, "documents").select(
        "doc_id", strip(title_case(F.col("text"))).alias("title")
    )


# Streams


def _stream(spark: SparkSession, folder: str) -> DataFrame:
    return sample.transactions(spark, folder, sample.line_stream(spark, folder))


def _target(spark: SparkSession, name: str) -> dict[str, str]:
    base = scratch_path(spark, name)
    return {"target": f"{base}/table", "checkpoint": f"{base}/checkpoint"}


def stream_enrich(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.stream_enrich(
        _stream(spark, folder), sample.master(spark, folder), **_target(spark, "stream-enrich")
    )


FILE_ROWS = 1 << 22  # rows of a file that one task writes


def stream_batch_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Totals over the micro-batches, of which there are several: the lines come as four times as many files as each may hold."""
    path = scratch_path(spark, "lines")
    rows = sample.table(spark, folder, "lineitem")
    files_per_batch = 1 + rows.count() // (4 * FILE_ROWS)
    rows.repartition(4 * files_per_batch).write.parquet(f"{path}/lineitem.parquet")
    lines = sample.line_stream(spark, path, files_per_batch=files_per_batch, pattern="lineitem.parquet")
    counts = enrichment.stream_batch_counts(
        sample.transactions(spark, folder, lines), sample.master_partial(spark, folder), **_target(spark, "stream-counts")
    )
    return counts.agg(
        (F.count("*") > 1).cast("int").alias("several_batches"),
        F.sum("processed").alias("processed"),
        F.sum("joined").alias("joined"),
    )


LARGE_ROWS = 1 << 24


def stream_bounded_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Rows taken in, and whether every micro-batch kept to its bytes, of large files and many small ones.

    Half of the rows come in one file, or in as many as hold ``LARGE_ROWS`` each, and 24 small
    ones to each take the others; a large file has four times the bytes of a micro-batch.
    """
    path, names = scratch_path(spark, "uneven"), schemas.TRANSACTION_FILE.names
    raw = sample.raw_transactions(spark, folder).select(*names)
    large = (F.col("orderID").cast("bigint") % 2 == 0).eqNullSafe(True)
    parts = 1 + sample.table(spark, folder, "lineitem").count() // (2 * LARGE_ROWS)
    # dealt by all columns, as dealing in turn sorts the rows first
    raw.filter(large).repartition(parts, *names).write.option("header", True).csv(path)
    raw.filter(~large).repartition(24 * parts, *names).write.mode("append").option("header", True).csv(path)
    limit = spark.read.format("binaryFile").load(path).agg(F.sum("length").alias("all")).first()["all"] // (8 * parts)
    source = files.stream_transactions(spark, path, bytes_per_batch=limit)
    place = source.select("*", F.col("file_place.file_path").alias("file"))
    counts = f"{path}-batches"

    def note(batch: DataFrame, name: str) -> None:
        batch.groupBy("file").agg(F.count("*").alias("rows")).write.mode("overwrite").parquet(f"{counts}/batch={name}")

    each_batch(place, note, f"{path}-checkpoint")
    lengths = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length")
    taken = spark.read.schema("file string, rows bigint, batch string").parquet(counts)
    by_batch = (
        taken.withColumn("file", F.regexp_extract("file", "[^/]+$", 0)).join(lengths.withColumn("file", F.regexp_extract("file", "[^/]+$", 0)), "file")
        .groupBy("batch").agg(F.sum("rows").alias("rows"), F.sum("length").alias("bytes"), F.count("*").alias("files"))
    )
    kept = (F.col("bytes") <= limit) | (F.col("files") == 1)
    return by_batch.agg(
        F.sum("rows").alias("processed"), F.min(kept.cast("int")).alias("within_bound"), (F.count("*") > 1).cast("int").alias("several_batches")
    )


def stream_enrich_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Each order once, and whether its row is what one of the order's good copies gives."""
    products = stage(_products(spark, folder), "products")
    raw = sample.raw_transactions(spark, folder, sample.line_stream(spark, folder))
    found = enrichment.stream_enrich_clean(raw, products, **_target(spark, "stream-clean"))
    usable = cleaning.fill_and_require_keys(cleaning.coerced_transactions(sample.raw_transactions(spark, folder)))
    copies = enrich(usable.filter(cleaning.good_quantity()), products)
    return _found_among(found, copies).select("order_id", "is_copy")


def _found_among(found: DataFrame, copies: DataFrame) -> DataFrame:
    """The rows of ``found``, as often as they stand there, and whether ``copies`` hold them; NULLs are equal.

    Both are dealt by their columns once, where a join would need distinct copies first.
    """
    names = found.columns
    seen, held = F.lit(1).alias("_seen"), F.lit(1).alias("is_copy")
    both = found.select(*names, seen, F.lit(0).alias("is_copy")).unionByName(copies.select(*names, F.lit(0).alias("_seen"), held))
    counted = both.groupBy(*names).agg(F.sum("_seen").cast("int").alias("_seen"), F.max("is_copy").alias("is_copy"))
    return counted.filter("_seen > 0").withColumn("_seen", F.explode(F.array_repeat(F.lit(0), F.col("_seen")))).drop("_seen")


def stream_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.stream_unmatched(
        _stream(spark, folder), sample.master_partial(spark, folder), **_target(spark, "stream-unmatched")
    )


def stream_parked(spark: SparkSession, folder: str) -> DataFrame:
    """Sales after the master has grown in two steps, the rows of late products taken up at each."""
    base = scratch_path(spark, "stream-parked")
    target, parked = f"{base}/table", f"{base}/parked"
    parking.stream_enrich_parked(
        _stream(spark, folder), sample.master_partial(spark, folder).filter("store_id % 2 = 0"), target, parked, f"{base}/checkpoint"
    )
    for master in (sample.master_partial(spark, folder), sample.master(spark, folder)):
        parking.release(spark, master, target, parked)
    return tables.read_enriched(spark, target).select(*schemas.FACT_ENRICHED.names)


def stream_store_quarterly(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.stream_store_quarterly(
        _stream(spark, folder),
        sample.master(spark, folder),
        sample.dates(spark, folder),
        sample.stores(spark, folder),
        **_target(spark, "stream-stores"),
    )


# Data quality


def _star_with_gaps(spark: SparkSession, folder: str) -> Star:
    star = sample.SampleStar(spark, folder)
    return Star(
        sales=star.sales,
        dim_date=star.dim_date,
        dim_customer=star.dim_customer.filter("customer_id % 10 <> 9"),
        dim_product=star.dim_product,
        dim_store=star.dim_store.filter("store_id % 5 <> 4"),
        dim_supplier=star.dim_supplier,
    )


def _star_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    star = sample.SampleStar(spark, folder)
    facts = sample.transactions(spark, folder)
    return {name: getattr(star, name) for name in tables.DIMENSIONS} | {
        "dim_date": dimensions.dim_date(facts),
        "fact_sales": facts,
    }


def pk_violations(spark: SparkSession, folder: str) -> DataFrame:
    return quality.pk_violations(_star_tables(spark, folder))


def not_null_violations(spark: SparkSession, folder: str) -> DataFrame:
    raw = cleaning.coerced_transactions(sample.raw_transactions(spark, folder))
    fact = enrich(raw, _products(spark, folder))
    return quality.not_null_violations(_dimensions(spark, folder) | {"fact_sales": fact})


def completion_report(spark: SparkSession, folder: str) -> DataFrame:
    star = sample.SampleStar(spark, folder)
    return quality.completion_report(
        _star_tables(spark, folder)
        | {
            "fact_sales_enriched": star.sales,
            "store_quarterly_sales": olap.q20_store_quarterly_sales(star),
        }
    )


def _registered() -> dict[str, Query]:
    in_year = {"year": YEAR}
    return {
        "scan_transactions_csv": scan_transactions_csv,
        "scan_customers": scan_customers,
        "scan_products": scan_products,
        "scan_products_reordered": scan_products_reordered,
        "warehouse_build_twice": warehouse_build_twice,
        "load_dimensions": load_dimensions,
        "load_dimensions_twice": load_dimensions_twice,
        "fact_sales_load": fact_sales_load,
        "catalog_store_view": catalog_store_view,
        "catalog_defaults": catalog_defaults,
        "bucketed_demographics": bucketed_demographics,
        "numbered_category_by_occupation": numbered_category_by_occupation,
        "table_preview": lambda s, d: tables.preview(sample.sales(s, d)),
        "table_count": lambda s, d: tables.count_rows(sample.sales(s, d)),
        "describe_table": describe_table,
        "dim_customer": lambda s, d: dimensions.dim_customer(_customers(s, d)),
        "dim_product": lambda s, d: dimensions.dim_product(_products(s, d)),
        "dim_store": lambda s, d: dimensions.dim_store(_products(s, d)),
        "dim_supplier": lambda s, d: dimensions.dim_supplier(_products(s, d)),
        "dim_date": lambda s, d: dimensions.dim_date(_transactions(s, d)),
        "product_master": lambda s, d: dimensions.product_master(_products(s, d)),
        "clean_customers": _customers,
        "clean_products": _products,
        "coerce_numeric": coerce_numeric,
        "coerce_date": coerce_date,
        "impute_median_price": impute_median_price,
        "clean_transactions": _transactions,
        "rejected_transactions": _rejected,
        "cleaning_report": cleaning_report,
        "dedup_keep_first": dedup_keep_first,
        "title_case": title_case_texts,
        "fact_enriched": sample.sales,
        "enrich_case_insensitive": enrich_case_insensitive,
        "stream_enrich": stream_enrich,
        "stream_bounded_batches": stream_bounded_batches,
        "stream_batch_counts": stream_batch_counts,
        "stream_enrich_clean": stream_enrich_clean,
        "stream_unmatched": stream_unmatched,
        "stream_parked": stream_parked,
        "stream_store_quarterly": stream_store_quarterly,
        "q01_top_products_daytype_monthly": _on_star(olap.q01_top_products_daytype_monthly, **in_year),
        "q02_demographics_city": _on_star(olap.q02_demographics_city),
        "q03_category_by_occupation": _on_star(olap.q03_category_by_occupation),
        "q04_gender_age_quarterly": _on_star(olap.q04_gender_age_quarterly, **in_year),
        "q05_top_occupations_by_category": _on_star(olap.q05_top_occupations_by_category),
        "q06_city_marital_h2": _on_star(olap.q06_city_marital_h2, **in_year),
        "q07_stay_gender_avg": _on_star(olap.q07_stay_gender_avg),
        "q08_top_cities_by_category": _on_star(olap.q08_top_cities_by_category),
        "q09_monthly_growth_category": _on_star(olap.q09_monthly_growth_category, **in_year),
        "q10_weekend_by_age": _on_star(olap.q10_weekend_by_age, **in_year),
        "q11_top5_products_daytype": _on_star(olap.q11_top5_products_daytype, **in_year),
        "q12_store_quarterly_growth": _on_star(olap.q12_store_quarterly_growth, **in_year),
        "q13_supplier_store_product": _on_star(olap.q13_supplier_store_product),
        "q14_seasonal_products": _on_star(olap.q14_seasonal_products),
        "q15_store_supplier_volatility": _on_star(olap.q15_store_supplier_volatility),
        "q16_product_affinity": _on_star(affinity.q16_product_affinity),
        "q17_rollup": _on_star(olap.q17_rollup),
        "q17_rollup_grouping_id": _on_star(olap.q17_rollup_grouping_id),
        "q18_half_year_split": _on_star(olap.q18_half_year_split, **in_year),
        "product_daily_stats": lambda s, d: olap.product_daily_stats(sample.SampleStar(s, d)).withColumn(
            # the deviation's last digits depend on the order of summation
            "stddev_sales", F.round("stddev_sales", 4)
        ),
        "q19_revenue_spikes": _on_star(olap.q19_revenue_spikes),
        "q19_daily_labelled": _on_star(olap.q19_daily_labelled),
        "q20_store_quarterly_sales": _on_star(olap.q20_store_quarterly_sales),
        "q20_view_preview": _on_star(olap.q20_view_preview),
        "fk_orphans": lambda s, d: quality.fk_orphans(_star_with_gaps(s, d)),
        "pk_violations": pk_violations,
        "not_null_violations": not_null_violations,
        "fk_set_null": lambda s, d: quality.fk_set_null(_star_with_gaps(s, d)),
        "completion_report": completion_report,
    }


def queries() -> dict[str, Query]:
    """Every query by name; each reads the whole tables below the folder."""

    def plain(query: Query) -> Query:
        return lambda spark, folder: _plain(query(spark, folder))

    made = {name: plain(query) for name, query in _registered().items()}
    return made | corpus.queries() if corpus else made


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL giving the same rows."""
    made = oracles.oracle_sql()
    return made | corpus.oracle_sql() if corpus else made


def entry(spark: SparkSession) -> DataFrame:
    """Quarterly sales per store on the smallest sample."""
    return queries()["q20_store_quarterly_sales"](spark, "/root/testdata/sf0.001")
