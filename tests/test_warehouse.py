"""The whole way from files to answers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starmill import schemas
from starmill.operators import cleaning, enrich, quality, tables
from starmill.plans import olap
from starmill.plans.warehouse import build_warehouse, stored_tables
from starmill.scratch import exists, scope, scratch_path
from starmill.sources import files, sample


def test_files_to_answers(spark, tiny):
    base = scratch_path(spark, "whole")
    raw = {
        "customers": (sample.raw_customers(spark, tiny), schemas.CUSTOMER_FILE),
        "products": (sample.raw_products(spark, tiny), schemas.PRODUCT_FILE),
        "transactions": (sample.raw_transactions(spark, tiny), schemas.TRANSACTION_FILE),
    }
    for name, (df, schema) in raw.items():
        # one file in order, so that first copies are where they should be
        rows = df.coalesce(1).sortWithinPartitions("file_order").select(*schema.names)
        rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False
        ).csv(f"{base}/in/{name}")
    inputs = [f"{base}/in/{name}" for name in raw]
    star = build_warehouse(spark, *inputs, f"{base}/warehouse")
    before = {name: df.count() for name, df in stored_tables(spark, f"{base}/warehouse").items()}
    with pytest.raises(FileExistsError):
        build_warehouse(spark, *inputs, f"{base}/warehouse")
    assert {name: df.count() for name, df in stored_tables(spark, f"{base}/warehouse").items()} == before
    star = build_warehouse(spark, *inputs, f"{base}/warehouse", replace=True)
    assert {name: df.count() for name, df in stored_tables(spark, f"{base}/warehouse").items()} == before

    products = cleaning.clean_products(raw["products"][0])
    facts = stored_tables(spark, f"{base}/warehouse")["fact_sales"]
    expected = cleaning.clean_transactions(raw["transactions"][0]).kept
    assert facts.exceptAll(expected).isEmpty() and expected.exceptAll(facts).isEmpty()
    sales = enrich.enrich(cleaning.coerced_transactions(raw["transactions"][0]), products)
    stored = star.sales.select(*schemas.FACT_ENRICHED.names)
    assert stored.exceptAll(sales).isEmpty() and sales.exceptAll(stored).isEmpty()

    report = quality.completion_report(
        {name: getattr(star, name) for name in tables.DIMENSIONS}
        | {"fact_sales": facts, "sales": star.sales, "view": olap.q20_store_quarterly_sales(star)}
    )
    assert report.filter("is_complete = 0").isEmpty()
    duplicates = quality.pk_violations({name: getattr(star, name) for name in tables.DIMENSIONS})
    assert duplicates.agg(F.sum("duplicate_keys")).first()[0] == 0
    assert olap.q04_gender_age_quarterly(star, 1998).count() > 0


def test_masters_are_read_by_name(spark):
    base = scratch_path(spark, "masters")
    rows = spark.createDataFrame([("7", "Shop", "P1", "2.50", "3", "Maker", "toys", "x")], [
        "storeID", "storeName", "Product_ID", "price$", "supplierID", "supplierName", "Product_Category", "more"])
    rows.write.option("header", True).csv(f"{base}/products")
    rows.write.parquet(f"{base}/products.parquet")
    for path in (f"{base}/products", f"{base}/products.parquet"):
        row = files.read_products(spark, path).first()
        assert (row.supplierID, row.storeName, row["price$"]) == ("3", "Shop", "2.50")
    rows.drop("storeName").write.option("header", True).csv(f"{base}/lacking")
    with pytest.raises(ValueError, match="storeName"):
        files.read_products(spark, f"{base}/lacking")


def test_repeated_keys_are_refused(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "supplier_id int, supplier_name string")
    with pytest.raises(ValueError, match="more than once.*without a key"):
        quality.require_keys({"dim_supplier": twice})


def test_scratch_is_emptied(spark):
    with scope(spark):
        path = scratch_path(spark, "within")
        spark.range(3).write.parquet(path)
        assert exists(spark, path)
    assert not exists(spark, path)
