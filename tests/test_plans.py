"""What the plans must look like when no table is small."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from starmill.operators import loads, quality, tables
from starmill.operators.dedupe import keep_first
from starmill.operators.numbering import numbered_star
from starmill.plans import olap
from starmill.plans.star import Star
from starmill.scratch import scratch_path
from starmill.sources import sample


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def stored(spark, tiny):
    base = scratch_path(spark, "warehouse")
    star = sample.SampleStar(spark, tiny)
    loads.load_dimensions({name: getattr(star, name) for name in tables.DIMENSIONS}, base)
    tables.append_enriched(star.sales, f"{base}/fact_sales_enriched")
    return tables.stored_star(spark, base)


LAZY = [name for name in entry._registered() if not name.startswith(("stream", "warehouse"))]


@pytest.mark.parametrize("name", LAZY)
def test_no_query_multiplies_rows(spark, tiny, no_broadcast, name):
    text = plan(entry.queries()[name](spark, tiny))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "MapInPandas" not in text


def test_duplicates_are_cut_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    text = plan(keep_first(df.repartition(3), "k", "o"))
    final, shuffle, partial = (
        text.index("Final"),
        text.index("Exchange hashpartitioning(k"),
        text.index("Partial"),
    )
    assert final < shuffle < partial


@pytest.mark.parametrize(
    "query",
    [
        lambda s: olap.q02_demographics_city(s),
        lambda s: olap.q03_category_by_occupation(s),
        lambda s: olap.q04_gender_age_quarterly(s, 1998),
        lambda s: olap.q06_city_marital_h2(s, 1998),
        lambda s: olap.q10_weekend_by_age(s, 1998),
        lambda s: olap.q14_seasonal_products(s),
        lambda s: olap.q05_top_occupations_by_category(s),
        lambda s: olap.q08_top_cities_by_category(s),
        lambda s: olap.q13_supplier_store_product(s),
        lambda s: olap.q17_rollup(s),
        lambda s: olap.q18_half_year_split(s, 1998),
        lambda s: olap.q19_daily_labelled(s),
        lambda s: olap.q20_store_quarterly_sales(s),
    ],
    ids=["q02", "q03", "q04", "q06", "q10", "q14", "q05", "q08", "q13", "q17", "q18", "q19", "q20"],
)
def test_sales_are_folded_before_they_are_shuffled(no_broadcast, stored, query):
    """Going up from the scan of the fact, an aggregate comes before an exchange."""
    lines = plan(query(stored)).splitlines()
    scan = next(i for i, line in enumerate(lines) if "total_amount" in line and "FileScan" in line)
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
    above = []
    for line in reversed(lines[:scan]):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < depth:
            depth = indent
            above.append(line.strip(" :+-"))
    first = next(op for op in above if op.startswith(("HashAggregate", "Exchange")))
    assert first.startswith("HashAggregate") and "partial_sum" in first


@pytest.mark.parametrize("broadcast", [True, False])
def test_order_counts_meet_customers_folded(no_broadcast, stored, monkeypatch, broadcast):
    """No unfolded fact behind a shuffled join, whether the categories travel or not."""
    monkeypatch.setattr(olap, "fits", lambda df: broadcast)
    for df in (olap.q03_category_by_occupation(stored), olap.q05_top_occupations_by_category(stored)):
        lines = plan(df).splitlines()
        joins = [i for i, line in enumerate(lines) if "SortMergeJoin" in line]
        scan = next(i for i, line in enumerate(lines) if "total_amount" in line and "FileScan" in line)
        folds = [i for i, line in enumerate(lines) if "partial_sum(total_amount" in line]
        assert joins and all(i < folds[0] < scan for i in joins) and len(folds) == 1
        assert "distinct" not in plan(df)


def test_rollup_repeats_folded_rows(no_broadcast, stored):
    text = plan(olap.q17_rollup(stored))
    assert text.count("Expand") == 1
    assert text.index("Expand") < text.index("SortMergeJoin") < text.rindex("partial_sum")


def test_year_reaches_the_files(stored):
    text = plan(olap.q09_monthly_growth_category(stored, 1998))
    assert re.search(r"PartitionFilters: \[.*sale_year.* = 1998", text)
    assert "GreaterThanOrEqual(date_id,1998-01-01)" in text
    read = re.search(r"ReadSchema: struct<product_id:string,date_id:date,total_amount", text)
    assert read, "only the columns needed are read"


def test_half_a_year_is_half_a_year(stored):
    text = plan(olap.q06_city_marital_h2(stored, 1998))
    assert "GreaterThanOrEqual(date_id,1998-07-01)" in text


def test_products_are_scanned_once(spark, tiny):
    text = plan(entry.queries()["clean_products"](spark, tiny))
    assert text.count("FileScan") == 1 and "Window" not in text


def test_ranks_are_cut_before_the_shuffle(no_broadcast, stored):
    text = plan(olap.q11_top5_products_daytype(stored, 1998))
    assert text.count("WindowGroupLimit") == 2


def test_policy_joins_known_orphans_in_place(spark, tiny, stored):
    partial = Star(
        **{
            **{name: getattr(stored, name) for name in tables.DIMENSIONS},
            "sales": stored.sales,
            "dim_store": stored.dim_store.filter("store_id > 3"),
        }
    )
    text = plan(quality.fk_set_null(partial))
    assert "SortMergeJoin" not in text and "Exchange hash" not in text


def test_a_hot_customer_is_split(spark, stored):
    """AQE cuts a partition that a single customer fills."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "3KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    hot = stored.sales.withColumn(
        "customer_id", F.when(F.col("order_id") % 3 == 0, F.lit(7)).otherwise(F.col("customer_id"))
    ).repartition(8)
    star = Star(**{**{n: getattr(stored, n) for n in tables.DIMENSIONS}, "sales": hot})
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df = olap.q03_category_by_occupation(star)
        rows = df.collect()
        text = plan(df)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "SortMergeJoin(skew=true)" in text
    assert rows == olap.q03_category_by_occupation(star).collect()


@pytest.mark.parametrize("query", [olap.q03_category_by_occupation, olap.q05_top_occupations_by_category, olap.q08_top_cities_by_category], ids=["q03", "q05", "q08"])
@pytest.mark.parametrize("numbered", [False, True])
def test_shares_of_products_stay_out_of_the_driver(spark, tiny, monkeypatch, query, numbered):
    """F1-F4: products repeated for the shares were broadcast, as Spark took their file's size for theirs."""
    star = sample.SampleStar(spark, tiny)
    star = numbered_star(star, scratch_path(spark, "numbered")) if numbered else star
    few = query(star).collect()
    monkeypatch.setattr(olap, "fits", lambda df: False)
    df = query(star)
    assert df.collect() == few
    joins = re.findall(r"(\w+Join)[^\[]*\[product_id#\d+, share#\d+\], \[", plan(df))
    assert joins and set(joins) == {"SortMergeJoin"}
