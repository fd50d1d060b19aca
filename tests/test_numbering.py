"""Dense order numbers."""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from test_olap import make_star

from starmill.functions import distinct
from starmill.operators import numbering
from starmill.operators.numbering import numbered_star, order_numbers
from starmill.plans import olap
from starmill.scratch import scratch_path, stage
from starmill.sources import sample

SALES = [(10**9 * (k % 7) + 1000 * k, k % 3 + 1, "ab"[k % 2], "2017-01-05", 1, 10) for k in range(500)]


def test_numbers_are_dense_and_rise_by_customer(spark):
    star = make_star(spark, SALES + SALES[:100] + [(None, 1, "a", "2017-01-05", 1, 1), (5, 2, "a", "2017-01-05", 1, 1), (5, 1, "b", "2017-01-05", 1, 1)])
    rows = order_numbers(star.sales.repartition(7)).collect()
    assert sorted(r.order_no for r in rows) == list(range(501))
    owner = {order: customer for order, customer, *_ in SALES} | {5: 1}
    in_order = [(owner[r.order_id], r.order_id) for r in sorted(rows, key=lambda r: r.order_no)]
    assert in_order == sorted(in_order)
    assert order_numbers(star.sales.limit(0)).count() == 0


def test_numbered_sales_fold_to_fewer_words(spark, tiny):
    star = sample.SampleStar(spark, tiny)
    numbered = numbered_star(star, scratch_path(spark, "numbered"))
    assert numbered.sales.count() == star.sales.count()
    words = lambda s: olap._folded(s.sales, "customer_id").count()
    customers = star.sales.select("customer_id").distinct().count()
    assert words(numbered) < 2.2 * customers < words(star)
    for query in (olap.q03_category_by_occupation, olap.q14_seasonal_products, lambda s: olap.q10_weekend_by_age(s, 1998)):
        assert sorted(map(str, query(numbered).collect())) == sorted(map(str, query(star).collect()))
    assert olap._order_number(numbered.sales) == "order_no" and distinct.WORD not in numbered.sales.columns
    year = numbered.sales.filter(F.col("sale_year") == 1998)
    assert "PartitionFilters: [isnotnull(sale_year" in year._jdf.queryExecution().executedPlan().toString()


def test_full_sales_are_shuffled_once_and_written_by_shares(spark, tiny, monkeypatch):
    """with a shuffle for the numbers and another for the files, and the enrichment run twice."""
    monkeypatch.setattr(numbering, "SHARE_ROWS", 300, raising=False)
    odd = [
        (9, 1, "a", "2017-01-05", 1, 1), (9, 3, "b", "2016-12-31", 1, 2), (9, 1, "b", "1954-01-01", 1, 2), (9, 1, "a", None, 1, 3),
        (None, 1, "a", "2017-01-05", 1, 4), (None, 2, "a", None, 1, 5), (7, None, "a", "2018-01-01", 1, 6),
    ]
    star = make_star(spark, SALES + odd)
    stored = numbered_star(star, scratch_path(spark, "numbered")).sales
    plain = star.sales.join(order_numbers(star.sales), "order_id", "left")
    key = [*star.sales.columns, "order_no"]
    assert sorted(map(str, stored.select(*key).collect())) == sorted(map(str, plain.select(*key).collect()))
    assert len(stored.inputFiles()) == 6  # two shares of 2017, one each of 1954, 2016, 2018 and of no date
    assert numbered_star(make_star(spark, SALES[:0]), scratch_path(spark, "numbered")).sales.count() == 0
    plan = numbering.numbered_sales(stage(sample.SampleStar(spark, tiny).sales, "sales"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange shufflepartitionidpassthrough") == 2 and "Exchange hashpartitioning(order_id" not in plan
    assert "rebalance" not in plan.lower()


def test_many_products_are_met_in_one_shuffle(spark, tiny, monkeypatch):
    """the fold by product and the join with the products shuffled all sales each."""
    star = numbered_star(sample.SampleStar(spark, tiny), scratch_path(spark, "numbered"))
    queries = (olap.q03_category_by_occupation, olap.q05_top_occupations_by_category, olap.q08_top_cities_by_category)
    few = [sorted(map(str, query(star).collect())) for query in queries]
    monkeypatch.setattr(olap, "fits", lambda df: False)
    monkeypatch.setattr(olap, "PRODUCTS_PER_TASK", 20, raising=False)
    assert [sorted(map(str, query(star).collect())) for query in queries] == few
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for query in queries:
            dealt = re.findall(r"Exchange hashpartitioning\(([^)]*product_id[^)]*)\)", query(star)._jdf.queryExecution().executedPlan().toString())
            assert [re.sub(r"#\d+", "", keys) for keys in dealt] == ["product_id, share, 10"] * 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
