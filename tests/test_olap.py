"""Hand-made rows for the cases the sample does not hold."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmill import schemas
from starmill.operators import dimensions
from starmill.plans import olap
from starmill.plans.star import Star
from starmill.sources import sample


def make_star(spark, sales, calendar_of=None):
    """Sales given as (order, customer, product, date, quantity, amount[, store, supplier])."""
    rows = []
    for row in sales:
        order, customer, product, day, quantity, amount = row[:6]
        store, supplier = row[6:] or (1, 1)
        day = None if day is None else dt.date.fromisoformat(day)
        rows.append((order, customer, product, day, quantity, Decimal(1), store, supplier, Decimal(amount)))
    fact = spark.createDataFrame(rows, schemas.FACT_ENRICHED)
    customers = [
        (i, "Male" if i % 2 else "Female", "26-35", "26-35", "clerk" if i < 3 else "cook", "A", "2", "Single")
        for i in range(1, 6)
    ]
    products = [(p, "toys" if p in "ab" else "food", Decimal(1)) for p in "abcd"]
    return Star(
        sales=fact,
        dim_date=dimensions.dim_date(fact if calendar_of is None else calendar_of),
        dim_customer=spark.createDataFrame(customers, schemas.DIM_CUSTOMER),
        dim_product=spark.createDataFrame(products, schemas.DIM_PRODUCT),
        dim_store=spark.createDataFrame([(1, "one", None), (2, "two", None)], schemas.DIM_STORE),
        dim_supplier=spark.createDataFrame([(1, "acme"), (2, None)], schemas.DIM_SUPPLIER),
    )


def test_growth_compares_with_the_previous_month_there_is(spark):
    star = make_star(
        spark,
        [(1, 1, "a", "2017-01-05", 1, 100), (2, 1, "a", "2017-03-05", 1, 150), (3, 1, "a", "2016-12-01", 1, 7)],
    )
    rows = olap.q09_monthly_growth_category(star, 2017).collect()
    assert [(r.month, r.previous_month_sales, r.growth_percentage) for r in rows] == [
        (1, None, None),
        (3, Decimal(100), Decimal(50)),
    ]


def test_growth_from_zero_is_null(spark):
    sales = [(1, 1, "a", "2017-01-05", 0, 0), (2, 1, "a", "2017-04-05", 1, 10)]
    star = make_star(spark, sales)
    assert [r.growth_percentage for r in olap.q09_monthly_growth_category(star, 2017).collect()] == [None, None]
    assert [r.growth_rate for r in olap.q12_store_quarterly_growth(star, 2017).collect()] == [None, None]
    volatility = olap.q15_store_supplier_volatility(star).collect()
    assert [r.volatility_percentage for r in volatility] == [None, None]


def test_growth_ties_round_up(spark):
    # 12.345 % exactly; as a binary fraction it may lie just below
    sales = [(1, 1, "a", "2017-01-05", 1, "10000.00"), (2, 1, "a", "2017-02-05", 1, "11234.50")]
    rows = olap.q09_monthly_growth_category(make_star(spark, sales), 2017).collect()
    assert rows[1].growth_percentage == Decimal("12.35")


def test_volatility_looks_across_years(spark):
    sales = [(1, 1, "a", "2016-12-05", 1, 100), (2, 1, "a", "2017-01-05", 1, 50)]
    rows = olap.q15_store_supplier_volatility(make_star(spark, sales)).collect()
    assert [r.volatility_percentage for r in rows] == [None, Decimal(-50)]


def test_twice_the_mean_is_no_spike(spark):
    sales = [
        (1, 1, "a", "2017-01-01", 1, 2),
        (2, 1, "a", "2017-01-02", 1, 0),
        (3, 1, "a", "2017-01-03", 1, 1),
        (4, 1, "b", "2017-01-01", 1, 9),
        (5, 1, "b", "2017-01-02", 1, 1),
        (6, 1, "b", "2017-01-03", 1, 1),
    ]
    star = make_star(spark, sales)
    labels = {(r.product_id, r.daily_sales): r.anomaly_flag for r in olap.q19_daily_labelled(star).collect()}
    assert labels["a", 2] == "NORMAL"
    assert labels["b", 9] == "SPIKE/OUTLIER"
    spikes = olap.q19_revenue_spikes(star).collect()
    assert [(r.product_id, r.daily_sales) for r in spikes] == [("b", 9)]


def test_spike_of_a_product_without_sales_value(spark):
    star = make_star(spark, [(1, 1, "a", "2017-01-01", 0, 0)])
    row = olap.q19_daily_labelled(star).first()
    assert (row.sales_multiplier, row.anomaly_flag) == (None, "NORMAL")


def test_deviation_is_of_the_population(spark):
    sales = [(i, 1, "a", f"2017-01-0{i}", 1, amount) for i, amount in ((1, 1), (2, 2), (3, 4))]
    row = olap.product_daily_stats(make_star(spark, sales)).first()
    assert row.stddev_sales == pytest.approx(1.2472, abs=1e-4)
    assert row.avg_daily_sales == pytest.approx(7 / 3)


def test_equal_sums_share_a_rank(spark):
    sales = [(1, 1, "a", "2017-01-02", 1, 10), (2, 3, "a", "2017-01-02", 1, 10), (3, 4, "c", "2017-01-02", 1, 5)]
    rows = olap.q05_top_occupations_by_category(make_star(spark, sales)).collect()
    assert [(r.product_category, r.occupation, r.sales_rank) for r in rows] == [
        ("food", "cook", 1),
        ("toys", "clerk", 1),
        ("toys", "cook", 1),
    ]


def test_ranks_after_a_tie_are_skipped_and_ties_are_kept(spark):
    sales = [(i, 1, p, "2017-01-02", 1, v) for i, (p, v) in enumerate([("a", 9), ("b", 9), ("c", 5), ("d", 5)])]
    star = make_star(spark, sales)
    rows = olap.q11_top5_products_daytype(star, 2017, top=3).collect()
    assert [(r.product_id, r.product_rank) for r in rows] == [("a", 1), ("b", 1), ("c", 3), ("d", 3)]


def test_rollup_tells_totals_from_missing_names(spark):
    sales = [(1, 1, "a", "2017-01-02", 1, 10, 1, 2), (2, 1, "a", "2017-01-02", 1, 5, 1, 1)]
    rows = olap.q17_rollup_grouping_id(make_star(spark, sales)).collect()
    nameless = [
        (r.grouping_id, r.total_revenue)
        for r in rows
        if (r.year, r.store_name, r.supplier_name, r.product_id) == (2017, "one", None, None)
    ]
    # the store's total and the supplier without a name
    assert sorted(nameless) == [(1, Decimal(10)), (3, Decimal(15))]


def test_sales_on_days_outside_the_calendar_drop_out(spark):
    star = make_star(
        spark,
        [(1, 1, "a", "2017-01-02", 1, 10), (2, 1, "a", "2017-01-03", 1, 5), (3, 1, "a", None, 1, 2)],
        calendar_of=spark.createDataFrame([(dt.date(2017, 1, 2),)], "date_id date"),
    )
    assert olap.q20_store_quarterly_sales(star).first().total_sales == 10


def test_limit_is_over_all_months(spark):
    sales = [(i, 1, p, f"2017-0{m}-02", 1, i) for i, (m, p) in enumerate([(1, "a"), (1, "b"), (2, "c"), (2, "d")], 1)]
    rows = olap.q01_top_products_daytype_monthly(make_star(spark, sales), 2017, limit=2).collect()
    assert [(r.month, r.product_id) for r in rows] == [(1, "b"), (1, "a")]


def test_distinct_customers_and_row_means(spark):
    sales = [
        (1, 1, "a", "2017-01-02", 1, 10),
        (1, 1, "a", "2017-01-02", 1, 10),
        (2, 1, "b", "2017-01-07", 1, 40),
        (3, 3, "b", "2017-01-02", 1, 20),
    ]
    star = make_star(spark, sales)
    (row,) = olap.q02_demographics_city(star).collect()
    assert (row.total_purchase_amount, row.customer_count, row.avg_purchase_amount) == (80, 2, 20.0)
    weekday, weekend = olap.q10_weekend_by_age(star, 2017).collect()
    assert (weekday.day_type, weekday.total_orders) == ("Weekday", 2)
    assert weekday.avg_order_value == pytest.approx(40 / 3)
    assert (weekend.day_type, weekend.total_orders, weekend.total_sales) == ("Weekend", 1, 40)


def test_halves_add_up_to_the_year(spark, tiny):
    rows = olap.q18_half_year_split(sample.SampleStar(spark, tiny), 1998).collect()
    assert rows
    for r in rows:
        assert r.h1_revenue + r.h2_revenue == r.yearly_revenue
        assert r.h1_quantity + r.h2_quantity == r.yearly_quantity


def test_rollup_total_is_the_sum_of_its_leaves(spark, tiny):
    rollup = olap.q17_rollup_grouping_id(sample.SampleStar(spark, tiny))
    sums = {r.grouping_id: r.s for r in rollup.groupBy("grouping_id").agg(F.sum("total_revenue").alias("s")).collect()}
    assert set(sums) == {0, 1, 3, 7, 15}
    assert len(set(sums.values())) == 1


def test_orders_of_several_customers_count_once(spark):
    """One order id of two customers and two products is one order wherever both belong."""
    sales = [(7, 1, "a", "2017-01-05", 1, 10), (7, 2, "b", "2017-01-05", 1, 10), (7, 4, "c", "2017-02-06", 2, 5), (None, 1, "a", "2017-01-05", 1, 1), (-3, 1, "a", "2017-01-05", 1, 1), (7, 1, "a", "2017-01-05", 1, 10)]
    star = make_star(spark, sales)
    assert [(r.occupation, r.product_category, r.total_sales, r.total_quantity, r.total_orders) for r in olap.q03_category_by_occupation(star).collect()] == [
        ("clerk", "toys", 32, 5, 2), ("cook", "food", 5, 2, 1),
    ]
    assert [(r.quarter, r.gender, r.total_orders) for r in olap.q04_gender_age_quarterly(star, 2017).collect()] == [(1, "Female", 1), (1, "Male", 2)]
    assert [(r.day_type, r.total_orders, r.avg_order_value) for r in olap.q10_weekend_by_age(star, 2017).collect()] == [("Weekday", 2, 37 / 6)]
    seasons = olap.q14_seasonal_products(star).collect()
    assert [(r.product_id, r.total_orders) for r in seasons] == [("a", 2), ("b", 1), ("c", 1)]


def test_numbered_orders_give_the_same(spark):
    sales = [(10**12 + 977 * k, k % 5 + 1, "abcd"[k % 4], "2017-01-05", 1, 10) for k in range(200)] * 2
    star = make_star(spark, sales)
    numbered = star.sales.withColumn("order_no", (F.col("order_id") - 10**12) / 977)
    numbered = numbered.withColumn("order_no", F.col("order_no").cast("bigint"))
    other = Star(**{**star.__dict__, "sales": numbered})
    assert olap.q03_category_by_occupation(star).collect() == olap.q03_category_by_occupation(other).collect()
