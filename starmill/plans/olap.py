"""The analytical queries, each from a Star to a DataFrame.

Two rules shape the plans:

* Sales are aggregated by their own keys before a dimension is joined,
  wherever the measures allow it. A product or customer that holds a third of
  all sales then leaves each task as one row, the join meets every key once,
  and labels are never shuffled with the facts. Exact distinct counts do not
  allow it; those queries join first and leave skewed keys to AQE, which
  splits them.
* The calendar is the only table with a hinted broadcast: one year of it has
  at most 366 rows, and the whole of it is counted first. Every other join is
  left to Spark, which knows the sizes.

``year(date_id)`` is what dim_date calls year, so a year filter also limits
``date_id`` in the fact, where it prunes files and row groups.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.functions import distinct
from starmill.functions.calendar import day_type
from starmill.operators.joins import broadcast_if_fits, fits
from starmill.plans.star import Star
from starmill.schemas import SALE_YEAR

SHARES = 8  # tasks that share the sales of a product
PRODUCTS_PER_TASK = 1 << 14  # whose sales a task folds, where the products do not travel


def _amount() -> Column:
    return F.sum("total_amount")


def _quantity() -> Column:
    return F.sum("quantity")


def _sales(star: Star, year: int | None = None, first_month: int = 1) -> DataFrame:
    if year is None:
        return star.sales
    first, last = dt.date(year, first_month, 1), dt.date(year, 12, 31)
    sales = star.sales.filter(F.col("date_id").between(F.lit(first), F.lit(last)))
    if SALE_YEAR in sales.columns:
        sales = sales.filter(F.col(SALE_YEAR) == year)
    return sales


def _dated(star: Star, *attributes: str, year: int | None = None, first_month: int = 1) -> DataFrame:
    """Sales with calendar attributes, one year of them if given, from a month on."""
    calendar = star.dim_date.filter(F.col("month") >= first_month) if first_month > 1 else star.dim_date
    if year is None:
        calendar = broadcast_if_fits(calendar.select("date_id", *attributes))
    else:
        calendar = F.broadcast(calendar.filter(F.col("year") == year).select("date_id", *attributes))
    return _sales(star, year, first_month).join(calendar, "date_id")


def _mean(total: Column, rows: Column) -> Column:
    return total.cast("double") / rows


def _ratio(part: Column, whole: Column) -> Column:
    """Exact quotient to nine decimals; NULL if the divisor is zero.

    Binary fractions would round ties such as 12.345 % at random.
    """
    return F.try_divide(part.cast("decimal(22,2)"), whole.cast("decimal(20,2)")).cast("decimal(30,9)")


def _growth(current: str, previous: str) -> Column:
    """Change in percent; NULL without a previous value or if it was zero."""
    now, before = F.col(current), F.col(previous)
    return F.round(_ratio(now - before, before) * 100, 2)


def q01_top_products_daytype_monthly(star: Star, year: int, limit: int = 60) -> DataFrame:
    """Products by revenue per month and day type; one limit over all of it."""
    keys = ["year", "month", "month_name", "is_weekend"]
    return (
        _dated(star, *keys, year=year)
        .groupBy(*keys, "product_id")
        .agg(_amount().alias("total_revenue"), _quantity().alias("total_quantity"))
        .join(star.dim_product.select("product_id", "product_category"), "product_id")
        .select(
            *keys,
            day_type(F.col("is_weekend")).alias("day_type"),
            "product_id",
            "product_category",
            "total_revenue",
            "total_quantity",
        )
        .orderBy("month", "is_weekend", F.desc("total_revenue"), "product_id")
        .limit(limit)
    )


def _by_customer(star: Star) -> DataFrame:
    """One row per customer who bought something, with the customer's traits."""
    totals = star.sales.groupBy("customer_id").agg(
        _amount().alias("amount"), F.count("total_amount").alias("rows")
    )
    return totals.join(star.dim_customer, "customer_id")


def _customer_totals() -> list[Column]:
    return [
        F.sum("amount").alias("total_purchase_amount"),
        F.count("customer_id").alias("customer_count"),
        _mean(F.sum("amount"), F.sum("rows")).alias("avg_purchase_amount"),
    ]


def q02_demographics_city(star: Star) -> DataFrame:
    keys = ["gender", "age_group", "city_category"]
    return (
        _by_customer(star)
        .groupBy(*keys)
        .agg(*_customer_totals())
        .orderBy(F.desc("total_purchase_amount"), *keys)
    )


def _order_number(sales: DataFrame) -> str:
    """What tells orders apart: dense numbers where the sales have been numbered, else their ids."""
    return "order_no" if "order_no" in sales.columns else "order_id"


def _folded(sales: DataFrame, *keys: str, orders: bool = True) -> DataFrame:
    """``amount``, ``items`` and ``rows`` of the sales by keys, and with ``orders`` also by words of orders."""
    measures = [_amount().alias("amount"), _quantity().alias("items"), F.count("total_amount").alias("rows")]
    if not orders:
        return sales.groupBy(*keys).agg(*measures)
    number = _order_number(sales)
    return sales.groupBy(*keys, distinct.word(number)).agg(*measures, distinct.bits(number))


def _by_category(star: Star, *keys: str, orders: bool = False) -> DataFrame:
    """Sales folded by ``keys`` and product_category.

    Where the products' categories are few enough to travel, they are joined first, and the
    sales are folded once. Otherwise they are folded by product, meet the
    products as folded rows, and are folded again. Few customers buy a product twice, so the first fold
    leaves nearly all rows: it takes them as they are dealt for the join, in one shuffle, a product's customers
    in ``SHARES`` shares, since a product may hold a third of all sales.
    """
    categories = star.dim_product.select("product_id", "product_category")
    if fits(categories):
        return _folded(star.sales.join(F.broadcast(categories), "product_id"), *keys, "product_category", orders=orders)
    again = [F.sum(c).alias(c) for c in ("amount", "items", "rows")]
    tasks = categories.count() // PRODUCTS_PER_TASK
    more = [tasks] if tasks > int(categories.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
    dealt = star.sales.withColumn("share", F.pmod(F.hash(*keys), F.lit(SHARES))).repartition(*more, "product_id", "share")
    # sorted, not broadcast: Spark takes a row for each product, where there are SHARES of them, and would pass them through the driver
    in_shares = categories.withColumn("share", F.explode(F.array(*map(F.lit, range(SHARES))))).hint("merge")
    by_product = _folded(dealt, *keys, "product_id", "share", orders=orders).join(in_shares, ["product_id", "share"])
    word = [distinct.WORD] if orders else []
    return by_product.groupBy(*keys, "product_category", *word).agg(*again, *([distinct.united()] if orders else []))


def _with_orders(folded: DataFrame, customers: DataFrame, *keys: str) -> DataFrame:
    """``amount``, ``items``, ``rows`` and ``total_orders`` by traits of customers and other keys.

    The folded sales meet the customers, are folded to words of orders by ``keys``, and
    these are counted.
    """
    sums = [F.sum(c).alias(c) for c in ("amount", "items", "rows")]
    return (
        folded.join(customers, "customer_id")
        .groupBy(*keys, distinct.WORD).agg(*sums, distinct.united())
        .groupBy(*keys).agg(*sums, distinct.counted().alias("total_orders"))
    )


def q03_category_by_occupation(star: Star) -> DataFrame:
    return (
        _with_orders(
            _by_category(star, "customer_id", orders=True),
            star.dim_customer.select("customer_id", "occupation"),
            "occupation",
            "product_category",
        )
        .select(
            "occupation",
            "product_category",
            F.col("amount").alias("total_sales"),
            F.col("items").alias("total_quantity"),
            "total_orders",
        )
        .orderBy("occupation", F.desc("total_sales"), "product_category")
    )


def q04_gender_age_quarterly(star: Star, year: int) -> DataFrame:
    keys = ["year", "quarter", "gender", "age_group"]
    return (
        _with_orders(
            _folded(_dated(star, "year", "quarter", year=year), "customer_id", "year", "quarter"),
            star.dim_customer.select("customer_id", "gender", "age_group"),
            *keys,
        )
        .select(*keys, F.col("amount").alias("total_purchase_amount"), "total_orders")
        .orderBy(*keys)
    )


def _top_traits_by_category(star: Star, trait: str, total: str, rank: str, top: int) -> DataFrame:
    best = Window.partitionBy("product_category").orderBy(F.desc(total))
    return (
        _by_category(star, "customer_id")
        .join(star.dim_customer.select("customer_id", trait), "customer_id")
        .groupBy("product_category", trait)
        .agg(F.sum("amount").alias(total))
        .withColumn(rank, F.rank().over(best))
        .filter(F.col(rank) <= top)
        .orderBy("product_category", rank, trait)
    )


def q05_top_occupations_by_category(star: Star, top: int = 5) -> DataFrame:
    return _top_traits_by_category(star, "occupation", "total_sales", "sales_rank", top)


def q06_city_marital_h2(star: Star, year: int) -> DataFrame:
    keys = ["year", "month", "month_name", "city_category", "marital_status"]
    months = ["year", "month", "month_name"]
    return (
        _with_orders(
            _folded(_dated(star, *months, year=year, first_month=7), "customer_id", *months),
            star.dim_customer.select("customer_id", "city_category", "marital_status"),
            *keys,
        )
        .select(*keys, F.col("amount").alias("total_purchase_amount"), "total_orders")
        .orderBy("year", "month", "city_category", "marital_status")
    )


def q07_stay_gender_avg(star: Star) -> DataFrame:
    keys = ["stay_in_current_city_years", "gender"]
    return (
        _by_customer(star)
        .groupBy(*keys)
        .agg(*_customer_totals())
        .orderBy(*keys)
    )


def q08_top_cities_by_category(star: Star, top: int = 5) -> DataFrame:
    return _top_traits_by_category(star, "city_category", "total_revenue", "city_rank", top)


def q09_monthly_growth_category(star: Star, year: int) -> DataFrame:
    months = ["year", "month", "month_name"]
    in_order = Window.partitionBy("product_category").orderBy("year", "month")
    return (
        _dated(star, *months, year=year)
        .groupBy(*months, "product_id")
        .agg(_amount().alias("amount"))
        .join(star.dim_product.select("product_id", "product_category"), "product_id")
        .groupBy(*months, "product_category")
        .agg(F.sum("amount").alias("current_month_sales"))
        .withColumn("previous_month_sales", F.lag("current_month_sales").over(in_order))
        .withColumn("growth_percentage", _growth("current_month_sales", "previous_month_sales"))
        .orderBy("product_category", "month")
    )


def q10_weekend_by_age(star: Star, year: int) -> DataFrame:
    return (
        _with_orders(
            _folded(_dated(star, "is_weekend", year=year), "customer_id", "is_weekend"),
            star.dim_customer.select("customer_id", "age_group"),
            "age_group",
            "is_weekend",
        )
        .orderBy("age_group", "is_weekend")
        .select(
            "age_group",
            day_type(F.col("is_weekend")).alias("day_type"),
            F.col("amount").alias("total_sales"),
            "total_orders",
            # per sales row, although the name says order
            _mean(F.col("amount"), F.col("rows")).alias("avg_order_value"),
        )
    )


def q11_top5_products_daytype(star: Star, year: int, top: int = 5) -> DataFrame:
    periods = ["year", "month", "is_weekend"]
    best = Window.partitionBy(*periods).orderBy(F.desc("revenue"))
    return (
        _dated(star, *periods, year=year)
        .groupBy(*periods, "product_id")
        .agg(_amount().alias("revenue"))
        .join(star.dim_product.select("product_id", "product_category"), "product_id")
        .withColumn("product_rank", F.rank().over(best))
        .filter(F.col("product_rank") <= top)
        .select(
            "year",
            "month",
            day_type(F.col("is_weekend")).alias("day_type"),
            "product_id",
            "product_category",
            "revenue",
            "product_rank",
        )
        .orderBy("month", "day_type", "product_rank", "product_id")
    )


def q12_store_quarterly_growth(star: Star, year: int) -> DataFrame:
    in_order = Window.partitionBy("store_id").orderBy("quarter")
    return (
        _dated(star, "quarter", year=year)
        .groupBy("store_id", "quarter")
        .agg(_amount().alias("quarterly_revenue"))
        .join(star.dim_store.select("store_id", "store_name"), "store_id")
        .withColumn("previous_quarter_revenue", F.lag("quarterly_revenue").over(in_order))
        .select(
            "store_id",
            "store_name",
            "quarter",
            "quarterly_revenue",
            "previous_quarter_revenue",
            _growth("quarterly_revenue", "previous_quarter_revenue").alias("growth_rate"),
        )
        .orderBy("store_id", "quarter")
    )


def q13_supplier_store_product(star: Star) -> DataFrame:
    return (
        star.sales.groupBy("store_id", "supplier_id", "product_id")
        .agg(_amount().alias("total_sales"), _quantity().alias("total_quantity"))
        .join(star.dim_product.select("product_id", "product_category"), "product_id")
        .join(star.dim_store.select("store_id", "store_name"), "store_id")
        .join(star.dim_supplier, "supplier_id")
        .select(
            "store_id",
            "store_name",
            "supplier_id",
            "supplier_name",
            "product_id",
            "product_category",
            "total_sales",
            "total_quantity",
        )
        .orderBy("store_name", "supplier_name", F.desc("total_sales"), "product_id")
    )


def q14_seasonal_products(star: Star) -> DataFrame:
    return (
        _folded(_dated(star, "season"), "season", "product_id")
        .groupBy("season", "product_id")
        .agg(
            F.sum("amount").alias("total_sales"),
            F.sum("items").alias("total_quantity"),
            distinct.counted().alias("total_orders"),
        )
        .join(star.dim_product.select("product_id", "product_category"), "product_id")
        .select(
            "season",
            "product_id",
            "product_category",
            "total_sales",
            "total_quantity",
            "total_orders",
        )
        .orderBy("season", F.desc("total_sales"), "product_id")
    )


def q15_store_supplier_volatility(star: Star) -> DataFrame:
    in_order = Window.partitionBy("store_id", "supplier_id").orderBy("year", "month")
    return (
        _dated(star, "year", "month")
        .groupBy("store_id", "supplier_id", "year", "month")
        .agg(_amount().alias("monthly_revenue"))
        .join(star.dim_store.select("store_id", "store_name"), "store_id")
        .join(star.dim_supplier, "supplier_id")
        .withColumn("previous_month_revenue", F.lag("monthly_revenue").over(in_order))
        .select(
            "store_id",
            "store_name",
            "supplier_id",
            "supplier_name",
            "year",
            "month",
            "monthly_revenue",
            "previous_month_revenue",
            _growth("monthly_revenue", "previous_month_revenue").alias("volatility_percentage"),
        )
        .orderBy("store_id", "supplier_id", "year", "month")
    )


_ROLLUP = ["year", "store_name", "supplier_name", "product_id"]


def _rolled_up(star: Star, *measures: Column) -> DataFrame:
    """Subtotals over year, store, supplier and product.

    The rollup repeats its input once per level, so it is given one row per
    year and product instead of the sales themselves.
    """
    leaves = (
        _dated(star, "year")
        .groupBy("year", "store_id", "supplier_id", "product_id")
        .agg(_amount().alias("amount"), _quantity().alias("items"))
        .join(star.dim_product.select("product_id"), "product_id")
        .join(star.dim_store.select("store_id", "store_name"), "store_id")
        .join(star.dim_supplier, "supplier_id")
    )
    return (
        leaves.rollup(*_ROLLUP)
        .agg(F.sum("amount").alias("total_revenue"), F.sum("items").alias("total_quantity"), *measures)
        .orderBy(*_ROLLUP)
    )


def q17_rollup(star: Star) -> DataFrame:
    return _rolled_up(star)


def q17_rollup_grouping_id(star: Star) -> DataFrame:
    """As q17, with what tells a total from a NULL key."""
    return _rolled_up(star, F.grouping_id().alias("grouping_id"))


def q18_half_year_split(star: Star, year: int) -> DataFrame:
    halves = {"h1": F.col("month").between(1, 6), "h2": F.col("month").between(7, 12)}
    measures = {"revenue": "total_amount", "quantity": "quantity"}
    split = [
        F.sum(F.when(months, F.col(column)).otherwise(0)).alias(f"{half}_{name}")
        for name, column in measures.items()
        for half, months in halves.items()
    ]
    return (
        _dated(star, "month", year=year)
        .groupBy("product_id")
        .agg(*split, _amount().alias("yearly_revenue"), _quantity().alias("yearly_quantity"))
        .join(star.dim_product.select("product_id", "product_category"), "product_id")
        .select(
            "product_id",
            "product_category",
            "h1_revenue",
            "h2_revenue",
            "h1_quantity",
            "h2_quantity",
            "yearly_revenue",
            "yearly_quantity",
        )
        .orderBy(F.desc("yearly_revenue"), "product_id")
    )


def _daily(star: Star) -> DataFrame:
    return (
        star.sales.groupBy("product_id", "date_id")
        .agg(_amount().alias("daily_sales"))
        .join(star.dim_product.select("product_id", "product_category"), "product_id")
    )


def product_daily_stats(star: Star) -> DataFrame:
    """Mean and population deviation of the daily sales of each product."""
    return (
        _daily(star)
        .groupBy("product_id", "product_category")
        .agg(
            _mean(F.sum("daily_sales"), F.count("daily_sales")).alias("avg_daily_sales"),
            F.stddev_pop("daily_sales").alias("stddev_sales"),
        )
    )


def _labelled_days(star: Star) -> DataFrame:
    """Daily sales against the product's mean.

    A product has at most one row per calendar day here, so the window stays
    small. The test is exact: sales > 2 * total / n without the division.
    """
    days = Window.partitionBy("product_id")
    n, total = F.count("daily_sales").over(days), F.sum("daily_sales").over(days)
    spike = F.col("daily_sales") * F.col("n") > 2 * F.col("total")
    mean = F.col("total").cast("double") / F.col("n")
    return (
        _daily(star)
        .withColumns({"n": n, "total": total})
        .select(
            "product_id",
            "product_category",
            "date_id",
            "daily_sales",
            mean.alias("avg_daily_sales"),
            F.round(_ratio(F.col("daily_sales") * F.col("n"), F.col("total")), 2).alias(
                "sales_multiplier"
            ),
            F.when(spike, "SPIKE/OUTLIER").otherwise("NORMAL").alias("anomaly_flag"),
        )
    )


def q19_revenue_spikes(star: Star, limit: int = 50) -> DataFrame:
    return (
        _labelled_days(star)
        .filter("anomaly_flag = 'SPIKE/OUTLIER'")
        .orderBy(F.desc("sales_multiplier"), F.desc("daily_sales"), "product_id", "date_id")
        .limit(limit)
    )


def q19_daily_labelled(star: Star) -> DataFrame:
    """Every product day with its label."""
    return _labelled_days(star)


STORE_QUARTERLY_SALES = "store_quarterly_sales"


def q20_store_quarterly_sales(star: Star) -> DataFrame:
    """Registers the store view and returns it; readers sort for themselves."""
    _store_quarters(star).createOrReplaceTempView(STORE_QUARTERLY_SALES)
    return star.sales.sparkSession.table(STORE_QUARTERLY_SALES)


def _store_quarters(star: Star) -> DataFrame:
    return (
        _dated(star, "year", "quarter")
        .groupBy("store_id", "year", "quarter")
        .agg(_amount().alias("total_sales"), _quantity().alias("total_qty"))
        .join(star.dim_store.select("store_id", "store_name"), "store_id")
        .select("store_id", "store_name", "year", "quarter", "total_sales", "total_qty")
    )


def q20_view_preview(star: Star, limit: int = 20) -> DataFrame:
    return (
        q20_store_quarterly_sales(star)
        .orderBy("store_name", "year", "quarter", "store_id")
        .limit(limit)
    )
