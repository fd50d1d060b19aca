from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from starmill import schemas
from starmill.operators import cleaning, dimensions
from starmill.operators.dedupe import keep_first
from starmill.sources import sample


def customers(spark, *rows):
    names = ", ".join(f"`{n}` string" for n in schemas.CUSTOMER_FILE.names)
    return spark.createDataFrame(rows, names + ", file_order int")


def products(spark, *rows):
    names = ", ".join(f"`{n}` string" for n in schemas.PRODUCT_FILE.names)
    return spark.createDataFrame(rows, names + ", file_order int")


def transactions(spark, *rows):
    names = ", ".join(f"`{n}` string" for n in schemas.TRANSACTION_FILE.names)
    return spark.createDataFrame(rows, names + ", file_order int")


def test_customer_codes_and_fills(spark):
    raw = customers(
        spark,
        ("1", "M", None, "10", " a ", "2", "0", 1),
        ("2", None, "26-35", "4", None, "4+", None, 2),
        ("3", "X", "55+", "7", "b", "1", "1", 3),
        ("3", "F", "0-17", "7", "c", "1", "0", 4),
    )
    one, two, three = cleaning.clean_customers(raw).orderBy("customer_id").collect()
    assert (one.gender, one.age, one.age_group) == ("Male", "Unknown", None)
    assert (one.city_category, one.marital_status) == ("A", "Single")
    assert (two.gender, two.city_category, two.marital_status) == ("Unknown", "Unknown", None)
    # unknown codes stay, and the first copy wins
    assert (three.gender, three.age, three.marital_status) == ("X", "55+", "Married")


def test_price_is_filled_after_duplicates_are_gone(spark):
    raw = products(
        spark,
        ("p1", "toys", "10.00", "1", "1", "a", "x", 1),
        ("p2", "toys", "20.00", "1", "1", "a", "x", 2),
        ("p3", "toys", "n/a", "2", "2", "b", "y", 3),
        ("p1", "toys", "9000", "1", "1", "a", "x", 4),
    )
    prices = {r.product_id: r.unit_price for r in cleaning.clean_products(raw).collect()}
    assert prices == {"p1": Decimal(10), "p2": Decimal(20), "p3": Decimal(15)}


def test_bad_first_copy_loses_the_order(spark):
    raw = transactions(
        spark,
        ("1", "7", "p", "-1", "2017-01-01", 1),
        ("1", "7", "p", "5", "2017-01-01", 2),
        ("2", "7", "p", None, "2017-01-01", 3),
        ("3", None, "p", "1", "2017-01-01", 4),
        ("4", "7", None, "1", "2017-01-01", 5),
        ("5", "7", "p", "0.3", "bad", 6),
        ("6", "7", "p", "0", "2017-01-02", 7),
    )
    result = cleaning.clean_transactions(raw)
    kept = {r.order_id: (r.quantity, r.date_id) for r in result.kept.collect()}
    assert set(kept) == {2, 5}
    assert kept[2][0] == 1
    # tested before it is rounded, and kept without a date
    assert kept[5] == (0, None)
    assert {r.order_id for r in result.rejected.collect()} == {1, 6}
    # a fact without a date makes no calendar row
    assert dimensions.dim_date(result.kept).count() == 1


def test_missing_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (5, 3)], "k int, o int")
    rows = keep_first(df, "k", "o").orderBy("o").collect()
    assert [(r.k, r.o) for r in rows] == [(None, 1), (5, 3)]


def test_keep_first_twice_changes_nothing(spark, tiny):
    raw = cleaning.coerced_transactions(sample.raw_transactions(spark, tiny))
    once = keep_first(raw, "order_id", "file_order")
    twice = keep_first(once, "order_id", "file_order")
    assert once.exceptAll(twice).isEmpty()
    assert once.count() == twice.count() == raw.select("order_id").distinct().count()


def test_sample_counts(spark, small):
    """The counts stated in FIXTURES.md."""
    raw_customers = sample.raw_customers(spark, small)
    first = keep_first(raw_customers, "Customer_ID", "file_order")
    nulls = first.agg(
        *[
            F.count_if(F.col(c).isNull())
            for c in ("Gender", "Age", "City_Category", "Marital_Status")
        ]
    ).first()
    assert (first.count(), *nulls) == (1500, 37, 29, 41, 35)

    known = cleaning.coerced_products(sample.raw_products(spark, small))
    assert (known.count(), known.filter("unit_price is null").count()) == (2000, 69)
    filled = cleaning.impute_price(known.filter("unit_price is null").unionAll(known.filter("unit_price is not null")))
    assert filled.filter("product_id = 'P00000029'").first().unit_price == Decimal("950.00")

    raw = sample.raw_transactions(spark, small)
    deduplicated = keep_first(cleaning.coerced_transactions(raw), "order_id", "file_order")
    result = cleaning.clean_transactions(raw)
    kept, rejected = result.kept.count(), result.rejected.count()
    assert (raw.count(), deduplicated.count(), kept, rejected) == (60000, 45832, 42865, 1621)
    # cleaned and dropped rows add up to the input
    assert deduplicated.count() - kept - rejected == 1346
    assert result.kept.filter("date_id is null").count() == 718
    assert result.kept.agg(F.sum("quantity")).first()[0] == 1064915
    assert dimensions.dim_date(result.kept).count() == 2397
