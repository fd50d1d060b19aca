"""Tables and views of the catalog, buckets, collations, bounded intake."""

from __future__ import annotations

import re
import uuid

import pytest
from pyspark.sql import functions as F
from test_olap import make_star
from test_plans import plan
from test_tables import write_lines

from starmill import schemas
from starmill.operators import catalog, enrich
from starmill.plans import olap
from starmill.plans.star import Star
from starmill.scratch import scratch_path
from starmill.sources import files, sample
from starmill.streaming.sinks import each_batch


@pytest.fixture
def database(spark):
    name = f"test_{uuid.uuid4().hex}"
    catalog.create_database(spark, name, scratch_path(spark, "catalog"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


SALES = [(1, 1, "a", "2016-06-01", 1, 5), (2, 2, "b", "2017-01-02", 1, 10, 2, 1), (3, 1, "a", "2017-02-02", 1, 15)]


def test_a_view_shows_what_its_tables_hold(spark, database):
    star = make_star(spark, SALES)
    catalog.publish_star(star, database)
    view = catalog.create_store_view(spark, database)
    other = spark.newSession()
    assert sorted((r.store_name, r.year, r.quarter, r.total_sales) for r in other.table(view).collect()) == [("one", 2016, 2, 5), ("one", 2017, 1, 15), ("two", 2017, 1, 10)]
    more = star.sales.filter("order_id = 2").withColumn("quantity", F.lit(7))
    catalog.insert(more, f"{database}.{catalog.ENRICHED}")
    assert catalog.read(other, view).filter("store_name = 'two'").first().total_qty == 8
    assert catalog.create_store_view(other, database) == view
    text = lambda df: sorted(map(str, df.collect()))
    assert text(other.table(view)) == text(olap.q20_store_quarterly_sales(catalog.published_star(spark, database)))


def test_columns_left_out_get_their_default(spark, database):
    table = f"{database}.dim_date"
    catalog.create_table(spark, table, schemas.DIM_DATE, load_time=True)
    calendar = make_star(spark, SALES).dim_date
    catalog.insert(calendar.drop("is_holiday", "season"), table)
    catalog.insert(calendar.limit(1).withColumn("is_holiday", F.lit(1)), table)
    rows = spark.table(table).collect()
    assert sorted(r.is_holiday for r in rows) == [0, 0, 0, 1]
    assert all(r.load_time is not None for r in rows) and sum(r.season is None for r in rows) == 3


def test_buckets_save_the_shuffle_of_the_fact(spark, database, tiny):
    star = sample.SampleStar(spark, tiny)
    stored = catalog.bucketed_star(star, database, 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for query in (olap.q02_demographics_city, olap.q07_stay_gender_avg, lambda s: olap.q04_gender_age_quarterly(s, 1998)):
            lines = plan(query(stored)).splitlines()
            join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
            below = lines[join + 1 :]
            assert not any(re.search(r"\bExchange hashpartitioning\(customer_id", line) for line in below)
            assert any("Bucketed: true" in line for line in below)
            assert sorted(map(str, query(stored).collect())) == sorted(map(str, query(star).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_hot_customer_is_left_out_of_buckets(spark, database):
    sales = [(k, 1 if k % 3 else k % 4 + 2, "a", "2017-01-05", 1, 1) for k in range(300)]
    star = make_star(spark, sales)
    assert catalog.largest_share(star.sales, 64) > 20
    with pytest.raises(ValueError, match="times the mean"):
        catalog.bucketed_star(star, database, 64)
    empty = Star(**{**star.__dict__, "sales": star.sales.limit(0)})
    assert catalog.largest_share(empty.sales, 8) == 0.0


def test_ids_in_other_cases_match_under_a_collation(spark):
    tx = spark.createDataFrame([(1, 1, "P1", None, 2), (2, 1, "p1", None, 1), (3, 1, "É1", None, 1), (4, 1, "zz", None, 1), (5, 1, None, None, 1)], "order_id long, customer_id long, product_id string, date_id date, quantity int")
    rows = [("p1", "x", 2, 1, 1), ("P1", "x", 3, 1, 1), ("é1", "x", 5, 1, 1)]
    master = spark.createDataFrame(rows, "product_id string, product_category string, unit_price int, store_id int, supplier_id int").withColumn("unit_price", F.col("unit_price").cast(schemas.PRICE))
    assert sorted(r.order_id for r in enrich.enrich(tx, master).collect()) == [1, 2]
    one = enrich.one_per_key(master, "UNICODE_CI")
    found = sorted((r.order_id, r.product_id, r.unit_price) for r in enrich.enrich(tx, one, "UNICODE_CI").collect())
    assert found == [(1, "P1", 3), (2, "p1", 3), (3, "É1", 5)]
    assert enrich.enrich(tx, one, "UNICODE_CI").schema == schemas.FACT_ENRICHED


def test_batches_are_bounded_by_bytes(spark):
    base = scratch_path(spark, "uneven")
    head = ",".join(schemas.TRANSACTION_FILE.names)
    for size in [4000] + [40] * 20:
        write_lines(spark, base, [head, *(f"{k},7,p1,1,2017-01-02" for k in range(size))])
    batches = []

    def note(batch, name):
        batches.append([r["count"] for r in batch.groupBy("file_place.file_path").count().collect()])

    source = files.stream_transactions(spark, base, bytes_per_batch=5000)
    each_batch(source, note, scratch_path(spark, "checkpoint"))
    assert sum(map(sum, batches)) == 4000 + 20 * 40
    assert all(len(b) == 1 or sum(b) <= 250 for b in batches) and len(batches) >= 5
