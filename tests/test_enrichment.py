"""Batch and streaming enrichment."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmill import schemas
from starmill.operators import enrich, joins, tables
from starmill.scratch import scratch_path
from starmill.sources import files, sample
from starmill.streaming import enrichment
from starmill.streaming.sinks import run_to_end

TX = "order_id bigint, customer_id bigint, product_id string, date_id date, quantity int"
DAY = dt.date(2017, 1, 2)


@pytest.fixture(scope="module")
def master(spark):
    rows = [("a", "toys", 2, 1, 1), ("b", "food", 3, 2, 1)]
    df = spark.createDataFrame(rows, "product_id string, product_category string, unit_price int, store_id int, supplier_id int")
    return df.withColumn("unit_price", F.col("unit_price").cast(schemas.PRICE))


@pytest.fixture(scope="module")
def lines(spark, tiny):
    """The sample's order lines as seven files."""
    path = scratch_path(spark, "lines")
    sample.table(spark, tiny, "lineitem").repartition(7).write.parquet(f"{path}/lineitem_parts")
    return path


def stream(spark, tiny, lines, files_per_batch=3):
    rows = (
        spark.readStream.schema(sample.TABLES["lineitem"])
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(f"{lines}/lineitem_parts")
        .withColumn("file_place", F.struct("_metadata.file_path", "_metadata.row_index"))
    )
    return sample.transactions(spark, tiny, rows)


def paths(spark):
    base = scratch_path(spark, "test-stream")
    return f"{base}/table", f"{base}/checkpoint"


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_raw_rows_stay_as_they_are(spark, master):
    rows = [(1, 1, "a", DAY, 5), (1, 1, "a", DAY, 5), (2, 1, "b", DAY, -1), (3, 1, "zz", DAY, 1), (4, 1, None, DAY, 1)]
    tx = spark.createDataFrame(rows, TX)
    found = enrich.enrich(tx, master)
    assert found.schema == schemas.FACT_ENRICHED
    assert sorted((r.order_id, r.total_amount) for r in found.collect()) == [(1, 10), (1, 10), (2, -3)]
    assert sorted(r.order_id for r in enrich.unmatched(tx, master).collect()) == [3, 4]


def test_a_broadcast_is_hinted_by_size_only(spark, master):
    assert not joins.fits(master, 1)
    assert joins.fits(master, 2)


def test_copies_of_a_hot_order_are_spread(spark):
    rows = spark.range(2000).select(F.lit(1).alias("order_id"), F.col("id").alias("file_place"))
    per_salt = rows.groupBy(joins.row_salt(rows).alias("s")).count()
    assert per_salt.agg(F.max("count")).first()[0] < 250


def test_stream_equals_batch_and_repeats_nothing(spark, tiny, lines):
    target, checkpoint = paths(spark)
    tables.recreate_enriched(spark, target)
    assert tables.read_enriched(spark, target).count() == 0
    master = sample.master(spark, tiny)
    streamed = enrichment.stream_enrich(stream(spark, tiny, lines), master, target, checkpoint)
    assert same_rows(streamed, sample.sales(spark, tiny))
    again = enrichment.stream_enrich(stream(spark, tiny, lines), master, target, checkpoint)
    assert again.count() == sample.sales(spark, tiny).count()


def test_stream_without_broadcast_equals_batch(spark, tiny, lines, monkeypatch):
    monkeypatch.setattr(joins, "fits", lambda *_: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        _stream_equals_batch(spark, tiny, lines)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_batch_append_after_a_stream_is_seen(spark, tiny, lines):
    target, checkpoint = paths(spark)
    sales = sample.sales(spark, tiny)
    enrichment.stream_enrich(stream(spark, tiny, lines), sample.master(spark, tiny), target, checkpoint)
    tables.append_enriched(sales, target)
    assert tables.read_enriched(spark, target).count() == 2 * sales.count()
    # a named load replaces its earlier attempt
    for _ in range(2):
        tables.append_enriched(sales, target, load="again")
    assert tables.read_enriched(spark, target).count() == 3 * sales.count()


def test_recreating_forgets_how_far_the_stream_had_come(spark, tiny, lines):
    target, checkpoint = paths(spark)
    master = sample.master(spark, tiny)
    for _ in range(2):
        tables.recreate_enriched(spark, target, checkpoint)
        found = enrichment.stream_enrich(stream(spark, tiny, lines), master, target, checkpoint)
        assert found.count() == sample.sales(spark, tiny).count()


def test_empty_streams_give_empty_tables(spark, tiny):
    empty = scratch_path(spark, "nothing")
    sample.table(spark, tiny, "lineitem").limit(0).write.parquet(f"{empty}/lineitem_parts")
    master, nothing = sample.master(spark, tiny), lambda: stream(spark, tiny, empty)
    assert enrichment.stream_batch_counts(nothing(), master, *paths(spark)).count() == 0
    assert enrichment.stream_enrich(nothing(), master, *paths(spark)).count() == 0
    assert enrichment.stream_unmatched(nothing(), master, *paths(spark)).count() == 0
    view = enrichment.stream_store_quarterly(
        nothing(), master, sample.dates(spark, tiny), sample.stores(spark, tiny), *paths(spark)
    )
    assert view.count() == 0


def _stream_equals_batch(spark, tiny, lines):
    streamed = enrichment.stream_enrich(
        stream(spark, tiny, lines), sample.master(spark, tiny), *paths(spark)
    )
    assert same_rows(streamed, sample.sales(spark, tiny))
    rest = enrichment.stream_unmatched(
        stream(spark, tiny, lines), sample.master_partial(spark, tiny), *paths(spark)
    )
    assert same_rows(rest, enrich.unmatched(sample.transactions(spark, tiny), sample.master_partial(spark, tiny)))


def test_matched_and_unmatched_make_the_input(spark, tiny, lines):
    partial = sample.master_partial(spark, tiny)
    target, checkpoint = paths(spark)
    counts = enrichment.stream_batch_counts(stream(spark, tiny, lines), partial, target, checkpoint)
    rows = counts.collect()
    assert len(rows) == 3
    total = sample.transactions(spark, tiny).count()
    rest = enrichment.stream_unmatched(stream(spark, tiny, lines), partial, *paths(spark)).count()
    assert rest > 0
    assert sum(r.processed for r in rows) == total
    assert sum(r.joined for r in rows) == total - rest
    assert spark.read.parquet(f"{target}/facts").count() == total - rest


def test_clean_stream_keeps_each_order_once(spark, tiny, lines):
    rows = (
        spark.readStream.schema(sample.TABLES["lineitem"])
        .option("maxFilesPerTrigger", 3)
        .parquet(f"{lines}/lineitem_parts")
        .withColumn("file_place", F.struct("_metadata.file_path", "_metadata.row_index"))
    )
    raw = sample.raw_transactions(spark, tiny, rows)
    cleaned = enrichment.stream_enrich_clean(raw, sample.master(spark, tiny), *paths(spark))
    orders = cleaned.select("order_id")
    usable = sample.raw_transactions(spark, tiny).filter(
        "Customer_ID is not null and Product_ID is not null "
        "and coalesce(try_cast(quantity as decimal(20,6)), 1) between 1 and 2147483647"
    )
    expected = usable.select(F.col("orderID").cast("bigint").alias("order_id")).distinct()
    assert same_rows(orders, expected)


def test_clean_stream_drops_copies_in_later_batches(spark, master):
    base = scratch_path(spark, "csv")
    row = "1,7,a,2,2017-01-02\n"
    for name in ("first", "second"):
        text = "orderID,Customer_ID,Product_ID,quantity,date\n" + row * 40 + ("2,7,b,0,2017-01-02\n" if name == "first" else "2,7,b,,2017-01-02\n")
        spark.createDataFrame([(text.rstrip("\n"),)], "value string").coalesce(1).write.mode("append").option("lineSep", "\n").text(base)
    source = files.stream_transactions(spark, base, files_per_batch=1)
    rows = enrichment.stream_enrich_clean(source, master, *paths(spark)).orderBy("order_id").collect()
    assert [(r.order_id, r.quantity, r.total_amount) for r in rows] == [(1, 2, 4), (2, 1, 3)]


def test_horizon_is_a_choice_of_the_caller(spark, master):
    rows = spark.readStream.format("rate").load().select(F.col("value").alias("order_id"), F.col("timestamp").alias("t"))
    exact = enrichment.first_arrivals(rows)._jdf.queryExecution().analyzed().toString()
    bounded = enrichment.first_arrivals(rows, "1 day")._jdf.queryExecution().analyzed().toString()
    assert "EventTimeWatermark" not in exact and "EventTimeWatermark" in bounded


@pytest.mark.parametrize("compact", [2, 32])
def test_store_view_follows_the_stream(spark, tiny, lines, monkeypatch, compact):
    monkeypatch.setattr(enrichment, "COMPACT", compact)
    target, checkpoint = paths(spark)
    view = enrichment.stream_store_quarterly(
        stream(spark, tiny, lines, files_per_batch=1),
        sample.master(spark, tiny),
        sample.dates(spark, tiny),
        sample.stores(spark, tiny),
        target,
        checkpoint,
    )
    # seven micro-batches
    assert enrichment.store_view_parts(spark, target) == (([5], [6]) if compact == 2 else ([], [*range(7)]))
    from starmill.plans.olap import q20_store_quarterly_sales

    batch = q20_store_quarterly_sales(sample.SampleStar(spark, tiny))
    text = lambda df: df.select(*[F.col(c).cast("string") for c in batch.columns])
    assert same_rows(text(view), text(batch))
    # the same view again, whole and from its changes
    assert same_rows(text(enrichment.current_store_view(spark, target)), text(batch))


def test_a_batch_writes_the_groups_it_changes(spark, tiny):
    """Sales of one store and quarter add one row to the view's changes."""
    path = scratch_path(spark, "lines")
    target, checkpoint = paths(spark)
    every = sample.table(spark, tiny, "lineitem")
    orders = sample.table(spark, tiny, "orders")
    few = every.join(orders, every.l_orderkey == orders.o_orderkey).filter("l_partkey % 25 = 3 and year(o_orderdate) = 1997 and quarter(o_orderdate) = 2")

    def run():
        rows = spark.readStream.schema(sample.TABLES["lineitem"]).parquet(f"{path}/*").withColumn("file_place", F.lit(0))
        return enrichment.stream_store_quarterly(
            sample.transactions(spark, tiny, rows), sample.master(spark, tiny), sample.dates(spark, tiny), sample.stores(spark, tiny), target, checkpoint
        )

    every.coalesce(1).write.parquet(f"{path}/first")
    whole = run().count()
    few.select(every.columns).coalesce(1).write.parquet(f"{path}/second")
    view = run()
    changed = spark.read.parquet(f"{target}/changes/batch=1")
    assert whole > 100 and (changed.count(), changed.first().store_id, changed.first().quarter) == (1, 3, 2)
    now = view.filter("store_id = 3 and year = 1997 and quarter = 2").first()
    assert view.count() == whole and now.total_sales == changed.first().total_sales


def test_overlong_stream_is_stopped(spark, tiny, lines):
    def slow(batch, _):
        import time

        time.sleep(5)

    writer = stream(spark, tiny, lines).writeStream.foreachBatch(slow)
    with pytest.raises(TimeoutError):
        run_to_end(writer, paths(spark)[1], time_limit=1)
