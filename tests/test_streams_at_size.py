"""What one task of a streaming query gets must not follow the input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from starmill.operators import joins
from starmill.scratch import scratch_path
from starmill.sources import sample
from starmill.streaming import enrichment


@pytest.fixture
def given(monkeypatch):
    """The scratch paths a query has taken, by label."""
    paths = {}

    def noted(spark, label):
        return paths.setdefault(label, scratch_path(spark, label))

    monkeypatch.setattr(entry, "scratch_path", noted)
    return paths


def rows_per_file(spark, path, **read):
    rows = spark.read.load(path, **read)
    return [r["count"] for r in rows.groupBy(F.input_file_name()).count().collect()]


def test_large_files_grow_in_number(spark, tiny, given, monkeypatch):
    monkeypatch.setattr(entry, "LARGE_ROWS", 1000, raising=False)
    row = entry.stream_bounded_batches(spark, tiny).first()
    lines = sample.table(spark, tiny, "lineitem").count()
    assert (row.processed, row.within_bound, row.several_batches) == (lines, 1, 1)
    rows = rows_per_file(spark, given["uneven"], format="csv", header=True)
    assert lines > 5000 and max(rows) < 1.3 * 1000 < lines / 2


def test_files_of_lines_grow_in_number(spark, tiny, given, monkeypatch):
    monkeypatch.setattr(entry, "FILE_ROWS", 500, raising=False)
    row = entry.stream_batch_counts(spark, tiny).first()
    lines = sample.table(spark, tiny, "lineitem").count()
    assert (row.several_batches, row.processed) == (1, lines)
    rows = rows_per_file(spark, f"{given['lines']}/lineitem.parquet")
    assert lines > 5000 and max(rows) <= 1.1 * 500
    # as many micro-batches as ever
    assert spark.read.parquet(f"{given['stream-counts']}/table/counts").count() == 4


def batch_columns(monkeypatch, run):
    seen = []
    monkeypatch.setattr(enrichment, "each_batch", lambda stream, *_: seen.append(stream.columns))
    run()
    return seen[0]


def test_micro_batches_carry_facts_alone(spark, tiny, monkeypatch):
    base = scratch_path(spark, "facts-alone")
    for name in ("stream_enrich", "stream_unmatched", "stream_batch_counts"):
        lines = sample.transactions(spark, tiny, sample.line_stream(spark, tiny))
        run = lambda: getattr(enrichment, name)(lines, sample.master(spark, tiny), f"{base}/{name}", f"{base}/{name}-checkpoint")  # noqa: B023, E731
        assert "file_place" not in batch_columns(monkeypatch, run)


def test_streamed_lines_share_the_join_by_the_orders(spark, tiny, monkeypatch):
    monkeypatch.setattr(sample, "ORDERS_PER_TASK", 100, raising=False)
    streamed = sample.transactions(spark, tiny, sample.line_stream(spark, tiny))
    tasks = sample.table(spark, tiny, "orders").count() // 100
    assert tasks > 4 and f", {tasks}" in streamed._jdf.queryExecution().analyzed().toString()
    assert joins.as_lookup(sample.master(spark, tiny)).count() == sample.master(spark, tiny).count()


def test_copies_lose_their_place_before_they_are_shuffled(spark, tiny):
    raw = sample.raw_transactions(spark, tiny, sample.line_stream(spark, tiny))
    for horizon in (None, "1 day"):
        kept = enrichment.first_arrivals(raw.withColumnRenamed("orderID", "order_id"), horizon)
        assert "file_place" not in kept.columns and "Customer_ID" in kept.columns


def test_found_rows_are_told_from_copies(spark):
    kind = "order_id bigint, quantity int"
    found = spark.createDataFrame([(1, 2), (1, 2), (2, None), (3, 4), (5, None)], kind)
    copies = spark.createDataFrame([(1, 2), (1, 2), (1, 2), (2, None), (3, 5), (4, 1)], kind)
    rows = entry._found_among(found, copies).select("order_id", "is_copy").collect()
    assert sorted(tuple(r) for r in rows) == [(1, 1), (1, 1), (2, 1), (3, 0), (5, 0)]
