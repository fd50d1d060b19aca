"""Keyed loads, published versions and parked rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from starmill import schemas
from starmill.functions import membership
from starmill.operators import loads, tables, versions
from starmill.plans import warehouse
from starmill.scratch import children, exists, read_text, scratch_path, stage, write_text
from starmill.sources import sample
from starmill.streaming import parking
from test_enrichment import DAY, TX, lines, master, same_rows, stream  # noqa: F401  (fixtures)

SCHEMA = schemas.DIM_SUPPLIER


def load(spark, base, rows):
    df = spark.createDataFrame(rows, "supplier_id int, supplier_name string").repartition(3)
    loads.load_keyed(df, f"{base}/table", SCHEMA, "supplier_id", f"{base}/rejects")
    stored = sorted(map(tuple, tables.read(spark, f"{base}/table", SCHEMA).collect()))
    rejects = loads.read_rejects(spark, f"{base}/rejects", SCHEMA).collect()
    return stored, sorted(map(tuple, rejects), key=str)


def test_a_key_is_stored_once(spark):
    base = scratch_path(spark, "keyed")
    first = [(1, "a"), (1, "a"), (1, "b"), (2, "x"), (None, "n"), (None, "n"), (3, None), (3, "z")]
    stored, rejects = load(spark, base, first)
    assert stored == [(1, "a"), (2, "x"), (3, None)]
    assert rejects == sorted([(1, "a", 1, "repeated"), (1, "b", 1, "repeated"), (3, "z", 1, "repeated"), (None, "n", 2, "no key")], key=str)
    again, more = load(spark, base, first)
    assert again == stored and len(more) == len(rejects) + 6
    changed, more = load(spark, base, [(2, "y"), (4, "new"), (4, "new")])
    assert changed == [*stored, (4, "new")]
    assert (2, "y", 1, "stored") in more and (4, "new", 1, "repeated") in more
    assert load(spark, base, []) == (changed, more)


def test_an_empty_first_load_leaves_an_empty_table(spark):
    assert load(spark, scratch_path(spark, "keyed"), []) == ([], [])


def test_a_bitmap_misses_no_member(spark):
    keys = spark.range(0, 5000, 7).select(F.concat(F.lit("k"), "id").alias("k"))
    bitmap = membership.members(keys.union(spark.createDataFrame([(None,)], "k string")), "k")
    assert bitmap.count() <= 1 << (membership.PLACES - 6)
    every = spark.range(5000).select("id", F.concat(F.lit("k"), "id").alias("k")).union(spark.createDataFrame([(-1, None)], "id long, k string"))
    marked = membership.marked(every, "k", bitmap, "maybe")
    assert marked.filter("id % 7 = 0 and not maybe").isEmpty()
    assert marked.filter("id % 7 <> 0 and maybe").count() < 10
    assert not marked.filter("id = -1").first().maybe


def test_stored_keys_do_not_meet_the_load_in_a_shuffle_of_their_own_size(spark):
    """Only stored keys that the load may hold are shuffled."""
    stored = spark.range(1_000_000).withColumnRenamed("id", "k")
    keys = spark.createDataFrame([(5,), (2_000_000,)], "k long")
    known = loads.known_keys(keys, "k", stored)
    assert [r.k for r in known.collect()] == [5]
    text = known._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") >= 2


def _inputs(spark, tiny):
    base = scratch_path(spark, "inputs")
    raw = {
        "customers": (sample.raw_customers(spark, tiny), schemas.CUSTOMER_FILE),
        "products": (sample.raw_products(spark, tiny), schemas.PRODUCT_FILE),
        "transactions": (sample.raw_transactions(spark, tiny), schemas.TRANSACTION_FILE),
    }
    for name, (df, schema) in raw.items():
        df.coalesce(1).sortWithinPartitions("file_order").select(*schema.names).write.option("header", True).csv(f"{base}/{name}")
    return base


def test_a_build_that_fails_leaves_the_old_star(spark, tiny, monkeypatch):
    base, inputs = scratch_path(spark, "warehouse"), _inputs(spark, tiny)
    paths = [f"{inputs}/{name}" for name in ("customers", "products", "transactions")]
    old = warehouse.build_warehouse(spark, *paths, base)
    counts = {name: df.count() for name, df in warehouse.stored_tables(spark, base).items()}
    assert counts["fact_sales_enriched"] > counts["fact_sales"] > 0

    def unlucky(*args, **more):
        raise RuntimeError("lost")

    # while the stream runs, when nearly all is written; and before the first input is read
    with monkeypatch.context() as m:
        m.setattr(warehouse, "stream_enrich", unlucky)
        with pytest.raises(RuntimeError, match="lost"):
            warehouse.build_warehouse(spark, *paths, base, replace=True)
    with pytest.raises(Exception):
        warehouse.build_warehouse(spark, *paths[:2], f"{inputs}/nowhere", base, replace=True)
    assert {name: df.count() for name, df in warehouse.stored_tables(spark, base).items()} == counts
    assert len(children(spark, f"{base}/versions")) == 1

    # a reader of the old version is not disturbed by the next one, and may be by the one after it
    warehouse.build_warehouse(spark, *paths, base, replace=True)
    assert old.sales.count() == counts["fact_sales_enriched"]
    assert {name: df.count() for name, df in warehouse.stored_tables(spark, base).items()} == counts
    assert len(children(spark, f"{base}/versions")) == 2


def test_versions_are_named_by_the_last_manifest(spark):
    base = scratch_path(spark, "versions")
    assert versions.current(spark, base) == base and not versions.is_published(spark, base)
    made = [versions.new_version(base) for _ in range(4)]
    for version in made:
        spark.range(1).write.parquet(version)
        versions.publish(spark, base, version)
        assert versions.current(spark, base) == version
    assert [exists(spark, v) for v in made] == [False, False, True, True]
    write_text(spark, f"{base}/note", "é")
    assert read_text(spark, f"{base}/note") == "é"
    with pytest.raises(FileExistsError):
        write_text(spark, f"{base}/note", "other")


def test_parked_rows_come_once_their_product_is_known(spark, tiny, lines):  # noqa: F811
    base = scratch_path(spark, "parked")
    target, parked = f"{base}/table", f"{base}/parked"
    full, partial = sample.master(spark, tiny), sample.master_partial(spark, tiny)
    sales = sample.SampleStar(spark, tiny).sales
    known = parking.stream_enrich_parked(stream(spark, tiny, lines), partial, target, parked, f"{base}/checkpoint")
    waiting = parking.parked_rows(spark, parked).count()
    assert waiting > 0 and known.count() + waiting == sales.count()
    # a master that has not grown moves nothing
    assert parking.release(spark, partial, target, parked) == 1
    assert parking.parked_rows(spark, parked).count() == waiting
    assert parking.release(spark, full, target, parked) == 2
    assert parking.parked_rows(spark, parked).isEmpty()
    stored = tables.read_enriched(spark, target).select(*schemas.FACT_ENRICHED.names)
    assert same_rows(stored, sales)
    assert parking.release(spark, full, target, parked) == 3
    assert same_rows(tables.read_enriched(spark, target).select(*schemas.FACT_ENRICHED.names), sales)


@pytest.mark.parametrize("step", ["append_enriched", "done"])
def test_a_release_that_fails_is_taken_up_again(spark, master, monkeypatch, step):  # noqa: F811
    base = scratch_path(spark, "parked")
    target, parked = f"{base}/table", f"{base}/parked"
    tables.ensure_enriched(spark, target)

    def park(name, rows):
        spark.createDataFrame(rows, TX).write.parquet(f"{parked}/load={name}")

    park("x", [(1, 1, "a", DAY, 5), (1, 1, "a", DAY, 5), (2, 1, "zz", DAY, 1), (3, 1, None, DAY, 1)])
    with monkeypatch.context() as m:
        if step == "done":  # both loads are written, the mark is not
            m.setattr(parking, "write_text", lambda s, path, text: write_text(s, path, text) if path.endswith("intent") else 1 / 0)
        else:
            m.setattr(tables, "append_enriched", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            parking.release(spark, master, target, parked)
    assert parking.parked_rows(spark, parked).count() == 4
    park("y", [(4, 1, "b", DAY, 2)])  # comes meanwhile
    assert parking.release(spark, master, target, parked) == 1
    assert sorted(r.order_id for r in tables.read_enriched(spark, target).collect()) == [1, 1]
    assert sorted(r.order_id for r in parking.parked_rows(spark, parked).collect()) == [2, 3, 4]
    assert parking.release(spark, master, target, parked) == 2
    assert sorted(r.order_id for r in tables.read_enriched(spark, target).collect()) == [1, 1, 4]
    assert sorted(r.order_id for r in parking.parked_rows(spark, parked).collect()) == [2, 3]


def test_a_first_load_is_written_once(spark, monkeypatch):
    """Into no table yet, the rows go to the table without a stop in the scratch folder; rejects are the same."""
    staged = []
    monkeypatch.setattr(loads, "stage", lambda df, label: staged.append(label) or stage(df, label))
    base = scratch_path(spark, "first-load")
    schema = "order_id bigint, customer_id bigint, product_id string, date_id date, quantity int"
    rows = [(1, 1, "a", None, 1), (2, 1, "a", None, 1), (2, 1, "a", None, 1), (2, 0, "a", None, 1), (None, 1, "a", None, 1)]
    args = (f"{base}/table", schemas.FACT_SALES, "order_id", f"{base}/rejects")
    loads.load_keyed(spark.createDataFrame(rows, schema), *args)
    assert staged == []
    stored = tables.read(spark, f"{base}/table", schemas.FACT_SALES).collect()
    assert sorted((r.order_id, r.customer_id) for r in stored) == [(1, 1), (2, 0)]
    rejects = loads.read_rejects(spark, f"{base}/rejects", schemas.FACT_SALES).collect()
    assert sorted((r.order_id or 0, r.customer_id, r.copies, r.reason) for r in rejects) == [(0, 1, 1, "no key"), (2, 1, 2, "repeated")]
    # none of the keys is new: as any later load
    loads.load_keyed(spark.createDataFrame(rows[:2], schema), *args)
    assert tables.read(spark, f"{base}/table", schemas.FACT_SALES).count() == 2 and staged == ["firsts"]


def test_copies_of_an_order_are_delivered_in_one_file(spark, tiny):
    path = entry._delivered_transactions(spark, tiny)
    rows = spark.read.option("header", True).csv(path).withColumn("file", F.input_file_name())
    assert rows.count() == sample.table(spark, tiny, "lineitem").count()
    assert rows.groupBy("orderID").agg(F.countDistinct("file").alias("n")).filter("n > 1").isEmpty()
    # the lines are shuffled once, for the join with the orders and for the files
    lines = sample.table(spark, tiny, "lineitem").repartition("l_orderkey")
    rows = sample.raw_transactions(spark, tiny, lines).sortWithinPartitions("file_order")
    assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2


def test_delivered_transactions_take_more_tasks_as_the_lines_grow(spark, tiny, monkeypatch):
    monkeypatch.setattr(entry, "LINES_PER_TASK", 500, raising=False)
    path = entry._delivered_transactions(spark, tiny)
    rows = spark.read.option("header", True).csv(path).groupBy(F.input_file_name()).count().collect()
    assert len(rows) > 8 and max(r["count"] for r in rows) < 2 * 500
