"""Streaming enrichment of transactions with the product master.

Streams carry ``order_id, customer_id, product_id, date_id, quantity`` and
``file_place``, which tells equal rows apart. The master is written once before a
query starts, so a micro-batch scans it instead of computing it again. Every
micro-batch is joined and written as an ordinary frame, into a folder of its own
that a repeated attempt replaces. All functions take ``time_limit`` (seconds);
without it they run until the input is used up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starmill import schemas
from starmill.operators import tables
from starmill.operators.cleaning import coerced_transactions, fill_and_require_keys, good_quantity
from starmill.operators.enrich import enrich, unmatched, with_amount
from starmill.operators.joins import as_lookup, broadcast_if_fits, row_salt
from starmill.scratch import children, exists, remove, stage
from starmill.streaming.sinks import each_batch, run_to_end

BATCH_COUNTS = "processed bigint, joined bigint, batch string"
COMPACT = 32  # micro-batches between two whole store views


def facts(stream: DataFrame) -> DataFrame:
    """What a fact is made of, without ``file_place``.

    A micro-batch is not pruned by what is done with it, so columns that it does not
    need would go through every shuffle and sort before it.
    """
    return stream.select(*schemas.FACT_SALES.names)


def product_lookup(master: DataFrame) -> DataFrame:
    """The master, written once, to be met by micro-batches whose sales need not be sorted for it."""
    return as_lookup(stage(master, "product-master"))


def stream_enrich(
    stream: DataFrame, master: DataFrame, target: str, checkpoint: str, time_limit: float | None = None
) -> DataFrame:
    """Append enriched transactions to ``target`` until the input is used up.

    ``tables.recreate_enriched`` first gives an empty target. Batch and stream
    may both append to one table: neither keeps a log of files.
    """
    spark = stream.sparkSession
    lookup = product_lookup(master)
    tables.ensure_enriched(spark, target)
    each_batch(
        facts(stream),
        lambda batch, name: tables.append_enriched(enrich(batch, lookup), target, load=name),
        checkpoint,
        time_limit,
    )
    return tables.read_enriched(spark, target).select(*schemas.FACT_ENRICHED.names)


def stream_unmatched(
    stream: DataFrame, master: DataFrame, target: str, checkpoint: str, time_limit: float | None = None
) -> DataFrame:
    """Append the transactions the master does not know to ``target``."""
    spark = stream.sparkSession
    lookup = product_lookup(master.select("product_id"))
    tables.ensure(spark, target, schemas.FACT_SALES)

    def write(batch: DataFrame, name: str) -> None:
        rows = tables.conform(unmatched(batch, lookup), schemas.FACT_SALES)
        rows.write.mode("overwrite").parquet(f"{target}/load={name}")

    each_batch(facts(stream), write, checkpoint, time_limit)
    return tables.read(spark, target, schemas.FACT_SALES).select(*schemas.FACT_SALES.names)


def stream_batch_counts(
    stream: DataFrame, master: DataFrame, target: str, checkpoint: str, time_limit: float | None = None
) -> DataFrame:
    """Enrich by micro-batch and report what each batch read and matched.

    A batch replaces its own folder, so one that is repeated after a failure
    leaves a single copy. The counts are taken while it is written.
    """
    lookup = product_lookup(
        master.select("product_id", "unit_price", "store_id", "supplier_id")
    ).withColumn("_known", F.lit(True))
    spark = stream.sparkSession
    tables.ensure(spark, f"{target}/counts", schemas.BATCH_TOTALS)

    def write(batch: DataFrame, name: str) -> None:
        counts = Observation()
        joined = batch.join(lookup, "product_id", "left").observe(
            counts,
            F.count(F.lit(1)).alias("processed"),
            F.count("_known").alias("joined"),
        )
        with_amount(joined.filter("_known")).write.mode("overwrite").parquet(
            f"{target}/facts/batch={name}"
        )
        row = [(counts.get["processed"], counts.get["joined"])]
        if row == [(0, 0)]:  # files without rows
            return
        batch.sparkSession.createDataFrame(row, schemas.BATCH_TOTALS).write.mode("overwrite").parquet(
            f"{target}/counts/batch={name}"
        )

    each_batch(facts(stream), write, checkpoint, time_limit)
    return spark.read.schema(BATCH_COUNTS).parquet(f"{target}/counts")


def first_arrivals(stream: DataFrame, horizon: str | None = None) -> DataFrame:
    """One row per order id, whenever its copies arrive.

    Every id is remembered, in the state store; on a cluster use the RocksDB
    provider (README). ``horizon`` bounds the memory: ids are then forgotten that
    long after their first arrival, and a copy that comes later is let in.

    An order id that holds a third of the rows would end up in one task; a first
    pass per salt leaves at most one row per salt for the second. ``file_place`` goes
    once the salt is drawn, before the rows are shuffled.
    """
    salted = stream.withColumn("_salt", row_salt(stream)).drop("file_place")
    if horizon is None:
        per_salt = salted.dropDuplicates(["order_id", "_salt"])
        return per_salt.dropDuplicates(["order_id"]).drop("_salt")
    arriving = salted.withColumn("_arrival", F.current_timestamp()).withWatermark("_arrival", horizon)
    per_salt = arriving.dropDuplicatesWithinWatermark(["order_id", "_salt"])
    return per_salt.dropDuplicatesWithinWatermark(["order_id"]).drop("_salt", "_arrival")


def stream_enrich_clean(
    raw_stream: DataFrame,
    master: DataFrame,
    target: str,
    checkpoint: str,
    horizon: str | None = None,
    time_limit: float | None = None,
) -> DataFrame:
    """Enrichment with the cleaning rules of the batch load applied.

    A stream has no first copy by file order, so bad rows go before
    duplicates are dropped: an order survives if any of its copies is good.
    """
    usable = fill_and_require_keys(coerced_transactions(raw_stream)).filter(good_quantity())
    return stream_enrich(first_arrivals(usable, horizon), master, target, checkpoint, time_limit)


def stream_store_quarterly(
    stream: DataFrame,
    master: DataFrame,
    dim_date: DataFrame,
    dim_store: DataFrame,
    target: str,
    checkpoint: str,
    time_limit: float | None = None,
) -> DataFrame:
    """The store view kept up to date while sales arrive.

    Every micro-batch writes the groups (store, year, quarter) it has changed, with their new
    totals, so what it writes follows the change and not the view. A group's last
    totals are the view's. Every ``COMPACT`` batches the view is written whole, and older changes go,
    but for those that readers of the previous whole one may still hold.
    """
    spark = stream.sparkSession
    lookup = stage(master, "product-master")
    calendar = broadcast_if_fits(
        stage(dim_date.select("date_id", "year", "quarter"), "calendar")
    )
    dated = stream.join(lookup.select("product_id", "unit_price", "store_id", "supplier_id"), "product_id")
    totals = (
        with_amount(dated)
        .join(calendar, "date_id")
        .groupBy("store_id", "year", "quarter")
        .agg(F.sum("total_amount").alias("total_sales"), F.sum("quantity").alias("total_qty"))
    )

    def publish(changed: DataFrame, batch_id: int) -> None:
        named = changed.join(dim_store.select("store_id", "store_name"), "store_id")
        tables.conform(named, schemas.STORE_QUARTERS).write.mode("overwrite").parquet(f"{target}/changes/batch={batch_id}")
        if batch_id % COMPACT == COMPACT - 1:
            current_store_view(spark, target).write.mode("overwrite").parquet(f"{target}/whole/batch={batch_id}")
            for old in _complete(spark, f"{target}/whole")[:-2]:
                remove(spark, f"{target}/whole/batch={old}")
            for old in [n for n in _complete(spark, f"{target}/changes") if n <= batch_id - COMPACT]:
                remove(spark, f"{target}/changes/batch={old}")

    run_to_end(totals.writeStream.outputMode("update").foreachBatch(publish), checkpoint, time_limit)
    return current_store_view(spark, target)


def _complete(spark, path: str) -> list[int]:
    """Batches written to their end, oldest first; a complete one holds the committer's mark."""
    names = (n.removeprefix("batch=") for n in children(spark, path) if n.startswith("batch="))
    return sorted(int(n) for n in names if exists(spark, f"{path}/batch={n}/_SUCCESS"))


def store_view_parts(spark, target: str) -> tuple[list[int], list[int]]:
    """What makes up the view: the last whole one, if any, and the changes since."""
    whole = _complete(spark, f"{target}/whole")[-1:]
    return whole, [n for n in _complete(spark, f"{target}/changes") if not whole or n > whole[0]]


def current_store_view(spark, target: str) -> DataFrame:
    """The view after the last complete batch; empty before the first."""
    whole, changes = store_view_parts(spark, target)
    paths = [f"{target}/whole/batch={n}" for n in whole] + [f"{target}/changes/batch={n}" for n in changes]
    if not paths:
        return spark.createDataFrame([], schemas.STORE_QUARTERS)
    names = schemas.STORE_QUARTERS.names
    batch = F.regexp_extract(F.col("_metadata.file_path"), r"/batch=(\d+)/", 1).cast("bigint")
    rows = spark.read.schema(schemas.STORE_QUARTERS).parquet(*paths).select(*names, batch.alias("_batch"))
    last = F.max_by(F.struct(*names), "_batch").alias("_row")
    return rows.groupBy("store_id", "year", "quarter").agg(last).select("_row.*")
