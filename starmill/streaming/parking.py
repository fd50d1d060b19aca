"""Enrichment in which a transaction waits for its product.

A micro-batch sends the rows whose product the master knows to the target, and parks
the others. When the master has grown, ``release`` joins what is parked with it: rows
that now match go to the target, the rest stays parked.

Parked rows lie in loads. A release first writes down which loads it takes up (its intent),
then writes the matched rows as one load of the target and the rest as one new parked
load, and at last marks itself done; from then on its loads count as taken, and
its rest as parked. If it fails before, the next release finds the intent and does the
same again: its two loads carry the release's number and are replaced, so no row
is lost and none comes twice. Releases run one at a time.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from starmill import schemas
from starmill.operators import tables
from starmill.operators.enrich import enrich, unmatched
from starmill.scratch import children, read_text, write_text
from starmill.streaming.enrichment import facts, product_lookup
from starmill.streaming.sinks import each_batch


def stream_enrich_parked(
    stream: DataFrame, master: DataFrame, target: str, parked: str, checkpoint: str, time_limit: float | None = None
) -> DataFrame:
    """Append enriched transactions to ``target`` and park the others, until the input is used up."""
    spark = stream.sparkSession
    lookup = product_lookup(master)
    tables.ensure_enriched(spark, target)

    def write(batch: DataFrame, name: str) -> None:
        # parked first: a batch that fails between the two is repeated, and both loads are replaced
        rows = tables.conform(unmatched(batch, lookup), schemas.FACT_SALES)
        rows.write.mode("overwrite").parquet(f"{parked}/load={name}")
        tables.append_enriched(enrich(batch, lookup), target, load=name)

    each_batch(facts(stream), write, checkpoint, time_limit)
    return tables.read_enriched(spark, target).select(*schemas.FACT_ENRICHED.names)


def _loads(spark: SparkSession, parked: str) -> list[str]:
    """Loads whose rows still wait: written whole, and not taken up by a release that is done."""
    releases = children(spark, f"{parked}/releases")
    done = {n.removesuffix(".done") for n in releases if n.endswith(".done")}
    taken = {load for n in done for load in json.loads(read_text(spark, f"{parked}/releases/{n}.intent"))}
    loads = [n.removeprefix("load=") for n in children(spark, parked) if n.startswith("load=")]
    whole = [n for n in loads if "_SUCCESS" in children(spark, f"{parked}/load={n}")]
    return sorted(n for n in whole if n not in taken and (not n.startswith("rest-") or n.removeprefix("rest-") in done))


def _rows(spark: SparkSession, parked: str, loads: list[str]) -> DataFrame:
    if not loads:
        return spark.createDataFrame([], schemas.FACT_SALES)
    return spark.read.schema(schemas.FACT_SALES).parquet(*[f"{parked}/load={n}" for n in loads])


def parked_rows(spark: SparkSession, parked: str) -> DataFrame:
    """The transactions that wait for their product."""
    return _rows(spark, parked, _loads(spark, parked))


def release(spark: SparkSession, master: DataFrame, target: str, parked: str) -> int:
    """Send parked rows that the master knows by now to ``target``; returns the release's number."""
    releases = children(spark, f"{parked}/releases")
    intents = sorted(n.removesuffix(".intent") for n in releases if n.endswith(".intent"))
    if intents and f"{intents[-1]}.done" not in releases:
        number = intents[-1]  # it did not come to its end
    else:
        number = f"{int(intents[-1]) + 1 if intents else 1:08d}"
        write_text(spark, f"{parked}/releases/{number}.intent", json.dumps(_loads(spark, parked)))
    rows = _rows(spark, parked, json.loads(read_text(spark, f"{parked}/releases/{number}.intent")))
    lookup = product_lookup(master)
    tables.append_enriched(enrich(rows, lookup), target, load=f"release-{number}")
    tables.conform(unmatched(rows, lookup), schemas.FACT_SALES).write.mode("overwrite").parquet(f"{parked}/load=rest-{number}")
    write_text(spark, f"{parked}/releases/{number}.done", "")
    return int(number)
