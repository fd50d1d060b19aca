"""Loads into tables with a primary key: a key is stored once, however often it is delivered.

A load takes the rows whose key the table does not hold yet. Everything else goes to a
table of rejects with the reason and the number of equal copies, so nothing
vanishes silently:

* ``stored``: the key was there before; the stored row stays as it is;
* ``repeated``: the key stands several times in the load; the least row (by all
  columns) is taken, the others are rejected;
* ``no key``: the key is NULL.

A load that is repeated, after a failure or by mistake, therefore adds only what is
missing. Copies are counted within tasks before they are shuffled, so a key with
a third of all rows is no burden. The stored keys are not shuffled against the load:
a bitmap of fixed size (functions.membership) tells which keys of the load may
be stored, another which stored keys may be among those, and only these meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from starmill.functions import membership
from starmill.operators import tables
from starmill.schemas import PRIMARY_KEYS
from starmill.scratch import exists, stage


def rejects_schema(schema: StructType) -> StructType:
    return StructType([*schema, StructField("copies", LongType()), StructField("reason", StringType())])


def read_rejects(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What loads into a table have turned away; empty before the first reject."""
    full = rejects_schema(schema)
    return tables.read(spark, path, full) if exists(spark, path) else spark.createDataFrame([], full)


def known_keys(keys: DataFrame, key: str, stored: DataFrame) -> DataFrame:
    """Those of ``keys`` that stand in ``stored``, once each."""
    maybe = membership.marked(keys, key, membership.members(stored, key), "_maybe").filter("_maybe").select(key)
    meeting = membership.marked(stored.select(key), key, membership.members(maybe, key), "_maybe").filter("_maybe").select(key)
    return maybe.join(meeting, key, "left_semi")


def load_keyed(df: DataFrame, path: str, schema: StructType, key: str, rejects: str) -> None:
    """Append the rows whose ``key`` is new to the table at ``path``, and the others to ``rejects``."""
    spark = df.sparkSession
    names = schema.names
    rows = tables.conform(df, schema)
    firsts = rows.groupBy(key).agg(F.min(F.struct(*names)).alias("_first"), F.count(F.lit(1)).alias("_total"))
    if not exists(spark, path):
        _load_first(rows, firsts, path, schema, key, rejects)
        return
    _load_more(rows, firsts, path, schema, key, rejects)


def _load_first(rows: DataFrame, firsts: DataFrame, path: str, schema: StructType, key: str, rejects: str) -> None:
    """A load into no table yet: no key is stored, so the rows are written as they come, once.

    What is refused, if anything, is counted on the way and then read again.
    """
    counts = Observation()
    fresh, refused = F.col(key).isNotNull(), F.col(key).isNull() | (F.col("_total") > 1)
    seen = firsts.observe(counts, F.count_if(refused).alias("refused"))
    tables.append(seen.filter(fresh).select("_first.*"), path, schema)
    if counts.get["refused"]:
        _reject(rows, firsts.filter(refused).withColumn("_stored", F.lit(False)), schema, key, rejects)


def _load_more(rows: DataFrame, firsts: DataFrame, path: str, schema: StructType, key: str, rejects: str) -> None:
    spark = rows.sparkSession
    known = known_keys(firsts.select(key), key, tables.read(spark, path, schema)).withColumn("_stored", F.lit(True))
    firsts = stage(firsts.join(known, key, "left").withColumn("_stored", F.coalesce("_stored", F.lit(False))), "firsts")
    fresh = F.col(key).isNotNull() & ~F.col("_stored")
    refused = ~fresh | (F.col("_total") > 1)
    counts = firsts.agg(F.count_if(fresh).alias("fresh"), F.count_if(refused).alias("refused")).first()
    if counts.fresh:
        tables.append(firsts.filter(fresh).select("_first.*"), path, schema)
    if counts.refused:
        _reject(rows, firsts.filter(refused), schema, key, rejects)


def _reject(rows: DataFrame, refused: DataFrame, schema: StructType, key: str, rejects: str) -> None:
    """Store the copies of refused keys that were not taken, with the reason."""
    names = schema.names
    taken = F.col(key).isNotNull() & ~F.col("_stored") & (F.struct(*names) == F.col("_first"))
    reason = F.when(F.col(key).isNull(), "no key").when(F.col("_stored"), "stored").otherwise("repeated")
    turned_away = (
        rows.groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
        .join(refused.select(F.col(key).alias("_key"), "_first", "_stored"), F.col(key).eqNullSafe(F.col("_key")))
        .withColumn("copies", F.col("copies") - F.coalesce(taken, F.lit(False)).cast("bigint"))
        .filter("copies > 0")
        .select(*names, "copies", reason.alias("reason"))
    )
    tables.append(turned_away, rejects, rejects_schema(schema))


def load_dimensions(dims: dict[str, DataFrame], base: str) -> dict[str, DataFrame]:
    """Load the dimensions below ``base``, each by its key, and return them as stored."""
    stored = {}
    for name, schema in tables.DIMENSIONS.items():
        load_keyed(dims[name], f"{base}/{name}", schema, PRIMARY_KEYS[name], f"{base}/rejects/{name}")
        stored[name] = tables.read(dims[name].sparkSession, f"{base}/{name}", schema)
    return stored
