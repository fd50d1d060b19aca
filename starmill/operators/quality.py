"""Data-quality jobs: declared constraints, checked instead of enforced."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill import schemas
from starmill.plans.star import Star
from starmill.scratch import stage


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _rows_of(one_row: DataFrame, label: str, value: str, names: list[str]) -> DataFrame:
    """Turn the single row of a many-column aggregate into one row per column."""
    pairs = ", ".join(f"'{name}', `{name}`" for name in names)
    return one_row.selectExpr(f"stack({len(names)}, {pairs}) as ({label}, {value})")


def _dimension(star: Star, column: str) -> DataFrame:
    name, _ = schemas.FOREIGN_KEYS[column]
    return getattr(star, name)


def orphan_keys(star: Star) -> DataFrame:
    """Foreign-key values no dimension row has, with the fact rows that use them.

    The five keys are counted in one pass, each value folded within its task,
    so a frequent value is shuffled once per task and meets the dimension as a
    single row.
    """
    keys = list(schemas.FOREIGN_KEYS)
    pairs = ", ".join(f"'{key}', cast({key} as string)" for key in keys)
    used = (
        star.sales.selectExpr(f"stack({len(keys)}, {pairs}) as (foreign_key, value)")
        .filter("value is not null")
        .groupBy("foreign_key", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = _union(
        [
            _dimension(star, key).select(
                F.lit(key).alias("foreign_key"), F.col(key).cast("string").alias("value")
            )
            for key in keys
        ]
    )
    return used.join(known, ["foreign_key", "value"], "left_anti")


def fk_orphans(star: Star) -> DataFrame:
    """Fact rows without a dimension row, per foreign key."""
    keys = list(schemas.FOREIGN_KEYS)
    totals = orphan_keys(star).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("foreign_key") == key, F.col("rows"))), F.lit(0)).alias(key)
            for key in keys
        ]
    )
    return _rows_of(totals, "foreign_key", "orphan_rows", keys)


def pk_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Keys held more than once, and the rows too many, per table."""

    def check(name: str, df: DataFrame) -> DataFrame:
        copies = df.groupBy(schemas.PRIMARY_KEYS[name]).agg(F.count(F.lit(1)).alias("copies"))
        return copies.filter("copies > 1").agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("duplicate_keys"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus_rows"),
        )

    return _union([check(name, df) for name, df in tables.items()])


def not_null_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """NULLs per column declared NOT NULL; one pass per table."""

    def check(name: str, df: DataFrame) -> DataFrame:
        columns = schemas.NOT_NULL[name]
        nulls = df.agg(*[F.count_if(F.col(column).isNull()).alias(column) for column in columns])
        return _rows_of(nulls, "column_name", "null_rows", columns).select(
            F.lit(name).alias("table_name"), "column_name", "null_rows"
        )

    return _union([check(name, df) for name, df in tables.items()])


def require_keys(tables: dict[str, DataFrame]) -> None:
    """Raise if a primary key occurs twice or is missing; one row per table is collected."""
    faults = [
        f"{row.table_name}: {row.duplicate_keys} keys more than once"
        for row in pk_violations(tables).filter("duplicate_keys > 0").collect()
    ]
    for name, df in tables.items():
        if missing := df.filter(F.col(schemas.PRIMARY_KEYS[name]).isNull()).count():
            faults.append(f"{name}: {missing} rows without a key")
    if faults:
        raise ValueError("; ".join(faults))


def fk_set_null(star: Star) -> DataFrame:
    """Apply the foreign-key policy to the fact.

    Store and supplier ids without a dimension row become NULL; a missing
    customer, product or date is flagged for the caller to refuse.

    The orphan values are found first and stored. They are few as a rule, and
    the planner sees how many: the fact is then joined with them in place,
    where joins with five dimensions would shuffle it five times.
    """
    orphans = stage(orphan_keys(star), "orphan-keys")
    checked = star.sales
    flags = []
    for key, (_, policy) in schemas.FOREIGN_KEYS.items():
        values = orphans.filter(F.col("foreign_key") == key).select(
            F.col("value").cast(schemas.FACT_ENRICHED[key].dataType).alias(key),
            F.lit(True).alias("_orphan"),
        )
        checked = checked.join(values, key, "left")
        if policy == "set null":
            checked = checked.withColumn(key, F.when(F.col("_orphan").isNull(), F.col(key)))
        else:
            flags.append(key.replace("_id", "_missing"))
            checked = checked.withColumn(flags[-1], F.col("_orphan").isNotNull().cast("int"))
        checked = checked.drop("_orphan")
    return checked.select(*schemas.FACT_ENRICHED.names, *flags)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [
            df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
            for name, df in tables.items()
        ]
    )


def cleaning_report(customers: DataFrame, products: DataFrame, transactions: DataFrame) -> DataFrame:
    """Rows left after cleaning."""
    return row_counts({"customers": customers, "products": products, "transactions": transactions})


def completion_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Whether every table of the warehouse holds something."""
    return row_counts(tables).withColumn("is_complete", (F.col("row_count") > 0).cast("int"))
