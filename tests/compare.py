"""Runs a query in Spark and its oracle in DuckDB and compares all rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


# Spark type -> DuckDB type
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: schema, row count, then up to three rows of each side."""
    relation = con.sql(sql)
    spark_schema = sorted((f.name, TYPES[f.dataType.simpleString()]) for f in df.schema)
    duck_schema = sorted(zip(relation.columns, map(str, relation.types)))
    found = []
    if spark_schema != duck_schema:
        found.append(f"schema {set(spark_schema) ^ set(duck_schema)}")
    mine = _rows(df.columns, df.collect())
    theirs = _rows(relation.columns, relation.fetchall())
    if mine != theirs:
        found.append(f"rows {mine.total()} vs {theirs.total()}")
        found += [f"only Spark {row}" for row in list((mine - theirs))[:3]]
        found += [f"only SQL {row}" for row in list((theirs - mine))[:3]]
    return found
