"""Session settings shared by tests and the bench; a cluster brings its own."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The library itself never changes these at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

LOCAL = {
    "spark.ui.enabled": "false",
    "spark.driver.memory": "12g",
    "spark.sql.shuffle.partitions": "8",
}


def local_session(cores: str | int = "*", app_name: str = "starmill") -> SparkSession:
    """A local session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for key, value in {**DEFAULTS, **LOCAL}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
