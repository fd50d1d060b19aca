"""Where intermediate tables, sinks and streaming checkpoints are written."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


# Paths given out within the innermost scope.
_given: ContextVar[list[str] | None] = ContextVar("given", default=None)


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="starmill-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without it: a machine-local folder on a
    cluster would be invisible to the other executors and lost with its host.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_root()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used before, below the shared folder."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if (given := _given.get()) is not None:
        given.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Later passes then scan only the columns they need instead of recomputing
    the plan, Spark sees the true size of the table, and a lost executor costs
    a re-read rather than the whole lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, whatever was given a scratch path within it.

    Results are read lazily, so a result has to be written (or collected)
    inside the scope.
    """
    paths: list[str] = []
    token = _given.set(paths)
    try:
        yield
    finally:
        _given.reset(token)
        for path in paths:
            remove(spark, path)


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _hadoop(spark, path)
    return files.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and all below it, on whatever store holds it."""
    files, target = _hadoop(spark, path)
    files.delete(target, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder; none if it does not exist."""
    files, target = _hadoop(spark, path)
    return [s.getPath().getName() for s in files.listStatus(target)] if files.exists(target) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all; an error if the name is taken."""
    files, target = _hadoop(spark, path)
    if files.exists(target):
        raise FileExistsError(path)
    _, aside = _hadoop(spark, f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}")
    out = files.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not files.rename(aside, target):
        files.delete(aside, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    files, target = _hadoop(spark, path)
    source = files.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()
