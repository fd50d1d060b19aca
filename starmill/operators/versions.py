"""Whole warehouses published at once: versions beside each other, and a manifest that names the current one.

A version is a folder of its own below ``versions/``. Its tables are written and checked
while readers still use the version before; one new manifest, written aside
and renamed, then makes it the current one. A build that fails on the way leaves a
folder that no manifest names, and the old version answers as before. The version
before the current one is kept for readers that have opened it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from starmill.scratch import children, read_text, remove, write_text

KEPT = 2


def _manifests(spark: SparkSession, base: str) -> list[str]:
    return sorted(n for n in children(spark, f"{base}/manifest") if n.isdigit())


def _named(spark: SparkSession, base: str, manifest: str) -> str:
    return read_text(spark, f"{base}/manifest/{manifest}").strip()


def new_version(base: str) -> str:
    """The folder of a version to be built; nobody reads it yet."""
    return f"{base}/versions/{uuid.uuid4().hex}"


def is_published(spark: SparkSession, base: str) -> bool:
    return bool(_manifests(spark, base))


def current(spark: SparkSession, base: str) -> str:
    """The folder of the published version; ``base`` itself where tables were loaded without versions."""
    manifests = _manifests(spark, base)
    return f"{base}/versions/{_named(spark, base, manifests[-1])}" if manifests else base


def publish(spark: SparkSession, base: str, version: str) -> None:
    """Make a complete version the current one, then delete those before the previous one.

    Two builds that end at the same time cannot take the same manifest: the
    second finds it there and fails, its version unpublished.
    """
    manifests = _manifests(spark, base)
    number = int(manifests[-1]) + 1 if manifests else 1
    write_text(spark, f"{base}/manifest/{number:08d}", version.rsplit("/", 1)[1])
    for old in _manifests(spark, base)[:-KEPT]:
        remove(spark, f"{base}/versions/{_named(spark, base, old)}")
        remove(spark, f"{base}/manifest/{old}")
