"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from stillroom import files

SHARED_DIR_KEY = "spark.checkpoint.dir"

_ROOTS: set[str] = set()

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app_name: str = "stillroom", master: str | None = None, **extra: str) -> SparkSession:
    """Return a session with the settings the engine is tuned for."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where that is not set, a folder in the warehouse, which all executors share as well.
    """
    configured = spark.conf.get(SHARED_DIR_KEY, None)
    return configured.rstrip("/") if configured else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def _scratch_root(spark: SparkSession) -> str:
    """The application's part of the shared folder; it goes when the application ends, at the latest."""
    root = f"{shared_dir(spark)}/stillroom/{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        files.make_transient(spark, root)
        _ROOTS.add(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below the shared folder, in a part that belongs to this application."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application stored on the way. Call it when its results have been written."""
    root = _scratch_root(spark)
    files.remove(spark, root)
    _ROOTS.discard(root)
