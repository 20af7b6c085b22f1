"""The session's settings that the engine relies on."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "folioflow", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the engine's settings; on a cluster, set spark.checkpoint.dir to a shared folder."""
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | settings)
    return (builder.master(master) if master else builder).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share: spark.checkpoint.dir.

    Where that is unset (tests, one machine) a folder below the warehouse is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
    return f"{base.rstrip('/')}/folioflow-{uuid.uuid4().hex}"
