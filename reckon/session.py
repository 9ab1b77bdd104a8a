"""Session builder and the few settings every query of the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC day boundaries on every side, runtime re-planning on, integer overflow an error.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, app: str = "reckon", **extra: str) -> SparkSession:
    """A session with the engine's settings; ``master`` only for local runs, a cluster sets its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
