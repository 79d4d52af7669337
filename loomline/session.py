"""Session factory for command-line use; queries otherwise take the caller's session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "loomline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, adaptive execution and per-season partition overwrite."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
