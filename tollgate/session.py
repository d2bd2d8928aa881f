"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution splits skewed join partitions and turns a join into a
# broadcast only after it has measured the small side, so no join in this
# package carries a broadcast hint unless its row bound is known beforehand.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(name: str = "tollgate", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` uses ``_`` for ``.`` in keys."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()
