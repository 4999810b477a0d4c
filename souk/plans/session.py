"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Timestamps carry no zone; pin the session so that nothing depends on the host.
    "spark.sql.session.timeZone": "UTC",
    # Overflow and bad casts fail instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
    # Joins pick broadcast from measured sizes, split skewed partitions and merge
    # small ones at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` takes further ``spark.*`` settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
