"""The Spark session that jobs of this library expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def session(app: str = "commerce", **more: str) -> SparkSession:
    """A session in UTC with ANSI rules, adaptive plans, and partition columns kept as text (``month='01'``)."""
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | more).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
