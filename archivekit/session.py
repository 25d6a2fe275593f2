"""A Spark session with the settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Timestamps are UTC; skewed and small shuffle partitions are split and merged
# at run time; whole files travel to Python in small batches; building long
# expressions does not record a call site for every step.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app: str = "archivekit", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
