"""The engine's session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(name: str = "tidemark", master: str | None = None, shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    """A session in UTC that overwrites only the partitions that it writes. On a cluster, master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | {k.replace("__", "."): v for k, v in settings.items()})
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
    return builder.getOrCreate()
