"""Deliveries as a stream of files: each batch rebuilds the months that its files touch.

The newest delivery wins even if it arrives first, so months are rebuilt from all their files; dropping late duplicates by watermark would keep the first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.jobs import Lake, build_daily
from ..sources.lake import period_paths


def rebuild_periods(spark: SparkSession, raw_root: str, tables: Lake, most_unexpected: float = 0.02) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: finds the periods in the batch's file paths and rebuilds each from all its files."""

    def run(batch: DataFrame, _: int) -> None:
        found = batch.select(F.regexp_extract("source_file", r"period=(\d{4}-\d{2})", 1).alias("p")).distinct().collect()
        periods = sorted(r["p"] for r in found if r["p"])
        if periods:
            build_daily(spark, period_paths(spark, raw_root, periods), tables, most_unexpected)

    return run


def watch(spark: SparkSession, raw_root: str, tables: Lake, checkpoint: str, most_unexpected: float = 0.02, **trigger) -> StreamingQuery:
    """Starts the stream; ``availableNow=True`` takes what is there and ends."""
    files = spark.readStream.format("text").option("wholetext", True).load(f"{raw_root.rstrip('/')}/*/*.txt")
    named = files.select(F.col("_metadata.file_path").alias("source_file"))
    writer = named.writeStream.foreachBatch(rebuild_periods(spark, raw_root, tables, most_unexpected)).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
