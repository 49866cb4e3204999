"""Deliveries that overlap: the newest wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_newest(df: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """One row of each key: the first in the given order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def with_conflicts(df: DataFrame, keys: list[str], value: str, into: str) -> DataFrame:
    """Whether a row's key has more than one value, by the partitioning that :func:`keep_newest` needs too."""
    same = Window.partitionBy(*keys)
    return df.withColumn(into, F.min(value).over(same) != F.max(value).over(same))


def newest_delivery() -> list[Column]:
    """Later window ends win, then later starts, then lower lines."""
    return [F.desc_nulls_last("source_end"), F.desc_nulls_last("source_start"), F.desc("line_no"), F.desc("source_file")]


def conflicting_keys(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys with more than one distinct value, and how many."""
    return df.groupBy(*keys).agg(F.count_distinct(value).alias("versions")).filter("versions > 1")
