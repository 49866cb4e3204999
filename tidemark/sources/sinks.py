"""Where tables go: periods that are overwritten one by one, whole tables, documents by key, and tables that readers swap to."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lake import filesystem, replaced, text_at


def write_periods(df: DataFrame, path: str, period_col: str = "period") -> None:
    """Overwrites only the periods that ``df`` has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period_col).parquet(path)


def drop_periods(spark: SparkSession, path: str, periods: list[str], period_col: str = "period") -> None:
    """Removes periods, so that a rebuild without rows for them leaves nothing stale."""
    for period in periods:
        fs, hpath = filesystem(spark, f"{path.rstrip('/')}/{period_col}={period}")
        fs.delete(hpath, True)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def upserted(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``old`` whose key ``new`` lacks, and all of ``new``. Keys that vanish from ``new`` stay."""
    return old.join(new, key, "left_anti").unionByName(new)


POINTER = "CURRENT"


def publish(spark: SparkSession, folder: str, tables: DataFrame | Iterable[tuple[str, DataFrame]], keep: int = 2, written: dict[str, DataFrame] | None = None) -> str:
    """Writes a new snapshot (a table, or some by name, one after the other) and then points the folder to it; its name.

    Until the pointer is replaced readers see the old snapshot, whatever fails before. Of older snapshots the last ``keep - 1`` stay for readers
    that have them open. ``written`` gets each table as soon as it is written, so that later ones can be made of it.
    """
    folder = folder.rstrip("/")
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    for part, df in [("", tables)] if isinstance(tables, DataFrame) else tables:
        path = f"{folder}/{name}/{part}".rstrip("/")
        df.write.parquet(path)
        if written is not None:
            written[part] = spark.read.parquet(path)
    replaced(spark, f"{folder}/{POINTER}", name)
    fs, hpath = filesystem(spark, folder)
    found = sorted(s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory())
    old = [x for x in found if x < name]
    for gone in old[: max(0, len(old) - keep + 1)]:
        fs.delete(filesystem(spark, f"{folder}/{gone}")[1], True)
    return name


def current(spark: SparkSession, folder: str) -> str | None:
    """The name of the snapshot that a folder points to; None before the first."""
    return text_at(spark, f"{folder.rstrip('/')}/{POINTER}")


def snapshot(spark: SparkSession, folder: str, table: str = "") -> DataFrame:
    """The table that the folder's pointer shows now; it stays that one while it is used."""
    name = current(spark, folder)
    if name is None:
        raise FileNotFoundError(f"nothing is published in {folder}")
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}/{table}".rstrip("/"))


def swap_in(df: DataFrame, folder: str, view: str) -> str:
    """Publishes a new snapshot, then points ``view`` at it: readers see the old table or the new one, never a part."""
    name = publish(df.sparkSession, folder, df)
    snapshot(df.sparkSession, folder).createOrReplaceTempView(view)
    return f"{folder.rstrip('/')}/{name}"


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 10_000, **properties: str) -> None:
    """Replaces a warehouse table's rows but not the table, its grants or its indexes."""
    df.write.mode("overwrite").format("jdbc").options(url=url, dbtable=table, truncate="true", batchsize=str(batch), **properties).save()


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))
