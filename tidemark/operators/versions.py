"""Histories of attributes, and the registry documents made of them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ATTRIBUTES = ["scheme_name", "scheme_type", "category", "fund_house", "isin_growth", "isin_reinvest"]


def attribute_versions(df: DataFrame, key: str = "scheme_code", attributes: list[str] | None = None, day: str = "nav_date", rows: str = "nav_rows") -> DataFrame:
    """A row for every set of attributes that a key has had: first_seen, last_seen and how many rows. A set that comes back is the same version."""
    seen = df.groupBy(key, *(attributes or ATTRIBUTES))
    return seen.agg(F.min(day).alias("first_seen"), F.max(day).alias("last_seen"), F.count("*").alias(rows))


def registry_documents(versions: DataFrame, key: str = "scheme_code", attributes: list[str] | None = None, rows: str = "nav_rows", now: datetime | None = None) -> DataFrame:
    """A document for every key: the current attributes, the history in order of first and last day, the days' limits, and the number of renames.

    Current is the version seen last (of those, the one that began last; of those, the last by its attributes). A missing name counts as a name of its own.
    """
    names = attributes or ATTRIBUTES
    name = names[0]
    entry = F.struct("first_seen", "last_seen", *names, rows)
    # A missing name counts once among the distinct ones.
    distinct = F.count_distinct(name) + F.max(F.col(name).isNull().cast("long"))
    docs = versions.groupBy(key).agg(
        F.max_by(F.struct(*names), F.struct("last_seen", "first_seen", *names)).alias("current"),
        F.array_sort(F.collect_list(entry)).alias("history"),
        F.min("first_seen").alias("first_nav_date"),
        F.max("last_seen").alias("last_nav_date"),
        (distinct - 1).cast("int").alias("name_changes"),
    )
    ordered = F.transform("history", lambda h: F.struct(*[h[c].alias(c) for c in (*names, "first_seen", "last_seen", rows)]))
    stamp = F.lit(now) if now else F.current_timestamp()
    return docs.withColumns({"history": ordered, "updated_at": stamp})


def registry_rows(documents: DataFrame, key: str = "scheme_code") -> DataFrame:
    """Documents as flat rows of their current attributes."""
    return documents.select(key, "current.*", "first_nav_date", "last_nav_date", "name_changes")
