"""Expectations of tables: each gives the rows that break it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has. Rows with a null key part aren't held against a single-column key."""
    rows = df.filter(F.col(keys[0]).isNotNull()) if len(keys) == 1 else df
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Other values than those accepted, and how often they are there."""
    return df.filter(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n"))


def related(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose (present) key the parent lacks."""
    keys = parent.select(F.col(parent_column).alias(column))
    return df.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def holds(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is false; unknown isn't false."""
    return df.filter(~condition)


def non_negative(df: DataFrame, column: str) -> DataFrame:
    return holds(df, F.col(column) >= 0)


def non_positive(df: DataFrame, column: str) -> DataFrame:
    return holds(df, F.col(column) <= 0)


def one_latest(df: DataFrame, key: str = "scheme_code", flag: str = "is_latest") -> DataFrame:
    """Keys with more than one row flagged as the latest."""
    return df.filter(flag).groupBy(key).agg(F.count("*").alias("n")).filter("n <> 1")


def implausible(df: DataFrame, column: str = "ret_1y", low: float = -0.9, high: float = 3.0) -> DataFrame:
    """Rows to warn about: a return below ``low`` or above ``high``."""
    return df.filter((F.col(column) < low) | (F.col(column) > high))


def violations(checks: dict[str, DataFrame]) -> DataFrame:
    """One row for each check: its name and how many violations it found."""
    counts = [df.agg(F.lit(name).alias("check"), F.count("*").alias("violations")) for name, df in checks.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
