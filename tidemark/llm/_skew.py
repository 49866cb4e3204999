"""Joins to a table of unique keys of which some may have a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARES = 1024
MOST_BYTES, MOST_ROWS, ROW_BYTES = 4 << 20, 100_000, 40


def _bytes(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 8
    if isinstance(kind, T.StructType):
        return sum((_bytes(column.getField(f.name), f.dataType) for f in kind.fields), F.lit(8))
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(column)), F.lit(0)) + 16
    return F.lit(16)


def is_small(df: DataFrame, most_bytes: int = MOST_BYTES) -> bool:
    """Whether ``df`` has at most ``MOST_ROWS`` rows of at most ``most_bytes`` together, as counted."""
    width = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(ROW_BYTES))
    rows, size = df.select(width.alias("w")).limit(MOST_ROWS + 1).agg(F.count("*"), F.sum("w")).first()
    return rows <= MOST_ROWS and (size or 0) <= most_bytes


def small(df: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``df``, to be broadcast if it is small by count and bytes; otherwise Spark joins it by a shuffle."""
    return F.broadcast(df) if is_small(df, most_bytes) else df


def lookup(left: DataFrame, right: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Left join of ``left`` (``total`` rows) to ``right``, whose column ``count`` says how many of the rows have its key.

    A small ``right`` is broadcast. Of a larger one, keys with a 1024th of the rows or more are at most 1024: they are broadcast, and their rows
    aren't shuffled. The others' keys are too small to make a large task.
    """
    if is_small(right):
        return left.join(F.broadcast(right), key, "left")
    hot = F.col(count) * SHARES >= F.lit(total)
    heavy = right.filter(hot)
    many = left.join(F.broadcast(heavy), key)
    few = left.join(F.broadcast(heavy.select(key)), key, "left_anti").join(right.filter(~hot), key, "left")
    return many.unionByName(few)
