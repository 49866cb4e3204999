"""Rows dealt into blocks by ranges of a numeric key, in order, from bounds that hold for the whole job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 128 << 20
COARSE = 2048
FINE = 128


def blocks(df: DataFrame) -> int:
    """How many blocks: as many as shuffle partitions, or more if Spark takes the input to be larger than ``BLOCK_BYTES`` for each."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    asked = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(COARSE * FINE, max(asked, -(-size // BLOCK_BYTES) if size < 1 << 60 else 0)))


@dataclass(frozen=True)
class Ranges:
    """``count`` blocks in rising order of the key, and the expression that gives a row's block. Null keys are in block 0."""

    count: int
    block: Column


def _tree(key: Column, cuts: list, low: int, high: int) -> Column:
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(key > F.lit(cuts[mid]), _tree(key, cuts, mid + 1, high)).otherwise(_tree(key, cuts, low, mid))


def ranges(df: DataFrame, key: str, n: int) -> Ranges:
    """Blocks of about equal numbers of rows: up to ``COARSE`` quantiles, looked up as a balanced tree, and beyond that each quantile's
    span in equal steps. The driver gets the quantiles and two bounds."""
    coarse, fine = min(n, COARSE), -(-n // COARSE)
    shares = [k / coarse for k in range(1, coarse)]
    wanted = [F.min(key).alias("low"), F.max(key).alias("high")]
    if shares:
        wanted.append(F.percentile_approx(key, shares, max(10_000, 20 * coarse)).alias("cuts"))
    got = df.agg(*wanted).first()
    cuts = sorted(set((got["cuts"] if shares else None) or []))
    column = F.col(key)
    at = _tree(column, cuts, 0, len(cuts))
    if fine == 1 or got["low"] is None:
        return Ranges(len(cuts) + 1, at)
    edges = F.array(*[F.lit(x).cast("double") for x in [got["low"], *cuts, got["high"]]])
    low, high = F.element_at(edges, at + 1), F.element_at(edges, at + 2)
    step = F.floor(F.try_divide((column - low) * fine, high - low))
    inside = F.greatest(F.lit(0), F.least(F.lit(fine - 1), F.coalesce(step, F.lit(0)))).cast("int")
    return Ranges((len(cuts) + 1) * fine, at * fine + F.when(column.isNull(), 0).otherwise(inside))
