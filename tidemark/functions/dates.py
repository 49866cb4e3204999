"""Windows of dates."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WINDOW = "window_start date, window_end date"


def _pieces(spark: SparkSession, start: date, end: date, unit: str, step: str, last: Column) -> DataFrame:
    if end < start:
        raise ValueError(f"window ends ({end}) before it starts ({start})")
    span = spark.createDataFrame([(start, end)], "s date, e date")
    firsts = span.select("s", "e", F.explode(F.sequence(F.trunc("s", unit), F.col("e"), F.expr(f"interval 1 {step}"))).alias("p"))
    return firsts.select(F.greatest("s", "p").alias("window_start"), F.least("e", last).alias("window_end")).orderBy("window_start")


def month_windows(spark: SparkSession, start: date, end: date) -> DataFrame:
    """[start, end] cut at the ends of months."""
    return _pieces(spark, start, end, "MM", "month", F.last_day("p"))


def year_chunks(spark: SparkSession, start: date, end: date) -> DataFrame:
    """[start, end] cut at the ends of years."""
    return _pieces(spark, start, end, "YYYY", "year", F.date_sub(F.add_months("p", 12), 1))


def local_day(moment: datetime, zone: str = "Asia/Kolkata") -> date:
    """The date of a moment where the publisher is; a moment without a zone is in UTC."""
    return (moment if moment.tzinfo else moment.replace(tzinfo=UTC)).astimezone(ZoneInfo(zone)).date()


def daily_window(end: date | datetime, days: int = 5, zone: str = "Asia/Kolkata") -> tuple[date, date]:
    """The window that a daily run fetches again: ``days`` before ``end`` up to ``end`` (a day, or a moment whose day in ``zone`` counts)."""
    last = local_day(end, zone) if isinstance(end, datetime) else end
    return last - timedelta(days=days), last


def clamped(start: date, earliest: date) -> date:
    return max(start, earliest)


def period_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def period_counts(df: DataFrame, day: str) -> DataFrame:
    """How many rows each month has."""
    return df.groupBy(period_of(F.col(day)).alias("period")).agg(F.count("*").alias("rows"))


def epoch_seconds(day: Column) -> Column:
    return F.unix_timestamp(day.cast("timestamp"))
