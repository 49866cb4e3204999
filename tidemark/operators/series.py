"""Dated series: look-backs, returns, period ends, jumps. All use one window (key, date), so that one shuffle serves them together."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Series:
    key: str = "scheme_code"
    day: str = "nav_date"
    value: str = "nav"

    @property
    def order(self) -> WindowSpec:
        return Window.partitionBy(self.key).orderBy(self.day)


NAV = Series()


def lookback(months: int, s: Series = NAV, tolerance_days: int = 7) -> Column:
    """The value of the last row at or before the day ``months`` earlier (clamped to the month's end); null if there is none, or
    if it is more than ``tolerance_days`` older than that day."""
    rows = f"OVER (PARTITION BY {s.key} ORDER BY {s.day} RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL '{months}' MONTH PRECEDING)"
    found = F.expr(f"last_value(struct({s.day} AS d, {s.value} AS v)) {rows}")
    return F.when(F.datediff(F.add_months(s.day, -months), found["d"]) <= tolerance_days, found["v"])


def growth(now: Column, then: Column, years: int = 1) -> Column:
    """Growth for a year: the ratio's ``years``-th root less 1."""
    ratio = now / then
    return (ratio if years == 1 else F.pow(ratio, F.lit(1.0 / years))) - 1


def log_return(s: Series = NAV, most_gap_days: int = 10) -> Column:
    """Logarithm of the ratio to the row before; null for the first row and over longer gaps."""
    before, day = F.lag(s.value).over(s.order), F.lag(s.day).over(s.order)
    return F.when(F.datediff(F.col(s.day), day) <= most_gap_days, F.log(F.col(s.value) / before))


def daily_returns(df: DataFrame, s: Series = NAV, most_gap_days: int = 10) -> DataFrame:
    return df.withColumns({"prev_day": F.lag(s.day).over(s.order), "log_return": log_return(s, most_gap_days)})


def period_ends(df: DataFrame, s: Series = NAV) -> DataFrame:
    """Each month's last row of every series, with ``is_latest`` for the series' last."""
    following = F.lead(s.day).over(s.order)
    marked = df.withColumn("_next", following)
    ends = F.col("_next").isNull() | (F.trunc("_next", "MM") != F.trunc(s.day, "MM"))
    return marked.filter(ends).withColumn("is_latest", F.col("_next").isNull()).drop("_next")


def jumps(df: DataFrame, s: Series = NAV, most: float = 0.5) -> DataFrame:
    """Rows whose value changed by more than ``most`` (as a ratio) since the row before, however long ago that was."""
    before = F.lag(s.value).over(s.order)
    rows = df.select(s.key, F.lag(s.day).over(s.order).alias(f"prev_{s.day}"), before.alias(f"prev_{s.value}"), s.day, s.value)
    change = F.try_divide(F.col(s.value), F.col(f"prev_{s.value}")) - 1
    return rows.withColumn("change", change.cast("double")).filter(F.abs(change) > most)


def carried(value: Column, order: WindowSpec) -> Column:
    """The last value that isn't null, down the rows of a window. A struct around a null is a value: it resets what is carried."""
    return F.last(value, ignorenulls=True).over(order)
