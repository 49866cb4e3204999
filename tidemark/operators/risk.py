"""Period-end snapshots of a series: returns, compound growth, volatility, drawdown and Sharpe ratio.

One shuffle by key: daily look-backs and returns; days gathered by (key, month), which the same partitioning serves; then a
frame of months that is always long enough gives each month end its days. What depends on the
month end's own date is decided on that array with built-in higher-order functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .series import NAV, Series, growth, log_return, lookback


@dataclass(frozen=True)
class RiskRules:
    risk_free_rate: float = 0.065
    lookup_gap_days: int = 7
    return_gap_days: int = 10
    least_returns: int = 200
    least_volatility: float = 1e-4
    trading_days: int = 252
    window_days: int = 365


METRICS = ["ret_1m", "ret_1y", "cagr_3y", "cagr_5y", "vol_1y", "max_drawdown_1y", "sharpe_1y"]


def sample_deviation(values: Column) -> Column:
    """Standard deviation (n - 1) of an array, in one pass: running mean and running sum of squares about it."""
    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))

    def step(a: Column, x: Column) -> Column:
        n = a["n"] + 1
        mean = a["mean"] + (x - a["mean"]) / n
        return F.struct(n.alias("n"), mean.alias("mean"), (a["squares"] + (x - a["mean"]) * (x - mean)).alias("squares"))

    return F.aggregate(values, start, step, lambda a: F.when(a["n"] > 1, F.sqrt(a["squares"] / (a["n"] - 1))))


def deepest_fall(values: Column) -> Column:
    """The least ratio of a value to the greatest one so far, less 1."""
    start = F.struct(F.lit(float("-inf")).alias("top"), F.lit(0.0).alias("fall"))

    def step(a: Column, x: Column) -> Column:
        top = F.greatest(a["top"], x)
        return F.struct(top.alias("top"), F.least(a["fall"], x / top - 1).alias("fall"))

    return F.aggregate(values, start, step, lambda a: a["fall"])


def with_lookbacks(df: DataFrame, s: Series = NAV, rules: RiskRules = RiskRules()) -> DataFrame:
    """Every day with its earlier day, log return and returns over 1 month and 1, 3 and 5 years."""
    now = F.col(s.value)
    back = {n: lookback(n, s, rules.lookup_gap_days) for n in (1, 12, 36, 60)}
    return df.select(
        s.key,
        s.day,
        s.value,
        F.lag(s.day).over(s.order).alias("prev_day"),
        log_return(s, rules.return_gap_days).alias("log_return"),
        growth(now, back[1]).alias("ret_1m"),
        growth(now, back[12]).alias("ret_1y"),
        growth(now, back[36], 3).alias("cagr_3y"),
        growth(now, back[60], 5).alias("cagr_5y"),
    )


def snapshot_metrics(df: DataFrame, s: Series = NAV, rules: RiskRules = RiskRules()) -> DataFrame:
    """A row for every month's last day of every series: key, as_of_date, value, is_latest, the metrics and obs_1y.

    Days of a series are unique and values positive. The trailing year begins at the first day not more than 365 days back; that
    day's own return isn't counted. Volatility and drawdown need ``least_returns`` returns, and Sharpe a volatility that isn't nil.
    """
    days = with_lookbacks(df.select(s.key, s.day, F.col(s.value).cast("double").alias(s.value)), s, rules)
    day = F.struct(F.col(s.day).alias("d"), F.col("prev_day").alias("p"), F.col("log_return").alias("r"), F.col(s.value).alias("v"))
    last = F.struct(s.day, s.value, "ret_1m", "ret_1y", "cagr_3y", "cagr_5y")
    months = days.groupBy(s.key, (F.year(s.day) * 12 + F.month(s.day)).alias("month")).agg(F.max_by(last, s.day).alias("last"), F.array_sort(F.collect_list(day)).alias("days"))
    by_month = Window.partitionBy(s.key).orderBy("month")
    reach = -(-rules.window_days // 28)
    months = months.withColumns({"is_latest": F.lead("month").over(by_month).isNull(), "days": F.flatten(F.collect_list("days").over(by_month.rangeBetween(-reach, 0)))})
    from_day = F.date_sub(F.col(f"last.{s.day}"), rules.window_days)
    months = months.withColumn("days", F.filter("days", lambda x: x["d"] >= from_day))
    returns = F.transform(F.filter("days", lambda x: (x["p"] >= from_day) & x["r"].isNotNull()), lambda x: x["r"])
    months = months.withColumns({"returns": returns, "values": F.transform("days", lambda x: x["v"])})
    enough = F.size("returns") >= rules.least_returns
    months = months.withColumn("vol_1y", F.when(enough, sample_deviation(F.col("returns")) * F.sqrt(F.lit(float(rules.trading_days)))))
    sharpe = F.when(F.col("vol_1y") >= rules.least_volatility, (F.col("last.ret_1y") - rules.risk_free_rate) / F.col("vol_1y"))
    return months.select(
        s.key,
        F.col(f"last.{s.day}").alias("as_of_date"),
        F.col(f"last.{s.value}").alias(s.value),
        "is_latest",
        *[F.col(f"last.{c}").alias(c) for c in ("ret_1m", "ret_1y", "cagr_3y", "cagr_5y")],
        "vol_1y",
        F.when(enough, deepest_fall(F.col("values"))).alias("max_drawdown_1y"),
        sharpe.alias("sharpe_1y"),
        F.size("returns").alias("obs_1y"),
    )
