"""Tables for analysts: classified keys, monthly facts, scorecards in peer groups, summaries, anomalies, and dashboard queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import before_first

# The kinds of option, each with the words that tell it, in the order in which they are tried.
OPTIONS = [("IDCW", ("idcw", "dividend")), ("Bonus", ("bonus",)), ("Growth", ("growth",))]


def plan_of(name: Column, word: str = "direct", yes: str = "Direct", no: str = "Regular") -> Column:
    """By whether the name has the word, in any case; a missing name hasn't."""
    return F.when(name.ilike(f"%{word}%"), yes).otherwise(no)


def option_of(name: Column) -> Column:
    kind = F.lit("Other")
    for label, marks in reversed(OPTIONS):
        has = F.lit(False)
        for word in marks:
            has = has | name.ilike(f"%{word}%")
        kind = F.when(has, label).otherwise(kind)
    return kind


def with_active(df: DataFrame, last_day: str, days: int = 7) -> DataFrame:
    """Whether a row's last day is one of the ``days`` before the newest of all, or that one."""
    newest = df.agg(F.max(last_day).alias("_newest"))
    rows = df.crossJoin(F.broadcast(newest))  # one row
    return rows.withColumn("is_active", F.col(last_day) >= F.date_sub("_newest", days)).drop("_newest")


def classified(registry: DataFrame, active_days: int = 7, key: str = "scheme_code") -> DataFrame:
    """Registry rows with asset class, plan, option, and whether they were seen in the ``active_days`` before the newest day of all."""
    kinds = {"asset_class": before_first(F.col("category"), " - "), "plan": plan_of(F.col("scheme_name")), "option_type": option_of(F.col("scheme_name"))}
    rows = with_active(registry, "last_nav_date", active_days).withColumns(kinds)
    return rows.select(key, "scheme_name", "scheme_type", "category", "asset_class", "fund_house", "isin_growth", "isin_reinvest", "plan", "option_type", "first_nav_date", "last_nav_date", "is_active", "name_changes")


def monthly(metrics: DataFrame, key: str = "scheme_code") -> DataFrame:
    """Month-end facts; the latest row of a key is its month to date."""
    measures = ["nav", "ret_1m", "ret_1y", "cagr_3y", "cagr_5y", "vol_1y", "max_drawdown_1y", "sharpe_1y"]
    return metrics.select(key, F.trunc("as_of_date", "MM").alias("month"), "as_of_date", F.col("is_latest").alias("is_month_to_date"), *measures)


def median(column: str) -> Column:
    return F.percentile(column, 0.5)


def scorecard(metrics: DataFrame, dim: DataFrame, benchmark_code: int | None, key: str = "scheme_code") -> DataFrame:
    """The latest metrics of every active growth option, ranked among its peers (category and plan) and held against their medians and a benchmark.

    Keys without a category have no peers and are left out. Without the benchmark's row the differences from it are null.
    """
    about = dim.filter("is_active AND option_type = 'Growth'").select(key, "scheme_name", "fund_house", "category", "asset_class", "plan")
    newest = metrics.filter("is_latest")
    latest = newest.join(about, key).filter("category IS NOT NULL")
    bench = newest.filter(F.col(key) == F.lit(benchmark_code)).select(*[F.col(c).alias(f"bench_{c}") for c in ("ret_1y", "cagr_3y", "cagr_5y")])
    peers = Window.partitionBy("category", "plan")  # one shuffle for counts, medians and ranks
    stats = {"funds_in_category": F.count("*").over(peers), "category_median_ret_1y": median("ret_1y").over(peers), "category_median_cagr_3y": median("cagr_3y").over(peers)}
    ranks = {f"rank_{c}": F.rank().over(peers.orderBy(F.desc_nulls_last(c))) for c in ("ret_1y", "cagr_3y", "sharpe_1y")}
    # The benchmark is the latest row of one key: one row, or none.
    rows = latest.withColumns(stats | ranks).join(F.broadcast(bench), F.lit(True), "left")
    rows = rows.withColumns({"ret_1y_vs_category": F.col("ret_1y") - F.col("category_median_ret_1y")} | {f"{c}_vs_benchmark": F.col(c) - F.col(f"bench_{c}") for c in ("ret_1y", "cagr_3y", "cagr_5y")})
    return rows.select(key, *SCORECARD)


SCORECARD = (
    "scheme_name fund_house category asset_class plan as_of_date nav ret_1m ret_1y cagr_3y cagr_5y vol_1y max_drawdown_1y sharpe_1y funds_in_category "
    "category_median_ret_1y category_median_cagr_3y ret_1y_vs_category ret_1y_vs_benchmark cagr_3y_vs_benchmark cagr_5y_vs_benchmark rank_ret_1y rank_cagr_3y rank_sharpe_1y"
).split()


def category_summary(card: DataFrame) -> DataFrame:
    """Peer groups as wholes, and how widely their members differ."""
    groups = card.groupBy("category", "asset_class", "plan").agg(
        F.count("*").alias("funds"),
        F.percentile("ret_1y", F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75)])).alias("q"),
        median("cagr_3y").alias("median_cagr_3y"),
        median("cagr_5y").alias("median_cagr_5y"),
        F.avg("vol_1y").alias("avg_vol_1y"),
        F.avg("max_drawdown_1y").alias("avg_max_drawdown_1y"),
        F.max("as_of_date").alias("as_of_date"),
    )
    low, mid, high = (F.col("q")[k] for k in range(3))
    quartiles = [low.alias("p25_ret_1y"), mid.alias("median_ret_1y"), high.alias("p75_ret_1y"), (high - low).alias("ret_1y_spread")]
    return groups.select("category", "asset_class", "plan", "funds", *quartiles, "median_cagr_3y", "median_cagr_5y", "avg_vol_1y", "avg_max_drawdown_1y", "as_of_date")


def house_summary(card: DataFrame) -> DataFrame:
    """Houses by breadth, and by how often their members beat the median of their peers."""
    beats = F.when(F.col("ret_1y").isNotNull(), F.when(F.col("ret_1y_vs_category") > 0, 1.0).otherwise(0.0))
    return card.groupBy("fund_house").agg(
        F.count("*").alias("growth_schemes"),
        F.count_if(F.col("plan") == "Direct").alias("direct_schemes"),
        F.count_distinct("category").alias("categories"),
        F.avg(beats).alias("share_beating_category_1y"),
        median("ret_1y_vs_category").alias("median_ret_1y_vs_category"),
    )


def anomalies(jumps: DataFrame, dim: DataFrame, key: str = "scheme_code") -> DataFrame:
    """Jumps with what is known of their key; unknown keys stay."""
    about = dim.select(key, "scheme_name", "fund_house", "category")
    return jumps.join(about, key, "left").select(key, "scheme_name", "fund_house", "category", "prev_nav_date", "prev_nav", "nav_date", "nav", "change")


def percent(x: Column, digits: int) -> Column:
    """As per cent, rounded half away from zero."""
    return F.round((x * 100).cast("decimal(38,10)"), digits)


def top_funds(card: DataFrame, plan: str = "Direct", asset_class: str = "Equity Scheme", n: int = 15) -> DataFrame:
    rows = card.filter((F.col("plan") == plan) & (F.col("asset_class") == asset_class) & F.col("ret_1y").isNotNull())
    rows = rows.orderBy(F.desc("ret_1y"), F.asc("scheme_code")).limit(n)
    short = F.replace("category", F.lit(f"{asset_class} - "), F.lit(""))
    shares = [percent(F.col(c), d).alias(f"{c}_pct") for c, d in (("ret_1y", 2), ("ret_1y_vs_benchmark", 2), ("cagr_3y", 2), ("vol_1y", 2), ("max_drawdown_1y", 1))]
    return rows.select("scheme_name", short.alias("category"), *shares, F.round(F.col("sharpe_1y").cast("decimal(38,10)"), 2).alias("sharpe_1y"), "rank_ret_1y")


def category_medians(summary: DataFrame, plan: str = "Direct", asset_class: str = "Equity Scheme", least_funds: int = 3) -> DataFrame:
    rows = summary.filter((F.col("plan") == plan) & (F.col("asset_class") == asset_class) & (F.col("funds") >= least_funds)).orderBy(F.desc_nulls_last("median_ret_1y"))
    return rows.select(F.replace("category", F.lit(f"{asset_class} - "), F.lit("")).alias("category"), percent(F.col("median_ret_1y"), 2).alias("median_1y_pct"))


def benchmark_series(facts: DataFrame, code: int, key: str = "scheme_code") -> DataFrame:
    return facts.filter(F.col(key) == code).select(F.col("as_of_date").cast("timestamp_ntz").alias("time"), "nav").orderBy("time")


def newest_anomalies(table: DataFrame, n: int = 50, key: str = "scheme_code") -> DataFrame:
    rows = table.orderBy(F.desc("nav_date"), F.asc(key)).limit(n)
    return rows.select(F.col("nav_date").cast("string").alias("nav_date"), "scheme_name", "fund_house", "prev_nav", "nav", percent(F.col("change"), 1).alias("change_pct"))


def staging(metrics: DataFrame, registry: DataFrame, jumps: DataFrame, active_days: int = 7) -> dict[str, DataFrame]:
    """What marts are made of: cheap projections, views rather than tables."""
    return {"stg_fund_metrics": metrics, "stg_schemes": classified(registry, active_days), "stg_nav_jumps": jumps}


def from_staging(staged: dict[str, DataFrame], benchmark_code: int) -> dict[str, DataFrame]:
    """Marts that need nothing but staged rows."""
    metrics, dim = staged["stg_fund_metrics"], staged["stg_schemes"]
    return {
        "dim_scheme": dim,
        "fct_fund_metrics_monthly": monthly(metrics),
        "mart_fund_scorecard": scorecard(metrics, dim, benchmark_code),
        "mart_nav_anomalies": anomalies(staged["stg_nav_jumps"], dim),
    }


def from_scorecard(card: DataFrame) -> dict[str, DataFrame]:
    """Marts that sum up the scorecard, once it is written."""
    return {"mart_category_summary": category_summary(card), "mart_fund_house_summary": house_summary(card)}


def named_views(tables: dict[str, DataFrame]) -> None:
    """A temporary view for every table."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
