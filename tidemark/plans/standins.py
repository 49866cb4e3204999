"""The driver's tables in the shapes that the engine's operators take."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.risk import METRICS, RiskRules, snapshot_metrics
from ..sources import sinks
from . import marts

RELAXED = RiskRules(least_returns=40)
SPARSE = RiskRules(least_returns=5, lookup_gap_days=60, return_gap_days=60)
BENCHMARK = 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nav(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily series for each nation: the mean price of its customers' orders, summed exactly."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("nav_date"), F.col("o_totalprice").cast("decimal(18,2)").alias("p"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("scheme_code"))
    days = orders.join(customers, "o_custkey").groupBy("scheme_code", "nav_date")
    return days.agg((F.sum("p").cast("double") / F.count("*")).alias("nav"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry row for each nation."""
    days = nav(spark, sf_dir).groupBy("scheme_code").agg(F.min("nav_date").alias("first_nav_date"), F.max("nav_date").alias("last_nav_date"))
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    plan = F.when(F.col("n_nationkey") % 2 == 0, "Direct").otherwise("Regular")
    option = F.when(F.col("n_nationkey") % 11 == 10, "IDCW").otherwise("Growth")
    rows = nations.select(
        F.col("n_nationkey").alias("scheme_code"),
        F.concat("n_name", F.lit(" Fund - "), plan, F.lit(" Plan - "), option).alias("scheme_name"),
        F.lit("Open Ended Schemes").alias("scheme_type"),
        F.concat(F.lit("Equity Scheme - "), "r_name").alias("category"),
        F.concat(F.lit("House "), (F.col("n_nationkey") % 4).cast("string")).alias("fund_house"),
        F.lit(None).cast("string").alias("isin_growth"),
        F.lit(None).cast("string").alias("isin_reinvest"),
    )
    return rows.join(days, "scheme_code").withColumn("name_changes", F.lit(0))


def metrics(spark: SparkSession, sf_dir: str, rules: RiskRules = RELAXED) -> DataFrame:
    return snapshot_metrics(nav(spark, sf_dir), rules=rules)


def store(spark: SparkSession) -> str:
    """A new folder in the store that the session names for checkpoints, or in the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/tables-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a stored table, as stages leave it for those behind them: what reads it more than once doesn't compute it again."""
    path = store(df.sparkSession)
    sinks.write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def card(spark: SparkSession, sf_dir: str, rules: RiskRules = RELAXED, active_days: int = 60) -> DataFrame:
    return marts.scorecard(stored(metrics(spark, sf_dir, rules)), marts.classified(stored(registry(spark, sf_dir)), active_days), BENCHMARK)


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as parsed text rows, of which some break a rule each."""
    case = F.col("event_id") % 12
    text = {
        "source_file": F.lit("period=2024-01/nav_20240101_20240120.txt"),
        "scheme_code": F.when(case == 1, "12.5").otherwise(F.col("user_id").cast("string")),
        "scheme_name": F.col("event_type"),
        "nav": F.when(case == 2, "N.A.").when(case == 3, "0.0000").when(case == 4, "-1.0000").otherwise((F.col("event_id") % 97 + 1).cast("string")),
        "nav_date": F.when(case == 5, "31-Feb-2024").otherwise(F.date_format("ts", "dd-MMM-yyyy")),
        "line_no": F.col("event_id").cast("int"),
        "parse_error": F.when(case == 6, "expected 8 fields, got 7"),
    }
    return table(spark, sf_dir, "events").select(*[c.alias(k) for k, c in text.items()], *[F.lit(None).cast("string").alias(c) for c in ("isin_growth", "isin_reinvest", "scheme_type", "category", "fund_house")])


def part_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery text for each brand, with a row for every part; before some parts a section or a house line, and some rows lack a field."""
    key = F.col("p_partkey")
    section = F.when(key % 5 == 0, F.concat(F.lit("Open Ended Schemes ( "), "p_type", F.lit(" (No. "), (key % 10).cast("string"), F.lit(") )\n")))
    house = F.when(key % 3 == 0, F.concat(F.lit("  House   of "), F.col("p_size").cast("string"), F.lit(" \r\n")))
    cells = F.array(key.cast("string"), F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("  "))), F.lit(""), F.lit(""), F.when(key % 4 == 0, "-").otherwise(F.concat(F.lit("IN"), key.cast("string"))), F.lit(" "), F.col("p_size").cast("string"), F.lit("01-Sep-2026"))
    row = F.array_join(F.when(key % 7 == 0, F.slice(cells, 1, 7)).otherwise(cells), ";")
    lines = F.concat(F.coalesce(section, F.lit("")), F.coalesce(house, F.lit("")), row)
    texts = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct(key.alias("k"), lines.alias("t")))).alias("x"))
    head = F.lit("Scheme Code;NAV Name;a;b;c;d;e;f\n\n")
    return texts.select(F.col("p_brand").alias("source_file"), F.concat(head, F.array_join(F.transform("x", lambda x: x["t"]), "\n")).alias("text"))


def rounded(df: DataFrame, digits: int = 9, columns: list[str] | None = None) -> DataFrame:
    """Doubles to so many digits, as engines differ in the last."""
    names = columns or [c for c, kind in df.dtypes if kind == "double" and (c in METRICS or c.startswith(("p25", "p75", "median", "avg", "category_median", "share")) or "_vs_" in c or c.endswith("spread"))]
    return df.withColumns({c: F.round(c, digits) for c in names})


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
