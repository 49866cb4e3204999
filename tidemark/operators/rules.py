"""Validation: typed columns, the first rule that a row breaks, and gates on what was broken."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import epoch_seconds


@dataclass(frozen=True)
class Rule:
    """A reason and the condition under which a row is tagged with it. Expected reasons don't count against the gate."""

    reason: str
    broken: Column
    expected: bool = False


class GateError(ValueError):
    """A batch that must not go on."""


def typed(rows: DataFrame, window_pattern: str = r"_(\d{8})_(\d{8})") -> DataFrame:
    """Adds the window that the file name states and typed key, value and date; what can't be read is null."""
    bounds = {f"source_{k}": F.try_to_date(F.regexp_extract("source_file", window_pattern, i), "yyyyMMdd") for i, k in ((1, "start"), (2, "end"))}
    return rows.withColumns(
        bounds
        | {
            "scheme_code_int": F.col("scheme_code").try_cast("int"),
            "nav_value": F.col("nav").try_cast("decimal(20,6)"),
            "nav_dt": F.try_to_date("nav_date", "dd-MMM-yyyy"),
        }
    )


def value_rules() -> list[Rule]:
    """The rules of typed rows, in the order in which they are tried."""
    value, day = F.col("nav_value"), F.col("nav_dt")
    return [
        Rule("malformed_line", F.col("parse_error").isNotNull()),
        Rule("bad_scheme_code", F.col("scheme_code_int").isNull()),
        Rule("non_numeric_nav", value.isNull()),
        Rule("zero_nav", value == 0, expected=True),
        Rule("negative_nav", value < 0),
        Rule("bad_date", day.isNull()),
        Rule("date_outside_requested_window", (day < F.col("source_start")) | (day > F.col("source_end"))),
    ]


def tagged(df: DataFrame, rules: list[Rule], into: str = "quarantine_reason") -> DataFrame:
    """The first broken rule's reason, or null. A condition that is null isn't broken."""
    reason = F.lit(None).cast("string")
    for rule in reversed(rules):
        reason = F.when(rule.broken, rule.reason).otherwise(reason)
    return df.withColumn(into, reason)


def divided(df: DataFrame, by: str = "quarantine_reason") -> tuple[DataFrame, DataFrame]:
    """Rows without and with a reason."""
    return df.filter(F.col(by).isNull()), df.filter(F.col(by).isNotNull())


def reason_counts(df: DataFrame, by: str = "quarantine_reason") -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("rows"))


def unexpected_ratio(df: DataFrame, rules: list[Rule], by: str = "quarantine_reason") -> DataFrame:
    """One row: input_rows, quarantined_rows, unexpected_rows and their ratio (0 without input)."""
    expected = [r.reason for r in rules if r.expected]
    bad = F.col(by).isNotNull()
    odd = bad & ~F.col(by).isin(expected) if expected else bad
    counts = df.agg(F.count("*").alias("input_rows"), F.count_if(bad).alias("quarantined_rows"), F.count_if(odd).alias("unexpected_rows"))
    return counts.withColumn("ratio", F.coalesce(F.try_divide(F.col("unexpected_rows").cast("double"), F.col("input_rows")), F.lit(0.0)))


def ratio_gate(ratio: float, most: float = 0.02) -> float:
    if ratio > most:
        raise GateError(f"{ratio:.2%} of the rows are quarantined unexpectedly; at most {most:.2%} may be")
    return ratio


def freshness(df: DataFrame, today: date, key: str = "scheme_code", day: str = "nav_date") -> DataFrame:
    """One row: the newest day, how many days it lies back, its epoch seconds, and how many keys there are."""
    newest = df.agg(F.max(day).alias("newest"), F.count_distinct(key).alias("schemes"))
    return newest.select("newest", F.datediff(F.lit(today), "newest").alias("days_old"), epoch_seconds(F.col("newest")).alias("newest_epoch"), "schemes")


def freshness_gate(newest: date | None, today: date, most_days: int = 5) -> None:
    if newest is None or (today - newest).days > most_days:
        raise GateError(f"the newest row is of {newest}; on {today} it may be {most_days} days old")
