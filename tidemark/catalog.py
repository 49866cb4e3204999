"""The engine's queries over the driver's tables, and the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import dates
from .functions.text import before_first, blank_to_null, squash, strip
from .operators import dedup, expectations, rules, series, versions
from .operators.risk import METRICS
from .operators.series import Series
from .plans import marts, serving, standins
from .plans.standins import BENCHMARK, card, metrics, nav, raw_rows, registry, rounded, table
from .sources import header_text, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
USERS = Series("user_id", "ts", "value")


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLES[name or f.__name__] = sql
        return f

    return add


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return card(spark, sf_dir, standins.SPARSE, 90)


# --- SQL that several queries share -------------------------------------------------------------------------------

NAV = "nav AS (SELECT c_nationkey AS scheme_code, CAST(o_orderdate AS DATE) AS nav_date, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS nav FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"
RETURNS = "ret AS (SELECT *, lag(nav_date) OVER w AS pd, CASE WHEN nav_date - lag(nav_date) OVER w <= 10 THEN ln(nav / lag(nav) OVER w) END AS r, lead(nav_date) OVER w AS nx FROM nav WINDOW w AS (PARTITION BY scheme_code ORDER BY nav_date))"
ENDS = "ends AS (SELECT scheme_code, nav_date, nav, nx IS NULL AS is_latest FROM ret WHERE nx IS NULL OR date_trunc('month', nx) <> date_trunc('month', nav_date))"


def back_sql(months: int, rows: str = "ends") -> str:
    target = f"SELECT *, CAST(nav_date - INTERVAL {months} MONTH AS DATE) AS t FROM {rows}"
    return f"b{months} AS (SELECT e.scheme_code, e.nav_date, CASE WHEN e.t - h.nav_date <= 7 THEN h.nav END AS v FROM ({target}) e ASOF LEFT JOIN nav h ON e.scheme_code = h.scheme_code AND e.t >= h.nav_date)"


TRAILING = """win AS (SELECT e.scheme_code, e.nav_date AS t, h.nav, h.r, h.pd, max(h.nav) OVER (PARTITION BY e.scheme_code, e.nav_date ORDER BY h.nav_date) AS top FROM ends e JOIN ret h ON e.scheme_code = h.scheme_code AND h.nav_date BETWEEN e.nav_date - 365 AND e.nav_date),
year AS (SELECT scheme_code, t AS nav_date, CAST(count(r) FILTER (pd >= t - 365) AS INTEGER) AS obs_1y, stddev_samp(r) FILTER (pd >= t - 365) * sqrt(252.0) AS vol, min(nav / top - 1) AS fall FROM win GROUP BY 1, 2)"""
METRICS_SQL = f"""{NAV}, {RETURNS}, {ENDS}, {back_sql(1)}, {back_sql(12)}, {back_sql(36)}, {back_sql(60)}, {TRAILING},
mraw AS (SELECT e.scheme_code, e.nav_date AS as_of_date, e.nav, e.is_latest, e.nav / b1.v - 1 AS ret_1m, e.nav / b12.v - 1 AS ret_1y, pow(e.nav / b36.v, 1.0::DOUBLE / 3) - 1 AS cagr_3y, pow(e.nav / b60.v, 1.0::DOUBLE / 5) - 1 AS cagr_5y,
CASE WHEN obs_1y >= 40 THEN vol END AS vol_1y, CASE WHEN obs_1y >= 40 THEN fall END AS max_drawdown_1y, obs_1y
FROM ends e JOIN b1 USING (scheme_code, nav_date) JOIN b12 USING (scheme_code, nav_date) JOIN b36 USING (scheme_code, nav_date) JOIN b60 USING (scheme_code, nav_date) JOIN year USING (scheme_code, nav_date)),
metrics AS (SELECT *, CASE WHEN vol_1y >= 1e-4 THEN (ret_1y - 0.065::DOUBLE) / vol_1y END AS sharpe_1y FROM mraw)"""


def r9(*columns: str) -> str:
    return ", ".join(f"round({c}, 9) AS {c}" for c in columns)


REGISTRY_SQL = """reg AS (SELECT n_nationkey AS scheme_code, n_name || ' Fund - ' || CASE WHEN n_nationkey % 2 = 0 THEN 'Direct' ELSE 'Regular' END || ' Plan - ' || CASE WHEN n_nationkey % 11 = 10 THEN 'IDCW' ELSE 'Growth' END AS scheme_name,
'Open Ended Schemes' AS scheme_type, 'Equity Scheme - ' || r_name AS category, 'House ' || CAST(n_nationkey % 4 AS VARCHAR) AS fund_house, first_nav_date, last_nav_date
FROM nation JOIN region ON n_regionkey = r_regionkey JOIN (SELECT scheme_code, min(nav_date) AS first_nav_date, max(nav_date) AS last_nav_date FROM nav GROUP BY 1) d ON d.scheme_code = n_nationkey),
dim AS (SELECT *, nullif(trim(split_part(category, ' - ', 1)), '') AS asset_class, CASE WHEN scheme_name ILIKE '%direct%' THEN 'Direct' ELSE 'Regular' END AS plan,
CASE WHEN scheme_name ILIKE '%idcw%' OR scheme_name ILIKE '%dividend%' THEN 'IDCW' WHEN scheme_name ILIKE '%bonus%' THEN 'Bonus' WHEN scheme_name ILIKE '%growth%' THEN 'Growth' ELSE 'Other' END AS option_type,
last_nav_date >= (SELECT max(last_nav_date) FROM reg) - 60 AS is_active FROM reg)"""
CARD_SQL = f"""{METRICS_SQL}, {REGISTRY_SQL},
latest AS (SELECT m.*, scheme_name, fund_house, category, asset_class, plan FROM metrics m JOIN dim USING (scheme_code) WHERE is_latest AND is_active AND option_type = 'Growth'),
bench AS (SELECT ret_1y AS b1y, cagr_3y AS b3y, cagr_5y AS b5y FROM metrics WHERE scheme_code = {BENCHMARK} AND is_latest),
stats AS (SELECT category, plan, count(*) AS funds_in_category, quantile_cont(ret_1y, 0.5) AS category_median_ret_1y, quantile_cont(cagr_3y, 0.5) AS category_median_cagr_3y FROM latest GROUP BY 1, 2),
card AS (SELECT l.scheme_code, scheme_name, fund_house, category, asset_class, plan, as_of_date, nav, ret_1m, ret_1y, cagr_3y, cagr_5y, vol_1y, max_drawdown_1y, sharpe_1y, funds_in_category, category_median_ret_1y, category_median_cagr_3y,
ret_1y - category_median_ret_1y AS ret_1y_vs_category, ret_1y - b1y AS ret_1y_vs_benchmark, cagr_3y - b3y AS cagr_3y_vs_benchmark, cagr_5y - b5y AS cagr_5y_vs_benchmark,
CAST(rank() OVER (PARTITION BY category, plan ORDER BY ret_1y DESC NULLS LAST) AS INTEGER) AS rank_ret_1y, CAST(rank() OVER (PARTITION BY category, plan ORDER BY cagr_3y DESC NULLS LAST) AS INTEGER) AS rank_cagr_3y, CAST(rank() OVER (PARTITION BY category, plan ORDER BY sharpe_1y DESC NULLS LAST) AS INTEGER) AS rank_sharpe_1y
FROM latest l JOIN stats USING (category, plan) LEFT JOIN bench ON true)"""
CARD_NUMBERS = [*METRICS, "category_median_ret_1y", "category_median_cagr_3y", "ret_1y_vs_category", "ret_1y_vs_benchmark", "cagr_3y_vs_benchmark", "cagr_5y_vs_benchmark"]
CARD_OUT = f"SELECT * REPLACE ({r9(*CARD_NUMBERS)}) FROM"
SUMMARY_SQL = """summary AS (SELECT category, asset_class, plan, count(*) AS funds, quantile_cont(ret_1y, 0.25) AS p25_ret_1y, quantile_cont(ret_1y, 0.5) AS median_ret_1y, quantile_cont(ret_1y, 0.75) AS p75_ret_1y,
quantile_cont(ret_1y, 0.75) - quantile_cont(ret_1y, 0.25) AS ret_1y_spread, quantile_cont(cagr_3y, 0.5) AS median_cagr_3y, quantile_cont(cagr_5y, 0.5) AS median_cagr_5y, avg(vol_1y) AS avg_vol_1y, avg(max_drawdown_1y) AS avg_max_drawdown_1y, max(as_of_date) AS as_of_date FROM card GROUP BY 1, 2, 3)"""
SUMMARY_NUMBERS = ["p25_ret_1y", "median_ret_1y", "p75_ret_1y", "ret_1y_spread", "median_cagr_3y", "median_cagr_5y", "avg_vol_1y", "avg_max_drawdown_1y"]
JUMPS = "j AS (SELECT scheme_code, lag(nav_date) OVER w AS prev_nav_date, lag(nav) OVER w AS prev_nav, nav_date, nav, nav / lag(nav) OVER w - 1 AS change FROM nav WINDOW w AS (PARTITION BY scheme_code ORDER BY nav_date)), jumps AS (SELECT * FROM j WHERE abs(change) > 0.5)"
RAW = """raw AS (SELECT event_id, user_id, event_type, CASE event_id % 12 WHEN 1 THEN '12.5' ELSE CAST(user_id AS VARCHAR) END AS scheme_code, CASE event_id % 12 WHEN 2 THEN 'N.A.' WHEN 3 THEN '0.0000' WHEN 4 THEN '-1.0000' ELSE CAST(event_id % 97 + 1 AS VARCHAR) END AS nav,
CASE event_id % 12 WHEN 5 THEN '31-Feb-2024' ELSE strftime(ts, '%d-%b-%Y') END AS nav_date, CAST(event_id AS INTEGER) AS line_no, event_id % 12 = 6 AS malformed FROM events),
typed AS (SELECT *, CASE WHEN regexp_full_match(trim(scheme_code), '[+-]?[0-9]+') THEN TRY_CAST(scheme_code AS INTEGER) END AS code, TRY_CAST(nav AS DECIMAL(20,6)) AS value, CASE WHEN regexp_full_match(nav_date, '[0-9]{2}-[A-Za-z]{3}-[0-9]{4}') THEN CAST(try_strptime(nav_date, '%d-%b-%Y') AS DATE) END AS day FROM raw),
tagged AS (SELECT *, CASE WHEN malformed THEN 'malformed_line' WHEN code IS NULL THEN 'bad_scheme_code' WHEN value IS NULL THEN 'non_numeric_nav' WHEN value = 0 THEN 'zero_nav' WHEN value < 0 THEN 'negative_nav' WHEN day IS NULL THEN 'bad_date' WHEN day < DATE '2024-01-01' OR day > DATE '2024-01-20' THEN 'date_outside_requested_window' END AS quarantine_reason FROM typed)"""


def tagged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.tagged(rules.typed(raw_rows(spark, sf_dir)), rules.value_rules())


# --- deliveries: typing, rules, gates, overlaps -------------------------------------------------------------------


@query(f"WITH {RAW} SELECT line_no, scheme_code, nav, nav_date, quarantine_reason FROM tagged")
def quarantine_tag(spark, sf_dir):
    return tagged_rows(spark, sf_dir).select("line_no", "scheme_code", "nav", "nav_date", "quarantine_reason")


@query(f"WITH {RAW} SELECT quarantine_reason, count(*) AS rows FROM tagged GROUP BY 1")
def quarantine_counts(spark, sf_dir):
    return rules.reason_counts(tagged_rows(spark, sf_dir))


@query(f"WITH {RAW} SELECT count(*) AS input_rows, count(quarantine_reason) AS quarantined_rows, count(*) FILTER (quarantine_reason <> 'zero_nav') AS unexpected_rows, count(*) FILTER (quarantine_reason <> 'zero_nav') / CAST(count(*) AS DOUBLE) AS ratio FROM tagged")
def quarantine_ratio(spark, sf_dir):
    return rules.unexpected_ratio(tagged_rows(spark, sf_dir), rules.value_rules())


@query(f"WITH {RAW} SELECT line_no, code AS scheme_code, day AS nav_date, CAST(value AS DOUBLE) AS nav FROM tagged WHERE quarantine_reason IS NULL")
def valid_rows(spark, sf_dir):
    valid, _ = rules.divided(tagged_rows(spark, sf_dir))
    return valid.select("line_no", F.col("scheme_code_int").alias("scheme_code"), F.col("nav_dt").alias("nav_date"), F.col("nav_value").cast("double").alias("nav"))


@query(f"WITH {RAW} SELECT code AS scheme_code, day AS nav_date, CAST(value AS DOUBLE) AS nav, event_type AS scheme_name, strftime(day, '%Y-%m') AS period FROM tagged WHERE quarantine_reason IS NULL QUALIFY row_number() OVER (PARTITION BY code, day ORDER BY line_no DESC) = 1")
def daily_table(spark, sf_dir):
    from .plans.jobs import clean_table

    valid, _ = rules.divided(tagged_rows(spark, sf_dir))
    return clean_table(valid).select("scheme_code", "nav_date", F.col("nav").cast("double").alias("nav"), "scheme_name", "period")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1")
def dedup_newest(spark, sf_dir):
    newest = [F.desc_nulls_last("l_shipdate"), F.desc("l_partkey"), F.desc("l_suppkey"), F.desc("l_extendedprice")]
    lines = dedup.keep_newest(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], newest)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", F.col("l_shipdate").cast("date").alias("l_shipdate"))


@query("SELECT l_orderkey, l_linenumber, count(DISTINCT l_extendedprice) AS versions FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_extendedprice) > 1")
def conflicting_keys(spark, sf_dir):
    return dedup.conflicting_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_extendedprice")


@query("SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS rows FROM orders GROUP BY 1")
def month_period_counts(spark, sf_dir):
    return dates.period_counts(table(spark, sf_dir, "orders"), "o_orderdate")


# --- text ---------------------------------------------------------------------------------------------------------

PARTS = r"""p AS (SELECT *, row_number() OVER w AS k, CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS is_section, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS is_house,
p_type || ' (No. ' || CAST(p_partkey % 10 AS VARCHAR) || ')' AS sect FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_partkey)),
n AS (SELECT *, CAST(2 + k + sum(is_section + is_house) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS INTEGER) AS line_no,
last_value(CASE WHEN is_section = 1 THEN sect END IGNORE NULLS) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS category,
last_value(CASE WHEN is_house = 1 THEN 'House of ' || CAST(p_size AS VARCHAR) WHEN is_section = 1 THEN '' END IGNORE NULLS) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS house FROM p)"""
PART_NAME = "regexp_replace(trim(p_name), '\\s+', ' ', 'g')"


@query(f"""WITH {PARTS} SELECT p_brand AS source_file, CAST(p_partkey AS VARCHAR) AS scheme_code,
CASE WHEN p_partkey % 7 = 0 THEN CAST(p_partkey AS VARCHAR) || '; ' || replace(p_name, ' ', '  ') || ';;;' || CASE WHEN p_partkey % 4 = 0 THEN '-' ELSE 'IN' || CAST(p_partkey AS VARCHAR) END || '; ;' || CAST(p_size AS VARCHAR) ELSE {PART_NAME} END AS scheme_name,
CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 4 <> 0 THEN 'IN' || CAST(p_partkey AS VARCHAR) END AS isin_growth, CAST(NULL AS VARCHAR) AS isin_reinvest, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS nav, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE '01-Sep-2026' END AS nav_date,
CASE WHEN category IS NOT NULL THEN 'Open Ended Schemes' END AS scheme_type, category, nullif(house, '') AS fund_house, line_no, CASE WHEN p_partkey % 7 = 0 THEN 'expected 8 fields, got 7' END AS parse_error FROM n""")
def parse_text(spark, sf_dir):
    return header_text.parse(standins.part_files(spark, sf_dir))


@query(f"WITH {PARTS} SELECT p_brand AS source_file, count(*) AS rows FROM n GROUP BY 1")
def delivery_lines(spark, sf_dir):
    return header_text.data_lines(standins.part_files(spark, sf_dir))


@query("""WITH m AS (SELECT conv_id, turn, role, text, CASE WHEN role = 'user' THEN 1 ELSE 0 END AS u FROM conversations),
g AS (SELECT *, sum(u) OVER (PARTITION BY conv_id ORDER BY turn) AS grp FROM m)
SELECT conv_id, turn, role, max(CASE WHEN u = 1 THEN length(text) END) OVER (PARTITION BY conv_id, grp) AS question_chars FROM g""")
def header_forward_fill(spark, sf_dir):
    order = Window.partitionBy("conv_id").orderBy("turn")
    asked = series.carried(F.when(F.col("role") == "user", F.length("text")), order)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", asked.cast("bigint").alias("question_chars"))


@query("""WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS line_no, unnest(ls) AS line FROM d),
k AS (SELECT *, CASE WHEN length(line) % 7 = 0 THEN 'section' WHEN length(line) % 7 = 3 THEN 'house' END AS kind FROM l),
p AS (SELECT *, max(CASE WHEN kind IS NOT NULL THEN line_no END) OVER (PARTITION BY doc_id ORDER BY line_no) AS src FROM k)
SELECT p.doc_id, p.line_no, CASE WHEN s.kind = 'house' THEN length(s.line) END AS house_chars FROM p LEFT JOIN k s ON s.doc_id = p.doc_id AND s.line_no = p.src""")
def header_reset_fill(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    kind = F.length("line") % 7
    mark = F.when(kind == 0, F.struct(F.lit(None).cast("int").alias("n"))).when(kind == 3, F.struct(F.length("line").alias("n")))
    order = Window.partitionBy("doc_id").orderBy("at")
    return lines.select("doc_id", (F.col("at") + 1).cast("bigint").alias("line_no"), series.carried(mark, order)["n"].cast("bigint").alias("house_chars"))


@query("SELECT p_partkey, regexp_replace(trim(p_name), '\\s+', ' ', 'g') AS squashed, nullif(trim(split_part(p_type, ' ', 1)), '') AS first_word, CASE WHEN trim(p_brand) NOT IN ('', '-') THEN trim(p_brand) END AS brand, replace(p_type, ' ', '_') AS joined FROM part")
def text_functions(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", squash(strip(F.col("p_name"))).alias("squashed"), before_first(F.col("p_type"), " ").alias("first_word"), blank_to_null(F.col("p_brand"), "-").alias("brand"), F.replace("p_type", F.lit(" "), F.lit("_")).alias("joined"))


# --- series -------------------------------------------------------------------------------------------------------


@query("WITH j AS (SELECT user_id, lag(ts) OVER w AS prev_ts, lag(value) OVER w AS prev_value, ts, value, value / nullif(lag(value) OVER w, 0) - 1 AS change FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)) SELECT user_id, CAST(prev_ts AS VARCHAR) AS prev_ts, prev_value, CAST(ts AS VARCHAR) AS ts, value, change FROM j WHERE abs(change) > 0.5")
def price_jumps(spark, sf_dir):
    found = series.jumps(table(spark, sf_dir, "events"), USERS)
    return found.withColumns({"prev_ts": F.col("prev_ts").cast("string"), "ts": F.col("ts").cast("string")})


@query(f"WITH {NAV}, {RETURNS} SELECT scheme_code, nav_date, pd AS prev_day, round(r, 12) AS log_return FROM ret")
def daily_returns(spark, sf_dir):
    return series.daily_returns(nav(spark, sf_dir)).select("scheme_code", "nav_date", "prev_day", F.round("log_return", 12).alias("log_return"))


@query(f"WITH {NAV}, {RETURNS}, {ENDS} SELECT scheme_code, nav_date, nav, is_latest FROM ends")
def period_end_rows(spark, sf_dir):
    return series.period_ends(nav(spark, sf_dir)).select("scheme_code", "nav_date", "nav", "is_latest")


def _lookback(months: int, label: str) -> None:
    @query(f"WITH {NAV}, {back_sql(months, 'nav')} SELECT scheme_code, nav_date, v AS earlier FROM b{months}", f"lookback_{label}")
    def run(spark, sf_dir):
        return nav(spark, sf_dir).select("scheme_code", "nav_date", series.lookback(months).alias("earlier"))


for _months, _label in ((1, "1m"), (12, "1y"), (36, "3y"), (60, "5y")):
    _lookback(_months, _label)


def _metric(name: str, *columns: str) -> None:
    @query(f"WITH {METRICS_SQL} SELECT scheme_code, as_of_date, {', '.join(f'round({c}, 9) AS {c}' if c in METRICS else c for c in columns)} FROM metrics", name)
    def run(spark, sf_dir):
        return rounded(metrics(spark, sf_dir).select("scheme_code", "as_of_date", *columns))


_metric("trailing_volatility", "vol_1y")
_metric("trailing_drawdown", "max_drawdown_1y")
_metric("trailing_obs", "obs_1y")
_metric("sharpe", "sharpe_1y", "ret_1y", "vol_1y")
_metric("snapshot_metrics", "nav", "is_latest", *METRICS, "obs_1y")


# --- versions and registry ----------------------------------------------------------------------------------------

VERSIONS = "v AS (SELECT user_id, event_type, min(CAST(ts AS DATE)) AS first_seen, max(CAST(ts AS DATE)) AS last_seen, count(*) AS nav_rows FROM events GROUP BY 1, 2)"


def event_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").cast("date").alias("day"))
    return versions.attribute_versions(days, "user_id", ["event_type"], "day")


@query(f"WITH {VERSIONS} SELECT * FROM v")
def attribute_versions(spark, sf_dir):
    return event_versions(spark, sf_dir)


@query(f"WITH {VERSIONS} SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY first_seen, last_seen, event_type) - 1 AS INTEGER) AS place, event_type, first_seen, last_seen, nav_rows, first_value(event_type) OVER (PARTITION BY user_id ORDER BY last_seen DESC, first_seen DESC, event_type DESC) AS current_type, CAST(count(*) OVER (PARTITION BY user_id) - 1 AS INTEGER) AS name_changes FROM v")
def registry_docs(spark, sf_dir):
    docs = versions.registry_documents(event_versions(spark, sf_dir), "user_id", ["event_type"])
    entries = docs.select("user_id", "current", "name_changes", F.posexplode("history").alias("place", "h"))
    return entries.select("user_id", "place", "h.*", F.col("current.event_type").alias("current_type"), "name_changes")


@query(f"WITH {VERSIONS} SELECT user_id, arg_max(event_type, (last_seen, first_seen, event_type)) AS event_type, min(first_seen) AS first_nav_date, max(last_seen) AS last_nav_date, CAST(count(DISTINCT event_type) - 1 AS INTEGER) AS name_changes FROM v GROUP BY 1")
def registry_flat(spark, sf_dir):
    docs = versions.registry_documents(event_versions(spark, sf_dir), "user_id", ["event_type"])
    return versions.registry_rows(docs, "user_id")


# --- marts --------------------------------------------------------------------------------------------------------


@query("SELECT p_partkey, CASE WHEN p_name ILIKE '%direct%' THEN 'Direct' ELSE 'Regular' END AS plan, CASE WHEN p_type ILIKE '%idcw%' OR p_type ILIKE '%dividend%' THEN 'IDCW' WHEN p_type ILIKE '%bonus%' THEN 'Bonus' WHEN p_type ILIKE '%growth%' THEN 'Growth' ELSE 'Other' END AS option_type, nullif(trim(split_part(p_type, ' - ', 1)), '') AS asset_class FROM part")
def scheme_classify(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", marts.plan_of(F.col("p_name")).alias("plan"), marts.option_of(F.col("p_type")).alias("option_type"), before_first(F.col("p_type"), " - ").alias("asset_class"))


@query(f"WITH {NAV}, {REGISTRY_SQL} SELECT scheme_code, scheme_name, category, fund_house, asset_class, plan, option_type, first_nav_date, last_nav_date, is_active FROM dim")
def dim_scheme(spark, sf_dir):
    return marts.classified(registry(spark, sf_dir), 60).drop("scheme_type", "isin_growth", "isin_reinvest", "name_changes")


@query("WITH c AS (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders GROUP BY 1) SELECT o_custkey, last_day, last_day >= (SELECT max(last_day) FROM c) - 7 AS is_active FROM c")
def active_flag(spark, sf_dir):
    last = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max(F.col("o_orderdate").cast("date")).alias("last_day"))
    return marts.with_active(last, "last_day", 7)


@query(f"WITH {CARD_SQL} {CARD_OUT} card")
def scorecard(spark, sf_dir):
    return rounded(card(spark, sf_dir))


@query(f"WITH {CARD_SQL}, {SUMMARY_SQL} SELECT * REPLACE ({r9(*SUMMARY_NUMBERS)}) FROM summary")
def category_summary(spark, sf_dir):
    return rounded(marts.category_summary(card(spark, sf_dir)), columns=SUMMARY_NUMBERS)


@query(f"WITH {CARD_SQL} SELECT fund_house, count(*) AS growth_schemes, count(*) FILTER (plan = 'Direct') AS direct_schemes, count(DISTINCT category) AS categories, round(avg(CASE WHEN ret_1y_vs_category > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FILTER (ret_1y IS NOT NULL), 9) AS share_beating_category_1y, round(quantile_cont(ret_1y_vs_category, 0.5), 9) AS median_ret_1y_vs_category FROM card GROUP BY 1")
def house_summary(spark, sf_dir):
    return rounded(marts.house_summary(card(spark, sf_dir)), columns=["share_beating_category_1y", "median_ret_1y_vs_category"])


@query(f"WITH {METRICS_SQL} SELECT scheme_code, CAST(date_trunc('month', as_of_date) AS DATE) AS month, as_of_date, is_latest AS is_month_to_date, nav, {r9(*METRICS)} FROM metrics")
def monthly_fact(spark, sf_dir):
    return rounded(marts.monthly(metrics(spark, sf_dir)))


@query(f"WITH {NAV}, {JUMPS}, {REGISTRY_SQL} SELECT scheme_code, scheme_name, fund_house, category, prev_nav_date, prev_nav, nav_date, jumps.nav, change FROM jumps LEFT JOIN (SELECT * FROM dim WHERE scheme_code % 3 <> 0) x USING (scheme_code)")
def anomalies_with_context(spark, sf_dir):
    known = marts.classified(registry(spark, sf_dir), 60).filter(F.col("scheme_code") % 3 != 0)
    return marts.anomalies(series.jumps(nav(spark, sf_dir)), known)


# --- serving ------------------------------------------------------------------------------------------------------


def _funds(name: str, where: str, sort_by: str, limit: int, **filters) -> None:
    @query(f"WITH {CARD_SQL} {CARD_OUT} (SELECT * FROM card WHERE {where} ORDER BY {sort_by} DESC NULLS LAST, scheme_code LIMIT {limit})", name)
    def run(spark, sf_dir):
        return rounded(serving.list_funds(card(spark, sf_dir), sort_by=sort_by, limit=limit, **filters))


_funds("list_topk", "true", "ret_1y", 5)
_funds("list_topk_plan", "plan = 'Direct'", "cagr_3y", 4, plan="Direct")
_funds("list_topk_category_house", "category = 'Equity Scheme - ASIA' AND fund_house = 'House 0'", "sharpe_1y", 20, category="Equity Scheme - ASIA", fund_house="House 0")


@query(f"WITH {METRICS_SQL} SELECT CAST(date_trunc('month', as_of_date) AS DATE) AS month, as_of_date, nav, {r9('ret_1m', 'ret_1y', 'cagr_3y', 'vol_1y', 'max_drawdown_1y', 'sharpe_1y')} FROM metrics WHERE scheme_code = 3 ORDER BY 1 DESC LIMIT 24")
def history(spark, sf_dir):
    return rounded(serving.history(marts.monthly(metrics(spark, sf_dir)), 3, 24))


@query(f"WITH {CARD_SQL}, {SUMMARY_SQL} SELECT * REPLACE ({r9(*SUMMARY_NUMBERS)}) FROM summary ORDER BY asset_class, category, plan")
def categories(spark, sf_dir):
    return rounded(serving.categories(marts.category_summary(card(spark, sf_dir))), columns=SUMMARY_NUMBERS)


@query(f"WITH {CARD_SQL} SELECT r.scheme_code, r.scheme_name AS registry_name, c.fund_house AS card_house, round(c.ret_1y, 9) AS ret_1y FROM reg r LEFT JOIN card c USING (scheme_code) WHERE r.scheme_code = 10")
def fund_detail(spark, sf_dir):
    found = serving.fund_detail(card(spark, sf_dir), registry(spark, sf_dir), 10)
    return found.select("scheme_code", F.col("registry.scheme_name").alias("registry_name"), F.col("scorecard.fund_house").alias("card_house"), F.round("scorecard.ret_1y", 9).alias("ret_1y"))


# --- dashboards ---------------------------------------------------------------------------------------------------


def pct_sql(column: str, digits: int, name: str | None = None) -> str:
    return f"CAST(round(CAST({column} * 100 AS DECIMAL(38,10)), {digits}) AS DOUBLE) AS {name or column + '_pct'}"


def as_doubles(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c, kind in df.dtypes if kind.startswith("decimal")})


@query(f"WITH {CARD_SQL} SELECT scheme_name, replace(category, 'Equity Scheme - ', '') AS category, {pct_sql('ret_1y', 2)}, {pct_sql('ret_1y_vs_benchmark', 2)}, {pct_sql('cagr_3y', 2)}, {pct_sql('vol_1y', 2)}, {pct_sql('max_drawdown_1y', 1)}, CAST(round(CAST(sharpe_1y AS DECIMAL(38,10)), 2) AS DOUBLE) AS sharpe_1y, rank_ret_1y FROM (SELECT * FROM card WHERE plan = 'Direct' AND asset_class = 'Equity Scheme' AND ret_1y IS NOT NULL ORDER BY card.ret_1y DESC, scheme_code LIMIT 15)")
def dashboard_top15(spark, sf_dir):
    return as_doubles(marts.top_funds(card(spark, sf_dir)))


@query(f"WITH {CARD_SQL}, {SUMMARY_SQL} SELECT replace(category, 'Equity Scheme - ', '') AS category, {pct_sql('median_ret_1y', 2, 'median_1y_pct')} FROM summary WHERE plan = 'Direct' AND asset_class = 'Equity Scheme' AND funds >= 2 ORDER BY median_ret_1y DESC")
def dashboard_category(spark, sf_dir):
    return as_doubles(marts.category_medians(marts.category_summary(card(spark, sf_dir)), least_funds=2))


@query(f"WITH {METRICS_SQL} SELECT CAST(as_of_date AS TIMESTAMP) AS time, nav FROM metrics WHERE scheme_code = {BENCHMARK} ORDER BY 1")
def dashboard_benchmark(spark, sf_dir):
    return marts.benchmark_series(marts.monthly(metrics(spark, sf_dir)), BENCHMARK)


@query(f"WITH {NAV}, {JUMPS}, {REGISTRY_SQL} SELECT CAST(nav_date AS VARCHAR) AS nav_date, scheme_name, fund_house, prev_nav, nav, {pct_sql('change', 1)} FROM (SELECT * FROM jumps LEFT JOIN dim USING (scheme_code) ORDER BY nav_date DESC, scheme_code LIMIT 50)")
def dashboard_anomalies(spark, sf_dir):
    found = marts.anomalies(series.jumps(nav(spark, sf_dir)), marts.classified(registry(spark, sf_dir), 60))
    return as_doubles(marts.newest_anomalies(found))


# --- expectations -------------------------------------------------------------------------------------------------


@query("SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def expect_unique(spark, sf_dir):
    return expectations.unique(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def expect_combination(spark, sf_dir):
    return expectations.unique(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query(f"WITH {METRICS_SQL} SELECT scheme_code, as_of_date FROM metrics WHERE vol_1y IS NULL")
def expect_not_null(spark, sf_dir):
    return expectations.not_null(metrics(spark, sf_dir), "vol_1y").select("scheme_code", "as_of_date")


@query("SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1")
def expect_accepted(spark, sf_dir):
    return expectations.accepted(table(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0)")
def expect_relationships(spark, sf_dir):
    some = table(spark, sf_dir, "customer").filter("c_custkey % 5 <> 0")
    return expectations.related(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", some, "c_custkey")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def expect_sign(spark, sf_dir):
    return expectations.non_negative(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_acctbal")


@query(f"WITH {METRICS_SQL} SELECT scheme_code, as_of_date, round(ret_1m, 9) AS ret_1m FROM metrics WHERE ret_1m > 0")
def expect_non_positive(spark, sf_dir):
    return rounded(expectations.non_positive(metrics(spark, sf_dir).select("scheme_code", "as_of_date", "ret_1m"), "ret_1m"))


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0")
def expect_no_credit(spark, sf_dir):
    return expectations.non_positive(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_acctbal")


@query("SELECT l_orderkey AS scheme_code, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 HAVING count(*) <> 1")
def expect_one_latest(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("scheme_code"), (F.col("l_returnflag") == "R").alias("is_latest"))
    return expectations.one_latest(rows)


@query(f"WITH {METRICS_SQL} SELECT scheme_code, as_of_date, ret_1m FROM metrics WHERE ret_1m < -0.3 OR ret_1m > 0.5")
def expect_implausible(spark, sf_dir):
    return expectations.implausible(metrics(spark, sf_dir).select("scheme_code", "as_of_date", "ret_1m"), "ret_1m", -0.3, 0.5)


# --- windows, gates, sinks ----------------------------------------------------------------------------------------

SPAN = (date(2023, 11, 17), date(2026, 2, 3))


@query("SELECT greatest(DATE '2023-11-17', CAST(p AS DATE)) AS window_start, least(DATE '2026-02-03', last_day(CAST(p AS DATE))) AS window_end FROM (SELECT unnest(generate_series(TIMESTAMP '2023-11-01', TIMESTAMP '2026-02-03', INTERVAL 1 MONTH)) AS p)")
def month_windows(spark, sf_dir):
    return dates.month_windows(spark, *SPAN)


@query("SELECT greatest(DATE '2023-11-17', make_date(y, 1, 1)) AS window_start, least(DATE '2026-02-03', make_date(y, 12, 31)) AS window_end FROM (SELECT CAST(unnest(range(2023, 2027)) AS INTEGER) AS y)")
def year_chunks(spark, sf_dir):
    return dates.year_chunks(spark, *SPAN)


@query(f"WITH {NAV} SELECT max(nav_date) AS newest, CAST(DATE '2001-08-10' - max(nav_date) AS INTEGER) AS days_old, CAST(epoch(max(nav_date)) AS BIGINT) AS newest_epoch, count(DISTINCT scheme_code) AS schemes FROM nav")
def freshness_lag(spark, sf_dir):
    return rules.freshness(nav(spark, sf_dir), date(2001, 8, 10))


@query(f"WITH {METRICS_SQL}, {JUMPS} SELECT 'metrics' AS name, count(*) AS rows FROM metrics UNION ALL SELECT 'latest', count(*) FROM metrics WHERE is_latest UNION ALL SELECT 'jumps', count(*) FROM jumps")
def summary_counts(spark, sf_dir):
    found = metrics(spark, sf_dir)
    parts = {"metrics": found, "latest": found.filter("is_latest"), "jumps": series.jumps(nav(spark, sf_dir))}
    return standins.union_all([sinks.row_count(df).withColumn("name", F.lit(name)) for name, df in parts.items()])


@query("SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y') AS period FROM orders WHERE NOT (strftime(o_orderdate, '%Y') = '1996' AND o_orderstatus <> 'F')")
def partition_overwrite_roundtrip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy").alias("period"))
    path = standins.store(spark)
    sinks.write_periods(orders, path)
    sinks.write_periods(orders.filter("period = '1996' AND o_orderstatus = 'F'"), path)
    return spark.read.schema(orders.schema).parquet(path)


@query("WITH n AS (SELECT 2 * c_custkey AS c_custkey, c_acctbal + 1 AS c_acctbal FROM customer) SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM n) UNION ALL SELECT * FROM n")
def upsert_snapshot(spark, sf_dir):
    """All customers, and as changes all of them under twice their key: some keys are replaced, the others new."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return sinks.upserted(rows, rows.select((2 * F.col("c_custkey")).alias("c_custkey"), (F.col("c_acctbal") + 1).alias("c_acctbal")), "c_custkey")


@query(f"WITH {CARD_SQL} {CARD_OUT} (SELECT * FROM card WHERE plan = 'Regular' AND ret_1y >= 0.0 ORDER BY ret_1y DESC NULLS LAST, scheme_code LIMIT 7)")
def parametrised_sql(spark, sf_dir):
    rounded(card(spark, sf_dir)).createOrReplaceTempView("mart_fund_scorecard_now")
    text = "SELECT * FROM mart_fund_scorecard_now WHERE plan = :plan AND ret_1y >= :least ORDER BY ret_1y DESC NULLS LAST, scheme_code LIMIT :n"
    return spark.sql(text, args={"plan": "Regular", "least": 0.0, "n": 7})


@query(f"WITH {NAV} SELECT scheme_code, count(*) AS days, max(nav) AS top FROM nav GROUP BY 1")
def swap_snapshot(spark, sf_dir):
    sinks.swap_in(nav(spark, sf_dir), standins.store(spark), "nav_snapshot")
    return spark.sql("SELECT scheme_code, count(*) AS days, max(nav) AS top FROM nav_snapshot GROUP BY scheme_code")

