import math
from datetime import date, timedelta

import numpy as np
import pytest
from tidemark.operators import expectations, series, versions
from tidemark.operators.risk import RiskRules, snapshot_metrics

SCHEMA = "scheme_code int, nav_date date, nav double"


def business_days(start, end):
    return [start + timedelta(k) for k in range((end - start).days + 1) if (start + timedelta(k)).weekday() < 5]


def growing(start, end, daily=0.0, code=1, first=10.0):
    return [(code, d, first * (1 + daily) ** k) for k, d in enumerate(business_days(start, end))]


def metrics(spark, rows, **rules):
    out = snapshot_metrics(spark.createDataFrame(rows, SCHEMA).repartition(3), rules=RiskRules(**rules))
    return out.orderBy("scheme_code", "as_of_date").collect()


def test_month_ends_and_the_latest_day(spark):
    rows = metrics(spark, growing(date(2024, 1, 1), date(2024, 3, 15)))
    assert [(r.as_of_date, r.is_latest) for r in rows] == [(date(2024, 1, 31), False), (date(2024, 2, 29), False), (date(2024, 3, 15), True)]


def test_steady_growth(spark):
    last = metrics(spark, growing(date(2019, 1, 1), date(2025, 6, 30), 1.12 ** (1 / 261) - 1))[-1]
    assert abs(last.cagr_3y - 0.12) < 0.005 and abs(last.cagr_5y - 0.12) < 0.005
    assert last.max_drawdown_1y == 0 and abs(last.vol_1y) < 1e-9 and last.sharpe_1y is None


def test_drawdown(spark):
    rows = [(c, d, 10.0 if k < 100 else 8.0 if k < 200 else 9.0) for k, (c, d, _) in enumerate(growing(date(2024, 1, 1), date(2024, 12, 31)))]
    assert abs(metrics(spark, rows)[-1].max_drawdown_1y + 0.2) < 1e-12


def test_short_history(spark):
    last = metrics(spark, growing(date(2025, 1, 1), date(2025, 5, 30), 0.001))[-1]
    assert last.ret_1m is not None and last.obs_1y > 0
    assert all(last[c] is None for c in ("ret_1y", "cagr_3y", "cagr_5y", "vol_1y", "max_drawdown_1y", "sharpe_1y"))


def test_suspended_at_the_lookback(spark):
    rows = [r for r in growing(date(2023, 1, 1), date(2025, 6, 30)) if not date(2024, 5, 2) <= r[1] <= date(2024, 7, 31)]
    assert metrics(spark, rows)[-1].ret_1y is None


def test_a_jump_over_a_gap_is_no_daily_return(spark):
    days = growing(date(2024, 3, 1), date(2025, 6, 30))
    rows = [(c, d, 10.0 if d < date(2025, 2, 15) else 20.0) for c, d, _ in days if not date(2025, 2, 1) <= d <= date(2025, 2, 28)]
    assert metrics(spark, rows)[-1].vol_1y == 0


def brute(rows, rules=RiskRules()):
    rows = sorted(rows, key=lambda r: r[1])
    days, navs = [r[1] for r in rows], [r[2] for r in rows]

    def months_before(d, n):
        y, m = divmod(d.year * 12 + d.month - 1 - n, 12)
        last = (date(y + (m == 11), (m + 1) % 12 + 1, 1) - timedelta(1)).day
        return date(y, m + 1, min(d.day, last))

    def at(target):
        found = [k for k, d in enumerate(days) if d <= target]
        return navs[found[-1]] if found and (target - days[found[-1]]).days <= rules.lookup_gap_days else None

    out = []
    for p, t in enumerate(days):
        if p + 1 < len(days) and (days[p + 1].year, days[p + 1].month) == (t.year, t.month):
            continue
        back = {n: at(months_before(t, n)) for n in (1, 12, 36, 60)}
        grown = {n: None if v is None else (navs[p] / v) ** (12 / max(12, n)) - 1 for n, v in back.items()}
        first = next(k for k, d in enumerate(days) if d >= t - timedelta(rules.window_days))
        rets = [math.log(navs[k] / navs[k - 1]) for k in range(first + 1, p + 1) if (days[k] - days[k - 1]).days <= rules.return_gap_days]
        vol = fall = sharpe = None
        if len(rets) >= rules.least_returns:
            vol = float(np.std(rets, ddof=1)) * math.sqrt(rules.trading_days)
            fall = min(navs[k] / max(navs[first : k + 1]) - 1 for k in range(first, p + 1))
            if grown[12] is not None and vol >= rules.least_volatility:
                sharpe = (grown[12] - rules.risk_free_rate) / vol
        out.append((t, p == len(days) - 1, grown[1], grown[12], grown[36], grown[60], vol, fall, sharpe, len(rets)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    random = np.random.default_rng(seed)
    rows, nav = [], 10.0
    for d in business_days(date(2016, 2, 1), date(2024, 2, 29)):
        nav *= math.exp(random.normal(0, 0.01))
        if random.random() > 0.12 and not (d.year == 2019 and d.month in (3, 4)):
            rows.append((1, d, nav))
    rules = {"least_returns": 150, "risk_free_rate": 0.05}
    got = metrics(spark, rows, **rules)
    want = brute(rows, RiskRules(**rules))
    assert len(got) == len(want)
    for r, w in zip(got, want, strict=True):
        mine = (r.as_of_date, r.is_latest, r.ret_1m, r.ret_1y, r.cagr_3y, r.cagr_5y, r.vol_1y, r.max_drawdown_1y, r.sharpe_1y, r.obs_1y)
        assert mine[:2] == w[:2] and mine[-1] == w[-1]
        for a, b in zip(mine[2:-1], w[2:-1], strict=True):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9 * max(1, abs(b)))


def test_no_rows_and_one_row(spark):
    assert metrics(spark, []) == []
    (only,) = metrics(spark, [(1, date(2024, 1, 5), 3.0)])
    assert only.is_latest and only.obs_1y == 0 and only.ret_1m is None


def test_snapshots_take_one_shuffle(spark):
    rows = spark.createDataFrame(growing(date(2024, 1, 1), date(2024, 6, 1)), SCHEMA)
    plan = snapshot_metrics(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_jumps_have_no_gap_limit(spark):
    rows = spark.createDataFrame([(1, date(2024, 1, 1), 10.0), (1, date(2024, 9, 1), 15.1), (1, date(2024, 9, 2), 15.0), (2, date(2024, 1, 1), 10.0), (2, date(2024, 1, 2), 15.0)], SCHEMA)
    (jump,) = series.jumps(rows).collect()
    assert (jump.scheme_code, jump.prev_nav_date, jump.nav_date) == (1, date(2024, 1, 1), date(2024, 9, 1)) and abs(jump.change - 0.51) < 1e-12


VERSION = "scheme_code int, scheme_name string, scheme_type string, category string, fund_house string, isin_growth string, isin_reinvest string, nav_date date"


def test_versions_and_documents(spark):
    def row(name, day):
        return (1, name, "T", "C", "H", None, None, day)

    days = [row("Old", date(2024, 1, 1)), row("Old", date(2024, 1, 2)), row("New", date(2024, 2, 1)), row("Old", date(2024, 1, 20)), (2, None, "T", "C", "H", None, None, date(2024, 1, 1)), (2, "Two", "T", "C", "H", None, None, date(2023, 1, 1))]
    found = versions.attribute_versions(spark.createDataFrame(days, VERSION))
    docs = {r.scheme_code: r for r in versions.registry_documents(found).collect()}
    assert docs[1].current.scheme_name == "New" and [h.scheme_name for h in docs[1].history] == ["Old", "New"] and docs[1].name_changes == 1
    assert [h.nav_rows for h in docs[1].history] == [3, 1] and docs[1].first_nav_date == date(2024, 1, 1) and docs[1].last_nav_date == date(2024, 2, 1)
    assert docs[2].current.scheme_name is None and docs[2].name_changes == 1
    flat = {r.scheme_code: r for r in versions.registry_rows(versions.registry_documents(found)).collect()}
    assert flat[1].scheme_name == "New" and flat[1].fund_house == "H"


def test_expectations(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", -1.0), (None, "c", None), (None, "c", 2.0), (3, None, 9.0)], "k int, s string, v double")
    count = {
        "unique": expectations.unique(df, "k"),
        "combination": expectations.unique(df, "k", "s"),
        "not_null": expectations.not_null(df, "s"),
        "accepted": expectations.accepted(df, "s", ["a", "c"]),
        "related": expectations.related(df, "k", spark.createDataFrame([(1,)], "id int"), "id"),
        "non_negative": expectations.non_negative(df, "v"),
        "non_positive": expectations.non_positive(df, "v"),
        "implausible": expectations.implausible(df, "v"),
    }
    got = {r.check: r.violations for r in expectations.violations(count).collect()}
    assert got == {"unique": 1, "combination": 1, "not_null": 1, "accepted": 1, "related": 1, "non_negative": 1, "non_positive": 3, "implausible": 2}
