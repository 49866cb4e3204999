import json
import urllib.error
import urllib.request
from datetime import UTC, date, datetime
from threading import Thread

import pytest
from tidemark.functions import dates
from tidemark.operators import rules
from tidemark.plans import jobs, marts, serving
from tidemark.plans.http_api import serve

DAY = date(2026, 9, 30)
METRICS = "scheme_code int, as_of_date date, nav double, is_latest boolean, ret_1m double, ret_1y double, cagr_3y double, cagr_5y double, vol_1y double, max_drawdown_1y double, sharpe_1y double, obs_1y int"
REGISTRY = "scheme_code int, scheme_name string, scheme_type string, category string, fund_house string, isin_growth string, isin_reinvest string, first_nav_date date, last_nav_date date, name_changes int"


def measure(code, ret, cagr=None, sharpe=None, latest=True, day=DAY):
    return (code, day, 10.0, latest, 0.01, ret, cagr, None, 0.2, -0.1, sharpe, 240)


def entry(code, name, category, house="H", last=DAY):
    return (code, name, "T", category, house, None, None, date(2020, 1, 1), last, 0)


@pytest.fixture(scope="module")
def tables(spark):
    large = "Equity Scheme - Large Cap Fund"
    rows = [measure(1, 0.10, 0.2, 1.0), measure(2, 0.30, 0.1, 2.0), measure(3, 0.30, None, None), measure(4, None, 0.4, 3.0), measure(5, 0.5), measure(6, 0.7), measure(7, 0.9), measure(8, 0.2), measure(1, 9.9, latest=False, day=date(2026, 8, 31)), measure(9, 0.15, 0.1)]
    registry = [entry(1, "A Direct Growth", large), entry(2, "B direct growth", large, "I"), entry(3, "C DIRECT Growth", large), entry(4, "D Direct Plan Growth", large), entry(5, "E Growth", large), entry(6, "F Direct Growth", None), entry(7, "G Direct IDCW", large), entry(8, "H Direct Growth", large, last=date(2026, 9, 22)), entry(9, "Bench Dividend Direct", " - X")]
    metrics, reg = spark.createDataFrame(rows, METRICS), spark.createDataFrame(registry, REGISTRY)
    dim = marts.classified(reg)
    return metrics, reg, dim, marts.scorecard(metrics, dim, 9)


def test_classes(tables):
    got = {r.scheme_code: r for r in tables[2].collect()}
    assert [got[k].plan for k in (1, 5, 9)] == ["Direct", "Regular", "Direct"]
    assert [got[k].option_type for k in (1, 7, 9)] == ["Growth", "IDCW", "IDCW"]
    assert got[1].asset_class == "Equity Scheme" and got[9].asset_class is None and got[6].asset_class is None
    assert [got[k].is_active for k in (1, 8)] == [True, False]


def test_option_words(spark):
    names = ["Dividend bonus", "Bonus growth", "GROWTH", "plain", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(marts.option_of(df.n)).collect()] == ["IDCW", "Bonus", "Growth", "Other", "Other"]


def test_scorecard_golden(tables):
    got = {r.scheme_code: r for r in tables[3].collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    assert {k: got[k].rank_ret_1y for k in (1, 2, 3, 4)} == {2: 1, 3: 1, 1: 3, 4: 4}
    assert {k: got[k].rank_cagr_3y for k in (1, 2, 3, 4)} == {4: 1, 1: 2, 2: 3, 3: 4}
    assert got[1].funds_in_category == 4 and got[1].category_median_ret_1y == 0.30 and abs(got[1].category_median_cagr_3y - 0.2) < 1e-12
    assert abs(got[1].ret_1y_vs_category + 0.2) < 1e-12 and abs(got[1].ret_1y_vs_benchmark + 0.05) < 1e-12 and got[4].ret_1y_vs_benchmark is None
    assert list(got[1].asDict()) == ["scheme_code", *marts.SCORECARD]


def test_a_missing_benchmark_leaves_nulls(tables):
    rows = marts.scorecard(tables[0], tables[2], 777).collect()
    assert len(rows) == 5 and all(r.ret_1y_vs_benchmark is None for r in rows)


def test_summaries(tables):
    (direct,) = marts.category_summary(tables[3]).filter("plan = 'Direct'").collect()
    assert direct.funds == 4 and abs(direct.p25_ret_1y - 0.2) < 1e-12 and direct.median_ret_1y == 0.3 and abs(direct.ret_1y_spread - 0.1) < 1e-12
    houses = {r.fund_house: r for r in marts.house_summary(tables[3]).collect()}
    assert (houses["H"].growth_schemes, houses["H"].direct_schemes, houses["H"].categories) == (4, 3, 1)
    assert houses["H"].share_beating_category_1y == 0.0 and houses["I"].median_ret_1y_vs_category == 0.0


def test_monthly_and_dashboards(spark, tables):
    facts = marts.monthly(tables[0])
    assert {(r.month, r.is_month_to_date) for r in facts.filter("scheme_code = 1").collect()} == {(date(2026, 9, 1), True), (date(2026, 8, 1), False)}
    assert [r.nav for r in marts.benchmark_series(facts, 1).collect()] == [10.0, 10.0]
    top = marts.top_funds(tables[3], n=2).collect()
    assert [(r.scheme_name, r.category, float(r.ret_1y_pct)) for r in top] == [("B direct growth", "Large Cap Fund", 30.0), ("C DIRECT Growth", "Large Cap Fund", 30.0)]
    assert marts.category_medians(marts.category_summary(tables[3])).count() == 1
    jumps = spark.createDataFrame([(1, DAY, 1.0, DAY, 2.0, 1.0), (99, DAY, 1.0, DAY, 2.0, 1.0)], "scheme_code int, prev_nav_date date, prev_nav double, nav_date date, nav double, change double")
    found = {r.scheme_code: r.scheme_name for r in marts.anomalies(jumps, tables[2]).collect()}
    assert found == {1: "A Direct Growth", 99: None}


@pytest.fixture(scope="module")
def service(spark, tables):
    metrics, reg, _, card = tables
    registry = reg.withColumn("updated_at", reg.last_nav_date)
    return serving.Service(serving.Tables(card.cache(), marts.monthly(metrics), marts.category_summary(card), registry))


def test_lists_filter_and_sort(tables):
    card = tables[3]
    codes = lambda **q: [r.scheme_code for r in serving.list_funds(card, **q).collect()]
    assert codes() == [5, 2, 3, 1, 4] and codes(plan="Regular") == [5] and codes(sort_by="cagr_3y", limit=2) == [4, 1] and codes(fund_house="I") == [2]
    for bad in ({"sort_by": "fund_house"}, {"sort_by": ""}, {"limit": -4}, {"limit": 1000}, {"plan": "direct"}):
        with pytest.raises(serving.RequestError):
            serving.list_funds(card, **bad)


def test_cache_hits_until_the_snapshot_changes():
    now, loads = [0.0], []
    cache = serving.ResultCache(10, lambda: now[0])
    load = lambda: loads.append(1) or [None]
    assert [cache.served("a", make=load) for _ in range(2)] == [([None], False), ([None], True)]
    cache.bump()
    assert not cache.served("a", make=load).kept
    now[0] = 11
    assert not cache.served("a", make=load).kept and len(loads) == 3


def test_http(service):
    server = serve(service, port=0)
    Thread(target=server.serve_forever, daemon=True).start()

    def get(path):
        try:
            with urllib.request.urlopen(f"http://127.0.0.1:{server.server_port}{path}") as r:
                return r.status, json.load(r), r.headers.get("X-Cache")
        except urllib.error.HTTPError as e:
            return e.code, json.load(e), None

    assert get("/health") == (200, {"status": "ok"}, None)
    assert get("/funds?limit=1")[2] == "MISS" and get("/funds?limit=1")[2] == "HIT"
    assert get("/funds?sort_by=x")[0] == 422 and get("/funds?limit=x")[0] == 422
    status, body, _ = get("/funds/6")
    assert status == 200 and body["scorecard"] is None and body["registry"]["scheme_name"] == "F Direct Growth" and "updated_at" not in body["registry"]
    assert get("/funds/1")[1]["scorecard"]["rank_ret_1y"] == 3 and get("/funds/777")[0] == 404
    assert [r["month"] for r in get("/funds/1/history?months=1")[1]] == ["2026-09-01"] and get("/funds/777/history")[0] == 404 and get("/funds/1/history?months=0")[0] == 422
    assert len(get("/categories")[1]) == 2 and get("/nothing")[0] == 404
    server.shutdown()


def test_windows(spark):
    got = [tuple(r) for r in dates.month_windows(spark, date(2026, 1, 15), date(2026, 3, 2)).collect()]
    assert got == [(date(2026, 1, 15), date(2026, 1, 31)), (date(2026, 2, 1), date(2026, 2, 28)), (date(2026, 3, 1), date(2026, 3, 2))]
    assert [tuple(r) for r in dates.year_chunks(spark, date(2025, 12, 30), date(2026, 1, 2)).collect()] == [(date(2025, 12, 30), date(2025, 12, 31)), (date(2026, 1, 1), date(2026, 1, 2))]
    with pytest.raises(ValueError):
        dates.month_windows(spark, date(2026, 2, 1), date(2026, 1, 1))
    assert dates.daily_window(date(2026, 9, 10)) == (date(2026, 9, 5), date(2026, 9, 10)) and dates.clamped(date(2000, 1, 1), date(2006, 4, 1)) == date(2006, 4, 1)


def test_all_stages(spark, tmp_path):
    from test_deliveries import FIRST, SECOND, WINDOWS
    from tidemark.sources import header_text, lake

    bodies = {w: t for (w, _), t in zip(WINDOWS, (FIRST, SECOND), strict=True)}
    paths = lake.land(spark, f"file://{tmp_path}/raw", lambda s, e: bodies[s, e].encode(), list(bodies), header_text.HEADER, sleep=lambda _: None)
    where = jobs.Lake(f"file://{tmp_path}/lake")
    for _ in range(2):  # a second run changes nothing
        stats = jobs.run_all(spark, where, paths, benchmark_code=201, today=date(2026, 9, 5), most_unexpected=0.5)
        assert stats["daily"]["kept"] == 7 and stats["metrics"]["keys"] == 4 and stats["registry"]["documents"] == 4
        assert spark.table("mart_fund_scorecard").count() == stats["marts"]["mart_fund_scorecard"] == 2
        assert spark.table("stg_schemes").count() == stats["marts"]["dim_scheme"] == 4


def test_a_running_service_turns_to_new_marts(spark, tmp_path):
    from test_deliveries import FIRST, SECOND, WINDOWS
    from tidemark.sources import header_text, lake

    bodies = {w: t for (w, _), t in zip(WINDOWS, (FIRST, SECOND), strict=True)}
    paths = lake.land(spark, f"file://{tmp_path}/raw", lambda s, e: bodies[s, e].encode(), list(bodies), header_text.HEADER, sleep=lambda _: None)
    where = jobs.Lake(f"file://{tmp_path}/lake")
    jobs.run_all(spark, where, paths, benchmark_code=201, most_unexpected=0.5)
    running = jobs.service(spark, where)
    assert [running.funds(limit=5).kept for _ in range(2)] == [False, True]
    stats = jobs.build_marts(spark, where, 203, active_days=0)
    answer = running.funds(limit=5)
    assert not answer.kept and [r["scheme_code"] for r in answer.body] == [201, 203] and running.seen == stats["version"]
    assert running.funds(limit=5).kept
    assert serving.query(spark, "SELECT scheme_code FROM stg_schemes WHERE scheme_code >= :least ORDER BY 1", least=203) == [{"scheme_code": 203}, {"scheme_code": 204}, {"scheme_code": 205}]


def body_of(start, end):
    rows = [f"{code};Fund {code} - Growth;;;X{code};;{10 + day % 7}.5;{day:02d}-{start:%b-%Y}" for code in (301, 302) for day in range(start.day, end.day + 1)]
    return "\n".join(["Scheme Code;a;b;c;d;e;f;g", "Open Ended Schemes ( Debt Scheme - Gilt )", "House", *rows]).encode()


def test_backfill_and_daily_run(spark, tmp_path):
    where, quiet = jobs.Lake(f"file://{tmp_path}/lake"), {"sleep": lambda _: None}
    stats = jobs.run_backfill(spark, where, body_of, date(2025, 12, 30), date(2026, 2, 10), 301, fetch=quiet)
    assert [d["read"] for d in stats["daily"]] == [4, 2 * 41] and stats["metrics"]["keys"] == 2
    late = datetime(2026, 2, 11, 20, 0, tzinfo=UTC)  # already the 12th where the publisher is
    stats = jobs.run_daily(spark, where, body_of, late, 301, fetch=quiet)
    assert stats["ingest"]["months"] == ["2026-02"] and stats["metrics"]["newest"] == date(2026, 2, 12)
    daily = spark.read.parquet(where.daily)
    assert daily.agg({"nav_date": "max"}).first()[0] == date(2026, 2, 12) and daily.count() == 2 * 45
    with pytest.raises(rules.GateError):
        jobs.build_metrics(spark, where, today=date(2026, 3, 1))


def test_days_of_the_publisher():
    assert dates.daily_window(datetime(2026, 9, 10, 18, 31)) == (date(2026, 9, 6), date(2026, 9, 11))
    assert dates.daily_window(datetime(2026, 9, 10, 18, 29, tzinfo=UTC)) == (date(2026, 9, 5), date(2026, 9, 10))
