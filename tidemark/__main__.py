"""Stages from the command line: ``python -m tidemark STAGE --lake ROOT ...``; each prints its numbers as a line of JSON."""

from __future__ import annotations

import argparse
import json
import urllib.parse
import urllib.request
from collections.abc import Callable
from datetime import UTC, date, datetime

from .operators.risk import RiskRules
from .plans import jobs
from .plans.http_api import serve
from .session import build_session
from .sources import lake


def http_fetcher(template: str, timeout: float = 120) -> Callable[[date, date], bytes]:
    """A window's body from a URL with ``{start}`` and ``{end}``, days as 01-Sep-2026."""

    def get(start: date, end: date) -> bytes:
        url = template.format(start=urllib.parse.quote(f"{start:%d-%b-%Y}"), end=urllib.parse.quote(f"{end:%d-%b-%Y}"))
        with urllib.request.urlopen(url, timeout=timeout) as r:
            return r.read()

    return get


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    stages = parser.add_subparsers(dest="stage", required=True)

    def stage(name: str, about: str) -> argparse.ArgumentParser:
        sub = stages.add_parser(name, help=about)
        sub.add_argument("--lake", required=True, help="root of the lake")
        return sub

    s = stage("ingest", "fetch windows into the raw zone")
    s.add_argument("--url", required=True, help="with {start} and {end}")
    s.add_argument("--start", type=date.fromisoformat, required=True)
    s.add_argument("--end", type=date.fromisoformat, required=True)
    s.add_argument("--earliest", type=date.fromisoformat, default=date.min)
    s = stage("daily", "rebuild the daily table's periods")
    s.add_argument("--periods", required=True, help="YYYY-MM, comma-separated")
    s.add_argument("--most-unexpected", type=float, default=0.02)
    s = stage("metrics", "metrics, versions and jumps")
    s.add_argument("--risk-free-rate", type=float, default=RiskRules.risk_free_rate)
    s.add_argument("--today", type=date.fromisoformat, help="checks that the newest row is fresh")
    stage("registry", "registry documents and rows")
    s = stage("warehouse", "load metrics and jumps over JDBC")
    s.add_argument("--jdbc-url", required=True)
    for name, about in (("marts", "tables for analysts"), ("run", "fetch the last days and build all"), ("backfill", "fetch years and build all")):
        s = stage(name, about)
        s.add_argument("--benchmark", type=int, required=True)
        s.add_argument("--active-days", type=int, default=7)
        if name != "marts":
            s.add_argument("--url", required=True, help="with {start} and {end}")
            s.add_argument("--jdbc-url")
        if name == "run":
            s.add_argument("--now", type=datetime.fromisoformat, default=None, help="a moment, UTC if it has no zone")
        if name == "backfill":
            s.add_argument("--start", type=date.fromisoformat, required=True)
            s.add_argument("--end", type=date.fromisoformat, required=True)
    s = stage("serve", "answer requests over HTTP")
    s.add_argument("--host", default="127.0.0.1")
    s.add_argument("--port", type=int, default=8000)
    return parser


def main(argv: list[str] | None = None) -> dict:
    args = arguments().parse_args(argv)
    spark = build_session(f"tidemark-{args.stage}")
    tables = jobs.Lake(args.lake)
    rest = {"active_days": args.active_days, "jdbc_url": args.jdbc_url} if args.stage in ("run", "backfill") else {}
    match args.stage:
        case "ingest":
            stats = jobs.ingest(spark, tables, http_fetcher(args.url), args.start, args.end, args.earliest)
        case "daily":
            periods = [p.strip() for p in args.periods.split(",") if p.strip()]
            stats = jobs.build_daily(spark, lake.period_paths(spark, tables.raw, periods), tables, args.most_unexpected)
        case "metrics":
            stats = jobs.build_metrics(spark, tables, RiskRules(risk_free_rate=args.risk_free_rate), args.today)
        case "registry":
            stats = jobs.build_registry(spark, tables)
        case "warehouse":
            stats = jobs.load_warehouse(spark, tables, args.jdbc_url)
        case "marts":
            stats = jobs.build_marts(spark, tables, args.benchmark, args.active_days)
        case "run":
            stats = jobs.run_daily(spark, tables, http_fetcher(args.url), args.now or datetime.now(UTC), args.benchmark, **rest)
        case "backfill":
            stats = jobs.run_backfill(spark, tables, http_fetcher(args.url), args.start, args.end, args.benchmark, **rest)
        case "serve":
            stats = {"host": args.host, "port": args.port}
            serve(jobs.service(spark, tables), args.host, args.port).serve_forever()
    print(json.dumps(stats, default=str))
    return stats


if __name__ == "__main__":
    main()
