"""The service over HTTP, with the standard library's server."""

from __future__ import annotations

import json
import re
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

from .serving import NotFound, RequestError, Service


def _whole(query: dict[str, str], name: str, default: int) -> int:
    try:
        return int(query.get(name, default))
    except ValueError:
        raise RequestError(f"{name} must be a whole number") from None


def answer(service: Service, target: str) -> tuple[int, object, bool | None]:
    """Status, body and whether the cache had it, for a request's path and query."""
    parts = urlsplit(target)
    query = {k: v[-1] for k, v in parse_qs(parts.query).items()}
    try:
        if parts.path == "/health":
            return 200, service.health(), None
        if parts.path == "/funds":
            known = {k: query.get(k) for k in ("category", "fund_house", "plan")}
            return 200, *service.funds(**known, sort_by=query.get("sort_by", "ret_1y"), limit=_whole(query, "limit", 20))
        if m := re.fullmatch(r"/funds/(-?\d+)(/history)?", parts.path):
            code = int(m[1])
            return 200, *(service.fund_history(code, _whole(query, "months", 60)) if m[2] else service.fund(code))
        if parts.path == "/categories":
            return 200, *service.all_categories()
        raise NotFound(parts.path)
    except RequestError as e:
        return 422, {"detail": str(e)}, None
    except NotFound as e:
        return 404, {"detail": str(e)}, None


def serve(service: Service, host: str = "127.0.0.1", port: int = 8000) -> ThreadingHTTPServer:
    """A server that is ready to ``serve_forever``."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            status, body, hit = answer(service, self.path)
            raw = json.dumps(body, default=str).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(raw)))
            if hit is not None:
                self.send_header("X-Cache", "HIT" if hit else "MISS")
            self.end_headers()
            self.wfile.write(raw)

        def log_message(self, *args) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)
