"""A small HTTP interface to a search function, on this machine only."""

from __future__ import annotations

import json
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, HTTPServer

from sparkloom.clients import check_loopback

#: Greatest body, and least and greatest length of a question.
BODY, QUESTION = 64 * 1024, (2, 500)
_HEADERS = {
    "Content-Type": "application/json; charset=utf-8", "Cache-Control": "no-store", "X-Content-Type-Options": "nosniff",
    "Content-Security-Policy": "default-src 'none'", "Referrer-Policy": "no-referrer", "X-Frame-Options": "DENY",
}


def make_server(answer: Callable[[str], dict], host: str = "127.0.0.1", port: int = 0) -> HTTPServer:
    """GET /api/health and POST /api/search {"query": ...}. ``answer`` gives the response of a question; its failure is
    reported as 500 without details. One request at a time, as one Spark session serves them."""
    check_loopback(f"http://{host}:{port}/")

    class Handler(BaseHTTPRequestHandler):
        def _send(self, status: int, value: dict) -> None:
            body = json.dumps(value, ensure_ascii=False, default=str).encode()
            self.send_response(status)
            for k, v in _HEADERS.items():
                self.send_header(k, v)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def do_GET(self) -> None:  # noqa: N802
            self._send(*((200, {"status": "ok"}) if self.path == "/api/health" else (404, {"error": "not found"})))

        def do_POST(self) -> None:  # noqa: N802
            if self.path != "/api/search":
                return self._send(404, {"error": "not found"})
            try:
                length = int(self.headers.get("Content-Length") or 0)
            except ValueError:
                return self._send(400, {"error": "bad length"})
            if not 0 < length <= BODY:
                return self._send(413 if length > BODY else 400, {"error": "body missing or too large"})
            try:
                query = json.loads(self.rfile.read(length))["query"].strip()
            except (ValueError, KeyError, TypeError, AttributeError):
                return self._send(400, {"error": "expected a JSON object with query"})
            if not QUESTION[0] <= len(query) <= QUESTION[1]:
                return self._send(400, {"error": f"a question has {QUESTION[0]} to {QUESTION[1]} characters"})
            try:
                return self._send(200, answer(query))
            except Exception:  # noqa: BLE001
                return self._send(500, {"error": "search failed"})

        def log_message(self, *args: object) -> None:
            pass

    return HTTPServer((host, port), Handler)
