"""The gateway over HTTP: GET /healthz and POST /v1/sql/query."""

from __future__ import annotations

import hmac
import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from tidemark.plans.gateway import Gateway

HEADER_TIMEOUT_S = 5
MOST_BODY = 1 << 20


def _handler(gateway: Gateway, token: str) -> type[BaseHTTPRequestHandler]:
    class Handler(BaseHTTPRequestHandler):
        timeout = HEADER_TIMEOUT_S
        protocol_version = "HTTP/1.1"

        def log_message(self, *args) -> None:
            pass

        def reply(self, status: int, body: dict) -> None:
            data = json.dumps(body, ensure_ascii=False).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json; charset=utf-8")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def known(self) -> bool:
            """Health needs no token; a token may come bare or after Bearer."""
            if not token:
                return True
            given = self.headers.get("Authorization", "").strip()
            given = given[7:].strip() if given.startswith("Bearer ") else given
            return hmac.compare_digest(given.encode(), token.encode())

        def do_GET(self) -> None:
            if self.path == "/healthz":
                self.reply(200, {"ok": True})
            elif not self.known():
                self.reply(401, {"error": "unauthorized"})
            else:
                self.reply(405 if self.path == "/v1/sql/query" else 404, {"error": "not found"})

        def do_POST(self) -> None:
            size = int(self.headers.get("Content-Length") or 0)
            body = self.rfile.read(min(size, MOST_BODY))
            if self.path == "/healthz":
                self.reply(405, {"error": "method not allowed"})
            elif not self.known():
                self.reply(401, {"error": "unauthorized"})
            elif self.path != "/v1/sql/query":
                self.reply(404, {"error": "not found"})
            else:
                self.reply(*self.answer(body))

        def answer(self, body: bytes) -> tuple[int, dict]:
            try:
                request = json.loads(body)
                if not isinstance(request, dict) or set(request) - {"sql", "limit"}:
                    raise ValueError("the body has the fields sql and limit only")
                sql, limit = request.get("sql") or "", request.get("limit") or 0
                if not isinstance(sql, str) or isinstance(limit, bool) or not isinstance(limit, int):
                    raise ValueError("sql is text and limit a whole number")
                if not sql.strip():
                    raise ValueError("sql is required")
                return 200, gateway.query(sql, limit).to_json()
            except TimeoutError as e:
                return 504, {"error": str(e)}
            except Exception as e:
                return 400, {"error": str(e)}

    return Handler


class Server:
    """Serves from a thread of its own until stopped."""

    def __init__(self, gateway: Gateway, listen: str = "127.0.0.1:0", token: str = ""):
        host, _, port = listen.rpartition(":")
        self.http = ThreadingHTTPServer((host or "0.0.0.0", int(port)), _handler(gateway, token))
        self.http.daemon_threads = True
        self.thread = threading.Thread(target=self.http.serve_forever, daemon=True)

    @property
    def address(self) -> str:
        return "http://{}:{}".format(*self.http.server_address[:2])

    def start(self) -> Server:
        self.thread.start()
        return self

    def stop(self) -> None:
        self.http.shutdown()
        self.http.server_close()
        self.thread.join(5)
