"""Fetching over HTTP against a local server: rates by host, retries, stops and resumption."""

import collections
import http.server
import threading

import pytest
from pyspark.sql import functions as F

from quarry.session import scratch
from quarry.sources import fetching, http as pages


class Server:
    """Answers /ok/n with PK..., /text with other bytes, and 404 else; while down every answer is 500. Counts requests."""

    def __init__(self):
        self.seen, self.down = collections.Counter(), False
        outer = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_GET(self):
                outer.seen[self.path] += 1
                code = 500 if outer.down else 200 if self.path.startswith(("/ok", "/text")) else 404
                body = b"" if code != 200 else (b"PK\x03\x04" + self.path.rpartition("/")[2][:1].encode() if self.path.startswith("/ok") else b"<html>")
                self.send_response(code)
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *_):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def url(self, path, host="127.0.0.1"):
        return f"http://{host}:{self.server.server_port}{path}"


@pytest.fixture
def server():
    s = Server()
    yield s
    s.server.shutdown()


def test_order_and_rate_of_hosts():
    clock, log = [0.0], []

    def get(url):
        log.append((round(clock[0], 1), url))
        clock[0] += 0.1
        return pages.Page(url, 200 if "x" not in url else 404, b"c")

    rows = [("1", "a1", "a"), ("2", "a2", "a"), ("3", "a3", "a"), ("4", "b1", "b"), ("5", "bx", "b")]
    got = list(fetching.served(rows, get, 1.0, lambda: clock[0], lambda s: clock.__setitem__(0, clock[0] + s)))
    assert log == [(0.0, "a1"), (0.1, "b1"), (1.0, "a2"), (1.1, "bx"), (2.0, "a3")]
    assert [(r[0], r[2], r[3]) for r in got] == [("1", 200, b"c"), ("4", 200, b"c"), ("2", 200, b"c"), ("5", 404, None), ("3", 200, b"c")]


def test_source_asks_each_address_once(spark, server):
    rows = [(i, server.url(f"/ok/{i}", "127.0.0.1" if i % 2 else "localhost")) for i in range(12)] + [(20, server.url("/none")), (21, None)]
    targets = spark.createDataFrame(rows, "doc_id long, url string").withColumn("status", F.lit("clash"))
    path = scratch(spark, "got")
    fetching.fetch(targets, wait=0.0, groups=4).write.parquet(path)
    got = {r.doc_id: (r.status, r.content and bytes(r.content)) for r in spark.read.parquet(path).collect()}
    assert got == {str(i): (200, b"PK\x03\x04" + str(i)[:1].encode()) for i in range(12)} | {"20": (404, None)}
    assert set(server.seen.values()) == {1}


def test_ingest_resumes_without_a_second_fetch(spark, server, monkeypatch):
    rows = [(i, server.url(f"/ok/{i}", "127.0.0.1" if i % 2 else "localhost")) for i in range(10)] + [(20, server.url("/none")), (21, server.url("/text"))]
    targets = spark.createDataFrame(rows, "doc_id long, url string")
    home = scratch(spark, "ingest")
    real, calls = fetching.fetch, []

    def stopped(mine, **how):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("stopped")
        return real(mine, **how)

    monkeypatch.setattr(fetching, "fetch", stopped)
    monkeypatch.setattr(fetching, "url_host", lambda c: F.col(c) if isinstance(c, str) else c)  # every address its own host: portions are fine
    with pytest.raises(RuntimeError, match="stopped"):
        fetching.ingest(targets, home, portions=3, magic=b"PK\x03\x04", wait=0.0, groups=2)
    first = dict(server.seen)
    assert 0 < len(first) < 12
    monkeypatch.setattr(fetching, "fetch", real)
    got = {r.doc_id: r for r in fetching.ingest(targets, home, portions=3, magic=b"PK\x03\x04", wait=0.0, groups=2).collect()}
    assert {i: got[str(i)].status for i in range(10)} == dict.fromkeys(range(10), "fetched")
    assert got["21"].status == "bad_content" and got["20"].status == "failed" and got["20"].code == 404
    assert all(n == 1 for path, n in server.seen.items() if path != "/none")
    for _ in range(3):  # what failed is asked again until it is given up
        last = {r.doc_id: r for r in fetching.ingest(targets, home, portions=1, magic=b"PK\x03\x04", wait=0.0, groups=2).collect()}
        n = server.seen["/none"]
        assert n <= 3 and (last["20"].status, last["20"].attempts) == ("failed" if n < 3 else "permanent_missing", n)
    assert n == 3
    held = {r.digest: bytes(r.content) for r in fetching.contents(spark, home).collect()}
    assert {held[got[str(i)].digest] for i in range(10)} == {b"PK\x03\x04" + str(i).encode() for i in range(10)} and len(held) == 11
    assert all(n == 1 for path, n in server.seen.items() if path != "/none")


def test_a_server_that_goes_down(spark, server, monkeypatch):
    monkeypatch.setattr(pages, "ATTEMPTS", 1)
    monkeypatch.setenv("no_proxy", "*")
    targets = spark.createDataFrame([(i, server.url(f"/text/{i}")) for i in range(4)], "doc_id long, url string")
    home = scratch(spark, "down")
    fetching.ingest(targets.where("doc_id < 2"), home, portions=1, wait=0.0, groups=2)
    got = {r.doc_id: r.status for r in fetching.ingest(targets, home, portions=2, wait=0.0, groups=2).collect()}
    assert got == {str(i): "fetched" for i in range(4)} and set(server.seen.values()) == {1}
    assert fetching.ingest(targets.limit(0), home, portions=1).count() == 4
