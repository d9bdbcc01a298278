"""Download against a small server in this process."""

import hashlib
import http.server
import json
import threading

import pytest

from loomspark.__main__ import main
from loomspark.sources import download, manifest

BODY = bytes(range(256)) * 2000


@pytest.fixture
def server():
    """Serves BODY under any name; /cut* ends early at the first request, /gone fails, /whole* knows no ranges."""
    asked = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append((self.path, self.headers.get("Range")))
            if "gone" in self.path:
                return self.send_error(404)
            body, start = BODY, 0
            if "status" in self.path:
                body = json.dumps({"jobs": {"j": {"files": {"a.gz": {"size": len(BODY), "sha1": hashlib.sha1(BODY).hexdigest()}}}}}).encode()
            elif self.headers.get("Range") and "whole" not in self.path:
                start = int(self.headers["Range"][6:-1])
            self.send_response(206 if start else 200)
            self.send_header("Content-Length", str(len(body) - start))
            self.end_headers()
            early = "cut" in self.path and len(asked) == 1
            self.wfile.write(body[start : len(body) // 2 if early else None])

        def log_message(self, *_):
            pass

    http_server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=http_server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{http_server.server_port}", asked
    http_server.shutdown()


def test_one_file(server, tmp_path):
    url, asked = server
    good = hashlib.sha1(BODY).hexdigest()

    def fetch(name, size=len(BODY), sha1=good):
        return download.fetch_file(f"{url}/{name}", str(tmp_path / name), size, sha1, attempts=2, backoff=0)

    assert fetch("cut").state == "ok" and [r for _, r in asked] == [None, f"bytes={len(BODY) // 2}-"]
    assert (tmp_path / "cut").read_bytes() == BODY
    assert fetch("cut").state == "skipped" and len(asked) == 2
    (tmp_path / "whole").write_bytes(b"xyz")
    assert fetch("whole").state == "ok" and (tmp_path / "whole").read_bytes() == BODY
    assert fetch("cut", sha1="0").state == "mismatch" and (tmp_path / "cut").read_bytes() == BODY
    assert fetch("cut", size=5).state == "failed" and (tmp_path / "cut").read_bytes() == BODY
    before = len(asked)
    assert fetch("gone").state == "failed" and len(asked) == before + 2
    assert fetch("free", size=None, sha1=None).state == "ok"
    (tmp_path / "none").write_bytes(b"")
    assert download.fetch_file(f"{url}/none", str(tmp_path / "none"), 0, hashlib.sha1(b"").hexdigest()).state == "skipped"


def test_manifest_cache(server, tmp_path):
    url, asked = server
    cache = str(tmp_path / "s.json")
    for refresh, n in ((False, 1), (False, 1), (True, 2)):
        assert download.fetch_manifest(f"{url}/status.json", cache, refresh) == cache and len(asked) == n


def test_command(spark, server, tmp_path, capsys):
    url, _ = server
    argv = ["files", "--status", str(tmp_path / "s.json"), "--status-url", f"{url}/status.json", "--files", "a.gz", "--download", url]
    assert main(argv) == 2
    assert main([*argv, "--folder", str(tmp_path)]) == 0
    assert (tmp_path / "a.gz").read_bytes() == BODY and "a.gz ok" in capsys.readouterr().out


def test_report_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("b", 2, None), ("a", 1, "x")], "file string, size bigint, sha1 string")
    (tmp_path / "m.md").write_text(manifest.to_markdown(rows))
    back = manifest.read_markdown(spark, str(tmp_path / "m.md"))
    assert sorted(map(tuple, back.collect())) == [("a", "1", "x"), ("b", "2", None)]
