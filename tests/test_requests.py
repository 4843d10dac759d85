import base64
import io
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs

import pytest

from lotline.__main__ import main
from lotline.operators import export
from lotline.sources import requests as R


def test_archives_are_kept_if_whole(tmp_path):
    at, asked = tmp_path / "a.zip", []
    get = lambda refresh=False: R.archive(str(at), lambda: "u", refresh, 3, lambda u: asked.append(u) or io.BytesIO(b"12345"))
    at.write_bytes(b"123")  # too small to be whole
    assert get() == str(at) and at.read_bytes() == b"12345" and asked == ["u"]
    get()
    assert len(asked) == 1
    get(refresh=True)
    assert len(asked) == 2

    def broken(url):
        raise OSError("gone")

    with pytest.raises(OSError):
        R.archive(str(at), lambda: "u", True, 3, broken)
    assert at.read_bytes() == b"12345" and len(list(tmp_path.iterdir())) == 1
    assert R.blob_url("b", "d", {"blobId": "x", "blobFilename": "f n"}) == "b/api/views/d/files/x?filename=f+n"
    with pytest.raises(ValueError, match="no file"):
        R.blob_url("b", "d", {})


class Service(BaseHTTPRequestHandler):
    def log_message(self, *args):
        pass

    def do_GET(self):
        self.send_response(200)
        self.send_header("Set-Cookie", "s=7")
        self.end_headers()
        self.wfile.write(b'<form><input value="t&amp;1" type="hidden" name="__RequestVerificationToken"></form>')

    def do_POST(self):
        sent = parse_qs(self.rfile.read(int(self.headers["Content-Length"])).decode())
        self.send_response(200)
        self.end_headers()
        self.wfile.write(f"{self.headers['Cookie']} {sent['__RequestVerificationToken'][0]} {sent['q'][0]}".encode())


def test_forms_take_the_pages_cookies_and_token():
    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    assert R.post_in_session(f"{base}/page", f"{base}/form", {"q": "5"}) == "s=7 t&1 5"
    server.shutdown()
    assert R.form_field("<p>none</p>", "x") == ""


def test_headers_literals_and_names():
    back = base64.b64decode("".join(chr(ord(ch) + R.CLOCK_STEPS) for ch in R.clock_header(12.5))).decode()
    assert back == "12500" and R.clock_header()
    assert R.quoted("O'Neil") == "'O''Neil'"
    for bad in ("", "9a", "A", "a-b"):
        with pytest.raises(ValueError):
            R.feed_name(bad)


def test_a_new_feed_can_be_imported(tmp_path):
    args = ["new_feed", "--db", str(tmp_path), "--source", "some_feed", "--out", str(tmp_path)]
    assert main(args, object()) == 0 and main(args, object()) == 1
    compile((tmp_path / "some_feed.py").read_text(), "some_feed.py", "exec")


def test_the_table_of_feeds_is_renewed():
    block = export.status_block([("b", 0, False), ("c", 5, True), ("a", 2, True)], "2026-01-01", "<x>", "</x>")
    assert [line.split("`")[1] for line in block.splitlines() if "`" in line] == ["a", "c", "b"] and "2 of 3" in block
    assert export.with_block("head <x>old</x> tail", block, "<x>", "</x>") == f"head {block} tail"
    assert export.with_block("no marks", block, "<x>", "</x>") == "no marks"
