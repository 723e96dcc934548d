import json
import threading
import urllib.error
import urllib.request

import pytest

from sparkloom.server import make_server


@pytest.fixture
def url():
    def answer(q):
        if q == "fail":
            raise RuntimeError
        return {"answer": q}

    s = make_server(answer)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()
    s.server_close()


def call(url, body=None):
    try:
        with urllib.request.urlopen(urllib.request.Request(url, body), timeout=10) as r:
            return r.status, json.load(r), r.headers
    except urllib.error.HTTPError as e:
        return e.code, json.load(e), e.headers


def test_requests(url):
    assert call(f"{url}/api/health")[:2] == (200, {"status": "ok"})
    status, value, headers = call(f"{url}/api/search", json.dumps({"query": " 가람원 "}).encode())
    assert (status, value["answer"], headers["X-Content-Type-Options"]) == (200, "가람원", "nosniff")
    for body, status in ((b"{", 400), (b"{}", 400), (b"[1]", 400), (b'{"query":"x"}', 400), (b'{"query":"' + b"x" * 501 + b'"}', 400), (b" " * 70_000, 413), (b'{"query":"fail"}', 500)):
        assert call(f"{url}/api/search", body)[0] == status
    assert call(f"{url}/other")[0] == 404 and call(f"{url}/other", b"x")[0] == 404


def test_other_hosts_are_refused():
    with pytest.raises(ValueError):
        make_server(dict, "0.0.0.0")
