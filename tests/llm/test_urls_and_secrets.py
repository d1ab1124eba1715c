from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import secrets, url_filter

URLS = [
    "http://example.com/en/7x?a", "https://a.EXAMPLE.com/en/7", "https://b.com/en/x", "http://notexample.com/en/7", "http://x.net/de/1", "http://example.net/de/81", "http://example.net/de/9#f", "https://z.org/es/", "https://z.org/es",
    "ftp://cheap-pills.shop/x", "http://www.spam-farm.example.org/en/1", "http://com/en/", "no url", None, "", "http://", "://com/en/5", "http://a.com", "http://a.com?x=://b.com/en/", "http://ÄÖ.com/en/ä", "http://a.com:80/en/1", "http://b.com/en/x",
]


def plain(url):
    """All rules one by one."""
    rest = url.split("://", 1)[1] if url and "://" in url else None
    host = re.match(r"[^/?#]*", rest or "")[0]
    path = re.match(r"[^?#]*", (rest or "")[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for r in url_filter.SITE_RULES:
        h, _, p = r.text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append(r)
    best = max(fits, key=lambda r: len(r.text), default=None)
    spam = any(re.fullmatch(p.host, host, re.S) for p in url_filter.HOST_PATTERNS)
    return host, path, best.text if best else None, best.action if best else "block" if spam or rest is None else "allow"


def test_url_verdicts(spark):
    pages = spark.createDataFrame([(i, u, "h", "x", "y") for i, u in enumerate(URLS)] + [(None, URLS[0], "h", "x", "y")], "page_id long, url string, html string, host string, key string")
    got = url_filter.judge_urls(pages).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        url = URLS[r["page_id"] or 0]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain(url), url
    assert url_filter.judge_urls(pages.limit(0)).collect() == []
    assert all(r["n_candidates"] <= 3 for r in got)


def test_very_long_urls(spark):
    """A path, a host and a query of 200,000 letters each."""
    urls = ["https://b.com/en/" + "x/" * 100_000, "https://" + "sub." * 50_000 + "example.net/de/8", "http://z.org/es/?" + "a=b&" * 50_000, "x" * 200_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for r in url_filter.judge_urls(pages).collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain(urls[r["page_id"]])


def test_rules_lie_under_their_rarest_token():
    index = url_filter.rule_index(url_filter.SITE_RULES, {"h:com": 50, "p:en": 40, "h:example": 60, "h:net": 9, "p:de": 10})
    assert {r.text for r in index["p:en"]} == {"com/en/", "example.com/en/7"}
    assert {r.text for r in index["h:net"]} == {"net/de/", "example.net/de/8"}
    assert url_filter.rule_index([url_filter.site_rule("block", "/x")], {}) == {None: [url_filter.site_rule("block", "/x")]}


# ---- secrets


def base_spans(text):
    """The contract's three patterns, word by word."""
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def tell(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)


SECRETS = [
    "PassWord = 'hunter2x' and token: abc then Secret='xyzxyz'", "AKIA" + "B" * 16 + " AKIASHORT", "é " + "0123456789abcdef" * 2 + " f" * 30, "api_key=token=abcdefgh apikey : x", "ſecret=abcdefg toKen=abcdefg",
    "Authorization: Bearer abcdefghijklmnopqrstuvwxyz0123", "token = deadbeefdeadbeefdeadbeefdeadbeef", "a" * 23 + " " + "a" * 24, "x", "", None,
]


def test_base_spans_and_ownership(spark, docs, odd):
    shared = "see token = examplekey12345 for how"
    rows = [(100 + i, t, "en", f"s{i}") for i, t in enumerate(SECRETS)] + [(200 + i, shared, "en", f"s{i % 4}") for i in range(8)] + [(300, "Bearer " + "q" * 30, "en", "s1")] + [(310 + i, "Bearer " + "z" * 30, "en", f"s{i}") for i in range(6)]
    rows += odd
    found = secrets.digest(secrets.find_secrets(spark, docs(rows))).collect()
    assert len(found) == len(rows)
    text_of = {i: t for i, t, *_ in rows}
    for r in found:
        want = base_spans(text_of[r["doc_id"]] or "")
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for _, x, _, _ in want) for k in range(3)), text_of[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(tell(want).encode()).hexdigest()
    by = {r["doc_id"]: r for r in found}
    assert by[200]["n_examples"] == 1, "many owners hold it"
    assert by[200]["spans"].startswith("assign:"), "base spans stay"
    assert by[300]["spans"] == "bearer:0:37"
    assert by[300]["n_live"] == 1
    assert by[310]["spans"] == "", "a widely copied value is not added"
    assert secrets.digest(secrets.find_secrets(spark, docs([]))).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("0af token=:\"'é" + "AKI"), max_size=80), max_size=4))
def test_scan_equals_patterns(strings, texts):
    from tessera.llm.common import utf8

    may = secrets.long_hex(*utf8(strings(texts)))
    for t, m in zip(texts, may, strict=True):
        assert [(a, b, k) for a, b, k, _ in secrets.find_spans(t, m) if k < 3] == [(a, e, k) for a, k, _, e in base_spans(t)]


def test_long_hex_over_borders(strings):
    from tessera.llm.common import utf8

    may = secrets.long_hex(*utf8(strings(["a" * 24, "g", "x" + "b" * 23, "", "c" * 500])))
    assert may[0]
    assert may[4]
    assert isinstance(may, np.ndarray)


def test_redaction(spark, docs, odd):
    rows = [(1, "é token = abcdefg and AKIA" + "Z" * 16 + " end", "en", "a"), (2, "plain", "en", "b"), *[(10 + i, "token = examplekey12345", "en", f"s{i}") for i in range(6)], *[(o[0] and o[0] + 100, *o[1:]) for o in odd]]
    got = secrets.redact(spark, docs(rows))
    assert got.columns == docs(rows).columns
    text = {r["doc_id"]: r["text"] for r in got.collect()}
    assert text[1] == "é [secret] and [secret] end"
    assert text[2] == "plain"
    assert text[10] == "token = examplekey12345", "a widely copied example stays"
    assert got.count() == len(rows)
    assert text[101] is None


if __name__ == "__main__":
    pytest.main([__file__])
