"""URL rules against a plain version, hash collisions, odd URLs."""

import random

import numpy as np
import xxhash

from chorale.llm.urls import DigestArray, Rule, filter_urls

RULES = [
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de", "block"),
    Rule("example.com", "", "allow"),
    Rule("org", "/fr/", "allow"),
    Rule("b.org", "/fr/", "allow"),
    Rule("b.org", "/fr/", "block"),
]
URLS = [
    None,
    "",
    "no scheme.net/",
    "http://",
    "://net/x",
    "HTTP://A.Example.NET/en/1?x=http://b.org/fr/",
    "https://net",
    "https://net/",
    "https://xnet/",
    "https://example.com#de",
    "https://m.example.com/de?q",
    "https://a.b.org/fr/\n/line",
    "https://ÄB.org/fr/",
    "http://a.net/" + "long/" * 30_000,
]


def plain(url):
    if "://" not in (url or ""):
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    stop = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:stop])
    path = rest[stop:].split("?")[0].split("#")[0]
    fits = [r for r in RULES if f".{host}".endswith(f".{r.host}") and path.startswith(r.path)]
    if not fits:
        return host, path, None, "allow"
    best = max(fits, key=lambda r: (len(r.name), r.name, r.verdict))
    return host, path, best.name, best.verdict


def test_rules_equal_a_plain_version(spark):
    rng = random.Random(2)
    hosts, paths = ["net", "example.net", "x.example.com", "b.org", "a.b.org", "other.de"], ["", "/", "/en/", "/en", "/de/x", "/fr/y"]
    urls = URLS + [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?a/b', '#c'])}" for _ in range(200)]
    frame = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls + urls[:3])], "page_id long, url string, rule string")
    for files in (1 << 20, 40):  # one digest file, several
        for row in filter_urls(frame, RULES, max_bytes=files).collect():
            assert (row.host, row.path, row.rule, row.verdict) == plain(row.url), row.url
    assert filter_urls(frame.limit(0), RULES).count() == 0
    assert {r.verdict for r in filter_urls(frame, []).collect()} == {"allow"}


def test_equal_digests_are_told_apart_by_their_strings(tmp_path, monkeypatch):
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda s: len(s))
    path = tmp_path / "digests"
    DigestArray.write([Rule("ab", "", "block"), Rule("cd", "", "allow"), Rule("xyz", "", "block")], path)
    found = DigestArray(path).find([b"cd", b"ab", b"zz", b"xyz", b"q", b"longer"])
    assert (found >= 0).tolist() == [True, True, False, True, False, False]
    assert len(np.unique(found[found >= 0])) == 3
