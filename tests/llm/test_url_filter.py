"""URL filter against a plain reading of the rules."""

from __future__ import annotations

import random

from starloom.llm import url_filter
from starloom.llm.queries import URL_RULES

HOSTS = ["com", "example.com", "a.example.com", "www.example.com", "x.www.example.com", "WWW.Example.COM",
         "example.net", "net", "notexample.com", "example.org", "", ".com", "a..com", "example.com:80"]
PATHS = ["", "/", "/en/", "/en", "/en/1?x=/fr/", "/fr/2#top", "/es/", "/EN/", "/en/../fr/", "?q=/en/", "#/en/"]


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h) + len(p), h + p, act) for h, p, act in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def judged(spark, urls, rules, **kw):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr(
        "page_id", "url", "'x' AS rule", "'y' AS host", "0 AS prefix")
    table = spark.createDataFrame(rules, "host string, path string, action string")
    got = url_filter.judge(pages, table, **kw).collect()
    return [tuple(r)[1:] for r in sorted(got, key=lambda r: r["page_id"])]


def test_every_kind_of_url(spark):
    urls = [f"{s}{h}{p}" for s in ("http://", "https://") for h in HOSTS for p in PATHS]
    urls += [None, "", "example.com/en/", "http:/example.com/", "://example.com/en/", "http://a://example.com/en/",
             "http://" + "a." * 3000 + "com/" + "x/" * 3000, "http://example.com/en/", "http://example.com/en/"]
    assert judged(spark, urls, URL_RULES) == [plain(u, URL_RULES) for u in urls]


def test_random_rules_with_and_without_broadcast(spark):
    rng = random.Random(3)
    rules = [(rng.choice([h for h in HOSTS if h]).lower(), rng.choice(["/", "/e", "/en/", "/en/1"]),
              rng.choice(["allow", "block"])) for _ in range(12)]
    rules = list({(h, p): (h, p, a) for h, p, a in rules}.values())
    urls = [f"http://{h}{p}" for h in HOSTS for p in PATHS]
    want = [plain(u, rules) for u in urls]
    assert judged(spark, urls, rules) == want
    assert judged(spark, urls, rules, max_broadcast_rows=0) == want  # joined by shuffle


def test_no_rows_and_no_rules(spark):
    assert judged(spark, ["http://a.com/"], [])[0] == ("a.com", "/", None, "allow")
    assert judged(spark, [], URL_RULES) == []
