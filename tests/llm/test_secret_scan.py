"""Secret scan against Python's regular expressions, and the trigram queries."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from starloom.llm import secret_scan as S
from starloom.llm.queries import secret_columns
from starloom.llm.trigrams import derive

BITS = ["password", "PassWd", "secret", "TOKEN", "api_key", "apikey", "api-key", "=", ":", " ", "  ", "'", '"', "\t",
        "AKIA", "ABCD1234EFGH5678", "0123456789abcdef" * 2, "deadbeef", "short", "longer_value-1", "x", "é", "😀", "\n",
        "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 20, "eyJab.eyJcd.ef", "xoxb-1234567890", "K"]


def plain(text):
    text = text or ""
    out = []
    for i, r in enumerate(S.RULES):
        for m in re.finditer(r.pattern, text):
            if len(m[r.group]) >= r.min_chars:
                out.append((m.start(), i, r.kind, m.end()))
    return sorted(out)


def scanned(spark, texts, rules=S.RULES):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 AS key", "2 AS spans", "3 AS rules", "4 AS gram")
    rows = S.scan(docs, rules=rules).collect()
    return [[tuple(s) for s in r["spans"]] for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_spans_equal_python(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices(BITS, k=rng.randint(0, 25))) for _ in range(300)]
    texts += [None, "", "token='abcdefgh'", "token: 'secret': abcdefghij", "token=" * 400,
              "password=" + "a" * 100_000, "z" * 50_000 + "AKIA" + "B" * 12, "AKIA" + "B" * 11, "f" * 31, "f" * 32]
    assert scanned(spark, texts) == [plain(t) for t in texts]


def test_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "token=abcdefgh"), (1, "token=abcdefgh"), (None, "AKIA" + "C" * 16),
                                  (None, None)], "doc_id long, text string")
    got = S.scan(docs).select("doc_id", *secret_columns(F.col("spans"))).collect()
    assert sorted((r["doc_id"], r["n_assign"], r["n_access"]) for r in got if r["doc_id"]) == [(1, 1, 0)] * 2
    assert sorted(r["spans"] for r in got if r["doc_id"] is None) == ["", "access:0:20"]
    assert S.scan(docs.where("false")).count() == 0


def test_masking(spark):
    docs = spark.createDataFrame([(1, "a token=abcdefgh b", 18), (2, "clean", 5), (3, None, None)],
                                 "doc_id long, text string, n_chars long")
    got = [tuple(r) for r in S.mask(docs).orderBy("doc_id").collect()]
    assert got == [(1, "a [SECRET] b", 12), (2, "clean", 5), (3, None, None)]


def plain_mask(text):
    out, at = "", 0
    for start, _, _, stop in plain(text):
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, stop)
    return out + text[at:]


def test_masking_equals_python_and_keeps_time(spark):
    import time
    rng = random.Random(6)
    texts = ["".join(rng.choices(BITS, k=rng.randint(0, 60))) for _ in range(300)]
    texts += ["token=" + "0123456789abcdef" * 3 + " secret=AKIA" + "B" * 20, "f" * 40,
              " é😀 ".join(f"{i:032x}" for i in range(16_000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    t0 = time.time()
    got = {r["doc_id"]: r["text"] for r in S.mask(docs).collect()}
    assert got == {i: plain_mask(t) for i, t in enumerate(texts)}
    assert time.time() - t0 < 40


def test_trigram_queries_hold_for_every_match():
    rng = random.Random(9)
    patterns = [r.pattern for r in S.RULES] + [r"(?i)foo(bar)?baz", r"a(bc|de)+fgh", r"x?yzab{2}c", r"[ab]cd[xyz]{3}"]
    for p in patterns:
        query = derive(p)
        for _ in range(400):
            t = "".join(rng.choices([*BITS, "foo", "bar", "baz", "abc", "fgh", "yzabbc", "acdxyz"], k=12))
            if query is not None and re.search(p, t):
                low = t.lower()
                assert any(all(g in low for g in conj) for conj in query), (p, t)
    assert derive(r"[0-9a-f]{32,}") is None and derive("ab") is None
    assert derive("hello") == [["ell", "hel", "llo"]]


def test_documents_of_a_hot_trigram(spark):
    """A trigram that every document holds, in many blocks."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('key token ', if(id % 10 = 0, '= abcdefgh', '')) AS text")
    base = docs.selectExpr("doc_id AS id", "text")
    assert S.candidates(base, S.RULES, block_rows=64).where("array_contains(rules, 0)").count() == 3000
    assert S.scan(docs).where("size(spans) > 0").count() == 300


def test_very_many_hits_in_one_text(spark):
    import time
    n = 16_000
    text = " ".join(f"{i:032x}" for i in range(n))
    docs = spark.createDataFrame([(1, text), (2, "f" * 32), (3, f"{'a' * 32} {'b' * 31} {'c' * 40}")],
                                 "doc_id long, text string")
    t0 = time.time()
    got = {r["doc_id"]: [(s["start"], s["stop"]) for s in r["spans"]] for r in S.scan(docs).collect()}
    assert got[1] == [(33 * i, 33 * i + 32) for i in range(n)]
    assert got[2] == [(0, 32)] and got[3] == [(0, 32), (65, 105)]
    assert time.time() - t0 < 30
