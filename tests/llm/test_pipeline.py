"""The corpus pipeline: every stage on its own input, and the whole against single pieces."""

from __future__ import annotations

import hashlib
import os

import corpus_pipeline as C
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starloom.llm import toxicity
from starloom.llm.common import roots
from starloom.llm.queries import queries, toxicity_model

from tests.conftest import SF0001
from tests.llm.test_decontaminate import plain as similarity
from tests.llm.test_secret_scan import plain as secrets
from tests.llm.test_simhash import plain_components, plain_fingerprint

EDGE = [(1, None), (2, ""), (3, "clean words of a short text"), (4, "clean words of a short text"),
        (5, "my token = abcdefghijk is here"), (None, "no id"), (6, "x " * 30_000), (6, "x " * 30_000)]


def test_run_equals_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    items = [r["text"] for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    scorer = toxicity.Scorer(toxicity_model(spark, SF0001))
    scores = dict(zip(docs, scorer.scores(list(docs.values())), strict=True))
    left = {i: t for i, t in docs.items() if scores[i] < 0.5}
    parts = plain_components([(i, plain_fingerprint(t)) for i, t in left.items()])
    left = {i: left[i] for i, _, c in parts if i == c}
    left = {i: t for i, t in left.items() if max(similarity(t, x) for x in items) < 0.8}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for i, t in left.items():
        at, out = 0, ""
        for start, _, _, stop in secrets(t):
            if start >= at:
                out += t[at:start] + "[SECRET]"
            at = max(at, stop)
        ids = library.encode(out + t[at:], add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in C.run(spark, SF0001).collect()}
    assert got == want


@pytest.mark.parametrize("name,stage", C.STAGES)
def test_stages_on_edge_rows(spark, name, stage):
    docs = spark.createDataFrame(EDGE, "doc_id long, text string").selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars", "1 AS _key", "2 AS _score",
        "3 AS component_id", "4 AS _spans")
    out = stage(spark, docs, SF0001)
    rows = out.collect()
    if name != "bpe":
        assert out.columns == docs.columns
    if name == "simhash_dedup":
        # Null and empty texts are copies of each other, the rest by text.
        assert sorted(str(r["doc_id"]) for r in rows) == ["1", "3", "5", "6", "None"]
    elif name == "secrets":
        assert [r["text"] for r in rows if r["doc_id"] == 5] == ["my [SECRET] is here"] and len(rows) == len(EDGE)
    elif name != "toxicity":
        assert len(rows) == len(EDGE)
    assert stage(spark, docs.where("false"), SF0001).count() == 0


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in C.STAGES] == ["toxicity", "simhash_dedup", "decontaminate", "secrets", "bpe"]
    assert sorted(int(q[2:].split("_")[0]) for q in queries()) == list(range(1, 14))


def test_no_other_module_needs_the_operators():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(os.path.join(root, "starloom")):
        if not folder.endswith("llm"):
            for n in names:
                if n.endswith(".py"):
                    assert "starloom.llm" not in open(os.path.join(folder, n)).read(), n


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))]
    edges += [(i, i + 1) for i in range(1000, 1100)] + [(5000, 6000 + i) for i in range(200)] + [(7, 7)]
    home = {}
    for a, b in edges:
        if a != b:
            home.setdefault(a, a)
            home.setdefault(b, b)

    def find(v):
        while home[v] != v:
            v = home[v]
        return v

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            home[y] = x
    got = {r["v"]: r["root"] for r in roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: find(v) for v in home}
    assert roots(spark.createDataFrame([], "a long, b long")).count() == 0
