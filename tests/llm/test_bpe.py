"""BPE ids and texts equal the tokenizers library's."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starloom.llm import bpe
from starloom.llm.queries import op10_bpe, vocabulary

from tests.conftest import SF0001

ALPHABET = [chr(c) for c in [*range(128), 0x85, 0xA0, 0x1680, 0x200B, 0x2028, 0x3000, 0xE9, 0x130, 0x4E2D, 0x1F600,
                             0x300, 0xFEFF, 0x661, 0x2160, 0xB2]]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_encoder_equals_library(library):
    rng = random.Random(2)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 60))) for _ in range(1500)]
    texts += [t[:9] + "<|endoftext|>" * rng.randint(1, 2) + t[9:] for t in texts[:150]]
    texts += [c * n for c in ("a", " ", "\n", "é", "0", "\r\n ") for n in (1, 2, 3, 60, 500)]
    coder = bpe.Encoder(vocabulary(), remembered=300, pairs=8)
    for lo in range(0, len(texts), 200):
        some = texts[lo:lo + 200]
        for t, packed in zip(some, coder.encode_all(some), strict=True):
            ids = library.encode(t, add_special_tokens=False).ids
            assert np.frombuffer(packed, np.int32).tolist() == ids
            assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert coder.encode(texts[0]).tolist() == library.encode(texts[0], add_special_tokens=False).ids
    assert coder.decode([162, 120, 198]) == library.decode([162, 120, 198], skip_special_tokens=False)


def test_query_equals_library(spark, library):
    import hashlib
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in op10_bpe(spark, SF0001).collect()}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        ids = library.encode(text, add_special_tokens=False).ids
        out = library.decode(ids, skip_special_tokens=False)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(out.encode()).hexdigest())


def test_edge_rows(spark):
    v = vocabulary()
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a" * 100_000), (3, "a" * 100_000), (None, "x")],
                                 "doc_id long, text string").selectExpr("doc_id", "text", "1 AS ids", "2 AS id")
    rows = bpe.decode(bpe.encode(docs, v), v).collect()
    assert sorted((r["doc_id"] or 0, len(r["ids"]), len(r["text"])) for r in rows) == [
        (0, 1, 1), (1, 0, 0), (2, 0, 0), (3, 25_000, 100_000), (3, 25_000, 100_000)]
    assert bpe.encode(docs.where("false"), v).count() == 0


def test_ambiguous_vocabulary_is_rejected(tmp_path):
    import json
    path = tmp_path / "v.json"
    path.write_text(json.dumps({"model": {"vocab": {"a": 0, "b": 1, "ab": 2, "ba": 3, "aba": 4},
                                          "merges": [["a", "b"], ["b", "a"], ["ab", "a"], ["a", "ba"]]}}))
    with pytest.raises(ValueError, match="two merges"):
        bpe.load(str(path))


def test_a_worker_fetches_the_vocabulary_once(monkeypatch):
    monkeypatch.setattr(bpe, "_encoders", {})
    v = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    first = bpe._encoder("a", lambda: v)
    assert bpe._encoder("a", lambda: 1 / 0) is first and first.v is v
    assert bpe._encoder("b", lambda: v) is not first and len(bpe._encoders) == 1


def test_the_query_has_one_worker_a_task_and_the_operators_results(spark):
    v = vocabulary()
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "ab <|endoftext|> caf\u00e9  x"), (3, "a" * 100_000), (None, "x")],
                                 "doc_id long, text string").selectExpr("doc_id", "text", "1 AS ids", "2 AS id")
    both = bpe.encode_decode(docs, v)
    want = bpe.decode(bpe.encode(docs, v), v)
    assert both.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, both.collect())) == sorted(map(str, want.collect()))
    assert both.where("false").count() == 0
    plan = op10_bpe(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
