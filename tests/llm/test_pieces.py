"""SentencePiece ids, texts and spans equal the sentencepiece library's."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from starloom.llm import pieces
from starloom.llm.queries import op11_sentencepiece, piece_model

from tests.conftest import SF0001

ALPHABET = [chr(c) for c in [*range(128), 0xA0, 0xE9, 0x300, 0x301, 0x3000, 0x4E2D, 0x1F600, 0x2581, 0xFB01, 0xFF21,
                             0x2028, 0xAC00, 0x1100, 0x1161, 0xFFFD, 0x200B, 0xFEFF]]
WORDS = ["the", "quick", "brown", "jumps", "über", "naïve", "中文字符", "hello", "1234", "0xdeadbeef", "foo_bar\tx\ny",
         "ａｂｃ", "ﬁne", "Å", "éa", "", "", "."]


def _spec():
    spec = proto.ModelProto()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        spec.ParseFromString(f.read())
    return spec


def _texts(rng, k):
    for _ in range(k):
        yield "".join(rng.choices(ALPHABET, k=rng.randint(0, 50)))
        yield " ".join(rng.choices(WORDS, k=rng.randint(0, 30)))
    for c in ("a", " ", "=", "\n", "中", "▁", "é"):
        for n in (1, 2, 3, 17, 500):
            yield c * n


def _check(spec, k, seed=1):
    library = sentencepiece.SentencePieceProcessor()
    library.LoadFromSerializedProto(spec.SerializeToString())
    model = pieces.read(spec)
    coder, back = pieces.Encoder(model, remembered=50), pieces.Decoder(model)
    rng = random.Random(seed)
    texts = list(_texts(rng, k))
    for t, found in zip(texts, coder.encode_all(texts), strict=True):
        ids, begins, ends = (x.tolist() for x in found)
        assert ids == coder.encode(t)[0].tolist()
        assert ids == library.encode(t, add_eos=True), t
        spans = library.encode(t, return_type="offset_mapping", return_bytes=True)["offsets"]
        size = len(t.encode())
        assert list(zip(begins, ends, strict=True)) == [*map(tuple, spans), (size, size)], t
        assert back.decode(ids) == library.decode(ids), t
    lists = []
    for _ in range(400):
        ids = [rng.choice([0, 1, 2, 35, rng.randint(3, 258), rng.randint(3, 258), 28705, rng.randint(259, 31999)])
               for _ in range(rng.randint(0, 8))]
        assert back.decode(ids) == library.decode(ids), ids
        lists.append(ids)
    flat = np.array([i for ids in lists for i in ids], np.int32)
    assert back.decode_all(flat, np.cumsum([0, *map(len, lists)]).tolist()) == [back.decode(ids) for ids in lists]


def test_given_model_equals_library():
    _check(_spec(), 700)


@pytest.fixture(scope="module")
def compiled():
    """A compiled character map with 226,684 rules, as the library ships it."""
    made = proto.ModelProto()
    made.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc_cf").serialized_model_proto())
    return made.normalizer_spec.precompiled_charsmap


@pytest.mark.parametrize("drop,front,last", [(True, True, False), (False, True, False), (True, False, False),
                                             (True, True, True), (False, True, True)])
def test_character_map_equals_library(compiled, monkeypatch, drop, front, last):
    rules = _rules(compiled)
    monkeypatch.setattr(pieces, "character_map", lambda blob: rules)
    spec = _spec()
    n = spec.normalizer_spec
    n.precompiled_charsmap, n.remove_extra_whitespaces, n.add_dummy_prefix = compiled, drop, front
    spec.trainer_spec.treat_whitespace_as_suffix = last
    _check(spec, 80, seed=drop * 4 + front * 2 + last)


_known: dict[bytes, dict] = {}
_character_map = pieces.character_map


def _rules(blob):
    if blob not in _known:
        _known[blob] = _character_map(blob)
    return _known[blob]


def test_character_map_is_read_whole(compiled):
    rules = _rules(compiled)
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc_cf")
    some = random.Random(3).sample(sorted(k for k in rules if "\0" not in k), 300)
    for key in some:
        assert library.normalize(key).strip("▁ ").replace("▁", " ") == rules[key].strip(), key
    assert pieces.character_map(b"") == {}


def test_pieces_that_hold_blanks_are_not_cut():
    cut = pieces.cutter(["ab", "a▁b", "▁a"])
    assert cut("ab▁b") == ["ab▁b"] and cut("") == []
    assert pieces.cutter(["ab", "▁a", ".."])("▁ab..c▁▁") == ["▁ab", "..", "c", "▁▁"]


def test_query_equals_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in op11_sentencepiece(spark, SF0001).collect()}
    assert got.keys() == docs.keys()

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    for i, text in docs.items():
        ids = library.encode(text or "", add_eos=True)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (
            len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))
        spans = library.encode(text or "", return_type="offset_mapping", return_bytes=True)["offsets"]
        ends = [*[e for _, e in spans], len((text or "").encode())]
        assert got[i]["ends_sha256"] == sha(" ".join(map(str, ends)))


def test_edge_rows(spark):
    m = piece_model()
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a" * 100_000), (3, "a" * 100_000), (None, "x")],
                                 "doc_id long, text string").selectExpr("doc_id", "text", "1 AS ids", "2 AS id")
    rows = pieces.decode(pieces.encode(docs, m), m).collect()
    assert sorted((r["doc_id"] or 0, r["ids"][-1], len(r["text"])) for r in rows) == [
        (0, 2, 1), (1, 2, 0), (2, 2, 0), (3, 2, 100_000), (3, 2, 100_000)]
    spans = {r["doc_id"]: (r["begins"], r["ends"]) for r in pieces.encode(docs, m, end=False).collect()}
    assert spans[1] == ([], []) and spans[2] == ([], []) and spans[3][1][-1] == 100_000
    assert pieces.encode(docs.where("false"), m).count() == 0


def test_unsupported_models_are_rejected():
    spec = _spec()
    spec.pieces[300].type = 4
    with pytest.raises(ValueError, match="user-defined"):
        pieces.read(spec)
    spec = _spec()
    spec.trainer_spec.byte_fallback = False
    with pytest.raises(ValueError, match="byte fallback"):
        pieces.read(spec)
