"""Quality and toxicity: held-out accuracy, and defined results on edge rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from starloom.llm import pu_quality, toxicity
from starloom.llm.queries import op1_pu_quality, op7_toxicity

from tests.conftest import SF001, SF0001

rng = np.random.default_rng(3)
LEXICON = ["".join(rng.choice(list("aeioulmnrst"), 6)) for _ in range(600)]


def prose(n, bad=()):
    out = list(rng.choice(LEXICON, n))
    for w in bad:
        out[rng.integers(n)] = w
    return " ".join(out)


def test_network_learns_words_and_word_parts():
    def toxic():
        return prose(200, ["scoundrel"] * 3) if rng.random() < 0.5 else prose(200, [f"vile{rng.choice(LEXICON)}" for _ in range(4)])
    texts = [toxic() for _ in range(150)] + [prose(200) for _ in range(250)]
    model = toxicity.train(texts, [1] * 150 + [0] * 250, shown=5000)
    scorer = toxicity.Scorer(model)
    bad = scorer.scores([toxic() for _ in range(60)])
    good = scorer.scores([prose(200) for _ in range(120)] + [None, ""])
    assert (bad >= 0.5).mean() > 0.9 and (good >= 0.5).mean() < 0.1
    # One window among many decides, wherever it stands.
    long = prose(5000) + " scoundrel scoundrel " + prose(5000)
    assert scorer.scores([long])[0] >= 0.5
    small = toxicity.Scorer(model, remembered=50, batch=3)  # the word table is dropped and rebuilt
    some = [toxic() for _ in range(5)] + [prose(100), None]
    assert np.allclose(small.scores(some), scorer.scores(some), atol=1e-5)


def test_gradients_are_right():
    p = {k: v.astype(np.float64) for k, v in toxicity._init(np.random.default_rng(1)).items()}
    p = toxicity._init(np.random.default_rng(1))
    g = np.random.default_rng(2)
    rows = g.integers(0, 5, (3, 6)).astype(np.int32)
    rows[:, 0] = 1
    x = g.normal(size=(4, toxicity.DIM)).astype(np.float32)
    y, w = np.array([1, 0, 1], np.float32), np.ones(3, np.float32)

    def loss():
        z = toxicity._forward(rows, toxicity._tables(x, p), p)
        return float(np.sum(np.logaddexp(0, z) - y * z))

    grads, d_x = toxicity._backward(rows, y, w, x, p)
    for name in ("in_f", "rec_b", "att_w", "att_v", "out_w", "bias_f"):
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        old, eps = p[name][at], 1e-2
        p[name][at] = old + eps
        up = loss()
        p[name][at] = old - eps
        down = loss()
        p[name][at] = old
        assert (up - down) / (2 * eps) == pytest.approx(grads[name][at], rel=0.08, abs=5e-3), name
    assert d_x.shape == x.shape


@pytest.mark.parametrize("query,fold,label,least", [(op1_pu_quality, (4, 2), "quality", 0.9),
                                                    (op7_toxicity, (5, 0), "toxic", 0.9)])
def test_held_out_rows(spark, query, fold, label, least):
    got = {r["doc_id"]: r for r in query(spark, SF001).collect()}
    assert len(got) == spark.read.parquet(f"{SF001}/documents.parquet").count()
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % fold[0] == fold[1]) and 0 <= r["score"] <= 1
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    right = [got[i]["predicted"] == y for i, y in labels.items() if got[i]["held_out"]]
    assert np.mean(right) >= least


def test_prior_estimate_and_risk():
    g = np.random.default_rng(5)

    def rows(n, centre):
        # A signal in 40 of the 266 features; in only 4 of them these few rows are not enough.
        x = g.normal(size=(n, pu_quality.FEATURES)) * 0.2
        x[:, :40] += centre
        return x

    pos, good, bad = rows(1500, 1.0), rows(1400, 1.0), rows(600, -1.0)
    unl = np.concatenate([good, bad])[g.permutation(2000)]
    model = pu_quality.train(pos, unl, steps=800)
    assert abs(model.prior - 0.7) < 0.08
    assert (pu_quality.scores(rows(300, 1.0), model) > 0.5).mean() > 0.97
    assert (pu_quality.scores(rows(300, -1.0), model) < 0.5).mean() > 0.97


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "x " * 60_000)], "doc_id long, text string"
                                 ).selectExpr("doc_id", "text", "1 AS score", "2 AS id")
    for model, score in ((pu_quality.train(np.zeros((0, pu_quality.FEATURES)), np.zeros((3, pu_quality.FEATURES))),
                          pu_quality.score), (toxicity.train([], []), toxicity.score)):
        got = score(docs, model).collect()
        assert len(got) == 4 and len({r["score"] for r in got}) == 1
        assert score(docs.where("false"), model).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert toxicity.sample(docs, labels, toxicity.F.lit(True)).base == 0.0
    assert pu_quality.sample(docs, labels, pu_quality.F.lit(True)).p is None


def test_drop_toxic_keeps_columns(spark):
    model = toxicity.Model({}, 0.3)
    docs = spark.createDataFrame([(1, "a", 0.1)], "doc_id long, text string, _score double")
    assert toxicity.drop_toxic(docs, model).collect() == docs.collect()
    assert toxicity.drop_toxic(docs, model, at=0.2).count() == 0


def test_toxic_text_far_inside_a_run_without_blanks_is_scored():
    g = np.random.default_rng(21)
    letters = [chr(0x4E00 + i) for i in range(400)]

    def run_of(n, bad=""):
        out = "".join(g.choice(letters, n))
        for at in sorted(g.integers(100, n - 100, 4).tolist(), reverse=True):
            out = out[:at] + bad + out[at:]
        return out

    bad = "".join(chr(0x9000 + i) for i in range(8))
    texts = [run_of(600, bad) for _ in range(120)] + [run_of(600) for _ in range(200)]
    scorer = toxicity.Scorer(toxicity.train(texts, [1] * 120 + [0] * 200))
    toxic = scorer.scores([run_of(900, bad) for _ in range(40)])
    clean = scorer.scores([run_of(900) for _ in range(40)])
    assert (toxic >= 0.5).mean() >= 0.8 and (clean >= 0.5).mean() < 0.1
    for n in (40, 41, 48, 49, 1000):
        word = "".join(g.choice(letters, n))
        pieces = toxicity.words_of(word)
        assert all(any(word[i:i + 4] in p for p in pieces) for i in range(n - 3))
        assert pieces == [word] if n <= 40 else max(map(len, pieces)) <= 40


def test_training_sees_every_window_and_whole_texts(spark):
    """The toxic passage stands once, past the prefix and between the windows of a sample."""
    g = np.random.default_rng(22)

    def long(bad):
        words = list(g.choice(LEXICON, 4500))
        if bad:
            at = int(g.integers(3200, 4400))
            words[at:at + 4] = ["scoundrel"] * 4
        return " ".join(words)

    rows = [(i, long(i % 2 == 0), int(i % 2 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.sample(df.select("doc_id", "text"), df.select("doc_id", "toxic"), toxicity.F.lit(True))
    scorer = toxicity.Scorer(model)
    assert (scorer.scores([long(True) for _ in range(20)]) >= 0.5).mean() > 0.9
    assert (scorer.scores([long(False) for _ in range(20)]) >= 0.5).mean() < 0.1


def test_chunks_are_all_windows():
    g = np.random.default_rng(23)
    bags = [g.integers(1, 99, n).astype(np.int32) for n in (0, 1, 63, 64, 65, 111, 112, 113, 500, 5000)]
    want = {(k, w.tobytes()) for k, b in enumerate(bags) for w in toxicity._windows(b)}
    for size in (1, 3, 10, 1024):
        got = [(int(o), r.tobytes()) for rows, owner in toxicity._chunks(bags, size) for r, o in zip(rows, owner, strict=True)]
        assert set(got) == want and len(got) == sum(len(toxicity._windows(b)) for b in bags)


def test_every_character_but_white_space_is_read():
    text = "Ab1_c!!! $$$\t\U0001f600\u00e9\u4e2d\u6587 --x " + "#" * 50
    steps = toxicity.words_of(text)
    assert steps[:9] == ["ab1", "_", "c", "!!!", "$$$", "\U0001f600", "\u00e9\u4e2d\u6587", "--", "x"]
    assert set("".join(steps)) == {c for c in text.lower() if not c.isspace()}
    bad, good = ["look $$$ !!! here"] * 40, ["look at all of it here"] * 40
    model = toxicity.train(bad + good, [1] * 40 + [0] * 40, shown=1500)
    a, b, c = toxicity.Scorer(model).scores(["!!! $$$", "look here", ""])
    assert a > 0.5 > b and a > c


def test_a_repeated_id_is_trained_on_one_text(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (2, None), (3, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 0), (3, None)], "doc_id long, toxic int")
    seen = []
    real, toxicity.train = toxicity.train, lambda texts, marks: seen.extend(zip(texts, marks, strict=True))
    try:
        toxicity.sample(docs, labels, toxicity.F.lit(True))
    finally:
        toxicity.train = real
    assert seen == [("", 0), ("c", 0), ("a", 1)]
