"""Hard negatives against brute force; the intervals hold every score."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import hard_negatives as hn
from starloom.llm.queries import op13_hard_negatives

from tests.conftest import SF0001

SCHEMA = "vec_id long, label int, embedding array<long>"


def _brute(rows, every=100, k=5, low=80, high=100):
    """``rows``: (id, label, whole numbers)."""
    out = []
    for i, (a, label, vec) in enumerate(rows):
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(vec, v, strict=True)), r, j, other)
                  for j, (r, other, v) in enumerate(rows) if j != i and len(v) == len(vec)]
        for s, r, _, _ in sorted(x for x in scored if x[3] == label)[:k]:
            fits = sorted(x for x in scored if x[3] != label and low * -s <= 100 * -x[0] <= high * -s)[:k]
            out += [(a, r, rank, x[1], -s, -x[0]) for rank, x in enumerate(fits, 1)]
    return sorted(out)


def _run(spark, rows, **kw):
    got = hn.mine(spark.createDataFrame(rows, SCHEMA), F.col("id") % 100 == 0, **kw).collect()
    return sorted(tuple(r) for r in got)


def _rows(seed, n, d, labels, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, d)) * 60
    out = []
    for i in range(n):
        label = int(rng.integers(labels))
        vec = centres[label if rng.random() < .7 else int(rng.integers(labels))] + rng.normal(size=d) * spread
        out.append((i * 10, label, np.floor(vec).astype(int).tolist()))
    return out


@pytest.mark.parametrize("d,spread,kw", [
    (64, 30, {}), (64, 30, {"block": 40, "anchor_block": 3}), (7, 20, {"block": 50}), (130, 50, {"levels": 2}),
    (1, 5, {}), (3, 1, {"block": 30})])
def test_equals_brute_force(spark, d, spread, kw):
    rows = _rows(d, 230, d, 4, spread)
    assert _run(spark, rows, **kw) == _brute(rows)


def test_intervals_hold_every_score():
    rng = np.random.default_rng(2)
    kept = {}
    for d in (1, 5, 64, 100):
        turn = hn.rotation(d)
        assert np.allclose(turn @ turn.T, np.eye(d))
        vecs = np.floor(rng.normal(size=(400, d)) * rng.choice([0, 1, 40, 1e6], size=(400, 1))).astype(np.int64)
        for levels in (1, 4):
            block = hn.Block(*hn.encode(vecs, levels, turn), vecs, turn)
            for a in vecs[:40]:
                low, high = block.interval(a)
                exact = vecs @ a
                assert (low <= exact).all() and (exact <= high).all()
                assert (block.score(a, np.arange(len(vecs))) == exact).all()
                kept[d, levels] = float((high - low).sum())
    assert kept[64, 4] < kept[64, 1] / 3


def test_query_equals_brute_force(spark):
    rows = []
    for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").orderBy("vec_id").collect():
        if r["label"] is None or r["embedding"] is None or not np.isfinite(np.array(r["embedding"], float)).all():
            continue
        label = (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]
        rows.append((r["vec_id"], label, [int(np.floor(256 * float(x))) for x in r["embedding"]]))
    got = sorted(tuple(r) for r in op13_hard_negatives(spark, SF0001).collect())
    assert got == _brute(rows) and got


def test_edge_rows(spark):
    # Repeated ids and rows, ties, nulls, other lengths, zeros, a lone label, negative scores.
    rows = [(0, 1, [3, 4]), (0, 1, [3, 4]), (1, 1, [3, 4]), (1, 1, [3, 4]), (2, 2, [3, 4]), (3, 2, [3, 4]),
            (4, 2, [3, 3]), (5, 3, [1, 2, 3]), (100, 3, [1, 2, 3]), (6, 1, [1, 2, 3]), (200, 9, [5, 5]),
            (300, 1, [0, 0]), (400, 2, [-9, -9])]
    bad = [(None, 1, [3, 4]), (7, None, [3, 4]), (8, 1, None), (9, 1, [3, None]), (10, 1, [])]
    assert _run(spark, rows + bad) == _brute(rows)
    assert _run(spark, bad) == [] and _run(spark, []) == []
    assert _run(spark, [(100, 1, [1]), (1, 2, [1])]) == []
    odd = spark.createDataFrame(rows, SCHEMA).selectExpr("vec_id", "label", "embedding", "1 AS g", "2 AS id",
                                                         "3 AS codes", "4 AS rank")
    assert sorted(tuple(r) for r in hn.mine(odd, F.col("id") % 100 == 0).collect()) == _brute(rows)


def test_large_numbers(spark):
    big = 1 << 29
    rows = [(100, 1, [big, 1]), (1, 1, [big, 2]), (2, 2, [big, 1]), (3, 2, [big - 1, 5])]
    assert _run(spark, rows) == _brute(rows)
    with pytest.raises(Exception, match="scores beyond a long"):
        _run(spark, [(100, 1, [1 << 40]), (1, 1, [1 << 40]), (2, 2, [1 << 40])])
