"""Embedding links and components against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from starloom.llm import embedding_dedup as E
from starloom.llm.queries import op6_embedding_dedup

from tests.conftest import SF0001


def plain(ids, vectors, cosine=0.9):
    x = [None if v is None else np.array([np.nan if c is None else c for c in v], float) for v in vectors]
    ok = [v is not None and len(v) > 0 and bool(np.isfinite(v).all()) and bool((v != 0).any()) for v in x]
    unit = [v / np.abs(v).max() if o else None for v, o in zip(x, ok, strict=True)]
    unit = [v / np.linalg.norm(v) if v is not None else None for v in unit]
    near = [[j for j in range(len(x)) if j != i and ok[i] and ok[j] and len(x[i]) == len(x[j])
             and float(unit[i] @ unit[j]) >= cosine - 1e-12] for i in range(len(x))]
    comp = list(range(len(x)))
    for i in range(len(x)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        named = [ids[j] for j in seen if ids[j] is not None]
        comp[i] = min(named) if named else None
    return sorted(((ids[i], len(near[i]), comp[i]) for i in range(len(x))), key=repr)


def run(spark, ids, vectors, **kw):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in zip(ids, vectors, strict=True)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS g", "2 AS code", "3 AS id")
    return sorted((tuple(r) for r in E.group(df, **kw).collect()), key=repr)


def clusters(seed, n=12, d=24):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        c = rng.normal(size=d)
        size = int(rng.choice([1, 2, 5, 30]))
        out += [c + rng.normal(scale=0.05, size=d) for _ in range(size)] + [c] * int(rng.choice([0, 1, 9]))
    return [v.astype(np.float32) for v in out]


@pytest.mark.parametrize("limits", [{}, {"block": 7, "crowd": 5}])
def test_links_equal_all_pairs(spark, limits):
    vectors = clusters(1)
    ids = list(np.random.default_rng(2).permutation(len(vectors)) * 3 + 1)
    ids = [int(i) for i in ids]
    got, want = run(spark, ids, vectors, **limits), plain(ids, [v.tolist() for v in vectors])
    assert got == want


def test_edge_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [], [0.0, 0.0], [nan, 1.0], [1.0, None], [inf, 1.0], [1.0, 0.0], [2.0, 0.0], [1.0, -0.0],
               [1.0, 0.0], [1e38, 1e30], [1.0], [3.0], [0.0, 1.0]]
    ids = [10, 11, 12, 13, 14, 15, 16, 17, 18, None, 20, 21, 22, 23]
    assert run(spark, ids, vectors) == plain(ids, vectors)
    assert run(spark, [], []) == []
    assert run(spark, [4, 5], [None, [0.0]]) == [(4, 0, 4), (5, 0, 5)]


def test_recall_of_the_query(spark):
    rows = spark.read.parquet(f"{SF0001}/embeddings.parquet").collect()
    want = plain([r["vec_id"] for r in rows], [r["embedding"] for r in rows])
    got = {r["vec_id"]: r for r in op6_embedding_dedup(spark, SF0001).collect()}
    assert got.keys() == {i for i, _, _ in want}
    assert sum(r["n_links"] for r in got.values()) >= 0.9 * sum(n for _, n, _ in want)
    assert all(got[i]["n_links"] <= n for i, n, _ in want)


def test_recall_at_the_threshold():
    """Pairs just above the threshold: the share whose codes are within the radius, which the
    tables guarantee to find."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(4000, 64))
    mean, projection = E.learn(E._unit(base))
    for noise, least in ((0.1, 0.99), (0.2, 0.99), (0.4, 0.85)):
        other = base + noise * rng.normal(size=base.shape)
        a, b = E.codes(E._unit(base), mean, projection), E.codes(E._unit(other), mean, projection)
        far = np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64))
        assert (far <= E.RADIUS).mean() >= least


@pytest.mark.parametrize("common", [0.0, 0.3, 0.5])
def test_pairs_just_above_the_threshold_link(spark, common):
    """Planted pairs at cosine 0.90 to 0.92, also where all vectors share a direction."""
    rng = np.random.default_rng(8)
    n, d = 1500, 64
    top = np.zeros(d)
    top[0] = np.sqrt(common)

    def rest(x):
        x[:, 0] = 0
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    a, u = rest(rng.normal(size=(n, d))), rng.normal(size=(n, d))
    u = rest(u)
    u = rest(u - (u * a).sum(axis=1, keepdims=True) * a)
    inner = 1 - (1 - rng.uniform(0.901, 0.92, size=(n, 1))) / (1 - common)
    b = inner * a + np.sqrt(1 - inner * inner) * u
    x, y = (top + np.sqrt(1 - common) * v for v in (a, b))
    got = run(spark, list(range(2 * n)), np.concatenate([x, y]).tolist())
    assert np.mean([links > 0 for _, links, _ in got]) >= 0.9
    learned, recall = E.enough(E._unit(np.concatenate([x, y])), 0.9)
    assert recall >= E.RECALL and len(learned) <= E.CODES


def test_a_mean_that_hides_the_links_is_compared_in_full(spark):
    rng = np.random.default_rng(9)
    vectors = (10 + rng.normal(size=(60, 8)) * 4).tolist()
    ids = list(range(60))
    assert run(spark, ids, vectors) == plain(ids, [np.array(v, np.float32).tolist() for v in vectors])


def test_pairs_of_every_length_link(spark):
    """Vectors of several lengths in one table: each length has its own recall."""
    rng = np.random.default_rng(11)
    vectors, lengths = [], []
    for d, n in ((64, 600), (24, 300), (8, 300), (48, 40)):
        a, u = rng.normal(size=(n, d)), rng.normal(size=(n, d))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        u -= (u * a).sum(axis=1, keepdims=True) * a
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        c = rng.uniform(0.901, 0.92, size=(n, 1))
        vectors += a.tolist() + (c * a + np.sqrt(1 - c * c) * u).tolist()
        lengths += [d] * 2 * n
    got = run(spark, list(range(len(vectors))), vectors)
    linked = np.array([links > 0 for _, links, _ in sorted(got)])
    for d in set(lengths):
        assert linked[np.array(lengths) == d].mean() >= 0.9


@pytest.mark.parametrize("inner", [True, False])
def test_part_links_equal_all_pairs(inner):
    """Members, a second cut or visitors of a part against every pair of them."""
    rng = np.random.default_rng(12)
    for sides in ((0,), (0, 2), (0, 1)):
        n = 300
        words = rng.integers(0, 1 << 62, size=(n, E.VERIFY)).astype(np.uint64)
        words[1::2] = words[::2] ^ (np.uint64(1) << rng.integers(0, 60, size=(n // 2, E.VERIFY)).astype(np.uint64))
        key = (words[:, 0] & np.uint64(255)).astype(np.int64)
        side = rng.choice(sides, size=n)
        home = E._part_links(key, words, side, inner, E._masks(8, 1), 40)
        want = np.arange(n)
        for i in range(n):
            for j in range(n):
                pair = {int(side[i]), int(side[j])}
                allowed = (inner and 1 not in sides) if pair == {0} else 0 in pair
                if (allowed and int(key[i] ^ key[j]).bit_count() <= 1
                        and int(np.bitwise_count(words[i] ^ words[j]).sum()) <= 40):
                    a, b = want[i], want[j]
                    want[want == max(a, b)] = min(a, b)
        assert home.tolist() == want.tolist()


def test_crowded_parts_find_the_same(spark):
    """Parts cut into few members and visitors, and tables dealt by upper bits."""
    rng = np.random.default_rng(13)
    centres = rng.normal(size=(40, 32))
    vectors = (np.repeat(centres, 8, axis=0) + rng.normal(scale=0.12, size=(320, 32))).tolist()
    ids = list(range(320))
    want = plain(ids, [np.array(v, np.float32).tolist() for v in vectors])
    for crowd in (1 << 14, 16, 2):
        assert run(spark, ids, vectors, crowd=crowd) == want
