"""SimHash near-duplicates against an all-pairs count of differing bits."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from starloom.llm import simhash_dedup as S
from starloom.llm.queries import op5_simhash_dedup

from tests.conftest import SF0001


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = ([" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3
                else [" ".join(words)])
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows):
    """rows of (id, fp): component id of each by union-find over all pairs."""
    fps = sorted({fp for _, fp in rows})
    home = {f: f for f in fps}

    def find(f):
        while home[f] != f:
            home[f] = home[home[f]]
            f = home[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                home[find(a)] = find(b)
    least = {}
    for d, fp in rows:
        if d is not None:
            least[find(fp)] = min(d, least.get(find(fp), d))
    return sorted(((d, format(fp, "016x"), least.get(find(fp))) for d, fp in rows), key=repr)


def grouped(df, **kw):
    return sorted(((r["id"], r["fp"], r["component_id"]) for r in S.group(df, **kw).select(
        "id", S.hex_digits(S.F.col("fp")).alias("fp"), "component_id").collect()), key=repr)


def test_query_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()
    want = plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in docs])
    got = sorted((tuple(r) for r in op5_simhash_dedup(spark, SF0001).select(
        "doc_id", "fingerprint", "component_id").collect()), key=repr)
    assert got == want


def test_edge_rows(spark):
    texts = [(5, None), (3, ""), (9, " \t\n"), (1, "One"), (2, "one"), (4, "a b"), (None, "A  B"),
             (7, "é É x y"), (7, "é É x y"), (8, "w " * 5000), (None, "q r s t u")]
    df = spark.createDataFrame(texts, "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 AS fp", "2 AS key", "3 AS component_id")
    assert grouped(df) == plain_components([(d, plain_fingerprint(t)) for d, t in texts])
    assert grouped(df.where("false")) == []


@pytest.mark.parametrize("limit", [4096, 8])
def test_links_of_dense_fingerprints(spark, limit):
    """Chains and dense groups, with and without the finer cut of crowded values."""
    rng = random.Random(limit)
    fps = set()
    for _ in range(30):
        centre = rng.getrandbits(64)
        fps.add(centre)
        for _ in range(rng.choice([1, 3, 40])):
            x = centre
            for _ in range(rng.randint(1, 6)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    base = rng.getrandbits(64)
    fps |= {base ^ rng.getrandbits(12) for _ in range(200)} | {base ^ (rng.getrandbits(12) << 32) for _ in range(200)}
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = [(r["a"], r["b"]) for r in S.links(df, bucket_limit=limit).collect()]
    mask = (1 << 64) - 1
    want = {c for _, c in _classes(sorted(fps), lambda a, b: (a ^ b).bit_count() <= 3)}
    linked = {(a & mask, b & mask) for a, b in edges}
    got = {c for _, c in _classes(sorted(fps), lambda a, b: (a, b) in linked or (b, a) in linked)}
    assert got == want


def _classes(items, linked):
    home = list(range(len(items)))

    def find(i):
        while home[i] != i:
            i = home[i]
        return i

    for i in range(len(items)):
        for j in range(i + 1, len(items)):
            if linked(items[i], items[j]) and find(i) != find(j):
                home[find(j)] = find(i)
    out = {}
    for i, x in enumerate(items):
        out.setdefault(find(i), []).append(x)
    return [(k, tuple(v)) for k, v in out.items()]


def test_link_partition_over_batches():
    """The result does not depend on where record batches are cut."""
    import pyarrow as pa
    rng = np.random.default_rng(1)
    fp = np.unique(rng.integers(0, 1 << 12, 600)).astype(np.int64)
    part, key = np.zeros(len(fp), np.int32), fp >> 9
    near = rng.random(len(fp)) < 0.5
    order = np.lexsort((near, key))
    cols = [pa.array(part[order]), pa.array(key[order]), pa.array(near[order]), pa.array(fp[order])]
    batch = pa.RecordBatch.from_arrays(cols, names=["part", "key", "near", "fp"])

    def pairs(step):
        cut = (batch.slice(i, step) for i in range(0, batch.num_rows, step))
        out = [b.to_pydict() for b in S._link_partition(cut, 3)]
        edges = {(a, b) for d in out for a, b in zip(d["a"], d["b"], strict=True)}
        return {c for _, c in _classes(sorted(fp.tolist()), lambda a, b: (a, b) in edges or (b, a) in edges)}

    assert pairs(1000) == pairs(7) == pairs(1) == pairs(64)


def test_keep_one_of_each_component_whatever_the_ids(spark):
    """Null ids and repeated ids do not make one component of unrelated texts."""
    rng = random.Random(12)
    a, b, c, d = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(4))
    rows = [(None, a), (None, b), (None, b), (7, c), (7, d), (9, d), (8, c), (None, c), (7, c)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS component")
    got = S.keep_one(df)
    assert got.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted(
        [(None, a), (None, b), (7, c), (7, d)], key=repr)
