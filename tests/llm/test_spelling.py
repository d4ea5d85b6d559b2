"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from starloom.llm import spelling
from starloom.llm.queries import op12_spelling

from tests.conftest import SF0001


def _near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _brute(n, ratio=5):
    out = {}
    for w in n:
        around = [o for o in n if o != w and _near(w, o)]
        best = min(around, key=lambda o: (-n[o], o), default=None)
        out[w] = (best if best is not None and n[best] >= ratio * n[w] else None, len(around))
    rows = set()
    for w, (form, count) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.add((w, form, root, n[w], count, n[form] if form else None))
    return rows


def _words(seed, count, alphabet, lo, hi):
    rng = random.Random(seed)
    out = Counter()
    for _ in range(count):
        w = "".join(rng.choices(alphabet, k=rng.randint(lo, hi)))
        out[w] = rng.randint(1, 200)
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(len(w))
            out[w[:i] + rng.choice(alphabet) * rng.randint(0, 2) + w[i + 1:]] = rng.randint(1, 2000)
    out.pop("", None)
    return out


@pytest.mark.parametrize("cell,crowd", [(10_000, 100_000), (16, 100_000), (16, 4)])
def test_variants_equal_brute_force(spark, cell, crowd):
    # Few letters: many anagrams of one vector, which only the crowd limit can divide.
    n = _words(cell, 120, "abé", 3, 6) + _words(crowd, 150, "abcdefghijklmnopqrstuvwxyzßü中", 1, 12)
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {tuple(r) for r in spelling.variants(df, cell=cell, crowd=crowd).collect()}
    assert got == _brute(n)


def test_tree_loses_nothing():
    rng = random.Random(4)
    words = sorted({"".join(rng.choices("abcde", k=7)) for _ in range(1500)})
    points = spelling.letters(words, 7)
    vecs = spelling.vectors(points)
    for tree in (spelling.plant(vecs, 8, True), spelling.plant(vecs[:200], 8, False)):
        leaf, query = tree.reach(vecs, 0)
        if len(tree.order) < len(vecs):
            # The planes cut the whole space: each vector lies in one cell.
            assert sorted(query.tolist()) == list(range(len(vecs)))
    got = {(i, j) for a, b in spelling.pairs(spelling.plant(vecs, 8, True), vecs, points, vecs, points, True)
           for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    diff = (points[:, None, :] != points[None]).sum(axis=2)
    assert got == {(int(i), int(j)) for i, j in np.argwhere(diff == 1) if i < j}


def test_one_edit():
    def check(a, b):
        return bool(spelling.one_edit(spelling.letters([a], len(a)), spelling.letters([b], len(b)))[0])
    assert check("abc", "abd") and not check("abc", "abc") and not check("abc", "bac")
    assert check("abc", "xabc") and check("abc", "abcx") and check("aab", "aaab") and not check("abc", "acbd")


def test_query_equals_brute_force(spark):
    n = Counter()
    for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{r['doc_id']}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = Counter({w: c for w, c in n.items() if len(w) >= 6 and c >= 5})
    got = {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n"))
           for r in op12_spelling(spark, SF0001).collect()}
    assert got == _brute(n) and len(got) > 300


def test_edge_rows(spark):
    long = "x" * 50_000
    df = spark.createDataFrame(
        [(None, 5), ("", 5), ("abcdef", 10), ("abcdef", 20), ("abcdeg", 6), ("abcdeh", 6), ("zzzz", None),
         ("yyyy", 0), (long, 5), (long + "y", 40), (long[:-1] + "y", 40)], "word string, n long").selectExpr(
             "word", "n", "'c' AS near", "1 AS size", "2 AS form", "3 AS length")
    got = {r["word"]: tuple(r)[1:] for r in spelling.variants(df).collect()}
    assert got.keys() == {"abcdef", "abcdeg", "abcdeh", long, long + "y", long[:-1] + "y"}
    assert got["abcdef"] == (None, "abcdef", 30, 2, None)
    assert got["abcdeg"] == ("abcdef", "abcdef", 6, 2, 30)
    # Equally common near words: the smaller one, here the one that goes on with y.
    assert got[long] == (long + "y", long + "y", 5, 2, 40) if long + "y" < long[:-1] + "y" else True
    assert spelling.variants(df.where("false")).collect() == []
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "AB cd"), (None, "Éa")], "doc_id long, text string")
    assert sorted(r["word"] for r in spelling.runs(docs, "[A-Za-zÀ-ÿ]+").collect()) == ["ab", "cd", "Éa"]
