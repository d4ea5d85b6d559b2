"""License scan: alignment properties and planted notices."""

from __future__ import annotations

import random
from collections import Counter

from starloom.llm import licenses as L
from starloom.llm.queries import op8_licenses

from tests.conftest import SF001


def test_alignment_is_rising_and_equal():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.randint(0, 12) for _ in range(rng.randint(0, 20))]
        b = [rng.randint(0, 12) for _ in range(rng.randint(0, 20))]
        got = L.align(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:], strict=False))
    assert L.align([1, 2, 3], [1, 2, 3]) == [(0, 0), (1, 1), (2, 2)]
    assert len(L.align([1, 2, 3, 4, 5], [9, 1, 2, 9, 4, 5, 9])) == 4


def test_longest_rising_chain():
    rng = random.Random(2)
    for _ in range(200):
        pairs = list(enumerate(rng.sample(range(30), rng.randint(0, 9))))
        best = 0
        for mask in range(1 << len(pairs)):
            js = [pairs[k][1] for k in range(len(pairs)) if mask >> k & 1]
            if js == sorted(js):
                best = max(best, len(js))
        got = L._rising(pairs)
        assert len(got) == best and [j for _, j in got] == sorted(j for _, j in got)


def found(text, **kw):
    return L.Scanner(L.TEMPLATES, kw.get("coverage", 0.8)).find(text)


def test_planted_notices():
    rng = random.Random(3)
    filler = [f"word{i}" for i in range(300)]
    for name, notice in L.TEMPLATES:
        for n in (0, 5, 400):
            head = " ".join(rng.choices(filler, k=n))
            text = f"{head}\n{notice.upper()}\n{head}"
            got = found(text)
            assert (name, 1.0) in [(g[0], g[1]) for g in got]
            start, stop = next(g[2:] for g in got if g[0] == name)
            assert L._word.findall(text[start:stop].lower()) == L._word.findall(notice.lower())
    assert found("İ Released under the MIT License.")[0][0] == "MIT"
    assert found(None) == found("") == found("the license of this work") == []
    twice = "Released under the MIT License. " * 3
    assert [g[0] for g in found(twice)] == ["MIT"]


def test_query_on_the_given_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in op8_licenses(spark, SF001).collect()}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        want = [n for n, t in L.TEMPLATES if " ".join(L._word.findall(t.lower())) in " ".join(L._word.findall(text.lower()))]
        assert set(want) <= set(got[i]["licenses"].split(",") if got[i]["licenses"] else [])


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (2, "x"), (None, "Released under the MIT License.")],
                               "doc_id long, text string").selectExpr("*", "1 AS found", "2 AS id")
    assert sorted(len(r["found"]) for r in L.scan(df).collect()) == [0, 0, 0, 1]
    assert L.scan(df.where("false")).count() == 0
    assert [len(r["found"]) for r in L.scan(df, templates=[("none", "")]).collect()] == [0] * 4


def test_every_place_of_a_notice(spark):
    filler = " ".join(f"word{i}" for i in range(20))
    texts = dict(L.TEMPLATES)
    cases = [["CC-BY-NC-4.0", "CC-BY-4.0"], ["Apache-2.0-header", "Apache-2.0"], ["MIT", "MIT", "MIT"],
             ["BSD", "MIT", "BSD", "GPL-2.0", "GPL-3.0"], ["CC-BY-4.0", "CC-BY-SA-4.0"] * 3]
    rows = []
    for gap in (f" {filler} ", " "):
        for names in cases:
            rows.append((len(rows), gap.join(texts[n] for n in names), sorted(names)))
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r["doc_id"]: r["found"] for r in L.scan(df).collect()}
    for i, text, names in rows:
        assert sorted(f["template"] for f in got[i]) == names, text
        assert all(L._word.findall(text[f["start"]:f["stop"]].lower()) == L._word.findall(texts[f["template"]].lower())
                   for f in got[i])


def test_stretched_notices_at_every_offset():
    """Foreign words between, words of the notice beside it: found wherever it stands."""
    rng = random.Random(11)
    filler = [f"word{i}" for i in range(50)]
    scanner = L.Scanner(L.TEMPLATES, 0.8)
    for name in ("Apache-2.0-header", "BSD", "MPL-2.0-header", "ISC"):
        notice = L._word.findall(dict(L.TEMPLATES)[name].lower())
        for added in (7, len(notice) // 2, len(notice) - 1):
            body = list(notice)
            for _ in range(added):
                body.insert(rng.randint(1, len(body) - 1), rng.choice(filler))
            for offset in range(0, 2 * len(notice) + 1):
                text = " ".join(rng.choices(filler, k=offset) + body + rng.choices(filler, k=rng.randint(0, 40)))
                assert name in [f[0] for f in scanner.places(text)], (name, added, offset)


def test_equal_to_alignment_over_all_windows():
    """A notice is found exactly where some stretch of a text, aligned on its own, reaches the threshold."""
    rng = random.Random(13)
    seen = Counter()
    for _ in range(150):
        template = [rng.choice("abcdefghijklmnop") for _ in range(rng.randint(4, 10))]
        n = len(template)
        scanner = L.Scanner([("t", " ".join(template))], 0.8)
        part = [w for w in template if rng.random() > 0.08]
        text = [rng.choice("abcdefghxyz") for _ in range(rng.randint(0, 25))]
        for w in part:
            text += [w] + [rng.choice("abxyz")] * rng.choice([0, 0, 0, 1])
        text += [rng.choice("abcdefghxyz") for _ in range(rng.randint(0, 25))]
        number = [scanner.number.get(w, 0) for w in text]
        numbers = scanner.templates[0][1]
        want = any(len(L.align(numbers, number[i:i + s])) >= 0.8 * n
                   for s in (2 * n, n + n // 4) for i in range(max(len(text) - s, 0) + 1))
        got = scanner.places(" ".join(text))
        seen[want, bool(got)] += 1
        assert bool(got) or not want, (template, text)
        for _, share, _, _ in got:
            assert share >= 0.8
    assert seen[True, True] > 30 and seen[False, False] > 5


def test_full_texts_win_over_their_parts():
    texts = dict(L.TEMPLATES)
    for name in ("MIT-full", "BSD-2-Clause", "BSD-3-Clause", "GPL-3.0-header", "GPL-2.0-header", "AGPL-3.0-header", "Apache-2.0-header"):
        assert [f[0] for f in L.Scanner(L.TEMPLATES, 0.8).places(f"x {texts[name]} y")] == [name]
