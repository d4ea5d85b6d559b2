"""Decontamination against exact window similarities computed one by one."""

from __future__ import annotations

import random
import re
from collections import Counter

from starloom.llm import decontaminate as D
from starloom.llm.queries import op2_decontaminate

from tests.conftest import SF0001


def words(text):
    return [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]


def plain(text, item):
    """Best weighted Jaccard of the item with a window of its size."""
    w, v = words(text), words(item)
    if not v:
        return 0.0
    k = min(5, len(v))
    bag = Counter(tuple(v[i:i + k]) for i in range(len(v) - k + 1))
    best = 0.0
    for s in range(max(len(w) - len(v), 0) + 1):
        part = w[s:s + len(v)]
        here = Counter(tuple(part[i:i + k]) for i in range(len(part) - k + 1))
        if here:
            best = max(best, sum((here & bag).values()) / sum((here | bag).values()))
    return best


def flagged(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 AS key", "2 AS words", "3 AS n", "4 AS item_ids")
    i = spark.createDataFrame(items, "item_id long, text string")
    return [(r["doc_id"], r["item_ids"]) for r in D.flag(d, i, **kw).collect()]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()
    want = {}
    for d in docs:
        found = [i["item_id"] for i in items if plain(d["text"], i["text"]) >= 0.8]
        want[d["doc_id"]] = ",".join(map(str, sorted(found))) or None
    assert {r["doc_id"]: r["item_ids"] for r in op2_decontaminate(spark, SF0001).collect()} == want


def test_planted_copies_edits_and_fragments(spark):
    rng = random.Random(4)
    lexicon = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(lexicon, k=rng.choice([3, 5, 8, 20, 40])))) for i in range(25)]
    items += [(100, None), (101, ""), (102, items[0][1])]
    docs = []
    for n in range(60):
        text = " ".join(rng.choices(lexicon, k=rng.randint(0, 120)))
        _, item = rng.choice(items[:25])
        v = item.split()
        cut = rng.choice([0, 0, 1, 2, len(v) // 2])
        edit = [x if rng.random() > 0.02 else "edit" for x in v[cut:]]
        docs.append((n, f"{text}. {' '.join(edit).upper()}, {text}" if n % 3 else text))
    docs += [(900, None), (901, ""), (902, "w1"), (903, docs[1][1]), (903, docs[1][1]), (None, docs[1][1]),
             (904, " ".join(rng.choices(lexicon, k=4000)) + " " + items[5][1])]
    got = Counter((d, i) for d, i in flagged(spark, docs, items))
    want = Counter((d, ",".join(str(i) for i, t in sorted(items) if plain(text, t) >= 0.8) or None)
                   for d, text in docs)
    assert got == want


def test_empty_tables_and_dropping(spark):
    docs = [(1, "one two three four five six"), (2, "nothing here"), (3, None)]
    items = [(7, "one two three four five six")]
    assert flagged(spark, docs, []) != [] and all(i is None for _, i in flagged(spark, docs, []))
    assert flagged(spark, [], items) == []
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "9 AS _key")
    kept = D.drop_contaminated(d, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == ["doc_id", "text", "_key"] and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]


def test_blocks_guarantee_the_radius():
    rng = random.Random(8)
    for radius in (3, 7, 16):
        blocks = D._blocks(radius)
        for _ in range(300):
            x = 0
            for b in rng.sample(range(64), rng.randint(0, radius)):
                x |= 1 << b
            assert any((x >> s) & m == 0 for s, m in blocks)


def test_recall_at_the_similarity(spark):
    """Edits that leave a similarity of 0.8 or little more: of all that the exact comparison
    accepts at least nine in ten are found, also where one shingle carries much weight."""
    rng = random.Random(12)
    items, docs = [], []
    for i in range(60):
        v = [f"w{rng.randrange(10 ** 6)}" for _ in range(120 if i % 3 == 0 else rng.choice([60, 90]))]
        if i % 3 == 0:
            # Many times the same five words, of which an edit removes the repeats.
            v += [f"r{i}"] * 14
        items.append((i, " ".join(v)))
        for copy in range(3):
            best = None
            for _ in range(25):
                at, wide = rng.randrange(len(v)), rng.randint(1, 8)
                edit = [f"e{rng.randrange(10 ** 6)}" if at <= j < at + wide else x for j, x in enumerate(v)]
                share = plain(" ".join(edit), items[-1][1])
                if share >= 0.8 and (best is None or share < best[0]):
                    best = (share, edit)
            if best:
                docs.append((1000 * i + copy, "some words before " + " ".join(best[1]) + " and after"))
        if i % 3 == 0:
            edit = [x if not x.startswith("r") else f"e{j}" for j, x in enumerate(v)]
            docs.append((1000 * i + 9, " ".join(edit)))
    asked = {d for d, t in docs if plain(t, items[d // 1000][1]) >= 0.8}
    got = {d for d, i in flagged(spark, docs, items) if i == str(d // 1000)}
    assert got <= asked and len(asked) >= 150
    assert len(got) >= 0.95 * len(asked), (len(got), len(asked))
    heavy = {d for d in asked if d % 1000 == 9}
    assert len(heavy & got) >= 0.9 * len(heavy), (len(heavy & got), len(heavy))


def test_copies_lay_their_windows_once(spark):
    item = " ".join(f"x{i}" for i in range(30))
    text = f"before {item} after"
    docs = [(n % 50 if n % 7 else None, text) for n in range(500)] + [(1, "clean"), (1, None)]
    got = Counter(flagged(spark, docs, [(5, item)]))
    assert got == Counter((d, "5" if t == text else None) for d, t in docs)
    found = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                           spark.createDataFrame([(5, item)], "item_id long, text string"))
    assert found.count() == 1
