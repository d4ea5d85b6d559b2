"""Document quality by positive-unlabelled learning.

A small network (one hidden layer, numpy) is trained on trusted positives and unlabelled
web text only; labels of bad documents are never used. With the class prior ``pi`` of good
documents among the unlabelled ones it minimises the non-negative unbiased risk

    pi * mean_P loss(f, +1) + max(0, mean_U loss(f, -1) - pi * mean_P loss(f, -1))

(when the second part turns negative in a batch, its gradient is walked back instead).
``pi`` is estimated first: a classifier of positives against unlabelled text ranks held-back
halves of both, and the smallest ratio, over all thresholds, of the unlabelled to the positive
share above the threshold (plus a confidence margin) is the share of positives in the mix.

Features of a text (whole text, language-independent): shares of byte-class pairs, and
word and line statistics such as how much is repeated.

The only thing sampled is the training set: at most ``positives`` trusted rows and
``unlabelled`` rows, those with the smallest hash of their id.

Defined results: null and empty texts have all-zero features and get the score those have;
repeated rows score alike; without trusted positives or unlabelled rows every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import pick

#: Bounds of the training sample.
POSITIVES, UNLABELLED = 4000, 8000
HIDDEN = 24


def _byte_classes() -> np.ndarray:
    """Class of each byte: letter cases, digits, blanks, line feeds, kinds of marks, UTF-8 parts."""
    c = np.full(256, 15, np.uint8)
    for group, members in enumerate(["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789",
                                     " \t", "\n\r", ".,;:", "!?", "'\"()[]{}", "-_", "|/\\", "#$%&*+=<>@^~`"]):
        for ch in members:
            c[ord(ch)] = group
    c[0x80:0xC0] = 11
    c[0xC0:0xE0] = 12
    c[0xE0:0x100] = 13
    return c


_CLASS = _byte_classes()
FEATURES = 256 + 10


def features(text: str | None) -> np.ndarray:
    """Feature vector of a whole text."""
    out = np.zeros(FEATURES, np.float32)
    if not text:
        return out
    data = text.encode()
    classes = _CLASS[np.frombuffer(data, np.uint8)]
    if len(classes) > 1:
        pairs = np.zeros(256, np.int64)
        for lo in range(0, len(classes) - 1, 1 << 20):
            part = classes[lo:lo + (1 << 20) + 1]
            pairs += np.bincount((part[:-1] << 4) | part[1:], minlength=256)
        out[:256] = np.sqrt(pairs / (len(classes) - 1))
    words = text.split()
    n = len(words)
    if n:
        kinds = set(words)
        lines = [x for x in text.split("\n") if x and not x.isspace()]
        same = sum(map(eq, words, words[1:]))
        skip = sum(map(eq, words, words[2:]))
        tails = len({w[-1] for w in kinds})
        out[256:] = (len(kinds) / n, same / n, skip / n, np.log1p(n) / 10, len(text) / n / 20,
                     len(set(lines)) / max(len(lines), 1), np.log1p(len(lines)) / 6,
                     np.log1p(n / max(len(lines), 1)) / 8, tails / max(len(kinds), 1),
                     sum(map(str.isupper, kinds)) / len(kinds))
    return out


@dataclass
class Model:
    """Parameters and feature scaling; a few kilobytes."""
    p: dict[str, np.ndarray] | None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    prior: float = 0.5


def _logit(x: np.ndarray, p: dict) -> tuple[np.ndarray, np.ndarray]:
    h = np.tanh(x @ p["w1"] + p["b1"])
    return h @ p["w2"] + p["b2"][0] + x @ p["w3"], h


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _gradient(x: np.ndarray, p: dict, d: np.ndarray, h: np.ndarray) -> dict:
    d_h = d[:, None] * p["w2"] * (1 - h * h)
    return {"w1": x.T @ d_h, "b1": d_h.sum(axis=0), "w2": h.T @ d, "b2": d.sum(keepdims=True), "w3": x.T @ d}


class _Fit:
    """Adam over the network's parameters."""

    def __init__(self, seed: int, rate: float = 0.003, decay: float = 1e-3):
        rng = np.random.default_rng(seed)
        self.p = {"w1": rng.normal(0, 0.1, (FEATURES, HIDDEN)), "b1": np.zeros(HIDDEN),
                  "w2": rng.normal(0, 0.3, HIDDEN), "b2": np.zeros(1), "w3": np.zeros(FEATURES)}
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.t, self.rate, self.decay, self.rng = 0, rate, decay, rng

    def step(self, g: dict) -> None:
        self.t += 1
        for k, x in g.items():
            x = x + self.decay * self.p[k]
            self.m[k] = 0.9 * self.m[k] + 0.1 * x
            self.v[k] = 0.999 * self.v[k] + 0.001 * x * x
            fix = np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
            self.p[k] -= self.rate * fix * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)

    def batches(self, pos: np.ndarray, unl: np.ndarray, steps: int,
                size: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for _ in range(steps):
            yield (pos[self.rng.integers(0, len(pos), size)], unl[self.rng.integers(0, len(unl), size)])


def estimate_prior(pos: np.ndarray, unl: np.ndarray, seed: int = 5, steps: int = 600) -> float:
    """Share of positives among the unlabelled rows (scaled features)."""
    half_p, half_u = len(pos) // 2, len(unl) // 2
    if half_p < 5 or half_u < 5:
        return 0.5
    fit = _Fit(seed)
    for p, u in fit.batches(pos[:half_p], unl[:half_u], steps):
        x = np.concatenate([p, u])
        y = np.concatenate([np.ones(len(p)), np.zeros(len(u))])
        z, h = _logit(x, fit.p)
        fit.step(_gradient(x, fit.p, (_sigmoid(z) - y) / len(x), h))
    sp, su = (np.sort(_logit(x, fit.p)[0]) for x in (pos[half_p:], unl[half_u:]))
    cuts = sp
    share_p = 1 - np.searchsorted(sp, cuts, "left") / len(sp)
    share_u = 1 - np.searchsorted(su, cuts, "left") / len(su)
    # Confidence of both empirical shares; a threshold with few rows above it cannot win by luck.
    margin = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(sp)) + 1 / np.sqrt(len(su)))
    best = np.argmin((share_u + margin) / np.maximum(share_p, 1e-9))
    return float(np.clip(share_u[best] / share_p[best], 0.02, 0.98))


def train(pos: np.ndarray, unl: np.ndarray, seed: int = 11, steps: int = 2500) -> Model:
    """Fit on feature rows of trusted positives and of unlabelled texts."""
    if not len(pos) or not len(unl):
        return Model(None)
    mean, scale = unl.mean(axis=0), unl.std(axis=0) + 0.02
    pos, unl = ((np.clip((x - mean) / scale, -8, 8)) for x in (pos, unl))
    prior = estimate_prior(pos, unl)
    fit = _Fit(seed)
    fit.p["b2"][0] = np.log(prior / (1 - prior))
    for xp, xu in fit.batches(pos, unl, steps):
        zp, hp = _logit(xp, fit.p)
        zu, hu = _logit(xu, fit.p)
        good_p, good_u = _sigmoid(zp), _sigmoid(zu)
        # Logistic loss: -log sigmoid(z) for +1, -log sigmoid(-z) for -1.
        rest = np.mean(np.logaddexp(0, zu)) - prior * np.mean(np.logaddexp(0, zp))
        if rest >= 0:
            d_p = prior * ((good_p - 1) - good_p) / len(xp)
            d_u = good_u / len(xu)
        else:
            d_p, d_u = prior * good_p / len(xp), -good_u / len(xu)
        a, b = _gradient(xp, fit.p, d_p, hp), _gradient(xu, fit.p, d_u, hu)
        fit.step({k: a[k] + b[k] for k in a})
    return Model(fit.p, mean, scale, prior)


def scores(x: np.ndarray, model: Model) -> np.ndarray:
    """Probability of label 1 of feature rows."""
    if model.p is None:
        return np.full(len(x), 0.5)
    return _sigmoid(_logit(np.clip((x - model.mean) / model.scale, -8, 8), model.p)[0])


def _sampled(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    """Feature rows of the documents with these (bounded many) ids, computed where the texts are."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [features(t).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(rows, pa.binary())], names=["id", "x"])

    kind = docs.schema["id"].dataType.simpleString()
    rows = (docs.join(F.broadcast(ids), "id").select("id", "text")
            .mapInArrow(work, f"id {kind}, x binary").collect())
    unique = {r["id"]: r["x"] for r in sorted(rows, key=lambda r: (r["id"], r["x"]))}
    return np.array([np.frombuffer(unique[i], np.float32) for i in sorted(unique)]).reshape(-1, FEATURES)


def sample(docs: DataFrame, labels: DataFrame, use: Column, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "quality", positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Train on at most ``positives`` rows labelled 1 and ``unlabelled`` rows of ``docs`` for
    which ``use`` (over the column id) holds."""
    base = pick(docs, id=id_col, text=text_col)
    trusted = (pick(labels, id=id_col, label=label_col).where("label IN (0, 1)").where(use)
               .groupBy("id").agg(F.min("label").alias("label")).where("label = 1").select("id"))
    some = base.select("id").where(use)
    # Two hash orders, so that the two samples are independent.
    pos = trusted.orderBy(F.xxhash64("id"), "id").limit(positives)
    unl = some.orderBy(F.xxhash64("id", F.lit("u")), "id").limit(unlabelled).distinct()
    return train(_sampled(base, pos), _sampled(base, unl))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row, in [0, 1]."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    base = pick(docs, id=id_col, text=text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                s = b.slice(lo, 512)
                x = np.array([features(t) for t in s.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [s.column("id"), pa.array(scores(x, sent.value), pa.float64())], names=["id", "score"])

    kind = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(work, f"id {kind}, score double").select(F.col("id").alias(id_col), "score")
