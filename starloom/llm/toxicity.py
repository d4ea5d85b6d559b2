"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

A step is a run of letters and digits or a run of other characters (punctuation, symbols,
emoji); nothing but white space is left out. Its input is a word vector plus the mean of its
character n-gram vectors (both hashed, so any run has an input). A run of more than
``LONGEST`` characters (languages written without blanks, glued text) is read as overlapping
pieces of ``PIECE`` characters, each a step of its own, so all its n-grams count. Two gated recurrent layers read a window forwards and
backwards, attention weighs their states into one vector, a logistic unit scores it. A
text is covered by overlapping windows of ``WINDOW`` words at ``STRIDE`` words, the last
one aligned with the end; its score is that of the worst window. All windows of the whole
text are scored.

Training (numpy, Adam) takes a bounded sample of labelled training rows: at most
``per_class`` documents of each class, those with the smallest hash of their id. It is the
only thing that is sampled: their texts are whole and every window counts, worked off
``CHUNK`` at a time. The driver reads them as a stream and keeps four bytes a word. A labelled document is a bag of windows: the first passes push
every window towards the label, later ones only the window with the highest score.

Defined results: null and empty texts have one window of padding and get the score of an
empty attention pool; repeated rows score alike; without labelled training rows of both
classes every score is the share of toxic rows (0.0 without any); of an id with several texts the smallest one is trained on.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from starloom.llm.common import fresh, pick

WINDOW, STRIDE = 64, 48
HIDDEN, DIM = 8, 8
WORD_BUCKETS, CHAR_BUCKETS = 1 << 15, 1 << 13
#: Bounds of training: documents of each class, windows in one step of the work.
PER_CLASS, CHUNK = 1500, 1024
#: Longest run that is one word; pieces of longer ones and the characters that two pieces share.
LONGEST, PIECE, SHARED = 40, 16, 8
_PAD_GATE = 30.0

_words = re.compile(r"[^\W_]+|(?:[^\w\s]|_)+").findall


@dataclass
class Model:
    """Parameters; a few hundred kilobytes, independent of the input."""
    p: dict[str, np.ndarray]
    base: float | None = None  # a constant score if nothing could be learned


def words_of(text: str | None) -> list[str]:
    """The runs of letters and digits and of other characters of a text in order, long ones as overlapping pieces."""
    words = _words((text or "").lower())
    if max(map(len, words), default=0) <= LONGEST:
        return words
    out: list[str] = []
    for w in words:
        if len(w) <= LONGEST:
            out.append(w)
        else:
            out.extend(w[i:i + PIECE] for i in range(0, len(w) - SHARED, PIECE - SHARED))
    return out


def _features(word: str) -> tuple[int, list[int]]:
    w = zlib.crc32(word.encode()) % WORD_BUCKETS
    s = f"<{word}>"
    grams = [zlib.crc32(s[i:i + n].encode()) % CHAR_BUCKETS for n in (3, 4)
             for i in range(len(s) - n + 1)] or [0]
    return w, grams


def _window_starts(n: int) -> list[int]:
    if n <= WINDOW:
        return [0]
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


def _init(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def n(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    p = {"word": n(WORD_BUCKETS, DIM, scale=0.1), "char": n(CHAR_BUCKETS, DIM, scale=0.1),
         "att_w": n(2 * HIDDEN, HIDDEN, scale=0.3), "att_v": n(HIDDEN, scale=0.3),
         "att_b": np.zeros(HIDDEN, np.float32),
         "out_w": n(2 * HIDDEN, scale=0.3), "out_b": np.full(1, -1.0, np.float32)}
    for d in "fb":
        p |= {f"in_{d}": n(DIM, 3 * HIDDEN, scale=0.5), f"rec_{d}": n(HIDDEN, 3 * HIDDEN, scale=0.3),
              f"bias_{d}": np.zeros(3 * HIDDEN, np.float32)}
    return p


class _Lexicon:
    """Row numbers for words; row 0 is padding. The n-grams of all rows lie end to end."""

    def __init__(self) -> None:
        self.row: dict[str, int] = {}
        self.word = array("l")
        self.gram = array("l")
        self.size = array("l")

    def rows(self, words: list[str]) -> np.ndarray:
        row = self.row
        out = list(map(row.get, words))
        if None in out:
            for i, r in enumerate(out):
                if r is None:
                    w = words[i]
                    r = row.get(w)
                    if r is None:
                        word, grams = _features(w)
                        self.word.append(word)
                        self.gram.extend(grams)
                        self.size.append(len(grams))
                        r = row[w] = len(row) + 1
                    out[i] = r
        return np.array(out, np.int32)


def _inputs(word: np.ndarray, gram: np.ndarray, size: np.ndarray, p: dict) -> np.ndarray:
    """Word plus mean n-gram vectors."""
    sums = np.add.reduceat(p["char"][gram], np.cumsum(size) - size, axis=0)
    return p["word"][word] + sums / size[:, None].astype(np.float32)


def _gru(gates: np.ndarray, rec: np.ndarray, keep: list | None) -> np.ndarray:
    """States of one direction; gates is (steps, batch, 3H), keep collects what BPTT needs."""
    steps, batch, _ = gates.shape
    h = np.zeros((batch, HIDDEN), np.float32)
    out = np.empty((steps, batch, HIDDEN), np.float32)
    for t in range(steps):
        r = h @ rec
        zr = gates[t, :, :2 * HIDDEN] + r[:, :2 * HIDDEN]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1.0
        np.reciprocal(zr, out=zr)
        z, s = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = np.tanh(gates[t, :, 2 * HIDDEN:] + s * r[:, 2 * HIDDEN:])
        if keep is not None:
            keep.append((h, z, s, n, r[:, 2 * HIDDEN:]))
        h = h + z * (n - h)
        out[t] = h
    return out


def _pool(states: np.ndarray, live: np.ndarray, p: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Attention over the steps: (pooled, weights, hidden of the attention)."""
    hidden = np.tanh(states @ p["att_w"] + p["att_b"])
    logit = np.where(live, hidden @ p["att_v"], -1e9)
    e = np.exp(logit - logit.max(axis=0)) * live
    a = e / np.maximum(e.sum(axis=0), 1e-9)
    return np.einsum("tb,tbh->bh", a, states), a, hidden


def _gates(rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """(steps, batch, 3H) gate inputs of windows of row numbers."""
    return table[rows.T]


def _tables(x: np.ndarray, p: dict) -> dict[str, np.ndarray]:
    """Gate inputs of every lexicon row for both directions; padding never opens the gate."""
    out = {}
    for d in "fb":
        pad = np.zeros((1, 3 * HIDDEN), np.float32)
        pad[0, :HIDDEN] = -_PAD_GATE
        out[d] = np.concatenate([pad, (x @ p[f"in_{d}"] + p[f"bias_{d}"]).astype(np.float32)])
    return out


def _forward(rows: np.ndarray, tables: dict, p: dict) -> np.ndarray:
    """Logits of windows (batch, steps) of row numbers."""
    f = _gru(_gates(rows, tables["f"]), p["rec_f"], None)
    b = _gru(_gates(rows[:, ::-1], tables["b"]), p["rec_b"], None)[::-1]
    pooled, _, _ = _pool(np.concatenate([f, b], axis=2), (rows != 0).T, p)
    return pooled @ p["out_w"] + p["out_b"][0]


def _bptt(d_out: np.ndarray, keep: list, rec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gate inputs and the recurrent matrix from those of the states."""
    d_gates = np.empty((*d_out.shape[:2], 3 * HIDDEN), np.float32)
    d_rec = np.zeros_like(rec)
    d_h = np.zeros(d_out.shape[1:], np.float32)
    for t in range(len(keep) - 1, -1, -1):
        h, z, s, n, rn = keep[t]
        d = d_out[t] + d_h
        d_n = d * z * (1 - n * n)
        d_z = d * (n - h) * z * (1 - z)
        d_s = d_n * rn * s * (1 - s)
        g = np.concatenate([d_z, d_s, d_n], axis=1)
        d_gates[t] = g
        d_r = np.concatenate([d_z, d_s, d_n * s], axis=1)
        d_rec += h.T @ d_r
        d_h = d * (1 - z) + d_r @ rec.T
    return d_gates, d_rec


def _backward(rows: np.ndarray, y: np.ndarray, weight: np.ndarray, x: np.ndarray,
              p: dict) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of the dense parameters, and of the inputs x of rows 1, 2, ..."""
    tables = _tables(x, p)
    kf, kb = [], []
    f = _gru(_gates(rows, tables["f"]), p["rec_f"], kf)
    b = _gru(_gates(rows[:, ::-1], tables["b"]), p["rec_b"], kb)[::-1]
    states, live = np.concatenate([f, b], axis=2), (rows != 0).T
    pooled, a, hidden = _pool(states, live, p)
    d_logit = ((_sigmoid(pooled @ p["out_w"] + p["out_b"][0]) - y) * weight).astype(np.float32)
    g = {"out_w": pooled.T @ d_logit, "out_b": d_logit.sum(keepdims=True)}
    d_pool = d_logit[:, None] * p["out_w"]
    d_a = np.einsum("bh,tbh->tb", d_pool, states)
    d_att = a * (d_a - (a * d_a).sum(axis=0))
    d_hidden = d_att[:, :, None] * p["att_v"] * (1 - hidden * hidden)
    g["att_v"] = np.einsum("tb,tbh->h", d_att, hidden)
    g["att_b"] = d_hidden.sum(axis=(0, 1))
    g["att_w"] = np.einsum("tbi,tbj->ij", states, d_hidden)
    d_states = a[:, :, None] * d_pool[None] + d_hidden @ p["att_w"].T
    d_x = np.zeros((len(x) + 1, DIM), np.float32)
    for d, keep, order, part in (("f", kf, rows, d_states[:, :, :HIDDEN]),
                                 ("b", kb, rows[:, ::-1], d_states[::-1, :, HIDDEN:])):
        d_gates, g[f"rec_{d}"] = _bptt(part, keep, p[f"rec_{d}"])
        d_gates *= (order.T != 0)[:, :, None]
        flat, at = d_gates.reshape(-1, 3 * HIDDEN), order.T.reshape(-1)
        seen = np.concatenate([np.zeros((1, DIM), np.float32), x])[at]
        g[f"in_{d}"] = seen.T @ flat
        g[f"bias_{d}"] = flat.sum(axis=0)
        d_x += _add_rows(at, flat @ p[f"in_{d}"].T, len(d_x))
    return g, d_x[1:]


def _add_rows(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum of the values' rows by their target row."""
    return np.stack([np.bincount(at, c, n) for c in values.T], axis=1).astype(np.float32)


class _Adam:
    def __init__(self, p: dict, rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, grads: dict) -> None:
        self.t += 1
        fix = np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, g in grads.items():
            if isinstance(g, tuple):  # rows of an embedding table
                at, back = np.unique(g[0], return_inverse=True)
                g = _add_rows(back, g[1], len(at))
            else:
                at = slice(None)
            m = self.m[k][at] = 0.9 * self.m[k][at] + 0.1 * g
            v = self.v[k][at] = 0.999 * self.v[k][at] + 0.001 * g * g
            self.p[k][at] -= (self.rate * fix * m / (np.sqrt(v) + 1e-8)).astype(np.float32)


def _windows(rows: np.ndarray, starts: list[int] | None = None) -> np.ndarray:
    if starts is None:
        starts = _window_starts(len(rows))
    if len(rows) < WINDOW:
        rows = np.concatenate([rows, np.zeros(WINDOW - len(rows), np.int32)])
    return rows[np.add.outer(np.array(starts), np.arange(WINDOW))]


def _chunks(bags: list[np.ndarray], size: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(windows, number of their document) of all windows, about ``size`` at a time. A bag is a
    document's row numbers, so overlapping windows exist only while they are worked on."""
    held, owner, n = [], [], 0
    for k, bag in enumerate(bags):
        starts = _window_starts(len(bag))
        for lo in range(0, len(starts), size):
            w = _windows(bag, starts[lo:lo + size])
            held.append(w)
            owner.append(np.full(len(w), k))
            n += len(w)
            if n >= size:
                yield np.concatenate(held), np.concatenate(owner)
                held, owner, n = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(owner)


def train(texts: Iterable[str], labels: Iterable[int], shown: int = 8_000, seed: int = 7,
          informed: bool = True) -> Model:
    """Fit on a bounded number of labelled texts, read one by one; ``shown`` is how many
    documents are looked at in all passes together, ``informed`` whether word vectors start
    from log-odds or from chance alone."""
    lexicon = _Lexicon()
    bags, marks = [], []
    for text, label in zip(texts, labels, strict=True):
        bags.append(lexicon.rows(words_of(text)))
        marks.append(label)
    y = np.array(marks, np.float32)
    if len(y) == 0 or y.min() == y.max():
        return Model({}, float(y.mean()) if len(y) else 0.0)
    rng = np.random.default_rng(seed)
    p = _init(rng)
    adam = _Adam(p, 0.01)
    counts = np.array([len(_window_starts(len(b))) for b in bags])
    word, gram, size = (np.array(a) for a in (lexicon.word, lexicon.gram, lexicon.size))
    begin = np.cumsum(size) - size
    if informed:
        _informed(p, bags, y, word, gram, size, begin)
    batch = min(96, max(16, len(bags) // 16))
    share = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    # Every class gets half of the weight; a pass is shuffled into batches of documents.
    passes = max(4, -(-shown // len(bags)))
    for k in range(passes):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), batch):
            docs = order[lo:lo + batch]
            weight = share[docs] / len(docs)
            if k < max(2, passes // 4):
                work, weight = _chunks([bags[i] for i in docs]), weight / counts[docs]
            else:
                work = [_worst([bags[i] for i in docs], p, word, gram, size, begin)]
            grads: dict = {}
            for rows, owner in work:
                sub, w, g, s = _part(rows, word, gram, size, begin)
                more, d_x = _backward(sub, y[docs][owner], weight[owner], _inputs(w, g, s, p), p)
                more |= {"word": (w, d_x), "char": (g, np.repeat(d_x / s[:, None].astype(np.float32), s, axis=0))}
                for name, d in more.items():
                    old = grads.get(name)
                    grads[name] = (d if old is None else old + d if not isinstance(d, tuple) else
                                   tuple(np.concatenate(x) for x in zip(old, d, strict=True)))
            adam.step(grads)
    return Model(p)


def _worst(bags: list[np.ndarray], p: dict, word: np.ndarray, gram: np.ndarray, size: np.ndarray,
           begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The window with the highest score of each document, found by a forward pass over all."""
    top, out = np.full(len(bags), -np.inf), np.zeros((len(bags), WINDOW), np.int32)
    for rows, owner in _chunks(bags):
        sub, w, g, s = _part(rows, word, gram, size, begin)
        logit = _forward(sub, _tables(_inputs(w, g, s, p), p), p)
        best = np.lexsort((-logit, owner))
        best = best[np.unique(owner[best], return_index=True)[1]]
        best = best[logit[best] > top[owner[best]]]
        top[owner[best]], out[owner[best]] = logit[best], rows[best]
    return out, np.arange(len(bags))


def _informed(p: dict, bags: list[np.ndarray], y: np.ndarray, word: np.ndarray, gram: np.ndarray,
              size: np.ndarray, begin: np.ndarray) -> None:
    """Start values: the first input unit holds how much likelier a word is in documents of
    label 1 (a smoothed log-odds z-score), the second the same for character n-grams. What
    occurs in few documents starts near zero, so it cannot stand for a single document."""
    seen = {"word": (np.zeros((2, WORD_BUCKETS)), 0), "char": (np.zeros((2, CHAR_BUCKETS)), 1)}
    for bag, label in zip(bags, y, strict=True):
        used = np.unique(bag)
        used = used[used > 0] - 1
        if len(used):
            at = np.concatenate([np.arange(b, b + s) for b, s in zip(begin[used], size[used], strict=True)])
            seen["word"][0][int(label), np.unique(word[used])] += 1
            seen["char"][0][int(label), np.unique(gram[at])] += 1
    n = np.array([(y == 0).sum(), (y == 1).sum()], float)
    for name, (df, unit) in seen.items():
        odds = np.log((df[1] + 0.5) / (n[1] + 1)) - np.log((df[0] + 0.5) / (n[0] + 1))
        z = odds / np.sqrt(1 / (df[1] + 0.5) + 1 / (df[0] + 0.5))
        z[df.sum(axis=0) < 3] = 0
        p[name][:, unit] = np.clip(z / 3, -1, 3)


def _part(rows: np.ndarray, word: np.ndarray, gram: np.ndarray, size: np.ndarray,
          begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows renumbered to the words they use, and those words' features."""
    used, inner = np.unique(np.append(rows, 0), return_inverse=True)
    real = used[1:] - 1
    if not len(real):  # nothing but padding
        return np.zeros_like(rows), np.zeros(1, int), np.zeros(1, int), np.ones(1, int)
    s = size[real]
    at = np.repeat(begin[real] - (np.cumsum(s) - s), s) + np.arange(s.sum())
    return inner[:-1].reshape(rows.shape).astype(np.int32), word[real], gram[at], s


class Scorer:
    """Scores texts with a model; keeps the gate inputs of the words it has met (bounded)."""

    def __init__(self, model: Model, remembered: int = 100_000, batch: int = 1024):
        self.model, self.remembered, self.batch = model, remembered, batch
        self._fresh()

    def _fresh(self) -> None:
        self.lexicon = _Lexicon()
        self.tables = {d: np.empty((1 << 12, 3 * HIDDEN), np.float32) for d in "fb"}
        for d in "fb":
            self.tables[d][0] = 0
            self.tables[d][0, :HIDDEN] = -_PAD_GATE
        self.ready = 0

    def _grow(self) -> None:
        lex, n = self.lexicon, len(self.lexicon.row)
        if n == self.ready:
            return
        # Features of new words only; once they are gate inputs they are not needed again.
        word, gram, size = (np.array(a) for a in (lex.word, lex.gram, lex.size))
        new = _tables(_inputs(word, gram, size, self.model.p), self.model.p)
        for a in (lex.word, lex.gram, lex.size):
            del a[:]
        for d in "fb":
            if n + 1 > len(self.tables[d]):
                bigger = np.empty((max(n + 1, 2 * len(self.tables[d])), 3 * HIDDEN), np.float32)
                bigger[:self.ready + 1] = self.tables[d][:self.ready + 1]
                self.tables[d] = bigger
            self.tables[d][self.ready + 1:n + 1] = new[d][1:]
        self.ready = n

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.model.base is not None:
            return np.full(len(texts), self.model.base)
        out = np.full(len(texts), -np.inf)
        waiting: list[np.ndarray] = []
        owner: list[np.ndarray] = []
        n = 0

        def flush() -> None:
            nonlocal n
            if waiting:
                self._grow()
                rows, who = np.concatenate(waiting), np.concatenate(owner)
                for lo in range(0, len(rows), self.batch):
                    np.maximum.at(out, who[lo:lo + self.batch],
                                  _forward(rows[lo:lo + self.batch], self.tables, self.model.p))
            waiting.clear()
            owner.clear()
            n = 0

        for i, t in enumerate(texts):
            if len(self.lexicon.row) > self.remembered:
                flush()
                self._fresh()
            w = _windows(self.lexicon.rows(words_of(t)))
            waiting.append(w)
            owner.append(np.full(len(w), i))
            n += len(w)
            if n >= self.batch:
                flush()
        flush()
        return _sigmoid(out)


def sample(docs: DataFrame, labels: DataFrame, use: Column, id_col: str = "doc_id",
           text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """Train on at most ``per_class`` labelled documents of each class for which ``use`` (over
    the column id) holds. Only their ids and, of those, the texts move."""
    marks = (pick(labels, id=id_col, label=label_col).where("label IN (0, 1)").where(use)
             .groupBy("id").agg(F.max("label").alias("label")))
    chosen = None
    for c in (0, 1):
        one = marks.where(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(per_class)
        chosen = one if chosen is None else chosen.unionByName(one)
    text = F.coalesce("text", F.lit(""))
    rows = (pick(docs, id=id_col, text=text_col).join(F.broadcast(chosen), "id")
            .groupBy("id", "label").agg(F.min(text).alias("text")).orderBy("label", "id"))
    marks = [r["label"] for r in rows.select("label", "id").collect()]
    return train((r["text"] for r in rows.toLocalIterator()), marks)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row, in [0, 1]."""
    base = pick(docs, id=id_col, text=text_col)
    return _scored(base, model, "text", "score").select(F.col("id").alias(id_col), "score")


def drop_toxic(docs: DataFrame, model: Model, at: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``at``."""
    name = fresh(docs, "_score")
    return (_scored(docs, model, text_col, name).where(F.col(name) < at)
            .select(*[f"`{c}`" for c in docs.columns]))


def _scored(docs: DataFrame, model: Model, text_col: str, name: str) -> DataFrame:
    """``docs`` plus the score, row by row where the rows are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                s = b.slice(lo, 256)
                got = pa.array(scorer.scores(s.column(at).to_pylist()), pa.float64())
                yield pa.RecordBatch.from_arrays([*s.columns, got], names=[*s.schema.names, name])

    return docs.mapInArrow(work, StructType([*docs.schema.fields, StructField(name, DoubleType())]))
