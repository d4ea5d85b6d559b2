"""Hard negatives: rotated one-bit codes with stored alignments, interval filter, exact scores.

1. Index: every vector is turned by a fixed random rotation and written as a sum of sign codes:
   the signs of what is left are a code, the vector's alignment with that code is stored, and
   the code's part is taken off; after ``levels`` codes only the length of the rest is stored.
   One code keeps 0.80 of a random vector's length, four leave about 0.13 of it.
2. Estimates: an anchor's rotated components become ``_PLANES``-bit numbers. Its product with a
   code is counted by popcounts of the code with the anchor's bit planes; alignments times
   these products add up to the estimate of the score.
3. Interval: what the estimate leaves out is the anchor times the rest of the vector, at most
   the product of their lengths (Cauchy-Schwarz), and the anchor's own rounding times the
   vector's length. So every score surely lies in a known interval. Rows whose interval misses
   the wanted range, or lies below the ``count``-th best sure lower end, are dropped; the rest
   are scored in integers. Nothing is lost by the filter, whatever the data.
4. Blocks: rows and anchors are dealt into blocks by a hash, every pair of blocks is a task of
   bounded size that returns at most ``count`` rows for each of its anchors (and positives);
   the best of the blocks are taken at the end.

Defined results: rows whose id, label or vector is null or whose vector has null components take no
part, nor do empty vectors; vectors of another length than the anchor's have no score with it.
Rows of one id are different rows; equal scores go by smaller id, then by what is first in the
table. An anchor without another row of its label, and a positive below zero, gives no rows.
A score beyond a long fails the job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import pick
from starloom.session import stage

POSITIVES, NEGATIVES = 5, 5
#: A negative's score in hundredths of the positive's.
LOW, HIGH = 80, 100
LEVELS = 4
#: Rows and anchors of a block.
BLOCK, ANCHORS = 8192, 2048
_PLANES = 10
_EXACT = 1 << 53


def rotation(d: int, seed: int = 11) -> np.ndarray:
    """A fixed random rotation of ``d`` dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(seed + d).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def encode(vecs: np.ndarray, levels: int, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, alignments, rest): (n, levels, words) bits, (n, levels) alignments with the unit
    vectors of the codes, (n,) length of what no code covers."""
    left = vecs.astype(np.float64) @ turn
    n, d = left.shape
    words = -(-d // 64)
    codes = np.zeros((n, levels, words), np.uint64)
    along = np.zeros((n, levels))
    for k in range(levels):
        up = left >= 0
        sign = np.where(up, 1.0, -1.0) / np.sqrt(d)
        along[:, k] = (left * sign).sum(axis=1)
        left = left - along[:, k, None] * sign
        bits = np.zeros((n, words * 64), bool)
        bits[:, :d] = up
        codes[:, k] = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    return codes, along, np.sqrt((left * left).sum(axis=1))


def planes(anchor: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, float, float, float]:
    """(bit planes, step, least, error) of an anchor: component i is about least + step * number
    i, and ``error`` is the length of the difference."""
    a = anchor.astype(np.float64) @ turn
    least, most = float(a.min()), float(a.max())
    step = (most - least) / ((1 << _PLANES) - 1) or 1.0
    numbers = np.rint((a - least) / step).astype(np.int64)
    bits = np.zeros((_PLANES, -(-len(a) // 64) * 64), bool)
    bits[:, :len(a)] = numbers >> np.arange(_PLANES)[:, None] & 1
    error = a - (least + step * numbers)
    return (np.packbits(bits, axis=1, bitorder="little").view("<u8").astype(np.uint64), step, least,
            float(np.sqrt((error * error).sum())))


class Block:
    """Rows of one length with their codes."""

    def __init__(self, codes: np.ndarray, along: np.ndarray, rest: np.ndarray, vecs: np.ndarray, turn: np.ndarray):
        self.codes, self.along, self.rest, self.vecs, self.turn = codes, along, rest, vecs, turn
        self.d = vecs.shape[1]
        self.ones = np.bitwise_count(codes).sum(axis=2, dtype=np.int64)
        self.length = np.sqrt((vecs.astype(np.float64) ** 2).sum(axis=1))
        self.largest = int(np.abs(vecs).max(initial=0))
        self.real = vecs.astype(np.float64)

    def interval(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper ends between which the scores surely lie."""
        bits, step, least, error = planes(anchor, self.turn)
        total = np.zeros(self.ones.shape, np.int64)
        for p, plane in enumerate(bits):
            total += np.bitwise_count(self.codes & plane).sum(axis=2, dtype=np.int64) << p
        whole = int(sum(int(np.bitwise_count(plane).sum()) << p for p, plane in enumerate(bits)))
        # Set bits count plus, the others minus.
        product = (step * (2 * total - whole) + least * (2 * self.ones - self.d)) / np.sqrt(self.d)
        middle = (self.along * product).sum(axis=1)
        size = float(np.sqrt((anchor.astype(np.float64) ** 2).sum()))
        # The last term covers the rounding of these sums.
        width = self.rest * size + error * self.length + 1e-9 * (1 + size * self.length)
        return middle - width, middle + width

    def score(self, anchor: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Integer products of an anchor with some of the rows."""
        bound = self.largest * int(np.abs(anchor).max(initial=0)) * self.d
        if bound < _EXACT:
            return (self.real[at] @ anchor.astype(np.float64)).astype(np.int64)
        if bound >= 1 << 63:
            raise ValueError("scores beyond a long")
        return self.vecs[at] @ anchor


def best(ids: np.ndarray, g: np.ndarray, scores: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` best: higher score, smaller id, first in the table."""
    if len(scores) > 4 * count:
        floor = np.partition(scores, len(scores) - count)[len(scores) - count]
        some = np.flatnonzero(scores >= floor)
        return some[np.lexsort((g[some], ids[some], -scores[some]))[:count]]
    return np.lexsort((g, ids, -scores))[:count]


def _sure(low: np.ndarray, count: int) -> float:
    """The ``count``-th best lower end."""
    return np.partition(low, len(low) - count)[len(low) - count] if len(low) >= count else -np.inf


def _block(t: pa.Table) -> Block | None:
    if not t.num_rows:
        return None
    d, words = t["dim"][0].as_py(), -(-t["dim"][0].as_py() // 64)
    n = t.num_rows
    flat = {c: np.concatenate([x.flatten().to_numpy() for x in t[c].chunks]) for c in ("codes", "along", "vec")}
    codes = flat["codes"].view(np.uint64).reshape(n, -1, words)
    return Block(codes, flat["along"].reshape(n, codes.shape[1]), t["rest"].to_numpy(),
                 flat["vec"].reshape(n, d), rotation(d))


def _positives(anchors: pa.Table, rows: pa.Table, count: int) -> pa.Table:
    """(anchor, row, id, score): the best rows of each anchor's label in this block."""
    out: list[list[np.ndarray]] = [[], [], [], []]
    block = _block(rows)
    if block is not None and anchors.num_rows:
        g, ids, labels = (rows[c].to_numpy() for c in ("g", "id", "label"))
        order = np.argsort(labels, kind="stable")
        for a, label, vec in zip(anchors["g"].to_pylist(), anchors["label"].to_pylist(),
                                 anchors["vec"].to_pylist(), strict=True):
            x, y = np.searchsorted(labels[order], [label, label + 1])
            same = order[x:y]
            same = same[g[same] != a]
            if not len(same):
                continue
            vec = np.array(vec, np.int64)
            low, high = block.interval(vec)
            near = same[high[same] >= _sure(low[same], count)]
            scores = block.score(vec, near)
            top = best(ids[near], g[near], scores, count)
            for o, v in zip(out, (np.full(len(top), a), g[near][top], ids[near][top], scores[top]), strict=True):
                o.append(v)
    return _table(["anchor", "row", "row_id", "score"], out)


def _negatives(anchors: pa.Table, rows: pa.Table, count: int, least: int, most: int) -> pa.Table:
    """(anchor, positive, row_id, row, score): the best rows of other labels whose score is within
    the range of each positive's."""
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    block = _block(rows)
    if block is not None and anchors.num_rows:
        g, ids, labels = (rows[c].to_numpy() for c in ("g", "id", "label"))
        for a, label, vec, positives in zip(*[anchors[c].to_pylist() for c in ("g", "label", "vec", "positives")],
                                            strict=True):
            vec = np.array(vec, np.int64)
            low, high = block.interval(vec)
            other = labels != label
            for p in positives:
                s = p["score"]
                # Ends of the range, rounded outwards for the filter.
                bottom, top = least * s / 100, most * s / 100
                wide = 1e-9 * (1 + abs(s))
                sure = other & (low >= bottom + wide) & (high <= top - wide)
                floor = max(bottom - wide, _sure(low[sure], count))
                near = np.flatnonzero(other & (high >= floor) & (low <= top + wide))
                scores = block.score(vec, near)
                # Whole numbers of any size: 100 times a score may be beyond a long.
                fits = (scores >= -(-least * s // 100)) & (scores <= most * s // 100)
                near, scores = near[fits], scores[fits]
                got = best(ids[near], g[near], scores, count)
                for o, v in zip(out, (np.full(len(got), a), np.full(len(got), p["row"]), ids[near][got],
                                      g[near][got], scores[got]), strict=True):
                    o.append(v)
    return _table(["anchor", "positive", "row_id", "row", "score"], out)


def _table(names: list[str], columns: list[list[np.ndarray]]) -> pa.Table:
    return pa.table([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in columns],
                    names=names)


def _index(rows: DataFrame, levels: int) -> DataFrame:
    """Adds codes, alignments and the length of the rest."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for b in batches:
            dim, vec = b.column("dim").to_numpy(), b.column("vec")
            flat, ends = vec.values.to_numpy(), vec.offsets.to_numpy()
            codes: list = [None] * b.num_rows
            along: list = [None] * b.num_rows
            rest = np.zeros(b.num_rows)
            for d in np.unique(dim).tolist():
                at = np.flatnonzero(dim == d)
                x, y, z = encode(flat[ends[at][:, None] + np.arange(d)], levels,
                                 turns.setdefault(d, rotation(d)))
                rest[at] = z
                for i, c, w in zip(at.tolist(), x.view(np.int64).reshape(len(at), -1), y, strict=True):
                    codes[i], along[i] = c, w
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(codes, pa.list_(pa.int64())), pa.array(along, pa.list_(pa.float64())),
                 pa.array(rest)], names=[*b.schema.names, "codes", "along", "rest"])

    return rows.mapInArrow(work, "g long, id long, label long, dim int, vec array<long>, codes array<long>, "
                                 "along array<double>, rest double")


def _meet(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, work, schema: str,
          block: int, anchor_block: int) -> DataFrame:
    """``work`` on every pair of a block of anchors and a block of rows of one length."""
    a_blocks, r_blocks = -(-n_anchors // anchor_block), -(-n_rows // block)

    def dealt(df: DataFrame, own: int, others: int, mine: str, theirs: str) -> DataFrame:
        return (df.withColumn(mine, F.pmod(F.xxhash64("g"), F.lit(own)).cast("int"))
                .withColumn(theirs, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))))

    left = dealt(anchors, a_blocks, r_blocks, "ab", "rb").groupBy("dim", "ab", "rb")
    right = dealt(rows, r_blocks, a_blocks, "rb", "ab").groupBy("dim", "ab", "rb")
    return left.cogroup(right).applyInArrow(work, schema)


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label",
         vec_col: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LOW,
         most: int = HIGH, levels: int = LEVELS, block: int = BLOCK, anchor_block: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score). The vectors
    are arrays of whole numbers; ``is_anchor`` is a condition on the column id."""
    base = pick(vectors, id=id_col, label=label_col, vec=vec_col).select(
        F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
        F.col("vec").cast("array<long>").alias("vec"))
    good = base.where("id IS NOT NULL AND label IS NOT NULL AND size(vec) > 0 AND NOT exists(vec, x -> x IS NULL)")
    # Numbered as written; a written table is read back with the same numbers.
    numbered = stage(good.select("id", "label", F.size("vec").alias("dim"), "vec"), "labelled-vectors")
    rows = numbered.df.select(F.monotonically_increasing_id().alias("g"), "id", "label", "dim", "vec")
    coded = stage(_index(rows, levels), "coded-vectors")
    anchors = stage(coded.df.where(is_anchor).select("g", "id", "label", "dim", "vec"), "anchors")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not anchors.rows:
        return vectors.sparkSession.createDataFrame([], schema)
    found = _meet(anchors.df, coded.df, anchors.rows, coded.rows,
                  lambda a, r: _positives(a, r, positives),
                  "anchor long, row long, row_id long, score long", block, anchor_block)
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "row_id", "row")
    kept = stage(found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
                 .drop("place"), "positives").df
    per_anchor = kept.groupBy("anchor").agg(F.collect_list(F.struct("row", "score")).alias("positives"))
    asking = stage(anchors.df.join(per_anchor.withColumnRenamed("anchor", "g"), "g"), "asking")
    if not asking.rows:
        return vectors.sparkSession.createDataFrame([], schema)
    found = _meet(asking.df, coded.df, asking.rows, coded.rows,
                  lambda a, r: _negatives(a, r, negatives, least, most),
                  "anchor long, positive long, row_id long, row long, score long", block, anchor_block)
    first = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "row_id", "row")
    ranked = (found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
              .select("anchor", "positive", "rank", F.col("row_id").alias("negative_id"),
                      F.col("score").alias("negative_score")))
    names = kept.select("anchor", F.col("row").alias("positive"), F.col("row_id").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    return (ranked.join(names, ["anchor", "positive"])
            .join(anchors.df.select(F.col("g").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
