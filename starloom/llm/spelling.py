"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

1. Vectors: a word's letters are counted in 32 buckets (a to z, and six for all others), each
   count up to four. In unary that is 128 bits, and the L1 distance of two vectors is the
   number of bits that differ. One inserted, deleted or replaced letter moves a vector by at
   most two, so the search radius is two for words of equal length and one for lengths that
   differ by one. Buckets and the limit of four only bring vectors nearer: none is lost.
2. Cells: for every length that has more than ``cell`` words, the planes of a k-d tree are
   chosen from a bounded sample of its words; its leaves cut the space into cells. Every word
   is stored in the one cell that holds its vector and probes all cells of its own and of the
   next length whose box lies within the radius. Of two cells of one length only the one with
   the smaller number probes. A cell with more than ``crowd`` words (anagrams share a vector,
   which no plane divides) is cut, and every pair of cuts is a piece of work of its own.
3. Search: a task builds a k-d tree with tight boxes over a cell's words, drops boxes outside
   the radius, and compares the letters of what is left in order.
4. Forms: a word's form is its commonest near word if that is ``ratio`` times as common; forms
   are followed to their ends by pointer doubling.

Defined results: words are compared by code point, so letters in either case and with other
accents are different letters. Null and empty words, null counts and counts below one take no
part; repeated words count together. A near word that is not common enough gives no form; ties
go to the smallest word in code-point order. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import lower_ascii, pick
from starloom.operators.joins import join_small
from starloom.session import Staged, stage

RATIO = 5
#: Words of a cell, of a cut of a crowded cell, and of a leaf of the search tree.
CELL, CROWD, LEAF = 8192, 65_536, 24
#: Bound of the sample that the planes are chosen from, for each length.
SAMPLE = 20_000
_BUCKETS, _LEVELS = 32, 4
#: Pairs looked at in one step, and letters compared in one step.
_PAIRS, _LETTERS = 1 << 20, 1 << 24
#: Numbers of cuts fit below this, so a pair of them is one long.
_WIDE = 1 << 20


def runs(docs: DataFrame, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, word) for every leftmost longest match of the pattern, A-Z lower-cased."""
    base = pick(docs, id=id_col, text=text_col)
    found = base.select("id", F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("word"))
    return found.select("id", lower_ascii(F.col("word")).alias("word"))


def letters(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    raw = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length)
    return raw.astype(np.uint8) if not raw.size or raw.max() < 256 else raw


def vectors(points: np.ndarray) -> np.ndarray:
    """Letter counts in unary: two words of 64 bits for each row of code points."""
    c = points.astype(np.int64)
    bucket = np.where((c >= 97) & (c < 123), c - 97, 26 + c % 6)
    counts = np.zeros((len(c), _BUCKETS), np.int64)
    row = np.arange(len(c))
    for k in range(c.shape[1]):
        counts[row, bucket[:, k]] += 1
    bits = counts[:, :, None] >= np.arange(1, _LEVELS + 1)
    return np.packbits(bits.reshape(len(c), -1), axis=1, bitorder="little").view("<u8").astype(np.uint64)


def _plane(vecs: np.ndarray) -> int | None:
    """The bit that divides the vectors most evenly, or None if all are equal."""
    ones = np.unpackbits(vecs.astype("<u8").view(np.uint8).reshape(len(vecs), -1), axis=1,
                         bitorder="little").sum(axis=0, dtype=np.int64)
    uneven = np.abs(2 * ones - len(vecs))
    bit = int(uneven.argmin())
    return bit if 0 < ones[bit] < len(vecs) else None


def _has(vecs: np.ndarray, bit: int) -> np.ndarray:
    return (vecs[:, bit >> 6] >> np.uint64(bit & 63)) & np.uint64(1) > 0


def _mask(low: int, high: int) -> np.ndarray:
    """The bits from ``low`` up to ``high``."""
    whole = (1 << high) - (1 << low)
    return np.array([whole & (1 << 64) - 1, whole >> 64], np.uint64)


@dataclass
class Tree:
    """A k-d tree. A node is a box (in unary: bits all vectors in it have, bits any may have)
    with two children, or a leaf with the places ``first`` up to ``stop`` of ``order``."""
    low: np.ndarray
    high: np.ndarray
    children: np.ndarray
    first: np.ndarray
    stop: np.ndarray
    order: np.ndarray

    def reach(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, query): the leaves whose boxes are within the radius of each query."""
        node = np.zeros(len(queries), np.int64)
        query = np.arange(len(queries))
        leaves = [(node[:0], query[:0])]
        while len(node):
            q = queries[query]
            far = (np.bitwise_count(self.low[node] & ~q).sum(axis=1, dtype=np.int64)
                   + np.bitwise_count(q & ~self.high[node]).sum(axis=1, dtype=np.int64))
            node, query = node[far <= radius], query[far <= radius]
            end = self.children[node, 0] < 0
            leaves.append((node[end], query[end]))
            node, query = self.children[node[~end]].T.reshape(-1), np.tile(query[~end], 2)
        a, b = zip(*leaves, strict=True)
        return np.concatenate(a), np.concatenate(b)


def plant(vecs: np.ndarray, leaf: int, tight: bool, depth: int = 64) -> Tree:
    """A tree over the vectors. Its boxes are those of the vectors if ``tight``; if not, they
    are what the planes leave, so that together the leaves cover the whole space."""
    low, high, children, first, stop, order = [], [], [], [], [], []
    todo = [(np.arange(len(vecs)), np.zeros(2, np.uint64), _mask(0, 128), 0, -1, 0)]
    while todo:
        at, lo, hi, level, parent, side = todo.pop()
        mine = len(low)
        if parent >= 0:
            children[parent][side] = mine
        part = vecs[at]
        if tight and len(at):
            lo, hi = np.bitwise_and.reduce(part, axis=0), np.bitwise_or.reduce(part, axis=0)
        low.append(lo)
        high.append(hi)
        children.append([-1, -1])
        bit = _plane(part) if len(at) > leaf and level < depth else None
        first.append(len(order))
        if bit is None:
            order.extend(at.tolist())
        else:
            has = _has(part, bit)
            begin = bit // _LEVELS * _LEVELS
            # Without the bit: fewer letters than its level; with it: at least so many.
            todo.append((at[has], lo | _mask(begin, bit + 1), hi, level + 1, mine, 1))
            todo.append((at[~has], lo, hi & ~_mask(bit, begin + _LEVELS), level + 1, mine, 0))
        stop.append(len(order))
    return Tree(np.array(low), np.array(high), np.array(children), np.array(first), np.array(stop),
                np.array(order, np.int64))


def _spread(first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, place): all places of the ranges, and the range each one is of."""
    size = stop - first
    which = np.repeat(np.arange(len(size)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + first[which]


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of code points differ by exactly one letter; ``b`` is as long or one longer."""
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(axis=1) == 1
    # Equal up to a place and, shifted by one, from there on.
    front = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= n


def pairs(tree: Tree, stored: np.ndarray, points: np.ndarray, vecs: np.ndarray, other: np.ndarray,
          among: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(stored, other) places of near words. ``vecs`` and ``other`` are the vectors and code
    points of the searching words, as long as the stored ones or one shorter; ``among``:
    they are the stored words, and each pair is wanted once."""
    radius = 2 if points.shape[1] == other.shape[1] else 1
    step = max(1, min(_PAIRS, _LETTERS // max(1, points.shape[1])))
    for lo in range(0, len(vecs), 2048):
        leaf, query = tree.reach(vecs[lo:lo + 2048], radius)
        sizes = np.cumsum(tree.stop[leaf] - tree.first[leaf])
        cuts = np.unique([0, *np.searchsorted(sizes, np.arange(step, sizes[-1] if len(sizes) else 0, step)),
                          len(leaf)])
        for x, y in zip(cuts, cuts[1:], strict=False):
            which, place = _spread(tree.first[leaf[x:y]], tree.stop[leaf[x:y]])
            s, q = tree.order[place], query[x:y][which] + lo
            if among:
                s, q = s[s < q], q[s < q]
            close = np.bitwise_count(stored[s] ^ vecs[q]).sum(axis=1, dtype=np.int64) <= radius
            s, q = s[close], q[close]
            for z in range(0, len(s), step):
                i, j = s[z:z + step], q[z:z + step]
                ok = one_edit(other[j], points[i])
                yield i[ok], j[ok]


def _planes(words: DataFrame, cell: int, sample: int) -> dict[int, Tree]:
    """A tree of cells for each length that has more words than a cell."""
    sizes = words.groupBy("length").count().where(F.col("count") > cell).collect()
    out = {}
    for r in sizes:
        some = words.where(F.col("length") == r["length"])
        every = max(1, 2 * r["count"] // sample)
        got = [x["word"] for x in some.where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0)
               .limit(sample).select("word").collect()]
        vecs = vectors(letters(got, r["length"]))
        depth = max(1, int(np.ceil(np.log2(r["count"] / cell))))
        out[r["length"]] = plant(vecs, max(1, len(vecs) >> depth + 2), tight=False, depth=depth)
    return out


def _route(batches: Iterator[pa.RecordBatch], trees: dict[int, Tree]) -> Iterator[pa.RecordBatch]:
    """A stored row for every word and a probing row for every other cell in reach."""
    for whole in batches:
        for lo in range(0, whole.num_rows, 4096):
            b = whole.slice(lo, 4096)
            length = b.column("length").to_numpy()
            words = b.column("word").to_pylist()
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                vecs = vectors(letters([words[i] for i in at], int(n)))
                rows = []
                own = np.zeros(len(at), np.int64)
                if n in trees:
                    leaf, query = trees[n].reach(vecs, 0)
                    own[query] = leaf
                    leaf, query = trees[n].reach(vecs, 2)
                    after = leaf > own[query]
                    rows.append((n, leaf[after], query[after], True))
                rows.append((n, own, np.arange(len(at)), False))
                if n + 1 in trees:
                    rows.append((n + 1, *trees[n + 1].reach(vecs, 1), True))
                else:
                    rows.append((n + 1, np.zeros(len(at), np.int64), np.arange(len(at)), True))
                for size, cell, query, probe in rows:
                    take = pa.array(at[query])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(cell), size, np.int64)), pa.array(cell.astype(np.int64)),
                         pa.array(np.full(len(cell), probe)), b.column("word").take(take),
                         b.column("n").take(take)], names=["size", "cell", "probe", "word", "n"])


def _search(batches: Iterator[pa.RecordBatch], leaf: int) -> Iterator[pa.RecordBatch]:
    """Near words of a partition sorted by (size, cell, pair, probe): a cell's stored words are
    kept, the probing ones are worked off as they come."""
    current: tuple | None = None
    held: list[pa.RecordBatch] = []
    built: tuple | None = None

    def rows(a: pa.RecordBatch | pa.Table, i: np.ndarray, b: pa.RecordBatch | pa.Table,
             j: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Each pair from both sides."""
        for x, p, y, q in ((a, i, b, j), (b, j, a, i)):
            yield pa.RecordBatch.from_arrays(
                [_flat(x["word"].take(pa.array(p))), _flat(y["word"].take(pa.array(q))),
                 _flat(y["n"].take(pa.array(q)))], names=["word", "near", "near_n"])

    def build() -> Iterator[pa.RecordBatch]:
        nonlocal built
        size, _, pair = current
        t = pa.Table.from_batches(held)
        points = letters(t["word"].to_pylist(), size)
        vecs = vectors(points)
        tree = plant(vecs, leaf, tight=True)
        built = t, points, vecs, tree
        # Two cuts of a crowded cell meet, or a cell's words meet each other.
        if pair // _WIDE == pair % _WIDE:
            for i, j in pairs(tree, vecs, points, vecs, points, True):
                yield from rows(t, i, t, j)

    for b in batches:
        if not b.num_rows:
            continue
        keys = [b.column(c).to_numpy(zero_copy_only=False) for c in ("size", "cell", "pair", "probe")]
        change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        cuts = [0, *change.tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            key = tuple(int(k[lo]) for k in keys[:3])
            if key != current:
                if held and built is None:
                    yield from build()
                held, built, current = [], None, key
            part = b.slice(lo, hi - lo)
            if not keys[3][lo]:
                held.append(part)
            elif held:
                if built is None:
                    yield from build()
                t, points, vecs, tree = built
                words = part.column("word").to_pylist()
                for n in sorted({len(w) for w in words}):
                    at = np.flatnonzero([len(w) == n for w in words])
                    mine = letters([words[i] for i in at], n)
                    for i, j in pairs(tree, vecs, points, vectors(mine), mine, False):
                        yield from rows(t, i, part, at[j])
    if held and built is None:
        yield from build()


def _flat(a: pa.Array | pa.ChunkedArray) -> pa.Array:
    return a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a


def near(words: DataFrame, cell: int = CELL, crowd: int = CROWD, leaf: int = LEAF,
         sample: int = SAMPLE) -> DataFrame:
    """(word, near, near_n): every pair of distinct words (word, n) that are one edit apart,
    from both sides."""
    sized = words.select("word", "n", F.char_length("word").alias("length"))
    trees = words.sparkSession.sparkContext.broadcast(_planes(sized, cell, sample))
    routed = sized.mapInArrow(lambda it: _route(it, trees.value),
                              "size long, cell long, probe boolean, word string, n long")
    routed = stage(routed, "routed-words").df
    crowded = stage(routed.where("NOT probe").groupBy("size", "cell").count().where(F.col("count") > crowd)
                    .select("size", "cell", F.ceil(F.col("count") / crowd).cast("int").alias("cuts")), "crowds")
    if crowded.rows:
        cut = join_small(routed, crowded, ["size", "cell"], "left")
        cuts = F.coalesce("cuts", F.lit(1))
        mine = F.pmod(F.xxhash64("word"), cuts).cast("int")
        every = F.sequence(F.lit(0), cuts - 1)
        # A stored word meets its own cut and, from the smaller to the larger, each other one,
        # where it probes; a probing word meets every cut.
        to = F.transform(every, lambda i: F.struct(
            F.when(F.col("probe"), i * F.lit(_WIDE).cast("long") + i).otherwise(
                F.least(i, mine) * F.lit(_WIDE).cast("long") + F.greatest(i, mine)).alias("pair"),
            (F.col("probe") | (i < mine)).alias("probe")))
        routed = (cut.select("size", "cell", "word", "n", F.explode(to).alias("to"))
                  .select("size", "cell", "to.pair", "to.probe", "word", "n"))
    else:
        routed = routed.withColumn("pair", F.lit(0).cast("long"))
    return (routed.repartition("size", "cell", "pair").sortWithinPartitions("size", "cell", "pair", "probe")
            .mapInArrow(lambda it: _search(it, leaf), "word string, near string, near_n long"))


def _ends(forms: DataFrame) -> Staged:
    """(word, root): where the chain of forms of every word with a form ends."""
    p = stage(forms.select("word", F.col("form").alias("root")), "spelling-ends")
    while p.rows:
        up = Staged(p.df.select(F.col("word").alias("root"), F.col("root").alias("up")), p.rows, p.bytes)
        q = stage(join_small(p.df, up, "root", "left").select(
            "word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), "spelling-ends")
        p = Staged(q.df.select("word", "root"), q.rows, q.bytes)
        if not q.df.where("moved").limit(1).count():
            break
    return p


def variants(words: DataFrame, word_col: str = "word", n_col: str = "n", ratio: int = RATIO,
             cell: int = CELL, crowd: int = CROWD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every distinct word."""
    base = pick(words, word=word_col, n=n_col).where("word <> '' AND n > 0")
    counted = stage(base.groupBy("word").agg(F.sum(F.col("n").cast("long")).alias("n")), "words").df
    best: Column = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    around = near(counted, cell, crowd).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    known = stage(counted.join(around, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best"))
        .select("word", "n", "n_near", F.col("best.near").alias("form"),
                (-F.col("best.less")).alias("form_n")), "spelling-forms").df
    ends = _ends(known.where("form IS NOT NULL"))
    return join_small(known, ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
