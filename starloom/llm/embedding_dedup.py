"""Embedding near-duplicates: ITQ codes, multi-index Hamming tables, exact rerank.

1. Codes: vectors are scaled to unit length; a bounded sample gives a mean, principal axes
   and a rotation learned by iterative quantisation (alternate between the nearest corner of
   the cube and the rotation that fits the corners best), which spreads variance evenly over
   the bits. Every vector is coded, not only the sample. A code has as many 64-bit words, each
   with a rotation of its own, as pairs planted in the sample at exactly the threshold need
   to meet with a share of ``RECALL``, for each of the ``LENGTHS`` most frequent vector lengths
   on its own. If ``CODES`` words do not get there, shorter segments are tried, and if these
   do not either all vectors are one neighbourhood, which is exact and quadratic.
2. Tables: a word is cut into segments of 16, 21 or 32 bits, the more bits the more vectors,
   so that a segment's value stays rare. Codes meet that have a segment within ``ball``
   bits. A table is dealt by the upper bits of the segment: a code goes to its own part and to
   the parts in reach of those upper bits, and the ball over the lower bits is enumerated
   in the task, so few rows are shuffled. Codes that meet are verified by their distance over
   ``VERIFY`` words, with the reach that planted pairs have, which random codes do not get
   near at any number of vectors. They are tied to each other by a tree, never by all pairs.
   A crowded part is cut, members and visitors alike.
3. Rerank: the original vectors of a neighbourhood are compared by exact cosine in double
   precision. A neighbourhood of more than ``block`` vectors is cut into blocks and every
   pair of blocks is a task of its own. Tasks return for each vector how many vectors it
   links with and one edge, so what is written is linear in the vectors, not in the links.

Equal vectors are one vector with a weight from the start.

Defined results: a vector that is null or empty, has null, NaN or infinite components, or
is all zeros links with nothing (0 links, its own component, kept); vectors of different
length never link; repeated rows link with each other; rows with a null id count as links
of others but never name a component unless it has no other id.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import pick, roots
from starloom.llm.simhash_dedup import _longs, _masks
from starloom.operators.joins import join_small
from starloom.session import stage

COSINE = 0.9
#: (most vectors, bits of a segment, ball around it): a segment has about as many values as there are vectors.
WIDTHS = ((1 << 20, 16, 2), (1 << 26, 21, 1), (1 << 62, 32, 1))
#: Segments to fall back on, shortest last.
SHORTER = ((16, 2), (8, 1))
#: Within this many bits of a word, 16-bit segments are sure to meet.
RADIUS = 11
#: Bounds: vectors the rotation is learned from, vectors of a rerank block, members of one
#: part of a table in one task, candidate pairs held at once.
SAMPLE, BLOCK, CROWD, CHUNK = 10_000, 2048, 1 << 14, 1 << 20
#: Share of planted pairs that must meet, the most words for it, pairs planted of a kind, vector
#: lengths for which they are planted.
RECALL, CODES, PLANTED, LENGTHS = 0.95, 40, 2000, 8
#: Words that verify a meeting, and the share of planted pairs within the reach.
VERIFY, WITHIN = 3, 0.999
_BITS = 64
#: Numbers of cuts fit below this, so a pair of them is one long.
_WIDE = 1 << 20


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one without overflow."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def learn(sample: np.ndarray, rounds: int = 40, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) of iterative quantisation; a code bit is the sign of a projected
    component. With fewer dimensions than bits the rest are random directions."""
    mean = sample.mean(axis=0)
    x = sample - mean
    d = x.shape[1]
    _, axes = np.linalg.eigh(x.T @ x / max(len(x), 1))
    axes = axes[:, ::-1][:, :min(d, _BITS)]
    rng = np.random.default_rng(seed)
    v = x @ axes
    k = v.shape[1]
    r = np.linalg.qr(rng.normal(size=(k, k)))[0]
    for _ in range(rounds):
        corners = np.where(v @ r >= 0, 1.0, -1.0)
        u, _, w = np.linalg.svd(corners.T @ v)
        r = (u @ w).T
    more = rng.normal(size=(d, _BITS - k)) / np.sqrt(d)
    return mean, np.concatenate([axes @ r, more], axis=1)


def codes(x: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Signed 64-bit codes of unit rows (cut or filled with zeros to the learned length)."""
    bits = (_filled(x, len(mean)) - mean) @ projection >= 0
    return np.packbits(bits, axis=1).view(">u8").astype(np.uint64).view(np.int64).reshape(-1)


def planted(sample: np.ndarray, cosine: float, seed: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit rows at exactly ``cosine``: sampled vectors and what they become when they
    are turned towards the way another sampled vector differs from the mean, towards another
    one with the part along the mean kept, and towards any direction."""
    rng = np.random.default_rng(seed)
    x = sample[rng.permutation(len(sample))[:PLANTED]]
    x = np.tile(x, (-(-min(PLANTED, 500) // len(x)), 1))
    mean = sample.mean(axis=0)
    apart = sample[rng.integers(len(sample), size=len(x))] - mean
    m = mean / max(float(np.linalg.norm(mean)), 1e-12)
    along, level = x - (x @ m)[:, None] * m, (x @ m)[:, None]
    out = []
    for kind, turn in enumerate((apart, apart, rng.normal(size=x.shape))):
        if kind == 1:
            # On the sphere of equal parts along the mean: 1 - cosine = |along|^2 (1 - cosine there).
            size = np.linalg.norm(along, axis=1, keepdims=True)
            inner = 1 - (1 - cosine) / np.maximum(size * size, 1e-12)
            u = apart - (apart @ m)[:, None] * m
            u = u - ((u * along).sum(axis=1, keepdims=True) / np.maximum(size * size, 1e-12)) * along
            long = np.linalg.norm(u, axis=1, keepdims=True)
            ok = ((long > 1e-6) & (inner > -1) & (size > 1e-6))[:, 0]
            inner, size, long = inner[ok], size[ok], long[ok]
            y = level[ok] * m + inner * along[ok] + np.sqrt(1 - inner * inner) * size * u[ok] / long
        else:
            u = turn - (turn * x).sum(axis=1, keepdims=True) * x
            long = np.linalg.norm(u, axis=1, keepdims=True)
            ok = (long > 1e-6)[:, 0]
            y = cosine * x[ok] + np.sqrt(1 - cosine * cosine) * u[ok] / long[ok]
        if len(y):
            out.append((x[ok], y))
    return out


def _filled(x: np.ndarray, d: int) -> np.ndarray:
    """Rows cut or filled with zeros to ``d`` components."""
    out = np.zeros((len(x), d))
    out[:, :min(d, x.shape[1])] = x[:, :d]
    return out


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64))


def _meet(a: np.ndarray, b: np.ndarray, width: int, ball: int) -> np.ndarray:
    """Whether any segment of two words is within ``ball`` bits."""
    x = a.view(np.uint64) ^ b.view(np.uint64)
    mask = np.uint64((1 << width) - 1)
    return np.any([np.bitwise_count((x >> np.uint64(width * s)) & mask) <= ball
                   for s in range(_BITS // width)], axis=0)


def enough(sample: np.ndarray, cosine: float, width: int = 16, ball: int = 2,
           pairs: list[tuple[np.ndarray, np.ndarray]] | None = None,
           ) -> tuple[list[tuple[np.ndarray, np.ndarray]], float]:
    """(words, recall): (mean, projection) of as many words as planted pairs need to meet, and
    the smallest share of a kind of pairs that does."""
    pairs = planted(sample, cosine) if pairs is None else pairs
    met = [np.zeros(len(a), bool) for a, _ in pairs]
    out: list[tuple[np.ndarray, np.ndarray]] = []
    share = 0.0
    while share < RECALL and len(out) < CODES:
        out.append(learn(sample, seed=3 + len(out)))
        for hit, (a, b) in zip(met, pairs, strict=True):
            hit |= _meet(codes(a, *out[-1]), codes(b, *out[-1]), width, ball)
        share = min((float(hit.mean()) for hit in met), default=1.0)
    return out, share


def reach(pairs: list[tuple[np.ndarray, np.ndarray]], words: list[tuple[np.ndarray, np.ndarray]]) -> int:
    """Distance over all of ``words`` that a share of ``WITHIN`` of every kind of pairs keeps."""
    far = [sum(_far(codes(a, *w), codes(b, *w)).astype(int) for w in words) for a, b in pairs]
    return int(max((np.ceil(np.quantile(f, WITHIN)) for f in far), default=_BITS * len(words)))


def _usable(column: str) -> str:
    """SQL condition: can be compared by cosine."""
    return (f"{column} IS NOT NULL AND size({column}) > 0 AND NOT exists({column}, x -> x IS NULL OR isnan(x) "
            f"OR x = double('inf') OR x = double('-inf')) AND exists({column}, x -> x <> 0)")


def _coded(groups: DataFrame, learned: list[tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(g, codes, dim, weight, vec) of distinct vectors."""
    many = len(learned)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dim = b.column("dim").to_numpy()
            out = np.zeros((b.num_rows, many), np.int64)
            vec = b.column("vec")
            flat, ends = vec.values.to_numpy(), vec.offsets.to_numpy()
            for d in np.unique(dim):
                at = np.flatnonzero(dim == d)
                rows = flat[ends[at][:, None] + np.arange(d)]
                unit = _unit(rows)
                for k, (mean, projection) in enumerate(learned):
                    out[at, k] = codes(unit, mean, projection)
            every = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * many),
                                             pa.array(out.reshape(-1)))
            yield pa.RecordBatch.from_arrays([b.column("g"), every, b.column("dim"), b.column("weight"), vec],
                                             names=["g", "codes", "dim", "weight", "vec"])

    return groups.select("g", "dim", "weight", "vec").mapInArrow(
        work, "g long, codes array<long>, dim int, weight long, vec array<double>")


def _tie(home: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Joins the groups of x[i] and y[i]; ``home`` names the smallest member of a group."""
    while True:
        a, b = home[x], home[y]
        open_ = a != b
        if not open_.any():
            return
        x, y, a, b = x[open_], y[open_], a[open_], b[open_]
        np.minimum.at(home, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = home[home]
            if np.array_equal(up, home):
                break
            home[:] = up


def _part_links(key: np.ndarray, words: np.ndarray, side: np.ndarray, inner: bool, masks: list[int],
                radius: int) -> np.ndarray:
    """For each row of a part the smallest row that it is tied to. Rows of side 0 are compared with
    those of side 1 if there are any, else with each other if ``inner``, and with those of side 2."""
    home = np.arange(len(key))
    stored = np.flatnonzero(side == 0)
    stored = stored[np.argsort(key[stored], kind="stable")]
    values = key[stored]
    own = not (side == 1).any()
    askers = [np.flatnonzero(side > 0)]
    if own and inner:
        askers.append(stored)
    for asking, itself in zip(askers, (False, True)):
        for mask in masks:
            to = key[asking] ^ mask
            at = np.arange(len(asking))
            if itself and mask:
                at = np.flatnonzero(key[asking] < to)
            lo = np.searchsorted(values, to[at], "left")
            if itself and not mask:
                lo = at + 1  # Of equal values, those after it.
            size = np.searchsorted(values, to[at], "right") - lo
            some = np.flatnonzero(size > 0)
            lo, size, who = lo[some], size[some], asking[at[some]]
            # As many askers at once as make about CHUNK pairs.
            ends = np.cumsum(size)
            first = 0
            while first < len(who):
                before = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, before + CHUNK, "right")))
                n = size[first:last]
                x = np.repeat(who[first:last], n)
                y = stored[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[first:last], n)]
                new = home[x] != home[y]
                x, y = x[new], y[new]
                if len(x):
                    near = np.bitwise_count(words[x] ^ words[y]).sum(axis=1, dtype=np.int64) <= radius
                    _tie(home, x[near], y[near])
                first = last
    return home


def _link_parts(batches: Iterator[pa.RecordBatch], masks: list[int], radius: int) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) of the runs of equal (part, to, pair) of a sorted partition."""
    held: list[pa.RecordBatch] = []
    current: tuple | None = None

    def done() -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        if t.num_rows > 1:
            v = t.column("v").to_numpy()
            words = np.stack([t.column(f"w{k}").to_numpy() for k in range(VERIFY)], axis=1).view(np.uint64)
            home = _part_links(t.column("key").to_numpy(), words, t.column("side").to_numpy(),
                               current[2] < _WIDE * _WIDE, masks, radius)
            tied = np.flatnonzero(home != np.arange(len(home)))
            yield pa.RecordBatch.from_arrays([pa.array(v[tied]), pa.array(v[home[tied]])], names=["a", "b"])

    for b in batches:
        if not b.num_rows:
            continue
        keys = [b.column(c).to_numpy() for c in ("part", "to", "pair")]
        change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        cuts = [0, *change.tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            at = tuple(k[lo].item() for k in keys)
            if at != current:
                if held:
                    yield from done()
                held, current = [], at
            held.append(b.slice(lo, hi - lo))
    if held:
        yield from done()


def _neighbourhoods(coded: DataFrame, tables: int, width: int, ball: int, radius: int, crowd: int) -> DataFrame:
    """(g, hood) for vectors with another one in reach; all others stand alone."""
    heads = stage(coded.groupBy("codes").agg(F.min("g").alias("v"), F.count("*").alias("n")), "code-heads")
    # The upper bits by which a table is dealt: as many as leave about ``crowd`` codes a part.
    high = min(width - 1, max(0, ceil(log2(max(1, heads.rows) / crowd))))
    segment = [F.shiftrightunsigned(F.col("codes")[t], width * s).bitwiseAND(F.lit((1 << width) - 1))
               for t in range(tables) for s in range(_BITS // width)]
    rows = heads.df.select("v", *[F.col("codes")[k].alias(f"w{k}") for k in range(VERIFY)],
                           F.posexplode(F.array(*segment)).alias("part", "key"))
    home = F.shiftrightunsigned("key", width - high)
    rows = (rows.withColumn("mask", F.explode(_longs(_masks(high, min(ball, high)) if high else [0])))
            .withColumn("to", home.bitwiseXOR(F.col("mask")))
            # Of two parts, codes of the smaller one visit the larger.
            .where(home <= F.col("to")).withColumn("visits", F.col("mask") != 0))
    visitors = 8 * crowd
    crowds = stage(rows.groupBy("part", "to").agg(F.count_if(~F.col("visits")).alias("members"),
                                                  F.count_if("visits").alias("guests"))
                   .where((F.col("members") > crowd) | (F.col("guests") > visitors))
                   .select("part", "to", F.greatest(F.lit(1), F.ceil(F.col("members") / crowd)).alias("cuts"),
                           F.greatest(F.lit(1), F.ceil(F.col("guests") / visitors)).alias("halls")), "crowds")
    first, guest = F.lit(0).cast("byte"), F.lit(2).cast("byte")
    if crowds.rows:
        # Members go to every pair with their own cut, visitors to each cut once; where these are
        # many they are cut too and members also go to each further cut of the visitors.
        rows = join_small(rows, crowds, ["part", "to"], "left")
        cuts, halls = F.coalesce("cuts", F.lit(1)).cast("long"), F.coalesce("halls", F.lit(1)).cast("long")
        mine, hall = F.pmod(F.xxhash64("v"), cuts), F.pmod(F.xxhash64(F.lit(1), "v"), halls)
        zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
        wide, hole = F.lit(_WIDE).cast("long"), F.lit(_WIDE * _WIDE).cast("long")
        among = F.transform(F.sequence(zero, cuts - 1), lambda i: F.struct(
            (F.least(i, mine) * wide + F.greatest(i, mine)).alias("pair"),
            F.when(i < mine, F.lit(1)).otherwise(0).cast("byte").alias("side")))
        further = F.transform(F.filter(F.sequence(zero, halls - 1), lambda p: p > 0), lambda p: F.struct(
            (p * hole + mine * wide + mine).alias("pair"), first.alias("side")))
        visit = F.transform(F.sequence(zero, cuts - 1), lambda i: F.struct(
            (hall * hole + i * wide + i).alias("pair"), guest.alias("side")))
        rows = rows.withColumn("go", F.explode(F.when(F.col("visits"), visit).otherwise(F.concat(among, further))))
        rows = rows.withColumn("pair", F.col("go.pair")).withColumn("side", F.col("go.side"))
    else:
        rows = (rows.withColumn("pair", F.lit(0).cast("long"))
                .withColumn("side", F.when(F.col("visits"), guest).otherwise(first)))
    masks = _masks(width, ball)
    edges = (rows.select("part", "to", "pair", "v", "key", "side", *[f"w{k}" for k in range(VERIFY)])
             .repartition("part", "to", "pair").sortWithinPartitions("part", "to", "pair")
             .mapInArrow(lambda it: _link_parts(it, masks, radius), "a long, b long"))
    near = stage(edges, "code-links").df
    shared = heads.df.where("n > 1").select("codes", "v")
    same = coded.select("g", "codes").join(shared, "codes").select(F.col("g").alias("a"), F.col("v").alias("b"))
    return roots(stage(same.unionByName(near), "vector-links").df).select(
        F.col("v").alias("g"), F.col("root").alias("hood"))


def _pairs(block: list[np.ndarray], pair: int, cosine: float) -> tuple[np.ndarray, ...]:
    """(g, links, root) of one block pair: links to vectors of the other cut, or of the same
    one on the diagonal; root ties everything that links in here."""
    g, weight, cut, vec = block
    x = _unit(vec)
    first, second = divmod(pair, _WIDE)
    left, right, same = np.flatnonzero(cut == first), np.flatnonzero(cut == second), first == second
    links = np.zeros(len(g), np.int64)
    home = np.arange(len(g))

    def find(i: int) -> int:
        while home[i] != i:
            home[i] = home[home[i]]
            i = home[i]
        return i

    for lo in range(0, len(left), 512):
        rows = left[lo:lo + 512]
        hit = x[rows] @ x[right].T >= cosine
        if same:
            hit[np.arange(len(rows)), np.arange(lo, lo + len(rows))] = False
        links[rows] += hit @ weight[right]
        if not same:
            links[right] += weight[rows] @ hit
        # Ties: a row to its first partner, and partners that share a row to each other.
        for r, partners in zip(rows, hit, strict=True):
            found = right[partners]
            if len(found):
                a = find(r)
                for f in np.unique(home[found]):
                    b = find(f)
                    home[max(a, b)] = a = min(a, b)
    root = np.array([find(i) for i in range(len(g))])
    return g, links, g[root]


def _rerank(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Runs of equal (hood, dim, pair) of a sorted partition, one at a time."""
    held: list[pa.RecordBatch] = []
    current: tuple | None = None

    def done() -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        if t.num_rows > 1:
            dim = t.column("dim")[0].as_py()
            vec = t.column("vec").combine_chunks()
            flat = vec.flatten().to_numpy() if not isinstance(vec, pa.ChunkedArray) else np.concatenate(
                [c.flatten().to_numpy() for c in vec.chunks])
            g, links, root = _pairs([t.column("g").to_numpy(), t.column("weight").to_numpy(),
                                     t.column("cut").to_numpy(), flat.reshape(-1, dim)],
                                    t.column("pair")[0].as_py(), cosine)
            yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(links), pa.array(root)],
                                             names=["g", "links", "root"])

    for b in batches:
        if not b.num_rows:
            continue
        keys = [b.column(c).to_numpy() for c in ("hood", "dim", "pair")]
        change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        cuts = [0, *change.tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            key = tuple(k[lo].item() for k in keys)
            if key != current:
                if held:
                    yield from done()
                held, current = [], key
            held.append(b.slice(lo, hi - lo))
    if held:
        yield from done()


def _plan(groups: DataFrame, n: int, sample: int, cosine: float) -> tuple | None:
    """(words, words that are tables, width, ball, reach), or None if no codes meet often enough."""
    counts = (groups.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).limit(LENGTHS)
              .select("dim").collect())
    lengths = [r["dim"] for r in counts]
    top = max(lengths)
    rows = (groups.where(F.col("dim").isin(lengths)).orderBy(F.xxhash64("vec"), "g").limit(sample)
            .select("vec").collect())
    by_length: dict[int, list] = {}
    for r in rows:
        by_length.setdefault(len(r["vec"]), []).append(r["vec"])
    units = [_unit(np.array(vectors)) for _, vectors in sorted(by_length.items())]
    learned_from = np.concatenate([_filled(x, top) for x in units])
    pairs = [(_filled(a, top), _filled(b, top)) for x in units for a, b in planted(x, cosine)]
    width, ball = next((w, b) for most, w, b in WIDTHS if n <= most)
    for width, ball in [(width, ball), *[s for s in SHORTER if s[0] < width]]:
        words, recall = enough(learned_from, cosine, width, ball, pairs)
        if recall >= RECALL:
            tables = len(words)
            words += [learn(learned_from, seed=3 + k) for k in range(tables, VERIFY)]
            return words, tables, width, ball, reach(pairs, words[:VERIFY])
    return None


def group(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE,
          sample: int = SAMPLE, block: int = BLOCK, crowd: int = CROWD) -> DataFrame:
    """(id, n_links, component_id) for every row."""
    base = pick(vectors, id=id_col, vec=vec_col).withColumn("vec", F.col("vec").cast("array<double>"))
    good = base.where(_usable("vec"))
    # Equal vectors: zeros of either sign are equal too.
    good = good.withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0)))
    # Rows find their vector's result by 128 bits of it; the vector itself moves only once.
    name = [F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2")]
    distinct = stage(good.groupBy("vec").agg(F.min("id").alias("least"), F.count("*").alias("weight"))
                     .withColumn("dim", F.size("vec")), "distinct-vectors")
    # Numbered as written; a written table is read back with the same numbers.
    groups = stage(distinct.df.withColumn("g", F.monotonically_increasing_id()), "vectors").df
    if not distinct.rows:
        return base.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    plan = _plan(groups, distinct.rows, sample, cosine)
    if plan is not None:
        words, tables, width, ball, radius = plan
        coded = stage(_coded(groups, words), "coded").df
        hoods = _neighbourhoods(coded, tables, width, ball, radius, crowd)
        placed = (join_small(coded, stage(hoods, "hoods"), "g", "left")
                  .select("g", "dim", "weight", "vec", F.coalesce("hood", "g").alias("hood")))
    else:
        placed = groups.select("g", "dim", "weight", "vec", F.lit(0).cast("long").alias("hood"))
    sizes = stage(placed.groupBy("hood", "dim").count().where("count > 1")
                  .select("hood", "dim", F.ceil(F.col("count") / block).cast("int").alias("cuts")), "hood-sizes")
    mine = F.pmod(F.xxhash64("g"), F.col("cuts")).cast("int")
    spread = (join_small(placed, sizes, ["hood", "dim"])
              .select("hood", "dim", "g", "weight", "vec", "cuts", mine.alias("cut"))
              .withColumn("pair", F.explode(F.transform(
                  F.sequence(F.lit(0), F.col("cuts") - 1),
                  lambda i: F.least(i, F.col("cut")).cast("long") * _WIDE + F.greatest(i, F.col("cut")))))
              .drop("cuts"))
    found = stage(spread.repartition("hood", "dim", "pair").sortWithinPartitions("hood", "dim", "pair", "g")
                  .mapInArrow(lambda it: _rerank(it, cosine), "g long, links long, root long"), "reranked").df
    ties = roots(found.select(F.col("g").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("g").agg(F.sum("links").alias("links"))
    homes = (groups.select("g", *name, "least", "weight")
             .join(links, "g", "left").join(ties.withColumnRenamed("v", "g"), "g", "left")
             .select("g", "h1", "h2", "least", F.coalesce("root", "g").alias("root"),
                     (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    homes = stage(homes, "homes").df
    named = homes.groupBy("root").agg(F.min("least").alias("component_id"))
    side = stage(homes.join(named, "root").select("h1", "h2", "n_links", "component_id"), "vector-components")
    out = join_small(good.select("id", *name), side, ["h1", "h2"]).select("id", "n_links", "component_id")
    rest = base.where(f"NOT coalesce({_usable('vec')}, false)").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return out.unionByName(rest)
