"""SimHash near-duplicates by multi-index hashing.

Fingerprints: 64 bits over word shingles. Two fingerprints link when they differ in at
most ``radius`` bits; a document's component is everything reachable through links.

The 64 bits are cut into two segments. If two fingerprints differ in at most ``radius``
bits, one of the segments differs in at most ``radius // 2`` bits, so every fingerprint
is stored under its exact segment values and probes the values in the small Hamming ball
around them; whatever meets under a value is verified on all 64 bits.

* Copies collapse first: only distinct fingerprints (with the smallest id) are indexed,
  so a group of copies of any size is one row.
* Under one value no pairs are written out. The members stored there are joined into
  components and each prober is tied to the components it reaches, so a value gives at
  most one edge for each member, and one for each prober and component.
* A value that stores more than ``bucket_limit`` distinct fingerprints is cut further by
  the two halves of the other segment (again with a ball around them). Such a bucket has
  48 bits fixed, so it stores at most 65,536 distinct fingerprints however large the
  table is.

Defined results: a null text counts as empty; texts without words have fingerprint zero
and link like any other; ties and repeated rows share a component; a null id takes part
but is never a component's id unless the component holds nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import fresh, pick, roots
from starloom.operators.joins import join_small
from starloom.session import Staged, stage

RADIUS = 3
SHINGLE = 3
SEED = 42
_HALF = 0xFFFFFFFF


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of one text (ASCII lower case, words between ASCII blanks,
    ``shingle`` words joined by one space, repeats counted)."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, n)
    stop = np.cumsum(size + 1) - 1
    start = stop - size
    k = min(shingle, n)
    one = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    total = n - k + 1
    for lo in range(0, total, 1 << 16):
        hi = min(total, lo + (1 << 16))
        h = np.array([one(joined[a:b], seed) for a, b in
                      zip(start[lo:hi].tolist(), stop[lo + k - 1:hi + k - 1].tolist(), strict=True)],
                     dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(id, text_hash, fp) for every row; ``fp`` is the fingerprint's bits as a signed long."""
    base = pick(docs, id=id_col, text=text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in b.column("text").to_pylist()],
                           dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("text_hash"), pa.array(fps.view(np.int64), pa.int64())],
                names=["id", "text_hash", "fp"])

    kind = base.schema["id"].dataType.simpleString()
    return (base.select("id", F.xxhash64("text").alias("text_hash"), "text")
            .mapInArrow(work, f"id {kind}, text_hash long, fp long"))


def _masks(bits: int, ball: int) -> list[int]:
    return [sum(1 << b for b in c) for r in range(ball + 1) for c in combinations(range(bits), r)]


def _segment(fp: Column, seg: Column) -> Column:
    return F.when(seg == 0, F.shiftrightunsigned(fp, 32)).otherwise(fp.bitwiseAND(F.lit(_HALF)))


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _probes(fps: DataFrame, hot: Staged | None, radius: int) -> DataFrame:
    """(part, key, near, fp): every place where a fingerprint is stored (near false) or probes."""
    ball = radius // 2
    rows = (fps.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("part"))
            .withColumn("own", _segment(F.col("fp"), F.col("part")))
            .select("fp", "part", "own", F.explode(_longs(_masks(32, ball))).alias("mask"))
            .withColumn("key", F.col("own").bitwiseXOR(F.col("mask"))))
    # Of two values one bit apart, the one with the smaller value probes the other.
    forward = F.col("own") <= F.col("key")
    if hot is None:
        return rows.where(forward).select("part", "key", (F.col("mask") != 0).alias("near"), "fp")
    marks = Staged(hot.df.withColumn("hot", F.lit(True)), hot.rows, hot.bytes)
    own = Staged(hot.df.select("part", F.col("key").alias("own"), F.lit(True).alias("own_hot")),
                 hot.rows, hot.bytes)
    rows = join_small(join_small(rows, marks, ["part", "key"], "left"), own, ["part", "own"], "left")
    hot_key, hot_own = F.coalesce("hot", F.lit(False)), F.coalesce("own_hot", F.lit(False))
    cold = (rows.where(~hot_key & ~hot_own & forward)
            .select("part", "key", (F.col("mask") != 0).alias("near"), "fp"))
    # Into a crowded value everything probes; out of one, only into other crowded ones.
    other = _segment(F.col("fp"), 1 - F.col("part"))
    fine = (rows.where(hot_key)
            .select("fp", "part", "key", "mask", other.alias("other"),
                    F.explode(F.array(F.lit(0), F.lit(1))).alias("half"))
            .withColumn("sub", F.when(F.col("half") == 0, F.shiftrightunsigned("other", 16))
                        .otherwise(F.col("other").bitwiseAND(F.lit(0xFFFF))))
            .select("*", F.explode(_longs(_masks(16, ball))).alias("submask"))
            .select((2 + 2 * F.col("part") + F.col("half")).alias("part"),
                    (F.shiftleft("key", 16) + F.col("sub").bitwiseXOR(F.col("submask"))).alias("key"),
                    ((F.col("mask") != 0) | (F.col("submask") != 0)).alias("near"), "fp"))
    return cold.unionByName(fine)


def _components(stored: np.ndarray, radius: int) -> list[np.ndarray]:
    """Members of each component among the fingerprints stored under one value."""
    left, out = stored, []
    while len(left):
        group, front, left = [left[:1]], left[:1], left[1:]
        while len(front) and len(left):
            step, front, found = front, [], np.zeros(len(left), bool)
            for lo in range(0, len(step), 256):
                found |= (np.bitwise_count(step[lo:lo + 256, None] ^ left[None, :]) <= radius).any(axis=0)
            front, left = left[found], left[~found]
            group.append(front)
        out.append(np.concatenate(group))
    return out


def _reach(near: np.ndarray, groups: list[np.ndarray], radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    edges = []
    for g in groups:
        for lo in range(0, len(near), 1024):
            part = near[lo:lo + 1024]
            hit = np.zeros(len(part), bool)
            for at in range(0, len(g), 4096):
                hit |= (np.bitwise_count(part[:, None] ^ g[None, at:at + 4096]) <= radius).any(axis=1)
            got = part[hit]
            edges.append((np.full(len(got), g[0]), got))
    return edges


def _link_partition(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Edges of a partition that is sorted by (part, key, near). A value may span batches:
    its stored members are kept, its probers are worked off as they come."""
    def columns(b: pa.RecordBatch) -> list[np.ndarray]:
        return [b.column(0).to_numpy(), b.column(1).to_numpy(),
                b.column(2).to_numpy(zero_copy_only=False),
                b.column(3).to_numpy().view(np.uint64)]

    def emit(edges: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if edges:
            a, b = (np.concatenate(x) for x in zip(*edges, strict=True))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                                 names=["a", "b"])

    open_part = open_key = None
    stored: list[np.ndarray] = []
    groups: list[np.ndarray] | None = None

    def feed(near: np.ndarray, fp: np.ndarray, edges: list) -> None:
        nonlocal groups
        if (~near).any():
            stored.append(fp[~near])
        if near.any() and stored:
            if groups is None:
                groups = _components(np.concatenate(stored), radius)
                edges.extend((np.full(len(g) - 1, g[0]), g[1:]) for g in groups)
            edges.extend(_reach(fp[near], groups, radius))

    def close(edges: list) -> None:
        if groups is None and stored and sum(map(len, stored)) > 1:
            edges.extend((np.full(len(g) - 1, g[0]), g[1:])
                         for g in _components(np.concatenate(stored), radius))

    for batch in batches:
        if not batch.num_rows:
            continue
        part, key, near, fp = columns(batch)
        new = np.flatnonzero((part[1:] != part[:-1]) | (key[1:] != key[:-1])) + 1
        cuts = np.concatenate(([0], new, [len(key)]))
        edges: list[tuple[np.ndarray, np.ndarray]] = []
        # The first piece may continue the open value, the last one stays open.
        first = 0
        if open_key is not None and part[0] == open_part and key[0] == open_key:
            feed(near[:cuts[1]], fp[:cuts[1]], edges)
            first = 1
        if first < len(cuts) - 1:
            close(edges)
            begin, end = cuts[first:-2], cuts[first + 1:-1]
            sizes = end - begin
            live = (sizes > 1) & ~near[begin]
            kept = (np.add.reduceat((~near[:cuts[-2]]).astype(np.int64), begin) if len(begin)
                    else np.zeros(0, np.int64))
            single = live & (kept == 1)
            if single.any():
                lo, size = begin[single], sizes[single]
                heads = np.repeat(fp[lo], size - 1)
                at = np.repeat(lo + 1, size - 1) + _ramp(size - 1)
                ok = np.bitwise_count(heads ^ fp[at]) <= radius
                edges.append((heads[ok], fp[at][ok]))
            for i in np.flatnonzero(live & (kept > 1)):
                g = _components(fp[begin[i]:begin[i] + kept[i]], radius)
                edges.extend((np.full(len(x) - 1, x[0]), x[1:]) for x in g)
                edges.extend(_reach(fp[begin[i] + kept[i]:end[i]], g, radius))
            open_part, open_key, stored, groups = part[-1], key[-1], [], None
            feed(near[cuts[-2]:], fp[cuts[-2]:], edges)
        yield from emit(edges)
    last: list[tuple[np.ndarray, np.ndarray]] = []
    close(last)
    yield from emit(last)


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of ``sizes``, end to end."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def links(fps: DataFrame, radius: int = RADIUS, bucket_limit: int = 4096) -> DataFrame:
    """Edges (a, b) that connect exactly what links (distinct fingerprints that differ in at
    most ``radius`` bits) connect: within a bucket, members are tied to their component's
    first one instead of to each other. ``fps`` has one distinct column fp."""
    stored = fps.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("part"), "fp")
    crowded = stage(stored.groupBy("part", _segment(F.col("fp"), F.col("part")).alias("key"))
                    .count().where(F.col("count") > bucket_limit).select("part", "key"), "crowded")
    rows = _probes(fps, crowded if crowded.rows else None, radius)
    return (rows.repartition("part", "key").sortWithinPartitions("part", "key", "near")
            .mapInArrow(lambda it: _link_partition(it, radius), "a long, b long"))


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
          radius: int = RADIUS, bucket_limit: int = 4096) -> DataFrame:
    """(id, text_hash, fp, component, component_id) for every row; ``component`` is the smallest
    fingerprint of the component as a signed long, which names it even where ids repeat or
    are null."""
    sigs = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints").df
    reps = stage(sigs.groupBy("fp").agg(F.min("id").alias("first_id")), "distinct-fingerprints")
    ends = roots(stage(links(reps.df.select("fp"), radius, bucket_limit), "links").df)
    tied = ends.withColumnRenamed("v", "fp").join(reps.df, "fp")
    smallest = tied.groupBy("root").agg(F.min("first_id").alias("least"))
    least = tied.select("fp", "root").join(smallest, "root").select("fp", "root", "least")
    home = stage(reps.df.join(least, "fp", "left")
                 .select("fp", F.coalesce("root", "fp").alias("component"),
                         F.coalesce("least", "first_id").alias("component_id")), "components")
    return join_small(sigs, home, "fp").select("id", "text_hash", "fp", "component", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             radius: int = RADIUS) -> DataFrame:
    """One row of each component, all columns: the one with the component's id. Rows that
    repeat that id and its text are one row; unrelated components that share an id, or have
    none, keep one row each."""
    found = group(docs, id_col, text_col, shingle, radius)
    kept = stage(found.where(F.col("id").eqNullSafe(F.col("component_id")))
                 # The same id may come with several texts of one component: the first hash stays.
                 .groupBy("component", "id").agg(F.min("text_hash").alias("text_hash"),
                                                    F.count("*").alias("copies")), "kept")
    # 128 bits of id and text hash: 64 would meet by chance among some 1e9 documents.
    key, more = fresh(docs, "_key"), fresh(docs, "_more")
    keys = Staged(kept.df.select(F.xxhash64("id", "text_hash").alias(key),
                                 F.xxhash64(F.lit(1), "id", "text_hash").alias(more)), kept.rows, kept.bytes)
    own = [F.col(f"`{id_col}`"), F.xxhash64(F.col(f"`{text_col}`"))]
    marked = docs.withColumns({key: F.xxhash64(*own), more: F.xxhash64(F.lit(1), *own)})
    out = join_small(marked, keys, [key, more], "left_semi")
    if kept.df.where("copies > 1").limit(1).count():
        out = out.dropDuplicates([key, more])
    return out.select(*[f"`{c}`" for c in docs.columns])
