"""Benchmark decontamination: SimHash of item-sized windows, found by multi-index Hamming blocks.

Words are runs of letters and digits, lower-cased. An item of n words is a bag of five-word
shingles (an item of fewer words is one shingle). A document is contaminated by an item if
some window of n words has a weighted Jaccard similarity (weights: how often a shingle
occurs) of ``similarity`` or more with it.

1. Windows: for every item size that occurs, at every place that overlaps a shingle which
   an item of that size also has. A window without such a shingle has similarity zero with
   all of them, so none that could be accepted is left out; it is an exact bound, not a cap.
2. Each window and item gets a 64-bit SimHash of its weighted shingles and, where a shingle
   repeats, a second one in which each shingle counts once. One heavy shingle that is edited
   turns many bits of the first, one that is shared covers edits in the second.
3. The fingerprints are cut into ``radius + 1`` blocks. Two within ``radius`` bits agree in
   at least one block, so an equi-join on (size, block, value) finds every item within the
   radius; two fingerprints are taken in the first block they agree in, and their distance is
   checked.
4. The shingle texts of what remains are compared exactly.

SimHash is a filter that may miss: of windows at a similarity of just 0.8 the default radius
misses some hundredths (``tests/llm/test_decontaminate.py`` measures it), of closer ones fewer.

Equal texts are one text from the first shuffle on: windows are laid once for all copies.
Everything is built-in column functions. The items are broadcast only behind their
measured size; larger sets are joined by shuffle.

Defined results: null and empty texts are clean; null or wordless items contaminate
nothing; repeated rows get the same result each; equal items are all reported.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import fresh, pick
from starloom.operators.joins import join_small
from starloom.session import Staged, stage

WORDS_PER_SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 16


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _hash_at(words: Column, at: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(words, at + j) for j in range(k)])


def _hashes(words: Column, k: int) -> Column:
    """Shingle hashes of a word array in order (empty if it has fewer than k words)."""
    n = F.size(words)
    return F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), lambda i: _hash_at(words, i, k))
                  ).otherwise(F.array().cast("array<bigint>"))


def simhash(hashes: Column) -> Column:
    """SimHash of an array of 64-bit hashes: a bit is set if it is in over half of them.

    Two bits are counted at a time, in the halves of a long."""
    n, one = F.size(hashes), F.lit(1).cast("long")
    halves = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda j: F.aggregate(
        hashes, F.lit(0).cast("long"), lambda a, h: a + F.call_function(
            "shiftrightunsigned", h, j).bitwiseAND(F.lit(0x0000000100000001))))

    def bit(count: Column, at: Column) -> Column:
        return F.when(count * 2 > n, F.call_function("shiftleft", one, at)).otherwise(F.lit(0).cast("long"))

    bits = F.transform(halves, lambda both, j: bit(both.bitwiseAND(F.lit(0xFFFFFFFF)), j).bitwiseOR(
        bit(F.shiftrightunsigned(both, 32), j + 32)))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def fingerprints(hashes: Column) -> Column:
    """Array of the SimHash by weight and, if a hash repeats, the one that counts each once."""
    once = F.array_distinct(hashes)
    return F.when(F.size(once) == F.size(hashes), F.array(simhash(hashes))).otherwise(
        F.array_distinct(F.array(simhash(hashes), simhash(once))))


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(shift, mask) of radius + 1 blocks that cover 64 bits."""
    count = radius + 1
    edges = [64 * i // count for i in range(count + 1)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(edges, edges[1:], strict=False)]


def _block_values(fp: Column, radius: int) -> Column:
    """Array of block values in block order."""
    shifts, masks = zip(*_blocks(radius), strict=True)
    at = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(m).cast("long").alias("m"))
                   for s, m in zip(shifts, masks, strict=True)])
    return F.transform(at, lambda b: F.call_function("shiftrightunsigned", fp, b["s"]).bitwiseAND(b["m"]))


def _first_shared(x: Column, radius: int) -> Column:
    """Number of the first block in which the xor ``x`` is zero."""
    return (F.array_position(_block_values(x, radius), F.lit(0).cast("long")) - 1).cast("int")


def _shingles(words: Column, k: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(words) - k + 1),
                       lambda i: F.array_join(F.slice(words, i, k), " "))


def _weighted_jaccard(a: Column, b: Column) -> Column:
    """Sum of the smaller weights over the sum of the larger ones, of two shingle arrays."""
    def times(of: Column, s: Column) -> Column:
        return F.size(F.filter(of, lambda x: x == s))

    shared = F.aggregate(F.array_intersect(a, b), F.lit(0),
                         lambda acc, s: acc + F.least(times(a, s), times(b, s)))
    return shared / (F.size(a) + F.size(b) - shared)


def prepare_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                  radius: int = RADIUS) -> Staged:
    """(item_id, words, n, k, hashes, fps) of every item with words."""
    base = (pick(items, item_id=id_col, text=text_col)
            .select("item_id", words_of(F.col("text")).alias("words"))
            .withColumn("n", F.size("words")).where("n > 0")
            .withColumn("k", F.least("n", F.lit(WORDS_PER_SHINGLE))))
    hashes = F.coalesce(*[F.when(F.col("k") == k, _hashes(F.col("words"), k))
                          for k in range(1, WORDS_PER_SHINGLE + 1)])
    return stage(base.withColumn("hashes", hashes).withColumn("fps", fingerprints(F.col("hashes"))),
                 "benchmark-items")


def _seeds(docs: DataFrame, items: Staged, ks: list[int]) -> DataFrame:
    """(key, n, pos): shingles of documents that items of n words have too."""
    wanted = (items.df.select("n", "k", F.explode("hashes").alias("h")).distinct()
              .groupBy("k", "h").agg(F.collect_set("n").alias("sizes")))
    held = stage(wanted, "benchmark-shingles")
    parts = []
    for k in ks:
        rows = (docs.select("key", words_of(F.col("text")).alias("words"))
                .where(F.size("words") >= k)
                .select("key", "words", F.explode(F.sequence(F.lit(0), F.size("words") - k)).alias("pos"))
                .select("key", "pos", F.lit(k).alias("k"), _hash_at(F.col("words"), F.col("pos"), k).alias("h")))
        parts.append(join_small(rows, held, ["k", "h"]).select("key", "k", "pos", "sizes"))
    return reduce(DataFrame.unionByName, parts)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(key, item_id, similarity): one row for each contaminated document and item, with the
    best window's similarity. ``key`` is ``text_key(text)``: equal texts have one."""
    base = pick(docs, text=text_col).select(text_key(F.col("text")).alias("key"), "text")
    ready = prepare_items(items, radius=radius)
    ks = sorted(r["k"] for r in ready.df.select("k").distinct().collect())  # at most five values
    if not ks:
        return base.select("key", F.lit(0).cast("long").alias("item_id"),
                           F.lit(0.0).alias("similarity")).where("false")
    seeds = stage(_seeds(base, ready, ks).select("key", "k", "pos", F.explode("sizes").alias("n"))
                  .groupBy("key").agg(F.collect_set(F.struct("n", "k", "pos")).alias("seeds")),
                  "benchmark-seeds")
    # Copies meet here: one row for each text, combined map-side.
    one = join_small(base, Staged(seeds.df.select("key"), seeds.rows, 16 * seeds.rows), "key").groupBy("key").agg(
        F.first("text").alias("text"))
    texts = join_small(one, seeds, "key").select("key", "seeds", words_of(F.col("text")).alias("words"))

    def starts(s: Column) -> Column:
        m = s["n"] - s["k"] + 1
        last = F.greatest(F.size("words") - s["n"], F.lit(0))
        return F.transform(F.sequence(F.greatest(s["pos"] - m + 1, F.lit(0)), F.least(s["pos"], last)),
                           lambda i: F.struct(s["n"].alias("n"), s["k"].alias("k"), i.alias("start")))

    windows = (texts.select("key", "words", F.explode(F.array_distinct(F.flatten(
                   F.transform("seeds", starts)))).alias("w"))
               .select("key", F.col("w.n").alias("n"), F.col("w.k").alias("k"),
                       F.slice("words", F.col("w.start") + 1, F.col("w.n")).alias("window"))
               .withColumn("hashes", F.coalesce(*[F.when(F.col("k") == k, _hashes(F.col("window"), k))
                                                  for k in ks]))
               .withColumn("wfps", fingerprints(F.col("hashes"))).drop("hashes"))
    # Written once: filters on a fingerprint or a similarity would otherwise be pushed down to
    # where the texts are cut and compute them there again.
    windows = stage(windows, "windows").df
    each = ready.df.select("n", "item_id", F.col("words").alias("item"), F.explode("fps").alias("ifp"))
    table = Staged(each.select("*", F.posexplode(_block_values(F.col("ifp"), radius)).alias("block", "value")),
                   2 * ready.rows * (radius + 1), 2 * ready.bytes * (radius + 1))
    probes = (windows.withColumn("wfp", F.explode("wfps")).drop("wfps")
              .select("*", F.posexplode(_block_values(F.col("wfp"), radius)).alias("block", "value")))
    x = F.col("wfp").bitwiseXOR(F.col("ifp"))
    near = (join_small(probes, table, ["n", "block", "value"])
            .where((F.bit_count(x) <= radius) & (_first_shared(x, radius) == F.col("block"))))
    pairs = stage(near.select("key", "item_id", _shingles(F.col("window"), F.col("k")).alias("a"),
                              _shingles(F.col("item"), F.col("k")).alias("b")), "window-pairs").df
    return (pairs.groupBy("key", "item_id")
            .agg(F.max(_weighted_jaccard(F.col("a"), F.col("b"))).alias("similarity"))
            .where(F.col("similarity") >= similarity))


def text_key(text: Column) -> Column:
    """128 bits that tell texts apart; null for a null text, which is clean."""
    return F.unhex(F.md5(text.cast("binary")))


def flag(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(id, contaminated, n_items, item_ids, similarity) for every row of ``docs``."""
    found = stage(contaminated(docs, items, id_col, text_col, similarity, radius)
                  .groupBy("key").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"),
                                      F.max("similarity").alias("similarity")), "contaminated")
    keyed = pick(docs, id=id_col, text=text_col).select(
        "id", text_key(F.col("text")).alias("key"))
    return (join_small(keyed, found, "key", "left")
            .select(F.col("id").alias(id_col), F.col("item_ids").isNotNull().alias("contaminated"),
                    F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
                    F.array_join(F.col("item_ids").cast("array<string>"), ",").alias("item_ids"),
                    F.coalesce("similarity", F.lit(0.0)).alias("similarity")))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark passage."""
    found = stage(contaminated(docs, items, id_col, text_col, similarity, radius)
                  .select("key").distinct(), "contaminated")
    key = fresh(docs, "_key")
    marked = docs.withColumn(key, text_key(F.col(f"`{text_col}`")))
    renamed = Staged(found.df.withColumnRenamed("key", key), found.rows, found.bytes)
    return join_small(marked, renamed, key, "left_anti").select(*[f"`{c}`" for c in docs.columns])
