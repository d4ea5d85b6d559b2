"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.joins import join_small
from starloom.session import Staged, materialize, stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, renamed to the operator's own names. Whatever else
    the input carries cannot clash with them afterwards."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for dst, src in columns.items()])


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name, k = base, 0
    while name.lower() in taken:
        k += 1
        name = f"{base}_{k}"
    return name


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m`` (the fold of a labelled row)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(m))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected edge list.

    ``edges`` has two long columns (a, b); returns (v, root) for every vertex of
    an edge, root being the smallest vertex of its component.

    Contraction rounds: every vertex points at its smallest neighbour (or itself),
    the pointers are shortened until they end at a local minimum, and the edges are
    rewritten to those ends; an edge inside one end disappears. Each round at least
    halves the vertices of every unfinished component, so the number of rounds is
    logarithmic. A vertex with very many edges is only ever a key of a ``min``
    aggregate (combined map-side) or the probing side of a join on unique keys.
    Every round is cut by a table in the shared checkpoint folder.
    """
    live = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"),
                                              F.greatest("a", "b").alias("b")).distinct(), "edges")
    levels: list[DataFrame] = []
    while live.rows:
        pointers = _star(live.df)
        levels.append(pointers.df)
        ends = (_follow(_follow(live.df, pointers, "a"), pointers, "b").where("a <> b")
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        live = stage(ends, "edges")
    if not levels:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("root")).where("false")
    out = levels[0]
    for level in levels[1:]:
        # A vertex that ended a round on its own is missing from the next level.
        out = out.join(level.select(F.col("v").alias("root"), F.col("root").alias("_next")),
                       "root", "left").select("v", F.coalesce("_next", "root").alias("root"))
    return materialize(out, "roots")


def _follow(df: DataFrame, pointers: Staged, column: str) -> DataFrame:
    to = Staged(pointers.df.select(F.col("v").alias(column), F.col("root").alias("_to")),
                pointers.rows, pointers.bytes)
    return join_small(df, to, column).drop(column).withColumnRenamed("_to", column)


def _star(edges: DataFrame) -> Staged:
    """(v, root): smallest neighbour or itself, shortened until roots point at themselves."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    p = stage(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("_m"))
              .select("v", F.least("v", "_m").alias("root")), "pointers")
    while True:
        up = Staged(p.df.select(F.col("v").alias("root"), F.col("root").alias("_up")), p.rows, p.bytes)
        q = stage(join_small(p.df, up, "root")
                  .select("v", F.col("_up").alias("root"), (F.col("_up") != F.col("root")).alias("moved")),
                  "pointers")
        moved = q.df.where("moved").limit(1).count()
        p = Staged(q.df.select("v", "root"), q.rows, q.bytes)
        if not moved:
            return p


class Memory:
    """A bounded table of results in two halves: a full young half becomes the old one, and
    what is still asked for moves back. Never holds more than ``2 * half`` entries."""

    def __init__(self, half: int):
        self.half = half
        self.young: dict = {}
        self.old: dict = {}

    def recall(self, key):
        """What is known of a key that the young half lacks, or None."""
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.half:
            self.old, self.young = self.young, {}
        self.young[key] = value


def slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``size`` bytes, so that outputs stay small."""
    step = max(1, batch.num_rows * size // max(1, batch.nbytes))
    for lo in range(0, batch.num_rows, step):
        yield batch.slice(lo, step)
