"""Records and source order of text files that many tasks read.

A file is read in splits, and a task sees only its own. Two things need more than one split:
the number of a row in the source, and, where quoted values hold line feeds, where records
begin. Both come from one small table with a row for each split.

* :func:`numbered`: rows of each split are counted; running sums over the splits, in the order
  of file names and places, give every row its number, whatever the partitioning.
* :func:`quoted_records`: whether a line lies inside a quoted value depends on all quotes before
  it. Each split reports the parity of its quotes and how many records begin in it under both
  hypotheses (it begins outside, or inside, a quoted value). A running parity over the splits
  picks one, and a second pass cuts the records. Only a record that crosses a split is put
  together from its pieces afterwards.

A double quote inside an unquoted value is not allowed (it would turn the parity); the reader
then finds records with a wrong number of fields and fails.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.operators.joins import join_small
from starloom.session import Staged, stage

_PLACE = ("_file", "_split")


def placed(df: DataFrame) -> DataFrame:
    """Adds file, split and a number that grows within a split to a plain scan of files."""
    return df.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
                     F.monotonically_increasing_id().alias("_at"), *[F.col(f"`{c}`") for c in df.columns])


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines (ended by a line feed) with their places."""
    return placed(spark.read.option("lineSep", "\n").text(path))


def _before(splits: DataFrame, rows: Column, headers: int) -> DataFrame:
    """(file, split, in_file, in_source): rows before each split in its file and in the source,
    ``headers`` rows of each file not counted. One row for each split of the input, as the scan's
    own plan has it."""
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    counted = splits.withColumn("_rows", rows.cast("long"))
    files = counted.groupBy("_file").agg((F.sum("_rows") - headers).alias("_n"))
    sooner = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_file", F.coalesce(F.sum("_n").over(sooner), F.lit(0)).alias("_files_before"))
    return (counted.withColumn("in_file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
            .join(files, "_file")
            .withColumn("in_source", F.col("_files_before") + F.col("in_file") - headers)
            .drop("_rows", "_files_before"))


def numbered(df: DataFrame, headers: int = 0) -> DataFrame:
    """A placed scan with ``_in_file`` (row number in the file, from 0) and ``_row_ord`` (row
    number in the source, headers not counted) in place of its places."""
    splits = df.groupBy(*_PLACE).agg(F.count(F.lit(1)).alias("_count"), F.min("_at").alias("_first"))
    base = stage(_before(splits, F.col("_count"), headers).select(*_PLACE, "_first", "in_file", "in_source"), "splits")
    inside = F.col("_at") - F.col("_first")
    kept = [c for c in df.columns if c not in (*_PLACE, "_at")]
    return join_small(df, base, list(_PLACE)).select(
        (F.col("in_file") + inside).alias("_in_file"), (F.col("in_source") + inside).alias("_row_ord"), *kept)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Array, np.ndarray]]:
    """(file, split, values, quotes) of runs of one split, in order."""
    for b in batches:
        if not b.num_rows:
            continue
        file, split = b.column("file").to_numpy(), b.column("split").to_numpy()
        new = np.flatnonzero((file[1:] != file[:-1]) | (split[1:] != split[:-1])) + 1
        cuts = [0, *new.tolist(), b.num_rows]
        quotes = pc.count_substring(b.column("value"), '"').to_numpy(zero_copy_only=False)
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            yield int(file[lo]), int(split[lo]), b.column("value").slice(lo, hi - lo), quotes[lo:hi]


def _parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split: its quotes' parity, records that begin in it from outside and from inside."""
    open_: list[int] | None = None

    def row(r: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in r],
                                          names=["file", "split", "parity", "outside", "inside"])

    for file, split, _, quotes in _groups(batches):
        if open_ is None or (file, split) != (open_[0], open_[1]):
            if open_ is not None:
                yield row(open_)
            open_ = [file, split, 0, 0, 0]
        before = open_[2] + np.cumsum(quotes) - quotes
        begun = int((before % 2 == 0).sum())
        open_[3] += begun
        open_[4] += len(quotes) - begun
        open_[2] = int(open_[2] + quotes.sum()) % 2
    if open_ is not None:
        yield row(open_)


def _cut(batches: Iterator[pa.RecordBatch], inside: dict[tuple[int, int], int]) -> Iterator[pa.RecordBatch]:
    """(file, split, pos, more, text): the records of each split. ``pos`` is -1 for lines that
    end a record of an earlier split; ``more``: the record goes on in the next split."""
    place: tuple[int, int] | None = None
    held: list[str] = []
    parity, pos = 0, -1

    def rows(out: list[tuple[int, bool, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([place[0]] * len(out), pa.int64()), pa.array([place[1]] * len(out), pa.int64()),
             pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.bool_()),
             pa.array([r[2] for r in out], pa.string())], names=["file", "split", "pos", "more", "text"])

    for file, split, values, quotes in _groups(batches):
        if (file, split) != place:
            if place is not None and held:
                yield rows([(pos, parity == 1, "\n".join(held))])
            place, held, parity, pos = (file, split), [], inside[file, split], -1
        out = []
        text = values.to_pylist()
        begun = np.flatnonzero((parity + np.cumsum(quotes) - quotes) % 2 == 0).tolist()
        parity = int(parity + quotes.sum()) % 2
        held += text[:begun[0] if begun else len(text)]
        for a, b in zip(begun, [*begun[1:], len(text)], strict=False):
            if held:
                out.append((pos, False, "\n".join(held)))
            held, pos = text[a:b], pos + 1
        if out:
            yield rows(out)
    if place is not None and held:
        yield rows([(pos, parity == 1, "\n".join(held))])


def quoted_records(spark: SparkSession, path: str, headers: int = 1) -> DataFrame:
    """(_in_file, _row_ord, value): the records of files whose quoted values may hold line feeds.
    The cut records are staged (they are numbered and put together from one copy)."""
    found = lines(spark, path).select("_file", F.xxhash64("_file").alias("file"), F.col("_split").alias("split"), "value")
    scan = found.select("file", "split", "value")
    names = stage(found.groupBy("file").agg(F.max("_file").alias("_file")), "files")
    splits = stage(scan.mapInArrow(_parities, "file long, split long, parity long, outside long, inside long"),
                   "parities")
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    chosen = splits.df.withColumn("start", F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2)
    broken = splits.df.groupBy("file").agg((F.sum("parity") % 2).alias("odd")).where("odd = 1")
    if broken.limit(1).count():
        name = names.df.join(broken, "file").agg(F.min("_file").alias("f")).first()["f"]
        raise ValueError(f"{name}: a quoted value is not closed")
    named = join_small(chosen, names, "file").select(
        "file", "_file", F.col("split").alias("_split"), "start",
        F.when(F.col("start") == 0, F.col("outside")).otherwise(F.col("inside")).alias("begun"))
    base = stage(_before(named, F.col("begun"), headers), "splits")
    # One number for each split, as many as the scan has tasks.
    inside = spark.sparkContext.broadcast({(r["file"], r["_split"]): r["start"] for r in
                                           base.df.select("file", "_split", "start").collect()})
    cut = stage(scan.mapInArrow(lambda it: _cut(it, inside.value),
                                "file long, split long, pos long, more boolean, text string"), "records").df
    whole = cut.where("pos >= 0 AND NOT more").select("file", "split", "pos", F.col("text").alias("value"))
    pieces = cut.where("pos < 0 OR more")
    order = Window.partitionBy("file").orderBy("split", "pos").rowsBetween(Window.unboundedPreceding, 0)
    owner = F.last(F.when(F.col("pos") >= 0, F.struct("split", "pos")), ignorenulls=True).over(order)
    # A record's pieces: the one it begins with and what later splits begin with.
    joined = (pieces.withColumn("owner", owner).groupBy("file", "owner")
              .agg(F.array_sort(F.collect_list(F.struct("split", "pos", "text"))).alias("pieces"))
              .select("file", "owner.split", "owner.pos",
                      F.array_join(F.transform("pieces", lambda p: p["text"]), "\n").alias("value")))
    at = Staged(base.df.select("file", F.col("_split").alias("split"), "in_file", "in_source"), base.rows, base.bytes)
    return join_small(whole.unionByName(joined), at, ["file", "split"]).select(
        (F.col("in_file") + F.col("pos")).alias("_in_file"), (F.col("in_source") + F.col("pos")).alias("_row_ord"),
        "value")
