"""Dense, reproducible surrogate keys 1..n in a given order.

Rows are range-partitioned and sorted within partitions; each row's position inside its
partition is taken from ``monotonically_increasing_id`` (partition index in the high bits,
position in the low 33 bits), and the per-partition row counts -- one row per partition, a
proven bound -- give the offsets through a small broadcast join. No task sees more than its
range. The ranged copy is written to the shared checkpoint folder first, so counts and
positions come from the same data even if executors are lost in between.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import materialize

_POS_BITS = 33


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def dense_keys(df: DataFrame, key_name: str, order_by: Sequence[str | Column], *,
               num_partitions: int | None = None, first: bool = True, drop: Sequence[str] = ()) -> DataFrame:
    """Add ``key_name`` = 1..n following ``order_by`` (which must be a total order over the
    rows; add the natural key as a tiebreak). The key column is placed first when ``first``.
    Columns in ``drop`` only give the order: they are not in the ranged copy nor in the result."""
    keyed = _range_keys(df, key_name, _order(order_by), num_partitions, drop)
    return keyed.select(key_name, *[c for c in df.columns if c not in drop]) if first else keyed


def _range_keys(df: DataFrame, key_name: str, order: list[Column],
                num_partitions: int | None, drop: Sequence[str]) -> DataFrame:
    spark = df.sparkSession
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(parts, *order)
              .sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = materialize(ranged.drop(*drop), f"keys-{key_name}")
    mask = (1 << _POS_BITS) - 1
    ranged = (ranged.withColumn("_pid", F.shiftright("_mid", _POS_BITS))
              .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(mask))))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    # ``offsets`` has one row per range partition: bounded, safe to broadcast.
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(key_name, (F.col("_off") + F.col("_pos") + 1).cast("int"))
            .drop("_mid", "_pid", "_pos", "_off"))
