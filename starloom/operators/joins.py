"""Join helpers: broadcast only behind a measured size bound.

A side is broadcast only when its exact row count and payload are known to
be under the limits: either measured while it was staged (``Staged``), or
measured by one distributed aggregate over it.
Anything larger is left to a shuffle join; AQE may still switch that to a
broadcast at runtime from the real shuffle sizes, and it splits skewed
partitions of the big side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import Staged, payload_expr

MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
SALT_BUCKETS = 16


def bounded_size(df: DataFrame, cap: int) -> tuple[int, int] | None:
    """(rows, bytes) of ``df`` if it has at most ``cap`` rows, else ``None``.

    A plain distributed aggregate (partial counts per task, combined), so
    nothing is gathered into one task. (A ``limit(cap + 1)`` probe would
    funnel up to ``cap`` rows from every partition through a single-partition
    exchange, i.e. possibly the whole table.)
    """
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(payload_expr(df)).alias("b")).first()
    n = int(row["n"])
    return (n, int(row["b"] or 0)) if n <= cap else None


def bounded_count(df: DataFrame, cap: int) -> int | None:
    """Exact row count if it is at most ``cap``, else ``None`` (distributed
    count, see :func:`bounded_size`)."""
    n = df.count()
    return n if n <= cap else None


def fits_broadcast(small: DataFrame | Staged, max_rows: int = MAX_BROADCAST_ROWS,
                   max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True only when ``small`` is proven to be at most ``max_rows`` rows and
    ``max_bytes`` of payload."""
    if isinstance(small, Staged):
        return small.rows <= max_rows and small.bytes <= max_bytes
    size = bounded_size(small, max_rows)
    return size is not None and size[1] <= max_bytes


def skew_splitting_on(spark) -> bool:
    """Whether AQE will split skewed join partitions at runtime."""
    conf = spark.conf
    return (conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
            and conf.get("spark.sql.adaptive.skewJoin.enabled", "true").lower() == "true")


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str,
                salt_by: Sequence[str], buckets: int = SALT_BUCKETS) -> DataFrame:
    """Shuffle join that spreads every key of ``big`` over ``buckets`` tasks.

    ``big`` gets a salt from a hash of ``salt_by`` (deterministic, so a
    retried task sees the same salt); ``small`` is replicated once per salt
    value. Each ``big`` row meets exactly one replica, so inner and left
    joins keep their meaning, and a key holding a third of ``big`` is cut
    into ``buckets`` pieces.
    """
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(buckets)))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                            F.lit(buckets - 1).cast("long"))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def join_small(big: DataFrame, small: DataFrame | Staged, on: str | Sequence[str],
               how: str = "inner", *, max_rows: int = MAX_BROADCAST_ROWS,
               max_bytes: int = MAX_BROADCAST_BYTES,
               salt_by: Sequence[str] | None = None) -> DataFrame:
    """Equi-join that broadcasts ``small`` only if its size is proven.

    Otherwise it is a shuffle join: AQE splits skewed partitions of ``big``
    at runtime, and where that is switched off and ``salt_by`` names
    row-identifying columns of ``big``, the join is salted instead.
    """
    side = small.df if isinstance(small, Staged) else small
    if fits_broadcast(small, max_rows, max_bytes):
        return big.join(F.broadcast(side), on, how)
    if salt_by and not skew_splitting_on(big.sparkSession):
        keys = [on] if isinstance(on, str) else list(on)
        return salted_join(big, side, keys, how, salt_by)
    return big.join(side, on, how)
