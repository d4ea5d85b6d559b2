"""Source cleaning (null drop, full-row dedup, key derivation, type parsing)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from starloom.functions.text import blank_to_null, clean_text, normalize_key, parse_flag
from starloom.functions.time import parse_ts_utc
from starloom.schemas import ROW_ORD

TRACK_REQUIRED = ("artists", "album_name", "track_name")


def dedup_rows(df: DataFrame, order_col: str = ROW_ORD,
               subset: Sequence[str] | None = None) -> DataFrame:
    """Full-row distinct that keeps the first row in source order.

    The order column is excluded from the comparison and the kept row gets
    the lowest order value. NULLs (and NaNs) compare equal, as in pandas.
    Runs as a hash aggregate: the partial (map-side) step collapses copies
    before the shuffle, so even a group of copies holding a third of the
    table leaves each task with one row per group.
    """
    if order_col not in df.columns:
        return df.dropDuplicates(list(subset) if subset else None)
    keys = list(subset) if subset else [c for c in df.columns if c != order_col]
    others = [c for c in df.columns if c not in keys and c != order_col]
    aggs = [F.min(order_col).alias(order_col)]
    # Non-key columns (only with ``subset``) come from the first row.
    aggs += [F.min_by(c, order_col).alias(c) for c in others]
    return df.groupBy(*keys).agg(*aggs).select(*df.columns)


def dedup_wide_rows(df: DataFrame, order_col: str = ROW_ORD, reread: bool = False) -> DataFrame:
    """Keep-first full-row dedup for wide rows, exact.

    Phase 1 shuffles only a row signature, the upper 44 bits of a 64-bit hash; signatures seen once
    mark rows that are certainly unique, and those rows never move. Only rows in signature-collision
    groups (the actual copies, plus any hash collisions) go through the
    exact :func:`dedup_rows`. The candidate-signature table must be small enough to broadcast by
    its measured size; where copies are too many for that, all rows go through :func:`dedup_rows`,
    which moves them once. With ``reread`` whatever is grouped is staged, so the result can be
    read many times without moving rows again.
    """
    from starloom.operators.joins import fits_broadcast, join_small
    from starloom.session import stage

    def grouped(rows: DataFrame) -> DataFrame:
        kept = dedup_rows(rows, order_col)
        return stage(kept, "dedup-rows").df if reread else kept

    keys = [c for c in df.columns if c != order_col]
    # The bytes left out would be shuffled for every row; of 10^10 rows under 0.1 % are grouped for nothing.
    tagged = df.withColumn("_h", F.shiftrightunsigned(F.xxhash64(*keys), 20))
    repeated = stage(tagged.groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
                     .filter(F.col("_n") > 1).drop("_n"), "dedup-signatures")
    if not fits_broadcast(repeated):
        return grouped(df)
    # Grouping turns -0.0 into 0.0, so rows that are not grouped are shown likewise.
    zeros = {f.name: F.col(f.name) + F.lit(0.0).cast(f.dataType) for f in df.schema.fields
             if isinstance(f.dataType, (DoubleType, FloatType)) and f.name != order_col}
    if reread and not repeated.rows:
        return df.withColumns(zeros)
    unique = join_small(tagged, repeated, "_h", "left_anti").drop("_h").withColumns(zeros)
    copies = join_small(tagged, repeated, "_h", "left_semi").drop("_h")
    return unique.select(*df.columns).unionByName(grouped(copies))


def clean_tracks(df: DataFrame, required: Sequence[str] = TRACK_REQUIRED,
                 key_source: str = "artists", key_name: str = "artist_norm", reread: bool = False) -> DataFrame:
    """Drop rows missing a required field, collapse full-row copies, then
    derive the entity key (in this order, as the reference does). ``reread``: as
    in :func:`dedup_wide_rows`."""
    out = df.na.drop("any", subset=list(required))
    out = dedup_wide_rows(out, reread=reread) if ROW_ORD in out.columns else dedup_rows(out)
    return out.withColumn(key_name, normalize_key(key_source))


def clean_awards(df: DataFrame, drop: Sequence[str] = ("workers", "img"),
                 ts_cols: Sequence[str] = ("published_at", "updated_at"),
                 flag_col: str = "winner", text_cols: Sequence[str] = ("category", "nominee"),
                 key_source: str = "artist", key_name: str = "artist_norm",
                 null_text: str | None = None) -> DataFrame:
    """Awards cleaning: drop unused columns, blank text to NULL, per-row UTC
    timestamp parse, text flag to boolean, case-folded text, entity key.

    ``null_text='<na>'`` reproduces the reference rendering of missing
    category/nominee values; the default keeps them NULL.
    """
    out = df.drop(*drop)
    out = blank_to_null(out)
    out = out.withColumns({c: parse_ts_utc(c) for c in ts_cols if c in out.columns})
    out = out.withColumn(flag_col, parse_flag(flag_col))
    out = out.withColumns({c: clean_text(c, null_text) for c in text_cols})
    return out.withColumn(key_name, normalize_key(key_source))
