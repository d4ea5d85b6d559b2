"""Per-entity award statistics and the zero-filled left join onto the spine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import join_small
from starloom.schemas import ROW_ORD, STAT_COLUMNS
from starloom.session import Staged, stage


def award_stats(awards: DataFrame, key: str = "artist_norm", flag: str = "winner",
                year: str = "year", exclude: str = "unknown") -> DataFrame:
    """One row per entity: nominations, wins, first and last year.

    The ``exclude`` bucket (rows whose entity was missing) is filtered before
    the aggregate, so it never reaches the shuffle. All four aggregates are
    partial-aggregation friendly, so a hot entity is pre-combined map-side.
    """
    return (awards.filter(F.col(key) != F.lit(exclude))
            .groupBy(key)
            .agg(F.count(F.lit(1)).cast("int").alias("grammy_nominations"),
                 F.count_if(F.col(flag)).cast("int").alias("grammy_wins"),
                 F.min(year).cast("int").alias("first_grammy_year"),
                 F.max(year).cast("int").alias("last_grammy_year")))


def enrich(spine: DataFrame, stats: DataFrame | Staged, key: str = "artist_norm",
           stat_cols: Sequence[str] = STAT_COLUMNS, fill: int = 0,
           stage_stats: bool = True) -> DataFrame:
    """Left-join ``stats`` onto ``spine`` (every spine row survives, row count
    unchanged) and zero-fill entities without stats, keeping integer type.

    The stats side is staged once so its size check reads stored rows; it
    is broadcast only when that check proves it small, otherwise the join
    shuffles and AQE splits a skewed spine partition.
    """
    if stage_stats and not isinstance(stats, Staged):
        stats = stage(stats, "award-stats")
    salt = [ROW_ORD] if ROW_ORD in spine.columns else None
    joined = join_small(spine, stats, key, "left", salt_by=salt)
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.lit(fill)).cast("int") for c in stat_cols})
