"""SQL access to the warehouse: the five tables as temporary views, so
dashboard queries written in SQL run through ``spark.sql`` (Catalyst plans
them exactly like the DataFrame marts)."""

from __future__ import annotations

from starloom.operators.star import Star


def register_views(star: Star, prefix: str = "") -> list[str]:
    """Register ``<prefix>dim_artist`` ... ``<prefix>fact_track`` as
    temporary views on the star's session; returns the view names."""
    names = []
    for name, df in star.tables().items():
        df.createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names
