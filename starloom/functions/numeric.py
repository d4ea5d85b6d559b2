"""Numeric helpers shared by the marts and the profiler."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c: Column | str, digits: int) -> Column:
    """``ROUND(x, d)`` with decimal half-up semantics, as MySQL applies to an
    exact average. Rounding the raw double differs between engines on exact
    ties, so the value is first fixed to 9 decimals (``DECIMAL(38,9)``, wide
    enough for any realistic magnitude). NaN, infinities and magnitudes
    beyond the decimal range pass through a plain double round."""
    col = F.col(c) if isinstance(c, str) else c
    fits = ~F.isnan(col) & (F.abs(col) < F.lit(1e28))
    return F.when(fits, F.round(col.cast("decimal(38,9)"), digits).cast("double")).otherwise(
        F.round(col.cast("double"), digits))


def avg_rounded(c: Column | str, digits: int) -> Column:
    return round_half_up(F.avg(c), digits)


def pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """``ROUND(100.0 * part / whole, digits)``."""
    return round_half_up(F.lit(100.0) * part / whole, digits)
