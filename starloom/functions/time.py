"""Timestamp parsing for mixed naive / offset-aware text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Any text after the time of day is a zone: Z, +hh:mm, a region id, an abbreviation.
# A date alone ("2020-01-15") has no zone, whatever its last "-dd".
_ZONED = r"\d:\d{2}(:\d{2}(\.\d*)?)?\s*[^\s\d:.].*$"


def parse_ts_utc(c: Column | str) -> Column:
    """Per-row parse of mixed timestamp text to a UTC instant.

    Offset-aware text (``2017-11-28T00:03:45-08:00``) is converted to UTC;
    naive text and date-only text (``2020-01-15``) is read as UTC, whatever
    the session time zone; anything unparseable (``garbage``, ``''``, a zone that
    is not known) becomes NULL instead of failing the job under ANSI mode.
    """
    text = F.trim(F.col(c) if isinstance(c, str) else c)
    zoned = text.try_cast("timestamp")
    wall = text.try_cast("timestamp_ntz")
    naive_as_utc = F.concat(wall.cast("string"), F.lit("Z")).try_cast("timestamp")
    return F.when(text.rlike(_ZONED), zoned).otherwise(naive_as_utc)


def epoch_micros(c: Column | str) -> Column:
    """Engine-neutral rendering of an instant (microseconds since epoch)."""
    return F.unix_micros(F.col(c) if isinstance(c, str) else c)
