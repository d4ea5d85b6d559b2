"""Scalar text rules, all as JVM-side Column expressions (no Python UDFs)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The characters Python's ``str.strip()`` removes are the Unicode
# White_Space set plus the four information separators U+001C..U+001F.
# ``(?U)\s`` in Java covers the former; the class adds the latter.
_WS = r"[\s\x1c-\x1f]"
STRIP_PATTERN = rf"(?U)^{_WS}+|{_WS}+\z"

# pandas' default missing-value tokens for CSV reads
# (``pandas.read_csv`` ``na_values`` defaults), matched exactly, not stripped.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """Strip leading/trailing whitespace exactly like Python ``str.strip``.

    Spark's ``trim`` removes only ASCII spaces; this also removes tabs, NBSP,
    U+3000, U+2009, U+0085 and the U+001C..U+001F separators.
    """
    return F.regexp_replace(_col(c), STRIP_PATTERN, "")


def first_part(c: Column | str, sep: str = ";") -> Column:
    """Element 0 of ``split(sep)`` without materialising the array."""
    return F.substring_index(_col(c), sep, 1)


def normalize_key(c: Column | str, sep: str = ";", default: str = "unknown") -> Column:
    """Entity join key: null -> default, first ``sep`` part, stripped, lowercased.

    ``";X"`` and blank names give ``''`` (a normal group), null gives
    ``default``.
    """
    text = F.coalesce(_col(c).cast("string"), F.lit(default))
    return F.lower(py_strip(first_part(text, sep)))


def display_first_part(c: Column | str, sep: str = ";") -> Column:
    """First collaborator, stripped but case preserved (profiling view)."""
    return py_strip(first_part(_col(c).cast("string"), sep))


def parse_flag(c: Column | str, true_text: str = "true") -> Column:
    """Text flag to boolean: ``strip().lower() == 'true'``; null is false."""
    return F.coalesce(F.lower(py_strip(_col(c).cast("string"))) == F.lit(true_text),
                      F.lit(False))


def clean_text(c: Column | str, null_text: str | None = None) -> Column:
    """``astype(str).strip().lower()``; nulls stay null unless ``null_text``
    is given (``'<na>'`` reproduces the pandas rendering of a missing value)."""
    out = F.lower(py_strip(_col(c).cast("string")))
    if null_text is not None:
        out = F.coalesce(out, F.lit(null_text))
    return out


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def blank_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Exactly-empty strings become NULL on the given (default: all string)
    columns. Whitespace-only values are kept, as in the reference."""
    targets = list(cols) if cols is not None else string_columns(df)
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in targets})


def na_tokens_to_null(df: DataFrame, tokens: Iterable[str] = NA_TOKENS,
                      cols: Iterable[str] | None = None) -> DataFrame:
    """Map CSV missing-value tokens to NULL (Spark's ``nullValue`` takes a
    single token)."""
    toks = list(tokens)
    targets = list(cols) if cols is not None else string_columns(df)
    return df.withColumns({
        c: F.when(F.col(c).isin(*toks), F.lit(None).cast("string")).otherwise(F.col(c))
        for c in targets
    })
