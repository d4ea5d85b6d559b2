"""Column-level functions (all built-in Spark expressions, codegen friendly)."""

from starloom.functions.numeric import avg_rounded, pct, round_half_up
from starloom.functions.text import (
    NA_TOKENS,
    blank_to_null,
    clean_text,
    display_first_part,
    first_part,
    na_tokens_to_null,
    normalize_key,
    parse_flag,
    py_strip,
    string_columns,
)
from starloom.functions.time import epoch_micros, parse_ts_utc

__all__ = [
    "NA_TOKENS", "avg_rounded", "blank_to_null", "clean_text", "display_first_part",
    "epoch_micros", "first_part", "na_tokens_to_null", "normalize_key", "parse_flag",
    "parse_ts_utc", "pct", "py_strip", "round_half_up", "string_columns",
]
