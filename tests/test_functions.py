"""Scalar rules on edge rows (FIXTURES section C)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from starloom.functions import (
    blank_to_null,
    clean_text,
    epoch_micros,
    na_tokens_to_null,
    normalize_key,
    parse_flag,
    parse_ts_utc,
    py_strip,
    round_half_up,
)


def _one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"c {typ}")
    return [r[0] for r in df.select(expr(F.col("c"))).collect()]


def test_normalize_key_edge_rows(spark):
    got = _one_col(spark, ["Gen Hoshino;Foo Bar", "  AJR ", "ajr", ";X", "   ", None],
                   normalize_key)
    assert got == ["gen hoshino", "ajr", "ajr", "", "", "unknown"]


def test_strip_matches_python_for_unicode_whitespace(spark):
    values = [" name　", "\tname\x1c", " x\u0085", "\x1d\x1e\x1fy\x1f",
              "in ner", "​z"]
    got = _one_col(spark, values, py_strip)
    assert got == [v.strip() for v in values]


def test_lower_matches_python(spark):
    values = ["ÀÉÎ", "İstanbul", "ΣΟΦΟΣ", "Straße"]
    assert _one_col(spark, values, lambda c: normalize_key(c)) == [v.lower() for v in values]


def test_parse_flag(spark):
    got = _one_col(spark, [" True", "TRUE", "False", "", None, "true "], parse_flag)
    assert got == [True, True, False, False, False, True]


def test_parse_ts_utc_mixed_forms(spark):
    values = ["2020-01-15", "2020-01-15T00:00:00+00:00", "2017-11-28T00:03:45-08:00",
              "garbage", "", None, "2024-01-01 00:00:07.179575"]
    got = _one_col(spark, values, lambda c: epoch_micros(parse_ts_utc(c)))
    assert got == [1579046400000000, 1579046400000000, 1511856225000000, None, None, None,
                   1704067207179575]


def test_parse_ts_utc_ignores_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = _one_col(spark, ["2020-01-15", "2017-11-28T00:03:45-08:00"],
                       lambda c: epoch_micros(parse_ts_utc(c)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [1579046400000000, 1511856225000000]


def test_blank_to_null_only_exact_empty(spark):
    df = spark.createDataFrame([("", " ", "x", 1)], "a string, b string, c string, n int")
    row = blank_to_null(df).first()
    assert (row.a, row.b, row.c, row.n) == (None, " ", "x", 1)


def test_na_tokens(spark):
    df = spark.createDataFrame([("NA",), ("None",), ("nan",), ("Nana",), ("",), ("x",)], "a string")
    assert [r.a for r in na_tokens_to_null(df).collect()] == [None, None, None, "Nana", None, "x"]


def test_clean_text_null_text_option(spark):
    assert _one_col(spark, [" A ", None], clean_text) == ["a", None]
    assert _one_col(spark, [" A ", None], lambda c: clean_text(c, "<na>")) == ["a", "<na>"]


def test_round_half_up_ties_and_nan(spark):
    got = _one_col(spark, [0.25, 0.35, 2.675, float("nan"), None],
                   lambda c: round_half_up(c, 1), "double")
    assert got[:3] == [0.3, 0.4, 2.7]
    assert math.isnan(got[3]) and got[4] is None
