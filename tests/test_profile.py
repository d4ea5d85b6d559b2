"""Profiling numbers against pandas/numpy on small data."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from starloom.operators import profile as P
from starloom.operators.quantiles import exact_quantiles


def _frame(spark, pdf):
    return spark.createDataFrame(pdf)


@pytest.fixture()
def data(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({
        "a": rng.normal(10, 3, 2000).round(2),
        "b": rng.integers(0, 20, 2000).astype(float),
        "hot": np.where(rng.random(2000) < 0.4, 5.0, rng.normal(0, 1, 2000)),
    })
    return pdf, _frame(spark, pdf)


@pytest.mark.parametrize("keep", [100_000, 3])
def test_exact_quantiles_match_numpy(spark, data, keep):
    pdf, df = data
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r.column_name, r.prob): r.quantile
           for r in exact_quantiles(df, ["a", "b", "hot"], probs, keep=keep).collect()}
    for c in ("a", "b", "hot"):
        for p in probs:
            assert got[(c, p)] == pytest.approx(np.percentile(pdf[c], p * 100), abs=1e-9)


def test_describe_matches_pandas(spark, data):
    pdf, df = data
    got = {r.column_name: r for r in P.describe(df, ["a", "b"]).collect()}
    ref = pdf[["a", "b"]].describe()
    for c in ("a", "b"):
        assert got[c]["count"] == ref[c]["count"]
        for mine, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"),
                             ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            assert got[c][mine] == pytest.approx(ref[c][theirs], abs=1e-6)


def test_histogram_matches_numpy(spark, data):
    pdf, df = data
    rows = P.histogram(df, ["a", "hot"], 50).collect()
    for c in ("a", "hot"):
        counts, edges = np.histogram(pdf[c], bins=50)
        mine = sorted((r.bin, r.n, r.bin_lo) for r in rows if r.column_name == c)
        assert [m[1] for m in mine] == counts.tolist()
        assert [m[2] for m in mine] == pytest.approx(edges[:-1].tolist(), abs=1e-6)


def test_histogram_max_in_last_bin_and_constant(spark):
    df = spark.createDataFrame([(0.0, 3.0), (1.0, 3.0), (2.0, 3.0)], "x double, k double")
    rows = {(r.column_name, r.bin): r.n for r in P.histogram(df, ["x", "k"], 4).collect()}
    assert rows[("x", 3)] == 1 and sum(v for (c, _), v in rows.items() if c == "x") == 3
    counts, _ = np.histogram([3.0, 3.0, 3.0], bins=4)
    assert [rows[("k", i)] for i in range(4)] == counts.tolist()


def test_boxstats_matches_matplotlib_rules(spark, data):
    pdf, df = data
    got = {r.column_name: r for r in P.boxstats(df, ["a", "hot"]).collect()}
    for c in ("a", "hot"):
        x = pdf[c].to_numpy()
        q1, med, q3 = np.percentile(x, [25, 50, 75])
        iqr = q3 - q1
        inside_hi = x[x <= q3 + 1.5 * iqr]
        inside_lo = x[x >= q1 - 1.5 * iqr]
        whi = max(inside_hi.max(), q3)
        wlo = min(inside_lo.min(), q1)
        outl = int(((x < wlo) | (x > whi)).sum())
        r = got[c]
        assert (r.q1, r.median, r.q3) == pytest.approx((q1, med, q3), abs=1e-6)
        assert (r.whisker_lo, r.whisker_hi, r.outliers) == (pytest.approx(wlo, abs=1e-6),
                                                            pytest.approx(whi, abs=1e-6), outl)


def test_boxstats_constant_column(spark):
    df = spark.createDataFrame([(4.0,)] * 10, "x double")
    r = P.boxstats(df, ["x"]).first()
    assert (r.iqr, r.outliers, r.whisker_lo, r.whisker_hi) == (0.0, 0, 4.0, 4.0)


@pytest.mark.parametrize("with_nulls", [False, True])
def test_corr_matrix_matches_pandas(spark, data, with_nulls):
    pdf, _ = data
    pdf = pdf.copy()
    if with_nulls:
        pdf.loc[::7, "a"] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                               "a double, b double, hot double")
    got = {(r.col_a, r.col_b): r.corr for r in P.corr_matrix(df, ["a", "b", "hot"]).collect()}
    ref = pdf.corr()
    for a in ("a", "b", "hot"):
        for b in ("a", "b", "hot"):
            assert got[(a, b)] == pytest.approx(ref.loc[a, b], abs=1e-6)


def test_nulls_dups_and_top_values(spark):
    pdf = pd.DataFrame({"k": ["x", "y", "x", None, "y", "x"], "v": [1, 2, 1, 3, 2, 9],
                        "idx": range(6)})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                               "k string, v long, idx long")
    nulls = {r.column_name: (r.nulls, r.pct) for r in P.nulls(df).collect()}
    assert nulls["k"] == (1, pytest.approx(100 / 6, abs=1e-6)) and nulls["v"] == (0, 0.0)
    assert P.duplicate_count(df).first().duplicates == 0
    assert P.duplicate_count(df, ["idx"]).first().duplicates == int(
        pdf.drop(columns="idx").duplicated().sum())
    members = P.duplicate_members(df, ["idx"], ["idx"]).collect()
    assert [r.idx for r in members] == [0, 1, 2, 4]
    assert P.key_duplicate_rows(df, ["k"]).first()[0] == int(
        pdf.duplicated(subset=["k"], keep=False).sum())
    top = [(r.value, r.n) for r in P.top_values(df, "k", 2).collect()]
    assert top == [("x", 3), ("y", 2)]


def test_signature_duplicate_profiles_equal_plain(spark):
    rows = [(i, f"t{i % 9}" if i % 4 else None, i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long")
    for ignore in ([], ["doc_id"]):
        plain = P.duplicate_count(df, ignore).first()[0]
        assert P.duplicate_count(df, ignore, by_signature=True).first()[0] == plain
    a = [tuple(r) for r in P.duplicate_members(df, ["doc_id"], ["doc_id"]).collect()]
    b = [tuple(r) for r in P.duplicate_members(df, ["doc_id"], ["doc_id"], by_signature=True).collect()]
    assert a == b and len(a) > 0


def test_nan_counts_as_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 5.0), (nan, 5.0), (3.0, 5.0), (None, None)], "x double, k double")
    nulls = {r.column_name: r.nulls for r in P.nulls(df).collect()}
    assert nulls == {"x": 2, "k": 1}
    assert {r.column_name: r.non_null for r in P.info(df).collect()} == {"x": 2, "k": 3}
    d = {r.column_name: r for r in P.describe(df, ["x", "k"]).collect()}
    assert (d["x"]["count"], d["x"]["mean"], d["x"]["q50"], d["x"]["max"]) == (2, 2.0, 2.0, 3.0)
    assert sum(r.n for r in P.histogram(df, ["x"], 4).collect()) == 2
    corr = {(r.col_a, r.col_b): r.corr for r in P.corr_matrix(df, ["x", "k"]).collect()}
    assert corr["x", "x"] == 1.0 and corr["x", "k"] != corr["x", "k"]  # a constant column has none
    empty = df.where("false")
    assert [r.pct for r in P.nulls(empty).collect()] == [None, None]
    assert P.boxstats(empty, ["x"]).collect() == [] and P.histogram(empty, ["x"]).collect() == []
    assert P.describe(empty, ["x"]).first()["count"] == 0


def test_quantiles_of_large_skewed_data(spark):
    """More values in a bracket than are ranked one by one: brackets are narrowed."""
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("x"),
                                     F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") % 1000).alias("y"))
    pdf = df.toPandas()
    got = {(r.column_name, r.prob): r.quantile
           for r in exact_quantiles(df, ["x", "y"], [0.01, 0.25, 0.5], keep=5).collect()}
    for c in ("x", "y"):
        for p in (0.01, 0.25, 0.5):
            assert got[c, p] == pytest.approx(np.percentile(pdf[c], p * 100), abs=1e-9)
