"""Less common paths: parquet sources, subset dedup, sparse profiling inputs."""

from __future__ import annotations

import pytest

from starloom.operators import profile as P
from starloom.operators.clean import dedup_rows
from starloom.sources.files import read_tracks


def test_read_tracks_parquet_index_and_no_index(spark, tmp_dir):
    df = spark.createDataFrame([(7, "t1"), (3, "t2")], "`Unnamed: 0` long, track_id string")
    df.write.parquet(f"{tmp_dir}/with_index")
    got = read_tracks(spark, f"{tmp_dir}/with_index", fmt="parquet")
    assert sorted((r["_row_ord"], r.track_id) for r in got.collect()) == [(3, "t2"), (7, "t1")]
    df.drop("Unnamed: 0").write.parquet(f"{tmp_dir}/no_index")
    got = read_tracks(spark, f"{tmp_dir}/no_index", fmt="parquet")
    assert "_row_ord" in got.columns and got.count() == 2


def test_dedup_on_subset_keeps_first_row_values(spark):
    df = spark.createDataFrame(
        [(3, "a", "late"), (1, "a", "early"), (2, "b", "only")], "_row_ord long, k string, v string")
    got = sorted(tuple(r) for r in dedup_rows(df, subset=["k"]).collect())
    assert got == [(1, "a", "early"), (2, "b", "only")]


def test_nulls_only_missing_and_all_null_describe(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (None, None)], "x double, y double")
    missing = {r.column_name: r.nulls for r in P.nulls(df, only_missing=True).collect()}
    assert missing == {"x": 1, "y": 3}
    d = {r.column_name: r for r in P.describe(df, ["x", "y"]).collect()}
    assert d["x"]["count"] == 2 and d["x"]["mean"] == pytest.approx(1.5)
    assert d["y"]["count"] == 0 and d["y"]["mean"] is None and d["y"]["q50"] is None


def test_describe_all_mixed_types(spark):
    df = spark.createDataFrame([(1, "a", True), (2, "b", True), (2, "b", None)],
                               "n int, s string, f boolean")
    d = {r.column_name: r for r in P.describe_all(df).collect()}
    assert (d["s"]["count"], d["s"]["unique"], d["s"]["top"], d["s"]["freq"]) == (3, 2, "b", 2)
    assert (d["f"]["count"], d["f"]["unique"], d["f"]["top"]) == (2, 1, "true")
    assert d["n"]["unique"] is None and d["n"]["mean"] == pytest.approx(5 / 3, abs=1e-6)


def test_source_order_is_wide_enough(spark):
    """Keys far beyond a long's room stay in source order."""
    from starloom.sources.fixtures import source_order

    rows = [(9_000_000_000_00, 7, 20_000_000_000, 1_000_000_000), (9_000_000_000_00, 7, 20_000_000_000, 999_999_999),
            (9_000_000_000_00, 6, 99_999_999_999, 9_999_999_999), (1, 1, 1, 1)]
    df = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long")
    got = [tuple(r)[:4] for r in df.withColumn("o", source_order()).orderBy("o").collect()]
    assert got == sorted(rows)


def test_landed_tracks_hold_the_joined_lines_and_give_the_same_rows(spark):
    from starloom.plans.pipeline import landed_tracks
    from starloom.sources.fixtures import raw_tracks

    d = "/root/testdata/sf0.001"
    landed, raw = landed_tracks(spark, d), raw_tracks(spark, d)
    stored = spark.read.parquet(*landed.inputFiles()).columns
    assert not {"_row_ord", "track_id", "artists", "track_name", "speechiness"} & set(stored)  # made by the readers
    assert [(f.name, f.dataType) for f in landed.schema] == [(f.name, f.dataType) for f in raw.schema]
    assert sorted(map(repr, landed.collect())) == sorted(map(repr, raw.collect()))


def test_dedup_shuffles_short_signatures(spark, monkeypatch):
    from starloom import session
    from starloom.operators.clean import dedup_wide_rows

    real, seen = session.stage, []

    def stage(df, name="stage", *a, **k):
        out = real(df, name, *a, **k)
        seen.extend(r["_h"] for r in out.df.collect() if name == "dedup-signatures")
        return out

    monkeypatch.setattr(session, "stage", stage)
    df = spark.range(400).selectExpr("id AS _row_ord", "id % 200 AS v")
    kept = sorted(tuple(r) for r in dedup_wide_rows(df).collect())
    assert kept == [(i, i) for i in range(200)]
    assert len(seen) == 200 and all(0 <= h < 2 ** 44 for h in seen)
