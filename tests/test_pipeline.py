"""End-to-end run on the smallest driver tables, plus landing DDL."""

from __future__ import annotations

import logging

import pytest

from starloom.operators.validate import ContractViolation
from starloom.plans.pipeline import run
from starloom.sinks.warehouse import current_version, read_published
from starloom.sources.files import create_landing_table
from starloom.sources.fixtures import raw_awards, raw_tracks

SF = "/root/testdata/sf0.001"


def test_run_publishes_and_reports_counts(spark, tmp_dir, caplog):
    target = f"{tmp_dir}/wh"
    with caplog.at_level(logging.INFO, logger="starloom.run"):
        counts = run(raw_tracks(spark, SF), raw_awards(spark, SF), target, enforce=False)
    assert counts["raw_tracks"] == raw_tracks(spark, SF).count()
    assert counts["merged"] == counts["clean_tracks"] == counts["fact_track"]
    assert counts["clean_tracks"] <= counts["raw_tracks"]
    assert current_version(spark, target) == counts["version"]
    assert read_published(spark, target).dim_artist.count() == counts["dim_artist"]
    assert any("skipping CSV export" in r.message for r in caplog.records)


def test_run_with_enforce_refuses_grain_violations(spark, tmp_dir):
    target = f"{tmp_dir}/wh"
    tracks = raw_tracks(spark, SF)
    # The driver data repeats (track_id, genre) pairs, which the fact's
    # primary key forbids: the publish must stop before committing.
    with pytest.raises(ContractViolation):
        run(tracks, raw_awards(spark, SF), target, enforce=True)
    assert current_version(spark, target) is None


def test_run_exports_csv(spark, tmp_dir):
    counts = run(raw_tracks(spark, SF), raw_awards(spark, SF), f"{tmp_dir}/wh",
                 csv_out=f"{tmp_dir}/merged", enforce=False)
    back = spark.read.option("header", True).csv(f"{tmp_dir}/merged")
    assert back.count() == counts["merged"] and "artist_norm" in back.columns


def test_landing_table_ddl_is_rerunnable(spark, tmp_dir):
    create_landing_table(spark, "awards_landing_test", f"{tmp_dir}/landing")
    create_landing_table(spark, "awards_landing_test", f"{tmp_dir}/landing")
    assert spark.table("awards_landing_test").columns[0] == "year"


def test_cli_on_csv_sources_matches_fixture_run(spark, tmp_dir):
    """Round-trip the driver-derived sources through CSV files (index column
    under a pandas-style header, blanks, quotes) and run the CLI on them."""
    from starloom.cli import main

    tracks = raw_tracks(spark, SF)
    (tracks.withColumnRenamed("_row_ord", "Unnamed: 0").write
     .options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
              ignoreTrailingWhiteSpace=False).csv(f"{tmp_dir}/tracks"))
    (raw_awards(spark, SF).drop("_row_ord").write
     .options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
              ignoreTrailingWhiteSpace=False).csv(f"{tmp_dir}/awards"))
    got = main(["--tracks", f"{tmp_dir}/tracks", "--awards", f"{tmp_dir}/awards",
                "--target", f"{tmp_dir}/wh", "--no-enforce"], spark=spark)
    ref = run(raw_tracks(spark, SF), raw_awards(spark, SF), f"{tmp_dir}/wh_ref", enforce=False)
    for k in ("raw_tracks", "clean_tracks", "merged", "dim_artist", "dim_album", "dim_genre",
              "dim_year", "fact_track", "raw_awards"):
        assert got[k] == ref[k], k
    a = read_published(spark, f"{tmp_dir}/wh").dim_artist.orderBy("artist_key").collect()
    b = read_published(spark, f"{tmp_dir}/wh_ref").dim_artist.orderBy("artist_key").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]


def test_platform_session_keeps_a_configured_master(spark, monkeypatch):
    import subprocess
    import sys

    from starloom.session import platform_session
    assert platform_session() is spark
    code = ("from starloom.session import platform_session; s = platform_session(); "
            "print('MASTER', s.sparkContext.master)")
    import os
    conf = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {**os.environ, "PYTHONPATH": conf, "PYSPARK_SUBMIT_ARGS":
           "--master local[2] --conf spark.ui.enabled=false pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120).stdout
    assert "MASTER local[2]" in out
