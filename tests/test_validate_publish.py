"""Contract checks (one violation per planted defect) and the staged publish."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starloom.operators import validate as V
from starloom.operators.star import Star, conform
from starloom.plans.pipeline import merged_from
from starloom.operators.star import build_star
from starloom.sinks.warehouse import (
    create_warehouse,
    current_version,
    publish,
    read_published,
)
from tests.test_star import toy_star


def clean_toy(spark):
    return conform(toy_star(spark))


def test_clean_toy_has_no_violations(spark):
    report = V.violations(clean_toy(spark))
    assert report.filter(F.col("n") > 0).count() == 0
    V.enforce(clean_toy(spark))


def _with(star: Star, **tables) -> Star:
    return Star(**{**star.tables(), **tables})


def test_each_planted_defect_is_reported_once(spark):
    star = clean_toy(spark)
    fact = star.fact_track
    first = fact.limit(1)
    broken_fact = (fact.unionByName(first)                                    # repeated grain
                   .unionByName(first.withColumn("track_id", F.lit("tX"))
                                .withColumn("album_key", F.lit(999)))         # orphan album
                   .unionByName(first.withColumn("track_id", F.lit("tY"))
                                .withColumn("popularity", F.lit(300).cast("smallint"))))
    genre = star.dim_genre.unionByName(spark.createDataFrame(
        [(90, "x" * 65), (91, "Pop"), (92, "pöp")], "genre_key int, genre_name string"))
    bad = _with(star, fact_track=broken_fact, dim_genre=genre)
    grain = V.grain_violations(bad.fact_track, ["track_id", "genre_key"]).collect()
    assert len(grain) == 1 and grain[0].n == 2
    fk = {r.fk_name: r.orphans for r in V.fk_orphans(bad).collect()}
    assert fk == {"fk_fact_artist": 0, "fk_fact_album": 1, "fk_fact_genre": 0, "fk_fact_year": 0}
    dom = {(r.table_name, r.column_name): r.violations for r in V.domain_violations(bad).collect()}
    assert dom[("fact_track", "popularity")] == 1 and dom[("dim_genre", "genre_name")] == 1
    assert sum(dom.values()) == 2
    uniq = V.unique_violations(bad.dim_genre, "genre_name", "UNICODE_CI_AI", "genre_key").collect()
    assert len(uniq) == 1 and uniq[0].n == 3  # pop, Pop, pöp
    with pytest.raises(V.ContractViolation):
        V.enforce(bad)


def test_null_measure_is_reported(spark):
    star = clean_toy(spark)
    fact = star.fact_track.withColumn(
        "energy", F.when(F.col("track_id") == "t4", F.lit(None)).otherwise(F.col("energy")))
    nulls = {(r.table_name, r.column_name): r.nulls
             for r in V.null_counts(_with(star, fact_track=fact)).collect()}
    assert nulls[("fact_track", "energy")] == 1 and sum(nulls.values()) == 1


def test_publish_is_all_or_nothing_and_rerunnable(spark, tmp_dir):
    target = f"{tmp_dir}/wh"
    assert current_version(spark, target) is None
    good = clean_toy(spark)
    v1 = publish(good, target)
    assert current_version(spark, target) == v1
    sizes = read_published(spark, target).sizes
    assert set(sizes) == {"dim_artist", "dim_album", "dim_genre", "dim_year", "fact_track"}
    assert sizes["fact_track"][0] == good.fact_track.count()
    before = sorted(tuple(r) for r in read_published(spark, target).fact_track.collect())

    bad = _with(good, fact_track=good.fact_track.unionByName(good.fact_track.limit(1)))
    with pytest.raises(V.ContractViolation):
        publish(bad, target, enforce=True)
    assert current_version(spark, target) == v1  # failed publish left the old version current

    v2 = publish(good, target)
    assert v2 > v1 and current_version(spark, target) == v2
    after = sorted(tuple(r) for r in read_published(spark, target).fact_track.collect())
    assert after == before


def test_warehouse_ddl_is_rerunnable(spark, tmp_dir):
    create_warehouse(spark, "starloom_dw_test", f"{tmp_dir}/dw")
    create_warehouse(spark, "starloom_dw_test", f"{tmp_dir}/dw")
    cols = spark.table("starloom_dw_test.fact_track").columns
    assert cols[:5] == ["track_id", "artist_key", "album_key", "genre_key", "year_key"]


def test_fixture_fact_grain_violations_reported(spark):
    from starloom.sources.fixtures import raw_awards, raw_tracks
    d = "/root/testdata/sf0.001"
    star = conform(build_star(merged_from(raw_tracks(spark, d), raw_awards(spark, d))))
    report = {(r.check_name, r.table_name): r.n for r in V.violations(star).collect()}
    assert report[("not_null", "fact_track")] == 0
    assert report[("fk_fact_artist", "fact_track")] == 0
