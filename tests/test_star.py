"""Star build: key rules, invariants, partition-count invariance, large path."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators.keys import dense_keys
from starloom.operators.star import build_star, conform
from starloom.plans.pipeline import fixture_merged, merged_from
from starloom.sources.fixtures import raw_awards, raw_tracks
from tests.test_clean_merge import AWARD_DDL, award, track, tracks_df

SF = "/root/testdata/sf0.001"


def toy_star(spark):
    rows = [
        track(10, "t1", "Zed;Guest", "Same", genre="rock"),   # first row of zed: collaboration
        track(11, "t2", "Zed", "Other", genre="pop"),
        track(12, "t3", "amy", "Same", genre="pop"),          # same album title, other artist
        track(13, "t1", "Zed;Guest", "Same", genre="pop"),
        track(14, "t4", "Bob", "B1", genre="jazz"),
    ]
    aw = spark.createDataFrame([award(1, "zed", " True", 2001), award(2, "amy", "False", 1999)],
                               AWARD_DDL)
    return build_star(merged_from(tracks_df(spark, rows), aw))


def test_toy_star_rules(spark):
    star = toy_star(spark)
    artists = {r.artist_norm: r for r in star.dim_artist.collect()}
    assert [artists[k].artist_key for k in ("amy", "bob", "zed")] == [1, 2, 3]
    assert artists["zed"].artist_name == "Zed;Guest"
    albums = sorted((r.album_key, r.album_name, r.artist_norm) for r in star.dim_album.collect())
    assert albums == [(1, "Same", "zed"), (2, "Other", "zed"), (3, "Same", "amy"), (4, "B1", "bob")]
    assert [r.genre_name for r in star.dim_genre.orderBy("genre_key").collect()] == [
        "jazz", "pop", "rock"]
    years = {r.year_value: r.year_key for r in star.dim_year.collect()}
    assert years == {0: 1, 1999: 2, 2001: 3}  # year 0 is an ordinary member, key 1
    fact = star.fact_track
    assert fact.count() == 5
    assert fact.filter((F.col("track_id") == "t4")).first().year_key == 1


def test_fixture_star_invariants(spark):
    merged = merged_from(raw_tracks(spark, SF), raw_awards(spark, SF))
    star = conform(build_star(merged))
    n = merged.count()
    assert star.fact_track.count() == n
    for name, key in (("dim_artist", "artist_key"), ("dim_album", "album_key"),
                      ("dim_genre", "genre_key"), ("dim_year", "year_key")):
        dim = getattr(star, name)
        stats = dim.agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"),
                        F.count_distinct(key).alias("d")).first()
        assert (stats.lo, stats.hi, stats.d) == (1, stats.n, stats.n), name
        orphans = star.fact_track.join(dim, key, "left_anti").count()
        assert orphans == 0, name
    assert dict(star.fact_track.dtypes)["popularity"] == "smallint"


def _star_rows(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        star = build_star(merged_from(raw_tracks(spark, SF), raw_awards(spark, SF)))
        return {name: sorted(tuple(r) for r in df.collect()) for name, df in star.tables().items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_result_independent_of_partitioning(spark, parts):
    base = _star_rows(spark, 8)
    assert _star_rows(spark, parts) == base


def test_keys_equal_window_keys(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("v"),
                                     (F.col("id") % 3).alias("g"))
    rank = F.row_number().over(Window.orderBy("v", "g")).cast("int").alias("k")
    large = dense_keys(df, "k", ["v", "g"], num_partitions=9)
    a = sorted(tuple(r) for r in df.select(rank, "v", "g").collect())
    b = sorted(tuple(r) for r in large.collect())
    assert a == b
    assert [r.k for r in large.orderBy("k").collect()] == list(range(1, 5001))


def test_order_columns_are_not_copied_and_first_rows_are_measured(spark, monkeypatch):
    from starloom.operators import keys, star

    ranged, staged = {}, []
    keep = keys.materialize
    monkeypatch.setattr(keys, "materialize", lambda df, name: ranged.setdefault(name, keep(df, name)))
    put = star.stage
    monkeypatch.setattr(star, "stage", lambda df, name: staged.append(name) or put(df, name))
    built = toy_star(spark)
    assert "_first" not in ranged["keys-album_key"].columns
    assert "artist-firsts" in staged
    assert built.dim_album.columns == ["album_key", "album_name", "artist_norm"]
    assert built.fact_track.count() == 5


def test_source_lookups_of_a_proven_size_do_not_move_the_rows(spark):
    from tests.test_plans import plan

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(raw_tracks(spark, SF)).count("BroadcastHashJoin") == 3
        assert plan(raw_awards(spark, SF)).count("BroadcastHashJoin") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_run_with_copies_counts_each_input_row_once(spark, tmp_path):
    from starloom.plans.pipeline import run

    rows = [track(i, f"t{i // 2}", genre="pop") for i in range(6)]
    counts = run(tracks_df(spark, rows), spark.createDataFrame([award(1, "A")], AWARD_DDL), str(tmp_path / "w"))
    assert {k: counts[k] for k in ("raw_tracks", "clean_tracks", "merged", "fact_track")} == {
        "raw_tracks": 6, "clean_tracks": 3, "merged": 3, "fact_track": 3}


def test_fact_reads_the_tracks_without_the_stats(spark):
    from starloom.plans.pipeline import fixture_merged, fixture_raw_star, fixture_tracks
    from tests.test_plans import plan

    assert "grammy_wins" not in plan(fixture_raw_star(spark, SF).fact_track)
    assert "grammy_wins" not in fixture_tracks(spark, SF).columns
    assert "merged-" not in plan(fixture_merged(spark, SF))  # no second copy of the landed rows


def test_key_map_is_staged_only_where_it_may_be_broadcast(spark, monkeypatch):
    from starloom.operators import star as S

    merged = merged_from(raw_tracks(spark, SF), raw_awards(spark, SF))
    real, names = S.stage, []
    monkeypatch.setattr(S, "stage", lambda df, name="stage", *a, **k: names.append(name) or real(df, name, *a, **k))
    small = sorted(map(repr, build_star(merged).fact_track.collect()))
    assert "key-map" in names
    names.clear()
    monkeypatch.setattr(S, "fits_broadcast", lambda side, *a, **k: False)  # as for albums beyond the bound
    assert sorted(map(repr, build_star(merged).fact_track.collect())) == small
    assert "key-map" not in names


def _shuffle_files(spark) -> set:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while found.hasNext():
        names.add(found.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def test_shuffle_files_go_with_the_write_that_made_them(spark, tmp_path):
    import time

    from starloom.session import _FREE_KEY, freed_shuffles, materialize, stage_all

    before = _shuffle_files(spark)
    rows = spark.range(20_000).selectExpr("id % 1000 AS k", "id AS v")
    made = stage_all({n: lambda: rows.groupBy("k").agg(F.sum("v").alias("s")) for n in ("a", "b", "c")})
    assert all(st.rows == 1000 for st in made.values())
    until = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)  # removed in the background
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(_FREE_KEY, None) is None
    # The setting a session brings is kept, also where a write inside fails.
    spark.conf.set(_FREE_KEY, "false")
    try:
        with pytest.raises(RuntimeError), freed_shuffles(spark):
            raise RuntimeError
        materialize(rows)
        assert spark.conf.get(_FREE_KEY) == "false"
    finally:
        spark.conf.unset(_FREE_KEY)


def test_star_build_leaves_only_the_tables_it_reads(spark):
    from starloom import storage
    from starloom.session import ensure_checkpoint_dir, temporary_stages

    def staged() -> set:
        return {n for n, *_ in storage.listing(spark, f"{ensure_checkpoint_dir(spark)}/starloom")}

    merged = fixture_merged(spark, SF)
    before = staged()
    star = build_star(merged, stage_spine=False)
    left = {n.rsplit("-", 1)[0] for n in staged() - before}
    assert left == {"dim-album", "dim-artist", "dim-genre", "dim-year", "key-map"}
    assert star.fact_track.count() == merged.count()
    before = staged()
    with temporary_stages(spark):
        build_star(merged)
        assert staged() > before
    assert staged() == before  # an enclosing scope has what the build leaves
