"""Cleaning, dedup and the zero-filled merge on toy rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators.clean import clean_awards, clean_tracks, dedup_rows
from starloom.operators.enrich import award_stats, enrich
from starloom.schemas import ROW_ORD, TRACKS_CSV

TRACK_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRACKS_CSV.fields[1:])
AWARD_DDL = ("_row_ord bigint, year int, title string, published_at string, updated_at string, "
             "category string, nominee string, artist string, workers string, img string, "
             "winner string")


def track(ordv, tid="t1", artists="A", album="Al", name="N", genre="pop", pop=10, dance=0.5):
    return (ordv, tid, artists, album, name, pop, 1000, False, dance, 0.4, 1, -5.0, 1, 0.1, 0.2,
            0.0, 0.1, 0.3, 120.0, 4, genre)


def tracks_df(spark, rows):
    return spark.createDataFrame(rows, f"{ROW_ORD} bigint, {TRACK_DDL}")


def award(ordv, artist, winner=" True", year=2000, category=" Best", nominee="x"):
    return (ordv, year, "t", "2020-01-15", "", category, nominee, artist, "w", "i", winner)


def test_dedup_keeps_lowest_row_ord(spark):
    df = tracks_df(spark, [track(5), track(2), track(9, genre="rock")])
    out = {(r[ROW_ORD], r.track_genre) for r in dedup_rows(df).collect()}
    assert out == {(2, "pop"), (9, "rock")}


def test_dedup_treats_null_and_nan_as_equal(spark):
    rows = [track(1, dance=float("nan"), album=None), track(2, dance=float("nan"), album=None)]
    assert dedup_rows(tracks_df(spark, rows)).count() == 1


def test_clean_tracks_drops_required_nulls_then_dedups(spark):
    rows = [track(1), track(2), track(3, album=None), track(4, artists=None),
            track(5, name=None), track(6, artists=" Gen Hoshino;Foo ")]
    out = clean_tracks(tracks_df(spark, rows)).orderBy(ROW_ORD).collect()
    assert [r[ROW_ORD] for r in out] == [1, 6]
    assert [r.artist_norm for r in out] == ["a", "gen hoshino"]


def test_clean_awards_rules(spark):
    rows = [award(1, "  ADELE", " True"), award(2, "", "False"), award(3, "Adele;Guest", "TRUE"),
            award(4, None, None, category="", nominee="")]
    out = clean_awards(spark.createDataFrame(rows, AWARD_DDL)).orderBy(ROW_ORD).collect()
    assert [r.artist_norm for r in out] == ["adele", "unknown", "adele", "unknown"]
    assert [r.winner for r in out] == [True, False, True, False]
    assert out[0].category == "best" and out[3].category is None and out[3].nominee is None
    assert "workers" not in out[0].asDict() and out[0].updated_at is None


def test_award_stats_and_zero_fill(spark):
    aw = clean_awards(spark.createDataFrame(
        [award(1, "A", " True", 1999), award(2, "a ", "False", 2005), award(3, "", " True", 1990),
         award(4, "B", "False", None)], AWARD_DDL))
    stats = {r.artist_norm: r for r in award_stats(aw).collect()}
    assert set(stats) == {"a", "b"}  # blank artist excluded
    assert (stats["a"].grammy_nominations, stats["a"].grammy_wins,
            stats["a"].first_grammy_year, stats["a"].last_grammy_year) == (2, 1, 1999, 2005)
    spine = clean_tracks(tracks_df(spark, [track(1, artists="A"), track(2, artists="B"),
                                           track(3, artists="C")]))
    merged = {r.artist_norm: r for r in enrich(spine, award_stats(aw)).collect()}
    assert len(merged) == 3
    assert (merged["b"].first_grammy_year, merged["b"].grammy_nominations) == (0, 1)
    c = merged["c"]
    assert (c.grammy_nominations, c.grammy_wins, c.first_grammy_year, c.last_grammy_year) == (0,) * 4
    assert dict(enrich(spine, award_stats(aw)).dtypes)["grammy_wins"] == "int"


def test_enrich_keeps_row_count_on_fixture(spark):
    from starloom.sources.fixtures import raw_awards, raw_tracks
    d = "/root/testdata/sf0.001"
    spine = clean_tracks(raw_tracks(spark, d))
    merged = enrich(spine, award_stats(clean_awards(raw_awards(spark, d))))
    assert merged.count() == spine.count()
    assert merged.filter(F.col("grammy_nominations").isNull()).count() == 0


def test_signature_dedup_equals_plain_dedup(spark):
    from starloom.operators.clean import dedup_wide_rows

    rows = [(i, f"text {i % 7}" if i % 5 else None, "en" if i % 3 else "fr", i % 2) for i in range(60)]
    rows += [(100 + i, "hot copy", "en", 1) for i in range(40)]  # one big group of copies
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n long")
    plain = sorted(tuple(r) for r in dedup_rows(df, order_col="doc_id").collect())
    wide = sorted(tuple(r) for r in dedup_wide_rows(df, order_col="doc_id").collect())
    assert wide == plain and (100, "hot copy", "en", 1) in wide


def test_dedup_moves_only_signatures_and_copies(spark):
    from tests.test_plans import plan

    rows = [track(1), track(2, tid="t2"), track(3, tid="t3", dance=-0.0)]
    out = clean_tracks(tracks_df(spark, rows), reread=True)
    assert "Exchange" not in plan(out)  # no copies: rows stay where they are read
    assert sorted((r[ROW_ORD], str(r.danceability)) for r in out.collect()) == [(1, "0.5"), (2, "0.5"), (3, "0.0")]


def test_dedup_by_signature_equals_grouping(spark, monkeypatch):
    from starloom.operators import joins

    rows = [track(7), track(3), track(5, tid="t2", dance=-0.0), track(4, tid="t2", dance=0.0),
            track(9, tid="t3", dance=float("nan")), track(8, tid="t3", dance=float("nan")),
            track(2, tid="t4", genre=None), track(1, tid="t4", genre=None), track(6, tid="t5")]
    def shown(df):
        return sorted(map(str, df.collect()))
    want = shown(dedup_rows(tracks_df(spark, rows)))
    for reread in (False, True):
        assert shown(clean_tracks(tracks_df(spark, rows), reread=reread).drop("artist_norm")) == want
    monkeypatch.setattr(joins, "fits_broadcast", lambda *a, **k: False)  # too many copies
    assert shown(clean_tracks(tracks_df(spark, rows)).drop("artist_norm")) == want


def test_staged_stats_are_not_staged_again(spark):
    from starloom.session import stage

    tracks = clean_tracks(tracks_df(spark, [track(1, artists="Adele"), track(2, artists="Bob")]))
    stats = stage(award_stats(clean_awards(spark.createDataFrame([award(1, "Adele")], AWARD_DDL))), "award-stats")
    out = {r.artists: r.grammy_wins for r in enrich(tracks, stats).collect()}
    assert out == {"Adele": 1, "Bob": 0}
