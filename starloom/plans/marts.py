"""The nine dashboard marts plus the warehouse sanity queries.

Each mart takes a :class:`Star` and returns a DataFrame. Where a mart joins
the fact to a dimension only to read an attribute, the fact is first
aggregated to the dimension's grain (a partial/final hash aggregate, which
also absorbs hot keys map-side), and the join happens at dimension size.
Averages are rebuilt from exact sums and counts. Every ``ORDER BY ...
LIMIT`` is tie-broken by the dimension key so the top-k is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.numeric import pct, round_half_up
from starloom.operators.joins import join_small
from starloom.operators.star import Star

# The status and content labels the dashboards report.
WINNER = "Grammy Winner"
NON_WINNER = "No Grammy"
EXPLICIT = "Explicit"
CLEAN = "Clean"


def _sums(cols: list[str]) -> list[Column]:
    """Rows, and per measure the sum and the count of its values (an average ignores nulls)."""
    return [F.count(F.lit(1)).alias("_n")] + [
        agg for c in cols for agg in (F.sum(F.col(c).cast("double")).alias(f"_s_{c}"),
                                      F.count(c).alias(f"_n_{c}"))]


def _avg(col: str, digits: int, alias: str | None = None) -> Column:
    return round_half_up(F.try_divide(F.sum(f"_s_{col}"), F.sum(f"_n_{col}")), digits).alias(
        alias or f"avg_{col}")


def _mean(col: str, digits: int) -> Column:
    """As ``_avg`` where the sums already are at the output's grain."""
    return round_half_up(F.try_divide(F.col(f"_s_{col}"), F.col(f"_n_{col}")), digits).alias(f"avg_{col}")


def _status(wins: Column) -> Column:
    return F.when(wins > 0, F.lit(WINNER)).otherwise(F.lit(NON_WINNER))


def _wins(dim_artist: DataFrame) -> DataFrame:
    return dim_artist.select("artist_key", "grammy_wins")


def _per_artist(star: Star, cols: list[str]) -> DataFrame:
    """Fact pre-aggregated to artist grain, then joined to ``dim_artist``."""
    agg = star.fact_track.groupBy("artist_key").agg(*_sums(cols))
    return join_small(agg, star.side("dim_artist"), "artist_key")


def _per_genre(star: Star, cols: list[str]) -> DataFrame:
    agg = star.fact_track.groupBy("genre_key").agg(*_sums(cols))
    return join_small(agg, star.side("dim_genre"), "genre_key")


def overview(star: Star) -> DataFrame:
    """KPI scorecards: tracks, artists, winning artists, genres, avg popularity."""
    agg = star.fact_track.groupBy("artist_key").agg(*_sums(["popularity"]))
    j = join_small(agg, star.side("dim_artist", _wins), "artist_key")
    # One row is one artist; genres are counted in bitmaps over their dense keys.
    artists = j.select("artist_key", "grammy_wins", *[c for c in agg.columns if c != "artist_key"],
                       F.lit(0).cast("long").alias("_genres"))
    genres = (star.fact_track.groupBy(F.bitmap_bucket_number("genre_key").alias("_bucket"))
              .agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("genre_key"))).alias("_genres"))
              .select("_genres"))
    return artists.unionByName(genres, allowMissingColumns=True).agg(
        F.sum("_n").cast("long").alias("total_tracks"),
        F.count("artist_key").cast("long").alias("unique_artists"),
        F.count_if(F.col("grammy_wins") > 0).cast("long").alias("grammy_artists"),
        F.sum("_genres").cast("long").alias("total_genres"),
        _avg("popularity", 1),
    )


def top_artists(star: Star, k: int = 10) -> DataFrame:
    """Top-k artists by average popularity."""
    j = _per_artist(star, ["popularity"])
    out = j.select(
        "artist_key", "artist_name", "grammy_nominations", "grammy_wins",
        F.col("_n").cast("long").alias("track_count"),
        _mean("popularity", 1))
    return (out.orderBy(F.desc("avg_popularity"), F.asc("artist_key")).limit(k)
            .drop("artist_key"))


def winner_compare(star: Star) -> DataFrame:
    """Winners vs the rest: artists, tracks, average popularity/danceability/energy."""
    cols = ["popularity", "danceability", "energy"]
    j = _per_artist(star, cols).withColumn("grammy_status", _status(F.col("grammy_wins")))
    return j.groupBy("grammy_status").agg(
        F.count(F.lit(1)).cast("long").alias("artist_count"),
        F.sum("_n").cast("long").alias("track_count"),
        _avg("popularity", 1), _avg("danceability", 3), _avg("energy", 3))


GENRE_FEATURES = ["danceability", "energy", "valence", "acousticness", "speechiness",
                  "instrumentalness"]


def genre_features(star: Star, k: int = 15) -> DataFrame:
    """Average audio features of the k genres with most tracks."""
    j = _per_genre(star, GENRE_FEATURES)
    out = j.groupBy("genre_key", "genre_name").agg(
        F.sum("_n").cast("long").alias("track_count"),
        *[_avg(c, 3) for c in GENRE_FEATURES])
    return out.orderBy(F.desc("track_count"), F.asc("genre_key")).limit(k).drop("genre_key")


def popularity_by_nominations(star: Star) -> DataFrame:
    """Nominated artists with popularity and features, by nominations desc."""
    agg = star.fact_track.groupBy("artist_key").agg(
        *_sums(["popularity", "danceability", "energy"]))
    nominated = star.side("dim_artist", lambda d: d.filter(F.col("grammy_nominations") > 0))
    j = join_small(agg, nominated, "artist_key")
    out = j.groupBy("artist_key", "artist_name", "grammy_nominations", "grammy_wins").agg(
        _avg("popularity", 1), _avg("danceability", 3), _avg("energy", 3),
        F.sum("_n").cast("long").alias("track_count"))
    return out.orderBy(F.desc("grammy_nominations"), F.asc("artist_key")).drop("artist_key")


def mood_quadrant(star: Star) -> DataFrame:
    """Energy vs valence per genre."""
    j = _per_genre(star, ["energy", "valence", "danceability", "popularity"])
    return j.groupBy("genre_key", "genre_name").agg(
        _avg("energy", 3), _avg("valence", 3), _avg("danceability", 3), _avg("popularity", 1),
        F.sum("_n").cast("long").alias("track_count")).drop("genre_key")


def artist_scatter(star: Star, min_tracks: int = 5) -> DataFrame:
    """Artist-level danceability vs energy by winner status, >= min_tracks."""
    j = _per_artist(star, ["danceability", "energy", "popularity"])
    out = j.groupBy("artist_key", "artist_name",
                    _status(F.col("grammy_wins")).alias("grammy_status")).agg(
        _avg("danceability", 3), _avg("energy", 3), _avg("popularity", 1),
        F.sum("_n").cast("long").alias("track_count"))
    return out.filter(F.col("track_count") >= min_tracks).drop("artist_key")


def genre_share(star: Star, min_artists: int = 20, k: int = 10) -> DataFrame:
    """Genres by share of winning artists (>= min_artists), top k."""
    pairs = star.fact_track.select("genre_key", "artist_key").distinct()
    j = join_small(pairs, star.side("dim_artist", _wins), "artist_key")
    per_genre = j.groupBy("genre_key").agg(
        F.count(F.lit(1)).cast("long").alias("total_artists"),
        F.count_if(F.col("grammy_wins") > 0).cast("long").alias("grammy_artists"))
    out = join_small(per_genre, star.side("dim_genre"), "genre_key").select(
        "genre_key", "genre_name", "total_artists", "grammy_artists",
        pct(F.col("grammy_artists"), F.col("total_artists"), 1).alias("grammy_pct"))
    return (out.filter(F.col("total_artists") >= min_artists)
            .orderBy(F.desc("grammy_pct"), F.asc("genre_key")).limit(k).drop("genre_key"))


def explicit_split(star: Star) -> DataFrame:
    """Explicit vs clean tracks: popularity and features."""
    f = star.fact_track.withColumn(
        "content_type", F.when(F.col("explicit"), F.lit(EXPLICIT)).otherwise(F.lit(CLEAN)))
    cols = ["popularity", "danceability", "energy", "speechiness", "valence"]
    return f.groupBy("content_type").agg(*_sums(cols)).select(
        "content_type", F.col("_n").cast("long").alias("track_count"),
        *[_mean(c, 1 if c == "popularity" else 3) for c in cols])


def star_counts(star: Star) -> DataFrame:
    """Row count of every warehouse table plus artists with wins."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in star.tables().items()]
    parts.append(star.dim_artist.filter(F.col("grammy_wins") > 0)
                 .agg(F.count(F.lit(1)).cast("long").alias("row_count"))
                 .select(F.lit("dim_artist_with_wins").alias("table_name"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def top_by_name(star: Star, k: int = 10) -> DataFrame:
    """Ad-hoc: average popularity per artist *name* (not key), top k."""
    j = _per_artist(star, ["popularity"])
    out = j.groupBy("artist_name").agg(
        _avg("popularity", 6, "avg_pop"))
    return out.orderBy(F.desc("avg_pop"), F.asc("artist_name")).limit(k)


MARTS = {
    "mart_overview": overview,
    "mart_top_artists": top_artists,
    "mart_winner_compare": winner_compare,
    "mart_genre_features": genre_features,
    "mart_popularity_by_nominations": popularity_by_nominations,
    "mart_mood_quadrant": mood_quadrant,
    "mart_artist_scatter": artist_scatter,
    "mart_genre_share": genre_share,
    "mart_explicit_split": explicit_split,
}
