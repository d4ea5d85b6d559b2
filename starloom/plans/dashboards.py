"""The nine dashboard metrics as Spark SQL over the warehouse views
(:func:`starloom.plans.views.register_views`): ``spark.sql(DASHBOARD_SQL[name])``.

Every statement groups the fact by the key of what it reports before it meets a dimension, as
the DataFrame marts do, and ranks by the metric with the key as tie-break.
"""

from __future__ import annotations


def _mean(column: str, digits: int) -> str:
    """A mean from sums and counts of a finer grain, rounded half up."""
    return (f"CAST(round(CAST(sum(sum_{column}) / sum(n_{column}) AS DECIMAL(38,9)), {digits}) AS DOUBLE) "
            f"AS avg_{column}")


def _grain(key: str, *measures: str) -> str:
    """The fact at the grain of one key: rows, and sum and count of each measure."""
    parts = [f"sum(CAST({m} AS DOUBLE)) AS sum_{m}, count({m}) AS n_{m}" for m in measures]
    return f"(SELECT {key}, count(*) AS rows, {', '.join(parts)} FROM fact_track GROUP BY {key})"


_ROWS = "CAST(sum(rows) AS BIGINT) AS track_count"
_STATUS = "CASE WHEN grammy_wins > 0 THEN 'Grammy Winner' ELSE 'No Grammy' END"
_FEATURES = ("danceability", "energy", "valence", "acousticness", "speechiness", "instrumentalness")

DASHBOARD_SQL = {
    "mart_overview": f"""
WITH artists AS (SELECT * FROM {_grain('artist_key', 'popularity')} JOIN dim_artist USING (artist_key)),
used AS (SELECT bitmap_count(bitmap_construct_agg(bitmap_bit_position(genre_key))) AS n
         FROM fact_track GROUP BY bitmap_bucket_number(genre_key))
SELECT CAST(sum(rows) AS BIGINT) AS total_tracks, count(*) AS unique_artists,
       count_if(grammy_wins > 0) AS grammy_artists, (SELECT CAST(sum(n) AS BIGINT) FROM used) AS total_genres,
       {_mean('popularity', 1)}
FROM artists""",
    "mart_top_artists": f"""
SELECT artist_name, grammy_nominations, grammy_wins, track_count, avg_popularity
FROM (SELECT artist_key, artist_name, grammy_nominations, grammy_wins, {_ROWS}, {_mean('popularity', 1)}
      FROM {_grain('artist_key', 'popularity')} JOIN dim_artist USING (artist_key)
      GROUP BY artist_key, artist_name, grammy_nominations, grammy_wins)
ORDER BY avg_popularity DESC, artist_key LIMIT 10""",
    "mart_winner_compare": f"""
SELECT {_STATUS} AS grammy_status, count(*) AS artist_count, {_ROWS}, {_mean('popularity', 1)},
       {_mean('danceability', 3)}, {_mean('energy', 3)}
FROM {_grain('artist_key', 'popularity', 'danceability', 'energy')} JOIN dim_artist USING (artist_key)
GROUP BY 1""",
    "mart_genre_features": f"""
SELECT genre_name, track_count, {', '.join(f'avg_{c}' for c in _FEATURES)}
FROM (SELECT genre_key, genre_name, {_ROWS}, {', '.join(_mean(c, 3) for c in _FEATURES)}
      FROM {_grain('genre_key', *_FEATURES)} JOIN dim_genre USING (genre_key) GROUP BY genre_key, genre_name)
ORDER BY track_count DESC, genre_key LIMIT 15""",
    "mart_popularity_by_nominations": f"""
SELECT artist_name, grammy_nominations, grammy_wins, {_mean('popularity', 1)}, {_mean('danceability', 3)},
       {_mean('energy', 3)}, {_ROWS}
FROM {_grain('artist_key', 'popularity', 'danceability', 'energy')} JOIN dim_artist USING (artist_key)
WHERE grammy_nominations > 0
GROUP BY artist_key, artist_name, grammy_nominations, grammy_wins
ORDER BY grammy_nominations DESC, artist_key""",
    "mart_mood_quadrant": f"""
SELECT genre_name, {_mean('energy', 3)}, {_mean('valence', 3)}, {_mean('danceability', 3)},
       {_mean('popularity', 1)}, {_ROWS}
FROM {_grain('genre_key', 'energy', 'valence', 'danceability', 'popularity')} JOIN dim_genre USING (genre_key)
GROUP BY genre_key, genre_name""",
    "mart_artist_scatter": f"""
SELECT artist_name, {_STATUS} AS grammy_status, {_mean('danceability', 3)}, {_mean('energy', 3)},
       {_mean('popularity', 1)}, {_ROWS}
FROM {_grain('artist_key', 'danceability', 'energy', 'popularity')} JOIN dim_artist USING (artist_key)
GROUP BY artist_key, artist_name, grammy_wins HAVING sum(rows) >= 5""",
    "mart_genre_share": """
WITH pairs AS (SELECT genre_key, artist_key FROM fact_track GROUP BY genre_key, artist_key),
shares AS (SELECT genre_key, count(*) AS total_artists, count_if(grammy_wins > 0) AS grammy_artists
           FROM pairs JOIN dim_artist USING (artist_key) GROUP BY genre_key)
SELECT genre_name, total_artists, grammy_artists,
       CAST(round(CAST(100.0D * grammy_artists / total_artists AS DECIMAL(38,9)), 1) AS DOUBLE) AS grammy_pct
FROM shares JOIN dim_genre USING (genre_key) WHERE total_artists >= 20
ORDER BY grammy_pct DESC, genre_key LIMIT 10""",
    "mart_explicit_split": f"""
SELECT CASE WHEN explicit THEN 'Explicit' ELSE 'Clean' END AS content_type, {_ROWS}, {_mean('popularity', 1)},
       {_mean('danceability', 3)}, {_mean('energy', 3)}, {_mean('speechiness', 3)}, {_mean('valence', 3)}
FROM {_grain('explicit', 'popularity', 'danceability', 'energy', 'speechiness', 'valence')} GROUP BY 1""",
}
