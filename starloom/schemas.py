"""Explicit schemas: the two sources and the five warehouse tables (fixed values: the column
names, types and ranges that the sources and the warehouse DDL have).

Sources are read with these (never ``inferSchema`` in production). The
warehouse types mirror the DDL: INT keys, TINYINT UNSIGNED popularity
(ShortType plus a 0..255 domain check), TINYINT codes, FLOAT measures.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

ROW_ORD = "_row_ord"

AUDIO_FEATURES = ("danceability", "energy", "loudness", "speechiness", "acousticness",
                  "instrumentalness", "liveness", "valence", "tempo")

# Track-grain source, CSV layout: a blank-headed index column first.
TRACKS_CSV = StructType(
    [StructField("_c0", DecimalType(38, 0), True),
     StructField("track_id", StringType(), True),
     StructField("artists", StringType(), True),
     StructField("album_name", StringType(), True),
     StructField("track_name", StringType(), True),
     StructField("popularity", IntegerType(), True),
     StructField("duration_ms", IntegerType(), True),
     StructField("explicit", BooleanType(), True)]
    + [StructField(c, DoubleType(), True) for c in ("danceability", "energy")]
    + [StructField("key", IntegerType(), True),
       StructField("loudness", DoubleType(), True),
       StructField("mode", IntegerType(), True)]
    + [StructField(c, DoubleType(), True) for c in
       ("speechiness", "acousticness", "instrumentalness", "liveness", "valence", "tempo")]
    + [StructField("time_signature", IntegerType(), True),
       StructField("track_genre", StringType(), True)]
)

TRACK_COLUMNS = tuple(f.name for f in TRACKS_CSV.fields[1:])

# Awards landing table: all text except year.
AWARDS = StructType(
    [StructField("year", IntegerType(), True)]
    + [StructField(c, StringType(), True) for c in
       ("title", "published_at", "updated_at", "category", "nominee", "artist",
        "workers", "img", "winner")]
)

STAT_COLUMNS = ("grammy_nominations", "grammy_wins", "first_grammy_year", "last_grammy_year")

DIM_ARTIST = StructType([
    StructField("artist_key", IntegerType(), False),
    StructField("artist_norm", StringType(), False),
    StructField("artist_name", StringType(), False),
    StructField("grammy_nominations", IntegerType(), False),
    StructField("grammy_wins", IntegerType(), False),
    StructField("first_grammy_year", IntegerType(), False),
    StructField("last_grammy_year", IntegerType(), False),
])

DIM_ALBUM = StructType([
    StructField("album_key", IntegerType(), False),
    StructField("album_name", StringType(), False),
    StructField("artist_norm", StringType(), False),
])

DIM_GENRE = StructType([
    StructField("genre_key", IntegerType(), False),
    StructField("genre_name", StringType(), False),
])

DIM_YEAR = StructType([
    StructField("year_key", IntegerType(), False),
    StructField("year_value", IntegerType(), False),
])

FACT_TRACK = StructType([
    StructField("track_id", StringType(), False),
    StructField("artist_key", IntegerType(), False),
    StructField("album_key", IntegerType(), False),
    StructField("genre_key", IntegerType(), False),
    StructField("year_key", IntegerType(), False),
    StructField("popularity", ShortType(), False),
    StructField("duration_ms", IntegerType(), False),
    StructField("explicit", BooleanType(), False),
    StructField("danceability", FloatType(), False),
    StructField("energy", FloatType(), False),
    StructField("music_key", ByteType(), False),
    StructField("loudness", FloatType(), False),
    StructField("mode", ByteType(), False),
    StructField("speechiness", FloatType(), False),
    StructField("acousticness", FloatType(), False),
    StructField("instrumentalness", FloatType(), False),
    StructField("liveness", FloatType(), False),
    StructField("valence", FloatType(), False),
    StructField("tempo", FloatType(), False),
    StructField("time_signature", ByteType(), False),
])

WAREHOUSE = {
    "dim_artist": DIM_ARTIST,
    "dim_album": DIM_ALBUM,
    "dim_genre": DIM_GENRE,
    "dim_year": DIM_YEAR,
    "fact_track": FACT_TRACK,
}

# Load order (dims first); deletes run in reverse.
TABLE_ORDER = ("dim_artist", "dim_album", "dim_genre", "dim_year", "fact_track")

# Warehouse domain rules: (table, column, lo, hi) ranges and varchar lengths.
RANGES = (
    ("fact_track", "popularity", 0, 255),
    ("fact_track", "music_key", -128, 127),
    ("fact_track", "mode", -128, 127),
    ("fact_track", "time_signature", -128, 127),
)
LENGTHS = (
    ("dim_artist", "artist_norm", 255),
    ("dim_artist", "artist_name", 512),
    ("dim_album", "album_name", 512),
    ("dim_album", "artist_norm", 255),
    ("dim_genre", "genre_name", 64),
    ("fact_track", "track_id", 32),
)
