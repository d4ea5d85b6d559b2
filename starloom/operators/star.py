"""Star schema build: four dimensions with dense keys and one fact table.

Plan shape (one fact-sized pass per step, everything else dimension-sized):

1. The merged spine is staged once (parquet in the checkpoint folder);
   every stage records its exact row count and payload while it is
   written, and those sizes decide broadcast vs shuffle without extra
   probe jobs.
2. One hash aggregate over the spine at album grain (album, artist) yields
   the album's first appearance and the per-artist stats. The artist
   dimension aggregates that (an artist's first row is the earliest of its
   albums' first rows); its display name is fetched from the spine with a
   semi join on (artist, row order), a key that does not skew.
3. ``dim_year`` comes from ``dim_artist`` (the year is an artist attribute);
   ``dim_genre`` is a distinct over the spine (partial aggregation leaves a
   handful of rows per task).
4. Every dimension is numbered once and staged; independent stages run
   concurrently in waves. Album, artist and year keys are then resolved at
   dimension grain into one map keyed by (album_name, artist_norm), so the
   fact needs a single join for three keys plus a proven-small genre lookup.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import fits_broadcast, join_small
from starloom.operators.keys import dense_keys
from starloom.schemas import ROW_ORD, STAT_COLUMNS, TABLE_ORDER, WAREHOUSE
from starloom.session import Staged, stage, stage_all, temporary_stages

FACT_COLUMNS = tuple(f.name for f in WAREHOUSE["fact_track"].fields)


@dataclass(frozen=True)
class Star:
    dim_artist: DataFrame
    dim_album: DataFrame
    dim_genre: DataFrame
    dim_year: DataFrame
    fact_track: DataFrame
    # Exact (rows, payload bytes) per table where known, for broadcast checks.
    sizes: dict[str, tuple[int, int]] = field(default_factory=dict, compare=False)

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLE_ORDER}

    def side(self, name: str, fn=None) -> DataFrame | Staged:
        """A table (optionally narrowed by ``fn``: a projection or filter, which
        can only shrink it) plus its measured size bound when known, for
        ``join_small``."""
        df = getattr(self, name)
        if fn is not None:
            df = fn(df)
        if name in self.sizes:
            rows, nbytes = self.sizes[name]
            return Staged(df, rows, nbytes)
        return df

    def map(self, fn, keep_sizes: bool = True) -> Star:
        return Star(**{name: fn(name, df) for name, df in self.tables().items()},
                    sizes=dict(self.sizes) if keep_sizes else {})


def album_first_rows(merged: DataFrame) -> DataFrame:
    """Album grain: first appearance and the (per-artist constant) stats.

    Only fixed-width aggregation buffers, so this runs as a partial + final
    hash aggregate over the spine (no sort of fact-sized data)."""
    return merged.groupBy("album_name", "artist_norm").agg(
        F.min(ROW_ORD).alias("_first"),
        *[F.min(c).alias(c) for c in STAT_COLUMNS])


def artist_rows(merged: DataFrame, albums: Staged) -> DataFrame:
    """Artist grain: stats plus the display name of the artist's first row.

    The first row is the earliest of the artist's album first rows; its text
    is fetched with an equi-join on (artist_norm, _row_ord). That key is
    (nearly) unique per row, so even an artist owning a third of the spine
    spreads evenly over the join's partitions; the artist side is staged, and broadcast
    when its measured size allows, so that the spine does not move.
    """
    firsts = stage(albums.df.groupBy("artist_norm").agg(
        F.min("_first").alias(ROW_ORD), *[F.min(c).alias(c) for c in STAT_COLUMNS]), "artist-firsts").df
    names = join_small(merged.select("artist_norm", ROW_ORD, "artists"),
                       firsts.select("artist_norm", ROW_ORD), ["artist_norm", ROW_ORD], "left_semi")
    # Rows sharing an order value are copies of one source line: same text.
    names = names.groupBy("artist_norm").agg(F.min("artists").alias("artist_name"))
    return firsts.join(names, "artist_norm").select(
        "artist_norm", "artist_name", *STAT_COLUMNS)


#: Staged tables of a star build that its result reads; the others go when it is built.
_KEPT = ("merged", "dim-album", "dim-artist", "dim-genre", "dim-year", "key-map")


def build_star(merged: DataFrame, stage_spine: bool = True, lines: DataFrame | None = None) -> Star:
    """Split the merged spine into ``dim_artist``, ``dim_album``,
    ``dim_genre``, ``dim_year`` and ``fact_track``.

    Keys: artists, genres and years are numbered in sorted natural-key
    order, albums in order of first appearance (ties broken by the natural
    key). Year 0 (never nominated) is an ordinary member. ``lines``: the spine's rows as they
    were before the stats joined them, of which the fact needs none.
    """
    with temporary_stages(merged.sparkSession, kept=_KEPT):
        return _build_star(merged, stage_spine, lines)


def _build_star(merged: DataFrame, stage_spine: bool, lines: DataFrame | None) -> Star:
    m = stage(merged, "merged").df if stage_spine else merged

    def keyed(src: DataFrame, key: str, order: list[str]) -> Callable[[], DataFrame]:
        return lambda: dense_keys(src, key, order)

    # Independent stages run concurrently; each wave depends on the last.
    w1 = stage_all({
        "album-first": lambda: album_first_rows(m),
        "genre-rows": lambda: m.select(F.col("track_genre").alias("genre_name")).distinct(),
    })
    albums, genres = w1["album-first"], w1["genre-rows"]
    w2 = stage_all({
        "dim-album": lambda: dense_keys(
            albums.df.select("album_name", "artist_norm", "_first"), "album_key",
            ["_first", "album_name", "artist_norm"], drop=["_first"]),
        "artist-rows": lambda: artist_rows(m, albums),
        "dim-genre": keyed(genres.df, "genre_key", ["genre_name"]),
    })
    artists = w2["artist-rows"]
    years = artists.df.select(F.col("first_grammy_year").alias("year_value")).distinct()
    w3 = stage_all({
        "dim-artist": keyed(artists.df, "artist_key", ["artist_norm"]),
        "dim-year": keyed(years, "year_key", ["year_value"]),
    })

    # Each dimension is numbered once and staged: the key map, the fact join
    # and every later reader see the same keys. Exact sizes for broadcasts.
    staged = {"dim_album": w2["dim-album"], "dim_genre": w2["dim-genre"],
              "dim_artist": w3["dim-artist"], "dim_year": w3["dim-year"]}
    sizes = {name: (st.rows, st.bytes) for name, st in staged.items()}
    dim_album, dim_artist, dim_genre, dim_year = (
        staged[n].df for n in ("dim_album", "dim_artist", "dim_genre", "dim_year"))

    def sized(name: str, df: DataFrame) -> Staged:
        return Staged(df, *sizes[name])

    # Measured as it is joined, by a job over the dimension: narrower than the whole.
    artist_part = dim_artist.select("artist_key", "artist_norm", "first_grammy_year")
    key_map = join_small(dim_album, artist_part, "artist_norm")
    key_map = join_small(key_map, sized("dim_year", dim_year.withColumnRenamed(
        "year_value", "first_grammy_year")), "first_grammy_year")
    key_map = key_map.select("album_name", "artist_norm", "album_key", "artist_key", "year_key")
    # The map has a row for each album and more bytes: where the albums outgrow a broadcast it is
    # joined as it is; otherwise a staged copy is measured.
    albums_side = sized("dim_album", key_map)
    key_map = stage(key_map, "key-map") if fits_broadcast(albums_side) else albums_side

    fact = join_small(m if lines is None else lines, sized("dim_genre", dim_genre.withColumnRenamed(
        "genre_name", "track_genre")), "track_genre")
    fact = join_small(fact, key_map, ["album_name", "artist_norm"], salt_by=[ROW_ORD])
    fact = fact.withColumnRenamed("key", "music_key").select(*FACT_COLUMNS)

    return Star(dim_artist=dim_artist, dim_album=dim_album, dim_genre=dim_genre,
                dim_year=dim_year, fact_track=fact, sizes=sizes)


def conform(star: Star) -> Star:
    """Cast every table to the warehouse schema (INT keys, SMALLINT/TINYINT
    codes, FLOAT measures). ANSI casts raise on overflow instead of wrapping."""
    def cast(name: str, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                           for f in WAREHOUSE[name].fields])
    return star.map(cast)
