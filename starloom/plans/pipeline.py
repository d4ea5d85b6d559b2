"""End-to-end composition: sources -> clean -> merge -> star (-> publish)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.operators.clean import clean_awards, clean_tracks
from starloom.operators.enrich import award_stats, enrich
from starloom.operators.joins import fits_broadcast
from starloom.operators.star import Star, build_star, conform
from starloom.plans.resume import Run, fingerprint
from starloom.session import scratch, stage, stage_all, temporary_stages
from starloom.sources.fixtures import raw_awards, track_lines, tracks_of

_STAR_CACHE: dict[tuple[str, str, str], Star] = {}
_STAGE_CACHE: dict[tuple[str, str, str], DataFrame] = {}


def merged_from(tracks: DataFrame, awards: DataFrame) -> DataFrame:
    """Clean both sources and attach per-artist award stats to the spine."""
    return enrich(clean_tracks(tracks), award_stats(clean_awards(awards)))


def _staged_once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGE_CACHE:
        _STAGE_CACHE[key] = stage(build(), name).df
    return _STAGE_CACHE[key]


def landed_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The track source derived from the driver tables, landed once per
    session as parquet in the checkpoint folder (the landing/stage step of
    the pipeline); later readers scan it instead of re-running the joins.
    The joined lines are landed, of which readers make the columns they read."""
    return tracks_of(_staged_once(spark, sf_dir, "landed-tracks", lambda: track_lines(spark, sf_dir)))


def landed_awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The awards landing table derived from the driver tables, landed once."""
    return _staged_once(spark, sf_dir, "landed-awards", lambda: raw_awards(spark, sf_dir))


def land_sources(spark: SparkSession, sf_dir: str) -> None:
    """Land both fixture sources, concurrently, if not landed yet."""
    app = spark.sparkContext.applicationId
    todo = {name: build for name, build in (
        ("landed-tracks", lambda: track_lines(spark, sf_dir)),
        ("landed-awards", lambda: raw_awards(spark, sf_dir)))
        if (app, sf_dir, name) not in _STAGE_CACHE}
    if todo:
        for name, st in stage_all(todo).items():
            _STAGE_CACHE[(app, sf_dir, name)] = st.df


def fixture_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned tracks, planned once per session: landed rows without their copies, which
    every reader drops as it scans them."""
    key = (spark.sparkContext.applicationId, sf_dir, "clean-tracks")
    if key not in _STAGE_CACHE:
        land_sources(spark, sf_dir)
        _STAGE_CACHE[key] = clean_tracks(landed_tracks(spark, sf_dir), reread=True)
    return _STAGE_CACHE[key]


def fixture_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged spine from the landed sources, planned once per session. Where the award stats
    are broadcast, every reader adds them as it scans the tracks; otherwise the spine moves to
    meet them, so it is staged, and every reader scans the same written copy."""
    key = (spark.sparkContext.applicationId, sf_dir, "merged")
    if key not in _STAGE_CACHE:
        tracks = fixture_tracks(spark, sf_dir)
        stats = stage(award_stats(clean_awards(landed_awards(spark, sf_dir))), "award-stats")
        merged = enrich(tracks, stats)
        _STAGE_CACHE[key] = merged if fits_broadcast(stats) else stage(merged, "merged").df
    return _STAGE_CACHE[key]


def fixture_star(spark: SparkSession, sf_dir: str) -> Star:
    """Conformed warehouse tables built from the driver tables.

    Built once per session and folder: every table is staged in the shared
    checkpoint folder, so the marts read it like a published warehouse.
    """
    key = (spark.sparkContext.applicationId, sf_dir, "conformed")
    if key not in _STAR_CACHE:
        _STAR_CACHE[key] = staged_star(conform(fixture_raw_star(spark, sf_dir)))
    return _STAR_CACHE[key]


def fixture_raw_star(spark: SparkSession, sf_dir: str) -> Star:
    """The star as built (source types, before the warehouse casts)."""
    key = (spark.sparkContext.applicationId, sf_dir, "raw")
    if key not in _STAR_CACHE:
        _STAR_CACHE[key] = build_star(fixture_merged(spark, sf_dir), stage_spine=False,
                                      lines=fixture_tracks(spark, sf_dir))
    return _STAR_CACHE[key]


def staged_star(star: Star) -> Star:
    """Write the fact once to the checkpoint folder, so repeated readers scan
    parquet instead of re-running its join (the dimensions are staged by
    ``build_star`` already)."""
    fact = stage(star.fact_track, "fact_track")
    sizes = dict(star.sizes)
    sizes["fact_track"] = (fact.rows, fact.bytes)
    return Star(dim_artist=star.dim_artist, dim_album=star.dim_album,
                dim_genre=star.dim_genre, dim_year=star.dim_year, fact_track=fact.df,
                sizes=sizes)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row-count metric collected by whatever action runs next
    (no extra job)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def run(tracks: DataFrame, awards: DataFrame, target: str, *, csv_out: str | None = None,
        enforce: bool = True, log=None, work: str | None = None, one_csv: bool = False) -> dict[str, int | str]:
    """End-to-end job: clean, merge, build, validate and publish the star;
    optionally export the merged table as CSV (``one_csv``: as one file).

    Stage row counts are collected with observations attached to the plan,
    so logging them costs no extra job. An unset ``csv_out`` skips the export
    with a warning, as an unconfigured optional sink should.

    ``work`` names a folder of this job alone. A run that fails leaves its finished steps there, and the
    next one with the same inputs goes on after them: the merged table, and the version written
    below the same target, which is validated anew. A run that succeeds removes the folder.
    All other tables staged on the way are removed at the end in any case.
    """
    import logging

    from starloom.sinks.files import export_csv, export_one_csv
    from starloom.sinks.warehouse import is_written, new_version, publish_written, read_published, write_version

    log = log or logging.getLogger("starloom.run")
    spark = tracks.sparkSession
    steps = Run(spark, work or scratch(spark, "run-steps"), fingerprint(tracks, awards) if work else "")

    def build() -> tuple[DataFrame, Callable[[], dict]]:
        raw_t, o_raw_t = observed(tracks, "raw_tracks")
        raw_a, o_raw_a = observed(awards, "raw_awards")
        clean_t, o_clean_t = observed(clean_tracks(raw_t), "clean_tracks")
        clean_a, o_clean_a = observed(clean_awards(raw_a), "clean_awards")
        seen = {"raw_tracks": o_raw_t, "raw_awards": o_raw_a, "clean_tracks": o_clean_t, "clean_awards": o_clean_a}
        return (enrich(clean_t, award_stats(clean_a)),
                lambda: {name: int(o.get["rows"]) for name, o in seen.items()})

    with temporary_stages(spark):
        merged, counts = steps.step("merged", build)
        counts = {**counts, "merged": merged.rows}
        for k, v in counts.items():
            log.info("%s: %s rows%s", k, v, " (resumed)" if "merged" in steps.reused else "")

        def write() -> dict:
            version = new_version()
            # What the build staged goes with it: the export does not need the room twice.
            with temporary_stages(spark):
                sizes = write_version(conform(build_star(merged.df, stage_spine=False)), target, version)
            return {"target": target, "version": version, "sizes": sizes}

        written = steps.noted("written", write, lambda n: n["target"] == target
                              and is_written(spark, target, n["version"]))
        version = publish_written(spark, target, written["version"],
                                  {name: tuple(size) for name, size in written["sizes"].items()}, enforce)
        published = read_published(spark, target, version)
        for name in published.tables():  # observed while publishing: no extra job
            counts[name] = published.sizes[name][0]
        counts["version"] = version
        log.info("warehouse version %s published%s", version, " (written before)" if "written" in steps.reused else "")

        if csv_out and one_csv:
            export_one_csv(merged.df, csv_out, order_by="_row_ord")
        elif csv_out:
            export_csv(merged.df.drop("_row_ord"), csv_out)
        if csv_out:
            log.info("merged table exported to %s", csv_out)
        else:
            log.warning("skipping CSV export: no output path configured")
    steps.finish()
    return counts
