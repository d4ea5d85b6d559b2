"""Registry of runnable queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables (or tables Spark derives from them) in
full; nothing here runs on fixed inline data. Names follow SURVEY section 2.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from starloom import storage

from starloom.functions.text import blank_to_null, na_tokens_to_null, normalize_key
from starloom.functions.time import epoch_micros, parse_ts_utc
from starloom.operators import profile as P
from starloom.operators import validate as V
from starloom.operators.clean import clean_awards, clean_tracks, dedup_wide_rows
from starloom.operators.enrich import award_stats
from starloom.plans import marts
from starloom.plans.pipeline import (
    fixture_merged,
    fixture_raw_star,
    fixture_star,
    landed_awards,
    landed_tracks,
    run,
)
from starloom.schemas import AWARDS, TABLE_ORDER
from starloom.session import scratch
from starloom.sinks.files import export_csv, export_one_csv
from starloom.sinks.warehouse import publish, publish_views, read_published
from starloom.sources.files import (
    CSV_OPTIONS,
    create_landing_table,
    read_awards_csv,
    read_csv_text,
    read_stage,
    read_tracks,
    write_stage,
)
from starloom.sources.fixtures import gappy_tracks_text, raw_tracks, table

Query = Callable[[SparkSession, str], DataFrame]

# The columns that the profiles report.
DESCRIBE_COLS = ("popularity", "duration_ms", "danceability", "energy", "key", "loudness",
                 "mode", "speechiness", "acousticness", "instrumentalness", "liveness",
                 "valence", "tempo", "time_signature")
PLOT_COLS = ("popularity", "danceability", "energy", "valence", "acousticness", "tempo")
CORR_COLS = ("popularity", "danceability", "energy", "loudness", "speechiness",
             "acousticness", "instrumentalness", "liveness", "valence", "tempo")
DOC_COLS = ("doc_id", "text", "lang", "source", "n_chars")


def _awards_out(df: DataFrame) -> DataFrame:
    """Cleaned awards with instants rendered as epoch microseconds."""
    return df.select(
        "_row_ord", "year", "title",
        epoch_micros("published_at").alias("published_at_us"),
        epoch_micros("updated_at").alias("updated_at_us"),
        "category", "nominee", "artist", "winner", "artist_norm")


def _shown(df: DataFrame) -> DataFrame:
    """The order key is wider than a long, so results show it as text."""
    return df.withColumn("_row_ord", F.col("_row_ord").cast("string"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(*DOC_COLS)


# --- sources, scalar rules, cleaning -------------------------------------

def scan_tracks(spark, d):
    """The track source straight from the driver tables (joins included)."""
    return _shown(raw_tracks(spark, d))


def na_tokens_to_null_q(spark, d):
    return na_tokens_to_null(landed_awards(spark, d))


def blank_to_null_q(spark, d):
    return blank_to_null(landed_awards(spark, d))


def normalize_key_q(spark, d):
    return _shown(landed_tracks(spark, d)).select("_row_ord", "artists",
                                                  normalize_key("artists").alias("artist_norm"))


def parse_mixed_ts(spark, d):
    a = landed_awards(spark, d)
    return a.select("_row_ord", "published_at", "updated_at",
                    epoch_micros(parse_ts_utc("published_at")).alias("published_at_us"),
                    epoch_micros(parse_ts_utc("updated_at")).alias("updated_at_us"))


def clean_tracks_q(spark, d):
    return _shown(clean_tracks(landed_tracks(spark, d)))


def clean_awards_q(spark, d):
    return _awards_out(clean_awards(landed_awards(spark, d)))


def award_stats_q(spark, d):
    return award_stats(clean_awards(landed_awards(spark, d)))


def merge_left_fill(spark, d):
    return _shown(fixture_merged(spark, d))


def dedup_documents(spark, d):
    """Whole documents deduplicated on every column but the id (lowest id kept);
    only signature-collision groups shuffle their full texts."""
    return dedup_wide_rows(_documents(spark, d), order_col="doc_id")


def drop_index_reveals_dups(spark, d):
    """Row count and distinct rows with the index column, without it, and on
    the text alone. Each distinct count is the row count minus a duplicate
    count computed on signature candidates, so full texts are shuffled only
    for rows that share a signature."""
    docs = _documents(spark, d)
    parts = [("n_rows", docs.agg(F.count(F.lit(1)).cast("long").alias("v"))),
             ("dup_with_index", P.duplicate_count(docs, by_signature=True)),
             ("dup_without_index", P.duplicate_count(docs, ["doc_id"], by_signature=True)),
             ("dup_text", P.duplicate_count(docs.select("text"), by_signature=True))]
    long = _union([df.select(F.lit(k).alias("k"), F.col(df.columns[0]).alias("v"))
                   for k, df in parts])
    m = {k: F.max(F.when(F.col("k") == k, F.col("v"))) for k, _ in parts}
    return long.agg(
        m["n_rows"].alias("n_rows"),
        (m["n_rows"] - m["dup_with_index"]).alias("distinct_with_index"),
        (m["n_rows"] - m["dup_without_index"]).alias("distinct_without_index"),
        (m["n_rows"] - m["dup_text"]).alias("distinct_text"))


# --- star tables ------------------------------------------------------------

def _dim(name: str) -> Query:
    def run(spark, d):
        return getattr(fixture_star(spark, d), name)
    run.__name__ = name
    return run


def fact_track(spark, d):
    return fixture_raw_star(spark, d).fact_track


def fact_conform(spark, d):
    return fixture_star(spark, d).fact_track


# --- contract checks --------------------------------------------------------

def check_fact_grain(spark, d):
    return V.grain_violations(fixture_star(spark, d).fact_track, ["track_id", "genre_key"])


def check_unique_genre(spark, d):
    return V.unique_violations(fixture_star(spark, d).dim_genre, "genre_name",
                               "UNICODE_CI_AI", key="genre_key")


def check_fk_orphans(spark, d):
    return V.fk_orphans(fixture_star(spark, d))


def check_not_null(spark, d):
    return V.null_counts(fixture_star(spark, d))


def check_domain(spark, d):
    return V.domain_violations(fixture_star(spark, d))


def check_violations(spark, d):
    return V.violations(fixture_star(spark, d))


# --- warehouse sanity / run metrics -------------------------------------------

def star_counts(spark, d):
    return marts.star_counts(fixture_star(spark, d))


def adhoc_top_by_name(spark, d):
    return marts.top_by_name(fixture_star(spark, d))


def pipeline_counts(spark, d):
    """The counts that the end-to-end job observes while it cleans, merges, builds, publishes
    and exports."""
    folder = scratch(spark, "run")
    counts = run(landed_tracks(spark, d), landed_awards(spark, d), f"{folder}/warehouse",
                 csv_out=f"{folder}/merged", enforce=False)  # the given keys repeat
    return spark.createDataFrame([(k, int(v)) for k, v in counts.items() if k != "version"],
                                 "stage string, row_count long")


# --- files, stages, publishing ------------------------------------------------

def csv_tracks(spark, d):
    """The track source written as a CSV export with its index column and read back."""
    path = scratch(spark, "tracks-csv")
    export_csv(raw_tracks(spark, d).withColumnRenamed("_row_ord", "_c0"), path)
    return _shown(read_tracks(spark, path))


def csv_awards(spark, d):
    """The awards source written as CSV and bulk-loaded into the landing layout."""
    path = scratch(spark, "awards-csv")
    export_csv(landed_awards(spark, d).drop("_row_ord"), path)
    return read_awards_csv(spark, path)


def landing_table(spark, d):
    """The landing table created by its DDL (twice: re-runnable), filled and read."""
    path = scratch(spark, "landing")
    name = "landing_" + path.rsplit("-", 1)[-1]
    create_landing_table(spark, name, path)
    landed_awards(spark, d).drop("_row_ord").write.insertInto(name)
    create_landing_table(spark, name, path)
    return spark.table(name)


def stage_round_trip(spark, d):
    path = scratch(spark, "stage")
    write_stage(landed_awards(spark, d), path)
    return read_stage(spark, path)


def csv_export(spark, d):
    """The merged table exported as CSV and read back with its schema."""
    path = scratch(spark, "export")
    merged = fixture_merged(spark, d).drop("_row_ord")
    export_csv(merged, path)
    return spark.read.schema(merged.schema).options(**CSV_OPTIONS).csv(path)


def csv_documents(spark, d):
    """Documents, whose texts hold line feeds and quotes, written as CSV in id order and read back
    by many tasks with their source order."""
    path = scratch(spark, "documents-csv")
    docs = _documents(spark, d)
    export_csv(docs.orderBy("doc_id"), path)
    return read_csv_text(spark, path, docs.schema)


def csv_source_order(spark, d):
    """The awards source, exported as one CSV file in source order, without an index column, and read
    back: every row's number in the file."""
    path = scratch(spark, "awards-order") + ".csv"
    export_one_csv(landed_awards(spark, d).withColumn("event", F.col("_row_ord")), path, order_by="_row_ord")
    kind = StructType([*AWARDS.fields, StructField("event", LongType())])
    return read_csv_text(spark, path, kind, multi_line=False).select("_row_ord", "event", "year", "artist")


def csv_by_name(spark, d):
    """The awards CSV with its columns in another order: they are found by their names."""
    path = scratch(spark, "awards-swapped")
    awards = landed_awards(spark, d).drop("_row_ord")
    export_csv(awards.select(*reversed(awards.columns)), path)
    return read_awards_csv(spark, path)


def csv_one_file(spark, d):
    """The merged table as one CSV file in source order, read back with the rows' numbers in the file."""
    path = scratch(spark, "merged") + ".csv"
    merged = fixture_merged(spark, d)
    export_one_csv(merged, path, order_by="_row_ord")
    text = StructType([StructField(c, StringType()) for c in merged.columns if c != "_row_ord"])
    return read_csv_text(spark, path, text).select("_row_ord", "track_id", "artist_norm")


def catalog_fact_track(spark, d):
    """The warehouse published and read by table name through catalog views, created twice."""
    target = scratch(spark, "catalog")
    name = "starloom_" + target.rsplit("-", 1)[-1]
    publish(fixture_star(spark, d), target, enforce=False)  # the given keys repeat
    publish_views(spark, name, target)
    publish_views(spark, name, target)
    return spark.table(f"{name}.fact_track")


def resumed_counts(spark, d):
    """Counts of a run that goes on after the merged step of a run that failed while publishing,
    and the steps and CSV that it did not need to do."""
    work, target = scratch(spark, "run-work"), scratch(spark, "run-target")
    tracks, awards = landed_tracks(spark, d), landed_awards(spark, d)
    try:
        run(tracks, awards, target, work=work)  # the given keys repeat: the contract is violated
    except V.ContractViolation:
        pass
    counts = run(tracks, awards, target, work=work, enforce=False)
    counts["steps_left"] = len(storage.listing(spark, work))
    return spark.createDataFrame([(k, int(v)) for k, v in counts.items() if k != "version"],
                                 "stage string, row_count long")


def gappy_tracks(spark, d):
    """The track source with missing-value tokens and NaN, through the CSV reader."""
    path = scratch(spark, "gappy-csv")
    export_csv(gappy_tracks_text(spark, d).withColumnRenamed("_row_ord", "_c0"), path)
    return read_tracks(spark, path)


def gappy_nulls(spark, d):
    return P.nulls(gappy_tracks(spark, d), "gappy_tracks")


def gappy_describe(spark, d):
    return P.describe(gappy_tracks(spark, d), ["popularity", "energy", "tempo", "valence", "danceability"])


def gappy_corr(spark, d):
    return P.corr_matrix(gappy_tracks(spark, d), CORR_COLS)


def _published(name: str) -> Query:
    def run_(spark, d):
        target = scratch(spark, "published")
        publish(fixture_star(spark, d), target, enforce=False)  # the given keys repeat
        return getattr(read_published(spark, target), name)
    run_.__name__ = f"published_{name}"
    return run_


# --- profiling ----------------------------------------------------------------

def profile_shape(spark, d):
    return P.shape(landed_tracks(spark, d), "raw_tracks").unionByName(
        P.shape(landed_awards(spark, d), "raw_awards"))


def profile_info(spark, d):
    return P.info(landed_tracks(spark, d))


def profile_describe(spark, d):
    return P.describe(landed_tracks(spark, d), DESCRIBE_COLS)


def profile_describe_all(spark, d):
    return P.describe_all(landed_awards(spark, d))


def profile_nulls(spark, d):
    return P.nulls(landed_tracks(spark, d), "raw_tracks").unionByName(
        P.nulls(landed_awards(spark, d), "raw_awards"))


def profile_dup_count(spark, d):
    docs = _documents(spark, d)
    return (P.duplicate_count(docs, by_signature=True)
            .select(F.lit("with_index").alias("mode"), "duplicates")
            .unionByName(P.duplicate_count(docs, ["doc_id"], by_signature=True)
                         .select(F.lit("without_index").alias("mode"), "duplicates")))


def profile_dup_sample(spark, d):
    return P.duplicate_members(_documents(spark, d), ["doc_id"], ["text", "doc_id"], 4,
                               by_signature=True)


def profile_key_dups(spark, d):
    return P.key_duplicate_rows(landed_tracks(spark, d), ["track_id"])


def profile_distinct(spark, d):
    t, a = landed_tracks(spark, d), landed_awards(spark, d)
    parts = [t.select(F.lit("track_genre").alias("column_name"), F.col("track_genre").alias("value"))]
    parts += [a.select(F.lit(c).alias("column_name"), F.col(c).alias("value"))
              for c in ("category", "title", "winner")]
    return _union([p.distinct() for p in parts])


def profile_top_genres(spark, d):
    return P.top_values(landed_tracks(spark, d), "track_genre", 15, "track_genre")


def profile_top_entities(spark, d):
    return P.first_entity_counts(landed_tracks(spark, d), "artists", 10)


def profile_top_categories(spark, d):
    return P.top_values(landed_awards(spark, d), "category", 15, "category")


def profile_top_award_artists(spark, d):
    return P.top_values(blank_to_null(landed_awards(spark, d)), "artist", 10, "artist")


def profile_freq_by_year(spark, d):
    a = landed_awards(spark, d)
    return (a.filter(F.col("year").isNotNull()).groupBy("year")
            .agg(F.count(F.lit(1)).cast("long").alias("n")).orderBy("year"))


def profile_head_tail(spark, d):
    return _shown(P.head_tail(landed_tracks(spark, d), "_row_ord", 5))


def profile_histogram(spark, d):
    return P.histogram(landed_tracks(spark, d), PLOT_COLS, 50)


def profile_boxstats(spark, d):
    return P.boxstats(landed_tracks(spark, d), PLOT_COLS)


def profile_corr(spark, d):
    return P.corr_matrix(landed_tracks(spark, d), CORR_COLS)


def _mart(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(fixture_star(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {
        "scan_tracks": scan_tracks,
        "na_tokens_to_null": na_tokens_to_null_q,
        "blank_to_null": blank_to_null_q,
        "normalize_key": normalize_key_q,
        "parse_mixed_ts": parse_mixed_ts,
        "clean_tracks": clean_tracks_q,
        "clean_awards": clean_awards_q,
        "award_stats": award_stats_q,
        "merge_left_fill": merge_left_fill,
        "dedup_documents": dedup_documents,
        "drop_index_reveals_dups": drop_index_reveals_dups,
        "dim_artist": _dim("dim_artist"),
        "dim_album": _dim("dim_album"),
        "dim_genre": _dim("dim_genre"),
        "dim_year": _dim("dim_year"),
        "fact_track": fact_track,
        "fact_conform": fact_conform,
        "check_fact_grain": check_fact_grain,
        "check_unique_genre": check_unique_genre,
        "check_fk_orphans": check_fk_orphans,
        "check_not_null": check_not_null,
        "check_domain": check_domain,
        "check_violations": check_violations,
        "star_counts": star_counts,
        "adhoc_top_by_name": adhoc_top_by_name,
        "pipeline_counts": pipeline_counts,
        "csv_tracks": csv_tracks,
        "csv_awards": csv_awards,
        "landing_table": landing_table,
        "stage_round_trip": stage_round_trip,
        "csv_export": csv_export,
        "csv_documents": csv_documents,
        "csv_source_order": csv_source_order,
        "csv_by_name": csv_by_name,
        "csv_one_file": csv_one_file,
        "catalog_fact_track": catalog_fact_track,
        "resumed_counts": resumed_counts,
        "gappy_nulls": gappy_nulls,
        "gappy_describe": gappy_describe,
        "gappy_corr": gappy_corr,
        "profile_shape": profile_shape,
        "profile_info": profile_info,
        "profile_describe": profile_describe,
        "profile_describe_all": profile_describe_all,
        "profile_nulls": profile_nulls,
        "profile_dup_count": profile_dup_count,
        "profile_dup_sample": profile_dup_sample,
        "profile_key_dups": profile_key_dups,
        "profile_distinct": profile_distinct,
        "profile_top_genres": profile_top_genres,
        "profile_top_entities": profile_top_entities,
        "profile_top_categories": profile_top_categories,
        "profile_top_award_artists": profile_top_award_artists,
        "profile_freq_by_year": profile_freq_by_year,
        "profile_head_tail": profile_head_tail,
        "profile_histogram": profile_histogram,
        "profile_boxstats": profile_boxstats,
        "profile_corr": profile_corr,
    }
    for name in TABLE_ORDER:
        q[f"published_{name}"] = _published(name)
    for name, fn in marts.MARTS.items():
        q[name] = _mart(fn)
    return q
