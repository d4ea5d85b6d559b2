"""Command-line entry point for the end-to-end job.

    python -m starloom.cli --tracks tracks.csv --awards awards.csv \
        --target /warehouse/music [--csv-out /exports/merged] [--no-enforce]

``--awards`` may be a CSV path or a JDBC URL (``jdbc:...``, table via
``--awards-table``). The session is the one the job is submitted with (its master and its
``spark.checkpoint.dir``); only without any configured master a tuned local one is made.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys

from pyspark.sql import SparkSession

from starloom.plans.pipeline import run
from starloom.session import platform_session
from starloom.sources.files import read_awards_csv, read_tracks
from starloom.sources.jdbc import read_awards_jdbc


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="starloom", description=__doc__.split("\n\n")[0])
    p.add_argument("--tracks", required=True, help="track-grain CSV (or parquet) path")
    p.add_argument("--tracks-format", default="csv", choices=("csv", "parquet"))
    p.add_argument("--awards", required=True, help="awards CSV path or JDBC URL")
    p.add_argument("--awards-table", default="awards")
    p.add_argument("--target", required=True, help="warehouse folder (versioned)")
    p.add_argument("--csv-out", default=None, help="optional merged-table CSV export")
    p.add_argument("--one-csv", action="store_true", help="export one file instead of a folder of parts")
    p.add_argument("--multi-line", action="store_true", help="quoted CSV values may hold newlines")
    p.add_argument("--work", default=None, help="folder of this job, to resume a failed run from")
    p.add_argument("--no-enforce", action="store_true",
                   help="publish even if contract checks report violations")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = spark or platform_session()
    tracks = read_tracks(spark, args.tracks, fmt=args.tracks_format, multi_line=args.multi_line)
    awards = (read_awards_jdbc(spark, args.awards, args.awards_table)
              if args.awards.startswith("jdbc:") else read_awards_csv(spark, args.awards, multi_line=args.multi_line))
    counts = run(tracks, awards, args.target, csv_out=args.csv_out,
                 enforce=not args.no_enforce, one_csv=args.one_csv, work=args.work)
    print(json.dumps(counts))
    return counts


if __name__ == "__main__":
    main(sys.argv[1:])
