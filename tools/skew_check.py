"""Skew experiment: build the star from the driver tables as they are, and
again with one artist owning a third of the rows and one album a quarter,
then report wall times and the worst task-time spread per run from Spark's
event log (written to a scratch folder; no UI).

Usage: python tools/skew_check.py [sf_dir] [scratch_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from starloom.operators.star import build_star  # noqa: E402
from starloom.plans.pipeline import landed_awards, landed_tracks, merged_from  # noqa: E402
from starloom.session import ensure_checkpoint_dir  # noqa: E402


def task_times(scratch: str) -> dict[int, list[int]]:
    import zstandard

    tasks: dict[int, list[int]] = {}
    for f in glob.glob(f"{scratch}/*/events_*"):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw),
                                                            read_across_frames=True) as r:
                raw = r.read()
        for line in raw.decode(errors="ignore").splitlines():
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if isinstance(e, dict) and e.get("Event") == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks.setdefault(e["Stage ID"], []).append(ti["Finish Time"] - ti["Launch Time"])
    return tasks


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="skew-", dir="/tmp")
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", scratch)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    tracks, awards = landed_tracks(spark, sf_dir), landed_awards(spark, sf_dir)
    hot = (tracks
           .withColumn("artists", F.when(F.col("_row_ord") % 3 == 0, F.lit("Hot Star"))
                       .otherwise(F.col("artists")))
           .withColumn("album_name", F.when(F.col("_row_ord") % 4 == 0, F.lit("Hot Album"))
                       .otherwise(F.col("album_name"))))
    bounds = []
    for label, src in (("as-is", tracks), ("one artist = 1/3 of rows", hot)):
        first_stage = max(task_times(scratch) or {-1: []}) + 1
        t0 = time.time()
        star = build_star(merged_from(src, awards))
        star.fact_track.write.format("noop").mode("overwrite").save()
        bounds.append((label, first_stage, round(time.time() - t0, 2)))
    spark.stop()
    tasks = task_times(scratch)
    for i, (label, lo, secs) in enumerate(bounds):
        hi = bounds[i + 1][1] if i + 1 < len(bounds) else max(tasks) + 1
        spread = [(max(v) / max(sum(v) / len(v), 1), sid) for sid, v in tasks.items()
                  if lo <= sid < hi and len(v) > 1]
        worst = max(spread) if spread else (1.0, None)
        print(f"{label}: {secs}s, worst task max/mean {worst[0]:.1f} (stage {worst[1]})")


if __name__ == "__main__":
    main()
