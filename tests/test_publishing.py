"""Publishing between publishers, retention, catalog views, one-file export, resuming, clean-up."""

from __future__ import annotations

import csv
import os
import threading

import pytest
from pyspark.sql import functions as F

from starloom import storage
from starloom.operators.validate import ContractViolation
from starloom.plans import pipeline
from starloom.plans.resume import fingerprint
from starloom.session import ensure_checkpoint_dir, materialize, payload_expr, stage_all, temporary_stages
from starloom.sinks import warehouse as W
from starloom.sinks.files import export_one_csv
from starloom.sources.fixtures import raw_awards, raw_tracks
from tests.test_validate_publish import clean_toy

SF = "/root/testdata/sf0.001"


def test_create_if_absent_has_one_winner(spark, tmp_dir):
    start, wins = threading.Barrier(8), []

    def go(k):
        start.wait()
        if storage.create_if_absent(spark, f"{tmp_dir}/c/one.json", str(k)):
            wins.append(k)

    threads = [threading.Thread(target=go, args=(k,)) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(wins) == 1 and storage.read_text(spark, f"{tmp_dir}/c/one.json") == str(wins[0])


def _race(spark, target, on_conflict):
    star, start, out = clean_toy(spark), threading.Barrier(2), []
    written = W.write_version

    def slow(*args):
        sizes = written(*args)
        start.wait()  # both have written before either commits
        return sizes

    def go():
        try:
            out.append(W.publish(star, target, on_conflict=on_conflict))
        except W.PublishConflict as exc:
            out.append(exc)

    W.write_version = slow
    try:
        threads = [threading.Thread(target=go) for _ in range(2)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
    finally:
        W.write_version = written
    return out


def test_racing_publishers_lose_no_version(spark, tmp_dir):
    target = f"{tmp_dir}/retry"
    out = _race(spark, target, "retry")
    commits = {r["number"]: r["version"] for r in W.committed_versions(spark, target).collect()}
    assert sorted(commits) == [1, 2] and set(commits.values()) == set(out)
    assert W.current_version(spark, target) == commits[2]
    for v in out:
        assert W.read_published(spark, target, v).fact_track.count() > 0


def test_racing_publishers_one_winner(spark, tmp_dir):
    target = f"{tmp_dir}/fail"
    out = _race(spark, target, "fail")
    lost = [x for x in out if isinstance(x, W.PublishConflict)]
    assert len(lost) == 1 and W.current_version(spark, target) in out


def test_retain_keeps_the_newest(spark, tmp_dir):
    target, star = f"{tmp_dir}/wh", clean_toy(spark)
    versions = [W.publish(star, target) for _ in range(3)]
    W.write_version(star, target, "0000000000001-dead")   # never committed, long ago
    W.write_version(star, target, W.new_version())         # may still be written
    assert sorted(W.retain(spark, target, keep=2)) == ["0000000000001-dead", versions[0]]
    assert W.current_version(spark, target) == versions[2]
    assert W.read_published(spark, target, versions[1]).dim_genre.count() == star.dim_genre.count()
    assert W.retain(spark, target, keep=2) == [] and W.publish(star, target) > versions[2]
    with pytest.raises(ValueError):
        W.retain(spark, target, keep=0)


def test_views_follow_the_committed_version(spark, tmp_dir):
    target, star = f"{tmp_dir}/wh", clean_toy(spark)
    with pytest.raises(FileNotFoundError):
        W.publish_views(spark, "starloom_views_test", target)
    W.publish(star, target)
    W.publish_views(spark, "starloom_views_test", target)
    before = spark.table("starloom_views_test.dim_genre").count()
    W.publish(star.map(lambda n, df: df.limit(0) if n == "dim_genre" else df), target, enforce=False)
    assert spark.table("starloom_views_test.dim_genre").count() == before
    W.publish_views(spark, "starloom_views_test", target)
    assert spark.table("starloom_views_test.dim_genre").count() == 0
    assert spark.table("starloom_views_test.fact_track").schema.simpleString() == star.fact_track.schema.simpleString()


def test_one_csv_file(spark, tmp_dir):
    df = spark.range(500).selectExpr("499 - id AS k", "concat('a,\"', id, '\n') AS s", "id % 7 AS m").repartition(9)
    path = f"{tmp_dir}/out/merged.csv"
    for _ in range(2):  # replaced whole
        export_one_csv(df, path, order_by="k")
        with open(path, newline="") as f:
            rows = list(csv.reader(f))
        assert rows[0] == ["s", "m"] and rows[1:] == [[f'a,"{499 - k}\n', str((499 - k) % 7)] for k in range(500)]
    bad = df.withColumn("m", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        export_one_csv(bad, path)
    with open(path, newline="") as f:
        assert len(list(csv.reader(f))) == 501  # a failed export leaves the old file
    assert os.listdir(f"{tmp_dir}/out") == ["merged.csv"] or all(
        n.startswith(".") or n == "merged.csv" for n in os.listdir(f"{tmp_dir}/out"))
    export_one_csv(df.limit(0), path)
    with open(path) as f:
        assert f.read() == "k,s,m\n"


def test_failed_run_resumes_and_leaves_nothing(spark, tmp_dir, monkeypatch):
    work, target = f"{tmp_dir}/work", f"{tmp_dir}/wh"
    stages = f"{ensure_checkpoint_dir(spark)}/starloom"
    tracks, awards = raw_tracks(spark, SF), raw_awards(spark, SF)
    before = set(n for n, *_ in storage.listing(spark, stages))
    with pytest.raises(ContractViolation):
        pipeline.run(tracks, awards, target, work=work)
    assert any(n == "merged.json" for n, *_ in storage.listing(spark, work))
    monkeypatch.setattr(pipeline, "enrich", lambda *a: pytest.fail("merged anew"))
    counts = pipeline.run(tracks, awards, target, work=work, enforce=False)
    assert counts["raw_tracks"] == tracks.count() and counts["fact_track"] == counts["merged"]
    assert not storage.exists(spark, work)
    assert set(n for n, *_ in storage.listing(spark, stages)) == before


def test_changed_inputs_are_not_resumed(spark, tmp_dir):
    spark.range(3).write.parquet(f"{tmp_dir}/in")
    a = fingerprint(spark.read.parquet(f"{tmp_dir}/in"))
    assert a == fingerprint(spark.read.parquet(f"{tmp_dir}/in"))
    spark.range(3).write.mode("append").parquet(f"{tmp_dir}/in")
    assert a != fingerprint(spark.read.parquet(f"{tmp_dir}/in"))


def test_temporary_stages_are_removed_also_from_threads(spark):
    with temporary_stages(spark) as made:
        a = materialize(spark.range(5), "kept", keep=True)
        stage_all({"x": lambda: spark.range(3), "y": lambda: spark.range(4)})
        assert len(made) == 2 and all(storage.exists(spark, p) for p in made)
    assert not any(storage.exists(spark, p) for p in made) and a.count() == 5
    with pytest.raises(RuntimeError), temporary_stages(spark) as made:
        materialize(spark.range(5))
        raise RuntimeError
    assert made and not storage.exists(spark, made[0])


def test_payload_counts_nested_values(spark):
    df = spark.sql("SELECT array(1L, 2L, 3L) AS a, array('xy', 'z') AS s, map('k', array(1D)) AS m, "
                   "named_struct('t', 'abc', 'n', 1) AS st, CAST(NULL AS array<string>) AS no, 'text' AS t")
    assert df.select(payload_expr(df).alias("b")).first()["b"] >= 24 + 3 + 9 + 4 + 4
    wide = spark.range(10).selectExpr("transform(sequence(1, 64), x -> CAST(x AS DOUBLE)) AS v")
    assert wide.select(payload_expr(wide).alias("b")).first()["b"] >= 512


def test_run_resumes_after_the_written_version(spark, tmp_dir, monkeypatch):
    work, target = f"{tmp_dir}/work", f"{tmp_dir}/wh"
    tracks, awards = raw_tracks(spark, SF), raw_awards(spark, SF)

    def fails(to):
        with pytest.raises(ContractViolation):
            pipeline.run(tracks, awards, to, work=work)
        return {n for n, *_ in storage.listing(spark, to) if n.startswith("v=")}

    built, real = [], pipeline.build_star
    monkeypatch.setattr(pipeline, "build_star", lambda *a, **k: built.append(1) or real(*a, **k))
    first = fails(target)
    assert len(first) == 1 and fails(target) == first and len(built) == 1  # checked anew, not written anew
    assert W.current_version(spark, target) is None
    (version,) = first
    storage.remove(spark, f"{target}/{version}/dim_year")  # no longer whole
    both = fails(target)
    assert len(both) == 2 and len(built) == 2
    other = fails(f"{tmp_dir}/other")  # another target has nothing written
    assert len(other) == 1 and len(built) == 3
    counts = pipeline.run(tracks, awards, f"{tmp_dir}/other", work=work, enforce=False)
    assert f"v={counts['version']}" in other and len(built) == 3
    published = W.read_published(spark, f"{tmp_dir}/other")
    assert {n: df.count() for n, df in published.tables().items()} == {n: counts[n] for n in published.tables()}
    assert not storage.exists(spark, work)


def test_one_csv_parts_are_packed_and_go_as_they_are_joined(spark, tmp_dir, monkeypatch):
    df = spark.range(5000).selectExpr("id AS k", "concat('name of ', id % 50) AS s").repartition(5)
    packed, left, real, remove = [], [], storage.join_files, storage.remove

    def joined(session, parts, target, **how):
        packed.append(sum(storage.status(session, p)[0] for p in parts))
        real(session, parts, target, **how)
        left.append([p for p in parts if storage.exists(session, p)])

    monkeypatch.setattr(storage, "join_files", joined)
    export_one_csv(df, f"{tmp_dir}/one.csv", order_by="k")
    text = "s\n" + "".join(f"name of {k % 50}\n" for k in range(5000))
    with open(f"{tmp_dir}/one.csv") as f:
        assert f.read() == text
    assert left == [[]] and packed[0] < len(text) / 2
    # A join that fails half way leaves the old file and no part.
    stages = f"{ensure_checkpoint_dir(spark)}/starloom"
    before = [n for n, *_ in storage.listing(spark, stages)]

    def fails(session, path):
        if path.endswith(".lz4"):
            raise RuntimeError("no removal")
        return remove(session, path)

    monkeypatch.setattr(storage, "remove", fails)
    with pytest.raises(RuntimeError, match="no removal"):
        export_one_csv(df.where("k > 9"), f"{tmp_dir}/one.csv", order_by="k")
    with open(f"{tmp_dir}/one.csv") as f:
        assert f.read() == text
    assert [n for n, *_ in storage.listing(spark, stages)] == before


def test_run_exports_after_the_star_build_is_removed(spark, tmp_dir, monkeypatch):
    from starloom.sinks import files
    stages = f"{ensure_checkpoint_dir(spark)}/starloom"
    left, real = [], files.export_csv
    monkeypatch.setattr(files, "export_csv", lambda *a: left.extend(storage.listing(spark, stages)) or real(*a))
    tracks, awards = raw_tracks(spark, SF), raw_awards(spark, SF)
    before = {n for n, *_ in storage.listing(spark, stages)}
    counts = pipeline.run(tracks, awards, f"{tmp_dir}/wh", csv_out=f"{tmp_dir}/csv", enforce=False)
    names = {n.rsplit("-", 1)[0] for n, *_ in left if n not in before}
    assert left and not names & {"dim-album", "dim-artist", "key-map", "album-first", "keys-album_key"}
    assert counts["fact_track"] == counts["merged"] == spark.read.option("header", "true").csv(f"{tmp_dir}/csv").count()
