"""CSV readers and writers on hand-made files."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from starloom.sinks.files import export_csv
from starloom.sinks.jdbc import jdbc_write_options, swap_statements
from starloom.sources.files import read_awards_csv, read_stage, read_tracks, write_stage
from starloom.sources.jdbc import jdbc_read_options

HEADER = (",track_id,artists,album_name,track_name,popularity,duration_ms,explicit,"
          "danceability,energy,key,loudness,mode,speechiness,acousticness,instrumentalness,"
          "liveness,valence,tempo,time_signature,track_genre\n")
TAIL = "50,200000,False,0.5,0.6,1,-5.0,1,0.05,0.1,0.0,0.1,0.4,120.0,4,pop\n"


def test_read_tracks_csv_quotes_newlines_tokens(spark, tmp_dir):
    path = f"{tmp_dir}/tracks.csv"
    with open(path, "w") as f:
        f.write(HEADER)
        f.write('0,id0,"Gen Hoshino;Foo","Album ""X"", deluxe","line one\nline two",' + TAIL)
        f.write("1,id1,NA,Album,Song," + TAIL)
        f.write("2,id2,None,Album,Song," + TAIL)
    df = read_tracks(spark, path, multi_line=True)
    rows = sorted(df.collect(), key=lambda r: r["_row_ord"])
    assert len(rows) == 3 and df.columns[0] == "_row_ord"
    assert rows[0].album_name == 'Album "X", deluxe'
    assert rows[0].track_name == "line one\nline two"
    assert rows[1].artists is None and rows[2].artists is None
    assert rows[0].explicit is False and rows[0].popularity == 50


def test_csv_values_are_read_strictly(spark, tmp_dir):
    good, bad, short = (f"{tmp_dir}/{n}.csv" for n in ("good", "bad", "short"))
    with open(good, "w") as f:
        f.write(HEADER + "0,id0,A,Al,S," + TAIL.replace("50,", "50.0,", 1))
        f.write("1,id1,A,Al,S," + TAIL.replace("0.5,0.6", "NaN,0.6"))
    rows = sorted(read_tracks(spark, good).collect(), key=lambda r: r["_row_ord"])
    assert rows[0].popularity == 50 and rows[1].danceability is None
    for path, line in ((bad, "0,id0,A,Al,S," + TAIL.replace("50,", "50.5,", 1)), (short, "0,id0,A,Al\n")):
        with open(path, "w") as f:
            f.write(HEADER + line)
        with pytest.raises(Exception, match="cannot read as int|MALFORMED|malformed"):
            read_tracks(spark, path).collect()


def test_one_big_csv_is_read_by_many_tasks(spark, tmp_dir):
    path = f"{tmp_dir}/big.csv"
    with open(path, "w") as f:
        f.write(HEADER)
        for i in range(30_000):
            f.write(f"{i},id{i},A,Al,S," + TAIL)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
        df = read_tracks(spark, path)
        assert df.select(F.spark_partition_id()).distinct().count() > 4 and df.count() == 30_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_read_tracks_csv_without_index(spark, tmp_dir):
    path = f"{tmp_dir}/noindex.csv"
    with open(path, "w") as f:
        f.write(HEADER[1:])
        f.write("id0,A,Al,S," + TAIL)
    df = read_tracks(spark, path)
    assert df.count() == 1 and "_row_ord" in df.columns and df.first().track_id == "id0"


def test_read_awards_csv_landing_blanks(spark, tmp_dir):
    path = f"{tmp_dir}/awards.csv"
    with open(path, "w") as f:
        f.write("year,title,published_at,updated_at,category,nominee,artist,workers,img,winner\n")
        f.write('2019,"62nd, Annual",2020-01-15,,Record,"Bad ""Guy""",,w,i,True\n')
    row = read_awards_csv(spark, path).first()
    assert row.year == 2019 and row.title == "62nd, Annual" and row.nominee == 'Bad "Guy"'
    assert row.artist == "" and row.updated_at == ""
    assert read_awards_csv(spark, path, landing_blanks=False).first().artist is None


def test_export_csv_and_stage_round_trip(spark, tmp_dir):
    df = spark.range(100).selectExpr("id", "concat('a,', cast(id as string)) as s")
    export_csv(df, f"{tmp_dir}/one")
    assert glob.glob(f"{tmp_dir}/one/part-*.csv")
    back = spark.read.option("header", True).csv(f"{tmp_dir}/one")
    assert back.count() == 100 and back.columns == ["id", "s"]
    write_stage(df, f"{tmp_dir}/stage")
    assert read_stage(spark, f"{tmp_dir}/stage").count() == 100


def test_jdbc_options_and_swap():
    r = jdbc_read_options("jdbc:x", "awards", lower_bound=1958, upper_bound=2020, num_partitions=4)
    assert r["partitionColumn"] == "year" and r["numPartitions"] == "4"
    w = jdbc_write_options("jdbc:x", "stg_fact_track", num_partitions=8)
    assert w["batchsize"] == "5000" and w["numPartitions"] == "8"
    stmts = swap_statements()
    assert stmts[1] == "DELETE FROM fact_track" and stmts[-2] == "INSERT INTO fact_track SELECT * FROM stg_fact_track"


def test_typed_columns_leave_the_generated_loop_short(spark, tmp_path):
    """A method over 8,000 bytes is never compiled by the JVM; rare values are still read or refused."""
    from starloom.schemas import TRACKS_CSV
    names = [f.name for f in TRACKS_CSV.fields[1:]]
    kinds = [f.dataType.simpleString() for f in TRACKS_CSV.fields[1:]]

    def written(folder, whole):
        values = [{"string": "x", "boolean": "True", "int": whole}.get(k, " 0.5") for k in kinds]
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a.csv").write_text(",".join(["", *names]) + "\n" + ",".join(["7", *values]) + "\n")
        return read_tracks(spark, str(tmp_path / folder))

    df = written("fits", "50.0")
    stages = df._jdf.queryExecution().debug().codegenToSeq()
    assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000
    assert df.select("popularity", "energy", "explicit").collect() == [(50, 0.5, True)]
    for wrong in ("50.7", "x"):
        with pytest.raises(Exception, match="column popularity: cannot read as int"):
            written(f"wrong{wrong}", wrong).collect()
