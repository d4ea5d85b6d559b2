"""CSV records in files that many tasks read: quoted newlines, source order, header names."""

from __future__ import annotations

import csv
import random
from contextlib import contextmanager

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from starloom.sources.files import read_awards_csv, read_csv_text, read_tracks
from starloom.sources.records import lines, numbered, quoted_records
from tests.test_sources_sinks import HEADER, TAIL

SCHEMA = StructType([StructField("a", StringType()), StructField("n", LongType()), StructField("b", StringType())])


@contextmanager
def split_size(spark, size):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], size)
    spark.conf.set(names[1], "1")
    try:
        yield
    finally:
        for n, o in zip(names, old, strict=True):
            spark.conf.set(n, o)


def _write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(["a", "n", "b"])
        out.writerows(rows)


def _rows(seed, count):
    rng = random.Random(seed)
    return [("".join(rng.choices('ab,"\n é', k=rng.choice([1, 3, 8, 30, 400]))) + "x", i,
             "".join(rng.choices('c\n"', k=rng.randint(1, 4))) + ".") for i in range(count)]


@pytest.mark.parametrize("size,end", [("16m", "\n"), ("700", "\n"), ("300", "\n"), ("700", "\r\n")])
def test_quoted_newlines_equal_a_plain_reader(spark, tmp_dir, size, end):
    parts = [_rows(k, 40) for k in range(2)]
    for k, rows in enumerate(parts):
        _write(f"{tmp_dir}/p{k}.csv", rows, end)
    with split_size(spark, size):
        df = read_csv_text(spark, tmp_dir, SCHEMA)
        got = sorted(tuple(r) for r in df.collect())
        assert got == [(i, *r) for i, r in enumerate(r for rows in parts for r in rows)]
        if size == "300":
            assert lines(spark, tmp_dir).select("_file", "_split").distinct().count() > 20


def test_one_value_over_many_splits(spark, tmp_dir):
    rows = [("begin", 1, "b"), ("line\n" * 400 + '"end"', 2, "b"), ("after", 3, "b")]
    _write(f"{tmp_dir}/one.csv", rows)
    with split_size(spark, "64"):
        assert sorted(tuple(r) for r in read_csv_text(spark, f"{tmp_dir}/one.csv", SCHEMA).collect()) == [
            (i, *r) for i, r in enumerate(rows)]


def test_values_that_are_not_closed_fail(spark, tmp_dir):
    with open(f"{tmp_dir}/bad.csv", "w") as f:
        f.write('a,n,b\nx,1,"y\nz,2,w\n')
    with pytest.raises(ValueError, match="not closed"):
        quoted_records(spark, f"{tmp_dir}/bad.csv")


def test_blank_and_empty_values(spark, tmp_dir):
    with open(f"{tmp_dir}/e.csv", "w") as f:
        f.write('a,n,b\n"",1,\n\n ,2,"x"\n')
    got = sorted(tuple(r)[1:] for r in read_csv_text(spark, f"{tmp_dir}/e.csv", SCHEMA).collect())
    assert got == [("", 1, None), (" ", 2, "x")]


@pytest.mark.parametrize("size", ["16m", "3k", "500"])
def test_source_order_without_an_index(spark, tmp_dir, size):
    """The same numbers for any split sizes; album keys follow them."""
    k = 0
    for part, n in enumerate((40, 1, 7, 90)):
        with open(f"{tmp_dir}/t{part}.csv", "w") as f:
            f.write(HEADER[1:])
            for _ in range(n):
                f.write(f"id{k},A,Al{k},S," + TAIL)
                k += 1
    with split_size(spark, size):
        got = {r.track_id: r["_row_ord"] for r in read_tracks(spark, tmp_dir).collect()}
    assert got == {f"id{i}": i for i in range(138)}


def test_parquet_source_order(spark, tmp_dir):
    spark.range(1000).selectExpr("id", "id as track_id").repartitionByRange(7, "id").sortWithinPartitions(
        "id").write.parquet(f"{tmp_dir}/p")
    for size in ("16m", "1k"):
        with split_size(spark, size):
            df = read_tracks(spark, f"{tmp_dir}/p", fmt="parquet")
            assert all(r["_row_ord"] == r["id"] for r in df.collect()) and df.count() == 1000
    empty = spark.range(0)
    empty.write.parquet(f"{tmp_dir}/none")
    assert read_tracks(spark, f"{tmp_dir}/none", fmt="parquet").count() == 0


def test_numbers_count_no_headers(spark, tmp_dir):
    for k in range(2):
        with open(f"{tmp_dir}/f{k}.txt", "w") as f:
            f.write("head\n" + "".join(f"{k}{i}\n" for i in range(3)))
    got = numbered(lines(spark, tmp_dir), headers=1).where("_in_file > 0").orderBy("_row_ord").collect()
    assert [(r["_row_ord"], r["value"]) for r in got] == list(enumerate(["00", "01", "02", "10", "11", "12"]))


AWARDS_HEADER = "year,title,published_at,updated_at,category,nominee,artist,workers,img,winner"


def test_columns_are_found_by_name(spark, tmp_dir):
    names = AWARDS_HEADER.split(",")
    row = dict(zip(names, ["2019", "t", "p", "u", "c", "nom", "art", "w", "i", "True"], strict=True))
    for order in (names, names[::-1]):
        for multi in (False, True):
            path = f"{tmp_dir}/{order[0]}{multi}.csv"
            with open(path, "w") as f:
                f.write(",".join(order) + "\n" + ",".join(row[n] for n in order) + "\n")
            got = read_awards_csv(spark, path, multi_line=multi).first()
            assert (got.year, got.nominee, got.artist) == (2019, "nom", "art")


@pytest.mark.parametrize("header", [AWARDS_HEADER.replace("nominee", "nominees"), AWARDS_HEADER.replace(",img", ""),
                                    AWARDS_HEADER + ",extra", AWARDS_HEADER + ",year"])
def test_missing_unknown_and_repeated_names_fail(spark, tmp_dir, header):
    with open(f"{tmp_dir}/x.csv", "w") as f:
        f.write(header + "\n" + ",".join("1" for _ in header.split(",")) + "\n")
    with pytest.raises(ValueError, match="header"):
        read_awards_csv(spark, f"{tmp_dir}/x.csv")


@pytest.mark.parametrize("multi", [False, True])
def test_files_with_different_headers_fail(spark, tmp_dir, multi):
    names = AWARDS_HEADER.split(",")
    for k, order in enumerate((names, [*names[:4], names[5], names[4], *names[6:]])):
        with open(f"{tmp_dir}/h{k}.csv", "w") as f:
            f.write(",".join(order) + "\n" + ",".join("1" for _ in names) + "\n")
    with pytest.raises(Exception, match="header"):
        read_awards_csv(spark, tmp_dir, multi_line=multi).collect()


def test_index_column_with_other_columns_swapped(spark, tmp_dir):
    names = HEADER.strip().split(",")
    values = ("7,id0,A,Al,S," + TAIL.strip()).split(",")
    order = [0, *range(len(names) - 1, 0, -1)]
    for head in ("", "Unnamed: 0"):
        with open(f"{tmp_dir}/s.csv", "w", encoding="utf-8-sig") as f:
            f.write(",".join(head if i == 0 else names[i] for i in order) + "\n")
            f.write(",".join(values[i] for i in order) + "\n")
        for multi in (False, True):
            r = read_tracks(spark, f"{tmp_dir}/s.csv", multi_line=multi).first()
            assert (int(r["_row_ord"]), r.track_id, r.track_genre, r.tempo) == (7, "id0", "pop", 120.0)
