"""File sources: the track CSV, the awards CSV landing load, parquet stages."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, IntegralType, LongType, StringType, StructField, StructType

from starloom import storage
from starloom.functions.text import NA_TOKENS, na_tokens_to_null, string_columns
from starloom.schemas import AWARDS, ROW_ORD, TRACKS_CSV
from starloom.sources.records import lines, numbered, placed, quoted_records

# Header names under which an exported row-number column shows up.
INDEX_HEADERS = ("_c0", "Unnamed: 0", "")

# RFC-4180 style: doubled quotes inside quoted fields. A record with another number of
# fields than the header fails the read.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "FAILFAST"}


def _header(spark: SparkSession, path: str) -> list[str]:
    """The names in the first record of the source's first file."""
    scan = spark.read.option("lineSep", "\n").text(path)
    files = scan.inputFiles()
    line = spark.read.option("lineSep", "\n").text(min(files)).first() if files else None
    if line is None:
        raise ValueError(f"{path}: no header")
    return next(csv.reader([line["value"].rstrip("\r").lstrip("\ufeff")]))


def _by_name(path: str, names: list[str], wanted: list[str]) -> str | None:
    """Checks a header against the wanted names, in any order; returns the index column's
    name if there is one."""
    index = next((n for n in names[:1] if n in INDEX_HEADERS and n not in wanted), None)
    rest = names[1:] if index is not None else names
    missing, unknown = [n for n in wanted if n not in rest], [n for n in rest if n not in wanted]
    if missing or unknown or len(set(rest)) < len(rest):
        raise ValueError(f"{path}: header {names} lacks {missing}, has unknown or repeated columns "
                         f"{unknown or sorted({n for n in rest if rest.count(n) > 1})}")
    return index


def _read_text(spark: SparkSession, path: str, wanted: StructType, multi_line: bool,
               order: bool, quoted_blanks: bool = False) -> tuple[DataFrame, bool]:
    """All wanted fields as text, picked by header name, and with ``order`` the source order
    ``_row_ord`` (from the index column if the file has one). Every file must have the same header."""
    names = _header(spark, path)
    index = _by_name(path, names, wanted.fieldNames())
    fields = [f"f{i}" for i in range(len(names))]
    text = ", ".join(f"{f} string" for f in fields)
    # Nothing between two commas is null; with ``quoted_blanks`` two quotes are an empty text.
    blanks = {"nullValue": "\0"} if quoted_blanks else {}
    options = {**CSV_OPTIONS, **blanks, "header": "false", "multiLine": "true"}
    if multi_line or (order and index is None):
        records = (quoted_records(spark, path) if multi_line else numbered(lines(spark, path), headers=1))
        value = F.regexp_replace("value", "\r$", "")
        row, head = (F.from_csv(v, text, options) for v in (value, F.regexp_replace(value, "^\ufeff", "")))
        same = F.lit(True)
        for i, n in enumerate(names):
            same = same & F.coalesce(head[f"f{i}"], F.lit("")).eqNullSafe(n)
        wrong = F.raise_error(F.concat(F.lit(f"{path}: another header in one of its files: "), value)).cast("boolean")
        df = (records.where(F.when(F.col("_in_file") > 0, value != "").otherwise(F.when(same, False).otherwise(wrong)))
              .select(F.col("_row_ord").alias("_source"), row.alias("r")).select("_source", "r.*"))
    else:
        # Each file's header is compared with these names.
        shown = StructType([StructField(n, StringType(), True) for n in names])
        df = (spark.read.schema(shown).options(**CSV_OPTIONS, **blanks).option("enforceSchema", "false").csv(path)
              .toDF(*fields).withColumn("_source", F.lit(None).cast("long")))
    picked = [F.col(f"f{names.index(f.name)}").alias(f.name) for f in wanted.fields]
    key = [(F.col("f0") if index is not None else F.col("_source")).alias(ROW_ORD)] if order else []
    return df.select(*key, *picked), index is not None


def typed(column: str, kind: DataType) -> Column:
    """Text as ``kind``; null stays null, a value that cannot be read fails the job with its
    column and text. Whole numbers may be written with a decimal point (``50.0``)."""
    name = kind.simpleString()
    text = F.trim(F.col(f"`{column}`"))
    if isinstance(kind, StringType):
        return F.col(f"`{column}`")
    if isinstance(kind, BooleanType):
        value = F.when(F.lower(text) == "true", True).when(F.lower(text) == "false", False)
    else:
        value = text.try_cast(name)

    def rare(t: Column) -> Column:
        wrong = F.raise_error(F.concat(F.lit(f"column {column}: cannot read as {name}: "), t)).cast(kind)
        if not isinstance(kind, IntegralType):
            return wrong
        return F.coalesce(F.regexp_replace(t, r"^([+-]?[0-9]+)[.]0*$", "$1").try_cast(name), wrong)

    # What cannot be read at once is looked at by a lambda: its code stays out of the loop that Spark
    # generates for a row, which with it for every column is too long for the JVM to compile.
    return F.coalesce(value, F.when(text.isNotNull(), F.transform(F.array(text), rare)[0]))


def read_tracks(spark: SparkSession, path: str, fmt: str = "csv",
                na_tokens=NA_TOKENS, multi_line: bool = False) -> DataFrame:
    """Track-grain source with ``_row_ord``.

    CSV columns are found by their header names, in any order; a missing or unknown name fails.
    The exported index column (blank header: ``_c0`` in Spark, ``Unnamed: 0`` in pandas) *is* the
    original row number, so it becomes ``_row_ord`` instead of being thrown away. Without one,
    rows are numbered in the order of file names and lines, whatever the partitioning.
    CSV missing-value tokens (``NA``, ``None``, ``NaN``, ...) become NULL in every column;
    other values are read strictly (:func:`typed`).
    ``multi_line`` keeps quoted newlines intact, also in files that many tasks read; without it
    a record broken by a newline fails the read.
    """
    if fmt == "parquet":
        df = spark.read.parquet(path)
        if ROW_ORD not in df.columns:
            idx = next((c for c in df.columns if c in INDEX_HEADERS), None)
            df = df.withColumnRenamed(idx, ROW_ORD) if idx else numbered(placed(df)).drop("_in_file")
        return df

    wanted = StructType(TRACKS_CSV.fields[1:])
    df, has_index = _read_text(spark, path, wanted, multi_line, order=True)
    if na_tokens:
        df = na_tokens_to_null(df, na_tokens)
    key = typed(ROW_ORD, TRACKS_CSV.fields[0].dataType).alias(ROW_ORD) if has_index else F.col(ROW_ORD)
    return df.select(key, *[typed(f.name, f.dataType).alias(f.name) for f in wanted.fields])


def read_awards_csv(spark: SparkSession, path: str, landing_blanks: bool = True,
                    multi_line: bool = False) -> DataFrame:
    """Bulk load of the awards CSV into the landing layout (``,``, optional ``"`` quoting, columns
    by header name, strict like :func:`read_tracks`).

    A database bulk loader stores blank text fields as ``''``; Spark's CSV
    reader yields NULL for them, so ``landing_blanks`` restores ``''`` on
    the text columns. The cleaning step turns them back into NULL either way.
    """
    df, _ = _read_text(spark, path, AWARDS, multi_line, order=False)
    df = df.select(*[typed(f.name, f.dataType).alias(f.name) for f in AWARDS.fields])
    if landing_blanks:
        df = df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in string_columns(df)})
    return df


def read_csv_text(spark: SparkSession, path: str, schema: StructType, multi_line: bool = True) -> DataFrame:
    """Any CSV with ``_row_ord``: fields by header name, typed strictly by ``schema``; a value of two
    quotes is an empty text, nothing at all is null."""
    df, has_index = _read_text(spark, path, schema, multi_line, order=True, quoted_blanks=True)
    key = typed(ROW_ORD, LongType()).alias(ROW_ORD) if has_index else F.col(ROW_ORD)
    return df.select(key, *[typed(f.name, f.dataType).alias(f.name) for f in schema.fields])


def create_landing_table(spark: SparkSession, name: str, location: str) -> None:
    """Re-runnable landing table DDL (``CREATE TABLE IF NOT EXISTS``)."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in AWARDS.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet LOCATION '{location}'")


def write_stage(df: DataFrame, path: str) -> None:
    """Type-preserving stage write between pipeline steps (parquet)."""
    df.write.mode("overwrite").parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
