"""File sinks: CSV export of the merged table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starloom import storage
from starloom.session import freed_shuffles, scratch

_OPTIONS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def export_csv(df: DataFrame, path: str) -> None:
    """Write ``df`` as CSV part files with a header and no index, one per partition, replacing
    ``path``. Blanks at the ends of values are kept (Spark's writer trims them by default)."""
    with freed_shuffles(df.sparkSession):
        df.write.mode("overwrite").option("header", "true").options(**_OPTIONS).csv(path)


def export_one_csv(df: DataFrame, path: str, order_by: str | None = None) -> None:
    """Write ``df`` as one CSV file with one header, replacing ``path`` whole or not at all.

    All tasks write headerless parts; with ``order_by`` they hold ranges of that column (which
    is not written), so the file is in that order. The parts are then joined in the storage,
    by splicing blocks where it can and through a fixed buffer elsewhere, and renamed into place.
    Parts that are not spliced are written compressed and go one by one as they are joined.
    """
    spark = df.sparkSession
    parts = scratch(spark, "csv-parts")
    options = {**_OPTIONS, "header": "false", "compression": "none" if storage.may_splice(spark, path) else "lz4"}
    try:
        body = df.orderBy(order_by).drop(order_by) if order_by else df
        with freed_shuffles(spark):
            body.write.options(**options).csv(f"{parts}/body")
        names = spark.createDataFrame([tuple(body.columns)], ", ".join(f"c{i} string" for i in range(len(body.columns))))
        names.coalesce(1).write.options(**options).csv(f"{parts}/head")
        files = [f"{parts}/{folder}/{name}" for folder in ("head", "body")
                 for name, size, _, _ in storage.listing(spark, f"{parts}/{folder}")
                 if name.startswith("part-") and size]
        storage.join_files(spark, files, path, consume=True)
    finally:
        storage.remove(spark, parts)
