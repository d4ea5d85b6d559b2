"""JDBC sink for the warehouse.

Spark's JDBC writer commits per partition, so it cannot make five tables
appear at once by itself. The star is therefore written to ``stg_*`` tables
in parallel batched inserts, and the switch to the live tables is one
database transaction (:func:`swap_statements`: delete fact-first, insert
dims-first) executed by the database, as the reference load does in a
single transaction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from starloom.operators.star import Star
from starloom.schemas import TABLE_ORDER


def jdbc_write_options(url: str, table: str, *, batchsize: int = 5000,
                       num_partitions: int | None = None,
                       properties: dict[str, str] | None = None) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "batchsize": str(batchsize),
            "isolationLevel": "READ_COMMITTED", "truncate": "true"}
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    opts.update(properties or {})
    return opts


def write_table_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **kw) -> None:
    """Batched, parallel insert (``batchsize`` rows per statement batch,
    at most ``numPartitions`` concurrent connections)."""
    df.write.format("jdbc").options(**jdbc_write_options(url, table, **kw)).mode(mode).save()


def stage_star_jdbc(star: Star, url: str, prefix: str = "stg_", **kw) -> list[str]:
    """Write every table to ``<prefix><table>``; returns the staged names."""
    names = []
    for name in TABLE_ORDER:
        write_table_jdbc(getattr(star, name), url, f"{prefix}{name}", **kw)
        names.append(f"{prefix}{name}")
    return names


def swap_statements(prefix: str = "stg_") -> list[str]:
    """One transaction that replaces the live tables with the staged ones."""
    stmts = ["START TRANSACTION"]
    stmts += [f"DELETE FROM {t}" for t in reversed(TABLE_ORDER)]
    stmts += [f"INSERT INTO {t} SELECT * FROM {prefix}{t}" for t in TABLE_ORDER]
    stmts.append("COMMIT")
    return stmts
