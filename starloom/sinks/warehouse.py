"""Publishing the star: all-or-nothing, re-runnable, validated, safe between publishers.

Parquet target layout::

    <target>/v=<version>/<table>/part-*.parquet   one folder per attempt
    <target>/_commits/<number>.json               one file per committed version

A publish writes every table of a new version (dims first, the fact sorted within partitions by
``artist_key`` so parquet min/max statistics prune artist lookups), validates the *written* copy,
and only then claims the next commit number by creating its file, which of several publishers
exactly one can do. Readers take the highest number, so a failed or interrupted publish
(including one rejected by the contract checks) leaves the previous version current, and a
rerun simply commits a new, identical version. A publisher that finds its number taken takes the
next one, or with ``on_conflict="fail"`` leaves the other's version current. Nothing is
overwritten in place; :func:`retain` removes versions that are no longer kept.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom import storage
from starloom.operators.star import Star
from starloom.operators.validate import enforce as enforce_contract
from starloom.schemas import TABLE_ORDER, WAREHOUSE
from starloom.session import freed_shuffles, payload_expr

COMMITS = "_commits"
FACT_SORT = "artist_key"


def new_version() -> str:
    """Sortable, collision-free version id (UTC milliseconds + random)."""
    return f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"


def write_version(star: Star, target: str, version: str) -> dict[str, tuple[int, int]]:
    """Write all five tables of one version (dims first, then the fact) and
    return each table's exact (rows, payload bytes), observed during the
    write itself."""
    sizes = {}
    for name in TABLE_ORDER:
        df = getattr(star, name)
        if name == "fact_track":
            df = df.sortWithinPartitions(FACT_SORT)
        obs = Observation(f"publish-{name}-{version}")
        measured = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.sum(payload_expr(df)).alias("bytes"))
        with freed_shuffles(df.sparkSession):
            measured.write.mode("error").option("compression", "zstd").parquet(f"{target}/v={version}/{name}")
        sizes[name] = (int(obs.get["rows"] or 0), int(obs.get["bytes"] or 0))
    return sizes


def read_version(spark: SparkSession, target: str, version: str,
                 sizes: dict[str, tuple[int, int]] | None = None) -> Star:
    return Star(**{name: spark.read.schema(WAREHOUSE[name]).parquet(
        f"{target}/v={version}/{name}") for name in TABLE_ORDER}, sizes=dict(sizes or {}))


COMMIT_SCHEMA = "number long, version string, committed_at_ms long, fact_rows long, sizes string"


class PublishConflict(RuntimeError):
    """Another publisher committed while this one was writing."""


def committed_versions(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(COMMIT_SCHEMA).json(f"{target}/{COMMITS}").where("version IS NOT NULL")


def _newest_commit(spark: SparkSession, target: str) -> int:
    """The highest commit number taken, 0 before the first."""
    names = [n for n, *_ in storage.listing(spark, f"{target}/{COMMITS}") if n.endswith(".json")]
    return max((int(n.split(".")[0]) for n in names), default=0)


def current_version(spark: SparkSession, target: str) -> str | None:
    """Newest committed version, or ``None`` before the first publish."""
    if not _newest_commit(spark, target):
        return None
    return committed_versions(spark, target).agg(F.max_by("version", "number").alias("v")).first()["v"]


def read_published(spark: SparkSession, target: str, version: str | None = None) -> Star:
    """The current (or a given) committed version of the warehouse, with the
    table sizes recorded at publish time (so broadcast decisions on it need
    no extra job)."""
    v = version or current_version(spark, target)
    if v is None:
        raise FileNotFoundError(f"nothing published under {target}")
    row = (committed_versions(spark, target).filter(F.col("version") == v)
           .select("sizes").first())
    sizes = {k: (int(a), int(b)) for k, (a, b) in json.loads(row["sizes"]).items()} \
        if row and row["sizes"] else {}
    return read_version(spark, target, v, sizes)


def publish(star: Star, target: str, enforce: bool = True, on_conflict: str = "retry") -> str:
    """Write, validate and commit one version; return its id.

    With ``enforce`` a contract violation raises before the commit, so the
    previous version stays current. Without it the version is committed
    and the caller can inspect ``validate.violations`` on it. ``on_conflict``: what happens if
    another publisher commits meanwhile, ``"retry"`` with the next number (the later commit is
    current, the other one stays readable) or ``"fail"`` with :class:`PublishConflict`.
    """
    if on_conflict not in ("retry", "fail"):
        raise ValueError(f"on_conflict: {on_conflict!r}")
    spark = star.fact_track.sparkSession
    number = _newest_commit(spark, target) + 1
    version = new_version()
    sizes = write_version(star, target, version)
    return publish_written(spark, target, version, sizes, enforce, on_conflict, number)


def publish_written(spark: SparkSession, target: str, version: str, sizes: dict[str, tuple[int, int]],
                    enforce: bool = True, on_conflict: str = "retry", number: int | None = None) -> str:
    """The rest of :func:`publish` for a version that :func:`write_version` has finished: validate
    the written copy and commit it. ``number``: the commit number that was free before it was
    written, by default the next one now."""
    if number is None:
        number = _newest_commit(spark, target) + 1
    if enforce:
        enforce_contract(read_version(spark, target, version, sizes))
    while not _commit(spark, target, number, version, sizes):
        if on_conflict == "fail":
            raise PublishConflict(f"commit {number} of {target} was taken while {version} was written")
        number = max(number, _newest_commit(spark, target)) + 1
    return version


def is_written(spark: SparkSession, target: str, version: str) -> bool:
    """Whether all tables of an attempt are there and complete."""
    return all(storage.exists(spark, f"{target}/v={version}/{name}/_SUCCESS") for name in TABLE_ORDER)


def _commit(spark: SparkSession, target: str, number: int, version: str, sizes: dict[str, tuple[int, int]]) -> bool:
    line = json.dumps({"number": number, "version": version, "committed_at_ms": int(time.time() * 1000),
                       "fact_rows": sizes["fact_track"][0], "sizes": json.dumps(sizes)})
    return storage.create_if_absent(spark, f"{target}/{COMMITS}/{number:010d}.json", line + "\n")


def retain(spark: SparkSession, target: str, keep: int = 2, grace_ms: int = 24 * 3600 * 1000) -> list[str]:
    """Remove the tables of all but the newest ``keep`` committed versions, and of attempts that
    were never committed and began more than ``grace_ms`` ago; returns what was removed. Commit
    files stay, so no number is used twice."""
    if keep < 1:
        raise ValueError("the current version is always kept")
    committed = [r["version"] for r in committed_versions(spark, target).orderBy(F.desc("number"))
                 .select("version").collect()] if _newest_commit(spark, target) else []
    removed = []
    for name, _, _, folder in storage.listing(spark, target):
        version = name.removeprefix("v=")
        if not folder or version == name or version in committed[:keep]:
            continue
        if version in committed or int(version.split("-")[0]) < time.time() * 1000 - grace_ms:
            storage.remove(spark, f"{target}/{name}")
            removed.append(version)
    return removed


def publish_views(spark: SparkSession, database: str, target: str, version: str | None = None) -> str:
    """Catalog views ``<database>.<table>`` over a committed version (the current one if none is
    named). Re-runnable after each publish: every view is replaced in one catalog step, and the
    files that running queries read stay until :func:`retain` removes them."""
    v = version or current_version(spark, target)
    if v is None:
        raise FileNotFoundError(f"nothing published under {target}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in TABLE_ORDER:
        columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                            for f in WAREHOUSE[name].fields)
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {columns} "
                  f"FROM parquet.`{target}/v={v}/{name}`")
    return v


def warehouse_ddl(database: str, location: str) -> list[str]:
    """Re-runnable DDL for the five tables (drops the fact first)."""
    stmts = [f"CREATE DATABASE IF NOT EXISTS {database}"]
    stmts += [f"DROP TABLE IF EXISTS {database}.{t}" for t in reversed(TABLE_ORDER)]
    for t in TABLE_ORDER:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()} NOT NULL"
                         for f in WAREHOUSE[t].fields)
        stmts.append(f"CREATE TABLE {database}.{t} ({cols}) USING parquet "
                     f"LOCATION '{location}/{t}'")
    return stmts


def create_warehouse(spark: SparkSession, database: str, location: str) -> None:
    for stmt in warehouse_ddl(database, location):
        spark.sql(stmt)
