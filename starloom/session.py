"""Session helpers: a tuned local session for tests/bench, and the shared
checkpoint folder used to cut lineage.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it. A private folder is chosen only when the
setting is absent *and* the master is local (tests, bench, smoke runs).
"""

from __future__ import annotations

import os
import shlex
import tempfile
import threading
import uuid
from collections.abc import Callable, Collection, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from dataclasses import dataclass

from pyspark import SparkConf, SparkContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

from starloom import storage

_CKPT_KEY = "spark.checkpoint.dir"
_FREE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "starloom") -> SparkSession:
    """Session used by tests and ``bench.py``. Cluster jobs bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STARLOOM_DRIVER_MEM", "12g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Staged tables are re-read by many jobs, also those that few tasks wrote.
        .config("spark.sql.files.maxPartitionBytes", "16m")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def platform_session(app: str = "starloom") -> SparkSession:
    """The platform's session: whatever master, memory and folders it was submitted with are
    kept. Only where no master is configured at all a tuned local session is made."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    # Before a JVM runs, its settings are not known here: it will take those of the submit.
    submitted = ("PYSPARK_GATEWAY_PORT" in os.environ
                 or any(w.partition("=")[0] in ("--master", "spark.master")
                        for w in shlex.split(os.environ.get("PYSPARK_SUBMIT_ARGS", ""))))
    if SparkContext._active_spark_context is None and not submitted and not SparkConf().contains("spark.master"):
        return local_session(app=app)
    spark = SparkSession.builder.appName(app).getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a private one only for
    local masters where the session does not name one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{_CKPT_KEY} is not set; a cluster run needs a shared folder "
                "(HDFS/object store) for checkpoints")
        configured = tempfile.mkdtemp(prefix="starloom-ckpt-", dir="/tmp")
        spark.conf.set(_CKPT_KEY, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/starloom/{name}-{uuid.uuid4().hex}"


def _payload(c: Column, kind: DataType) -> Column:
    """Data size of one value."""
    zero = F.lit(0).cast("long")
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("long")
    if isinstance(kind, StructType):
        return sum((_payload(c[f.name], f.dataType) for f in kind.fields), F.lit(8).cast("long"))
    if isinstance(kind, ArrayType):
        if isinstance(kind.elementType, (StringType, BinaryType, StructType, ArrayType, MapType)):
            inner = F.aggregate(c, zero, lambda total, x: total + F.lit(8) + _payload(x, kind.elementType))
        else:
            inner = F.greatest(F.size(c), F.lit(0)).cast("long") * 8
        return F.coalesce(inner, zero) + F.lit(8)
    if isinstance(kind, MapType):
        return (_payload(F.map_keys(c), ArrayType(kind.keyType))
                + _payload(F.map_values(c), ArrayType(kind.valueType)))
    return F.lit(8).cast("long")


def payload_expr(df: DataFrame) -> Column:
    """Per-row data size: byte lengths of strings and binaries, 8 bytes per other value, all
    elements of arrays, maps and structs included."""
    return sum((_payload(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(0).cast("long"))


@dataclass(frozen=True)
class Staged:
    """A table written to the checkpoint folder, with its exact row count and
    payload size collected while it was written (no extra job)."""
    df: DataFrame
    rows: int
    bytes: int


def stage(df: DataFrame, name: str = "stage", path: str | None = None, keep: bool = False) -> Staged:
    """Write ``df`` to the shared checkpoint folder and measure it on the way."""
    obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    measured = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                          F.sum(payload_expr(df)).alias("bytes"))
    out = materialize(measured, name, path, keep)
    m = obs.get
    return Staged(out, int(m.get("rows") or 0), int(m.get("bytes") or 0))


def stage_all(builders: dict[str, Callable[[], DataFrame]]) -> dict[str, Staged]:
    """Stage several independent tables concurrently (one Spark job each,
    submitted from driver threads), so small jobs share the cluster instead
    of queueing one after another."""
    if len(builders) == 1:
        (name, build), = builders.items()
        return {name: stage(build(), name)}
    with ThreadPoolExecutor(max_workers=len(builders)) as pool:
        # Each thread knows the caller's open :func:`temporary_stages`.
        futures = {name: pool.submit(copy_context().run, lambda n=name, b=build: stage(b(), n))
                   for name, build in builders.items()}
        return {name: f.result() for name, f in futures.items()}


_scope: ContextVar[list[str] | None] = ContextVar("starloom_stages", default=None)


@contextmanager
def temporary_stages(spark: SparkSession, kept: Collection[str] = ()) -> Iterator[list[str]]:
    """Removes the tables that are staged inside when it ends, also after a failure. What is
    taken off the list, or staged with ``keep``, stays. Tables staged under a name in ``kept`` go
    after a failure only; otherwise an enclosing scope has them."""
    made: list[str] = []
    token = _scope.set(made)
    done = False
    try:
        yield made
        done = True
    finally:
        _scope.reset(token)
        outer = _scope.get()
        for path in made:
            if not done or path.rsplit("/", 1)[-1].rsplit("-", 1)[0] not in kept:
                storage.remove(spark, path)
            elif outer is not None:
                outer.append(path)


_freeing: dict[int, int] = {}
_freeing_lock = threading.Lock()


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write inside go when the write ends. Otherwise they stay until the
    driver's garbage collector comes across the write's plan, so a job of many steps holds those
    of all its steps at once. A setting that the session brings is kept. Threads may be inside together."""
    with _freeing_lock:
        if id(spark) in _freeing:
            _freeing[id(spark)] += 1
        elif spark.conf.get(_FREE_KEY, None) is None:
            spark.conf.set(_FREE_KEY, "true")
            _freeing[id(spark)] = 1
        counted = id(spark) in _freeing
    try:
        yield
    finally:
        with _freeing_lock:
            if counted:
                _freeing[id(spark)] -= 1
                if not _freeing[id(spark)]:
                    del _freeing[id(spark)]
                    spark.conf.unset(_FREE_KEY)


def materialize(df: DataFrame, name: str = "stage", path: str | None = None, keep: bool = False) -> DataFrame:
    """Cut lineage by writing a parquet table into the shared checkpoint folder.

    Used where a result is read by several later jobs and must be identical
    for all of them (dense keys, the staged spine). Unlike a cache or a local
    checkpoint it survives executor loss, and unlike ``checkpoint()`` the
    columnar copy keeps column pruning and filter pushdown for its readers.
    """
    spark = df.sparkSession
    path = path or scratch(spark, name)
    made = _scope.get()
    if made is not None and not keep:
        made.append(path)
    with freed_shuffles(spark):
        df.write.mode("error").option("compression", "zstd").parquet(path)
    # Known schema: no footer sampling to infer it again.
    return spark.read.schema(df.schema).parquet(path)
