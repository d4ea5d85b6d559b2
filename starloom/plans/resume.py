"""Resuming a job: finished steps are found again by a fingerprint of their inputs.

A run's folder holds one manifest for each finished step, ``<step>.json``, with the fingerprint
of the run's inputs, the folder of the step's table and what was counted. A step whose manifest
has the same fingerprint is read back; any other is done anew. Manifests are created only after
their table is complete, so an interrupted step leaves none. A step whose outcome lies elsewhere
(a written warehouse version) has a manifest with its notes alone. ``finish`` removes the folder.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom import storage
from starloom.session import Staged, stage


def fingerprint(*inputs: DataFrame, options: str = "") -> str:
    """What the inputs are made of: their files with size and time of change, their plans' schemas
    and the options."""
    h = hashlib.sha256(options.encode())
    for df in inputs:
        h.update(df.schema.json().encode())
        for f in sorted(df.inputFiles()):
            h.update(f"{f} {storage.status(df.sparkSession, f)}".encode())
    return h.hexdigest()


class Run:
    """The steps of one job under a folder of its own."""

    def __init__(self, spark: SparkSession, folder: str, print_: str):
        self.spark, self.folder, self.print = spark, folder.rstrip("/"), print_
        self.reused: list[str] = []

    def step(self, name: str, build: Callable[[], tuple[DataFrame, Callable[[], dict]]]) -> tuple[Staged, dict]:
        """The step's table and notes. ``build`` returns the table's DataFrame and a function
        that gives the notes once the table is written."""
        manifest = f"{self.folder}/{name}.json"
        if storage.exists(self.spark, manifest):
            m = json.loads(storage.read_text(self.spark, manifest))
            if m["fingerprint"] == self.print and storage.exists(self.spark, f"{m['path']}/_SUCCESS"):
                self.reused.append(name)
                return Staged(self.spark.read.parquet(m["path"]), m["rows"], m["bytes"]), m["notes"]
            storage.remove(self.spark, manifest)
        df, notes = build()
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        done = stage(df, name, path=path, keep=True)
        m = {"fingerprint": self.print, "path": path, "rows": done.rows, "bytes": done.bytes, "notes": notes()}
        storage.create_if_absent(self.spark, manifest, json.dumps(m))
        return done, m["notes"]

    def noted(self, name: str, build: Callable[[], dict], holds: Callable[[dict], bool]) -> dict:
        """The notes of a step whose outcome lies outside the folder; done anew unless what they
        name still ``holds``."""
        manifest = f"{self.folder}/{name}.json"
        if storage.exists(self.spark, manifest):
            m = json.loads(storage.read_text(self.spark, manifest))
            if m["fingerprint"] == self.print and holds(m["notes"]):
                self.reused.append(name)
                return m["notes"]
            storage.remove(self.spark, manifest)
        m = {"fingerprint": self.print, "notes": build()}
        storage.create_if_absent(self.spark, manifest, json.dumps(m))
        return m["notes"]

    def finish(self) -> None:
        storage.remove(self.spark, self.folder)
