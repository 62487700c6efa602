"""Restartable stages (S7): written tables that a rerun takes up where the job before it ended.

A stage is a Parquet folder and a manifest, a small JSON file beside it.  The folder has a
fresh name each time; the manifest is written under another name and moved into place after
the data are complete, so a stage is there with all its rows or not at all.  It names the
data and holds a fingerprint of what the stage was made from: its name and version, the
fingerprints of the stages before it, and length and modification time of every input file.
A rerun after a lost driver reads each stage whose fingerprint still holds and builds the
first missing one; a changed input or version makes its stage, and all that follow, anew.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession


class Stages:
    """Stages of one job under ``root``; ``version`` names the code that makes them."""

    def __init__(self, spark: SparkSession, root: str, version: str = "1"):
        self.spark, self.root, self.version = spark, root.rstrip("/"), version
        self.built: list[str] = []      # stages made by this run
        self.reused: list[str] = []     # stages found complete
        self.prints: dict[str, str] = {}
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def source(self, name: str, path: str) -> None:
        """Register input files under a name: their lengths and times make its fingerprint."""
        found, files = self._fs_of(path), []
        if found.exists(self._path(path)):
            listed = found.listFiles(self._path(path), True)
            while listed.hasNext():
                f = listed.next()
                files.append([f.getPath().toString(), f.getLen(), f.getModificationTime()])
        self.prints[name] = _digest([name, sorted(files)])

    def stage(self, name: str, inputs: Sequence[str], build: Callable[[], DataFrame]) -> DataFrame:
        """The stage's table, read if complete and else built, written and read back."""
        data = self._ready(name, inputs)
        if data is None:
            data = f"{self.root}/{name}-{uuid.uuid4().hex}"
            build().write.parquet(data)
            self._commit(name, data)
        return self.spark.read.parquet(data)

    def effect(self, name: str, inputs: Sequence[str], target: str, run: Callable[[], None]) -> str:
        """A step that writes ``target`` itself; it runs again unless it ended and the target is there."""
        data = self._ready(name, inputs)
        if data is None:
            run()
            self._commit(name, target)
        return target

    def clear(self) -> None:
        self._fs.delete(self._path(self.root), True)

    def _fs_of(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _ready(self, name: str, inputs: Sequence[str]) -> str | None:
        self.prints[name] = _digest([name, self.version, [self.prints[i] for i in inputs]])
        at = self._path(f"{self.root}/{name}.json")
        if self._fs.exists(at):
            stream = self._fs.open(at)
            try:
                found = json.loads(bytes(stream.readAllBytes()).decode())
            finally:
                stream.close()
            if found["fingerprint"] == self.prints[name] and self._fs_of(found["data"]).exists(self._path(found["data"])):
                self.reused.append(name)
                return found["data"]
            if found["data"].startswith(f"{self.root}/"):
                self._fs.delete(self._path(found["data"]), True)
            self._fs.delete(at, False)
        return None

    def _commit(self, name: str, data: str) -> None:
        text = json.dumps({"stage": name, "fingerprint": self.prints[name], "data": data})
        draft, at = self._path(f"{self.root}/.{name}-{uuid.uuid4().hex}"), self._path(f"{self.root}/{name}.json")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self._fs.rename(draft, at):
            raise OSError(f"the manifest of stage {name} could not be moved into place")
        self.built.append(name)


def _digest(parts: object) -> str:
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()
