"""Publication of several outputs together (K3).

Outputs are written to a staging folder beside their places.  When all are
there, the old ones move aside, the new ones move in and a manifest names them;
if a move fails, those made are taken back.  A run that fails before leaves the
old outputs and the old manifest untouched.  Moves are renames of Hadoop's file
system, so no data is copied (object stores copy on rename).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from merchpulse.session import file_system

MANIFEST = "_MANIFEST.json"


def published(spark: SparkSession, root: str) -> dict | None:
    """The manifest of the last publication below ``root``: run, and for each
    output its files and bytes; null without one."""
    fs, to_path = file_system(spark, root)
    path = to_path(f"{root}/{MANIFEST}")
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


class Publication:
    """``with Publication(spark, root) as out:`` write to ``out.path(name)``;
    leaving the block publishes all names, an exception none."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.run = spark, root.rstrip("/"), uuid.uuid4().hex
        self.fs, self.to_path = file_system(spark, self.root)
        # names with an underscore are hidden from Spark's readers
        self.staging, self.aside = f"{self.root}/_staging-{self.run}", f"{self.root}/_old-{self.run}"
        self.names: list[str] = []

    def path(self, name: str) -> str:
        if name not in self.names:
            self.names.append(name)
        return f"{self.staging}/{name}"

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, value, trace) -> None:
        try:
            if kind is None:
                self._publish()
        finally:
            for folder in (self.staging, self.aside):
                self.fs.delete(self.to_path(folder), True)

    def _move(self, source: str, target: str) -> None:
        if not self.fs.rename(self.to_path(source), self.to_path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def _publish(self) -> None:
        manifest = {"run": self.run, "outputs": {}}
        for name in self.names:
            size = self.fs.getContentSummary(self.to_path(f"{self.staging}/{name}"))
            manifest["outputs"][name] = {"files": size.getFileCount(), "bytes": size.getLength()}
        stream = self.fs.create(self.to_path(f"{self.staging}/{MANIFEST}"))
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        # what the last run had beside these, such as its rejects, goes too
        last = (published(self.spark, self.root) or {"outputs": {}})["outputs"]
        self.fs.mkdirs(self.to_path(self.aside))
        done: list[tuple[str, str]] = []
        try:
            for name in dict.fromkeys([*self.names, *last, MANIFEST]):
                target = f"{self.root}/{name}"
                if self.fs.exists(self.to_path(target)):
                    self._move(target, f"{self.aside}/{name}")
                    done.append((f"{self.aside}/{name}", target))
                if name in self.names or name == MANIFEST:
                    self._move(f"{self.staging}/{name}", target)
                    done.append((target, f"{self.staging}/{name}"))
        except BaseException:
            for source, target in reversed(done):
                if source.startswith(self.aside):
                    self._move(source, target)
                else:
                    self.fs.rename(self.to_path(source), self.to_path(target))
            raise
