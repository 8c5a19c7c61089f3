"""Versions of a folder of tables, of which one is published.

A load writes its tables into a folder of its own and publishes them together at the end. What is
published is a manifest: table names and the folders that hold them, so that a job that replaces one
table carries the others over. Publishing creates one empty file whose name holds a number and the
version; the highest number counts. Until that file is there, readers see the version before, and a
reader that has opened a version keeps it.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession

VERSIONS = "versions"
PUBLISHED = "_published"
MANIFEST = "_manifest.json"
#: Versions that stay readable after a newer one is published, this one included.
KEPT = 3


class PublishConflict(RuntimeError):
    """Another job has published in the meantime; nothing of this job is visible."""


class _Files:
    """The few file operations needed, through whatever file system the path belongs to."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self.root = folder.rstrip("/")
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._path(f"{self.root}/{name}")

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        if not self._fs.exists(at):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(at))

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self.path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def create(self, name: str) -> bool:
        """Whether the file could be made; False if it is there already."""
        return self._fs.createNewFile(self.path(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)


def _pointers(files: _Files) -> list[tuple[int, str]]:
    """Number and version of everything published, in order."""
    found = (name.partition(".") for name in files.names(PUBLISHED))
    return sorted((int(number), version) for number, _, version in found if number.isdigit())


def _manifest(files: _Files, version: str) -> dict[str, str]:
    return json.loads(files.read(f"{VERSIONS}/{version}/{MANIFEST}"))


def current(spark: SparkSession, folder: str) -> dict[str, str] | None:
    """The published tables with the full paths of their folders; None if nothing is published."""
    files = _Files(spark, folder)
    pointers = _pointers(files)
    if not pointers:
        return None
    return {t: f"{files.root}/{path}" for t, path in _manifest(files, pointers[-1][1]).items()}


class Draft:
    """A version in the making, on top of what was published when it began."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._files = _Files(spark, folder)
        pointers = _pointers(self._files)
        self._base = pointers[-1] if pointers else (0, "")
        self.version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"
        self._tables: list[str] = []

    def path(self, table: str) -> str:
        """Where to write a table; the table belongs to the version from now on."""
        if table not in self._tables:
            self._tables.append(table)
        return f"{self._files.root}/{VERSIONS}/{self.version}/{table}"

    def publish(self, kept: int = KEPT) -> None:
        """Make the tables visible, all at once. Tables of the version before that were not written
        again stay; versions beyond the last ``kept`` are deleted."""
        files, (number, before) = self._files, self._base
        manifest = _manifest(files, before) if before else {}
        manifest |= {t: f"{VERSIONS}/{self.version}/{t}" for t in self._tables}
        files.write(f"{VERSIONS}/{self.version}/{MANIFEST}", json.dumps(manifest, sort_keys=True))
        mine = (number + 1, self.version)
        files.create(f"{PUBLISHED}/{mine[0]:012d}.{self.version}")
        rivals = [p for p in _pointers(files) if p[0] >= mine[0] and p != mine]
        if rivals:
            files.delete(f"{PUBLISHED}/{mine[0]:012d}.{self.version}")
            raise PublishConflict(f"{rivals[0][1]} was published on top of the same version")
        _prune(files, kept)

    def discard(self) -> None:
        """Delete what was written, and the folders above if nothing else is in them."""
        self._files.delete(f"{VERSIONS}/{self.version}")
        for folder in (VERSIONS, "."):
            if not self._files.names(folder):
                self._files.delete(folder)


def _prune(files: _Files, kept: int) -> None:
    """Delete the versions that were published before the last ``kept``, but for tables that one of
    those still uses. What was never published may belong to a running job and stays."""
    pointers = _pointers(files)
    old, new = pointers[:-kept], pointers[-kept:]
    used = {path for _, version in new for path in _manifest(files, version).values()}
    for number, version in old:
        files.delete(f"{PUBLISHED}/{number:012d}.{version}")
        folder = f"{VERSIONS}/{version}"
        tables = [f"{folder}/{name}" for name in files.names(folder)]
        if not used & set(tables):
            files.delete(folder)
            continue
        for path in tables:
            if path not in used:
                files.delete(path)
