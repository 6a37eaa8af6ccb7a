"""Small files and folders on whatever file system the session reaches, by Hadoop's own client.

Only names and notes of a few kilobytes pass here; rows go through Spark's readers and writers.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Files:
    """Folder operations below one base path."""

    def __init__(self, spark: SparkSession, base: str):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._new_path = self._hadoop.Path  # looked up once: every step through the packages is a call
        self.base = base.rstrip("/")
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._new_path(f"{self.base}/{name}" if name else self.base)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._path(name))

    def names(self, folder: str = "") -> list[str]:
        """Names in a folder, in order; none if there is no such folder."""
        if not self.exists(folder):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(folder)))

    def folders(self, folder: str = "") -> list[str]:
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(folder)) if s.isDirectory())

    def leaves(self, folder: str, depth: int) -> list[str]:
        """Folders ``depth`` levels below ``folder``, named relative to it; ``[""]`` at depth 0. Hidden ones are left out."""
        found = [""] if self.exists(folder) else []
        for _ in range(depth):
            found = [f"{f}/{n}" if f else n for f in found for n in self.folders("/".join(x for x in (folder, f) if x))
                     if not n.startswith((".", "_"))]
        return found

    def set_time(self, name: str, millis: int) -> None:
        """Set when a file was modified."""
        self._fs.setTimes(self._path(name), millis, -1)

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def move(self, source: str, target: str) -> None:
        """Rename; ``target`` must not exist."""
        goal = self._path(target)
        self._fs.mkdirs(goal.getParent())
        if not self._fs.rename(self._path(source), goal):
            raise OSError(f"cannot rename {self.base}/{source} to {target}")

    def read_note(self, name: str):
        """The JSON in a small file, or None if it is not there."""
        if not self.exists(name):
            return None
        stream = self._fs.open(self._path(name))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write_note(self, name: str, note) -> None:
        """Write JSON beside its place and rename it there: a reader sees the old note or the new one."""
        draft = f"{name}.{uuid.uuid4().hex}.draft"
        stream = self._fs.create(self._path(draft), True)
        try:
            stream.write(bytearray(json.dumps(note, sort_keys=True).encode()))
        finally:
            stream.close()
        self._replace(draft, name)

    def _replace(self, source: str, target: str) -> None:
        options = self._gateway.new_array(self._hadoop.Options.Rename, 1)
        options[0] = self._hadoop.Options.Rename.OVERWRITE
        path = self._path(source)
        context = self._hadoop.FileContext.getFileContext(self._fs.makeQualified(path).toUri(), self._conf)
        context.rename(self._fs.makeQualified(path), self._fs.makeQualified(self._path(target)), options)
