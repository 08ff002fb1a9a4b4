"""Folder moves through Hadoop's FileSystem, so any shared store Spark can write works."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import SparkSession

_CHUNK = re.compile(r"chunk_id=(-?\d+)")
_LOAD = re.compile(r"chunk_id=(-?\d+)/load=([^/,}\s]+)")


class Folder:
    """Metadata calls on one table folder; data never passes through here."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        jvm = spark._jvm
        self._to_path = jvm.org.apache.hadoop.fs.Path
        self._to_paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths
        self._to_text = jvm.org.apache.commons.lang3.ArrayUtils.toString
        self._read_all = jvm.org.apache.commons.io.IOUtils.toString
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())
        self._full_root = self._fs.makeQualified(self._path("")).toString()
        #: The root as a path pattern that stands for itself alone.
        self.plain_root = re.sub(r"([{}\[\]*?\\])", r"\\\1", self.root)

    def _path(self, name: str):
        return self._to_path(f"{self.root}/{name}" if name else self.root)

    def holds(self, path: str) -> bool:
        """Whether a file's path, as Spark names it, lies in this folder."""
        return unquote(path).startswith(f"{self._full_root}/") or unquote(path).startswith(
            self._full_root.replace(":/", ":///", 1) + "/"
        )

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._path(name))

    def mkdirs(self, name: str = "") -> None:
        self._fs.mkdirs(self._path(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def rename(self, old: str, new: str) -> None:
        if not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"could not move {old} to {new} in {self.root}")

    def each(self, job: Callable, names: Iterable) -> None:
        """Run a job of metadata calls for every name, several at a time."""
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(job, names))

    def write_text(self, name: str, text: str) -> None:
        """A small file; it appears under its name only when it is whole."""
        hidden = f"{name}.{uuid.uuid4().hex[:12]}"
        out = self._fs.create(self._path(hidden))
        out.write(text.encode())
        out.close()
        self.rename(hidden, name)

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._read_all(stream, "UTF-8")
        finally:
            stream.close()

    def matches(self, pattern: str) -> str:
        """Paths that match, as one string: a single call however many there are."""
        found = self._fs.globStatus(self._to_path(f"{self.plain_root}/{pattern}"))
        return self._to_text(self._to_paths(found)).replace(self._full_root, "")

    def names(self, pattern: str) -> list[str]:
        """Names, below this folder, that match a pattern with one star at its end."""
        stem = re.escape(pattern.rstrip("*"))
        return sorted(set(re.findall(rf"/({stem}[^/,}}\s]*)", self.matches(pattern))))

    def loads(self, pattern: str = "chunk_id=*") -> dict[int, set[str]]:
        """The loads in the chunks that match."""
        out: dict[int, set[str]] = {}
        for chunk, load in _LOAD.findall(self.matches(f"{pattern}/load=*")):
            out.setdefault(int(chunk), set()).add(load)
        return out

    def chunk_ids(self, within: str = "", pattern: str = "chunk_id=*") -> list[int]:
        """Chunk folders present, in time order; as many as there are chunks, never rows."""
        pattern = f"{within}/{pattern}" if within else pattern
        return sorted({int(i) for i in _CHUNK.findall(self.matches(pattern))})


def fresh(prefix: str) -> str:
    """A new hidden folder name; Spark's readers skip names with a leading underscore."""
    return f"_{prefix}-{uuid.uuid4().hex[:12]}"
