"""Small driver-side file actions on whatever file system Spark is set up with."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession
from py4j.protocol import Py4JJavaError


class CommitConflict(RuntimeError):
    """Another writer committed the same version first."""


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()

    def path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def _fs(self, text: str):
        return self.path(text).getFileSystem(self._conf)

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        fs = p.getFileSystem(self._conf)
        if not fs.exists(p):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(p))

    def exists(self, file: str) -> bool:
        p = self.path(file)
        return p.getFileSystem(self._conf).exists(p)

    def read_text(self, file: str) -> str:
        stream = self._fs(file).open(self.path(file))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, file: str, text: str) -> None:
        """Publish ``text`` under a name nobody else has taken, in one rename."""
        fs = self._fs(file)
        folder, name = file.rsplit("/", 1)
        draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
        out = fs.create(self.path(draft), False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self.path(file).toUri(), self._conf
        ) if self.path(file).toUri().getScheme() else (
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._conf)
        )
        try:
            context.rename(self.path(draft), self.path(file), options)
        except Py4JJavaError as error:
            fs.delete(self.path(draft), False)
            if "AlreadyExists" in str(error.java_exception):
                raise CommitConflict(file) from error
            raise

    def leaf_dirs(self, folder: str, depth: int) -> list[str]:
        """Relative ``a=1/b=2`` directories ``depth`` levels below ``folder``."""
        level = [""]
        for _ in range(depth):
            level = [
                f"{parent}/{name}" if parent else name
                for parent in level
                for name in self.names(f"{folder}/{parent}" if parent else folder)
                if "=" in name
            ]
        return level

    def delete(self, folder: str) -> None:
        self._fs(folder).delete(self.path(folder), True)


class Pointer:
    """A numbered sequence of small JSON documents; the highest number is current."""

    def __init__(self, spark: SparkSession, folder: str):
        self._files = Files(spark)
        self.folder = folder

    def versions(self) -> list[int]:
        return [
            int(name[:-5])
            for name in self._files.names(self.folder)
            if name.endswith(".json") and not name.startswith(".")
        ]

    def _file(self, version: int) -> str:
        return f"{self.folder}/{version:010d}.json"

    def newest(self, at_least: int = 0) -> int:
        """The current version, or 0. Versions are consecutive, so one look past a
        version that is known to exist tells whether it is still the newest."""
        if at_least and not self._files.exists(self._file(at_least + 1)):
            return at_least
        return max(self.versions(), default=0)

    def load(self, version: int | None = None) -> tuple[int, dict[str, Any]]:
        version = version or self.newest()
        if not version:
            return 0, {}
        return version, json.loads(self._files.read_text(self._file(version)))

    def swap(self, after: int, document: dict[str, Any]) -> int:
        """Publish the successor of version ``after``; fail if somebody else did."""
        version = after + 1
        self._files.write_new(self._file(version), json.dumps(document))
        return version


__all__ = ["CommitConflict", "Files", "Pointer"]
