"""Small documents and folders on any filesystem that Spark reads."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Store:
    """The Hadoop filesystem of a folder. Documents are replaced in one rename, so readers see the old or the new one."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self.spark = str(root).rstrip("/"), spark
        self._jvm, self._conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self.path().getFileSystem(self._conf)

    def path(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/") if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self.path(name))

    def folders(self) -> list[str]:
        if not self.exists():
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.path()) if s.isDirectory())

    def has_files(self, end: str) -> bool:
        """Whether there is a file of such a name, hidden ones aside."""
        return self.exists() and any(s.isFile() and (n := s.getPath().getName()).endswith(end) and n[0] not in "._" for s in self._fs.listStatus(self.path()))

    def names(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.path())) if self.exists() else []

    def create(self, name: str, text: str) -> bool:
        """Make a document that must not be there; False if it is. Of several that try only one makes it."""
        path = self.path(name)
        self._fs.mkdirs(path.getParent())
        if self._fs.getScheme() == "file":  # where the filesystem looks before it makes a file
            try:
                with os.fdopen(os.open(path.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY), "w") as f:
                    f.write(text)
                return True
            except FileExistsError:
                return False
        try:
            out = self._fs.create(path, False)
        except Py4JJavaError as e:
            if self._fs.exists(path):
                return False
            raise e
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def modified(self, name: str) -> float:
        """When a document was last written, in seconds."""
        return self._fs.getFileStatus(self.path(name)).getModificationTime() / 1000

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)

    def rename(self, old: str, new: str) -> None:
        if not self._fs.rename(self.path(old), self.path(new)):
            raise OSError(f"{self.root}/{old} could not become {self.root}/{new}")

    def replace(self, new: str, name: str) -> None:
        """Put the finished ``new`` in the place of ``name``; what was there goes once that is done."""
        old = f".old-{uuid.uuid4().hex}"
        if had := self.exists(name):
            self.rename(name, old)
        try:
            self.rename(new, name)
        except OSError:
            if had:
                self.rename(old, name)
            raise
        if had:
            self.delete(old)

    def write(self, name: str, parts: Iterable[str]) -> None:
        """A UTF-8 document from parts, however many."""
        new = f".new-{uuid.uuid4().hex}"
        out = self._fs.create(self.path(new), True)
        try:
            for p in parts:
                out.write(bytearray(p.encode("utf-8", "surrogatepass")))
        finally:
            out.close()
        self.replace(new, name)

    def read(self, name: str) -> str | None:
        """A document's text, or None if there is none."""
        if not self.exists(name):
            return None
        stream = self._fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8-sig", "replace")
        finally:
            stream.close()

    def write_json(self, name: str, value) -> None:
        self.write(name, [json.dumps(value, ensure_ascii=False, indent=2)])

    def read_json(self, name: str):
        """A JSON document, or None if there is none or it is damaged."""
        try:
            return json.loads(self.read(name) or "")
        except ValueError:
            return None
