"""Small files below a root through Hadoop's file system, with creation that only one writer wins."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


class Exists(RuntimeError):
    """Another writer has created the file."""


class Files:
    """``create`` writes a file beside its place and moves it there without ever replacing one, so
    a reader sees whole files only and of several writers exactly one succeeds. On a local disk the
    move is a hard link, elsewhere a rename that refuses an existing target (atomic on HDFS; a
    store whose rename copies, as plain object stores do, gives no such promise)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())
        self.local = self.fs.getUri().getScheme() == "file"

    def path(self, name: str):
        return self._hadoop.Path(f"{self.root}/{name}".rstrip("/"))

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def get(self, name: str) -> bytes:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def head(self, n: int) -> bytes:
        """The first bytes of the root, if it is a file, else none."""
        path = self.path("")
        if not self.fs.exists(path) or self.fs.getFileStatus(path).isDirectory():
            return b""
        stream = self.fs.open(path)
        try:
            found = [stream.read() for _ in range(n)]
        finally:
            stream.close()
        return bytes(b for b in found if b >= 0)

    def list(self, name: str) -> list[str]:
        """Names in a folder, sorted; those that begin with a dot are left out."""
        path = self.path(name)
        found = [s.getPath().getName() for s in self.fs.listStatus(path)] if self.fs.exists(path) else []
        return sorted(n for n in found if not n.startswith("."))

    def walk(self, name: str) -> list[tuple[str, int, float]]:
        """(name below the root, bytes, seconds of its last change) of all files below a folder."""
        base, found = self.path(name), []
        if self.fs.exists(base):
            top = urlparse(self.fs.makeQualified(self.path("")).toString()).path.rstrip("/")
            files = self.fs.listFiles(base, True)
            while files.hasNext():
                s = files.next()
                found.append((urlparse(s.getPath().toString()).path.removeprefix(top).lstrip("/"), int(s.getLen()), s.getModificationTime() / 1000))
        return sorted(found)

    def create(self, name: str, data: bytes) -> None:
        target = self.path(name)
        part = self.path(f".{uuid.uuid4().hex}")
        self.fs.mkdirs(target.getParent())
        out = self.fs.create(part, True)
        out.write(bytearray(data))
        out.close()
        try:
            if self.local:
                os.link(self._local(part), self._local(target))
            else:
                self.move(part, target)
        except FileExistsError as e:
            raise Exists(name) from e
        finally:
            self.fs.delete(part, False)

    def _local(self, path) -> str:
        return unquote(urlparse(self.fs.makeQualified(path).toUri().toString()).path)

    def move(self, source, target) -> None:
        """A rename that refuses an existing target."""
        from py4j.protocol import Py4JJavaError

        jvm = self.spark._jvm
        options = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            self._hadoop.FileContext.getFileContext(self.fs.getUri(), self.spark._jsc.hadoopConfiguration()).rename(source, target, options)
        except Py4JJavaError as e:
            if e.java_exception.getClass().getName() == jvm.org.apache.hadoop.fs.FileAlreadyExistsException._fqn:
                raise Exists(target.toString()) from e
            raise

    def move_folder(self, source: str, target: str) -> None:
        self.fs.mkdirs(self.path(target).getParent())
        if not self.fs.rename(self.path(source), self.path(target)):
            raise OSError(f"{source} could not be moved to {target}")

    def delete(self, name: str) -> bool:
        return bool(self.fs.delete(self.path(name), True))
