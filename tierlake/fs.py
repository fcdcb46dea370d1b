"""The few file system calls Spark's readers and writers do not offer.

They go through Hadoop's FileSystem, so any scheme the session can read works.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """Hadoop file system access for paths of any scheme."""

    def __init__(self, spark: SparkSession):
        jvm = getattr(spark, "_jvm", None)
        if jvm is None:
            raise RuntimeError("publishing needs a classic Spark session, not Spark Connect")
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._io = jvm.org.apache.commons.io.IOUtils
        self._utf8 = jvm.java.nio.charset.StandardCharsets.UTF_8

    def _at(self, path: str):
        location = self._path(path)
        return location.getFileSystem(self._conf), location

    def local(self, path: str) -> str | None:
        """The path in the local file system, None if Hadoop finds it in another one."""
        fs, location = self._at(path)
        # The second is Hive's, over the first.
        if fs.getClass().getSimpleName() not in ("LocalFileSystem", "ProxyLocalFileSystem"):
            return None
        return fs.makeQualified(location).toUri().getPath()

    def exists(self, path: str) -> bool:
        fs, location = self._at(path)
        return fs.exists(location)

    def make_parent(self, path: str) -> None:
        fs, location = self._at(path)
        fs.mkdirs(location.getParent())

    def delete(self, path: str) -> None:
        fs, location = self._at(path)
        fs.delete(location, True)

    def rename(self, source: str, target: str) -> None:
        fs, location = self._at(source)
        if not fs.rename(location, self._path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def children(self, path: str) -> list[str]:
        fs, location = self._at(path)
        if not fs.exists(location):
            return []
        return [status.getPath().getName() for status in fs.listStatus(location)]

    def age(self, path: str) -> float:
        """Seconds since the file or folder was last changed; endless if it is not there."""
        fs, location = self._at(path)
        try:
            return time.time() - fs.getFileStatus(location).getModificationTime() / 1000
        except Py4JJavaError as error:
            if _is(error, "FileNotFoundException"):
                return float("inf")
            raise

    def create_new(self, path: str) -> bool:
        """Make an empty file where none is; of several callers one gets True.

        The folder must be there. HDFS, ABFS and GCS create exclusively by themselves.
        """
        fs, location = self._at(path)
        folder = fs.resolvePath(location.getParent()).toUri()
        if folder.getScheme() == "file":  # Hadoop looks first and creates then
            try:
                flags = os.O_CREAT | os.O_EXCL | os.O_WRONLY
                os.close(os.open(f"{folder.getPath()}/{location.getName()}", flags, 0o644))
            except FileExistsError:
                return False
            return True
        try:
            fs.create(location, False).close()
        except Py4JJavaError as error:
            if _is(error, "FileAlreadyExistsException"):
                return False
            raise
        return True

    def files(self, path: str) -> Iterator[tuple[str, int, int]]:
        """``(path below, bytes, milliseconds of last change)`` of all files, hidden ones too.

        The checksums that Hadoop keeps beside local files are none of them.
        """
        fs, location = self._at(path)
        if not fs.exists(location):
            return
        top = fs.getFileStatus(location).getPath().toUri().getPath().rstrip("/")
        found = fs.listFiles(location, True)
        while found.hasNext():
            status = found.next()
            below = status.getPath().toUri().getPath().removeprefix(f"{top}/")
            name = below.rpartition("/")[2]
            if name.startswith(".") and name.endswith(".crc"):
                continue
            yield below, status.getLen(), status.getModificationTime()

    def read_text(self, path: str) -> str:
        fs, location = self._at(path)
        stream = fs.open(location)
        try:
            return self._io.toString(stream, self._utf8)
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        fs, location = self._at(path)
        stream = fs.create(location, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()


def _is(error: Py4JJavaError, name: str) -> bool:
    return error.java_exception.getClass().getName().endswith(f".{name}")


def beside(target: str, label: str) -> str:
    """A hidden path next to ``target``; readers skip names that start with ``_``."""
    parent, slash, name = target.rstrip("/").rpartition("/")
    return f"{parent}{slash}_{name}.{label}"


def sibling(target: str, label: str) -> str:
    """A fresh hidden path next to ``target``."""
    return beside(target, f"{label}-{uuid.uuid4().hex}")
