"""Whole files of a local folder, listed and read by tasks.

Spark's file source keeps a record of every file on the driver and gives a task
about 32 small files. With a file a page both grow with the pages. Here the
driver knows only the names in one folder, and tasks do the rest. What a folder
must look like is narrow, so that the files are those Spark's text source finds.
"""

from __future__ import annotations

import os
import re
import stat
import sys
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.fs import Files

# As with Spark's own source, Python workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILES_PER_TASK = 1024
# Names travel in rows of so many; contents in batches of so many files or bytes.
_NAMES = 64
_BATCH_FILES, _BATCH_BYTES = 256, 16 << 20

# Names that are the same in a URI.
_NAME = r"[A-Za-z0-9_.=+,@~-]+"
_FOLDER = rf"(?:file:(?://)?)?((?:/{_NAME})+)/*"
_COMPRESSED = (".gz", ".bz2", ".deflate", ".snappy", ".lz4", ".zst")
_CONTENTS = pa.schema([("path", pa.string()), ("content", pa.binary())])


class OddFolder(Exception):
    """A folder with more in it than plain files."""


def read_folder(spark: SparkSession, path: str) -> DataFrame | None:
    """``path, value`` of each file as ``spark.read.text(path, wholetext=True)`` has them.

    None if ``path`` is not a local folder of plain files, or of folders
    ``key=value`` with plain files in them. Names are taken when this is called.
    """
    folder = _local_folder(spark, path)
    try:
        names, nested = _names(folder) if folder else ([], False)
    except OddFolder:
        return None
    if not names:
        return None
    rows = [names[at : at + _NAMES] for at in range(0, len(names), _NAMES)]
    listed = spark.createDataFrame(pa.table({"names": pa.array(rows, pa.list_(pa.string()))}))
    sizes = listed.mapInArrow(_sizes(folder, nested), "files BIGINT, bytes BIGINT, odd BOOLEAN")
    total = sizes.agg(
        F.sum("files").alias("files"), F.sum("bytes").alias("bytes"), F.max("odd").alias("odd")
    ).first()
    if total.odd:
        return None
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    tasks = max(1, -(-total.files // FILES_PER_TASK), -(-total.bytes // most))
    # A row of names is the least that a task can get.
    contents = listed.repartition(min(tasks, len(rows))).mapInArrow(
        _contents(folder, nested), "path STRING, content BINARY"
    )
    return contents.select("path", F.col("content").cast("string").alias("value"))


def _local_folder(spark: SparkSession, path: str) -> str | None:
    """``path`` as the tasks open it, if it is a folder whose bytes no setting changes."""
    found = re.fullmatch(_FOLDER, path) if isinstance(path, str) else None
    if found is None or {".", ".."} & set(found[1].split("/")) or not hasattr(spark, "_jvm"):
        return None
    settings = "spark.sql.files.ignoreMissingFiles", "spark.sql.files.ignoreCorruptFiles"
    if any(spark.conf.get(name, "false").lower() == "true" for name in settings):
        return None
    folder = Files(spark).local(path)
    return folder if folder and os.path.isdir(folder) else None


def _visible(name: str) -> bool:
    """Does Spark read a file or folder of this name?"""
    if name.startswith(("_metadata", "_common_metadata")) or name.endswith("._COPYING_"):
        raise OddFolder(name)
    if name.startswith(".") or name.startswith("_") and "=" not in name:
        return False
    if not re.fullmatch(_NAME, name):
        raise OddFolder(name)
    return True


def _names(folder: str) -> tuple[list[str], bool]:
    """What lies in the folder, and whether that is folders ``key=value`` of one key."""
    with os.scandir(folder) as entries:
        found = [(entry.name, entry.is_dir()) for entry in entries if _visible(entry.name)]
    names, nested = [name for name, _ in found], any(is_folder for _, is_folder in found)
    if nested:
        keys = {name.partition("=")[0] for name in names}
        plain = all(is_folder and re.fullmatch("[^=]+=.+", name) for name, is_folder in found)
        # A second column named value would be an error.
        if not plain or len(keys) > 1 or keys.pop().lower() == "value":
            raise OddFolder(folder)
    return names, nested


def _files(folder: str, names: list[str], nested: bool) -> Iterator[tuple[str, str, int]]:
    """``(folder, name, bytes)`` of the files that are not empty."""
    for name in names:
        place, inside = folder, [name]
        if nested:
            place = f"{folder}/{name}"
            inside = [file for file in os.listdir(place) if _visible(file)]
        for file in inside:
            try:
                status = os.stat(f"{place}/{file}")
            except FileNotFoundError:
                if os.path.islink(f"{place}/{file}"):  # to nothing: no file
                    continue
                raise
            if not stat.S_ISREG(status.st_mode) or file.endswith(_COMPRESSED):
                raise OddFolder(f"{place}/{file}")
            if status.st_size:
                yield place, file, status.st_size


def _sizes(folder: str, nested: bool):
    def measure(batches):
        for batch in batches:
            count, total, odd = 0, 0, False
            for names in batch["names"].to_pylist():
                try:
                    for _, _, size in _files(folder, names, nested):
                        count, total = count + 1, total + size
                except OddFolder:
                    odd = True
            yield pa.RecordBatch.from_pydict({"files": [count], "bytes": [total], "odd": [odd]})

    return measure


def _contents(folder: str, nested: bool):
    def read(batches):
        paths, contents, size = [], [], 0
        for batch in batches:
            for names in batch["names"].to_pylist():
                for place, file, _ in _files(folder, names, nested):
                    content = _content(place, file)
                    paths.append(f"file:{place}/{file}")
                    contents.append(content)
                    size += len(content)
                    if len(paths) >= _BATCH_FILES or size >= _BATCH_BYTES:
                        yield pa.RecordBatch.from_pydict(
                            {"path": paths, "content": contents}, _CONTENTS
                        )
                        paths, contents, size = [], [], 0
        yield pa.RecordBatch.from_pydict({"path": paths, "content": contents}, _CONTENTS)

    return read


def _content(folder: str, name: str) -> bytes:
    """The bytes of a file, held against the checksums that Hadoop may have left beside it."""
    with open(f"{folder}/{name}", "rb") as file:
        content = file.read()
    try:
        with open(f"{folder}/.{name}.crc", "rb") as file:
            sums = file.read()
    except FileNotFoundError:
        return content
    if sums[:4] == b"crc\0":
        step = int.from_bytes(sums[4:8], "big")
        parts = (content[at : at + step] for at in range(0, len(content), step))
        found = b"".join(zlib.crc32(part).to_bytes(4, "big") for part in parts)
        if found != sums[8 : 8 + len(found)]:
            raise OSError(f"Checksum error: {folder}/{name}")
    return content
