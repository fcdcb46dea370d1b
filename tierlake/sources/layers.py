"""Read a published table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierlake.fs import Files
from tierlake.names import exact
from tierlake.sinks.refresh import current_run, leftovers


def layer_path(spark: SparkSession, target: str) -> str:
    """Where the current files of ``target`` are.

    That is ``target``, the run its pointer names, or, if a refresh was killed
    between two renames, the folder it had moved aside.
    """
    target = target.rstrip("/")
    files = Files(spark)
    names = files.children(target)
    _, run = current_run(names, target)
    if run is not None:
        return f"{target}/{run}"
    if any(name.startswith("run-") for name in names):
        raise FileNotFoundError(f"{target} has runs, but no pointer to the current one")
    if not names and not files.exists(target):
        old = leftovers(files, target, "old")
        if len(old) == 1:
            return old[0]
    return target


def read_layer(
    spark: SparkSession, target: str, schema: T.StructType | None = None
) -> DataFrame:
    """All rows of a Parquet table, folder-name columns included.

    A declared schema keeps folder-name columns in their place and type
    (``08`` stays text), and makes a table without files readable. Without one
    Spark infers it, folder-name columns come last, and they are text only where
    ``spark.sql.sources.partitionColumnTypeInference.enabled`` is false, as in
    ``tierlake.session.SETTINGS``.
    """
    path = layer_path(spark, target)
    reader = spark.read.option("basePath", path)
    if schema is None:
        return reader.parquet(path)
    return reader.schema(schema).parquet(path).select(*(exact(name) for name in schema.names))


LISTING = "path STRING, bytes BIGINT, modified TIMESTAMP, is_data BOOLEAN"


def list_files(spark: SparkSession, target: str, *, every_run: bool = False) -> DataFrame:
    """The files that make up a table, hidden ones and markers too: ``LISTING``.

    ``path`` is below the table's folder, ``is_data`` false for whatever a
    Parquet reader does not read: a name, or a folder on the way, that begins
    with ``_`` or ``.``, or another ending. Of a table published with
    ``swap="pointer"`` the current run is listed; ``every_run`` lists the whole
    folder, pointers included. One row a file, listed by the driver.
    """
    path = target.rstrip("/") if every_run else layer_path(spark, target)
    rows = [
        (
            below,
            size,
            datetime.fromtimestamp(changed / 1000, timezone.utc),
            below.endswith(".parquet") and not any(n[:1] in "._" for n in below.split("/")),
        )
        for below, size, changed in Files(spark).files(path)
    ]
    return spark.createDataFrame(rows, LISTING)
