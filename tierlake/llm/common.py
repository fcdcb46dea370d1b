"""What several corpus operators share: normal forms, stored tables, sized broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.session import scratch

# The words of a text are runs of anything but these six characters (fixed values).
BLANKS = "\t\n\x0b\x0c\r "
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` only: whatever else the table has cannot clash later."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that where every character is ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


#: Rows that a Python worker gets at a time in stored steps: of texts of 1 MB, 500 MB.
FRAME_ROWS = 500
_FRAME_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Shuffle files go when the query that made them ends, not when the driver collects its garbage.
_CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def small_frames(spark: SparkSession, rows: int = FRAME_ROWS) -> Iterator[None]:
    """Jobs that start in the block send Python at most ``rows`` rows at a time, and clean up."""
    before = {name: spark.conf.get(name) for name in (_FRAME_SETTING, _CLEANUP_SETTING)}
    most = int(before[_FRAME_SETTING])
    spark.conf.set(_FRAME_SETTING, str(min(rows, most) if most > 0 else rows))
    spark.conf.set(_CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has a column of that name."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    It cuts the lineage, survives lost executors, and fixes what a second
    evaluation could order differently.
    """
    spark = df.sparkSession
    path = f"{folder or scratch(spark)}/t-{uuid.uuid4().hex}"
    with small_frames(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` marked for broadcast when it has at most ``max_rows`` rows, else as it is.

    Counting stops after ``max_rows + 1`` rows; beyond that the join shuffles.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def broadcast_if_light(df: DataFrame, size: Column, max_bytes: int) -> DataFrame:
    """``df``, a stored table, marked for broadcast when ``size`` sums to at most ``max_bytes``."""
    total = df.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= max_bytes else df
