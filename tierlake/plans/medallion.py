"""The layered job: pages to bronze, bronze to silver, silver to gold.

Each layer is one Spark job that reads only the stored output of the layer
before it and is published as a full refresh. A failure stops the run and
leaves the layers after it as they were.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierlake.fs import Files, sibling
from tierlake.functions.nulls import DEFAULTS, fill_defaults
from tierlake.names import exact
from tierlake.operators.aggregate import count_by
from tierlake.operators.pages import (
    PagesEnd,
    find_end,
    read_records,
    take_pages,
    with_empty_flag,
)
from tierlake.sinks.refresh import Refreshed, refresh
from tierlake.sources.layers import read_layer
from tierlake.sources.pages import read_pages

LAYERS = ("bronze", "silver", "gold")

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Medallion:
    """Where the layers are and what they hold; works for any record schema."""

    pages: str
    bronze: str
    silver: str
    gold: str
    schema: T.StructType
    keys: Sequence[str]
    counted: str
    count_name: str
    partition_by: str | None = None
    columns: Sequence[str] | None = None
    defaults: Mapping[str, object] = field(default_factory=lambda: dict(DEFAULTS))
    page_format: str = "parquet"
    on_bad_page: str = "stop"
    cluster: bool = True
    max_records: int | None = None
    #: About how large the files of layers without folders are to be.
    file_bytes: int | None = None
    swap: str = "rename"

    @property
    def silver_schema(self) -> T.StructType:
        return T.StructType([self.schema[name] for name in self.columns or self.schema.names])

    @property
    def gold_schema(self) -> T.StructType:
        keys = [self.schema[key] for key in self.keys]
        return T.StructType([*keys, T.StructField(self.count_name, T.LongType())])

    def layout(self, partition_by: str | None = None) -> dict[str, object]:
        """How a layer is written, for ``refresh``; folders are sized by their values."""
        file_bytes = None if partition_by else self.file_bytes
        return {"max_records": self.max_records, "file_bytes": file_bytes, "swap": self.swap}

    def bronze_frame(self, pages: DataFrame, end: PagesEnd | None = None) -> DataFrame:
        return read_records(take_pages(pages, self.on_bad_page, end), self.schema)

    def silver_frame(self, bronze: DataFrame) -> DataFrame:
        columns = (exact(name) for name in self.silver_schema.names)
        return fill_defaults(bronze, self.defaults).select(*columns)

    def gold_frame(self, silver: DataFrame) -> DataFrame:
        return count_by(silver, self.keys, self.counted, self.count_name)


@contextmanager
def flagged_pages(spark: SparkSession, job: Medallion) -> Iterator[DataFrame]:
    """The job's pages as a Parquet table with ``empty`` flags.

    Text has nothing to skip, so it is read once, into a table beside bronze
    that goes when the block ends; the search for the end then reads narrow
    columns, and the second scan leaves out what comes after it.
    """
    pages = read_pages(spark, job.pages, job.page_format)
    if job.page_format == "parquet":
        yield pages
        return
    files, landed = Files(spark), sibling(job.bronze.rstrip("/"), "pages")
    files.make_parent(landed)
    try:
        with_empty_flag(pages).write.parquet(landed)
        yield read_pages(spark, landed)
    finally:
        files.delete(landed)


def run(
    spark: SparkSession, job: Medallion, layers: Sequence[str] = LAYERS
) -> dict[str, Refreshed]:
    """Refresh the given layers, in order; the row count of each comes with its write.

    Bronze also tells where its pages ended and why. With
    ``on_bad_page="fail"`` nothing is written unless that was an empty page.
    """
    unknown = set(layers) - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers {sorted(unknown)}")
    done: dict[str, Refreshed] = {}
    if "bronze" in layers:
        with flagged_pages(spark, job) as pages:
            end = find_end(pages)
            log.log(
                logging.INFO if end.natural else logging.WARNING,
                "pages end at %d: %s, status %s", end.stop, end.cause, end.status,
            )
            records = job.bronze_frame(pages, end)
            written = refresh(records, job.bronze, **job.layout())
        done["bronze"] = replace(written, end=end)
    if "silver" in layers:
        bronze = read_layer(spark, job.bronze, job.schema)
        done["silver"] = refresh(
            job.silver_frame(bronze),
            job.silver,
            job.partition_by,
            cluster=job.cluster,
            **job.layout(job.partition_by),
        )
    if "gold" in layers:
        silver = read_layer(spark, job.silver, job.silver_schema)
        done["gold"] = refresh(job.gold_frame(silver), job.gold, **job.layout())
    return done


def row_counts(spark: SparkSession, done: Mapping[str, Refreshed]) -> DataFrame:
    """``(layer, n)``, one row per refreshed layer."""
    counts = [(layer, result.rows) for layer, result in done.items()]
    return spark.createDataFrame(counts, "layer STRING, n BIGINT")
