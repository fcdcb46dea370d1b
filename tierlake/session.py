"""Session settings for layered jobs, and shared scratch space."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import suppress

from pyspark.sql import SparkSession

from tierlake.fs import Files

# What the jobs rely on, or run better with, on a large cluster. The master,
# memory and executor counts belong to the submit command.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    # Size shuffle partitions and written files by bytes, not by core count.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # The JVM leaves larger methods uncompiled: wide projections run faster split up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
    # As in JSON objects elsewhere, the last of two equal keys counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Folder names are text, also for readers that give no schema.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def builder(app: str, settings: dict[str, str] | None = None) -> SparkSession.Builder:
    """A session builder with ``SETTINGS``, overridden by ``settings``."""
    session = SparkSession.builder.appName(app)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        session = session.config(name, value)
    return session


def mount(spark: SparkSession, links: dict[str, str], name: str | None = None) -> str:
    """``viewfs://name``, a file system in which ``links`` maps folders such as ``/lake`` to URIs.

    Layers, pages and jobs can then be named by stable paths while stores move
    or differ. The table holds for this session and its tasks; a name that is
    in use already would keep the links it had, so one is made up by default.
    Folders cannot be renamed from one link to another: a table and what is
    beside it must be under the same one.
    """
    name = name or f"m{uuid.uuid4().hex}"
    for folder, uri in links.items():
        spark.conf.set(f"fs.viewfs.mounttable.{name}.link.{folder}", uri)
    return f"viewfs://{name}"


def scratch(spark: SparkSession) -> str:
    """A fresh folder every executor can reach, under ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder. The
    folder goes when Python exits.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        folder = f"{shared.rstrip('/')}/tierlake-{uuid.uuid4().hex}"
        atexit.register(_remove, Files(spark), folder)
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tierlake-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _remove(files: Files, folder: str) -> None:
    with suppress(Exception):  # the gateway may be gone by now
        files.delete(folder)
