"""Sources of JSON pages: landed tables, page files, and a paged HTTP service."""

from __future__ import annotations

import hashlib
import math
import re
import time
from collections.abc import Iterator
from email.utils import parsedate_to_datetime
from urllib.error import HTTPError
from urllib.parse import urlencode
from urllib.request import urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

from tierlake.fs import Files, beside
from tierlake.operators.pages import (
    EMPTY_BODY,
    _good,
    checked_end,
    find_end,
    with_empty_flag,
)
from tierlake.sinks.refresh import LEASE, publish, staging_path
from tierlake.sources.folders import read_folder
from tierlake.sources.layers import layer_path

PAGE_SCHEMA = "page BIGINT, status INT, body STRING"
# Statuses that ask to come back later (fixed values).
BUSY = frozenset([429, 500, 502, 503, 504])


def read_pages(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Landed pages: a Parquet table, or page rows in another format such as JSON lines.

    A Parquet table from ``land_pages`` has the ``empty`` flag, so that the
    search for the end need not read bodies; files without it, also beside
    others with it, work too. An unreadable row of another format is an error.
    ``page`` and ``status`` may be stored as INT or BIGINT.
    """
    path = layer_path(spark, path)
    if format != "parquet":
        reader = spark.read.schema(PAGE_SCHEMA).option("mode", "FAILFAST")
        return reader.format(format).load(path)
    stored = spark.read.schema("page BIGINT, status BIGINT, body STRING, empty BOOLEAN")
    status = F.col("status").cast("int").alias("status")
    # Pages that were landed in waves lie in a folder a wave.
    return stored.parquet(path).select("page", status, "body", "empty")


def read_page_files(spark: SparkSession, path: str, number: str = r"(\d+)\.json$") -> DataFrame:
    """One file per page; ``number`` finds the page number in the file path.

    Plain files in local folders are listed and read by tasks, whatever their
    number (``read_folder``); all else goes through Spark's text source, which
    lists on the driver.
    """
    files = read_folder(spark, path)
    if files is None:
        text = spark.read.text(path, wholetext=True)
        files = text.select(F.col("_metadata.file_path").alias("path"), "value")
    page = F.regexp_extract("path", number, 1).cast("bigint")
    return files.select(
        page.alias("page"), F.lit(200).alias("status"), F.col("value").alias("body")
    )


class PageSource(DataSource):
    """Pages of an HTTP service, fetched on the executors.

    ``spark.dataSource.register(PageSource)``, then
    ``spark.read.format("json_pages").option("url", ...).load()``. Options:
    ``url`` (asked with ``page`` and ``per_page`` parameters, or a template
    with ``{page}`` and ``{per_page}`` in it), ``per_page`` (50), ``first``
    (0), ``pages`` (how many page numbers to ask for), ``pages_per_task`` (8),
    ``timeout`` in seconds (60), ``retries`` of a page that a busy service
    refuses (3) and ``wait``, the seconds before the first of them (1), which
    double with each; a service that names a time itself (``Retry-After``) is
    not asked before.

    ``rate`` is the number of requests a second that the service allows, retries
    included. Time is then dealt out in slots of ``1 / rate`` seconds: there are
    ``lanes`` tasks (8; the tasks that can run at once), each takes every
    ``lanes``-th page, and asks only at the beginning of every ``lanes``-th
    slot. However long answers take, two tasks never ask in one slot, as far as
    the clocks of the executors agree.

    A status other than 200 is a row without a body. A task stops at its first
    refused or empty page: no later page can count. A network failure fails
    the task, which Spark runs again.

    ``spark.readStream`` takes the same options but ``pages``, and reads in
    waves: see ``PageStream``.
    """

    @classmethod
    def name(cls) -> str:
        return "json_pages"

    def schema(self) -> str:
        return PAGE_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PageStream(self.options)


class PageRange(InputPartition):
    """The pages ``first, first + step, ...`` before ``end``, asked for in slots of a lane."""

    def __init__(self, first: int, end: int, step: int = 1, lane: int = 0):
        self.first = first
        self.end = end
        self.step = step
        self.lane = lane


class PageFetcher:
    """Asks a service for pages; what both readers share."""

    def __init__(self, options):
        self.url = options["url"]
        self.per_page = int(options.get("per_page", 50))
        self.first = int(options.get("first", 0))
        self.pages_per_task = int(options.get("pages_per_task", 8))
        self.timeout = float(options.get("timeout", 60))
        self.retries = int(options.get("retries", 3))
        self.wait = float(options.get("wait", 1))
        self.rate = float(options.get("rate", 0))
        self.lanes = int(options.get("lanes", 8))

    def ranges(self, first: int, end: int) -> list[InputPartition]:
        if self.rate:
            lanes = range(min(self.lanes, end - first))
            return [PageRange(first + lane, end, self.lanes, lane) for lane in lanes]
        step = self.pages_per_task
        return [PageRange(at, min(at + step, end)) for at in range(first, end, step)]

    def read(self, partition: PageRange) -> Iterator[tuple[int, int, str | None]]:
        for page in range(partition.first, partition.end, partition.step):
            status, body = self._patiently(page, partition.lane)
            yield page, status, body
            if status != 200 or re.fullmatch(EMPTY_BODY, body or ""):
                return

    def _patiently(self, page: int, lane: int) -> tuple[int, str | None]:
        for turn in range(self.retries):
            status, body, asked_to_wait = self._get(page, lane)
            if status not in BUSY:
                return status, body
            time.sleep(max(self.wait * 2**turn, asked_to_wait))
        return self._get(page, lane)[:2]

    def _get(self, page: int, lane: int) -> tuple[int, str | None, float]:
        """Status, body, and the seconds a refusing service asks to wait."""
        if self.rate:
            now = time.time()
            time.sleep(next_slot(now, self.rate, self.lanes, lane) - now)
        try:
            with urlopen(self._address(page), timeout=self.timeout) as response:
                # Schemes other than HTTP have no status.
                status = response.status or 200
                return status, response.read().decode("utf-8") if status == 200 else None, 0
        except HTTPError as refusal:
            return refusal.code, None, seconds_to_wait(refusal.headers, time.time())

    def _address(self, page: int) -> str:
        if "{page}" in self.url:
            return self.url.replace("{page}", str(page)).replace("{per_page}", str(self.per_page))
        joint = "&" if "?" in self.url else "?"
        return self.url + joint + urlencode({"page": page, "per_page": self.per_page})


def next_slot(now: float, rate: float, lanes: int, lane: int) -> float:
    """When the next slot of a lane begins; slots are counted from the epoch."""
    turn = math.floor((now * rate - lane) / lanes) + 1
    return (turn * lanes + lane) / rate


def seconds_to_wait(headers, now: float) -> float:
    """What ``Retry-After`` says, a number of seconds or a date; 0 if it says nothing clear."""
    said = ((headers and headers.get("Retry-After")) or "").strip()
    if re.fullmatch(r"[0-9]{1,9}", said):
        return float(said)
    try:
        return max(0.0, parsedate_to_datetime(said).timestamp() - now)
    except (ValueError, TypeError):
        return 0.0


class PageReader(PageFetcher, DataSourceReader):
    def __init__(self, options):
        super().__init__(options)
        self.end = self.first + int(options["pages"])

    def partitions(self) -> list[InputPartition]:
        return self.ranges(self.first, self.end)


class PageStream(PageFetcher, DataSourceStreamReader):
    """Pages in waves that double in size; an offset is the first page not yet asked for.

    Options beside those of the batch reader: ``first_wave`` (64) and
    ``largest_wave`` (65536) pages. ``waves_done`` (0) is how many waves the
    stream's checkpoint holds: the service does not say where it ends, so the
    reader offers one wave more than that, and a stream with ``availableNow``
    ends after it.
    """

    def __init__(self, options):
        super().__init__(options)
        self.first_wave = int(options.get("first_wave", 64))
        self.largest_wave = int(options.get("largest_wave", 65536))
        self.waves_done = int(options.get("waves_done", 0))

    def initialOffset(self) -> dict:
        return {"page": self.first}

    def latestOffset(self) -> dict:
        return {"page": self.first + asked_in(self.waves_done + 1, self.first_wave, self.largest_wave)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self.ranges(start["page"], end["page"])

    def commit(self, end: dict) -> None:
        """Nothing to let go of: the service keeps its pages."""


def asked_in(waves: int, first_wave: int, largest_wave: int) -> int:
    """How many pages the first ``waves`` waves ask for."""
    return sum(min(first_wave << min(k, 62), max(largest_wave, first_wave)) for k in range(waves))


def land_pages(
    spark: SparkSession,
    url: str,
    target: str,
    *,
    per_page: int = 50,
    first_wave: int = 64,
    largest_wave: int = 65536,
    pages_per_task: int = 8,
    swap: str = "rename",
    on_bad_page: str = "stop",
    retries: int = 3,
    wait: float = 1,
    rate: float = 0,
    lease: float = LEASE,
) -> int:
    """Fetch pages until the end is in sight and publish them at ``target``.

    With ``on_bad_page="fail"`` an end other than an empty page with status 200
    is an error, and ``target`` keeps what it had.

    The service does not say how many pages it has, so they are asked for in
    waves that double in size: the driver takes a handful of turns, the
    executors do the fetching and write each page as they get it. Each wave is
    a batch of a stream with a checkpoint beside ``target``. A landing that
    fails or is killed goes on there when it is called again with the same
    ``url``, ``per_page`` and waves: waves that were committed are not asked for
    again, and one that was not is asked for as a whole and replaces what it
    left, so no page is there twice. After ``lease`` seconds it starts over
    instead. ``rate`` limits the requests a second. Two landings of the same
    pages at ``target`` must not run at the same time.

    Returns how many page numbers were asked for.
    """
    if on_bad_page not in ("stop", "fail"):
        raise ValueError(f"on_bad_page must be 'stop' or 'fail', not {on_bad_page!r}")
    spark.dataSource.register(PageSource)
    target, files = target.rstrip("/"), Files(spark)
    asked_for = f"{url} {per_page} {first_wave} {largest_wave}"
    home = beside(target, f"landing-{hashlib.md5(asked_for.encode()).hexdigest()}")
    if files.exists(home) and files.age(home) >= lease:
        files.delete(home)
    staging = _landing_path(files, home, target, swap)
    waves, options = _waves_done(files, home), {
        "url": url, "per_page": per_page, "pages_per_task": pages_per_task,
        "retries": retries, "wait": wait, "rate": rate,
        "lanes": max(1, spark.sparkContext.defaultParallelism),
        "first_wave": first_wave, "largest_wave": largest_wave,
    }
    while not waves or not _ends(spark, f"{staging}/wave={waves - 1}"):
        pages = spark.readStream.format("json_pages").options(**options, waves_done=waves).load()
        stream = (
            pages.writeStream.foreachBatch(_landed_at(staging))
            .option("checkpointLocation", f"{home}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        stream.awaitTermination()
        waves = _waves_done(files, home)
    try:
        if on_bad_page == "fail":
            checked_end(find_end(read_pages(spark, staging)), on_bad_page)
    except ValueError:
        # What was refused may be there next time.
        files.delete(staging)
        files.delete(home)
        raise
    publish(files, staging, target, swap, lease)
    files.delete(home)
    return asked_in(waves, first_wave, largest_wave)


def _landing_path(files: Files, home: str, target: str, swap: str) -> str:
    """Where the pages of a landing are gathered: told by a file in ``home``, made once."""
    told = f"{home}/staging"
    if files.exists(told):
        path = files.read_text(told)
        if path and files.exists(path):
            return path
        files.delete(home)
    staging = staging_path(files, target, swap)
    files.make_parent(f"{staging}/wave")
    files.make_parent(told)
    files.write_text(told, staging)
    return staging


def _waves_done(files: Files, home: str) -> int:
    """How many waves the checkpoint of a landing has committed."""
    names = files.children(f"{home}/checkpoint/commits")
    return max((int(name) + 1 for name in names if name.isdigit()), default=0)


def _landed_at(staging: str):
    def land(pages: DataFrame, wave: int) -> None:
        # A wave that is asked for again replaces what it left.
        with_empty_flag(pages).write.mode("overwrite").parquet(f"{staging}/wave={wave}")

    return land


def _ends(spark: SparkSession, wave: str) -> bool:
    """Does a landed wave hold the page that ends them all, or one after it?"""
    return not read_pages(spark, wave).where(~_good()).limit(1).isEmpty()
