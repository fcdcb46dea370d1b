"""Full refresh of a stored table: write aside, then swap.

Several writers may refresh one table at the same time. Each writes to a folder
of its own; then one after the other publishes, and readers see the table of
the last one, whole.
"""

from __future__ import annotations

import random
import re
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierlake.fs import Files, beside, sibling
from tierlake.names import exact
from tierlake.operators.pages import PagesEnd
from tierlake.sinks.layout import clustered, packed_files

# Empty files whose names say which run of a table published with swap="pointer"
# is the current one: the largest number counts. A file is there or not, so no
# reader or crash can meet half a pointer.
POINTER = "_current."
_POINTER_NAME = re.compile(r"_current\.(\d+)\.(run-[0-9a-f]{32})")
# An empty file that is made exclusively: its number belongs to one writer.
_CLAIM_NAME = re.compile(r"_claim\.(\d+)")

#: Seconds that a write may take; what an unfinished one left is cleared after them.
LEASE = 86_400.0
#: Seconds that two renames may take; a lock that is older was left by a killed writer.
SWAP_LEASE = 600.0

# Leave no marker or summary files beside the data.
_DATA_FILES_ONLY = {
    "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
    "parquet.summary.metadata.level": "NONE",
}


@dataclass(frozen=True)
class Refreshed:
    """A published table and the number of rows this run wrote to it.

    Of a table made from pages, ``end`` says where those ended and why.
    """

    target: str
    rows: int
    end: PagesEnd | None = None


def staging_path(files: Files, target: str, swap: str) -> str:
    """A fresh path that ``publish`` can make the table at ``target``."""
    if swap not in ("rename", "pointer"):
        raise ValueError(f"swap must be 'rename' or 'pointer', not {swap!r}")
    staging = sibling(target, "new") if swap == "rename" else f"{target}/run-{uuid.uuid4().hex}"
    files.make_parent(staging)
    return staging


def publish(files: Files, staging: str, target: str, swap: str, lease: float = LEASE) -> None:
    """Make the complete folder ``staging`` the table at ``target``."""
    if swap == "pointer":
        _swap_by_pointer(files, staging.rpartition("/")[2], target, lease)
        return
    with _locked(files, target):
        _recover(files, target)
        _swap_by_rename(files, staging, target)
        for name in leftovers(files, target, "old"):
            files.delete(name)
        for name in leftovers(files, target, "new"):
            if files.age(name) >= lease:
                files.delete(name)


class Staging:
    """Where a writer of ``target`` puts its data: ``path``, or ``another()`` instead of it."""

    def __init__(self, files: Files, target: str, swap: str):
        self.files, self.target, self.swap = files, target, swap
        self.paths = [staging_path(files, target, swap)]

    @property
    def path(self) -> str:
        return self.paths[-1]

    def another(self) -> str:
        """A fresh path; what is at those before it is not published."""
        self.paths.append(staging_path(self.files, self.target, self.swap))
        return self.path

    def clear(self, paths: list[str]) -> None:
        for path in paths:
            self.files.delete(path)


@contextmanager
def staged(
    spark: SparkSession, target: str, swap: str = "rename", lease: float = LEASE
) -> Iterator[Staging]:
    """A place to write to; what is there becomes ``target`` if the block succeeds.

    If the block fails, ``target`` keeps what it had. If the process is killed,
    readers find what ``target`` had or what it should have, and later calls
    clear away what is left, unfinished data once it is older than ``lease``
    seconds. Calls for one target may overlap, also from several drivers.

    ``swap="rename"`` moves the new folder into place: two renames under a lock
    file, for file systems where a folder rename is a metadata change (HDFS,
    ABFS, local). ``swap="pointer"`` is for object stores, where a rename copies
    every byte: data stays in ``target/run-<id>`` and an empty file names the
    current run. The run before it is kept for readers that have begun; older
    ones go. Read such a table with ``read_layer``. Both rely on the store to
    make a file exclusively when asked to.
    """
    target = target.rstrip("/")
    files = Files(spark)
    staging = Staging(files, target, swap)
    if swap == "rename" and not files.exists(target) and leftovers(files, target, "old"):
        with _locked(files, target):
            _recover(files, target)
    try:
        yield staging
        staging.clear(staging.paths[:-1])
    except BaseException:
        staging.clear(staging.paths)
        raise
    publish(files, staging.path, target, swap, lease)


@contextmanager
def _locked(files: Files, target: str) -> Iterator[None]:
    """Only one writer of ``target`` at a time is inside the block.

    The lock is an exclusively made file. One of a killed writer counts until
    ``SWAP_LEASE`` is over; then the next number is made instead.
    """
    parent, slash, name = target.rpartition("/")
    pattern = re.compile(rf"_{re.escape(name)}\.lock-(\d+)")
    folder = parent or slash or "."

    def held() -> tuple[list[int], list[int]]:
        """Numbers of all locks, and of those that still count."""
        found = [int(m[1]) for n in files.children(folder) if (m := pattern.fullmatch(n))]
        return found, [k for k in found if files.age(beside(target, f"lock-{k}")) < SWAP_LEASE]

    while True:
        every, young = held()
        mine = max(every, default=0) + 1
        path = beside(target, f"lock-{mine}")
        if not young and files.create_new(path):
            # Another may have seen the same, made an older number and be at work.
            if not set(held()[1]) - {mine}:
                break
            files.delete(path)
        time.sleep(random.uniform(0.05, 0.3))
    try:
        yield
    finally:
        for number in every:
            files.delete(beside(target, f"lock-{number}"))
        files.delete(path)


def _swap_by_rename(files: Files, staging: str, target: str) -> None:
    if not files.exists(target):
        files.rename(staging, target)
        return
    retired = sibling(target, "old")
    files.rename(target, retired)
    try:
        files.rename(staging, target)
    except BaseException:
        files.rename(retired, target)
        raise
    files.delete(retired)


def leftovers(files: Files, target: str, label: str) -> list[str]:
    """Folders beside ``target`` that a writer is at work on or has left."""
    parent, slash, name = target.rpartition("/")
    pattern = re.compile(rf"_{re.escape(name)}\.{label}-[0-9a-f]{{32}}")
    names = files.children(parent or slash or ".")
    return [f"{parent}{slash}{name}" for name in names if pattern.fullmatch(name)]


def _recover(files: Files, target: str) -> None:
    """Put back a table that a killed run had moved aside."""
    old = leftovers(files, target, "old")
    if old and not files.exists(target):
        if len(old) > 1:
            raise RuntimeError(f"{target} is missing and {len(old)} old versions are beside it")
        files.rename(old[0], target)


def pointers(names: list[str], target: str) -> dict[int, str]:
    """The runs that were published, by number, from the names in a table's folder."""
    found = {}
    for name in names:
        if name.startswith(POINTER.rstrip(".")):
            match = _POINTER_NAME.fullmatch(name)
            if not match:
                raise ValueError(f"{target}/{name} names no run")
            found[int(match[1])] = match[2]
    return found


def current_run(names: list[str], target: str) -> tuple[int, str | None]:
    """Number and folder of the current run, from the names in a table's folder."""
    found = pointers(names, target)
    number = max(found, default=0)
    run = found.get(number)
    if run is not None and run not in names:
        raise FileNotFoundError(f"{target}/{run}, the current run, is missing")
    return number, run


def _swap_by_pointer(files: Files, run: str, target: str, lease: float) -> None:
    """Name ``run`` the current one, under a number that no other writer has.

    A number is claimed by a file that only one writer can make; who loses the
    race takes the next. A claim that is never used does no harm: the largest
    published number counts.
    """
    while True:
        names = files.children(target)
        claimed = [int(m[1]) for name in names if (m := _CLAIM_NAME.fullmatch(name))]
        number = max([*pointers(names, target), *claimed], default=0) + 1
        claim = f"{target}/_claim.{number}"
        if files.create_new(claim):
            break
    files.write_text(f"{target}/{POINTER}{number}.{run}", "")
    _clear(files, target, lease)


def _clear(files: Files, target: str, lease: float) -> None:
    """Delete published runs that two newer ones follow, and what is left of unpublished ones.

    A run without a pointer may be another writer's, until ``lease`` is over.
    """
    names = files.children(target)
    found = pointers(names, target)
    newest = sorted(found)[-2:]
    keep = {found[number] for number in newest}
    # Pointers first: one without its run would be an error.
    for number in sorted(set(found) - set(newest)):
        files.delete(f"{target}/{POINTER}{number}.{found[number]}")
        if found[number] not in keep:
            files.delete(f"{target}/{found[number]}")
    for name in names:
        claim = _CLAIM_NAME.fullmatch(name)
        if claim and int(claim[1]) <= newest[-1]:
            files.delete(f"{target}/{name}")
        elif not claim and not name.startswith(POINTER) and name not in found.values():
            if not name.startswith("run-") or files.age(f"{target}/{name}") >= lease:
                files.delete(f"{target}/{name}")


def refresh(
    df: DataFrame,
    target: str,
    partition_by: str | None = None,
    *,
    cluster: bool = True,
    max_records: int | None = None,
    file_bytes: int | None = None,
    swap: str = "rename",
    lease: float = LEASE,
) -> Refreshed:
    """Make the Parquet table at ``target`` hold exactly the rows of ``df``.

    Without ``partition_by`` tasks write what they hold: no shuffle. With
    ``file_bytes`` what they have written is measured, and files that are much
    smaller are packed into files of about that size before they are
    published, also without a shuffle (``tierlake.sinks.layout``).

    With ``partition_by`` the rows go to ``<column>=<value>`` folders.
    ``cluster=True`` asks Spark to rebalance by the column first: small values
    share a task, and values that hold more than
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` are measured and dealt
    out to as many tasks as they need, whichever task has read them.
    ``cluster=False``, or a session without adaptive execution, skips that
    shuffle; each task then writes one file per value it meets, which is the
    cheaper plan for columns with few values and large input splits.

    ``df`` may read ``target`` itself. The rows are counted in the writing
    tasks. ``swap`` and ``lease`` are those of ``staged``.
    """
    spark = df.sparkSession
    if file_bytes and partition_by:
        raise ValueError("file_bytes is for tables without folders; partition_by sizes by itself")
    rows = Observation()
    # Without adaptive execution nothing would split a hot value.
    if partition_by and cluster and spark.conf.get("spark.sql.adaptive.enabled") == "true":
        df = clustered(df, partition_by)

    def written(frame: DataFrame, path: str) -> None:
        writer = frame.write.options(**_DATA_FILES_ONLY)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        if max_records:
            writer = writer.option("maxRecordsPerFile", max_records)
        writer.parquet(path)

    # Observed after the shuffle: in the final stage a task that runs again,
    # after an executor was lost, is counted once.
    counted = df.observe(rows, F.count(F.lit(1)).alias("rows"))
    with staged(spark, target, swap, lease) as staging:
        written(counted, staging.path)
        packed = packed_files(spark, staging.path, df.schema, file_bytes) if file_bytes else None
        if packed is not None:
            written(packed, staging.another())
    return Refreshed(target, rows.get["rows"])
