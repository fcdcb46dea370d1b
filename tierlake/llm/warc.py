"""Web archives: written by many tasks, read back by byte ranges (operator 13).

**Writing.** Each task writes gzip files of WARC 1.1 records, one gzip member a
record, into the shared folder and returns their names and sizes. Only files in
that table are part of the archive, so what a lost task leaves behind never
counts. Of records with equal payloads the one with the smallest id is a
*response*; the others are *revisits* that name it and carry only its HTTP
header and digest.

**Reading.** Archives are cut into byte ranges, however the files were written.
A task looks for gzip magic in its range; a candidate counts if it inflates to a
WARC header and, to its end, to as many bytes as that header says, checksum
included. The task owns the records that start inside its range and reads the
last of them past the range's end. Members of an archive inside an archive may
lie open in a stored block and look like records to a task that starts in
there; they begin before the record around them ends, which the table of
ranges shows, and go.

Files are opened with ``pyarrow.fs``: local, ``hdfs``, ``s3``, ``gs``, ``abfs``.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.llm.common import broadcast_if_small, stored
from tierlake.session import scratch

#: A file is closed when it has this many bytes.
FILE_BYTES = 1 << 30
#: Bytes read, and inflated, at a time.
READ, INFLATED = 1 << 20, 1 << 20
LEVEL = 6
#: Repeated payloads sent to every task instead of shuffling the pages.
BROADCAST_PAYLOADS = 100_000
BROADCAST_RANGES = 100_000

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
GZIP = 31  # zlib's window bits for a gzip member
VERSION = b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
HEAD_LIMIT = 1 << 16


def located(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a URI or local path, and the path in it."""
    if "://" not in path and path.startswith("file:"):
        path = "file://" + path.removeprefix("file:")
    return pa.fs.FileSystem.from_uri(path)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, copy: int) -> str:
    """A URN for a row: its id, and its number if the id is repeated."""
    name = "null" if page_id is None else "id:" + quote(str(page_id), safe="")
    return f"<urn:page:{name}:{copy}>"


def header(fields: list[tuple[str, str | None]], first: str) -> bytes:
    lines = [first, *(f"{name}: {value}" for name, value in fields if value is not None)]
    return "\r\n".join([*lines, "", ""]).encode()


def record(row: dict) -> bytes:
    """The WARC record of a page, one gzip member."""
    payload = row["payload"]
    refers_to = None if row["refers_copy"] is None else record_id(row["refers_to"], row["refers_copy"])
    http = header(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))],
        "HTTP/1.1 200 OK",
    )
    block = http if refers_to else http + payload
    url = None if row["url"] is None else quote(row["url"], safe="%/:?#[]@!$&'()*+,;=-._~")
    head = header(
        [
            ("WARC-Type", "revisit" if refers_to else "response"),
            ("WARC-Record-ID", record_id(row["page_id"], row["copy"])),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", url),
            ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
            ("WARC-Profile", PROFILE if refers_to else None),
            ("WARC-Refers-To", refers_to),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(block))),
        ],
        "WARC/1.1",
    )
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
    return squeeze.compress(head + block + b"\r\n\r\n") + squeeze.flush()


def payloads(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``page_id, copy, url, payload``; ``copy`` tells rows of one id apart, else it is 0."""
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.col(f"`{url_col}`").alias("url"),
        F.coalesce(F.col(f"`{html_col}`").cast("binary"), F.lit(b"")).alias("payload"),
    )
    ids = rows.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.where("n > 1").limit(1).count() == 0:
        return rows.withColumn("copy", F.lit(0).cast("long"))
    return stored(rows.withColumn("copy", F.monotonically_increasing_id()))


def with_originals(rows: DataFrame, least_bytes: int) -> DataFrame:
    """``refers_to, refers_copy`` of the rows whose payload an earlier row has, null for others."""
    size = F.octet_length("payload")
    keyed = rows.withColumn("digest", F.when(size >= least_bytes, F.sha2("payload", 256)))
    # A null id comes last.
    place = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "copy")
    groups = keyed.where("digest is not null").groupBy(F.col("digest").alias("of"))
    groups = groups.agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    groups = broadcast_if_small(stored(groups.where("n > 1").drop("n")), BROADCAST_PAYLOADS)
    same = F.col("page_id").eqNullSafe(F.col("first.page_id")) & (F.col("copy") == F.col("first.copy"))
    later = F.col("of").isNotNull() & ~same
    return keyed.join(groups, F.col("digest") == F.col("of"), "left").select(
        "page_id",
        "copy",
        "url",
        "payload",
        F.when(later, F.col("first.page_id")).alias("refers_to"),
        F.when(later, F.col("first.copy")).alias("refers_copy"),
    )


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    least_bytes: int = 0,
    file_bytes: int = FILE_BYTES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``path, bytes, records`` of the archive files that hold one record a row.

    A null page is an empty payload. Among rows of equal payloads of at least
    ``least_bytes`` bytes the one with the smallest id is the response, a null
    id coming last and rows that repeat an id in the order they are read; the
    others are revisits. An empty table gives no files. ``folder`` is one that
    all executors reach (the scratch folder by default).
    """
    spark = pages.sparkSession
    folder = f"{folder or scratch(spark)}/warc-{uuid.uuid4().hex}"
    rows = with_originals(payloads(pages, id_col, url_col, html_col), least_bytes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = located(folder)
        files.create_dir(base, recursive=True)
        out, name, size, records, done = None, "", 0, 0, []
        for batch in batches:
            for place in range(batch.num_rows):
                member = record({c: batch[c][place].as_py() for c in batch.schema.names})
                if out is None:
                    name, size, records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= file_bytes:
                    out.close()
                    out = None
                    done.append((f"{folder}/{name}", size, records))
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size, records))
        yield pa.RecordBatch.from_pydict(
            {
                "path": pa.array([d[0] for d in done], pa.string()),
                "bytes": pa.array([d[1] for d in done], pa.int64()),
                "records": pa.array([d[2] for d in done], pa.int64()),
            }
        )

    # Stored: each file is written by one run of its task, and named by that run.
    return stored(rows.mapInArrow(write, "path string, bytes long, records long"))


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """``path, bytes`` of all files at ``path`` (a file, folder or pattern); none is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select("path", F.col("length").alias("bytes"))


class ReadAhead:
    """A file's bytes from a position on, read ahead as they are asked for."""

    def __init__(self, file, size: int):
        self.file, self.size, self.start, self.data = file, size, 0, b""

    def at(self, position: int, count: int) -> bytes:
        """Up to ``count`` bytes at ``position``; fewer only at the end of the file."""
        count = min(count, self.size - position)
        if not self.start <= position <= position + count <= self.start + len(self.data):
            self.file.seek(position)
            self.start, self.data = position, self.file.read(max(count, READ))
        return self.data[position - self.start : position - self.start + count]

    def find(self, wanted: bytes, position: int, end: int) -> int | None:
        """Where ``wanted`` next starts, in ``[position, end)``."""
        while position < end:
            chunk = self.at(position, min(READ, end - position + len(wanted) - 1))
            found = chunk.find(wanted)
            if found >= 0:
                return position + found if position + found < end else None
            if len(chunk) < len(wanted):
                return None
            position += len(chunk) - len(wanted) + 1
        return None


def parsed(head: bytes) -> dict[str, str] | None:
    """Fields of a header by lower-case name, and its first line as ``""``; None if it is none."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {"": lines[0]}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return fields


def read_member(window: ReadAhead, position: int) -> tuple[dict[str, str], bytes, int] | None:
    """Header, block and end of the record whose gzip member starts at ``position``.

    None if there is no such record: no gzip, no WARC header, or a member that
    breaks off, fails its checksum or is not as long as its header says.
    """
    inflate = zlib.decompressobj(GZIP)
    out, fields, head_end, length = bytearray(), None, 0, 0
    at = position
    try:
        while not inflate.eof:
            fed = inflate.unconsumed_tail
            if not fed:
                # Little at first: most candidates that are no records end at once.
                fed = window.at(at, READ if fields else 4096)
                if not fed:
                    return None
                at += len(fed)
            out += inflate.decompress(fed, INFLATED)
            if fields is None:
                if not VERSION.startswith(bytes(out[: len(VERSION)])):
                    return None
                end = out.find(b"\r\n\r\n")
                if end < 0:
                    if len(out) > HEAD_LIMIT:
                        return None
                    continue
                fields = parsed(bytes(out[:end]))
                if fields is None or not re.fullmatch(r"[0-9]+", fields.get("content-length", "")):
                    return None
                head_end, length = end + 4, int(fields["content-length"])
            if len(out) > head_end + length + 4:
                return None
    except zlib.error:
        return None
    if fields is None or out[head_end + length :] not in (b"\r\n\r\n", b""):
        return None
    if len(out) < head_end + length:
        return None
    return fields, bytes(out[head_end : head_end + length]), at - len(inflate.unused_data)


def records_in(window: ReadAhead, begin: int, end: int) -> Iterator[tuple[int, int, dict, bytes]]:
    """``start, end, header, block`` of the records that start in ``[begin, end)``."""
    position = begin
    while (position := window.find(MAGIC, position, end)) is not None:
        found = read_member(window, position)
        if found is None:
            position += 1
            continue
        fields, block, after = found
        yield position, after, fields, block
        position = after


def http_payload(fields: dict[str, str], block: bytes) -> tuple[bytes | None, int | None]:
    """Payload of a record and its length; of a revisit the length its HTTP header tells."""
    if "application/http" not in fields.get("content-type", ""):
        return block, len(block)
    head, _, body = block.partition(b"\r\n\r\n")
    if fields.get("warc-type") != "revisit":
        return body, len(body)
    told = (parsed(head) or {}).get("content-length", "")
    return None, int(told) if re.fullmatch(r"[0-9]+", told) else None


READ_SCHEMA = (
    "path string, range_begin long, start long, end long, record_type string, record_id string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
)


def scan_archives(archives: DataFrame, range_bytes: int, with_payload: bool = True) -> DataFrame:
    """All records of ``path, bytes`` archives, with those of inner archives that lie open.

    One row a record (``READ_SCHEMA``); a revisit has no ``payload``, its digest
    and length are those its headers tell, all others' are measured.
    """
    begins = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))
    ranges = archives.where("bytes > 0").select("path", "bytes", F.explode(begins).alias("begin"))
    count = ranges.count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            for path, size, begin in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files, name = located(path)
                with files.open_input_file(name) as file:
                    window, rows, held = ReadAhead(file, size), [], 0
                    for start, end, fields, block in records_in(
                        window, begin, min(begin + range_bytes, size)
                    ):
                        payload, length = http_payload(fields, block)
                        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                        rows.append(
                            (
                                path, begin, start, end,
                                fields.get("warc-type"),
                                fields.get("warc-record-id"),
                                fields.get("warc-target-uri"),
                                fields.get("warc-refers-to"),
                                digest if payload is None else sha1_base32(payload),
                                length,
                                payload if with_payload else None,
                            )
                        )
                        held += len(block)
                        if held >= READ:
                            yield batch_of(rows)
                            rows, held = [], 0
                    yield batch_of(rows)

    spread = ranges.repartition(max(1, count))
    return spread.select("path", "bytes", "begin").mapInArrow(read, READ_SCHEMA)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    names = [column.split(" ") for column in READ_SCHEMA.split(", ")]
    columns = [pa.array([row[k] for row in rows], kinds[kind]) for k, (_, kind) in enumerate(names)]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in names])


def without_inner(records: DataFrame) -> DataFrame:
    """``records`` of a stored scan without those that start inside a record of an earlier range."""
    ranges = records.groupBy("path", "range_begin").agg(
        F.min("start").alias("first"), F.max("end").alias("last")
    )
    earlier = Window.partitionBy("path").orderBy("range_begin").rowsBetween(
        Window.unboundedPreceding, -1
    )
    held = F.max("last").over(earlier)
    cut = ranges.withColumn("held", held).where("first < held").select(
        F.col("path").alias("of"), F.col("range_begin").alias("of_begin"), "held"
    )
    cut = stored(cut)
    if cut.isEmpty():
        return records
    same = (F.col("path") == F.col("of")) & (F.col("range_begin") == F.col("of_begin"))
    inner = F.coalesce(F.col("start") < F.col("held"), F.lit(False))
    joined = records.join(broadcast_if_small(cut, BROADCAST_RANGES), same, "left")
    return joined.where(~inner).drop("of", "of_begin", "held")


def read_archives(
    archives: DataFrame, range_bytes: int | None = None, with_payload: bool = True
) -> DataFrame:
    """The records of ``path, bytes`` archives (``READ_SCHEMA``), each read by the task that owns it.

    ``range_bytes`` is ``spark.sql.files.maxPartitionBytes`` by default. Bytes
    between records that are no record, such as zeros or a broken member, are
    passed over. Empty files have no records.
    """
    if range_bytes is None:
        conf = archives.sparkSession._jsparkSession.sessionState().conf()
        range_bytes = conf.filesMaxPartitionBytes()
    return without_inner(stored(scan_archives(archives, range_bytes, with_payload)))


def row_of(record: str, kind: str):
    """The id in a column of record ids that ``record_id`` has made, as ``kind``."""
    name = F.regexp_extract(record, r"^<urn:page:id:(.*):[0-9]+>$", 1)
    plain = F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(F.col(record).startswith("<urn:page:id:"), plain).cast(kind)
