"""Archives: what is written comes back, whatever the byte ranges and the payloads."""

import base64
import gzip
import hashlib
import random
import zlib
from pathlib import Path

import pytest

from tierlake.llm import warc

SCHEMA = "page_id long, url string, html string"


def table():
    rng = random.Random(3)
    words = [f"word{k}" for k in range(500)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(5, 400))) for _ in range(40)]
    texts += [texts[0]] * 30 + [texts[1]] * 2  # a large group of copies
    texts += [None, "", None, "é\r\n\r\nWARC/1.1\r\n\r\n", "".join(map(chr, range(1, 300))) * 2000]
    rows = [(2**60 + k, f"http://host/{k}?a=b c", t) for k, t in enumerate(texts)]
    rows += [rows[2], rows[2], (rows[3][0], None, "other"), (None, "a\r\nb", texts[0]), (None, None, "n")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, parts=3):
    extra = "copy int, digest int, payload int, of int, first int, path int, bytes int, start int"
    data = [(*r, *range(8)) for r in rows]
    return spark.createDataFrame(data, f"{SCHEMA}, {extra}").repartition(parts).cache()


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def said(records):
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` as the query gives them."""
    return sorted(
        records.select(
            warc.row_of("record_id", "long"), "payload_bytes", "payload_digest", "record_type",
            warc.row_of("refers_to", "long"),
        ).collect(),
        key=str,
    )


def wanted(rows):
    out, first = [], {}
    for page_id, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        payload = (html or "").encode()
        kind = "revisit" if payload in first else "response"
        refers = first.setdefault(payload, page_id) if kind == "revisit" else None
        first.setdefault(payload, page_id)
        out.append((page_id, len(payload), digest(payload), kind, refers))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def archives(spark):
    return warc.write_archives(frame(spark, table()), file_bytes=5_000)


@pytest.mark.parametrize("range_bytes", [777, 5_000, 1 << 20])
def test_round_trip_by_ranges(archives, range_bytes):
    assert archives.count() > 3  # files are closed at their size
    records = warc.read_archives(archives, range_bytes)
    assert [tuple(r) for r in said(records)] == wanted(table())
    for row in records.where("record_type = 'response'").collect():
        assert digest(bytes(row.payload)) == row.payload_digest


def test_files_are_plain_gzip_of_warc(archives):
    for path, size in archives.select("path", "bytes").collect():
        raw = Path(path.removeprefix("file:")).read_bytes()
        text = gzip.decompress(raw)
        assert len(raw) == size and text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
        assert text.count(b"\r\nWARC-Record-ID: ") >= 1


def test_payloads_and_urls_come_back(archives):
    records = warc.read_archives(archives, 3_000).where("record_type = 'response'").collect()
    assert {bytes(r.payload) for r in records} == {(t or "").encode() for _, _, t in table()}
    assert "http://host/1?a=b%20c" in {r.target_uri for r in records}
    # A line feed in an address stays inside its header field.
    assert all("\n" not in (r.target_uri or "") for r in records)


def test_short_payloads_are_no_revisits(spark):
    rows = [(1, "u", "same"), (2, "u", "same"), (3, "u", "longer text"), (4, "u", "longer text")]
    records = warc.read_archives(warc.write_archives(frame(spark, rows), least_bytes=5))
    kinds = {r[0]: (r[3], r[4]) for r in said(records)}
    assert kinds == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


def test_shuffled_instead_of_broadcast(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_PAYLOADS", 0)
    records = warc.read_archives(warc.write_archives(frame(spark, table())))
    assert [tuple(r) for r in said(records)] == wanted(table())


def test_no_pages(spark):
    archives = warc.write_archives(frame(spark, []))
    assert archives.collect() == [] and warc.read_archives(archives).collect() == []


def member(kind: str, name: str, block: bytes, level: int = 6) -> bytes:
    fields = [("WARC-Type", kind), ("WARC-Record-ID", name), ("Content-Length", str(len(block)))]
    squeeze = zlib.compressobj(level, zlib.DEFLATED, warc.GZIP)
    head = warc.header(fields, "WARC/1.0")
    return squeeze.compress(head + block + b"\r\n\r\n") + squeeze.flush()


def foreign(spark, tmp_path, raw: bytes, range_bytes: int):
    (tmp_path / "x.warc.gz").write_bytes(raw)
    records = warc.read_archives(warc.list_archives(spark, str(tmp_path)), range_bytes)
    return sorted((r.start, r.record_id, bytes(r.payload)) for r in records.collect())


@pytest.mark.parametrize("range_bytes", [100, 1_000, 10_000])
def test_archives_inside_records_are_payload(spark, tmp_path, range_bytes):
    """An inner archive lies open in a stored block; only its outer record is one."""
    inner = b"".join(member("resource", f"<inner:{k}>", b"i" * 300) for k in range(20))
    parts = [member("resource", "<a>", b"x" * 50), member("resource", "<b>", inner, 0)]
    parts += [member("resource", "<c>", random.Random(1).randbytes(5_000)), member("resource", "<d>", b"")]
    starts = [sum(map(len, parts[:k])) for k in range(4)]
    found = foreign(spark, tmp_path, b"".join(parts), range_bytes)
    assert [f[:2] for f in found] == list(zip(starts, ["<a>", "<b>", "<c>", "<d>"], strict=True))
    assert found[1][2] == inner and found[3][2] == b""


def test_what_is_no_record_is_passed_over(spark, tmp_path):
    good = member("resource", "<a>", b"text" * 20)
    damaged = bytearray(member("resource", "<b>", random.Random(2).randbytes(400)))
    damaged[200] ^= 255
    raw = b"\0" * 9 + good + warc.MAGIC * 50 + bytes(damaged) + gzip.compress(b"no record")
    raw += b"\x1f" + member("resource", "<c>", b"") + good[:40]
    for range_bytes in (64, 4_096):
        names = [name for _, name, _ in foreign(spark, tmp_path, raw, range_bytes)]
        assert names == ["<a>", "<c>"]


def test_a_lost_task_leaves_no_record_twice(spark, tmp_path):
    """The second attempt writes files of its own; the table names only those."""
    from pyspark import TaskContext

    def flaky(batches):
        yield from batches
        if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 0:
            raise RuntimeError("lost")

    rows = frame(spark, [(k, "u", f"page {k}") for k in range(30)], parts=2)
    pages = rows.select("page_id", "url", "html")
    archives = warc.write_archives(pages, str(tmp_path)).cache()
    lost = pages.mapInArrow(flaky, pages.schema)
    again = warc.write_archives(lost, str(tmp_path))
    for written in (archives, again):
        assert written.agg({"records": "sum"}).first()[0] == 30
        assert warc.read_archives(written).count() == 30
