"""Page sources: landed tables, page files, and the fetching source on file URLs."""

import io
import json
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from tierlake import (
    PageSource,
    land_pages,
    read_page_files,
    read_pages,
    read_records,
    take_pages,
    with_empty_flag,
)
from tierlake.sources import pages as sources

RECORD = T.StructType().add("id", "string")


def write_pages(folder, count, upto):
    for page in range(upto):
        records = [{"id": f"{page}-{n}"} for n in range(3)] if page < count else []
        (folder / f"{page}.json").write_text(json.dumps(records))
    return f"file://{folder}/{{page}}.json"


def test_page_files(spark, tmp_path):
    write_pages(tmp_path, 12, 13)
    records = read_records(take_pages(read_page_files(spark, str(tmp_path))), RECORD)
    assert records.count() == 36 and records.distinct().count() == 36


def test_json_lines(spark, tmp_path):
    rows = [{"page": 0, "status": 200, "body": '[{"id":"a"}]'}, {"page": 1, "status": 500}]
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, rows)))
    records = read_records(take_pages(read_pages(spark, str(tmp_path), "json")), RECORD)
    assert [r.id for r in records.collect()] == ["a"]


def test_parquet_pages_without_the_flag(spark, tmp_path):
    rows = [(0, 200, '[{"id":"a"}]'), (1, 200, "[]"), (2, 200, '[{"id":"b"}]')]
    pages = spark.createDataFrame(rows, "page INT, status INT, body STRING")
    pages.write.parquet(str(tmp_path / "p"))
    records = read_records(take_pages(read_pages(spark, str(tmp_path / "p"))), RECORD)
    assert [r.id for r in records.collect()] == ["a"]


def test_fetching_source(spark, tmp_path):
    url = write_pages(tmp_path, 9, 20)
    spark.dataSource.register(PageSource)
    pages = (
        spark.read.format("json_pages")
        .options(url=url, first=2, pages=10, pages_per_task=4)
        .load()
    )
    assert pages.rdd.getNumPartitions() == 3
    # Of the tasks for 2-5, 6-9 and 10-11 the last one stops at its first empty page.
    assert sorted(r.page for r in pages.collect()) == list(range(2, 11))
    assert {r.status for r in pages.collect()} == {200}


@pytest.mark.parametrize("count, asked", [(0, 4), (3, 4), (4, 12), (11, 12), (13, 28)])
def test_landing_goes_on_until_the_end_is_in_sight(spark, tmp_path, count, asked):
    files, target = tmp_path / "files", str(tmp_path / "landed")
    files.mkdir()
    url = write_pages(files, count, 28)
    assert land_pages(spark, url, target, first_wave=4, pages_per_task=2) == asked
    landed = read_pages(spark, target)
    # A task of two pages stops after an empty one.
    assert landed.count() == count + (asked - count + 1) // 2
    assert read_records(take_pages(landed), RECORD).count() == 3 * count


def test_a_failing_fetch_leaves_the_landed_pages(spark, tmp_path):
    files, target = tmp_path / "files", str(tmp_path / "landed")
    files.mkdir()
    url = write_pages(files, 3, 4)
    land_pages(spark, url, target, first_wave=4)
    with pytest.raises((PySparkException, Py4JJavaError)):
        land_pages(spark, url, target, first_wave=8, pages_per_task=2)
    assert read_pages(spark, target).count() == 4


def test_addresses():
    def address(url, **options):
        return sources.PageReader({"url": url, "pages": "1", **options})._address(7)

    assert address("http://h/items") == "http://h/items?page=7&per_page=50"
    assert address("http://h/items?a=1", per_page="9") == "http://h/items?a=1&page=7&per_page=9"
    assert address("http://h/{page}/{per_page}") == "http://h/7/50"


def test_a_refusal_is_a_page_without_a_body(monkeypatch):
    def refuse(url, timeout):
        raise sources.HTTPError(url, 404, "not found", None, None)

    monkeypatch.setattr(sources, "urlopen", refuse)
    reader = sources.PageReader({"url": "http://h/items", "pages": "2"})
    assert list(reader.read(reader.partitions()[0])) == [(0, 404, None)]


class Service:
    """Answers in turn with the given statuses or bodies, and keeps what it was asked."""

    def __init__(self, *answers):
        self.answers, self.asked = list(answers), []

    def __call__(self, url, timeout):
        self.asked.append(int(url.split("page=")[1].split("&")[0]))
        answer = self.answers.pop(0)
        if isinstance(answer, int):
            raise sources.HTTPError(url, answer, "no", None, None)
        return Answer(answer.encode())


class Answer(io.BytesIO):
    status = 200


def waves_at(folder):
    return {
        wave.name: sorted(p.name for p in wave.iterdir() if p.name.startswith("part-"))
        for wave in folder.glob("_landed.new-*/wave=*")
    }


@pytest.mark.parametrize("swap", ["rename", "pointer"])
def test_a_failed_landing_goes_on_after_its_last_committed_wave(spark, tmp_path, swap):
    service, target = tmp_path / "files", str(tmp_path / "landed")
    service.mkdir()
    url = write_pages(service, 12, 12)  # waves of 4 and 8 are there
    for turn in range(2):
        with pytest.raises((PySparkException, Py4JJavaError)):
            land_pages(spark, url, target, first_wave=4, pages_per_task=2, swap=swap)
        if swap == "rename":
            if turn:
                assert before.items() <= waves_at(tmp_path).items()
            before = waves_at(tmp_path)
            assert {"wave=0", "wave=1"} <= before.keys()
    # Committed waves are not asked for again: their pages may be gone.
    for page in range(12):
        (service / f"{page}.json").unlink()
    for page in range(12, 28):
        records = [{"id": f"{page}-{n}"} for n in range(3)] if page < 17 else []
        (service / f"{page}.json").write_text(json.dumps(records))
    assert land_pages(spark, url, target, first_wave=4, pages_per_task=2, swap=swap) == 28
    landed = read_pages(spark, target)
    assert landed.groupBy("page").count().where("count > 1").isEmpty()
    records = read_records(take_pages(landed), RECORD)
    assert records.count() == 51 and records.distinct().count() == 51
    assert [p.name for p in tmp_path.iterdir() if "landing" in p.name or "new-" in p.name] == []


def test_a_wave_that_was_written_but_not_committed_is_replaced(spark, tmp_path, monkeypatch):
    service, target = tmp_path / "files", str(tmp_path / "landed")
    service.mkdir()
    url = write_pages(service, 9, 12)
    whole = sources._landed_at

    def killed_after_wave_1(staging):
        def land(pages, wave):
            whole(staging)(pages, wave)
            if wave == 1:
                raise RuntimeError("killed")

        return land

    monkeypatch.setattr(sources, "_landed_at", killed_after_wave_1)
    with pytest.raises(PySparkException):
        land_pages(spark, url, target, first_wave=4, pages_per_task=2)
    assert waves_at(tmp_path).keys() == {"wave=0", "wave=1"}
    monkeypatch.undo()
    assert land_pages(spark, url, target, first_wave=4, pages_per_task=2) == 12
    landed = read_pages(spark, target)
    assert landed.groupBy("page").count().where("count > 1").isEmpty()
    assert read_records(take_pages(landed), RECORD).count() == 27


def test_an_old_landing_and_one_of_other_pages_start_over(spark, tmp_path):
    service, target = tmp_path / "files", str(tmp_path / "landed")
    service.mkdir()
    url = write_pages(service, 4, 4)
    with pytest.raises((PySparkException, Py4JJavaError)):
        land_pages(spark, url, target, first_wave=4)
    write_pages(service, 2, 12)
    assert land_pages(spark, url, target, first_wave=3) == 3  # its own waves
    assert land_pages(spark, url, target, first_wave=4, lease=0) == 4
    assert read_records(take_pages(read_pages(spark, target)), RECORD).count() == 6


def test_a_refused_end_is_asked_for_again(spark, tmp_path, monkeypatch):
    service, target = tmp_path / "files", str(tmp_path / "landed")
    service.mkdir()
    url = write_pages(service, 6, 6)
    monkeypatch.setattr(sources, "_ends", lambda spark, wave: True)  # as if page 4 were refused
    with pytest.raises(ValueError, match="page 4 is missing"):
        land_pages(spark, url, target, first_wave=4, on_bad_page="fail")
    assert list(tmp_path.iterdir()) == [service]


def test_waves():
    assert [sources.asked_in(k, 4, 20) for k in range(6)] == [0, 4, 12, 28, 48, 68]
    assert sources.asked_in(2, 100, 10) == 200
    stream = sources.PageStream({"url": "u", "first": "5", "first_wave": "4", "waves_done": "2"})
    assert stream.initialOffset() == {"page": 5} and stream.latestOffset() == {"page": 33}
    ranges = stream.partitions({"page": 17}, {"page": 33})
    assert [(r.first, r.end) for r in ranges] == [(17, 25), (25, 33)]


class Clock:
    """Time that passes only while someone sleeps, for one task."""

    def __init__(self, now):
        self.now = now

    def time(self):
        return self.now

    def sleep(self, seconds):
        assert seconds >= 0
        self.now += seconds


@pytest.mark.parametrize("rate, lanes", [(5, 3), (2.5, 8), (40, 7)])
def test_a_service_is_never_asked_faster_than_it_allows(monkeypatch, rate, lanes):
    rng, asked, got = random.Random(1), [], []
    options = {"url": "http://h/items", "pages": "60", "rate": str(rate), "lanes": str(lanes)}
    reader = sources.PageReader(options)
    for partition in reader.partitions():
        clock = Clock(1_700_000_000 + rng.random())  # tasks start when they can

        def answer(url, timeout, clock=clock):
            asked.append(clock.now)
            clock.now += rng.choice([0.001, 0.3, 3.0])  # and wait as long as it takes
            if rng.random() < 0.3:
                raise sources.HTTPError(url, 503, "busy", None, None)
            return Answer(b"[1]")

        monkeypatch.setattr(sources, "urlopen", answer)
        monkeypatch.setattr(sources, "time", clock)
        got += [page for page, status, _ in reader.read(partition)]
    asked.sort()
    # Requests are a slot apart, so in no second there are more than allowed.
    assert min(b - a for a, b in zip(asked, asked[1:], strict=False)) > 0.999 / rate
    assert len(set(got)) == len(got) and len(reader.partitions()) == lanes


def test_each_page_is_in_one_lane():
    reader = sources.PageReader({"url": "u", "first": "3", "pages": "20", "rate": "1", "lanes": "6"})
    pages = [p for r in reader.partitions() for p in range(r.first, r.end, r.step)]
    assert sorted(pages) == list(range(3, 23))


@pytest.mark.parametrize(
    "said, wait",
    [("7", 7), (" 12 ", 12), ("Thu, 01 Jan 1970 00:01:40 GMT", 40), ("Thu, 01 Jan 1970 00:00:01 GMT", 0),
     ("soon", 0), ("-5", 0), ("", 0), (None, 0)],
)
def test_retry_after(said, wait):
    assert sources.seconds_to_wait({} if said is None else {"Retry-After": said}, 60.0) == wait
    assert sources.seconds_to_wait(None, 60.0) == 0


def test_a_service_that_names_a_time_is_not_asked_before(monkeypatch):
    waits, turns = [], iter([{"Retry-After": "9"}, {"Retry-After": "0"}, None])

    def answer(url, timeout):
        headers = next(turns)
        if headers is None:
            return Answer(b"[]")
        raise sources.HTTPError(url, 429, "slow down", headers, None)

    monkeypatch.setattr(sources, "urlopen", answer)
    monkeypatch.setattr(sources.time, "sleep", waits.append)
    reader = sources.PageReader({"url": "http://h/items", "pages": "1", "wait": "0.5"})
    assert list(reader.read(reader.partitions()[0])) == [(0, 200, "[]")]
    assert waits == [9, 1]


@pytest.mark.parametrize(
    "answers, rows, asked",
    [
        ([503, 429, '[{"id":"a"}]', "[]"], [(0, 200, '[{"id":"a"}]'), (1, 200, "[]")], [0, 0, 0, 1]),
        ([503] * 4, [(0, 503, None)], [0] * 4),
        ([403], [(0, 403, None)], [0]),
        (["[1]", " { } "], [(0, 200, "[1]"), (1, 200, " { } ")], [0, 1]),
        (["[1]"] * 3, [(k, 200, "[1]") for k in range(3)], [0, 1, 2]),
    ],
)
def test_busy_services_are_asked_again_and_nothing_after_the_end(monkeypatch, answers, rows, asked):
    service, waits = Service(*answers), []
    monkeypatch.setattr(sources, "urlopen", service)
    monkeypatch.setattr(sources.time, "sleep", waits.append)
    reader = sources.PageReader({"url": "http://h/items", "pages": "3", "wait": "0.5"})
    assert list(reader.read(reader.partitions()[0])) == rows
    assert service.asked == asked
    assert waits == [0.5 * 2**k for k in range(len(waits))]
    assert len(waits) == min(3, sum(a in sources.BUSY for a in answers))


def test_landing_can_insist_on_an_empty_page(spark, tmp_path):
    files, target = tmp_path / "files", str(tmp_path / "landed")
    files.mkdir()
    url = write_pages(files, 3, 8)
    land_pages(spark, url, target, first_wave=4, on_bad_page="fail")
    # Records that go on where a page is empty end there all the same.
    assert read_records(take_pages(read_pages(spark, target)), RECORD).count() == 9
    with pytest.raises(ValueError):
        land_pages(spark, url, target, first_wave=4, on_bad_page="skip")
    assert read_pages(spark, target).count() == 4


def test_a_cut_json_line_fails(spark, tmp_path):
    lines = [json.dumps({"page": k, "status": 200, "body": '[{"id":"a"}]'}) for k in range(7)]
    lines[2] = lines[2][:30]
    (tmp_path / "p.json").write_text("\n".join(lines))
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_records(take_pages(read_pages(spark, str(tmp_path), "json")), RECORD).collect()


@pytest.mark.parametrize("flagged_first", [True, False])
def test_files_with_and_without_the_flag(spark, tmp_path, flagged_first):
    path = str(tmp_path / "p")
    for turn, flagged in enumerate([flagged_first, not flagged_first]):
        rows = [(3 * turn + k, 200, json.dumps([{"id": f"{turn}{k}"}])) for k in range(3)]
        part = spark.createDataFrame(rows, "page BIGINT, status BIGINT, body STRING")
        part = with_empty_flag(part) if flagged else part
        part.write.mode("append").parquet(path)
    records = read_records(take_pages(read_pages(spark, path)), RECORD)
    assert sorted(r.id for r in records.collect()) == ["00", "01", "02", "10", "11", "12"]
