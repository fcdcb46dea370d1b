import json
import math
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from tierlake import end_of_pages, read_records, take_pages, union_pages, with_empty_flag
from tierlake.operators.pages import PagesEnd, UnfinishedPages, _words, find_end
from tierlake.sources.pages import read_pages

PAGES = "page BIGINT, status INT, body STRING"
RECORD = T.StructType().add("id", "string").add("lon", "double").add("n", "integer")


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), PAGES)


def page(number, *ids, status=200):
    return number, status, json.dumps([{"id": i} for i in ids])


def ids(df):
    return sorted(r.id for r in df.collect())


def ingest(df, **options):
    return read_records(take_pages(df, **options), RECORD)


EMPTY = ["[]", " [ \n] ", "{}", "{ }", "null", "false", "0", "0.0", "-0", "0e5", '""']


@pytest.mark.parametrize("end", EMPTY)
def test_an_empty_page_ends_the_pages(spark, end):
    df = pages(spark, page(0, "a", "b"), page(1, "c"), (2, 200, end), page(3, "d"))
    assert ids(ingest(df)) == ["a", "b", "c"]


@pytest.mark.parametrize("body", ["[0]", "[{}]", "[[]]", "1", "x", "", "nulls", '"a"', "0.1", None])
def test_other_bodies_are_not_empty(spark, body):
    assert with_empty_flag(pages(spark, (0, 200, body))).first().empty is False


@pytest.mark.parametrize("status", [500, 404, 201, None])
def test_any_other_status_ends_the_pages(spark, status):
    df = pages(spark, page(0, "a"), page(1, "b", status=status), page(2, "c"))
    assert ids(ingest(df)) == ["a"]


def test_a_bad_status_can_fail(spark):
    df = pages(spark, page(0, "a"), page(1, "b", status=500), page(2, "c"))
    with pytest.raises(UnfinishedPages, match="page 1 has status 500"):
        ingest(df, on_bad_page="fail")
    with pytest.raises(UnfinishedPages, match="page 1 is missing"):
        ingest(pages(spark, page(0, "a"), page(2, "b")), on_bad_page="fail")
    after_the_end = pages(spark, page(0, "a"), (1, 200, "[]"), (2, 500, None))
    assert ids(ingest(after_the_end, on_bad_page="fail")) == ["a"]
    with pytest.raises(ValueError):
        take_pages(df, on_bad_page="skip")


@pytest.mark.parametrize(
    "rows, end",
    [
        ([page(0, "a"), (1, 200, "[]")], PagesEnd(1, 200, "empty")),
        ([page(0, "a"), (1, 503, None), page(2, "b")], PagesEnd(1, 503, "refused")),
        ([page(0, "a"), (1, None, "[]")], PagesEnd(1, None, "refused")),
        ([page(0, "a"), (1, 200, "[]"), (1, 500, None)], PagesEnd(1, 500, "refused")),
        ([page(0, "a"), page(2, "b")], PagesEnd(1, None, "missing")),
        ([page(3, "a")], PagesEnd(0, None, "missing")),
        ([], PagesEnd(0, None, "missing")),
    ],
)
def test_where_pages_end_and_why(spark, rows, end):
    assert find_end(pages(spark, *rows)) == end


def test_a_page_without_a_number_fails(spark):
    df = pages(spark, page(0, "a"), page(None, "b"), (2, 200, "[]"))
    with pytest.raises((PySparkException, Py4JJavaError), match="no number"):
        ingest(df).collect()


def test_a_null_flag_is_filled_from_the_body(spark):
    rows = [(0, 200, '[{"id":"a"}]', None), (1, 200, '[{"id":"b"}]', False), (2, 200, "[]", None)]
    df = spark.createDataFrame(rows, PAGES + ", empty BOOLEAN")
    assert ids(ingest(df)) == ["a", "b"] and end_of_pages(df).first().stop == 2


def test_a_gap_ends_the_pages(spark):
    assert ids(ingest(pages(spark, page(0, "a"), page(2, "b")))) == ["a"]
    assert ids(ingest(pages(spark, page(1, "a")))) == []
    assert ids(ingest(pages(spark))) == []
    assert ids(ingest(pages(spark, page(-1, "x"), page(0, "a")))) == ["a"]


def test_the_end_is_the_first_number_without_a_good_page(spark):
    random.seed(7)
    for length in [0, 1, 31, 32, 33, 63, 64, 65, 200, 4096]:
        numbers = set(range(length)) | {random.randrange(length + 2, 9000) for _ in range(50)}
        rows = [page(n, "x") for n in numbers] + [(length, 500, None)] * (length % 2)
        random.shuffle(rows)
        assert end_of_pages(pages(spark, *rows)).first().stop == length


def test_a_landed_page_counts_each_time(spark):
    df = pages(spark, page(0, "a"), page(0, "a"), page(1, "b"))
    assert ids(ingest(df)) == ["a", "a", "b"]
    assert ids(union_pages(ingest(df), ingest(df))) == ["a", "a", "a", "a", "b", "b"]


def test_a_good_copy_makes_up_for_a_bad_one(spark):
    df = pages(spark, page(0, "a"), (1, 503, None), page(1, "b"), page(2, "c"))
    assert ids(ingest(df)) == ["a", "b", "c"]


def test_fields(spark):
    body = (
        '[{"id":5,"lon":"1_0","extra":1},{"id":1.50,"lon":0},{"id":true,"lon":true,"n":3},{},'
        '{"id":null,"lon":NaN},{"id":"\\u00e9\\n","lon":[]}]'
    )
    rows = [tuple(r) for r in ingest(pages(spark, (0, 200, body))).collect()]
    assert rows[:4] == [("5", 10.0, None), ("1.5", None, None), ("true", 1.0, 3), (None,) * 3]
    assert rows[4][0] is None and math.isnan(rows[4][1])
    assert rows[5] == ("é\n", None, None)


@pytest.mark.parametrize(
    "body",
    [
        "", "  ", None, "x", "5", "true", '"abc"', '{"id":"a"}', "[null]", "[5]", "[[{}]]",
        '[{"id":"a"},null]', '[{"id":"a"}] junk', '[{"id":"a"}],[{"id":"b"}]', '[{"id":"a"},',
        "[{'id':'a'}]", '[{"id":"a",}]', '[{"n":"x"}]',
    ],
)
def test_a_malformed_body_fails(spark, body):
    with pytest.raises((PySparkException, Py4JJavaError), match="(?i)malformed|not one JSON array"):
        ingest(pages(spark, page(0, "a"), (1, 200, body), page(2, "b"))).collect()


def test_a_malformed_body_after_the_end_is_never_read(spark):
    assert ids(ingest(pages(spark, page(0, "a"), (1, 200, "[]"), (2, 200, "x")))) == ["a"]


def test_long_values_are_read_whole(spark):
    text, number = "x" * 25_000_000, "1" + "0" * 1500
    body = f'[{{"id":"{text}","lon":{number}}},{{"id":"b","lon":{{"a":1,"a":2}}}}]'
    rows = {r.id[:2]: r for r in ingest(pages(spark, (0, 200, body))).collect()}
    assert rows["xx"].id == text and rows["xx"].lon == math.inf and rows["b"].lon is None


def test_plan(spark, tmp_path):
    path = str(tmp_path / "landed")
    rows = [page(n, "a", "b") for n in range(50)] + [(50, 200, "[]")]
    with_empty_flag(pages(spark, *rows)).write.parquet(path)
    records = ingest(spark.read.parquet(path))
    assert records.count() == 100
    plan = records._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    # The search for the end reads no bodies, and its result limits the second scan.
    assert "ReadSchema: struct<page:bigint,status:int,empty:boolean>" in plan
    assert "ReadSchema: struct<page:bigint,status:int,body:string,empty:boolean>" in plan
    assert "LessThan(page,ScalarSubquery" in plan.replace(" ", "")
    assert "Join" not in plan and "CartesianProduct" not in plan and "Python" not in plan


def test_the_end_and_its_cause_come_from_one_reading(spark, tmp_path, capsys):
    rows = [(k, 200, "[1]") for k in range(70)] + [(70, 503, None), (70, 404, None), (71, 200, "[1]")]
    pages = with_empty_flag(spark.createDataFrame(rows, "page BIGINT, status INT, body STRING"))
    pages.write.parquet(str(tmp_path / "p"))
    stored = read_pages(spark, str(tmp_path / "p"))
    assert find_end(stored) == PagesEnd(70, 503, "refused")
    words = _words(stored, with_status=True)
    words.explain("formatted")
    plan = capsys.readouterr().out
    # With the flag and without it; a row group is read by one of the two.
    assert plan.count("Scan parquet") == 2 * 2  # each scan is named twice
    assert words.where("size(bad) > 0").count() == 1


def test_a_good_copy_makes_up_for_bad_ones(spark):
    rows = [(0, 503, None), (0, 200, "[1]"), (1, 200, "[]"), (1, 200, "[]"), (40, 500, None)]
    pages = spark.createDataFrame(rows, "page BIGINT, status INT, body STRING")
    assert find_end(pages) == PagesEnd(1, 200, "empty")
    assert find_end(pages.where("page <> 1")) == PagesEnd(1, None, "missing")
    assert find_end(pages.where("page > 100")) == PagesEnd(0, None, "missing")
    nothing = spark.createDataFrame([(0, None, "[1]")], "page BIGINT, status INT, body STRING")
    assert find_end(nothing) == PagesEnd(0, None, "refused")
