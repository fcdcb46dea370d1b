"""The layered job end to end, on the 16-column example records."""

import json
import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from tierlake import Medallion, read_layer, run, with_empty_flag
from tierlake.__main__ import main
from tierlake.config import azure_settings, load_job, setting
from tierlake.operators.pages import PagesEnd, UnfinishedPages
from tierlake.plans.medallion import row_counts
from tierlake.sources.layers import list_files

EXAMPLE = os.path.join(os.path.dirname(__file__), "..", "examples", "breweries.json")

RECORDS = [
    [
        {"id": "1", "name": "A", "brewery_type": "micro", "city": "Oslo", "longitude": "10.5",
         "latitude": 59.9, "unknown": 1},
        {"id": "2", "name": "B", "brewery_type": "micro", "city": "Oslo", "longitude": 0},
        {"id": None, "name": "C", "brewery_type": None, "city": "", "longitude": "n/a"},
    ],
    [
        {"id": "2", "name": "B", "brewery_type": "micro", "city": "Oslo", "longitude": "nan"},
        {"id": "4", "brewery_type": "", "state_province": "Vest", "postal_code": 5003},
    ],
]


@pytest.fixture
def job(spark, tmp_path) -> Medallion:
    return load_job(EXAMPLE, {"LAKE": str(tmp_path)})


def land(spark, job, bodies, mode="overwrite"):
    rows = [(page, 200, body) for page, body in enumerate(bodies)]
    pages = spark.createDataFrame(rows, "page BIGINT, status INT, body STRING")
    with_empty_flag(pages).write.mode(mode).parquet(job.pages)


def good_bodies():
    return [*map(json.dumps, RECORDS), "[]", json.dumps(RECORDS[0])]


def gold(spark, job):
    return {tuple(r) for r in read_layer(spark, job.gold, job.gold_schema).collect()}


EXPECTED = {
    ("micro", "Oslo", "TBD", 3),
    ("TBD", "", "TBD", 1),
    # The empty text comes back from its folder as null.
    (None, "TBD", "Vest", 1),
}


@pytest.mark.parametrize("swap", ["rename", "pointer"])
def test_layers(spark, job, swap):
    job = Medallion(**{**vars(job), "swap": swap})
    land(spark, job, good_bodies())
    for _ in range(2):
        done = run(spark, job)
        assert {layer: result.rows for layer, result in done.items()} == {
            "bronze": 5, "silver": 5, "gold": 3,
        }
        assert gold(spark, job) == EXPECTED
    assert {tuple(r) for r in row_counts(spark, done).collect()} == {
        ("bronze", 5), ("silver", 5), ("gold", 3),
    }
    bronze = {
        (r.id, r.longitude if r.longitude == r.longitude else "nan", r.postal_code)
        for r in read_layer(spark, job.bronze, job.schema).collect()
    }
    assert bronze == {
        ("1", 10.5, None), ("2", None, None), (None, None, None), ("2", "nan", None),
        ("4", None, "5003"),
    }
    silver = read_layer(spark, job.silver, job.silver_schema)
    assert silver.columns == job.schema.names
    assert silver.where("longitude = -1.0").count() == 3
    assert silver.where("id = 'TBD'").count() == 1


def test_a_malformed_page_leaves_all_layers(spark, job):
    land(spark, job, good_bodies())
    run(spark, job)
    land(spark, job, [json.dumps(RECORDS[0]), '{"error": "busy"}', "[]"])
    with pytest.raises(Py4JJavaError):
        run(spark, job)
    assert gold(spark, job) == EXPECTED
    assert read_layer(spark, job.bronze, job.schema).count() == 5


def test_the_end_is_reported_and_enforced(spark, job, caplog):
    land(spark, job, good_bodies())
    assert run(spark, job)["bronze"].end == PagesEnd(2, 200, "empty")
    land(spark, job, good_bodies()[:2])
    strict = Medallion(**{**vars(job), "on_bad_page": "fail"})
    with pytest.raises(UnfinishedPages, match="page 2 is missing"):
        run(spark, strict)
    assert gold(spark, job) == EXPECTED
    assert run(spark, job)["bronze"].end == PagesEnd(2, None, "missing")
    assert "pages end at 2: missing" in caplog.text


def test_json_lines_are_read_once(spark, job, monkeypatch):
    rows = [json.dumps({"page": k, "status": 200, "body": b}) for k, b in enumerate(good_bodies())]
    os.makedirs(job.pages)
    with open(os.path.join(job.pages, "p.json"), "w") as file:
        file.write("\n".join(rows))
    job = Medallion(**{**vars(job), "page_format": "json"})
    plans = []
    original = Medallion.bronze_frame

    def kept(self, pages, end=None):
        frame = original(self, pages, end)
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return frame

    monkeypatch.setattr(Medallion, "bronze_frame", kept)
    assert run(spark, job)["bronze"].rows == 5
    assert gold(spark, job) == EXPECTED
    # Bronze comes from the flagged table alone, which is gone afterwards.
    assert "FileScan json" not in plans[0] and plans[0].count("FileScan parquet") == 1
    assert "LessThan(page,2)" in plans[0]
    assert [n for n in os.listdir(os.path.dirname(job.bronze)) if n.startswith("_")] == []
    with open(os.path.join(job.pages, "p.json"), "a") as file:
        file.write('\n{"page": 9, "sta')
    with pytest.raises((PySparkException, Py4JJavaError)):
        run(spark, job)
    assert gold(spark, job) == EXPECTED


def test_no_pages_give_empty_layers(spark, job):
    land(spark, job, ["[]"])
    assert {layer: result.rows for layer, result in run(spark, job).items()} == {
        "bronze": 0, "silver": 0, "gold": 0,
    }
    assert gold(spark, job) == set()


def test_projection_and_layer_choice(spark, job):
    land(spark, job, good_bodies())
    job = Medallion(**{**vars(job), "columns": ["id", "brewery_type", "city", "state_province"]})
    run(spark, job, ["bronze"])
    assert set(run(spark, job, ["silver"])) == {"silver"}
    assert read_layer(spark, job.silver, job.silver_schema).columns == list(job.columns)
    run(spark, job, ["gold"])
    assert gold(spark, job) == EXPECTED
    with pytest.raises(ValueError, match="platinum"):
        run(spark, job, ["platinum"])


def test_plans(spark, job):
    land(spark, job, good_bodies())
    run(spark, job)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    silver = plan(job.silver_frame(read_layer(spark, job.bronze, job.schema)))
    assert "Exchange" not in silver and silver.count("Project") == 1
    gold = plan(job.gold_frame(read_layer(spark, job.silver, job.silver_schema)))
    assert gold.count("Exchange") == 1 and "partial_count" in gold
    # The partition column comes from the folder names.
    assert "ReadSchema: struct<id:string,city:string,state_province:string>" in gold


def test_command_line(spark, job, tmp_path, capfd, monkeypatch):
    land(spark, job, good_bodies())
    monkeypatch.setenv("LAKE", str(tmp_path))
    main(["run", "--job", EXAMPLE, "--preview"])
    assert gold(spark, job) == EXPECTED
    assert "brewery_count" in capfd.readouterr().out


def test_settings():
    assert setting("A", "x", {"A": ""}) == "x" and setting("A", "x", {"A": "y"}) == "y"
    assert azure_settings("acct", "k") == {
        "spark.hadoop.fs.azure.account.key.acct.blob.core.windows.net": "k"
    }


def test_job_file_needs_its_variables(spark):
    with pytest.raises(KeyError, match="LAKE"):
        load_job(EXAMPLE, {"LAKE": ""})


def test_layers_of_packed_files(spark, job):
    pages = [json.dumps([{"id": f"{p}-{k}", "brewery_type": "micro"} for k in range(50)]) for p in range(60)]
    rows = [(p, 200, body) for p, body in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page BIGINT, status INT, body STRING")
    with_empty_flag(frame).repartition(30).write.option("maxRecordsPerFile", 1).parquet(job.pages)
    job = Medallion(**{**vars(job), "file_bytes": 1 << 20, "max_records": 100})
    done = run(spark, job)
    assert done["bronze"].rows == done["silver"].rows == 3_000
    # Files of at most 100 records were packed, and cut again by records.
    files = list_files(spark, job.bronze).where("is_data")
    assert files.count() == 30 and read_layer(spark, job.bronze, job.schema).count() == 3_000
    job = Medallion(**{**vars(job), "max_records": None, "partition_by": None})
    run(spark, job)
    assert list_files(spark, job.silver).where("is_data").count() == 1
    assert gold(spark, job) == {("micro", "TBD", "TBD", 3_000)}


def test_command_line_lands_and_runs_on_a_mount(spark, job, tmp_path, monkeypatch):
    for page, body in enumerate([*map(json.dumps, RECORDS), *["[]"] * 70]):
        (tmp_path / f"{page}.json").write_text(body)
    monkeypatch.setenv("LAKE", "viewfs://lake/here")
    link = ["--job", EXAMPLE, "--mount", f"/here=file://{tmp_path}/there"]
    main(["land", *link, "--url", f"file://{tmp_path}/{{page}}.json", "--rate", "500"])
    main(["run", *link])
    there = load_job(EXAMPLE, {"LAKE": f"{tmp_path}/there"})
    assert gold(spark, there) == EXPECTED
    with pytest.raises(SystemExit):
        main(["run", "--job", EXAMPLE, "--mount", "here"])
