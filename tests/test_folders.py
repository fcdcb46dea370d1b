"""Page files in local folders: the rows of Spark's text source, in tasks of many files."""

import gzip
import subprocess
import sys
from collections import Counter

import pytest
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tierlake import catalog, read_page_files
from tierlake.sources import folders

FLAT = {"0.json": b"[1]", "1.json": b"\xef\xbb\xbf[\xff]\r\n", "2.json": "[\"é\"]\n\n".encode()}
NESTED = {"page=0/a.txt": b"[0]\n", "page=1/a.txt": b"[1]\n", "page=1/b.txt": b"[]", "page=x/a": b"x"}
HIDDEN = {"_SUCCESS": b"x", ".0.json.crc": b"no sums", "3.json": b"", "_k=4.json": b"4"}

# Read by the tasks, and left to Spark's source.
PLAIN = {
    "flat": FLAT | HIDDEN,
    "nested": NESTED | {"page=5/_h": b"x", "page=6/e": b"", "_h/a": b"x", ".h/a": b"x"},
    "not page": {"n=1/a": b"1", "n=__HIVE_DEFAULT_PARTITION__/a": b"2"},
}
ODD = {
    "packed": FLAT | {"7.json.gz": gzip.compress(b"[7]")},
    "folder beside files": FLAT | {"sub/8.json": b"8"},
    "file beside folders": NESTED | {"9.json": b"9"},
    "deeper": NESTED | {"page=2/s/a": b"2"},
    "two deep": {"page=1/b=1/a": b"1", "page=1/b=2/a": b"2"},
    "packed inside": NESTED | {"page=2/a.gz": gzip.compress(b"[2]")},
    "name not as in a URI": FLAT | {"a b%20c.json": b"x"},
    "case of the key": {"page=1/a": b"1", "Page=2/a": b"2"},
    "metadata": FLAT | {"_metadata_1": b"x"},
    "empty": {},
}


def put(folder, files):
    for name, content in files.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(content)
    return str(folder)


def rows(files):
    return Counter(map(tuple, files.select("path", F.hex(F.col("value").cast("binary"))).collect()))


def by_spark(spark, path):
    text = spark.read.text(path, wholetext=True)
    return rows(text.select(F.col("_metadata.file_path").alias("path"), "value"))


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
@pytest.mark.parametrize("name", PLAIN)
def test_rows_of_plain_folders(spark, tmp_path, name, scheme):
    path = scheme + put(tmp_path / "in", PLAIN[name]) + "/" * bool(scheme)
    found = folders.read_folder(spark, path)
    assert found.dtypes == [("path", "string"), ("value", "string")]
    assert rows(found) == by_spark(spark, path)


@pytest.mark.parametrize("name", ODD)
def test_other_folders_are_left_to_spark(spark, tmp_path, name):
    path = put(tmp_path / "in", ODD[name] or {"_h": b""})
    assert folders.read_folder(spark, path) is None
    read = read_page_files(spark, path, r"/in(.*)()$").count()
    assert read == by_spark(spark, path).total()


def test_other_paths_are_left_to_spark(spark, tmp_path):
    path = put(tmp_path / "in", FLAT)
    for other in (f"{path}/0.json", f"{path}/*", f"{path}/../in", f"{path}-", "hdfs://nowhere/in", "in"):
        assert folders.read_folder(spark, other) is None
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", "true")
    try:
        assert folders.read_folder(spark, path) is None
    finally:
        spark.conf.unset("spark.sql.files.ignoreCorruptFiles")


def test_many_page_files_are_few_tasks(spark, tmp_path):
    """Spark's source gives a task some 32 files."""
    path = put(tmp_path / "in", {f"page={n}/body.txt": b"[%d]" % n for n in range(600)})
    pages = read_page_files(spark, path, r"/page=(\d+)/")
    assert pages.rdd.getNumPartitions() == 1
    assert sorted((p.page, p.status, p.body) for p in pages.collect()) == [
        (n, 200, f"[{n}]") for n in range(600)
    ]


def test_large_files_are_dealt_out(spark, tmp_path):
    path = put(tmp_path / "in", {f"{n}.json": b"x" * 1000 for n in range(300)})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000b")
    try:
        pages = read_page_files(spark, path)
        assert pages.rdd.getNumPartitions() == 3 and pages.distinct().count() == 300
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_checksums_beside_files_count(spark, tmp_path):
    path = tmp_path / "in"
    text = spark.range(3).select("id", F.repeat(F.lit("body"), 400).alias("value"))
    text.write.partitionBy("id").text(str(path))
    assert rows(folders.read_folder(spark, str(path))) == by_spark(spark, str(path))
    changed = next(path.glob("id=1/part-*"))
    changed.write_bytes(changed.read_bytes().replace(b"y", b"z"))
    with pytest.raises(PySparkException, match="Checksum error"):
        read_page_files(spark, str(path), r"/id=(\d+)/").collect()


def test_workers_need_no_copy_of_the_package():
    for task in (folders._sizes("/in", True), folders._contents("/in", True)):
        load = "import pickle, sys; pickle.load(sys.stdin.buffer)"
        subprocess.run([sys.executable, "-I", "-c", load], input=cloudpickle.dumps(task), check=True)


def test_a_folder_with_one_file_per_page(spark, tmp_path):
    pages = spark.createDataFrame([(n, f'["é{n}"]') for n in range(40)], "page BIGINT, body STRING")
    catalog.page_folders(pages, f"file://{tmp_path}/files")
    made = {f.relative_to(tmp_path / "files") for f in tmp_path.rglob("*") if f.is_file()}
    assert len(made) == 40 and not [f for f in made if f.name.endswith(".crc")]
    read = read_page_files(spark, f"{tmp_path}/files", r"/page=(\d+)/").select("page", "body")
    assert sorted(map(tuple, read.collect())) == [(n, f'["é{n}"]\n') for n in range(40)]
