"""Publishing: a run replaces the table, a failed run leaves it alone."""

import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark import TaskContext
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake import read_layer, refresh
from tierlake.fs import Files
from tierlake.session import mount
from tierlake.sinks import refresh as sinks
from tierlake.sinks.refresh import staged
from tierlake.sources.layers import list_files

SCHEMA = T.StructType().add("id", "integer").add("k", "string").add("v", "string")


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def content(spark, path):
    return sorted(tuple(r) for r in read_layer(spark, path, SCHEMA).collect())


def files(path):
    return sorted(
        os.path.relpath(os.path.join(folder, name), path)
        for folder, _, names in os.walk(path)
        for name in names
    )


@pytest.mark.parametrize("swap", ["rename", "pointer"])
@pytest.mark.parametrize("partition_by", [None, "k"])
def test_two_runs_equal_one(spark, tmp_path, swap, partition_by):
    path = str(tmp_path / "layer")
    rows = [(1, "a", "x"), (2, "b", "y"), (2, "b", "y")]
    for _ in range(3):
        done = refresh(table(spark, *rows), path, partition_by, swap=swap)
        assert (done.target, done.rows) == (path, 3)
    assert content(spark, path) == rows
    refresh(table(spark, (9, "c", "z")), path, partition_by, swap=swap)
    assert content(spark, path) == [(9, "c", "z")]
    if swap == "rename":
        assert os.listdir(tmp_path) == ["layer"]
    else:
        # The current run and the one before it.
        assert sum(name.startswith("run-") for name in os.listdir(path)) == 2


@pytest.mark.parametrize("swap", ["rename", "pointer"])
def test_a_failed_run_leaves_the_old_rows(spark, tmp_path, swap):
    path = str(tmp_path / "layer")
    refresh(table(spark, (1, "a", "x")), path, swap=swap)
    before = files(tmp_path)
    bad = table(spark, (2, "b", "y")).withColumn("v", F.raise_error(F.lit("no")))
    with pytest.raises(PySparkException):
        refresh(bad, path, swap=swap)
    assert content(spark, path) == [(1, "a", "x")]
    assert files(tmp_path) == before


def test_siblings_with_the_same_prefix_stay(spark, tmp_path):
    refresh(table(spark, (1, "a", "x")), str(tmp_path / "layer2"))
    for n in range(2):
        refresh(table(spark, (n, "a", "x")), str(tmp_path / "layer") + "/")
    assert content(spark, str(tmp_path / "layer2")) == [(1, "a", "x")]


def test_a_table_can_be_rewritten_from_itself(spark, tmp_path):
    path = str(tmp_path / "layer")
    refresh(table(spark, (1, "a", "x")), path)
    old = read_layer(spark, path, SCHEMA)
    refresh(old.union(table(spark, (2, "b", "y"))), path)
    assert content(spark, path) == [(1, "a", "x"), (2, "b", "y")]


def test_only_data_files(spark, tmp_path):
    path = str(tmp_path / "layer")
    refresh(table(spark, (1, "a", "x")), path)
    assert all(name.lstrip(".").startswith("part-") for name in files(path))


class Killed(BaseException):
    """Nothing runs after it, like a process that is gone."""


CALLS = "rename", "delete", "write_text", "make_parent"


@pytest.mark.parametrize("swap", ["rename", "pointer"])
def test_a_kill_between_any_two_calls_leaves_old_or_new_rows(spark, tmp_path, monkeypatch, swap):
    from tierlake.fs import Files

    # What a killed writer leaves counts as another's until its lease is over.
    monkeypatch.setattr(sinks, "SWAP_LEASE", 0.0)
    lease = 0.0
    original = {name: getattr(Files, name) for name in CALLS}
    old, new = [(1, "a", "x")], [(2, "b", "y"), (3, "c", "z")]
    for stop in range(20):
        path = str(tmp_path / f"{swap}{stop}")
        refresh(table(spark, *old), path, swap=swap, lease=lease)
        done = [0]

        def counted(name, limit=stop, done=done):
            def call(self, *args):
                if done[0] >= limit:
                    raise Killed
                done[0] += 1
                return original[name](self, *args)

            return call

        for name in CALLS:
            monkeypatch.setattr(Files, name, counted(name))
        try:
            refresh(table(spark, *new), path, swap=swap, lease=lease)
            finished = True
        except Killed:
            finished = False
        for name in CALLS:
            monkeypatch.setattr(Files, name, original[name])
        assert content(spark, path) in ([new] if finished else [old, new])
        # The next run finds its way, and nothing is left beside the table.
        refresh(table(spark, *new), path, swap=swap, lease=lease)
        assert content(spark, path) == new
        assert [n for n in os.listdir(tmp_path) if n.startswith(f"_{swap}{stop}.")] == []
        if finished:
            return
    raise AssertionError("never finished")


def test_a_broken_pointer_is_an_error(spark, tmp_path):
    path = tmp_path / "layer"
    refresh(table(spark, (1, "a", "x")), str(path), swap="pointer")
    pointer = next(p for p in path.iterdir() if p.name.startswith("_current"))
    assert pointer.read_text() == ""
    (path / "_current").write_text("")
    with pytest.raises(ValueError, match="names no run"):
        content(spark, str(path))
    (path / "_current").unlink()
    pointer.unlink()
    with pytest.raises(FileNotFoundError, match="no pointer"):
        content(spark, str(path))
    (path / f"_current.9.run-{'0' * 32}").write_text("")
    with pytest.raises(FileNotFoundError, match="missing"):
        content(spark, str(path))


def test_unknown_swap(spark, tmp_path):
    with pytest.raises(ValueError), staged(spark, str(tmp_path / "x"), "copy"):
        pass


def test_partition_values(spark, tmp_path):
    path = str(tmp_path / "layer")
    values = ["micro", "", None, "7", "08", "a/b", "a=b", "x y", "é"]
    refresh(table(spark, *[(n, v, "x") for n, v in enumerate(values)]), path, "k")
    # The empty text shares the folder of null and comes back as null.
    assert [r[1] for r in content(spark, path)] == [v or None for v in values]
    assert read_layer(spark, path, SCHEMA).columns == ["id", "k", "v"]
    assert os.path.isdir(os.path.join(path, "k=08"))


def test_reading_without_a_schema(spark, tmp_path):
    path = str(tmp_path / "layer")
    refresh(table(spark, (1, "a", "x"), (2, "08", "y")), path, "k", swap="pointer")
    inferred = read_layer(spark, path)
    assert inferred.columns == ["id", "v", "k"]
    assert {r.k for r in inferred.collect()} == {"a", "08"}


@pytest.mark.parametrize("partition_by", [None, "k"])
def test_empty_tables(spark, tmp_path, partition_by):
    path = str(tmp_path / "layer")
    assert refresh(table(spark), path, partition_by).rows == 0
    assert content(spark, path) == []
    assert refresh(table(spark, (1, "a", "x")).where("id > 1"), path, partition_by).rows == 0


def test_partition_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "layer")
    refresh(table(spark, (1, "a", "x"), (2, "b", "y")), path, "k")
    read = read_layer(spark, path, SCHEMA).where("k = 'a'").select("id")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan and "ReadSchema: struct<id:int>" in plan


def test_a_hot_partition_value_is_split_over_tasks(spark, tmp_path):
    rows = spark.range(0, 400_000, 1, 16).select(
        F.col("id").cast("integer").alias("id"),
        F.when(F.col("id") % 4 == 0, F.concat(F.lit("k"), F.col("id") % 7)).otherwise("hot").alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    path = str(tmp_path / "layer")
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "2m")
    try:
        assert refresh(rows, path, "k").rows == 400_000
    finally:
        spark.conf.set(name, before)
    written = spark.read.parquet(path)
    per_file = written.groupBy("k", F.input_file_name()).count().where("k = 'hot'").collect()
    assert len(per_file) > 4 and max(r["count"] for r in per_file) < 100_000
    assert read_layer(spark, path, SCHEMA).distinct().count() == 400_000


def lose_first_attempts(batches):
    """Pass everything on, but fail the first attempt of each odd task at its end."""
    yield from batches
    context = TaskContext.get()
    if context.attemptNumber() == 0 and context.partitionId() % 2:
        raise RuntimeError("lost")


@pytest.mark.parametrize("partition_by", [None, "k"])
def test_tasks_that_run_again_write_and_count_once(spark, tmp_path, partition_by):
    rows = spark.range(0, 1000, 1, 6).selectExpr(
        "cast(id as int) id", "cast(id % 3 as string) k", "'x' v"
    )
    path = str(tmp_path / "layer")
    flaky = rows.mapInArrow(lose_first_attempts, rows.schema)
    assert refresh(flaky, path, partition_by).rows == 1000
    assert content(spark, path) == sorted(tuple(r) for r in rows.collect())


def shuffles_of(spark, work):
    """How many tasks of ``work`` wrote shuffle data: zero means no shuffle."""
    listed = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("shuffles", "shuffles")
    try:
        work()
        jobs = [listed.getJobInfo(job) for job in listed.getJobIdsForGroup("shuffles")]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return sum(len(job.stageIds) for job in jobs) - len(jobs)


@pytest.mark.parametrize("partition_by, options", [(None, {}), ("k", {"cluster": False})])
def test_no_shuffle_unless_clustering(spark, tmp_path, partition_by, options):
    rows = spark.range(0, 100, 1, 4).selectExpr("cast(id as int) id", "'a' k", "'x' v")
    path = str(tmp_path / "layer")
    assert shuffles_of(spark, lambda: refresh(rows, path, partition_by, **options)) == 0
    folder = os.path.join(path, "k=a") if partition_by else path
    assert sum(name.startswith("part-") for name in os.listdir(folder)) == 4


def test_without_adaptive_execution_nothing_is_clustered(spark, tmp_path):
    rows = spark.range(0, 100, 1, 4).selectExpr("cast(id as int) id", "'a' k", "'x' v")
    path = str(tmp_path / "layer")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert refresh(rows, path, "k").rows == 100
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(content(spark, path)) == 100


def test_partition_column_with_a_dot(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "id INT, `a.b` STRING")
    path = str(tmp_path / "layer")
    refresh(rows, path, "a.b")
    assert sorted(map(tuple, read_layer(spark, path, rows.schema).collect())) == [(1, "x"), (2, "y")]


def test_file_size_limit(spark, tmp_path):
    path = str(tmp_path / "layer")
    refresh(spark.range(0, 100, 1, 1), path, max_records=30)
    assert sum(name.startswith("part-") for name in files(path)) == 4


@pytest.mark.parametrize("swap", ["rename", "pointer"])
def test_concurrent_writers_leave_one_whole_table(spark, tmp_path, swap):
    path = str(tmp_path / "layer")
    tables = [table(spark, *[(k, f"w{w}", "x") for k in range(40)]) for w in range(5)]
    with ThreadPoolExecutor(5) as writers:
        done = list(writers.map(lambda df: refresh(df, path, swap=swap), tables * 2))
    assert [d.rows for d in done] == [40] * 10
    rows = content(spark, path)
    assert len({k for _, k, _ in rows}) == 1 and [i for i, _, _ in rows] == list(range(40))
    # A writer may clear only what no other is at work on; now nobody is.
    refresh(tables[0], path, swap=swap, lease=0)
    left = os.listdir(path if swap == "pointer" else tmp_path)
    if swap == "rename":
        assert left == ["layer"]
    else:
        left = sorted(name[:4] for name in left if name[0] != ".")
        assert left == ["_cur", "_cur", "run-", "run-"]


def test_a_number_belongs_to_one_writer(spark, tmp_path):
    files = Files(spark)
    with ThreadPoolExecutor(8) as callers:
        made = list(callers.map(lambda _: files.create_new(str(tmp_path / "x")), range(24)))
    assert sum(made) == 1
    assert files.age(str(tmp_path / "x")) < 60 and files.age(str(tmp_path / "y")) == float("inf")


@pytest.mark.parametrize("swap", ["rename", "pointer"])
def test_an_unpublished_run_stays_until_its_lease_is_over(spark, tmp_path, swap):
    path = tmp_path / "layer"
    name = f"_layer.new-{'a' * 32}" if swap == "rename" else f"layer/run-{'a' * 32}"
    refresh(table(spark, (1, "a", "x")), str(path), swap=swap)
    (tmp_path / name).mkdir()
    (tmp_path / name / "part-0.parquet").write_text("half written")
    refresh(table(spark, (2, "a", "x")), str(path), swap=swap)
    assert (tmp_path / name).exists()
    refresh(table(spark, (3, "a", "x")), str(path), swap=swap, lease=0)
    assert not (tmp_path / name).exists()
    assert content(spark, str(path)) == [(3, "a", "x")]


def test_a_lock_is_waited_for_and_an_old_one_replaced(spark, tmp_path, monkeypatch):
    path, lock = str(tmp_path / "layer"), tmp_path / "_layer.lock-3"
    lock.write_text("")
    with ThreadPoolExecutor(1) as writers:
        waiting = writers.submit(refresh, table(spark, (1, "a", "x")), path)
        time.sleep(4)
        assert not os.path.exists(path)
        lock.unlink()
        assert waiting.result(60).rows == 1
    lock.write_text("")
    monkeypatch.setattr(sinks, "SWAP_LEASE", 0.0)
    refresh(table(spark, (2, "a", "x")), path)
    assert content(spark, path) == [(2, "a", "x")] and os.listdir(tmp_path) == ["layer"]


def test_a_late_pointer_does_not_win(spark, tmp_path):
    """Who claimed a number first and publishes last finds a newer table and leaves it."""
    path, files = str(tmp_path / "layer"), Files(spark)
    refresh(table(spark, (1, "a", "x")), path, swap="pointer")
    slow = f"run-{'b' * 32}"
    assert files.create_new(f"{path}/_claim.2")
    refresh(table(spark, (2, "a", "x")), path, swap="pointer")
    os.mkdir(f"{path}/{slow}")
    files.write_text(f"{path}/_current.2.{slow}", "")
    assert content(spark, path) == [(2, "a", "x")]
    refresh(table(spark, (3, "a", "x")), path, swap="pointer")
    assert content(spark, path) == [(3, "a", "x")] and slow not in os.listdir(path)


@pytest.fixture
def advised(spark):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield 32 << 10
    for name, value in before.items():
        spark.conf.set(name, value)


def test_a_hot_value_read_by_one_task_is_written_by_many(spark, tmp_path, advised):
    path = str(tmp_path / "layer")
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None)
    key = key.otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    rows = spark.range(0, 24_000, 1, 1).select(
        F.col("id").cast("int"), key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    assert rows.rdd.getNumPartitions() == 1
    assert refresh(rows, path, "k").rows == 24_000
    by_folder = {}
    for name in files(path):
        if name.endswith(".parquet"):
            by_folder.setdefault(name.split("/")[0], []).append(name)
    # 8,000 rows of about 70 bytes each.
    assert len(by_folder["k=hot"]) >= 6 and len(by_folder["k=__HIVE_DEFAULT_PARTITION__"]) >= 6
    assert all(len(v) == 1 for k, v in by_folder.items() if k.startswith("k=k"))
    back = read_layer(spark, path, SCHEMA)
    assert back.exceptAll(rows).isEmpty() and back.count() == 24_000


def test_clashing_names_and_types_cluster_too(spark, tmp_path, advised):
    rows = spark.range(0, 4_000, 1, 1).select(
        "id", F.lit("x").alias("value"), F.lit(1).alias("parts"), F.lit(2).alias("salt"),
        F.map_from_arrays(F.array(F.lit("a")), F.array("id")).alias("m"),
        F.array(F.col("id")).alias("a.b"), F.struct("id").alias("s"),
        F.parse_json(F.lit('{"a": 1}')).alias("j"), F.lit(b"\1\2").alias("b"),
    )
    refresh(rows, str(tmp_path / "layer"), "value")
    assert spark.read.parquet(str(tmp_path / "layer")).count() == 4_000
    assert len(files(tmp_path / "layer" / "value=x")) > 1


@pytest.mark.parametrize("swap", ["rename", "pointer"])
def test_small_files_are_packed_by_their_bytes(spark, tmp_path, swap):
    path, wanted = str(tmp_path / "layer"), 400_000
    text = F.concat_ws(" ", *(F.sha2((F.col("id") * k).cast("string"), 512) for k in range(1, 20)))
    rows = spark.range(0, 3_000, 1, 300).select(F.col("id").cast("int"), F.lit("a").alias("k"), text.alias("v"))
    assert refresh(rows, path, file_bytes=wanted, swap=swap).rows == 3_000
    sizes = [r.bytes for r in list_files(spark, path).where("is_data").collect()]
    assert 3 < len(sizes) < 30 and sum(size > 0.6 * wanted for size in sizes) >= len(sizes) - 2
    assert max(sizes) < 1.5 * wanted
    back = read_layer(spark, path, SCHEMA)
    assert back.count() == 3_000 and back.distinct().count() == 3_000
    # Files of the right size already are left as they are; no settings have changed.
    few = rows.coalesce(1)
    assert refresh(few, path, file_bytes=1 << 30, swap=swap).rows == 3_000
    assert list_files(spark, path).count() == 1
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(wanted)
    with pytest.raises(ValueError):
        refresh(rows, path, "k", file_bytes=wanted)


def test_empty_tables_are_packed(spark, tmp_path):
    assert refresh(table(spark), str(tmp_path / "x"), file_bytes=1_000).rows == 0
    assert content(spark, str(tmp_path / "x")) == []


def test_the_files_of_a_table_as_rows(spark, tmp_path):
    path = str(tmp_path / "layer")
    for n in range(2):
        refresh(table(spark, (n, "a", "x")).coalesce(1), path, swap="pointer")
    (found,) = list_files(spark, path).collect()
    assert found.is_data and found.path.startswith("part-") and found.bytes > 100
    every = list_files(spark, path, every_run=True).collect()
    assert len(every) == 4 and sum(not r.is_data for r in every) == 2  # runs and pointers
    assert all(r.path.startswith("_current.") for r in every if not r.is_data)
    spark.createDataFrame([(1,)], "a int").write.parquet(str(tmp_path / "marked"))
    assert not list_files(spark, str(tmp_path / "marked")).where("path = '_SUCCESS' AND is_data").count()
    assert list_files(spark, str(tmp_path / "marked")).where("NOT is_data").count() == 1
    assert list_files(spark, str(tmp_path / "none")).collect() == []


def test_layers_on_a_mount(spark, tmp_path):
    lake = mount(spark, {"/lake": f"file://{tmp_path}/store"})
    for swap in ("rename", "pointer"):
        path = f"{lake}/lake/{swap}"
        for n in range(3):
            refresh(table(spark, (n, "a", "x"), (n, None, "y")), path, "k", swap=swap, lease=0)
        assert [r[0] for r in content_by_id(spark, path)] == [2, 2]
        assert list_files(spark, path).where("is_data").count() == 2
    assert sorted(os.listdir(tmp_path / "store")) == ["pointer", "rename"]


def content_by_id(spark, path):
    return sorted(read_layer(spark, path, SCHEMA).collect(), key=lambda r: r[0])
