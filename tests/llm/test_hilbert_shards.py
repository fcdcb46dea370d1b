import itertools
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tierlake.llm.hilbert_shards import cell, hilbert_index, hilbert_shards, text_cuts


@pytest.mark.parametrize("dims, bits", [(2, 1), (2, 4), (3, 2), (4, 1)])
def test_curve_visits_neighbours(spark, dims, bits):
    side = 1 << bits
    grid = list(itertools.product(range(side), repeat=dims))
    names = [f"x{k}" for k in range(dims)]
    table = spark.createDataFrame(grid, ", ".join(f"{n} int" for n in names))
    along = table.withColumn("h", hilbert_index([F.col(n) for n in names], bits)).orderBy("h")
    path = [tuple(r) for r in along.collect()]
    assert [p[-1] for p in path] == list(range(side**dims))
    for a, b in itertools.pairwise(path):
        assert sum(abs(x - y) for x, y in zip(a[:-1], b[:-1], strict=True)) == 1


@pytest.mark.parametrize("shards", [1, 5, 24, 200])
def test_shards_are_runs_of_equal_counts(docs, rows, shards):
    result = hilbert_shards(docs, shards).collect()
    assert sorted(r.doc_id for r in result) == sorted(r[0] for r in rows)
    text = {r[0]: (r[1] or "").encode() for r in rows}
    by_shard = {s: [] for s in range(shards)}
    for r in result:
        assert (r.size, r.text_crc32) == (len(text[r.doc_id]) + 8, zlib.crc32(text[r.doc_id]))
        assert (r.law, r.grown_shard) == ("rows", None)
        by_shard[r.shard].append((r.slot, r.curve, r.doc_id))
    sizes = [len(v) for v in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1
    order = []
    for slots in by_shard.values():
        assert sorted(s for s, *_ in slots) == list(range(len(slots)))
        order += [(c, d) for _, c, d in sorted(slots)]
    assert order == sorted(order)


def test_repeats_ties_nulls_and_empty(spark, twice, rows, nothing):
    assert hilbert_shards(twice).count() == 2 * len(rows)
    assert hilbert_shards(nothing).collect() == []
    table = spark.createDataFrame(
        [(None, None, None, None)] * 7, "doc_id long, text string, lang string, source string"
    )
    result = hilbert_shards(table, 3).collect()
    assert sorted((r.shard, r.slot) for r in result) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (2, 0), (2, 1)]


def test_pruning(spark):
    """A shard spans a small part of every dimension."""
    table = spark.range(4096).selectExpr(
        "id as doc_id", "'' as text", "id % 64 as x", "id div 64 as y"
    )
    result = hilbert_shards(table, 16, dims=("x", "y")).join(table, "doc_id")
    spans = result.groupBy("shard").agg(
        (F.max("x") - F.min("x")).alias("x"), (F.max("y") - F.min("y")).alias("y")
    )
    assert all(r.x < 40 and r.y < 40 for r in spans.collect())


def test_plan_runs_no_python(docs):
    plan = hilbert_shards(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_texts_are_cut_at_shares_of_rows_by_whole_values(spark):
    """Sources that begin alike fall into cells of their own, where brute force puts them."""
    rng = random.Random(4)
    names = [f"https://host{k:02}.example/very/long" for k in range(40)] + ["", "é", None]
    values = [names[min(int(rng.expovariate(0.1)), 42)] for _ in range(3_000)]
    df = spark.createDataFrame([(v,) for v in values], "s string").repartition(5)
    shares = [k / 16 for k in range(1, 16)]
    known = sorted(v.encode() for v in values if v is not None)
    want = [known[math.ceil(len(known) * share) - 1].decode() for share in shares]
    cuts = text_cuts(df, "s", shares)
    assert cuts == want and len(set(cuts)) > 8
    cells = {r.s: r.c for r in df.select("s", cell(df.s, cuts).alias("c")).distinct().collect()}
    for value, found in cells.items():
        assert found == sum(value is not None and value.encode() >= c.encode() for c in want)
    assert text_cuts(df.where("s IS NULL"), "s", shares) == []


def test_sources_with_one_beginning_are_pruned(spark):
    rows = [(k, "x" * (k % 50), "en", f"https://{k % 16:02}.example", 1) for k in range(1_600)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = hilbert_shards(table).join(table, "doc_id").groupBy("shard").agg(F.countDistinct("source").alias("n"))
    assert max(r.n for r in found.collect()) < 12
