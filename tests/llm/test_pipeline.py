import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import test_exact_dedup, test_jaccard_join, test_mixing, test_packing
from tests.llm.conftest import SCHEMA
from tierlake.llm.common import stored
from tierlake.llm.factorisation import score_quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def as_rows(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def through(spark, docs, sf_dir):
    """Every stage's input and output, each held against brute force over its own input."""
    steps = []
    for _, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, sf_dir))
        steps.append((docs, out))
        docs = out
    return steps


def check(steps, labels):
    before, after = steps[0]
    rows = as_rows(before)
    scores = {r.doc_id: r.predicted for r in score_quality(before, labels).collect()}
    assert sorted(as_rows(after), key=repr) == sorted((r for r in rows if scores[r[0]]), key=repr)

    before, after = steps[1]
    rows = as_rows(before)
    want = [k for k, v in test_exact_dedup.expected(rows).items() if v[2]]
    assert sorted(r[0] for r in as_rows(after)) == sorted(want)

    before, after = steps[2]
    rows = as_rows(before)
    want = [k for k, (_, c) in test_jaccard_join.expected(rows).items() if c == k]
    assert sorted(as_rows(after)) == sorted(r for r in rows if r[0] in set(want))

    before, after = steps[3]
    rows, mixed = as_rows(before), as_rows(after)
    size = {r[0]: len(test_mixing.WORD.findall(r[1] or "")) for r in rows}
    sizes, taken, longest = {}, {}, {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size[r[0]]
        longest[r[3]] = max(longest.get(r[3], 0), size[r[0]])
    for r in mixed:
        assert r in set(rows)
        taken[r[3]] = taken.get(r[3], 0) + size[r[0]]
    assert max((mixed.count(r) for r in mixed), default=0) <= 3
    for source, target in test_mixing.filled(sizes, (5, 2, 1), 3).items():
        assert abs(taken.get(source, 0) - target) <= longest[source] / 2 + 1

    before, after = steps[4]
    rows = as_rows(before)
    one = {r[0]: r for r in rows}
    tokens = {k: len(test_packing.token_ids(r[1])) for k, r in one.items()}
    pieces = after.collect()
    assert sum(r.length for r in pieces) == sum(tokens[r[0]] for r in rows)
    filled = {}
    for r in pieces:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert max(filled.values()) <= 2048
    assert len(filled) <= sum(filled.values()) / 2048 * 1.05 + 1


def test_stages_over_given_documents(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = through(spark, docs, sf_dir)
    assert all(out.columns == COLUMNS for _, out in steps[:-1])
    check(steps, labels)


@pytest.mark.parametrize("stage", range(5))
def test_stages_over_awkward_tables(spark, docs, twice, nothing, sf_dir, stage):
    run = corpus_pipeline.STAGES[stage][1]
    assert run(spark, nothing, sf_dir).collect() == []
    for table in (docs, twice):
        out = run(spark, table, sf_dir)
        assert stage == 4 or out.columns == table.columns
        assert out.count() > 0
    nulls = spark.createDataFrame([(None, None, None, None, None)] * 2, SCHEMA)
    left = run(spark, nulls, sf_dir).count()
    assert left == {0: left, 1: 1, 2: 2, 3: 0, 4: 2}[stage]


def test_rows_that_share_an_id_are_documents_of_their_own(spark, sf_dir):
    """Every second row takes the id of the row before it; decisions stay those of the rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text IS NOT NULL")
    names = "__doc_id", "__id", "__sha", "row_key", "kept_key", "kept_sha", "taken_key"
    extra = [F.lit(k).alias(name) for k, name in enumerate(names)]
    plain = docs.select(*COLUMNS, *extra).cache()
    # Labels are by id: without them every row would be scored by another machine.
    shared = plain.withColumn("doc_id", F.floor(F.col("doc_id") / 2).cast("long"))

    def texts_of(df):
        return sorted((r.text, r.lang, r.source) for r in df.collect())

    for name, stage in corpus_pipeline.STAGES[1:3]:
        alone, both = stage(spark, plain, sf_dir), stage(spark, shared, sf_dir)
        assert both.columns == shared.columns, name
        # Of copies another one may stay, since ids say which.
        assert len(texts_of(both)) == len(texts_of(alone)) < plain.count()
    mixed = corpus_pipeline.mix(spark, shared, sf_dir)
    assert mixed.columns == shared.columns and mixed.count() > 0
    scored = corpus_pipeline.quality(spark, shared, sf_dir)
    assert scored.columns == shared.columns and 0 < scored.count() < shared.count()


def test_near_copies_under_one_id(spark, sf_dir):
    words = [f"w{k}" for k in range(60)]
    one, two = " ".join(words), " ".join([*words[:-1], "other"])
    rows = [(1, one, "en", "s", 1), (1, two, "en", "s", 1), (1, "another text", "en", "s", 1)]
    table = spark.createDataFrame([*rows, (None, one, "en", "s", 1)], SCHEMA)
    left = corpus_pipeline.near(spark, table, sf_dir).collect()
    assert sorted(r.text == "another text" for r in left) == [False, True]
    assert all(r.doc_id == 1 for r in left)
