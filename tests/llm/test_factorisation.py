import itertools
import zlib

import numpy as np
import pytest

from tierlake.llm.factorisation import Machine, features, fit, flat, logistic, score_quality


def test_squares_identity():
    rng = np.random.default_rng(0)
    machine = Machine(0.3, rng.normal(size=40), rng.normal(size=(40, 5)), np.zeros(0), np.ones(0))
    rows = [
        (rng.choice(40, n, replace=False).astype(np.int32), rng.normal(size=n).astype(np.float32))
        for n in (1, 2, 9, 30)
    ]
    at, x, starts = flat(rows)
    got, _ = machine.raw(at, x, starts)
    for value, (at, x) in zip(got, rows, strict=True):
        want = 0.3 + (machine.linear[at] * x).sum()
        for i, j in itertools.combinations(range(len(at)), 2):
            want += machine.factors[at[i]] @ machine.factors[at[j]] * x[i] * x[j]
        assert value == pytest.approx(want, rel=1e-5)


def test_pairs_are_learnt():
    """Neither word says anything by itself; both together do."""
    rng = np.random.default_rng(1)
    texts, labels = [], []
    for _ in range(2_000):
        a, b = rng.integers(0, 2, 2)
        texts.append(" ".join(["up" if a else "down", "left" if b else "right"]))
        labels.append(float(a == b))
    rows = [features(t, [], 1 << 10) for t in texts]
    machine = fit(rows, np.array(labels), 1 << 10, epochs=40)
    at, values, starts = flat(rows)
    score = logistic(machine.raw(at, machine.scaled(at, values), starts)[0])
    assert ((score > 0.5) == np.array(labels)).mean() > 0.95


def test_held_out_accuracy(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    result = score_quality(docs, labels).join(labels, "doc_id").collect()
    for r in result:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1
    held = [r for r in result if r.held_out]
    assert len(held) > 50
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95


def labelled(spark, rows):
    data = [(r[0], int(r[0] % 4 > 0), 0) for r in rows if r[0] % 5]
    return spark.createDataFrame([*data, (None, 1, 0), (0, None, 0)], "doc_id long, quality int, toxic int")


def test_scores_do_not_see_what_they_must_not(spark, docs, rows):
    labels = labelled(spark, rows)
    one = {r.doc_id: r.score for r in score_quality(docs, labels, ()).collect()}
    # Another language and source change nothing, nor do the labels of the held-out fold.
    other = docs.drop("lang", "source").selectExpr("*", "'xx' as lang", "'yy' as source")
    lies = labels.selectExpr(
        "doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality) as quality"
    )
    assert one == {r.doc_id: r.score for r in score_quality(other, lies, ()).collect()}
    texts = {r[0]: r[1] or "" for r in rows}
    by_text = {}
    for doc_id, score in one.items():
        assert by_text.setdefault(texts[doc_id], score) == score


def test_repeats_nulls_and_empty(spark, docs, twice, rows, nothing):
    labels = labelled(spark, rows)
    result = score_quality(twice, labels).collect()
    assert len(result) == 2 * len(rows)
    assert len({tuple(r) for r in result}) == len(rows)
    assert all(r.score is not None for r in result)
    assert score_quality(nothing, labels).collect() == []
    none = score_quality(docs, labels.limit(0)).collect()
    assert {r.predicted for r in none} == {1}
    same = score_quality(docs, labels.where("quality = 0")).collect()
    assert {r.predicted for r in same} == {0}
    table = spark.createDataFrame([(None, None, None)], "doc_id long, text string, n_chars long")
    assert [(r.doc_id, r.held_out) for r in score_quality(table, labels).collect()] == [(None, False)]
