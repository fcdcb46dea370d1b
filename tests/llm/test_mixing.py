import re

import pytest

from tierlake.llm import mixing
from tierlake.llm.mixing import mix, schedule

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def filled(sizes, weights, epochs):
    """Targets by sharing, stopping and sharing again until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total >= epochs * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        target |= {s: float(epochs * sizes[s]) for s in over}
        left -= sum(target[s] for s in over)
        free -= over
    return target


def summed(result, rows):
    source = {r[0]: r[3] for r in rows}
    taken = {}
    for r in result:
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    return taken


@pytest.mark.parametrize("weights, epochs", [((5, 2, 1), 3), ((1,), 2), ((1000, 1), 3)])
def test_targets_and_limits(docs, rows, weights, epochs):
    documents, manifest = mix(docs, weights, epochs)
    result = documents.collect()
    size = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    assert {r.doc_id: r.size for r in result} == size
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size[r[0]]
    target = filled(sizes, weights, epochs)
    source = {r[0]: r[3] for r in rows}
    for r in result:
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(target[source[r.doc_id]])
        assert r.taken <= epochs * r.size
    for name, words in summed(result, rows).items():
        assert words == round(target[name])
    # The manifest says the same, slot by slot, and no slot holds more than a block.
    assert sum(r.words for r in manifest.collect()) == sum(r.taken for r in result)
    slots = manifest.groupBy("slot").sum("words").collect()
    assert max(r[1] for r in slots) <= 128


def test_any_stretch_of_the_schedule_is_mixed(docs):
    documents, manifest = mix(docs, (3, 1), block=16)
    shares = manifest.groupBy("source_id").sum("words").collect()
    total = sum(r[1] for r in shares)
    head = manifest.where("slot < 1000").groupBy("source_id").sum("words").collect()
    words = sum(r[1] for r in head)
    for r in head:
        share = next(s[1] for s in shares if s.source_id == r.source_id) / total
        assert abs(r[1] / words - share) < 0.02


@pytest.mark.parametrize("chunk", [1, 7, 1024])
def test_slots_of_a_source_are_ranked_in_order(spark, monkeypatch, chunk):
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    targets = spark.createDataFrame([(1, 900.0), (2, 0.0), (3, 300.0)], "source_id int, target double")
    slots = sorted(map(tuple, schedule(targets, 2).select("slot", "source_id", "rank").collect()))
    assert [s for s, _, _ in slots] == list(range(600))
    for source in (1, 3):
        ranks = [rank for _, of, rank in slots if of == source]
        assert ranks == list(range(len(ranks))) and abs(len(ranks) - 150 * (4 - source)) < 3
    assert {of for _, of, _ in slots} == {1, 3}


def test_reruns_agree(docs):
    a, b = (sorted(map(tuple, mix(t)[0].collect())) for t in (docs, docs.repartition(5)))
    assert a == b


def test_repeats_nulls_and_empty(spark, twice, rows, nothing):
    documents, _ = mix(twice)
    result = documents.collect()
    assert len(result) == 2 * len(rows)
    assert all(r.taken <= 3 * r.size for r in result)
    assert mix(nothing)[0].collect() == [] == mix(nothing)[1].collect()
    table = spark.createDataFrame([(None, None, None), (1, " ", "a")], "doc_id long, text string, source string")
    assert {tuple(r)[2:] for r in mix(table)[0].collect()} == {(0, 0, 0.0, 0)}


def test_plan_runs_no_python(docs):
    plan = mix(docs)[0]._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
