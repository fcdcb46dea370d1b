import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierlake.llm import jaccard_join
from tierlake.llm.components import components
from tierlake.llm.jaccard_join import (
    SKETCH_BITS,
    Shingler,
    jaccard_components,
    keys_of,
    mixed,
    pair_keys_of,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=5):
    words = WORD.findall((text or "").translate(LOWER))
    size = min(width, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set()


def grouped(nodes, links):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


def expected(rows, width=5, percent=80):
    sets = {r[0]: shingles(r[1], width) for r in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for i, a in enumerate(ids)
        for b in ids[i + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return {d: (len(sets[d]), c) for d, c in grouped(ids, links).items()}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def family(rng, copies, words=150):
    """Copies of one text, each with a few words changed."""
    base = [f"v{rng.randrange(300)}" for _ in range(words)]
    out = []
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randrange(5)):
            text[rng.randrange(words)] = f"z{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.fixture(scope="module")
def near(rows):
    rng = random.Random(9)
    more = [t for _ in range(4) for t in family(rng, 25)] + family(rng, 6, 6) + family(rng, 6, 9)
    common = " ".join(f"c{k}" for k in range(60))
    more += [common + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(40)) for _ in range(30)]
    more += ["a b c d e f g h", "a b c d e f g h i", "b c d e f g h i"]
    return rows + [(1000 + k, t, "en", "s1", 1) for k, t in enumerate(more)]


def table_of(spark, rows):
    return spark.createDataFrame(
        [tuple(r) for r in rows], "doc_id long, text string, lang string, source string, n_chars long"
    )


@pytest.mark.parametrize("frequent", [64, 1])
def test_matches_brute_force(spark, near, monkeypatch, frequent):
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    assert found(jaccard_components(table_of(spark, near))) == expected(near)


def test_one_round_and_shuffled_texts(spark, near, monkeypatch):
    monkeypatch.setattr(jaccard_join, "STARS", 1)
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    assert found(jaccard_components(table_of(spark, near))) == expected(near)


@pytest.mark.parametrize("hot", [0, 1, 8])
def test_large_groups_are_keyed_by_pairs(spark, near, monkeypatch, hot):
    # A sketch that tells no token from another.
    monkeypatch.setattr(jaccard_join, "FREQUENT", 10**6)
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    assert found(jaccard_components(table_of(spark, near))) == expected(near)


def test_other_threshold(spark, near):
    width, percent = 2, 60
    some = near[::3]
    result = jaccard_components(table_of(spark, some), width, percent)
    assert found(result) == expected(some, width, percent)


def test_clashing_columns(docs, rows):
    assert found(jaccard_components(docs)) == expected(rows)


def test_repeats_nulls_and_empty(spark, twice, rows, nothing):
    result = jaccard_components(twice)
    assert result.count() == 2 * len(rows)
    assert found(result) == expected(rows)
    assert jaccard_components(nothing).collect() == []
    data = [(None, "a b c"), (5, "A b c"), (4, None), (3, "a  b\tc")]
    table = spark.createDataFrame(data, "doc_id long, text string")
    assert {tuple(r) for r in jaccard_components(table).collect()} == {
        (None, 1, None), (5, 1, 3), (4, 0, 4), (3, 1, 3)
    }


@settings(max_examples=400, deadline=None)
@given(
    st.integers(4, 120), st.integers(0, 30), st.integers(0, 30), st.integers(0, 2**32),
    st.sampled_from([50, 80, 95]), st.sampled_from([0, 2, 5, 1000]),
)
def test_similar_sets_share_a_key(common, left, right, seed, percent, frequent):
    rng = np.random.default_rng(seed)
    universe = np.unique(mixed(rng.integers(0, 2**63, common + left + right, dtype=np.uint64)))
    x = np.sort(np.concatenate([universe[:common], universe[common : common + left]]))
    y = np.sort(np.concatenate([universe[:common], universe[common + left :]]))
    if 100 * common < percent * len(universe) or (len(x) == len(y) == common):
        return
    sketch = rng.integers(0, 9, 1 << 12).astype("<u4").repeat(1 << (SKETCH_BITS - 12))
    (kx, rx), (ky, ry) = (keys_of(s, sketch, frequent, percent) for s in (x, y))
    overlap = -(-percent * (len(x) + len(y)) // (100 + percent))
    assert np.intersect1d(kx[rx >= overlap], ky[ry >= overlap]).size
    (kx, rx), (ky, ry) = (pair_keys_of(s, sketch, percent) for s in (x, y))
    assert np.intersect1d(kx[rx >= overlap], ky[ry >= overlap]).size


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text("ab \nÄ", max_size=40), max_size=12), st.integers(1, 6))
def test_texts_together_give_what_each_gives(batch, width):
    tokens, place = Shingler(width).together(batch)
    assert len(place) == len(batch) + 1
    for k, text in enumerate(batch):
        own = tokens[place[k] : place[k + 1]]
        assert (own == Shingler(width)(text)).all() and (own[1:] > own[:-1]).all()
        assert len(own) == len(shingles(text, width))


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)]
    links += [(k, k + 1) for k in range(1000, 1020)] + [(2000, k) for k in range(2001, 2050)]
    links += [(b, a) for a, b in links[:20]]
    nodes = {n for a, b in links for n in (a, b) if a != b}
    want = grouped({n for link in links for n in link}, links)
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == {n: want[n] for n in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("block_bits", [4, 16])
def test_sketch_counts_all_tokens(spark, near, monkeypatch, block_bits):
    monkeypatch.setattr(jaccard_join, "BLOCK_BITS", block_bits)
    monkeypatch.setattr(jaccard_join, "SKETCH_BITS", max(10, block_bits))
    rows = table_of(spark, near * 3).repartition(5)
    sketch, mean = jaccard_join.token_sketch(rows, 5)
    want = np.zeros(1 << jaccard_join.SKETCH_BITS, dtype=np.int64)
    for r in near:
        tokens = jaccard_join.Shingler(5)(r[1])
        np.add.at(want, (tokens >> np.uint64(64 - jaccard_join.SKETCH_BITS)).astype(int), 3)
    assert (sketch == want).all() and mean == pytest.approx(want.mean())
