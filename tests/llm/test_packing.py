import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tierlake.llm.packing import best_two, pack, plan_patterns
from tierlake.llm.vocabularies import BYTE_BPE, byte_bpe_ids


def token_ids(text):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def check(result, rows, size, copies=1):
    ids = {r[0]: token_ids(r[1]) for r in rows}
    pieces, sequences = {}, {}
    for r in result:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == ids.keys()
    for doc_id, held in pieces.items():
        all_ids, at = ids[doc_id], 0
        held.sort(key=lambda r: r.piece)
        assert len(held) == copies * -(-len(all_ids) // size)
        for number, r in enumerate(held[::copies]):
            part = np.array(all_ids[r.start : r.start + r.length], dtype="<u4")
            assert (r.piece, r.start, len(part)) == (number, at, r.length)
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
            assert number == 0 or r.length == size
            at += r.length
        assert at == len(all_ids)
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(sequences), sum(map(len, ids.values())) * copies


@pytest.mark.parametrize("size", [2048, 300, 17, 1])
def test_pieces_and_sequences(docs, rows, size):
    count, tokens = check(pack(docs, size).collect(), rows, size)
    assert count <= -(-tokens // size) * 1.02 + 1


def test_repeats_nulls_and_empty(spark, twice, rows, nothing):
    check(pack(twice).collect(), rows, 2048, copies=2)
    assert pack(nothing).collect() == []
    table = spark.createDataFrame([(None, None)], "doc_id long, text string")
    assert [tuple(r)[:4] for r in pack(table).collect()] == [(None, 0, 0, 1)]


END_OF_TEXT = [
    "end <|endoftext|> more",
    "<|endoftext|>",
    "<|endoftext|><|endoftext|>x",
    " \n\n<|endoftext|>\n  a <|endoftext|",
    "it'<|endoftext|>s  <|endoftext|>  é😀",
]


def test_added_tokens_in_a_text_have_their_id(spark):
    assert token_ids(END_OF_TEXT[0]) == [437, 220, 50256, 517, 0]
    for text in END_OF_TEXT:
        assert [*byte_bpe_ids()(text), 0] == token_ids(text)
    rows = list(enumerate(END_OF_TEXT))
    check(pack(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows, 2048)


def test_of_added_tokens_the_longest_counts(tmp_path):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    tokenizer.add_special_tokens(["<|a", "<|a|>", "a|>b"])
    path = str(tmp_path / "more.json")
    tokenizer.save(path)
    for text in ["x <|a|>b<|a y", "a|>b<|a|", "<|endoftext|><|a|>"]:
        assert byte_bpe_ids(path)(text) == tokenizer.encode(text, add_special_tokens=False).ids


def first_fit_decreasing(lengths, size):
    bins = []
    for length in sorted(lengths, reverse=True):
        for k, free in enumerate(bins):
            if free >= length:
                bins[k] -= length
                break
        else:
            bins.append(size - length)
    return len(bins)


@pytest.mark.parametrize("seed", range(20))
def test_plan_uses_every_piece_once_and_packs_well(seed):
    rng = random.Random(seed)
    size = rng.choice([10, 100, 2048])
    low, high = rng.choice([(1, size), (size // 3, size // 2), (size // 2, size), (1, max(1, size // 5))])
    lengths = [rng.randint(max(1, low), high) for _ in range(rng.choice([0, 1, 5, 400]))]
    histogram = {x: lengths.count(x) for x in set(lengths)}
    plan = plan_patterns(histogram, size)
    used = {}
    for times, held in plan:
        assert times >= 1 and sum(held) <= size
        for length in held:
            used[length] = used.get(length, 0) + times
    assert used == histogram
    assert sum(times for times, _ in plan) <= first_fit_decreasing(lengths, size) * 1.05 + 1


def test_best_two_is_the_best():
    rng = random.Random(1)
    for _ in range(200):
        count = np.array([0] + [rng.choice([0, 0, 1, 2]) for _ in range(30)])
        room = rng.randint(1, 40)
        pool = [x for x in range(31) for _ in range(count[x])]
        pairs = [a + b for i, a in enumerate(pool) for b in pool[i + 1 :] if a + b <= room]
        got = best_two(count, np.flatnonzero(count), room)
        assert (sum(got) if got else None) == (max(pairs) if pairs else None)


def test_a_smaller_piece_gives_way_to_two():
    # Greedily 60 + 30 leaves 10; instead of 30, 25 and 15 fill the room of 40.
    plan = plan_patterns({60: 1, 30: 1, 25: 1, 15: 1}, 100)
    assert [60, 25, 15] in [held for _, held in plan]
