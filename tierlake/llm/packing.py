"""Best-two-fit packing of token sequences (operator 5).

Documents become pieces of at most ``max_tokens`` tokens. Pieces of one length
are interchangeable, so a packing is planned on the histogram of lengths, at
most ``max_tokens`` rows whatever the corpus: a plan is a list of *patterns*,
each the lengths of a sequence and how many sequences have them. Then every
piece finds its place by its rank among the pieces of its length. The plan, not
the data, goes to the driver and to every task, and the packing does not depend
on how the data is partitioned.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.common import stored, texts
from tierlake.llm.vocabularies import BYTE_BPE, byte_bpe_ids

MAX_TOKENS = 2048
END = 0


def tokenized(frames: Iterator[pd.DataFrame], vocabulary: str, max_tokens: int):
    """Pieces of each document, the shorter one first, numbered by length in this task."""
    encode = byte_bpe_ids(vocabulary)
    part = TaskContext.get().partitionId()
    seen = np.zeros(max_tokens + 1, dtype=np.int64)
    for frame in frames:
        out = []
        for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
            ids = np.array([*encode(text or ""), END], dtype="<u4")
            begin, end = 0, len(ids) % max_tokens or max_tokens
            piece = 0
            while begin < len(ids):
                length = end - begin
                crc = zlib.crc32(ids[begin:end].tobytes())
                out.append((doc_id, piece, begin, length, crc, part, seen[length]))
                seen[length] += 1
                begin, end, piece = end, end + max_tokens, piece + 1
        columns = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"]
        yield pd.DataFrame(out, columns=columns)


def plan_patterns(histogram: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """``(how many sequences, their lengths)`` that use up ``histogram``, best-two-fit.

    A sequence is filled greedily, longest piece that fits first. Then its
    shortest piece goes back if two unused pieces fill the room it leaves
    better. The same sequence is made as often as the counts allow.
    """
    count = np.zeros(size + 1, dtype=np.int64)
    for length, n in histogram.items():
        count[length] = n
    plan: list[tuple[int, list[int]]] = []
    longest = size
    lengths = np.flatnonzero(count)
    while True:
        while longest > 0 and count[longest] == 0:
            longest -= 1
        if longest == 0:
            return plan
        used: list[int] = []
        gap = size
        while gap > 0:
            at = np.searchsorted(lengths, gap, side="right") - 1
            while at >= 0 and count[lengths[at]] == 0:
                at -= 1
            if at < 0:
                break
            # As many of this length as fit and are left.
            length = int(lengths[at])
            n = int(min(gap // length, count[length]))
            used += [length] * n
            count[length] -= n
            gap -= n * length
        if gap and len(used) > 1:
            least = used[-1]
            pair = best_two(count, lengths, least + gap)
            if pair and sum(pair) > least:
                used[-1:] = pair
                count[least] += 1
                for length in pair:
                    count[length] -= 1
        need = np.unique(used, return_counts=True)
        more = int((count[need[0]] // need[1]).min())
        count[need[0]] -= more * need[1]
        plan.append((1 + more, used))
        if len(plan) % 64 == 0:
            lengths = lengths[count[lengths] > 0]


def best_two(count: np.ndarray, lengths: np.ndarray, room: int) -> list[int] | None:
    """Two unused lengths with the largest sum up to ``room``."""
    there = lengths[(lengths < room) & (count[lengths] > 0)]
    if not there.size:
        return None
    # For each the largest partner that fits; the same length twice needs two pieces.
    at = np.searchsorted(there, room - there, side="right") - 1
    same = (at >= 0) & (there[at] == there) & (count[there] < 2)
    at = np.where(same, at - 1, at)
    total = np.where(at >= 0, there + there[at], -1)
    best = int(total.argmax())
    if total[best] < 0:
        return None
    return sorted((int(there[best]), int(there[at[best]])), reverse=True)


class Places:
    """Where the pieces of each length go: ranges of ranks, sorted, per length."""

    def __init__(self, plan: list[tuple[int, list[int]]], size: int):
        rows: list[list[tuple]] = [[] for _ in range(size + 1)]
        taken = [0] * (size + 1)
        first = 0
        for times, used in plan:
            offset = 0
            for length in used:
                rows[length].append((taken[length], first, offset))
                taken[length] += times
                offset += length
            first += times
        self.rows = [np.array(r, dtype=np.int64).reshape(-1, 3) for r in rows]
        self.sequences = first

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty_like(rank), np.empty_like(rank)
        for each in np.unique(length):
            of = length == each
            table = self.rows[each]
            at = np.searchsorted(table[:, 0], rank[of], side="right") - 1
            sequence[of] = table[at, 1] + rank[of] - table[at, 0]
            offset[of] = table[at, 2]
        return sequence, offset


def pack(
    docs: DataFrame,
    max_tokens: int = MAX_TOKENS,
    vocabulary: str = BYTE_BPE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    A document is its token ids and an end token 0; a null or empty text is the
    end token alone. Only documents of more than ``max_tokens`` tokens are cut,
    into pieces of that length, of which the first may be shorter. Rows are
    documents of their own even when repeated. An empty table gives no pieces.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, place long"
    )

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from tokenized(frames, vocabulary, max_tokens)

    pieces = stored(texts(docs, id_col, text_col).mapInPandas(cut, schema))
    # Ranks within a length: running counts over tasks, one row a task and length.
    before = (
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counts = stored(counts)
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    plan = plan_patterns({row.length: row.n for row in histogram}, max_tokens)
    places = docs.sparkSession.sparkContext.broadcast(Places(plan, max_tokens))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rank = frame["rank"].to_numpy(dtype=np.int64)
            sequence, offset = places.value(frame["length"].to_numpy(dtype=np.int64), rank)
            yield frame.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    own = "doc_id", "piece", "start", "length", "ids_crc32"
    ranked = pieces.join(counts.drop("n"), ["length", "part"]).select(
        *own, (F.col("offset") + F.col("place")).alias("rank")
    )
    return ranked.mapInPandas(
        place,
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )
