"""Product codes by Lloyd's rounds over cover trees (operator 11).

Vectors become integers and are cut into equal consecutive parts; each part
position has a codebook of its own. Blocks of vectors, each within one
partition, get one cover tree per part position, once:

* a node is a centre, the points in its reach, and its radius, the exact
  distance to the farthest of them;
* its children are centres more than ``rho`` apart, ``rho`` a power of
  ``BASE`` below the radius, that cover all its points within ``rho``;
* a node of at most ``LEAF`` points, or of equal points, is not split further;
* the points of a subtree are a run of the block's order, so that its sum is the
  difference of two cumulative sums.

A round walks down all trees. An entry that is farther from a node's centre than
the nearest one by more than twice the radius is nearest to none of its points
(triangle inequality). When one entry is left the whole subtree goes to it by
count and sum; leaves that stay ambiguous compare their points with the entries
that are left, in exact integers. Tasks send one sum per entry they met.

Blocks are stored in the shared folder: a lost executor costs the tasks it held.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import broadcast_if_small, stored
from tierlake.llm.vectors import (
    FAR,
    floor_means,
    integers,
    kept_vectors,
    matrix,
    pair_squared,
    squared,
)

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors a block; one tree spans one block.
BLOCK = 4096
BASE, LEAF = 1.5, 16
#: Labels sent to every task instead of shuffling the vectors.
BROADCAST_LABELS = 100_000

NODE = np.dtype(
    [("begin", "<i4"), ("end", "<i4"), ("child", "<i4"), ("children", "<i4"), ("radius", "<f8")]
)


def parts_of(size: int, parts: int) -> list[slice]:
    """``parts`` consecutive parts of equal length, the first ones longer by one if need be."""
    ends = np.cumsum([size // parts + (k < size % parts) for k in range(parts)]).tolist()
    return [slice(begin, end) for begin, end in zip([0, *ends], ends, strict=False)]


def spread(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after the other, and which range each is of."""
    count = end - begin
    of = np.repeat(np.arange(len(begin)), count)
    return np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + begin[of], of


class CoverTree:
    """A tree over ``points`` (``n, w`` integers); ``order`` lists them subtree by subtree.

    The centre of a node is the first point of its run. Nodes are in breadth-first
    order, the children of one side by side.
    """

    def __init__(self, points: np.ndarray, order: np.ndarray, nodes: np.ndarray):
        self.order, self.nodes = order, nodes
        self.points = points[order]
        self.sums = np.zeros((len(order) + 1, points.shape[1]), dtype=np.int64)
        np.cumsum(self.points, axis=0, out=self.sums[1:])

    @classmethod
    def build(cls, points: np.ndarray) -> CoverTree:
        order, nodes, at = np.arange(len(points)), [(0, len(points), -1, 0, 0.0)], 0
        while at < len(nodes):
            begin, end = nodes[at][:2]
            run = order[begin:end]
            far = np.sqrt(squared(points[run], points[run[:1]])[:, 0])
            radius, child, children = float(far.max(initial=0.0)), -1, 0
            if radius > 0 and len(run) > LEAF:
                child, label = len(nodes), covered(points[run], far, radius)
                children = int(label.max()) + 1
                order[begin:end] = run[np.argsort(label, kind="stable")]
                ends = begin + np.cumsum(np.bincount(label))
                starts = [begin, *ends[:-1].tolist()]
                nodes += [(b, e, -1, 0, 0.0) for b, e in zip(starts, ends.tolist(), strict=True)]
            nodes[at] = begin, end, child, children, radius
            at += 1
        return cls(points, order, np.array(nodes, dtype=NODE))

    def walk(self, entries: np.ndarray) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """What belongs to which entry: ``("nodes", ids, entry)`` or ``("points", places, entry)``.

        Every point comes once, alone or with a subtree. Of entries that are
        equally near the first counts.
        """
        if not len(self.order):
            return
        at, able = np.zeros(1, dtype=np.int64), np.ones((1, len(entries)), dtype=bool)
        while len(at):
            node = self.nodes[at]
            near = np.where(able, squared(self.points[node["begin"]], entries), FAR)
            best = near.argmin(axis=1)
            reach = np.sqrt(near[np.arange(len(at)), best]) + 2 * node["radius"]
            # Rounding only ever keeps an entry too many.
            able = able & (np.sqrt(near) <= (reach * (1 + 1e-9) + 1e-6)[:, None])
            sure = (able.sum(axis=1) == 1) | (node["radius"] == 0)
            yield "nodes", at[sure], best[sure]
            leaf = ~sure & (node["child"] < 0)
            if leaf.any():
                place, of = spread(node["begin"][leaf], node["end"][leaf])
                row, entry = np.nonzero(able[leaf][of])
                exact = np.full((len(place), len(entries)), FAR)
                exact[row, entry] = pair_squared(self.points[place[row]], entries[entry])
                yield "points", place, exact.argmin(axis=1)
            inner = ~sure & ~leaf
            first = node["child"][inner].astype(np.int64)
            at, of = spread(first, first + node["children"][inner])
            able = able[inner][of]

    def totals(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many points each entry gets, and their sums."""
        count = np.zeros(len(entries), dtype=np.int64)
        sums = np.zeros((len(entries), self.points.shape[1]), dtype=np.int64)
        for what, at, entry in self.walk(entries):
            if what == "nodes":
                begin, end = self.nodes["begin"][at], self.nodes["end"][at]
                np.add.at(count, entry, end - begin)
                np.add.at(sums, entry, self.sums[end] - self.sums[begin])
            else:
                np.add.at(count, entry, 1)
                np.add.at(sums, entry, self.points[at])
        return count, sums

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each point, in the order the points came in."""
        found = np.zeros(len(self.order), dtype=np.int64)
        for what, at, entry in self.walk(entries):
            if what == "nodes":
                at, of = spread(self.nodes["begin"][at], self.nodes["end"][at])
                entry = entry[of]
            found[at] = entry
        error = pair_squared(self.points, entries[found]) if len(found) else found
        back = np.empty_like(self.order)
        back[self.order] = np.arange(len(back))
        return found[back], error[back]


def covered(points: np.ndarray, far: np.ndarray, radius: float) -> np.ndarray:
    """The child that covers each point; child 0 keeps the centre, ``points[0]``."""
    rho = min(BASE ** (math.ceil(math.log(radius, BASE)) - 1), 0.99 * radius)
    label = np.where(far <= rho, 0, -1)
    left, child = np.flatnonzero(label < 0), 1
    while len(left):
        near = np.sqrt(squared(points[left], points[left[:1]])[:, 0]) <= rho
        label[left[near]] = child
        left, child = left[~near], child + 1
    return label


@dataclass(frozen=True)
class Compressed:
    """``codes``: ``vec_id, label, code binary, error``, a row a kept vector.

    ``codebooks[part][entry]`` are the integers of an entry.
    """

    codes: DataFrame
    codebooks: list[list[list[int]]]


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | None = "label",
) -> Compressed:
    """Codes of all vectors, by codebooks that Lloyd's rounds have fitted to all of them.

    A component x is ``floor(scale * x)``. A codebook starts as its part of the
    ``entries`` (at most 256) smallest ids; a null id comes last, and rows that
    repeat an id are vectors of their own, in the order of their components. Each
    round assigns every part to the nearest entry, ties to the first, and
    replaces every entry that was used by ``floor(sum / count)``.

    Vectors that are null or hold null or non-finite components are dropped,
    and so are those whose length is not that of the first one in the order of
    ids. A length that ``parts`` does not divide gives parts that differ by one.
    Components beyond 32,768 either way (of 64 dimensions, at the default
    scale) count as that. Fewer vectors than entries give smaller codebooks; a
    table without vectors gives no rows and empty codebooks.
    """
    rows = kept_vectors(vectors, id_col, vector_col, label_col)
    by_id = F.asc_nulls_last("vec_id"), F.asc("vector")
    first = rows.orderBy(*by_id).select(F.size("vector").alias("size")).first()
    size = first.size if first else 0
    rows = rows.where(F.size("vector") == size)
    start = rows.orderBy(*by_id).select(integers(F.col("vector"), scale, size).alias("v"))
    start = [row.v for row in start.limit(entries).collect()]
    cuts = parts_of(size, parts)
    start = np.array(start, dtype=np.int64).reshape(len(start), size)
    books = [start[:, cut] for cut in cuts]
    grown = stored(blocks(rows.withColumn("vector", integers(F.col("vector"), scale, size)), cuts))
    width = max(book.shape[1] for book in books)
    if not len(start):
        rounds = 0
    for _ in range(rounds):
        means = floor_means(totals(grown, cuts, books), ["part", "entry"], width)
        last = books
        books = [
            np.array(
                [means.get((p, e), old.tolist())[: book.shape[1]] for e, old in enumerate(book)],
                dtype=np.int64,
            ).reshape(book.shape)
            for p, book in enumerate(books)
        ]
        if all(np.array_equal(a, b) for a, b in zip(last, books, strict=True)):
            break  # nothing will move any more
    return Compressed(codes(grown, cuts, books), [book.tolist() for book in books])


def blocks(rows: DataFrame, cuts: list[slice]) -> DataFrame:
    """Blocks of ``vec_id, label, vector`` rows with a tree per part."""
    size = cuts[-1].stop
    kinds = {name: rows.schema[name].dataType for name in ("vec_id", "label")}

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                part = batch.slice(begin, BLOCK)
                values = matrix(part["vector"], size)
                trees = [CoverTree.build(values[:, cut].astype(np.int64)) for cut in cuts]
                columns = {
                    name: pa.array([part[name].to_pylist()], pa.list_(part.schema.field(name).type))
                    for name in kinds
                }
                columns["vectors"] = pa.array([values.ravel()], pa.list_(pa.int32()))
                columns["orders"] = pa.array(
                    [[t.order.astype("<i4").tobytes() for t in trees]], pa.list_(pa.binary())
                )
                columns["nodes"] = pa.array([[t.nodes.tobytes() for t in trees]], pa.list_(pa.binary()))
                yield pa.RecordBatch.from_pydict(columns)

    lists = ", ".join(f"{name} array<{kind.simpleString()}>" for name, kind in kinds.items())
    schema = f"{lists}, vectors array<int>, orders array<binary>, nodes array<binary>"
    return rows.mapInArrow(build, schema)


def trees_of(batch: pa.RecordBatch, row: int, cuts: list[slice]) -> Iterator[CoverTree]:
    """The trees of a stored block, part by part."""
    orders, nodes = batch["orders"][row].as_py(), batch["nodes"][row].as_py()
    orders = [np.frombuffer(order, "<i4").astype(np.int64) for order in orders]
    values = batch["vectors"].slice(row, 1).flatten().to_numpy()
    values = values.reshape(len(orders[0]), cuts[-1].stop).astype(np.int64)
    for cut, order, node in zip(cuts, orders, nodes, strict=True):
        yield CoverTree(values[:, cut], order, np.frombuffer(node, NODE))


def totals(grown: DataFrame, cuts: list[slice], books: list[np.ndarray]) -> DataFrame:
    """``part, entry, n, sums``: what each task gives to each entry."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [np.zeros(len(book), dtype=np.int64) for book in books]
        sums = [np.zeros_like(book) for book in books]
        for batch in batches:
            for row in range(batch.num_rows):
                for p, tree in enumerate(trees_of(batch, row, cuts)):
                    n, s = tree.totals(books[p])
                    count[p] += n
                    sums[p] += s
        used = [(p, e) for p, n in enumerate(count) for e in np.flatnonzero(n).tolist()]
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([p for p, _ in used], pa.int32()),
                "entry": pa.array([e for _, e in used], pa.int32()),
                "n": pa.array([int(count[p][e]) for p, e in used], pa.int64()),
                "sums": pa.array([sums[p][e].tolist() for p, e in used], pa.list_(pa.int64())),
            }
        )

    return grown.select("vectors", "orders", "nodes").mapInArrow(
        add, "part int, entry int, n long, sums array<long>"
    )


def codes(grown: DataFrame, cuts: list[slice], books: list[np.ndarray]) -> DataFrame:
    """``vec_id, label, code, error`` of all vectors, by the entries of ``books``."""
    kinds = {name: grown.schema[name].dataType.elementType for name in ("vec_id", "label")}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found = [t.assign(books[p]) for p, t in enumerate(trees_of(batch, row, cuts))]
                code = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8)
                error = sum(far for _, far in found)
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": batch["vec_id"].slice(row, 1).flatten(),
                        "label": batch["label"].slice(row, 1).flatten(),
                        "code": pa.array([c.tobytes() for c in code], pa.binary()),
                        "error": pa.array(error, pa.int64()),
                    }
                )

    plain = ", ".join(f"{name} {kind.simpleString()}" for name, kind in kinds.items())
    return grown.mapInArrow(assign, f"{plain}, code binary, error long")


def with_label_error(found: DataFrame) -> DataFrame:
    """``label_error``: errors summed over equal labels, null being one of them."""
    found = stored(found)
    sums = found.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    sums = broadcast_if_small(stored(sums), BROADCAST_LABELS)
    return found.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")
