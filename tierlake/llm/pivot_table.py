"""Lloyd's clustering with a LAESA pivot table (operator 12).

The distances of every vector to a few fixed pivots are stored once, beside the
vector. By the triangle inequality the distances of a vector and a centroid to
one pivot differ by no more than the two are apart, so the largest difference
over the pivots bounds their distance from below: each round, for every
centroid, without touching the vector's components. The centroid of the least
bound gets its exact distance first; the others get theirs only if their bound
does not exceed it. Exact distances are integers, and bounds are rounded in
favour of the centroid, so results are those of comparing everything.

Tasks send one sum per centroid; the driver holds centroids and pivots only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import stored
from tierlake.llm.vectors import (
    FAR,
    floor_means,
    integers,
    kept_vectors,
    matrix,
    pair_squared,
    squared,
)

CLUSTERS, ROUNDS, SCALE, SIZE, SEED = 8, 10, 1024, 64, 3
#: Pivots, and the vectors they are chosen from; any choice gives the same result.
PIVOTS, PIVOT_CHOICE = 16, 512
#: Vectors that are compared at a time.
CHUNK = 4096


def chosen_pivots(choice: np.ndarray, pivots: int) -> np.ndarray:
    """One vector, then again and again the one whose distances to those chosen sum to the most."""
    if not len(choice):
        return choice
    total, taken = np.zeros(len(choice)), [0]
    while len(taken) < min(pivots, len(choice)):
        total += np.sqrt(squared(choice, choice[taken[-1:]])[:, 0])
        total[taken] = -1
        if total.max() <= 0:
            break
        taken.append(int(total.argmax()))
    return choice[taken]


def survivors(to_pivots: np.ndarray, of_centroids: np.ndarray) -> np.ndarray:
    """Lower bounds of all distances (``n, k``) from those to the pivots (``n, p`` and ``k, p``)."""
    bound = np.zeros((len(to_pivots), len(of_centroids)))
    for p in range(to_pivots.shape[1]):
        apart = np.abs(to_pivots[:, p, None] - of_centroids[None, :, p])
        np.maximum(bound, apart, out=bound)
    # Rounding must not push a bound over the distance.
    return np.maximum(bound * (1 - 1e-9) - 1e-6, 0)


def nearest(
    points: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, of_centroids: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Cluster and squared distance of each point, and how many exact distances it took."""
    bound = survivors(to_pivots, of_centroids)
    rows, guess = np.arange(len(points)), bound.argmin(axis=1)
    exact = np.full(bound.shape, FAR)
    exact[rows, guess] = pair_squared(points, centroids[guess])
    able = bound <= np.sqrt(exact[rows, guess])[:, None]
    able[rows, guess] = False
    row, centroid = np.nonzero(able)
    exact[row, centroid] = pair_squared(points[row], centroids[centroid])
    best = exact.argmin(axis=1)
    return best, exact[rows, best], len(points) + len(row)


@dataclass(frozen=True)
class Clustered:
    """``members``: ``vec_id, cluster, distance`` of every kept vector; distances are squared.

    ``centroids[cluster]`` are its integers, ``inertias[cluster]`` the sum of
    its distances.
    """

    members: DataFrame
    centroids: list[list[int]]
    inertias: list[int]


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    size: int = SIZE,
    seed: int = SEED,
    pivots: int = PIVOTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> Clustered:
    """Lloyd's rounds over all vectors of ``size`` finite components.

    A component x is ``floor(scale * x)``, at most 134,217,728 either way (of
    64 dimensions). Centroids start as the vectors whose ids, written after
    ``seed`` and a colon, have the smallest SHA-256, in that order; a null id
    comes last, and rows that repeat an id are vectors of their own, in the
    order of their components. A round assigns each vector to the nearest
    centroid, ties to the smaller number, and replaces every centroid that has
    vectors by ``floor(sum / count)``; after the last one vectors are assigned
    once more. Fewer vectors than clusters give fewer centroids, none gives none.
    """
    rows = kept_vectors(vectors, id_col, vector_col).where(F.size("vector") == size)
    rows = rows.select("vec_id", integers(F.col("vector"), scale, size).alias("v"))
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    order = rows.orderBy(F.asc_nulls_last(drawn), "v").select("v")
    choice = [row.v for row in order.limit(max(clusters, PIVOT_CHOICE)).collect()]
    choice = np.array(choice, dtype=np.int64).reshape(len(choice), size)
    centroids, fixed = choice[:clusters], chosen_pivots(choice, pivots)
    table = stored(pivot_distances(rows, fixed))

    for _ in range(rounds if len(choice) else 0):
        means = floor_means(totals(table, centroids, fixed), ["cluster"], size)
        last = centroids
        centroids = np.array(
            [means.get((k,), old.tolist()) for k, old in enumerate(centroids)], dtype=np.int64
        )
        if np.array_equal(last, centroids):
            break  # nothing will move any more
    members = stored(assigned(table, centroids, fixed))
    sums = members.groupBy("cluster").agg(F.sum("distance").alias("inertia"))
    inertia = {row.cluster: row.inertia for row in sums.collect()}
    inertias = [inertia.get(k, 0) for k in range(len(centroids))]
    return Clustered(members, centroids.tolist(), inertias)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, CHUNK):
            yield batch.slice(begin, CHUNK)


def pivot_distances(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vec_id, v, to_pivots``: the table that is stored once."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    size = pivots.shape[1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            far = np.sqrt(squared(matrix(part["v"], size).astype(np.int64), pivots))
            ends = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * len(pivots))
            to_pivots = pa.ListArray.from_arrays(ends, pa.array(far.ravel()))
            yield pa.RecordBatch.from_arrays(
                [part["vec_id"], part["v"], to_pivots], ["vec_id", "v", "to_pivots"]
            )

    return rows.mapInArrow(measure, f"vec_id {kind}, v array<int>, to_pivots array<double>")


def totals(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """``cluster, n, sums``: what each task gives to each centroid."""
    of_centroids = np.sqrt(squared(centroids, pivots))
    size = centroids.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), dtype=np.int64)
        sums = np.zeros_like(centroids)
        for part in chunks(batches):
            points = matrix(part["v"], size).astype(np.int64)
            far = matrix(part["to_pivots"], len(pivots))
            best, _, _ = nearest(points, far, centroids, of_centroids)
            count += np.bincount(best, minlength=len(centroids))
            np.add.at(sums, best, points)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": pa.array(used, pa.int32()),
                "n": pa.array(count[used], pa.int64()),
                "sums": pa.array(sums[used].tolist(), pa.list_(pa.int64())),
            }
        )

    return table.select("v", "to_pivots").mapInArrow(add, "cluster int, n long, sums array<long>")


def assigned(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of all vectors."""
    of_centroids = np.sqrt(squared(centroids, pivots))
    size = pivots.shape[1]
    kind = table.schema["vec_id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            points = matrix(part["v"], size).astype(np.int64)
            far = matrix(part["to_pivots"], len(pivots))
            best, distance, _ = nearest(points, far, centroids, of_centroids)
            yield pa.RecordBatch.from_arrays(
                [part["vec_id"], pa.array(best, pa.int32()), pa.array(distance, pa.int64())],
                ["vec_id", "cluster", "distance"],
            )

    return table.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long")
