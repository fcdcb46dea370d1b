"""Vectors as exact integers, for the operators that cluster them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Larger than any squared distance.
FAR = np.iinfo(np.int64).max


def limit(size: int) -> int:
    """The largest integer component for which squared distances of ``size`` of them fit a long."""
    return 1 << ((62 - max(6, (size - 1).bit_length())) // 2 - 1)


def finite(vector: Column) -> Column:
    """Is the vector there, with neither null nor non-finite components?"""
    inside = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(vector.isNotNull() & inside, F.lit(False))


def integers(vector: Column, scale: int, size: int) -> Column:
    """``floor(scale * x)`` of every component, at most ``limit(size)`` either way."""
    most = float(limit(size))

    def one(x: Column) -> Column:
        scaled = F.least(F.greatest(x.cast("double") * float(scale), F.lit(-most)), F.lit(most))
        return F.floor(scaled).cast("int")

    return F.transform(vector, one)


def kept_vectors(
    vectors: DataFrame,
    id_col: str,
    vector_col: str,
    label_col: str | None = None,
) -> DataFrame:
    """``vec_id, label, vector`` of the finite vectors; whatever else the table has stays out."""
    label = F.lit(None).cast("int") if label_col is None else F.col(f"`{label_col}`")
    rows = vectors.select(
        F.col(f"`{id_col}`").alias("vec_id"),
        label.alias("label"),
        F.col(f"`{vector_col}`").alias("vector"),
    )
    return rows.where(finite(F.col("vector")))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix of its dtype, one row a vector."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def squared(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances of every point (``n, w``) to every other (``k, w``)."""
    out = np.zeros((len(points), len(others)), dtype=np.int64)
    for axis in range(points.shape[1]):
        step = points[:, axis, None] - others[None, :, axis]
        out += step * step
    return out


def pair_squared(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances of points to others, row by row."""
    step = points - others
    return np.einsum("ij,ij->i", step, step)


def floor_means(sums: DataFrame, keys: list[str], width: int) -> dict[tuple, list[int]]:
    """``floor(sum / count)`` by ``keys``, component by component.

    ``sums`` has ``keys``, ``n`` and ``sums array<long>`` of ``width``, a row per
    task and key; they are added up as they are, without a row per component.
    Shorter arrays give shorter means. What comes to the driver is a mean per key: a codebook.
    """
    parts = [F.sum(F.get("sums", F.lit(k))) for k in range(width)]
    total = sums.groupBy(*keys).agg(F.sum("n").alias("n"), F.array(*parts).alias("sums"))
    return {
        tuple(row[k] for k in keys): [x // row["n"] for x in row["sums"] if x is not None]
        for row in total.where("n > 0").collect()
    }
