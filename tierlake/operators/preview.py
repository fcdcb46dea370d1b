"""The first rows, for a look at a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tierlake.names import exact


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str] = ()) -> DataFrame:
    """``n`` rows: the first by ``order_by``, or any when no order is given."""
    if order_by:
        df = df.orderBy(*(exact(name) for name in order_by))
    return df.limit(n)
