"""Grouped counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.names import as_column, exact


def count_by(df: DataFrame, keys: Sequence[str], counted: str, alias: str) -> DataFrame:
    """Non-null ``counted`` values per combination of ``keys``.

    A null key is a group of its own. Spark counts per task before the
    shuffle, so a hot group costs one row per task on the reduce side.
    """
    return df.groupBy(*(exact(key) for key in keys)).agg(F.count(as_column(counted)).alias(alias))
