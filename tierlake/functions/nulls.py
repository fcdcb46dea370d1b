"""Nulls to per-type defaults, and the rows that hold nulls."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.names import as_column, exact

# The default for each column type, by type name. Columns of
# every other type keep their nulls.
DEFAULTS: Mapping[str, object] = {"string": "TBD", "double": -1}


def fill_defaults(df: DataFrame, defaults: Mapping[str, object] = DEFAULTS) -> DataFrame:
    """Replace nulls by the default of the column's type.

    Only nulls: NaN and the empty string are values and stay (``na.fill``
    would also replace NaN).
    """

    def filled(field) -> Column:
        column = exact(field.name)
        kind = field.dataType.typeName()
        if kind not in defaults:
            return column
        return F.coalesce(column, F.lit(defaults[kind])).alias(field.name)

    return df.select(*(filled(field) for field in df.schema.fields))


def null_rows(df: DataFrame, column: Column | str) -> DataFrame:
    """The rows whose ``column`` is null."""
    return df.filter(as_column(column).isNull())
