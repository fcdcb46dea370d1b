"""Fit a DataFrame to a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.names import exact


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and with its types.

    A missing column becomes typed nulls, an extra one is dropped, and any
    value fits a STRING column as its text. Other type changes raise: convert
    first, with ``safe_double`` for instance, so that no value changes unseen.
    """
    present = {field.name: field.dataType for field in df.schema.fields}

    def fitted(field: T.StructField) -> Column:
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        source = present[field.name]
        if source == field.dataType:
            return exact(field.name)
        if isinstance(field.dataType, T.StringType) or isinstance(source, T.NullType):
            return exact(field.name).cast(field.dataType).alias(field.name)
        raise TypeError(
            f"column {field.name!r} is {source.simpleString()}, the schema declares "
            f"{field.dataType.simpleString()}: convert it before aligning"
        )

    return df.select(*(fitted(field) for field in schema.fields))
