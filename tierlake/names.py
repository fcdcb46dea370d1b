"""Column references that survive dots and backticks in column names."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact(name: str) -> Column:
    """The column called exactly ``name``, never a path into a struct."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_column(value: Column | str) -> Column:
    return exact(value) if isinstance(value, str) else value
