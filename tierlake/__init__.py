"""tierlake: layered (bronze, silver, gold) batch processing on Spark DataFrames."""

from tierlake.functions.nulls import fill_defaults, null_rows
from tierlake.functions.numeric import json_field, safe_double, safe_double_variant
from tierlake.operators.aggregate import count_by
from tierlake.operators.align import align
from tierlake.operators.pages import (
    end_of_pages,
    read_records,
    take_pages,
    union_pages,
    with_empty_flag,
)
from tierlake.operators.preview import preview
from tierlake.plans.medallion import Medallion, run
from tierlake.sinks.refresh import Refreshed, refresh
from tierlake.sources.layers import read_layer
from tierlake.sources.pages import PageSource, land_pages, read_page_files, read_pages

__all__ = [
    "Medallion",
    "PageSource",
    "Refreshed",
    "align",
    "count_by",
    "end_of_pages",
    "fill_defaults",
    "json_field",
    "land_pages",
    "null_rows",
    "preview",
    "read_layer",
    "read_page_files",
    "read_pages",
    "read_records",
    "refresh",
    "run",
    "safe_double",
    "safe_double_variant",
    "take_pages",
    "union_pages",
    "with_empty_flag",
]
