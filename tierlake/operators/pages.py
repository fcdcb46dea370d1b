"""Numbered JSON pages to typed records.

A page is a row ``(page, status, body)`` whose body is a JSON array of
objects, with at most a fixed page size of them. Pages count up from zero and
end at the first one that is missing, has a status other than 200, or is
empty; later pages contribute nothing.

Landed pages also carry ``empty BOOLEAN`` (see ``with_empty_flag``). With it
the search for the end reads three narrow columns and no bodies. Where the flag
is null, as in files landed without it, the body tells.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.numeric import doubles_from_variants

# The JSON documents a Python program treats as false.
EMPTY_BODY = (
    r'[ \t\n\r]*(\[[ \t\n\r]*\]|\{[ \t\n\r]*\}|null|false|""|-?0(\.0+)?([eE][+-]?[0-9]+)?)'
    r"[ \t\n\r]*"
)
# Strict about form, with no limit on the length of a text or a number.
_STRICT_JSON = {
    "mode": "FAILFAST",
    "allowSingleQuotes": "false",
    "maxStringLen": str(2**31 - 1),
    "maxNumLen": str(2**31 - 1),
}

# One BIGINT tells for 32 consecutive pages which of them are there.
_WORD_BITS = 5
_FULL_WORD = (1 << 32) - 1


@dataclass(frozen=True)
class PagesEnd:
    """Where the pages end and why.

    ``status`` is that of the page numbered ``stop``, the largest if it was
    landed more than once, and null if there is none.
    """

    stop: int
    status: int | None
    cause: str

    @property
    def natural(self) -> bool:
        """Did an empty page with status 200 end them?"""
        return self.cause == "empty"


class UnfinishedPages(ValueError):
    """The pages end with a refused or a missing page."""


def _empty() -> Column:
    return F.coalesce(F.col("body").rlike(rf"\A{EMPTY_BODY}\z"), F.lit(False))


def with_empty_flag(pages: DataFrame) -> DataFrame:
    """Add ``empty``, or fill it where it is null: does the body hold no records?"""
    known = [F.col("empty")] if "empty" in pages.columns else []
    return pages.withColumn("empty", F.coalesce(*known, _empty()))


def _narrow(pages: DataFrame) -> DataFrame:
    """``page, status, empty``; bodies are read only where the flag is null.

    Parquet skips the bodies of row groups that have no null flag.
    """
    columns = "page", "status", "empty"
    if "empty" not in pages.columns:
        return with_empty_flag(pages).select(*columns)
    known = pages.where("empty is not null").select(*columns)
    return known.unionByName(with_empty_flag(pages.where("empty is null")).select(*columns))


def _good() -> Column:
    return F.col("status").eqNullSafe(200) & ~F.col("empty")


def _words(pages: DataFrame, *, with_status: bool) -> DataFrame:
    """``word, seen``: which of each 32 page numbers have a good page.

    Each page says "this number is here" and "the next number is expected";
    ``bit_or`` folds both into one word per 32 numbers before the shuffle, so
    the shuffle carries about 1/32 of the page numbers and no task sees all.
    With ``with_status`` a word also has ``bad``, the distinct ``(n, status)`` of
    its pages that are not good: a few per number, and only where there are any.
    """
    numbered = F.when(
        F.col("page").isNull(), F.raise_error(F.lit("a page has no number")).cast("boolean")
    ).otherwise(F.col("page") >= 0)
    n, number = F.col("page").cast("bigint"), "bigint"
    nothing = F.lit(None).cast("struct<n: bigint, status: int>")
    refused = F.when(~_good(), F.struct(n.alias("n"), "status"))
    here = F.struct(n.alias("n"), _good().cast(number).alias("here"), refused.alias("bad"))
    following = F.struct((n + 1).alias("n"), F.lit(0).cast(number).alias("here"), nothing.alias("bad"))
    marks = _narrow(pages).where(numbered).select(F.inline(F.array(here, following)))
    first = pages.sparkSession.range(0, 1, 1, 1).select(
        F.col("id").alias("n"), F.lit(0).cast(number).alias("here"), nothing.alias("bad")
    )
    seen = F.bit_or(F.expr(f"shiftleft(here, cast(n & {2**_WORD_BITS - 1} as int))")).alias("seen")
    folds = [seen, F.collect_set("bad").alias("bad")] if with_status else [seen]
    words = marks.unionByName(first).groupBy(F.expr(f"shiftright(n, {_WORD_BITS})").alias("word"))
    return words.agg(*folds).where(F.col("seen") != _FULL_WORD)


def _first_gap() -> Column:
    """The first number of a word without a good page."""
    leading = F.bit_count(F.col("seen").bitwiseAND(F.bitwise_not(F.col("seen") + 1)))
    return F.col("word") * 2**_WORD_BITS + leading


def end_of_pages(pages: DataFrame) -> DataFrame:
    """One row, one column ``stop``: the first page number without a good page.

    A row without a page number is an error: it may be any page.
    """
    return _words(pages, with_status=False).agg(F.min(_first_gap()).alias("stop"))


def find_end(pages: DataFrame) -> PagesEnd:
    """The end of ``pages`` and its cause: ``empty``, ``refused`` or ``missing``.

    The statuses of pages that are not good ride along in the words, so pages
    are read once.
    """
    first = _words(pages, with_status=True).agg(
        F.min(_first_gap()).alias("stop"), F.min_by("bad", "word").alias("bad")
    )
    there = F.filter("bad", lambda page: page["n"] == F.col("stop"))
    row = (
        first.select("stop", F.transform(there, lambda page: page["status"]).alias("statuses"))
        .select(
            "stop",
            F.size("statuses").alias("n"),
            F.array_max("statuses").alias("status"),
            F.exists("statuses", lambda status: ~status.eqNullSafe(200)).alias("refused"),
        )
        .first()
    )
    cause = "refused" if row.refused else "empty" if row.n else "missing"
    return PagesEnd(row.stop, row.status, cause)


def checked_end(end: PagesEnd, on_bad_page: str) -> PagesEnd:
    """``end``, or an error if it must be an empty page with status 200 and is not."""
    if on_bad_page not in ("stop", "fail"):
        raise ValueError(f"on_bad_page must be 'stop' or 'fail', not {on_bad_page!r}")
    if on_bad_page == "fail" and not end.natural:
        what = f"has status {end.status}" if end.cause == "refused" else "is missing"
        raise UnfinishedPages(f"page {end.stop} {what}")
    return end


def take_pages(
    pages: DataFrame, on_bad_page: str = "stop", end: PagesEnd | None = None
) -> DataFrame:
    """The pages before the end.

    A page with a status other than 200, or a missing one, ends the pages like
    an empty one and the part before it is kept; ``on_bad_page="fail"`` makes
    it an error, at once. ``pages`` is read twice, so it should be a stored
    table; an ``end`` that is known already saves the first scan. The end
    reaches the other scan as a filter on ``page``, pushed down to Parquet.
    """
    if end is None and on_bad_page != "stop":
        end = find_end(pages)
    if end is not None:
        checked_end(end, on_bad_page)
    stop = end_of_pages(pages).scalar() if end is None else F.lit(end.stop).cast("bigint")
    pages = with_empty_flag(pages)
    return pages.where((F.col("page") >= 0) & (F.col("page") < stop) & _good())


def _wire_type(field: T.StructField) -> T.StructField:
    """How a field is read off the wire: a DOUBLE may arrive as any JSON value."""
    if isinstance(field.dataType, T.DoubleType):
        return T.StructField(field.name, T.VariantType())
    return T.StructField(field.name, field.dataType)


def read_records(pages: DataFrame, schema: T.StructType) -> DataFrame:
    """The records of all pages, with the columns and types of ``schema``.

    Missing fields are null, fields outside the schema are dropped, a number
    or truth value in a STRING field is its text, and DOUBLE fields follow
    ``safe_double_variant``. A body that is not exactly one JSON array of
    objects fails the job. Duplicates are kept. Of equal keys inside the value
    of a DOUBLE field the last one counts where ``spark.sql.variant.allowDuplicateKeys``
    is true, as in ``tierlake.session.SETTINGS``; elsewhere they fail the job.
    """
    record = T.StructType([_wire_type(field) for field in schema.fields])
    # Wrapped in one more array, so that text after the document is an error too.
    document = F.from_json(
        F.concat(F.lit("["), F.col("body"), F.lit("]")),
        T.ArrayType(T.ArrayType(record)),
        _STRICT_JSON,
    )
    parsed = pages.select("page", document.alias("document"))
    body = F.get("document", F.lit(0))
    is_list_of_objects = (
        (F.size("document") == 1) & body.isNotNull() & ~F.exists(body, lambda item: item.isNull())
    )
    message = F.format_string("page %d is not one JSON array of objects", F.col("page"))
    checked = F.when(is_list_of_objects, body).otherwise(F.raise_error(message))
    records = parsed.select(F.inline(checked))
    reals = [f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType)]
    return doubles_from_variants(records, reals)


def union_pages(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, duplicates included."""
    return reduce(lambda left, right: left.unionByName(right), parts)
