"""The operators as queries over the given tables, each with SQL for the same result.

Pages, nulls and number texts are derived from whole tables by Spark, so the
work of every query grows with them. Queries that store something write below
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.fs import Files
from tierlake.functions.nulls import fill_defaults, null_rows
from tierlake.functions.numeric import json_field, safe_double, safe_double_variant
from tierlake.operators.aggregate import count_by
from tierlake.operators.align import align
from tierlake.operators.pages import (
    find_end,
    read_records,
    take_pages,
    union_pages,
    with_empty_flag,
)
from tierlake.operators.preview import preview
from tierlake.plans.medallion import Medallion, row_counts, run
from tierlake.session import mount, scratch
from tierlake.sinks.refresh import refresh
from tierlake.sources.layers import list_files, read_layer
from tierlake.sources.pages import land_pages, read_page_files, read_pages

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

PAGE_SIZE = 50
# Pages that a Python worker gets at a time.
FRAME_PAGES = 500


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that checks it."""

    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        ORACLE_SQL[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def struct_type(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TEXT, REAL, LONG, INT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()


# --- Input pages -----------------------------------------------------------


def packed(records: DataFrame, number: Column) -> DataFrame:
    """Records as JSON pages of ``PAGE_SIZE``, by a unique running ``number``.

    A page has at most ``PAGE_SIZE`` records because the number is unique; it
    is an error if it is not, found by counts before any page is put together.
    Null fields are left out of the JSON.
    """
    page = F.floor(number / PAGE_SIZE).cast("bigint")
    counts = records.groupBy(page.alias("page")).count()
    facts = counts.agg(
        F.max("count").alias("most"), F.max("page").alias("last"), F.count("*").alias("n")
    ).first()
    if facts.n and (facts.most > PAGE_SIZE or facts.last + 1 != facts.n):
        raise ValueError("the numbers must be unique, from 0 on, without a gap of a page")
    return (
        records.select(page.alias("page"), F.struct(*records.columns).alias("record"))
        .groupBy("page")
        .agg(F.to_json(F.collect_list("record")).alias("body"))
        .select("page", F.lit(200).alias("status"), "body")
    )


def landed(
    spark: SparkSession, pages: DataFrame, end: Column | None = None, form: str = "parquet"
) -> str:
    """Store ``pages``, then what ``end`` makes of them, then every page once more.

    The copies carry page numbers beyond the end, so a correct reader leaves
    all of them out. ``end`` is the struct ``(status, body)`` of the page
    between; without it that page number is missing.
    """
    path = f"{scratch(spark)}/pages"
    stored = f"{path}/first"
    with_empty_flag(pages).write.parquet(stored)
    first = spark.read.parquet(stored)
    last = first.agg(F.max("page")).scalar()
    again = first.withColumn("page", F.col("page") + last + 2)
    parts = [first, again]
    if end is not None:
        closing = first.where(F.col("page") == last).select(
            (F.col("page") + 1).alias("page"), end.alias("end")
        )
        parts.append(with_empty_flag(closing.select("page", "end.status", "end.body")))
    everything = union_pages(*parts)
    if form == "json":
        everything.drop("empty").write.json(f"{path}/all")
    else:
        everything.write.parquet(f"{path}/all")
    return f"{path}/all"


def closing_page(status: int, body: str | None) -> Column:
    return F.struct(F.lit(status).alias("status"), F.lit(body).cast("string").alias("body"))


NATURAL_END = (200, "[]")

EVENT = struct_type(event_id=TEXT, ts=TEXT, event_type=TEXT, visitor=TEXT, value=REAL, k=REAL)


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as pages; some fields missing, ``k`` as text, ``value`` as a number."""
    events = table(spark, sf_dir, "events")
    records = events.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") >= 5, F.col("user_id")).alias("visitor"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
        json_field("props", "k").alias("k"),
        F.lit("not in the schema").alias("extra"),
    )
    return packed(records, F.col("event_id"))


EVENT_SQL = """
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
           nullif(event_type, 'error') AS event_type,
           CASE WHEN value >= 5 THEN CAST(user_id AS VARCHAR) END AS visitor,
           CASE WHEN event_type <> 'view' THEN value END AS value,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
    FROM events"""

EVENT_FILLED_SQL = f"""
    SELECT event_id, coalesce(ts, 'TBD') AS ts,
           coalesce(event_type, 'TBD') AS event_type, coalesce(visitor, 'TBD') AS visitor,
           coalesce(value, -1.0) AS value, coalesce(k, -1.0) AS k
    FROM ({EVENT_SQL})"""

DOCUMENT = struct_type(doc_id=TEXT, text=TEXT, lang=TEXT, source=TEXT, n_chars=LONG)


def document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, whole, as pages; German ones without a language."""
    documents = table(spark, sf_dir, "documents")
    records = documents.withColumn("lang", F.nullif("lang", F.lit("de")))
    return packed(records, F.col("doc_id"))


# --- Pages to records ------------------------------------------------------


def event_records(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    return read_records(take_pages(read_pages(spark, path, form)), EVENT)


@query(EVENT_SQL)
def paged_json_ingest(spark, sf_dir):
    path = landed(spark, event_pages(spark, sf_dir), closing_page(*NATURAL_END))
    return event_records(spark, path)


@query(EVENT_SQL)
def paged_json_lines(spark, sf_dir):
    path = landed(spark, event_pages(spark, sf_dir), closing_page(200, " [ ] "), form="json")
    return event_records(spark, path, "json")


@query(EVENT_SQL)
def paged_stop_on_error(spark, sf_dir):
    path = landed(spark, event_pages(spark, sf_dir), closing_page(500, "server error"))
    return event_records(spark, path)


@query(EVENT_SQL)
def paged_stop_on_gap(spark, sf_dir):
    return event_records(spark, landed(spark, event_pages(spark, sf_dir)))


@query(EVENT_SQL)
def paged_mixed_flag(spark, sf_dir):
    """Half of the pages have the ``empty`` flag, half were landed without it."""
    path = landed(spark, event_pages(spark, sf_dir), closing_page(*NATURAL_END))
    pages, mixed = spark.read.parquet(path), f"{scratch(spark)}/mixed"
    pages.where("page % 2 = 0").write.parquet(mixed)
    pages.where("page % 2 = 1").drop("empty").write.mode("append").parquet(mixed)
    return event_records(spark, mixed)


@query(EVENT_SQL)
def paged_fail_mode(spark, sf_dir):
    """An end that must be, and is, an empty page."""
    path = landed(spark, event_pages(spark, sf_dir), closing_page(*NATURAL_END))
    return read_records(take_pages(read_pages(spark, path), on_bad_page="fail"), EVENT)


@query(
    f"""SELECT 'empty' AS cause, ceil(count(*) / {PAGE_SIZE})::BIGINT AS stop, 200 AS status FROM events
        UNION ALL
        SELECT 'refused', ceil(count(*) / {PAGE_SIZE})::BIGINT, 503 FROM events
        UNION ALL
        SELECT 'missing', ceil(count(*) / {PAGE_SIZE})::BIGINT, NULL FROM events"""
)
def paged_end_reason(spark, sf_dir):
    """Where the events' pages end and why, for three ways to end."""
    pages = event_pages(spark, sf_dir)
    found = []
    for end in (closing_page(*NATURAL_END), closing_page(503, None), None):
        at = find_end(read_pages(spark, landed(spark, pages, end)))
        found.append((at.cause, at.stop, at.status))
    return spark.createDataFrame(found, "cause STRING, stop BIGINT, status INT")


def page_service(pages: DataFrame, folder: str, name: str = "{page}.json") -> None:
    """A file ``<page>.json`` per page, written by the tasks; stands in for a paged service.

    Another ``name`` may lie in a folder a page.
    """
    place = folder.removeprefix("file://").removeprefix("file:")
    Path(place).mkdir(parents=True, exist_ok=True)

    def write(frames):
        for frame in frames:
            for page, body in zip(frame["page"], frame["body"], strict=True):
                path = f"{place}/{name.format(page=page)}"
                if "/" in name:
                    os.makedirs(os.path.dirname(path), exist_ok=True)
                Path(path).write_text(body, encoding="utf-8")
            yield frame[["page"]]

    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark, before = pages.sparkSession, pages.sparkSession.conf.get(rows)
    most = int(before)
    spark.conf.set(rows, str(min(FRAME_PAGES, most) if most > 0 else FRAME_PAGES))
    try:
        pages.select("page", "body").mapInPandas(write, "page BIGINT").count()
    finally:
        spark.conf.set(rows, before)


def page_folders(pages: DataFrame, folder: str) -> None:
    """A folder ``page=<page>`` with one text file per page.

    Without Hadoop's native library Spark's text writer starts six processes,
    for permissions, a file it makes so in a local folder; there the tasks
    write the files themselves.
    """
    if Files(pages.sparkSession).local(folder) is None:
        body = F.col("body").alias("value")
        by_page = pages.select("page", body).repartition(F.col("page"))
        by_page.write.partitionBy("page").text(folder)
    else:
        lines = pages.withColumn("body", F.concat("body", F.lit("\n")))
        page_service(lines, folder, "page={page}/body.txt")


@query(EVENT_SQL)
def paged_files(spark, sf_dir):
    """One file a page, its number in the path."""
    path = landed(spark, event_pages(spark, sf_dir), closing_page(*NATURAL_END))
    files = f"{scratch(spark)}/files"
    page_folders(spark.read.parquet(path), files)
    pages = read_page_files(spark, files, number=r"/page=(\d+)/")
    return read_records(take_pages(pages), EVENT)


@query(EVENT_SQL)
def paged_landing_resumed(spark, sf_dir):
    """A landing that fails in a later wave and goes on there when it is called again."""
    pages = spark.read.parquet(landed(spark, event_pages(spark, sf_dir), closing_page(*NATURAL_END)))
    last = pages.agg(F.max("page")).first()[0]
    folder = f"{scratch(spark)}/service"
    # Waves of 16, 32, 64, ... pages; of the third one nothing is there at first.
    page_service(pages.where("page < 48"), folder)
    url = f"file://{folder.removeprefix('file://').removeprefix('file:')}/{{page}}.json"
    target = f"{scratch(spark)}/landed"
    try:
        land_pages(spark, url, target, first_wave=16, pages_per_task=16)
    except (PySparkException, Py4JJavaError):
        page_service(pages.where("page >= 48"), folder)
        beyond = spark.range(last + 1, 3 * last + 64).select(
            F.col("id").alias("page"), F.lit("[]").alias("body")
        )
        page_service(beyond, folder)
        land_pages(spark, url, target, first_wave=16, pages_per_task=16)
    return read_records(take_pages(read_pages(spark, target)), EVENT)


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, nullif(lang, 'de') AS lang, source, n_chars
       FROM documents"""
)
def paged_json_documents(spark, sf_dir):
    path = landed(spark, document_pages(spark, sf_dir), closing_page(*NATURAL_END))
    return read_records(take_pages(read_pages(spark, path)), DOCUMENT)


@query(f"SELECT * FROM ({EVENT_SQL}) UNION ALL SELECT * FROM ({EVENT_SQL})")
def pages_union_all(spark, sf_dir):
    path = landed(spark, event_pages(spark, sf_dir), closing_page(*NATURAL_END))
    return union_pages(event_records(spark, path), event_records(spark, path))


# --- Scalar functions ------------------------------------------------------


def as_is(text: Column) -> Column:
    return text


# One number text per column, by the shape it tests.
NUMBER_SHAPES: dict[str, Callable[[Column], Column]] = {
    "plain": as_is,
    "blanks": lambda v: F.concat(F.lit(" \t"), v, F.lit(" ")),
    "signed": lambda v: F.concat(F.lit("+"), v),
    "exponent": lambda v: F.concat(v, F.lit("E-3")),
    "underscore": lambda v: F.concat(F.lit("1_0"), v),
    "two_underscores": lambda v: F.concat(F.lit("1__0"), v),
    "suffix": lambda v: F.concat(v, F.lit("d")),
    "hex": lambda v: F.concat(F.lit("0x"), v),
    "two_numbers": lambda v: F.concat(v, F.lit(" "), v),
}


@query(
    """SELECT l_orderkey, l_linenumber,
              TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) AS plain,
              TRY_CAST(trim(CAST(l_quantity AS VARCHAR)) AS DOUBLE) AS blanks,
              TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) AS signed,
              TRY_CAST(concat(CAST(l_quantity AS VARCHAR), 'E-3') AS DOUBLE) AS exponent,
              TRY_CAST(concat('10', CAST(l_quantity AS VARCHAR)) AS DOUBLE) AS underscore,
              TRY_CAST(concat('1__0', CAST(l_quantity AS VARCHAR)) AS DOUBLE) AS two_underscores,
              TRY_CAST(concat(CAST(l_quantity AS VARCHAR), 'd') AS DOUBLE) AS suffix,
              TRY_CAST(concat('0x', CAST(l_quantity AS VARCHAR)) AS DOUBLE) AS hex,
              TRY_CAST(concat(CAST(l_quantity AS VARCHAR), ' ', CAST(l_quantity AS VARCHAR))
                       AS DOUBLE) AS two_numbers,
              TRY_CAST(l_returnflag AS DOUBLE) AS letter,
              CASE l_linestatus WHEN 'O' THEN CAST('inf' AS DOUBLE) END AS special
       FROM lineitem"""
)
def safe_double_shapes(spark, sf_dir):
    text = F.col("l_quantity").cast("string")
    texts = {name: shape(text) for name, shape in NUMBER_SHAPES.items()}
    texts["letter"] = F.col("l_returnflag")
    texts["special"] = F.when(F.col("l_linestatus") == "O", F.lit(" Infinity")).otherwise("")
    keys = ["l_orderkey", "l_linenumber"]
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem.select(*keys, *(text.alias(name) for name, text in texts.items())).select(
        *keys, *(safe_double(name).alias(name) for name in texts)
    )


@query(
    """SELECT doc_id, count(TRY_CAST(word AS DOUBLE)) AS numbers, count(*) AS words
       FROM (SELECT doc_id, unnest(string_split(replace(text, chr(10), ' '), ' ')) AS word
             FROM documents)
       GROUP BY doc_id"""
)
def safe_double_words(spark, sf_dir):
    """How many words of each whole text are numbers."""
    documents = table(spark, sf_dir, "documents")
    # Split in a projection of its own: both counts then use the one list.
    split = documents.select("doc_id", F.split(F.translate("text", "\n", " "), " ").alias("list"))
    numbers = F.size(F.filter("list", lambda word: safe_double(word).isNotNull()))
    return split.select(
        "doc_id", numbers.cast("bigint").alias("numbers"), F.size("list").cast("bigint").alias("words")
    )


@query(
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
              json_extract_string(props, '$.absent') AS absent
       FROM events"""
)
def json_field_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        safe_double(json_field("props", "k")).alias("k"),
        json_field("props", "absent").alias("absent"),
    )


@query(
    """SELECT event_id,
              CASE event_type
                WHEN 'click' THEN nullif(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0)
                WHEN 'view' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE)
                WHEN 'error' THEN CASE WHEN value >= 5 THEN 1.0 END
              END AS k
       FROM events"""
)
def json_number_coercion(spark, sf_dir):
    """``k`` as a number, a text, a truth value, a list or null, by the type of the event."""
    kind = F.col("event_type")
    k = json_field("props", "k")
    value = (
        F.when(kind == "click", k)
        .when(kind == "view", F.concat(F.lit('"'), k, F.lit('"')))
        .when(kind == "error", (F.col("value") >= 5).cast("string"))
        .when(kind == "signup", F.concat(F.lit("["), k, F.lit("]")))
        .otherwise("null")
    )
    return (
        table(spark, sf_dir, "events")
        .select("event_id", F.parse_json(value).alias("k"))
        .select("event_id", safe_double_variant("k").alias("k"))
    )


# --- Columns ---------------------------------------------------------------


def events_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") >= 5, F.col("value")).alias("value"),
        F.when(F.col("event_type") != "view", F.col("user_id")).alias("user_id"),
        F.when(F.col("event_type") != "click", F.col("props")).otherwise("").alias("props"),
    )


EVENTS_WITH_NULLS_SQL = """
    SELECT event_id, nullif(event_type, 'error') AS event_type,
           CASE WHEN value >= 5 THEN value END AS value,
           CASE WHEN event_type <> 'view' THEN user_id END AS user_id,
           CASE WHEN event_type <> 'click' THEN props ELSE '' END AS props
    FROM events"""

EVENTS_FILLED_SQL = f"""
    SELECT event_id, coalesce(event_type, 'TBD') AS event_type, coalesce(value, -1.0) AS value,
           user_id, coalesce(props, 'TBD') AS props
    FROM ({EVENTS_WITH_NULLS_SQL})"""


@query(EVENTS_FILLED_SQL)
def fill_defaults_by_type(spark, sf_dir):
    return fill_defaults(events_with_nulls(spark, sf_dir))


@query(f"SELECT event_id, event_type, user_id FROM ({EVENTS_WITH_NULLS_SQL}) WHERE value IS NULL")
def null_rows_filter(spark, sf_dir):
    return null_rows(events_with_nulls(spark, sf_dir), "value").select(
        "event_id", "event_type", "user_id"
    )


@query("SELECT c_name, c_mktsegment, c_acctbal, c_custkey FROM customer")
def silver_project(spark, sf_dir):
    job = Medallion(
        pages="", bronze="", silver="", gold="",
        schema=table(spark, sf_dir, "customer").schema,
        columns=["c_name", "c_mktsegment", "c_acctbal", "c_custkey"],
        keys=[], counted="", count_name="",
    )
    return job.silver_frame(table(spark, sf_dir, "customer"))


@query(
    """SELECT o_orderstatus, CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_totalprice,
              CAST(NULL AS VARCHAR) AS note, CAST(NULL AS DOUBLE) AS weight
       FROM orders"""
)
def schema_align(spark, sf_dir):
    declared = struct_type(
        o_orderstatus=TEXT, o_orderkey=TEXT, o_totalprice=REAL, note=TEXT, weight=REAL
    )
    return align(table(spark, sf_dir, "orders"), declared)


# --- Counts and previews ---------------------------------------------------


@query(
    """SELECT p_type, p_brand, p_size, count(p_partkey) AS part_count
       FROM part GROUP BY p_type, p_brand, p_size"""
)
def gold_count_by_keys(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return count_by(part, ["p_type", "p_brand", "p_size"], "p_partkey", "part_count")


@query(
    """SELECT l_suppkey, l_returnflag, l_linestatus, count(l_orderkey) AS line_count
       FROM lineitem GROUP BY l_suppkey, l_returnflag, l_linestatus"""
)
def gold_count_lines(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    return count_by(lineitem, ["l_suppkey", "l_returnflag", "l_linestatus"], "l_orderkey", "line_count")


@query(
    f"""SELECT event_type, count(user_id) AS known, count(*) AS n
        FROM ({EVENTS_WITH_NULLS_SQL}) GROUP BY event_type"""
)
def count_ignores_null(spark, sf_dir):
    events = events_with_nulls(spark, sf_dir)
    known = count_by(events, ["event_type"], "user_id", "known")
    every = count_by(events, ["event_type"], "event_id", "n").withColumnRenamed("event_type", "kind")
    same = F.col("event_type").eqNullSafe(F.col("kind"))
    return known.join(every, same).select("event_type", "known", "n")


@query(
    """SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate)
       FROM orders ORDER BY o_orderkey LIMIT 20"""
)
def preview_top_n(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    dated = orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return preview(dated, 20, ["o_orderkey"])


# --- Stored tables ---------------------------------------------------------


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def bronze_roundtrip(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    done = refresh(documents, f"{scratch(spark)}/documents")
    return read_layer(spark, done.target, documents.schema)


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def sized_files_roundtrip(spark, sf_dir):
    """At most 100 rows a file."""
    documents = table(spark, sf_dir, "documents")
    done = refresh(documents, f"{scratch(spark)}/documents", max_records=100)
    return read_layer(spark, done.target, documents.schema)


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def packed_files_roundtrip(spark, sf_dir):
    """Many small files, packed into a few of about 256 KB before they are published."""
    documents = table(spark, sf_dir, "documents")
    done = refresh(
        documents, f"{scratch(spark)}/documents", max_records=100, file_bytes=256 << 10
    )
    return read_layer(spark, done.target, documents.schema)


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def concurrent_refreshes(spark, sf_dir):
    """Four writers of one table at the same time, twice; the last one's rows are there, whole."""
    documents, path = table(spark, sf_dir, "documents"), f"{scratch(spark)}/documents"
    for swap in ("pointer", "rename"):
        with ThreadPoolExecutor(4) as writers:
            list(writers.map(lambda _, s=swap: refresh(documents, f"{path}-{s}", swap=s), range(4)))
    by_pointer = read_layer(spark, f"{path}-pointer", documents.schema)
    return by_pointer.intersectAll(read_layer(spark, f"{path}-rename", documents.schema))


@query(
    """SELECT 'events' AS layer, 0::BIGINT AS markers, count(*) AS rows FROM events
       UNION ALL SELECT 'documents', 0, count(*) FROM documents"""
)
def no_marker_files(spark, sf_dir):
    """The files of two layers, by folder and by run: data only."""
    events = refresh(events_with_nulls(spark, sf_dir), f"{scratch(spark)}/events", "event_type")
    documents = refresh(
        table(spark, sf_dir, "documents"), f"{scratch(spark)}/documents", swap="pointer"
    )
    counts = [
        list_files(spark, done.target).agg(
            F.lit(name).alias("layer"),
            F.count_if(~F.col("is_data")).alias("markers"),
            F.lit(done.rows).cast("bigint").alias("rows"),
        )
        for name, done in (("events", events), ("documents", documents))
    ]
    return counts[0].unionByName(counts[1])


@query(EVENTS_FILLED_SQL)
def partition_hot_value(spark, sf_dir):
    """Values far over the advised size, all read by one task, are written by many."""
    filled = fill_defaults(events_with_nulls(spark, sf_dir)).coalesce(1)
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    before = {name: spark.conf.get(name) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        done = refresh(filled, f"{scratch(spark)}/events", "event_type")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return read_layer(spark, done.target, filled.schema)


@query(EVENTS_FILLED_SQL)
def partition_roundtrip(spark, sf_dir):
    filled = fill_defaults(events_with_nulls(spark, sf_dir))
    done = refresh(filled, f"{scratch(spark)}/events", "event_type")
    return read_layer(spark, done.target, filled.schema)


@query("SELECT p_partkey, lpad(CAST(p_size AS VARCHAR), 3, '0') AS size_code, p_name FROM part")
def partition_number_like_text(spark, sf_dir):
    """Folder values such as ``007`` come back as text, in their place."""
    part = table(spark, sf_dir, "part").select(
        "p_partkey", F.lpad(F.col("p_size").cast("string"), 3, "0").alias("size_code"), "p_name"
    )
    done = refresh(part, f"{scratch(spark)}/part", "size_code", cluster=False)
    return read_layer(spark, done.target, part.schema)


@query(
    """SELECT nullif(event_type, 'error') AS event_type, count(event_id) AS n
       FROM events GROUP BY 1"""
)
def partition_empty_is_null(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("event_type"),
    )
    done = refresh(events, f"{scratch(spark)}/events", "event_type")
    return count_by(read_layer(spark, done.target, events.schema), ["event_type"], "event_id", "n")


@query("SELECT * FROM customer")
def full_refresh_idempotent(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    target = f"{scratch(spark)}/customer"
    for _ in range(2):
        refresh(customer, target)
    return read_layer(spark, target, customer.schema)


@query("SELECT * FROM customer")
def full_refresh_replaces(spark, sf_dir):
    """The table holds the last run only; here with a pointer instead of a rename."""
    customer = table(spark, sf_dir, "customer")
    target = f"{scratch(spark)}/customer"
    for content in (union_pages(customer, customer), customer):
        refresh(content, target, swap="pointer")
    return read_layer(spark, target, customer.schema)


# --- The layered job -------------------------------------------------------


def event_job(spark: SparkSession, sf_dir: str, form: str = "parquet") -> Medallion:
    pages = landed(spark, event_pages(spark, sf_dir), closing_page(500, None), form)
    base = scratch(spark)
    return Medallion(
        pages=pages,
        page_format=form,
        bronze=f"{base}/bronze",
        silver=f"{base}/silver",
        gold=f"{base}/gold",
        schema=EVENT,
        keys=["event_type", "visitor"],
        counted="event_id",
        count_name="event_count",
        partition_by="event_type",
    )


def document_job(spark: SparkSession, sf_dir: str) -> Medallion:
    pages = landed(spark, document_pages(spark, sf_dir), closing_page(*NATURAL_END))
    base = scratch(spark)
    return Medallion(
        pages=pages,
        bronze=f"{base}/bronze",
        silver=f"{base}/silver",
        gold=f"{base}/gold",
        schema=DOCUMENT,
        keys=["lang", "source"],
        counted="doc_id",
        count_name="document_count",
        partition_by="lang",
    )


@query(
    f"""SELECT event_type, visitor, count(event_id) AS event_count
        FROM ({EVENT_FILLED_SQL}) GROUP BY event_type, visitor"""
)
def medallion_gold(spark, sf_dir):
    job = event_job(spark, sf_dir)
    run(spark, job)
    return read_layer(spark, job.gold, job.gold_schema)


@query(
    f"""SELECT event_type, visitor, count(event_id) AS event_count
        FROM ({EVENT_FILLED_SQL}) GROUP BY event_type, visitor"""
)
def medallion_on_mount(spark, sf_dir):
    """Pages and layers on another scheme, by either swap."""
    job = event_job(spark, sf_dir)
    lake = mount(spark, {"/pages": job.pages, "/lake": scratch(spark)})
    layers = {name: f"{lake}/lake/{name}" for name in ("bronze", "silver", "gold")}
    run(spark, replace(job, pages=f"{lake}/pages", **layers, swap="pointer"))
    again = replace(job, pages=f"{lake}/pages", **{k: f"{v}-2" for k, v in layers.items()})
    run(spark, again)
    return read_layer(spark, layers["gold"], job.gold_schema).intersectAll(
        read_layer(spark, again.gold, job.gold_schema)
    )


@query(
    f"""SELECT event_type, visitor, count(event_id) AS event_count
        FROM ({EVENT_FILLED_SQL}) GROUP BY event_type, visitor"""
)
def medallion_json_lines(spark, sf_dir):
    """The same from pages as JSON lines, which are read once."""
    job = event_job(spark, sf_dir, "json")
    run(spark, job)
    return read_layer(spark, job.gold, job.gold_schema)


@query(EVENT_FILLED_SQL)
def medallion_silver(spark, sf_dir):
    job = event_job(spark, sf_dir)
    run(spark, job, ["bronze", "silver"])
    return read_layer(spark, job.silver, job.silver_schema)


@query(
    """SELECT coalesce(nullif(lang, 'de'), 'TBD') AS lang, source, count(*) AS document_count
       FROM documents GROUP BY ALL"""
)
def medallion_documents(spark, sf_dir):
    job = document_job(spark, sf_dir)
    run(spark, job)
    return read_layer(spark, job.gold, job.gold_schema)


@query(
    f"""SELECT 'bronze' AS layer, count(*) AS n FROM ({EVENT_SQL})
        UNION ALL SELECT 'silver', count(*) FROM ({EVENT_FILLED_SQL})
        UNION ALL SELECT 'gold', count(*) FROM
            (SELECT DISTINCT event_type, visitor FROM ({EVENT_FILLED_SQL}))"""
)
def layer_row_counts(spark, sf_dir):
    return row_counts(spark, run(spark, event_job(spark, sf_dir)))
