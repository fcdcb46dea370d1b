"""The corpus operators as queries over the given tables, with SQL where SQL can say it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm import (
    cover_tree,
    exact_dedup,
    factorisation,
    fertility,
    hilbert_shards,
    html_text,
    jaccard_join,
    line_dedup,
    mixing,
    packing,
    pivot_table,
    suffix_family,
    warc,
)
from tierlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op1_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.fertility(table(spark, sf_dir, "documents"))


@query
def op2_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_family.drop_substrings(table(spark, sf_dir, "documents"))
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


# Every window of 100 bytes, as hexadecimal digits, with all others.
ORACLE_SQL["op2_suffix_family"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS k
  FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - 99)) AS i FROM d)),
later AS (
  SELECT doc_id, i
  FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS place FROM win)
  WHERE place > 1),
marked AS (
  SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 100, true) AS new
  FROM later),
numbered AS (
  SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
span AS (
  SELECT doc_id, min(i) AS b, max(i) + 100 AS e FROM numbered GROUP BY doc_id, run),
edge AS (
  SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS was FROM span
  UNION ALL
  SELECT d.doc_id, len(h) // 2, NULL, coalesce(max(e), 0)
  FROM d LEFT JOIN span USING (doc_id) GROUP BY d.doc_id, h)
SELECT doc_id, any_value(len(h) // 2) AS n_bytes,
       CAST(coalesce(sum(e - b), 0) AS BIGINT) AS n_removed, count(e) AS n_spans,
       sha256(unhex(string_agg(substr(h, 2 * was + 1, 2 * (b - was)), '' ORDER BY b))) AS kept_sha256
FROM edge JOIN d USING (doc_id) GROUP BY doc_id
"""


@query
def op3_text_to_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


ORACLE_SQL["op4_line_dedup"] = """
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line),
gone AS (
  SELECT key FROM keyed WHERE length(key) >= 1
  GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(gone.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
                       FILTER (WHERE gone.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN gone USING (key) GROUP BY doc_id
"""


@query
def op5_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op6_factorisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return factorisation.score_quality(docs, labels)


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


# In this SQL, translate() stands for lower-casing A-Z only.
ORACLE_SQL["op7_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM d WINDOW same AS (PARTITION BY norm)
"""


@query
def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.hilbert_shards(table(spark, sf_dir, "documents"))


@query
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return documents.drop("copy")


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


ORACLE_SQL["op10_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
        FROM words WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM shared JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b
  WHERE 100 * shared.n >= 80 * (p.n + q.n - shared.n)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, edge.b FROM reach JOIN edge ON edge.a = reach.other)
SELECT reach.doc_id, coalesce(any_value(size.n), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN size USING (doc_id) GROUP BY reach.doc_id
"""


@query
def op11_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cover_tree.compress(table(spark, sf_dir, "embeddings"))
    entries = [str(x) for book in found.codebooks for entry in book for x in entry]
    digest = hashlib.sha256(",".join(entries).encode()).hexdigest()
    return cover_tree.with_label_error(found.codes).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )


def exact_floor(total: str, count: str) -> str:
    """SQL for ``floor(total / count)`` of whole numbers."""
    return f"((({total}) - ((({total}) % {count}) + {count}) % {count}) // {count})"


def cover_tree_sql(rounds: int = cover_tree.ROUNDS) -> str:
    """Every part against every entry, round by round."""
    steps = [
        f"""
near_{k} AS MATERIALIZED (
  SELECT vec_id, part, min({{'far': far, 'entry': entry}}) AS best
  FROM (SELECT vec_id, part, entry, sum((c.x - b.x) * (c.x - b.x)) AS far
        FROM component c JOIN book_{k} b USING (part, place) GROUP BY ALL)
  GROUP BY ALL),
book_{k + 1} AS MATERIALIZED (
  SELECT part, entry, place, coalesce(mean.x, old.x) AS x
  FROM book_{k} old LEFT JOIN (
    SELECT part, best.entry AS entry, place, {exact_floor("sum(x)", "count(*)")} AS x
    FROM component JOIN near_{k} USING (vec_id, part) GROUP BY ALL) mean
  USING (part, entry, place)),"""
        for k in range(rounds + 1)
    ]
    return f"""
WITH component AS MATERIALIZED (
  SELECT vec_id, i // (size // 8) AS part, i % (size // 8) AS place, x
  FROM (SELECT vec_id, len(embedding) AS size, unnest(range(len(embedding))) AS i,
               CAST(floor(4096 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x
        FROM embeddings
        WHERE len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0)),
book_0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part, place ORDER BY vec_id) - 1 AS entry, place, x
  FROM component
  WHERE vec_id IN (SELECT DISTINCT vec_id FROM component ORDER BY vec_id LIMIT 16)),
{"".join(steps)}
coded AS (
  SELECT vec_id, string_agg(printf('%02x', CAST(best.entry AS INTEGER)), '' ORDER BY part) AS code,
         CAST(sum(best.far) AS BIGINT) AS error
  FROM near_{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place))
        FROM book_{rounds}) AS codebooks_sha256
FROM coded JOIN embeddings USING (vec_id)
"""


ORACLE_SQL["op11_cover_tree"] = cover_tree_sql()


@query
def op12_pivot_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pivot_table.cluster(table(spark, sf_dir, "embeddings"))
    rows = [
        (k, sum_, hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest())
        for k, (centroid, sum_) in enumerate(zip(found.centroids, found.inertias, strict=True))
    ]
    of = spark.createDataFrame(rows, "of int, cluster_inertia long, centroid_sha256 string")
    members = found.members.join(F.broadcast(of), F.col("cluster") == F.col("of"))
    return members.select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        F.lit(sum(found.inertias)).cast("long").alias("inertia"),
        "centroid_sha256",
    )


def pivot_table_sql(rounds: int = pivot_table.ROUNDS) -> str:
    """Every vector against every centroid, round by round."""
    steps = [
        f"""
near_{k} AS MATERIALIZED (
  SELECT vec_id, min({{'far': far, 'cluster': cluster}}) AS best
  FROM (SELECT vec_id, cluster, sum((c.x - m.x) * (c.x - m.x)) AS far
        FROM component c JOIN centroid_{k} m USING (place) GROUP BY ALL)
  GROUP BY ALL),
centroid_{k + 1} AS MATERIALIZED (
  SELECT cluster, place, coalesce(mean.x, old.x) AS x
  FROM centroid_{k} old LEFT JOIN (
    SELECT best.cluster AS cluster, place, {exact_floor("sum(x)", "count(*)")} AS x
    FROM component JOIN near_{k} USING (vec_id) GROUP BY ALL) mean
  USING (cluster, place)),"""
        for k in range(rounds + 1)
    ]
    return f"""
WITH component AS MATERIALIZED (
  SELECT vec_id, unnest(range(len(embedding))) AS place,
         CAST(floor(1024 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
drawn AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR))) - 1 AS cluster
  FROM (SELECT DISTINCT vec_id FROM component)),
centroid_0 AS MATERIALIZED (
  SELECT cluster, place, x FROM component JOIN drawn USING (vec_id) WHERE cluster < 8),
{"".join(steps)}
digest AS (
  SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY place)) AS centroid_sha256
  FROM centroid_{rounds} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(best.far AS BIGINT) AS distance,
       CAST(sum(best.far) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.far) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near_{rounds} JOIN digest ON digest.cluster = best.cluster
"""


ORACLE_SQL["op12_pivot_table"] = pivot_table_sql()


@query
def op13_warc_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    records = warc.read_archives(warc.write_archives(pages), with_payload=False)
    kind = pages.schema["page_id"].dataType.simpleString()
    return records.select(
        warc.row_of("record_id", kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.row_of("refers_to", kind).alias("refers_to"),
    )


# Every 5 hexadecimal digits of SHA-1 are 4 digits of base 32.
ORACLE_SQL["op13_warc_ranges"] = """
WITH page AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
said AS (
  SELECT page_id, strlen(html) AS payload_bytes,
         array_to_string(
           [substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   ((CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS INTEGER)
                     >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1, 1)
            for i in range(32)], '') AS payload_digest,
         min(page_id) OVER (PARTITION BY html) AS first
  FROM page)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM said
"""
