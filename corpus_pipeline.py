"""Documents to training sequences: the corpus operators in a row.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``. Null or empty texts, repeated rows and empty
tables are treated as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm import exact_dedup, factorisation, jaccard_join, mixing, packing
from tierlake.llm.common import broadcast_if_small, free_name, stored, table

#: Row keys sent to every task instead of shuffling the documents.
BROADCAST_IDS = 500_000


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a column that tells every row apart, and its name.

    That is ``doc_id``, or a number of a new name where ids are repeated or null.
    """
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.where("n > 1 OR doc_id IS NULL").limit(1).count() == 0:
        return docs, "doc_id"
    key = free_name(docs, "row_key")
    return stored(docs.withColumn(key, F.monotonically_increasing_id())), key


def only(docs: DataFrame, key: str, keys: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of the rows of ``docs`` whose ``key`` is in the one column of ``keys``."""
    own = free_name(docs, "kept_key")
    keys = broadcast_if_small(stored(keys.toDF(own)), BROADCAST_IDS)
    kept = docs.join(keys, F.col(f"`{key}`") == F.col(own), "left_semi")
    return kept.select(*(F.col(f"`{c}`") for c in columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine accepts, row by row."""
    rows, key = keyed(docs)
    scores = factorisation.score_quality(rows, table(spark, sf_dir, "labels"), row_col=key)
    return only(rows, key, scores.where("predicted = 1").select("row"), docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts, the one with the smallest id; null is the largest."""
    rows, key = keyed(docs)
    found = jaccard_join.jaccard_components(rows, id_col=key)
    if key == "doc_id":
        first = found.where("component_id = doc_id").select("doc_id")
    else:
        ids = rows.select(F.col(f"`{key}`").alias("row"), F.col("doc_id").alias("id"))
        placed = found.join(ids, found["doc_id"] == ids["row"])
        place = F.struct(F.col("id").isNull(), "id", "row")
        first = placed.groupBy("component_id").agg(F.min_by("row", place).alias("row"))
        first = first.select("row")
    return only(rows, key, first, docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    A document that the mix takes in part, at most one a source, is there once
    more if that part is at least half of it. Documents without words are not
    in the mix.
    """
    rows, key = keyed(docs)
    taken, _ = mixing.mix(rows, id_col=key)
    own, turns = free_name(rows, "taken_key"), free_name(rows, "taken_times")
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias(turns)
    times = taken.where("size > 0").select(F.col("doc_id").alias(own), times)
    times = stored(times.where(F.col(turns) > 0))
    mixed = rows.join(broadcast_if_small(times, BROADCAST_IDS), F.col(f"`{key}`") == F.col(own))
    each = F.explode(F.sequence(F.lit(1), F.col(turns)))
    return mixed.select(*(F.col(f"`{c}`") for c in docs.columns), each.alias(own)).drop(own)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: where each piece of each document goes."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: SQL cannot train the classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
