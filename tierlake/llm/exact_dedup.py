"""Exact deduplication through disk-backed streaming state (operator 7).

Deliveries of documents *land* as small rows ``(digest, doc_id, row, locator)``.
A stateful stream folds what has landed since its last run into keyed state in
RocksDB: per digest the largest ``doc_id``, where its content lies, and the
number of rows seen. The state never expires, so a copy is found however long
after its original it arrives. The answer is read from the state itself; a hit
counts only after the whole normalised texts have been compared.

Only DataFrame functions run here. Per-digest folding starts on the map side,
so a group with a third of all rows reaches the state as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.llm.common import ascii_lower, broadcast_if_small, free_name, stored, texts
from tierlake.session import scratch

STATE = "spark.sql.streaming.stateStore"
STATE_SETTINGS = {
    f"{STATE}.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Upload what changed, and hold no disk for logs in advance (4 MB a partition).
    f"{STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{STATE}.rocksdb.allowFAllocate": "false",
    # Small write buffers: each partition's first block of one is an eighth of it,
    # outside the heap.
    f"{STATE}.rocksdb.writeBufferSizeMB": "4",
    # All partitions of an executor share one bounded cache, write buffers included.
    f"{STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{STATE}.rocksdb.maxMemoryUsageMB": "96",
    # A partition is open only while a task works on it: memory goes with the tasks
    # that run, not with the partitions an executor has met.
    f"{STATE}.unloadOnCommit": "true",
}
#: Members of groups that are sent to every task instead of shuffling all texts.
BROADCAST_ROWS = 500_000


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def normalised(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = texts(docs, id_col, text_col)
    return rows.select("doc_id", ascii_lower(F.coalesce("text", F.lit(""))).alias("norm"))


class DigestState:
    """Landed digests and the stream's state, both under ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, digest=sha256):
        self.spark, self.digest = spark, digest
        self.landing, self.state = f"{folder}/landed", f"{folder}/state"

    def land(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Append a delivery: one row of about 50 bytes per document."""
        rows = normalised(docs, id_col, text_col).select(
            self.digest(F.col("norm")).alias("digest"),
            F.sha2("norm", 256).alias("text_sha256"),
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            F.input_file_name().alias("locator"),
        )
        rows.write.mode("append").parquet(self.landing)

    def landed(self) -> DataFrame:
        return self.spark.read.parquet(self.landing)

    def fold(self) -> None:
        """Run the stream over what landed since the last call, then stop it."""
        spark = self.spark
        before = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
        for name, value in STATE_SETTINGS.items():
            spark.conf.set(name, value)
        try:
            held = (
                spark.readStream.schema(self.landed().schema)
                .parquet(self.landing)
                .groupBy("digest")
                .agg(
                    F.max(F.struct("doc_id", "row", "locator")).alias("keep"),
                    F.count(F.lit(1)).alias("group_size"),
                )
            )
            query = (
                held.writeStream.format("noop")
                .outputMode("update")
                .option("checkpointLocation", self.state)
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()
        finally:
            for name, value in before.items():
                if value is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, value)

    def held(self) -> DataFrame:
        """``digest, keep_id, keep_row, locator, group_size``, read from the state store."""
        rows = self.spark.read.format("statestore").load(self.state)
        fields = rows.schema["value"].dataType.fields
        keep = next(f.name for f in fields if isinstance(f.dataType, T.StructType))
        size = next(f.name for f in fields if isinstance(f.dataType, T.LongType))
        return rows.select(
            F.col("key.digest").alias("digest"),
            F.col(f"value.`{keep}`.doc_id").alias("keep_id"),
            F.col(f"value.`{keep}`.row").alias("keep_row"),
            F.col(f"value.`{keep}`.locator").alias("locator"),
            F.col(f"value.`{size}`").alias("group_size"),
        )


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folder: str | None = None,
    digest=sha256,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; of equal texts the
    row with the largest ``doc_id`` stays. A null text is an empty one; empty
    texts form a group. A null ``doc_id`` sorts below all others. Of rows
    repeated with one ``doc_id`` and one text exactly one stays. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    if not docs.columns or docs.limit(1).count() == 0:
        kind = docs.schema[id_col].dataType
        schema = T.StructType(
            [T.StructField("doc_id", kind), T.StructField("keep_id", kind)]
            + [T.StructField("group_size", T.LongType()), T.StructField("kept", T.BooleanType())]
            + [T.StructField("text_sha256", T.StringType())]
        )
        return spark.createDataFrame([], schema)
    state = DigestState(spark, folder or scratch(spark), digest)
    state.land(docs, id_col, text_col)
    state.fold()
    landed = state.landed()
    held = stored(state.held())
    rows = landed.join(held.drop("locator"), "digest").select(
        "doc_id",
        "row",
        "digest",
        "text_sha256",
        "keep_id",
        "group_size",
        (F.col("row").eqNullSafe(F.col("keep_row")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias(
            "kept"
        ),
    )
    rows = stored(rows)
    result = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]

    clashes = unequal_hits(docs, rows, id_col, text_col, digest)
    if clashes.isEmpty():
        return rows.select(*result)
    # Two different texts share a digest: those groups are formed anew by their whole texts.
    mixed = rows.join(clashes, "digest", "left_semi").select("doc_id", "row", "text_sha256")
    whole = normalised(docs, id_col, text_col).dropDuplicates()
    anew = mixed.join(
        whole.select("doc_id", "norm", F.sha2("norm", 256).alias("text_sha256")),
        ["doc_id", "text_sha256"],
    )
    groups = anew.groupBy("norm").agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    anew = anew.join(groups, "norm").select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        F.col("row").eqNullSafe(F.col("keep.row")).alias("kept"),
        "text_sha256",
    )
    return rows.join(clashes, "digest", "left_anti").select(*result).unionByName(anew)


def unequal_hits(
    docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, digest
) -> DataFrame:
    """Digests under which the texts differ: every hit is compared with the text that stays.

    Only texts of groups of two or more are moved.
    """
    members = rows.where(F.col("group_size") > 1)
    ids = members.select(F.col("doc_id").alias("member")).distinct()
    ids = broadcast_if_small(ids, BROADCAST_ROWS)
    whole = normalised(docs, id_col, text_col)
    whole = whole.join(ids, F.col("doc_id").eqNullSafe(F.col("member")), "left_semi")
    whole = whole.withColumn("digest", digest(F.col("norm")))
    keeps = members.where("kept").select(
        F.col("digest").alias("keep_digest"), F.col("doc_id").alias("keep_id")
    )
    of_keep = (F.col("digest") == F.col("keep_digest")) & F.col("doc_id").eqNullSafe(
        F.col("keep_id")
    )
    stays = whole.join(keeps, of_keep).select("keep_digest", F.col("norm").alias("kept_norm"))
    unequal = (F.col("digest") == F.col("keep_digest")) & (F.col("norm") != F.col("kept_norm"))
    return stored(whole.join(stays, unequal).select("digest")).distinct()


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names."""
    found = exact_duplicates(docs, id_col, text_col)
    own_id, own_sha = free_name(docs, "kept_id"), free_name(docs, "kept_sha")
    kept = found.where("kept").select(
        F.col("doc_id").alias(own_id), F.col("text_sha256").alias(own_sha)
    )
    repeated = found.groupBy("doc_id").count().where("count > 1").limit(1).count() > 0
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(own_id))
    if not repeated:
        return docs.join(broadcast_if_small(kept.drop(own_sha), BROADCAST_ROWS), same, "left_semi")
    # Rows share ids: their texts tell them apart, and of equal rows one stays.
    sha = F.sha2(ascii_lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), 256)
    rows = docs.join(kept, same & (sha == F.col(own_sha)), "left_semi")
    return rows.withColumn(own_sha, sha).dropDuplicates([id_col, own_sha]).drop(own_sha)
