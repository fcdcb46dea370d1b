"""Reversible line deduplication: cuckoo filters over exact reference counts (operator 4).

``LineIndex`` keeps, under one shared folder and split into shards by key
digest, two tables a version:

* ``refs``: for every line key the exact number of documents that hold it;
* ``filters``: a cuckoo filter per shard with the keys that ``min_docs``
  documents or more hold, that is, the lines to drop.

Inserting documents adds to the counts, deleting them subtracts, and only keys
that cross the threshold go into or out of a filter; when shards grow over
``SHARD_KEYS`` keys there are twice as many and the filters are built anew.
Whoever probes with a line gets no false negative; the false positives among
all keys there are (about one in 500 million) are found by probing the counts
once, and travel with the filters as exact exceptions. So documents are
rewritten in one pass without a shuffle of their texts. When filters or
exceptions outgrow ``max_filter_bytes``, lines are joined with the exact counts
instead.

Lines, keys and digests are made by built-in functions and texts never leave
the JVM: Python gets the digests of a document's lines and says which are in a
filter. A common line reaches the counts as one row per task and batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.common import BLANKS, ascii_lower, stored, texts
from tierlake.session import scratch

SLOTS = 4
KICKS = 500
#: Frequent keys a shard, at most.
SHARD_KEYS = 100_000


def lines_of(text: Column) -> Column:
    """The lines of a text; a null one is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """Blanks off both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def high_half(key: Column) -> Column:
    return F.xxhash64(key)


def low_half(key: Column) -> Column:
    """The other half of a key's 128-bit digest: the same hash from another seed."""
    return F.xxhash64(F.lit("line"), key)


def unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


class Cuckoo:
    """Buckets of four 32-bit fingerprints; a key lies in one of two buckets.

    ``table`` has one row a bucket, a power of two of them; 0 is a free slot.
    """

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.buckets = buckets
        self.table = np.zeros((buckets, SLOTS), dtype="<u4") if table is None else table

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        """Room for ``keys`` at a load of about two thirds."""
        return cls(1 << max(1, int(np.ceil(np.log2(max(1, keys) * 1.5 / SLOTS + 1)))))

    @staticmethod
    def places(low: np.ndarray, buckets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets for the second digest halves."""
        mask = np.asarray(buckets, dtype=np.uint64) - np.uint64(1)
        print_ = low & np.uint64(0xFFFFFFFF)
        print_ = np.where(print_ == 0, np.uint64(1), print_)
        first = (low >> np.uint64(32)) & mask
        return print_.astype("<u4"), first, first ^ (print_ * np.uint64(0x5BD1E995) & mask)

    def add(self, low: int) -> bool:
        """False when no place was found; the filter must then be built larger."""
        prints, first, second = self.places(np.array([low], dtype=np.uint64), self.buckets)
        print_, bucket = prints[0], int(first[0])
        for choice in (bucket, int(second[0])):
            free = np.flatnonzero(self.table[choice] == 0)
            if free.size:
                self.table[choice, free[0]] = print_
                return True
        for kick in range(KICKS):
            slot = kick % SLOTS
            print_, self.table[bucket, slot] = self.table[bucket, slot], print_
            bucket ^= int(print_) * 0x5BD1E995 & (self.buckets - 1)
            free = np.flatnonzero(self.table[bucket] == 0)
            if free.size:
                self.table[bucket, free[0]] = print_
                return True
        return False

    def remove(self, low: int) -> None:
        prints, first, second = self.places(np.array([low], dtype=np.uint64), self.buckets)
        for choice in (int(first[0]), int(second[0])):
            held = np.flatnonzero(self.table[choice] == prints[0])
            if held.size:
                self.table[choice, held[0]] = 0
                return


class Probe:
    """All shards' filters side by side, with the keys they wrongly pass."""

    def __init__(self, rows: list[tuple[int, int, bytes]], shards: int, wrong: np.ndarray):
        """``wrong``: the ``high, low`` digest halves of those keys, a row a key."""
        self.shards = shards
        self.wrong = wrong[np.argsort(wrong[:, 0], kind="stable")]
        self.buckets = np.ones(shards, dtype=np.uint64)
        self.start = np.zeros(shards, dtype=np.int64)
        tables, at = [np.zeros((1, SLOTS), dtype="<u4")], 1  # shards without a filter: one empty bucket
        for shard, buckets, table in rows:
            self.buckets[shard], self.start[shard] = buckets, at
            tables.append(np.frombuffer(table, dtype="<u4").reshape(buckets, SLOTS))
            at += buckets
        self.table = np.concatenate(tables)

    def may_hold(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        shard = high.view(np.int64) % self.shards
        prints, first, second = Cuckoo.places(low, self.buckets[shard])
        start = self.start[shard]
        found = np.zeros(len(low), dtype=bool)
        for bucket in (first, second):
            found |= (self.table[start + bucket.astype(np.int64)] == prints[:, None]).any(axis=1)
        return found

    def holds(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Exact for every key that is in the counts."""
        found = self.may_hold(high, low)
        if len(self.wrong):
            at = np.flatnonzero(found)
            begin = np.searchsorted(self.wrong[:, 0], high[at], "left")
            end = np.searchsorted(self.wrong[:, 0], high[at], "right")
            for k in np.flatnonzero(end > begin):
                if (self.wrong[begin[k] : end[k], 1] == low[at[k]]).any():
                    found[at[k]] = False
        return found


def counted(docs: DataFrame) -> DataFrame:
    """``high, low, n``: documents per key."""
    keys = F.filter(
        F.array_distinct(F.transform(lines_of(F.col("text")), line_key)),
        lambda key: F.char_length(key) > 0,
    )
    keys = docs.select(F.explode(keys).alias("key"))
    halves = keys.select(high_half(F.col("key")).alias("high"), low_half(F.col("key")).alias("low"))
    return halves.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n"))


class LineIndex:
    """Reference counts and filters of the lines of all documents inserted so far."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str | None = None,
        min_docs: int = 10,
        shards: int = 64,
        max_filter_bytes: int = 64 << 20,
    ):
        self.spark, self.folder = spark, folder or scratch(spark)
        self.min_docs, self.shards, self.max_filter_bytes = min_docs, shards, max_filter_bytes
        self.refs = spark.createDataFrame([], "high long, low long, n long")
        self.filters = self._no_filters()

    def _no_filters(self) -> DataFrame:
        return self.spark.createDataFrame([], "shard int, buckets int, keys long, table binary")

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Every row is a document; a null text is one empty line."""
        self._apply(texts(docs, id_col, text_col), 1)

    def delete(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Take back documents that were inserted with the same texts."""
        self._apply(texts(docs, id_col, text_col), -1)

    def _apply(self, docs: DataFrame, sign: int) -> None:
        min_docs = self.min_docs
        delta = counted(docs).select(
            "high", "low", (F.col("n") * sign).alias("n"), F.lit(0).cast("long").alias("old")
        )
        both = self.refs.select("high", "low", "n", F.col("n").alias("old")).unionByName(delta)
        state = stored(
            both.groupBy("high", "low").agg(F.sum("n").alias("n"), F.sum("old").alias("old")),
            self.folder,
        )
        dropped = state.where((F.col("n") >= min_docs) | (F.col("old") >= min_docs))
        frequent = dropped.where(F.col("n") >= min_docs).count()
        while frequent > self.shards * SHARD_KEYS:
            self.shards, self.filters = 2 * self.shards, self._no_filters()

        def refilter(keys: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
            """One shard: its keys over the threshold now or before, and its filter."""
            shard = int(keys["shard"].iloc[0] if len(keys) else old["shard"].iloc[0])
            low = keys["low"].to_numpy(dtype=np.int64).view(np.uint64)
            now, was = (keys["n"] >= min_docs).to_numpy(), (keys["old"] >= min_docs).to_numpy()
            held = Cuckoo.sized(0)
            fits = len(old) > 0
            if fits:
                buckets = int(old["buckets"].iloc[0])
                table = np.frombuffer(old["table"].iloc[0], dtype="<u4").reshape(-1, SLOTS)
                held = Cuckoo(buckets, table.copy())
                for k in low[was & ~now]:
                    held.remove(int(k))
                fits = now.sum() <= buckets * SLOTS * 0.84 and all(
                    held.add(int(k)) for k in low[now & ~was]
                )
            room = int(now.sum())
            while not fits:
                held = Cuckoo.sized(room)
                fits = all(held.add(int(k)) for k in low[now])
                room = 2 * room + 1
            return pd.DataFrame(
                {
                    "shard": [shard],
                    "buckets": [held.buckets],
                    "keys": [int(now.sum())],
                    "table": [held.table.tobytes()],
                }
            )

        shard = F.pmod("high", F.lit(self.shards)).cast("int")
        self.filters = stored(
            dropped.select(shard.alias("shard"), "low", "n", "old")
            .groupBy("shard")
            .cogroup(self.filters.groupBy("shard"))
            .applyInPandas(refilter, self.filters.schema),
            self.folder,
        )
        self.refs = state.where("n > 0").select("high", "low", "n")

    def _probe(self) -> Probe | None:
        """The filters with their exceptions, or None when they are too large to send out."""
        size = self.filters.agg(F.coalesce(F.sum(F.octet_length("table")), F.lit(0))).first()[0]
        if size > self.max_filter_bytes:
            return None
        rows = [(r.shard, r.buckets, bytes(r.table)) for r in self.filters.collect()]
        bare = Probe(rows, self.shards, np.zeros((0, 2), dtype=np.uint64))
        sent = self.spark.sparkContext.broadcast(bare)

        def wrong(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held = sent.value.may_hold(unsigned(batch["high"]), unsigned(batch["low"]))
                yield batch.filter(pa.array(held))

        few = self.refs.where(F.col("n") < self.min_docs).select("high", "low")
        limit = self.max_filter_bytes // 16
        found = few.mapInArrow(wrong, "high long, low long").limit(limit + 1).toArrow()
        sent.destroy()
        if len(found) > limit:
            return None
        halves = [found[name].combine_chunks() for name in ("high", "low")]
        return Probe(rows, self.shards, np.stack([unsigned(half) for half in halves], axis=1))

    def drop(
        self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
    ) -> DataFrame:
        """``doc_id, n_lines, n_dropped, kept`` for every row; ``docs`` must be inserted already.

        Lines whose key ``min_docs`` documents or more hold go, in every
        document; lines of blanks only never go. The others stay as they are,
        joined by line feeds. A null or empty text is one empty line.
        """
        rows = texts(docs, id_col, text_col).withColumn("lines", lines_of(F.col("text")))
        probe = self._probe()
        if probe is None:
            return self._drop_by_join(rows)
        sent = self.spark.sparkContext.broadcast(probe)

        @F.arrow_udf("array<boolean>")
        def held(high: pa.Array, low: pa.Array) -> pa.Array:
            """Which of each document's lines are in a filter."""
            found = sent.value.holds(unsigned(high.flatten()), unsigned(low.flatten()))
            sizes = high.value_lengths().to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(found))

        keys = F.transform("lines", line_key)
        high, low = F.transform(keys, high_half), F.transform(keys, low_half)
        return without(rows.withColumn("gone", held(high, low)))

    def _drop_by_join(self, rows: DataFrame) -> DataFrame:
        """The same without filters: each document's distinct keys joined with the exact counts."""
        numbered = stored(rows.withColumn("row", F.monotonically_increasing_id()), self.folder)
        digest = F.struct(high_half(F.col("key")).alias("high"), low_half(F.col("key")).alias("low"))
        keys = numbered.select(
            "row", F.explode(F.array_distinct(F.transform("lines", line_key))).alias("key")
        )
        frequent = self.refs.where(F.col("n") >= self.min_docs).select("high", "low")
        keys = keys.where(F.char_length("key") > 0).select("row", "key", digest.alias("digest"))
        found = keys.select("row", "key", "digest.*").join(frequent, ["high", "low"])
        found = found.groupBy("row").agg(F.collect_list("key").alias("keys"))
        joined = numbered.join(found, "row", "left")
        gone = F.transform(
            "lines", lambda line: F.coalesce(F.array_contains("keys", line_key(line)), F.lit(False))
        )
        return without(joined.withColumn("gone", gone))


def without(rows: DataFrame) -> DataFrame:
    """The result of ``drop`` from ``doc_id, lines, gone``; blank lines stay whatever ``gone`` says."""
    stays = F.filter(
        F.arrays_zip("lines", "gone"),
        lambda x: ~x["gone"] | (F.char_length(F.btrim(x["lines"], F.lit(BLANKS))) == 0),
    )
    kept = rows.select("doc_id", "lines", F.transform(stays, lambda x: x["lines"]).alias("stays"))
    return kept.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("stays")).cast("long").alias("n_dropped"),
        F.array_join("stays", "\n").alias("kept"),
    )


def drop_repeated_lines(
    docs: DataFrame, min_docs: int = 10, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Insert ``docs`` into a fresh index and drop their repeated lines."""
    index = LineIndex(docs.sparkSession, min_docs=min_docs)
    index.insert(docs, id_col, text_col)
    return index.drop(docs, id_col, text_col)
