"""Substring deduplication with a logarithmic family of suffix indexes (operator 2).

Batches of documents arrive in document order. Of each batch the suffixes that
start at content-defined anchors are sorted; the sorted run is scanned together
with the sorted runs, the *levels*, that hold all earlier batches. A run joins
a level of its own size in the same scan and becomes one of twice the size, and
so on, so that ``b`` batches leave about ``log2 b`` levels and a suffix is
rewritten as often.

Suffixes are sorted by 64-bit fingerprints, first of the anchor's ``K`` bytes
and then of the bytes around it: ``length`` bytes for every window the anchor
stands for. Equal strings are neighbours in this order as they are in the
alphabetic one, at an eighth of its bytes. Two suffixes that agree in both
stand for the same windows, so the later one is a repetition as a whole. Where
only the anchor agrees, a match begins or ends in between; the bytes of those
contexts are fetched and compared window by window: the contexts of an anchor
in slices of ``SLICE_CONTEXTS``, and of anchors with more than one slice then
the distinct windows of the slices, each by its first place there.

Within one slice of a task's documents a repetition is known at once. It is not sorted with its
first occurrence, so a passage in a third of all documents is a few rows a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.llm.anchors import CHUNK, PLACE_BITS, K, Prints, anchor_runs, mixed
from tierlake.llm.common import broadcast_if_light, broadcast_if_small, stored, texts
from tierlake.session import scratch

LENGTH = 100
BATCHES = 3
#: Contexts of one anchor that are compared at once.
SLICE_CONTEXTS = 2048
#: Contexts a task compares at a time, over many anchors.
BUCKET = 5_000
#: Bytes of contexts' places, or of documents' spans, sent to every task instead of shuffling texts.
BROADCAST_BYTES = 64 << 20
#: Anchors with more than one slice that are sent to every task.
BROADCAST_ANCHORS = 100_000
#: Bytes of texts whose suffixes a task holds at a time, or one longer text.
SLICE = 8 << 20
SEGMENT = 1 << (PLACE_BITS - 2)


def segments(
    raw: list[bytes], length: int
) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of ``(document, offset, bytes)`` of about ``CHUNK`` bytes.

    Long documents are cut so that each window start lies in one segment.
    """
    chunk, size = [], 0
    for k, data in enumerate(raw):
        for begin in range(0, max(0, len(data) - length + 1), SEGMENT):
            part = data[begin : begin + SEGMENT + length - 1]
            chunk.append((k, begin, part))
            size += len(part)
            if size >= CHUNK:
                yield chunk
                chunk, size = [], 0
    if chunk:
        yield chunk


def suffixes(frame: pd.DataFrame, length: int) -> pd.DataFrame:
    """The anchored suffixes of a batch: ``fp, context, again`` and where they are."""
    found = []
    raw = [(text or "").encode() for text in frame["text"]]
    for chunk in segments(raw, length):
        data = np.frombuffer(b"".join(p for _, _, p in chunk), dtype=np.uint8)
        sizes = np.array([len(p) for _, _, p in chunk])
        ends = np.cumsum(sizes)
        within = np.repeat(np.arange(len(chunk)), sizes)
        starts = np.arange(len(data) - length + 1)
        valid = starts + length <= ends[within[: len(starts)]]
        anchor, first, count, prints = anchor_runs(data, valid, length)
        of = within[first]
        context = Prints(data, 2)(first, first + count + length - 1)
        doc = np.array([k for k, _, _ in chunk])[of]
        base = np.array([b for _, b, _ in chunk])[of] - (ends - sizes)[of]
        fp = prints(anchor, anchor + K)
        found.append((fp, context, doc, first + base, count))
    if not found:
        return pd.DataFrame({c: [] for c in ("fp", "context", "row", "start", "windows", "again")})
    fp, context, doc, start, count = (np.concatenate(c) for c in zip(*found, strict=True))
    return pd.DataFrame(
        {
            "fp": fp.view(np.int64),
            "context": context.view(np.int64),
            "row": doc,
            "start": start,
            "windows": count.astype(np.int32),
        }
    )


class SuffixFamily:
    """Levels of sorted suffixes, and the repetitions found when batches were added."""

    def __init__(self, spark: SparkSession, folder: str | None = None, length: int = LENGTH):
        self.spark, self.folder, self.length = spark, folder or scratch(spark), length
        #: ``(rank, suffixes)``; a level of rank r holds the suffixes of 2 ** r batches.
        self.levels: list[tuple[int, DataFrame]] = []
        self.repeats: list[DataFrame] = []
        self.partial: list[DataFrame] = []

    def add(self, batch: DataFrame) -> None:
        """Index ``doc_id, copy, text`` rows that come after all that were added before."""
        length = self.length
        kind = batch.schema["doc_id"].dataType.simpleString()

        def entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in sliced(frames):
                frame = frame.sort_values(["doc_id", "copy"], na_position="first", ignore_index=True)
                found = suffixes(frame, length)
                row = found.pop("row").to_numpy(dtype=np.int64)
                found["doc_id"] = frame["doc_id"].to_numpy()[row]
                found["copy"] = frame["copy"].to_numpy()[row]
                again = found.duplicated(["fp", "context"]).to_numpy()
                # A known repetition is spread out; only its place matters now.
                alone = mixed(np.arange(len(found), dtype=np.uint64) + hash_of(frame))
                fp = np.where(again, alone.view(np.int64), found["fp"].to_numpy())
                yield found.assign(fp=fp, again=again)[
                    ["fp", "context", "doc_id", "copy", "start", "windows", "again"]
                ]

        new = batch.mapInPandas(
            entries,
            f"fp long, context long, doc_id {kind}, copy long, start int, windows int, again boolean",
        )
        # The levels that the new run will join, newest first; the others stay as they are.
        scanned, rank = tagged(new, old=False, stays=False), 0
        while self.levels and self.levels[-1][0] == rank:
            level = self.levels.pop()[1].withColumn("again", F.lit(False))
            scanned = scanned.unionByName(tagged(level, old=True, stays=False))
            rank += 1
        for _, level in self.levels:
            level = level.withColumn("again", F.lit(False))
            scanned = scanned.unionByName(tagged(level, old=True, stays=True))
        here = Window.partitionBy("fp")
        sorted_run = here.orderBy("context", "doc_id", "copy", "start")
        repeated = F.col("again") | F.coalesce(
            F.lag("context").over(sorted_run) == F.col("context"), F.lit(False)
        )
        cut = (F.min("context").over(here) != F.max("context").over(here)) & (
            ~F.min("old").over(here)
        )
        ranked = scanned.withColumns({"repeated": repeated, "cut": cut})
        # Suffixes of levels that stay are written only where they matter now.
        wanted = ~F.col("stays") | (F.col("cut") & ~F.col("repeated"))
        run = stored(ranked.where(wanted).drop("again"), self.folder)
        place = "doc_id", "copy", "start", "windows"
        self.repeats.append(run.where("repeated and not old").select(*place))
        self.partial.append(run.where("cut and not repeated").select(*place, "fp"))
        kept = run.where("not repeated and not stays").select("fp", "context", *place)
        self.levels.append((rank, kept))

    def spans(self, docs: DataFrame) -> DataFrame:
        """``doc_id, copy, begin, end`` of repeated bytes of all batches; spans may overlap.

        ``docs`` are the rows that were added.
        """
        whole = [
            r.select(
                "doc_id",
                "copy",
                F.col("start").alias("begin"),
                (F.col("start") + F.col("windows") + self.length - 1).alias("end"),
            )
            for r in self.repeats
        ]
        found = whole[0]
        for more in whole[1:]:
            found = found.unionByName(more)
        for more in self._compared(docs):
            found = found.unionByName(more)
        return found

    def _compared(self, docs: DataFrame) -> list[DataFrame]:
        """Spans inside contexts that share their anchor but not all bytes."""
        length = self.length
        kind = docs.schema["doc_id"].dataType.simpleString()
        cut = self.partial[0]
        for more in self.partial[1:]:
            cut = cut.unionByName(more)
        cut = stored(cut.distinct(), self.folder)
        total = cut.count()
        if not total:
            return []
        slices = F.ceil(F.count(F.lit(1)) / SLICE_CONTEXTS).cast("int").alias("slices")
        many = stored(cut.groupBy("fp").agg(slices).where("slices > 1"), self.folder)
        place = F.xxhash64("doc_id", "copy", "start")
        part = F.coalesce(F.pmod(place, "slices"), F.lit(0)).cast("int")
        dealt = cut.join(broadcast_if_small(many, BROADCAST_ANCHORS), "fp", "left").select(
            "doc_id", "copy", "start", "windows", "fp",
            F.col("slices").isNotNull().alias("many"), part.alias("part"),
        )
        held = ("start", "windows", "fp", "many", "part")
        of_doc = dealt.groupBy(F.col("doc_id").alias("in_id"), F.col("copy").alias("in_copy"))
        of_doc = stored(of_doc.agg(*[F.collect_list(c).alias(c) for c in held]), self.folder)
        of_doc = broadcast_if_light(of_doc, F.size("start") * 21 + 32, BROADCAST_BYTES)
        same = F.col("doc_id").eqNullSafe(F.col("in_id")) & (F.col("copy") == F.col("in_copy"))
        texts_of = docs.join(of_doc, same).drop("in_id", "in_copy")

        def contexts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            columns = ["many", "part", "fp", "doc_id", "copy", "start", "windows", "bytes"]
            for frame in frames:
                out = []
                for row in frame.itertuples(index=False):
                    raw = (row.text or "").encode()
                    for start, windows, fp, many, part in zip(
                        row.start, row.windows, row.fp, row.many, row.part, strict=True
                    ):
                        found = raw[start : start + windows + length - 1]
                        out.append(
                            (bool(many), part, fp, row.doc_id, row.copy, start, windows, found)
                        )
                yield pd.DataFrame(out, columns=columns)

        schema = f"doc_id {kind}, copy long, begin int, end int, h1 long, h2 long"

        def compare(frame: pd.DataFrame) -> pd.DataFrame:
            """Many slices' contexts: spans of windows that an earlier context has.

            Of anchors with other slices also each distinct window, with its
            first place and its fingerprints ``h1, h2``.
            """
            frame = frame.sort_values(
                ["doc_id", "copy", "start"], na_position="first", ignore_index=True
            )
            which, at, prints = windows_of(frame, length, 3)
            fp = frame["fp"].to_numpy()[which].view(np.uint64)
            key = mixed(prints ^ mixed(fp))
            # The same anchor's other slices are not to be seen here.
            slice_ = frame["part"].to_numpy(dtype=np.int64)[which].view(np.uint64)
            seen = pd.Series(mixed(key + slice_)).duplicated().to_numpy()
            spans = runs_of(frame, which[seen], at[seen], length)
            first = np.flatnonzero(frame["many"].to_numpy(dtype=bool)[which] & ~seen)
            if not len(first):
                return spans.assign(h1=pd.NA, h2=pd.NA).astype({"h1": "Int64", "h2": "Int64"})
            two = windows_of(frame, length, 4)[2]
            row = which[first]
            windows = pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].to_numpy()[row],
                    "copy": frame["copy"].to_numpy()[row],
                    "begin": at[first].astype(np.int32),
                    "end": (at[first] + length).astype(np.int32),
                    "h1": key[first].view(np.int64),
                    "h2": two[first].view(np.int64),
                }
            )
            spans = spans.assign(h1=pd.NA, h2=pd.NA)
            both = pd.concat([spans, windows], ignore_index=True) if len(spans) else windows
            return both.astype({"h1": "Int64", "h2": "Int64"})

        buckets = -(-total // BUCKET)
        compared = (
            texts_of.mapInPandas(
                contexts,
                f"many boolean, part int, fp long, doc_id {kind}, copy long, start int, windows int, "
                "bytes binary",
            )
            .withColumn("bucket", F.pmod(F.xxhash64("fp", "part"), F.lit(buckets)))
            .groupBy("bucket")
            .applyInPandas(compare, schema)
        )
        compared = stored(compared, self.folder)
        spans = compared.where("h1 IS NULL").select("doc_id", "copy", "begin", "end")
        if many.isEmpty():
            return [spans]
        windows = compared.where("h1 IS NOT NULL")
        place = F.struct("doc_id", "copy", "begin")
        firsts = windows.groupBy("h1", "h2").agg(
            F.min(place).alias("first"), F.count(F.lit(1)).alias("n")
        )
        firsts = firsts.where("n > 1").drop("n")
        later = windows.join(firsts, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
        return [spans, later.select("doc_id", "copy", "begin", "end")]


def sliced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same rows in frames of about ``SLICE`` characters."""
    for frame in frames:
        size = frame["text"].str.len().fillna(0).cumsum()
        for _, part in frame.groupby((size // SLICE).to_numpy(), sort=False):
            yield part


def tagged(suffixes: DataFrame, **flags: bool) -> DataFrame:
    return suffixes.withColumns({name: F.lit(value) for name, value in flags.items()})


def hash_of(frame: pd.DataFrame) -> np.uint64:
    """A number that differs between batches: of the first row's place."""
    head = f"{frame['doc_id'].iloc[0]}/{frame['copy'].iloc[0]}" if len(frame) else ""
    return np.uint64(int.from_bytes(hashlib.blake2b(head.encode(), digest_size=8).digest(), "little"))


def windows_of(
    frame: pd.DataFrame, length: int, seed: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every window of the contexts: its row, its start in the document, its fingerprint.

    Windows are in the order of the rows and inside each from left to right.
    """
    count = frame["windows"].to_numpy(dtype=np.int64)
    if not len(frame):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none.view(np.uint64)
    data = np.frombuffer(b"".join(frame["bytes"]), dtype=np.uint8)
    which = np.repeat(np.arange(len(frame)), count)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    sizes = count + length - 1
    begin = (np.cumsum(sizes) - sizes)[which] + inside
    return which, frame["start"].to_numpy(dtype=np.int64)[which] + inside, Prints(data, seed)(
        begin, begin + length
    )


def runs_of(
    frame: pd.DataFrame, which: np.ndarray, at: np.ndarray, length: int
) -> pd.DataFrame:
    """Spans from marked windows, consecutive ones of a row joined."""
    if not len(which):
        return pd.DataFrame({"doc_id": [], "copy": [], "begin": [], "end": []}).astype(
            {"copy": "int64", "begin": "int32", "end": "int32"}
        )
    new = np.concatenate(([True], (which[1:] != which[:-1]) | (at[1:] != at[:-1] + 1)))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    row = which[first]
    return pd.DataFrame(
        {
            "doc_id": frame["doc_id"].to_numpy()[row],
            "copy": frame["copy"].to_numpy()[row],
            "begin": at[first].astype(np.int32),
            "end": (at[last] + length).astype(np.int32),
        }
    )


def united(begins: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Maximal runs that spans cover; touching spans are one run."""
    runs: list[tuple[int, int]] = []
    for begin, end in sorted(zip(begins, ends, strict=True)):
        if runs and begin <= runs[-1][1]:
            runs[-1] = runs[-1][0], max(end, runs[-1][1])
        else:
            runs.append((begin, end))
    return runs


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, copy, text``; ``copy`` tells rows of one ``doc_id`` apart, else it is 0."""
    rows = texts(docs, id_col, text_col)
    repeated = rows.groupBy("doc_id").count().where("count > 1").limit(1).count() > 0
    if not repeated:
        return rows.withColumn("copy", F.lit(0).cast("long"))
    return stored(rows.withColumn("copy", F.monotonically_increasing_id()))


def in_batches(rows: DataFrame, batches: int) -> list[DataFrame]:
    """Consecutive runs of documents of about equal number, for ids of any type with an order."""
    if batches < 2:
        return [rows]
    # The ids alone, dealt out by range: a few rows say where the ranges end.
    ids = rows.select("doc_id").where("doc_id is not null")
    ranges = ids.repartitionByRange(8 * batches, "doc_id").groupBy(F.spark_partition_id()).agg(
        F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n")
    )
    ranges = sorted((row.last, row.n) for row in ranges.collect())
    cuts, seen, total = [], 0, sum(n for _, n in ranges)
    for last, n in ranges[:-1]:
        seen += n
        if seen * batches >= total * (len(cuts) + 1) and len(cuts) + 1 < batches:
            cuts.append(last)
    low, parts = None, []
    for cut in [*cuts, None]:
        part = F.lit(True)
        if low is not None:
            part &= F.col("doc_id") > F.lit(low)
        if cut is not None:
            part &= F.col("doc_id") <= F.lit(cut)
        if low is None:
            part |= F.col("doc_id").isNull()
        parts.append(rows.where(part))
        low = cut
    return parts


def drop_substrings(
    docs: DataFrame,
    length: int = LENGTH,
    batches: int = BATCHES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (bytes) of every row.

    Each byte of a string of ``length`` bytes that also starts earlier, in a
    document of smaller ``doc_id`` or further left, is removed; strings are
    those of the input. A null text is empty, shorter texts stay as they are, a
    null ``doc_id`` comes before all others, and rows that repeat a ``doc_id``
    are compared in the order they are read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    family = SuffixFamily(spark, length=length)
    for batch in in_batches(rows, batches):
        family.add(batch)
    spans = family.spans(rows)
    kind = rows.schema["doc_id"].dataType.simpleString()
    of_doc = spans.groupBy(F.col("doc_id").alias("in_id"), F.col("copy").alias("in_copy")).agg(
        F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends")
    )

    def unite(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            runs = [united(b, e) for b, e in zip(frame["begins"], frame["ends"], strict=True)]
            yield frame[["in_id", "in_copy"]].assign(
                begins=[[b for b, _ in r] for r in runs], ends=[[e for _, e in r] for r in runs]
            )

    of_doc = stored(
        of_doc.mapInPandas(
            unite, f"in_id {kind}, in_copy long, begins array<int>, ends array<int>"
        ),
        family.folder,
    )
    of_doc = broadcast_if_light(of_doc, F.size("begins") * 8 + 32, BROADCAST_BYTES)

    def remove(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                raw, parts, at, gone = (row.text or "").encode(), [], 0, 0
                begins, ends = (
                    ((), ()) if row.begins is None else (row.begins, row.ends)
                )
                for begin, end in zip(begins, ends, strict=True):
                    parts.append(raw[at:begin])
                    at, gone = end, gone + int(end - begin)
                kept = b"".join([*parts, raw[at:]])
                out.append((row.doc_id, len(raw), gone, len(begins), kept))
            columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
            yield pd.DataFrame(out, columns=columns)

    same = F.col("doc_id").eqNullSafe(F.col("in_id")) & (F.col("copy") == F.col("in_copy"))
    return rows.join(of_doc, same, "left").mapInPandas(
        remove, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    )
