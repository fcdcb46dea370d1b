"""Mixing sources to target weights by a low-discrepancy schedule (operator 9).

The mix is a row of equal slots of ``block`` words. Slot ``i`` takes the point
``frac((i + 1) * golden ratio)`` of the unit interval, on which every source
owns a stretch as long as its share; so after any number of slots each source
is within a few blocks of its share. The slots of a source are ranked, and slot
``r`` of the source is joined with block ``r`` of the source's shuffled words,
which repeat from the start when they run out. A source's last block ends at its
target; the few slots that a source lacks or has too many at the end are added
or left out.

Only DataFrame functions run here. Running sums go over hash buckets and then
inside each, about the square root of the row count both times, so that a
source with a third of all rows is never one window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.common import WORD, stored

#: Weights of the sources in code point order, repeating (fixed values).
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BLOCK = 128
#: Cells of the unit interval through which points find their source.
GRID = 4096
#: Slots that are ranked together, at least.
CHUNK = 1024
GOLDEN = 0.6180339887498949
SPLIT = 20


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, epochs: int = MAX_EPOCHS
) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    All sizes are shared by weight; no source gets more than ``epochs`` times
    its size, and the excess goes to the others by weight. Sorted by the level
    at which they fill up, the full sources are a prefix: those whose limit per
    weight is below what the rest would get per weight. The windows here are
    over one row per source.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(in_order) - 1) % len(weights)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), place)
    everything = Window.partitionBy()
    limits = by_source.select(
        "source",
        "source_size",
        weight.alias("weight"),
        (F.col("source_size") * epochs).cast("double").alias("limit"),
        F.sum("source_size").over(everything).cast("double").alias("total"),
    )
    fill = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    heavy = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(before), F.lit(0.0)
    )
    level = limits.withColumn("level", left / heavy)
    full = F.col("limit") <= F.col("level") * F.col("weight")
    # The level of the first source that does not fill up holds for all after it.
    first = F.when(~F.col("full"), F.struct(F.col("limit") / F.col("weight"), "level"))
    ruled = level.withColumn("full", full).withColumn("rest", F.min(first).over(everything))
    target = F.when(F.col("full"), F.col("limit")).otherwise(
        F.col("rest.level") * F.col("weight")
    )
    return ruled.select("source", "source_size", target.alias("target"))


def schedule(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """``slot, source, rank``: which source each slot takes, and its how many-th slot that is.

    Sources are told apart by ``source_id``, a number of this table. Slots are
    ranked in chunks, and chunks of a source by a running count; a chunk has the
    square root of all slots, so that neither becomes long.
    """
    spark = targets.sparkSession
    everything = Window.partitionBy()
    upto = Window.orderBy("source_id").rowsBetween(Window.unboundedPreceding, 0)
    shares = targets.where("target > 0").select(
        "source_id",
        F.sum("target").over(upto).alias("sum"),
        F.sum("target").over(everything).alias("all"),
        "target",
    )
    total = targets.agg(F.sum("target")).first()[0] or 0.0
    stretches = shares.select(
        "source_id",
        ((F.col("sum") - F.col("target")) / F.col("all")).alias("from"),
        # The last one ends at 1, whatever rounding says.
        F.when(F.max("source_id").over(everything) == F.col("source_id"), F.lit(1.0))
        .otherwise(F.col("sum") / F.col("all"))
        .alias("to"),
    )
    # Neighbours share a bound only when computed alike.
    following = F.lead("from").over(Window.orderBy("source_id"))
    stretches = stretches.withColumn("to", F.coalesce(following, "to"))
    cells = stretches.withColumn(
        "cell",
        F.explode(
            F.sequence(
                F.floor(F.col("from") * GRID),
                F.least(F.floor(F.col("to") * GRID), F.lit(GRID - 1).cast("long")),
            )
        ),
    )
    number = F.col("slot") + 1
    high, low = F.shiftright(number, SPLIT), number.bitwiseAND((1 << SPLIT) - 1)
    step = math.fmod(GOLDEN * (1 << SPLIT), 1.0)
    point = F.pmod(high * F.lit(step) + low * F.lit(GOLDEN), F.lit(1.0))
    number_of_slots = round(total / block)
    chunk = max(CHUNK, math.isqrt(number_of_slots))
    slots = spark.range(number_of_slots).select(
        F.col("id").alias("slot"), F.expr(f"id div {chunk}").alias("chunk")
    )
    slots = slots.withColumn("point", point).withColumn(
        "cell", F.least(F.floor(F.col("point") * GRID), F.lit(GRID - 1).cast("long"))
    )
    dealt = (
        slots.join(cells, "cell")
        .where((F.col("point") >= F.col("from")) & (F.col("point") < F.col("to")))
        .select("slot", "chunk", "source_id")
    )
    counts = dealt.groupBy("source_id", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = (
        Window.partitionBy("source_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = Window.partitionBy("chunk", "source_id").orderBy("slot")
    ranked = dealt.withColumn("inside", F.row_number().over(inside) - 1)
    return ranked.join(counts.drop("n"), ["source_id", "chunk"]).select(
        "slot", "source_id", (F.col("offset") + F.col("inside")).alias("rank")
    )


def settled(slots: DataFrame, quota: DataFrame, block: int) -> DataFrame:
    """``slots`` with exactly the ranks that fill each source's ``quota``.

    What the schedule lacks at its end, a few slots a source, follows after it.
    """
    needed = quota.select("source_id", F.expr(f"(quota + {block} - 1) div {block}").alias("needed"))
    slots = stored(slots)
    had = slots.groupBy("source_id").agg(F.count(F.lit(1)).alias("had"))
    last = slots.agg(F.coalesce(F.max("slot"), F.lit(-1))).first()[0]
    lacking = (
        needed.join(had, "source_id", "left")
        .withColumn("had", F.coalesce("had", F.lit(0)))
        .where("had < needed")
        .select("source_id", F.explode(F.expr("sequence(had, needed - 1)")).alias("rank"))
    )
    number = F.row_number().over(Window.orderBy("rank", "source_id")).cast("long")
    tail = lacking.select((number + last).alias("slot"), "source_id", "rank")
    kept = slots.join(needed, "source_id").where("rank < needed")
    return kept.select("slot", "source_id", "rank").unionByName(tail)


def shuffled_starts(sized: DataFrame, seed: int) -> DataFrame:
    """``sized`` with ``start``: the words of the same source before the row, in hash order."""
    rows = sized.agg(F.count(F.lit(1))).first()[0]
    buckets = max(1, math.isqrt(rows))
    order = F.xxhash64(F.lit(seed), "doc_id", "size", "copy")
    keyed = sized.withColumn("order", order).withColumn(
        "bucket", F.floor((F.col("order") / 2.0**64 + 0.5) * buckets)
    )
    sums = keyed.groupBy("source_id", "bucket").agg(F.sum("size").alias("words"))
    before = Window.unboundedPreceding, -1
    over = Window.partitionBy("source_id").orderBy("bucket").rowsBetween(*before)
    sums = sums.select(
        "source_id", "bucket", F.coalesce(F.sum("words").over(over), F.lit(0)).alias("offset")
    )
    inside = (
        Window.partitionBy("source_id", "bucket")
        .orderBy("order", "doc_id", "copy")
        .rowsBetween(*before)
    )
    keyed = keyed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return keyed.join(sums, ["source_id", "bucket"]).select(
        *sized.columns, (F.col("offset") + F.col("inside")).alias("start")
    )


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    epochs: int = MAX_EPOCHS,
    block: int = BLOCK,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """``(documents, manifest)`` of the mix.

    ``documents`` has ``doc_id, copy, size, source_size, target, taken`` for
    every row, ``manifest`` one row ``slot, source_id, rank, doc_id, copy,
    epoch, words`` for each piece of a document in a slot.

    A null text has no words, a null source is a source of its own, the last
    one. Documents without words are in no slot. ``copy`` tells apart rows that
    are repeated with one ``doc_id`` and size; they are separate documents. An
    empty table, or one without words, gives an empty manifest.
    """
    sized = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        word_count(F.col(f"`{text_col}`")).alias("size"),
        F.monotonically_increasing_id().alias("copy"),
    )
    sized = stored(sized)  # the texts are read once
    # Ids repeat seldom; a copy number over all rows would make reruns differ with the files.
    twin = Window.partitionBy("doc_id", "source", "size").orderBy("copy")
    repeated = (
        sized.groupBy("doc_id", "source", "size").count().where("count > 1").limit(1).count() > 0
    )
    copy = F.row_number().over(twin) - 1 if repeated else F.lit(0)
    sized = sized.withColumn("copy", copy.cast("long"))

    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    targets = stored(
        source_targets(sized, weights, epochs).withColumn("source_id", F.row_number().over(by_source))
    )
    same = sized["source"].eqNullSafe(targets["source"])
    sized = stored(sized.join(targets, same).drop("source"))

    quota = targets.select("source_id", F.round("target").cast("long").alias("quota"))
    slots = stored(settled(schedule(targets, block), quota, block))
    starts = shuffled_starts(
        sized.where("size > 0").select("doc_id", "copy", "size", "source_id", "source_size"), seed
    )
    starts = starts.join(quota, "source_id")
    epoch = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))
    passes = (
        starts.withColumn("epoch", epoch)
        .withColumn("begin", F.col("epoch") * F.col("source_size") + F.col("start"))
        .where("begin < quota")
        .withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("quota")))
    )
    pieces = passes.withColumn(
        "rank", F.explode(F.sequence(F.expr(f"begin div {block}"), F.expr(f"(end - 1) div {block}")))
    )
    words = F.least(F.col("end"), (F.col("rank") + 1) * block) - F.greatest(
        F.col("begin"), F.col("rank") * block
    )
    manifest = stored(
        pieces.withColumn("words", words)
        .join(slots, ["source_id", "rank"])
        .select("slot", "source_id", "rank", "doc_id", "copy", "size", "epoch", "words")
    )
    taken = manifest.groupBy("source_id", "doc_id", "size", "copy").agg(
        F.sum("words").alias("taken")
    )
    t = taken.select(*[F.col(c).alias(f"t_{c}") for c in taken.columns])
    of = (
        (sized["source_id"] == t["t_source_id"])
        & sized["doc_id"].eqNullSafe(t["t_doc_id"])
        & (sized["size"] == t["t_size"])
        & (sized["copy"] == t["t_copy"])
    )
    documents = sized.join(t, of, "left").select(
        "doc_id",
        "copy",
        "size",
        "source_size",
        "target",
        F.coalesce("t_taken", F.lit(0)).cast("long").alias("taken"),
    )
    return documents, manifest.drop("size")
