"""Shards cut from a Hilbert curve through the metadata (operator 8).

Each dimension is quantised at quantiles of its values, the cells are numbered
along a Hilbert curve, and rows are sorted by that number. Runs of the order
become shards, so rows of one shard are close in every dimension and a reader
that filters on any of them can skip most files by their minima and maxima.

Only DataFrame functions run here. Rows are ranked without a global window: a
range partitioning over ``(curve, doc_id)`` also cuts a cell that holds a third
of all rows, each partition counts its rows, and the running sum over the
partitions (one row each) gives the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.llm.common import stored

BITS = 4
#: ``monotonically_increasing_id`` has the partition above these bits, the row below.
ROW_BITS = 33


def cell(value: Column, cuts: list) -> Column:
    """How many of the ascending ``cuts`` are at or below ``value``; of null, none."""
    below = (F.coalesce(value >= F.lit(c), F.lit(False)).cast("int") for c in cuts)
    return sum(below, F.lit(0))


def number_cuts(df: DataFrame, dims: list[str], shares: list[float]) -> list[list[float]]:
    """Approximate quantiles of numeric dimensions over all rows; a null lies below all."""
    if not dims:
        return []
    values = [F.coalesce(F.col(f"`{d}`").cast("double"), F.lit(-1.0)) for d in dims]
    found = df.agg(
        *[F.percentile_approx(v, shares, 10_000).alias(f"c{k}") for k, v in enumerate(values)]
    ).first()
    return [found[k] or [] for k in range(len(dims))]


def text_cuts(df: DataFrame, dim: str, shares: list[float]) -> list[str]:
    """Quantiles of a text dimension over all rows, by whole values.

    The distinct values, each with its rows, are dealt out by range; running
    counts within the ranges and over them (one row each) say where a share of
    all rows is reached.
    """
    value = F.col(f"`{dim}`")
    counts = df.select(value.alias("value")).where("value is not null").groupBy("value").count()
    tasks = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    counts = counts.repartitionByRange(int(tasks), "value")
    counts = stored(counts.withColumn("part", F.spark_partition_id()))
    total = counts.agg(F.sum("count")).first()[0]
    if not total:
        return []
    # One row a range.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.groupBy("part").agg(F.sum("count").alias("rows"))
    offsets = sums.select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("value")
    reached = counts.join(F.broadcast(offsets), "part").withColumn(
        "reached", F.sum("count").over(inside) + F.col("before")
    )
    firsts = [
        F.min(F.when(F.col("reached") >= share * total, F.col("value"))).alias(f"c{k}")
        for k, share in enumerate(shares)
    ]
    return list(reached.agg(*firsts).first())


def gray_tables(dims: int) -> tuple[list[int], list[int], list[int]]:
    """Per digit of one step along the curve: inverse Gray code, entry corner, direction.

    The rules of Hamilton and Rau-Chaplin's description of the curve.
    """
    size = 1 << dims
    gray = [i ^ (i >> 1) for i in range(size)]
    inverse = [gray.index(i) for i in range(size)]
    entry = [0 if i == 0 else gray[2 * ((i - 1) // 2)] for i in range(size)]

    def trailing_ones(i: int) -> int:
        return (i ^ (i + 1)).bit_length() - 1

    direction = [
        0 if i == 0 else (trailing_ones(i - 1) if i % 2 == 0 else trailing_ones(i)) % dims
        for i in range(size)
    ]
    return inverse, entry, direction


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """The place of a cell along the Hilbert curve over ``2 ** bits`` cells a dimension."""
    dims = len(cells)
    full = (1 << dims) - 1
    inverse, entry, direction = (
        F.array(*[F.lit(v) for v in values]) for values in gray_tables(dims)
    )

    def shift_left(value: Column, by: Column) -> Column:
        return F.call_function("shiftleft", value, by)

    def shift_right(value: Column, by: Column) -> Column:
        return F.call_function("shiftright", value, by)

    def rotate_left(value: Column, by: Column) -> Column:
        by = by % dims
        turned = shift_left(value, by).bitwiseOR(shift_right(value, F.lit(dims) - by))
        return turned.bitwiseAND(full)

    def step(state: Column, level: Column) -> Column:
        corner, turn = state["corner"], state["turn"]
        digit = F.lit(0)
        for k, c in enumerate(cells):
            bit = shift_right(c.cast("int"), level).bitwiseAND(1)
            digit = digit.bitwiseOR(F.shiftleft(bit, k))
        by = turn + 1
        seen = rotate_left(digit.bitwiseXOR(corner), F.lit(dims) - by % dims)
        place = F.get(inverse, seen)
        return F.struct(
            F.shiftleft(state["index"], dims).bitwiseOR(place.cast("long")).alias("index"),
            corner.bitwiseXOR(rotate_left(F.get(entry, place), by)).alias("corner"),
            ((turn + F.get(direction, place) + 1) % dims).alias("turn"),
        )

    start = F.struct(
        F.lit(0).cast("long").alias("index"), F.lit(0).alias("corner"), F.lit(0).alias("turn")
    )
    levels = F.array(*[F.lit(b) for b in range(bits - 1, -1, -1)])
    return F.aggregate(levels, start, step, lambda state: state["index"])


def curve(df: DataFrame, dims: list[str], bits: int = BITS) -> DataFrame:
    """``df`` with ``curve``: the Hilbert index of its quantised ``dims``.

    Cuts are quantiles over all rows, of texts by their whole values: one row
    with ``2 ** bits - 1`` cuts a dimension is what the driver sees. The index is
    worked out once for each occupied cell, of which there are at most
    ``2 ** (bits * dims)``, and joined; only up to 65,536 of them are marked for
    broadcast.
    """
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    plain = [d for d in dims if not isinstance(df.schema[d].dataType, T.StringType)]
    cuts = dict(zip(plain, number_cuts(df, plain, shares), strict=True))
    values = {d: F.coalesce(F.col(f"`{d}`").cast("double"), F.lit(-1.0)) for d in plain}
    for d in dims:
        if d not in cuts:
            cuts[d], values[d] = text_cuts(df, d, shares), F.col(f"`{d}`")
    names = [f"cell_{k}" for k in range(len(dims))]
    celled = df.select("*", *[cell(values[d], cuts[d]).alias(names[k]) for k, d in enumerate(dims)])
    along = celled.select(*names).distinct()
    along = along.withColumn("curve", hilbert_index([F.col(n) for n in names], bits))
    if bits * len(dims) <= 16:
        along = F.broadcast(along)
    return celled.join(along, names).drop(*names)


def hilbert_shards(
    docs: DataFrame,
    shards: int = 24,
    dims: tuple[str, ...] = ("lang", "source", "n_bytes"),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, curve`` of every row.

    The law is ``rows``: runs along the curve with counts at most one apart.
    ``size`` is the text's UTF-8 bytes and 8 more; ``n_bytes`` may be named as a
    dimension. A null text has no bytes, a null dimension sorts first, rows of
    one cell are ordered by ``doc_id`` and then by size and checksum, and rows
    equal in all of these are interchangeable. An empty table gives an empty
    result. Other columns are not touched, whatever their names.
    """
    text = F.encode(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "UTF-8")
    own = [F.col(f"`{d}`").alias(f"dim_{k}") for k, d in enumerate(dims) if d != "n_bytes"]
    meta = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.crc32(text).alias("text_crc32"),
        *own,
    )
    meta = stored(meta)  # the texts are read once
    names = [d if d == "n_bytes" else f"dim_{k}" for k, d in enumerate(dims)]
    order = ["curve", "doc_id", "n_bytes", "text_crc32"]
    placed = curve(meta, names).select(*order)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = stored(
        placed.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id())
    ).withColumn("part", F.shiftright("place", ROW_BITS))

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranked.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select(
        "part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    rank = F.col("offset") + F.col("place").bitwiseAND((1 << ROW_BITS) - 1)
    numbered = ranked.join(F.broadcast(offsets), "part").withColumn("rank", rank)
    shard = F.expr(f"rank * {shards} div total")
    return numbered.withColumn("shard", shard).select(
        "doc_id",
        (F.col("n_bytes") + 8).alias("size"),
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        # The first rank of shard s is the least r with r * shards >= s * total.
        F.expr(f"rank - (shard * total + {shards} - 1) div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
