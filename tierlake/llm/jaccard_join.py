"""Similarity join on word shingles with token-combination prefixes (operator 10).

A document is the set of its distinct ``width``-word shingles, its *tokens*.
Two sets of Jaccard similarity ``t`` or more overlap in at least ``t`` of each.
With tokens in one global order, rare first, that forces common tokens near the
front:

* the first ``n - ceil(t n) + 1`` tokens of both, the *prefix*, share at least one;
* extended by ``g`` tokens, the prefixes share at least ``g + 1``.

Rare tokens of the prefix are index keys by themselves. If all that a pair
shares there are frequent tokens, keys of one frequent token would gather huge
groups; instead the prefix is extended by ``g``, frequent tokens are coloured
by hash with ``g`` colours, and every two of one colour are a key: of ``g + 1``
shared tokens two have one colour. ``g`` goes with the size of the smaller set,
so a set emits keys for the one or two values its partners may have.

How frequent a token is comes from a sketch of ``2 ** SKETCH_BITS`` counters
over all documents. It overestimates where tokens share a counter; any estimate
that is the same for all documents gives the right result. Tasks get the counters
on a scale of one byte.

The more tokens share a counter, the more frequent a token can be without
standing out. Where that could be more than ``HOT`` documents, the groups of
single tokens are counted, and larger ones are replaced: their members are keyed by
every two tokens of one colour in the extended prefix, so that two sets whose
first common token is such a one meet at a pair. Group sizes so do not follow
the size of the corpus, however coarse the sketch is for it.

With each key goes its *room*, how many tokens a set can still share from the
key's place on, plus the extension. A pair of sizes ``m`` and ``n`` overlaps in
``t / (1 + t) (m + n)`` tokens, more than each side knew alone; the key of its
first common tokens has that much room in both sets, so other matches are dropped.

Each set also has a bitmap in which every token flips one bit. Common tokens
cancel out in the exclusive or of two bitmaps, so its bits are at most the
tokens that only one side has; pairs with too many are never formed.

Candidates are verified on the words themselves. Within the group of a key,
first everyone is compared with one member, again while that links many; then
only those pairs whose members are still in different components. That is all that
components need, and a group of thousands of near copies costs no square.
Documents with equal sets are one *representative* throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.anchors import mixed
from tierlake.llm.common import broadcast_if_small, small_frames, stored, texts
from tierlake.llm.components import components
from tierlake.session import scratch

WIDTH = 5
PERCENT = 80
SKETCH_BITS = 22
BLOCK_BITS = 16
#: A token is frequent above this estimate, or well above the mean counter.
FREQUENT = 64
#: Documents that may meet at one single token; larger groups are keyed by pairs.
HOT = 256
#: Words whose hashes a worker keeps.
CACHE = 60_000
#: Characters of texts that are shingled at once; a longer text comes alone.
TOGETHER = 1 << 18
#: Rounds of comparing with one member of each group before pairs are formed, at most.
STARS = 4
#: 64-bit words of a set's bitmap.
BITMAP = 8
#: Candidate ids that are sent to every task instead of shuffling all texts.
BROADCAST_ROWS = 500_000

STEP = np.uint64(0x9E3779B97F4A7C15)
#: The bit that tells keys of single tokens (0) from others (1).
SINGLE = np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased: ``bytes`` methods know the six blanks and A-Z only."""
    return (text or "").encode().lower().split()


class Numbers(dict):
    """Words to small numbers, and the hash of each number's word."""

    def __init__(self):
        self.hashes = np.zeros(1024, dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        if number == len(self.hashes):
            self.hashes = np.concatenate((self.hashes, np.zeros_like(self.hashes)))
        self.hashes[number] = xxhash.xxh3_64_intdigest(word)
        return number


class Shingler:
    """Texts to tokens; hashes are kept for a bounded number of words."""

    def __init__(self, width: int):
        self.width, self.numbers = width, Numbers()

    def __call__(self, text: str | None) -> np.ndarray:
        """The sorted distinct 64-bit tokens of a text."""
        return self.together([text])[0]

    def together(self, batch: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all texts, one text after the other, and the places where texts begin and end."""
        if len(self.numbers) > CACHE:
            self.numbers = Numbers()
        words = [words_of(text) for text in batch]
        count = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        at = np.fromiter(
            map(self.numbers.__getitem__, chain.from_iterable(words)), dtype=np.int64, count=count.sum()
        )
        h = self.numbers.hashes[at]
        long = count >= self.width
        n = np.where(long, count - self.width + 1, np.minimum(count, 1))
        place, ends = np.zeros(len(n) + 1, dtype=np.int64), np.cumsum(count)
        np.cumsum(n, out=place[1:])
        total = np.zeros(place[-1], dtype=np.uint64)
        if long.any():
            left = np.repeat(ends, count) - np.arange(len(h))  # words from here to the text's end
            whole = np.flatnonzero(left >= self.width)
            total[np.repeat(long, n)] = hashed(h, self.width)[whole]
        for k in np.flatnonzero((n > 0) & ~long):
            total[place[k]] = hashed(h[ends[k] - count[k] : ends[k]], int(count[k]))[0]
        total = mixed(total)
        for begin, end in zip(place[:-1].tolist(), place[1:].tolist(), strict=True):
            total[begin:end].sort()
        new = np.ones(len(total), dtype=bool)
        new[1:] = total[1:] != total[:-1]
        new[place[:-1][n > 0]] = True
        kept = np.zeros(len(total) + 1, dtype=np.int64)
        np.cumsum(new, out=kept[1:])
        return total[new], kept[place]


def hashed(h: np.ndarray, size: int) -> np.ndarray:
    """One number for each run of ``size`` word hashes."""
    total = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        total = total * STEP + h[k : k + len(total)]
    return total


def batches(texts: Iterable[str | None]) -> Iterator[list[str | None]]:
    """Texts in batches of bounded length, or alone."""
    batch, length = [], 0
    for text in texts:
        if batch and length + len(text or "") > TOGETHER:
            yield batch
            batch, length = [], 0
        batch.append(text)
        length += len(text or "")
    if batch:
        yield batch


def overlap_needed(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def extension(n: int) -> int:
    """Tokens by which the prefix of a set of ``n`` is extended, and colours: a power of two."""
    return 1 if n < 16 else 1 << (int(n).bit_length() - 4)


def estimates(tokens: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Each token's counter; the sketch has a power of two of them."""
    shift = 64 - (len(sketch).bit_length() - 1)
    return sketch[(tokens >> np.uint64(shift)).astype(np.int64)]


def levels(counts: np.ndarray) -> np.ndarray:
    """Counts on a logarithmic scale of one byte."""
    scaled = np.empty(len(counts), dtype=np.uint8)
    for begin in range(0, len(counts), 1 << BLOCK_BITS):
        part = slice(begin, begin + (1 << BLOCK_BITS))
        scaled[part] = np.minimum(8 * np.log2(1.0 + counts[part]), 255)
    return scaled


def pairs_of(
    tokens: np.ndarray, place: np.ndarray, g: int, salt: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and rooms of every two tokens of one of ``g`` colours among those at ``place``."""
    colour = tokens[place] % np.uint64(g)
    by_colour = np.argsort(colour, kind="stable")
    place, colour = place[by_colour], colour[by_colour]
    # Neighbours at distance 1, 2, ... while any are left.
    for apart in range(1, len(place)):
        same = colour[apart:] == colour[:-apart]
        if not same.any():
            break
        one, two = place[:-apart][same], place[apart:][same]
        key = mixed(mixed(tokens[one] + np.uint64(g + salt)) * STEP + tokens[two])
        yield key | SINGLE, len(tokens) - two + g


def equal_only(n: int, percent: int) -> bool:
    """Are sets similar to one of ``n`` tokens equal to it?"""
    return overlap_needed(n, percent) == n == 100 * n // percent


def joined(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not found:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32)
    keys, rooms = zip(*found, strict=True)
    return np.concatenate(keys), np.concatenate(rooms).astype(np.int32)


def keys_of(
    tokens: np.ndarray, sketch: np.ndarray, frequent: float, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of a set (sorted) with their room: rare prefix tokens, pairs of frequent ones.

    Keys of single tokens are even, those of pairs odd.
    """
    n = len(tokens)
    need = overlap_needed(n, percent)
    if equal_only(n, percent):
        return joined([])
    estimate = estimates(tokens, sketch)
    order = np.argsort(estimate, kind="stable")
    tokens, often = tokens[order], estimate[order] > frequent
    prefix = n - need + 1
    place = np.flatnonzero(~often[:prefix])
    found = [(tokens[place] & ~SINGLE, n - place)]
    if often[:prefix].any():
        for g in {extension(n), extension(need)}:
            found += pairs_of(tokens, np.flatnonzero(often[: prefix + g]), g, 0)
    return joined(found)


def pair_keys_of(
    tokens: np.ndarray, sketch: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set (sorted) that holds a hot token: every two of one colour, rare or frequent.

    Two similar sets that both have such keys share one of them: their first
    ``g + 1`` common tokens are in both extended prefixes.
    """
    n = len(tokens)
    need = overlap_needed(n, percent)
    if equal_only(n, percent):
        return joined([])
    tokens = tokens[np.argsort(estimates(tokens, sketch), kind="stable")]
    found = []
    for g in {extension(n), extension(need)}:
        found += pairs_of(tokens, np.arange(min(n, n - need + 1 + g)), g, 1 << 40)
    return joined(found)


def bitmaps_of(tokens: np.ndarray, of: np.ndarray, sets: int) -> np.ndarray:
    """A row of ``BITMAP`` words for each of ``sets``, whose tokens these are."""
    bits = 64 * BITMAP
    at = of * bits + (tokens % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(at, minlength=sets * bits) & 1
    return np.packbits(odd.astype(np.uint8).reshape(sets, bits), axis=1).view(np.int64)


def token_sketch(rows: DataFrame, width: int) -> tuple[np.ndarray, float]:
    """Counters of all tokens by their leading bits, saturating, and the mean counter.

    Tasks send blocks of counters in as few bytes as they fit in, and of sparse
    blocks only those that are not zero; sums go over at most 256 tasks at a
    time. What reaches the driver has the fixed size of the sketch.
    """
    size, block = 1 << SKETCH_BITS, 1 << BLOCK_BITS

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle, waiting, pending = Shingler(width), [], 0
        counts, one = np.zeros(size, dtype="<u4"), np.uint32(1)
        for frame in frames:
            for batch in batches(frame["text"]):
                tokens, _ = shingle.together(batch)
                waiting.append((tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64))
                pending += len(waiting[-1])
                if pending > 1_000_000:
                    np.add.at(counts, np.concatenate(waiting), one)
                    waiting, pending = [], 0
        if waiting:
            np.add.at(counts, np.concatenate(waiting), one)
        part = TaskContext.get().partitionId()
        for k in range(size // block):
            yield pd.DataFrame([packed(k, part // 256, counts[k * block : (k + 1) * block])])

    def packed(k: int, part: int, counts: np.ndarray) -> dict:
        kind = next(t for t in ("<u1", "<u2", "<u4") if counts.max() <= np.iinfo(t).max)
        at = np.flatnonzero(counts)
        width = np.dtype(kind).itemsize
        if len(at) * (2 + width) < block * width:
            counts, at = counts[at], at.astype("<u2").tobytes()
        else:
            at = b""
        return {"block": k, "part": part, "kind": kind, "at": at, "n": counts.astype(kind).tobytes()}

    def add(total: np.ndarray, kind: str, at: bytes, n: bytes) -> None:
        where = np.frombuffer(at, dtype="<u2") if at or not n else slice(None)
        total[where] += np.frombuffer(n, dtype=kind)

    def summed(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(block, dtype=np.int64)
        for kind, at, n in zip(frame["kind"], frame["at"], frame["n"], strict=True):
            add(total, kind, at, n)
        total = np.minimum(total, np.iinfo("<u4").max)
        return pd.DataFrame([packed(int(frame["block"].iloc[0]), 0, total)])

    schema = "block int, part int, kind string, at binary, n binary"
    parts = rows.select("text").mapInPandas(count, schema)
    parts = parts.groupBy("block", "part").applyInPandas(summed, schema)
    sketch = np.zeros(size, dtype="<u4")
    with small_frames(rows.sparkSession):
        blocks = parts.groupBy("block").applyInPandas(summed, schema).collect()
    for row in blocks:
        add(sketch[row.block * block : (row.block + 1) * block], row.kind, row.at, row.n)
    return sketch, float(sketch.mean())


def signatures(
    rows: DataFrame, width: int, percent: int, sent: Broadcast, frequent: int, folder: str
) -> DataFrame:
    """``doc_id, n_shingles, s1, s2, bits, keys, rooms`` of each row, stored.

    Equal sets have equal ``n_shingles, s1, s2``. ``sent`` has the levels of the
    sketch, ``frequent`` is the level above which a token is frequent.
    """

    def sums(hashes: np.ndarray, place: np.ndarray) -> np.ndarray:
        total = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes, out=total[1:])
        return (total[place[1:]] - total[place[:-1]]).view(np.int64)

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(width)
        for frame in frames:
            begin = 0
            for batch in batches(frame["text"]):
                tokens, place = shingle.together(batch)
                n = np.diff(place)
                of = np.repeat(np.arange(len(batch)), n)
                ends = zip(place[:-1].tolist(), place[1:].tolist(), strict=True)
                posts = [keys_of(tokens[a:b], sent.value, frequent, percent) for a, b in ends]
                yield pd.DataFrame(
                    {
                        "doc_id": frame["doc_id"].iloc[begin : begin + len(batch)].to_numpy(),
                        "n_shingles": n,
                        "s1": sums(mixed(tokens), place),
                        "s2": sums(mixed(tokens ^ STEP), place),
                        "bits": list(bitmaps_of(tokens, of, len(batch))),
                        "keys": [key.view(np.int64) for key, _ in posts],
                        "rooms": [room for _, room in posts],
                    }
                )
                begin += len(batch)

    kind = rows.schema["doc_id"].dataType.simpleString()
    signed = rows.mapInPandas(
        sign,
        f"doc_id {kind}, n_shingles long, s1 long, s2 long, bits array<long>, "
        "keys array<long>, rooms array<int>",
    )
    return stored(signed, folder)


def without_hot(
    posted: DataFrame, rows: DataFrame, width: int, percent: int, sent: Broadcast, folder: str
) -> DataFrame:
    """``posted`` with the single tokens of more than ``HOT`` sets replaced by pairs."""
    single = F.col("key").bitwiseAND(F.lit(1)) == 0
    hot = posted.where(single).groupBy("key").count().where(F.col("count") > HOT).select("key")
    hot = broadcast_if_small(stored(hot, folder), BROADCAST_ROWS)
    held = posted.join(hot, "key", "left_semi").select(F.col("rep").alias("doc_id")).distinct()
    held = broadcast_if_small(stored(held, folder), BROADCAST_ROWS)

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(width)
        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                tokens = shingle(text)
                keys, rooms = pair_keys_of(tokens, sent.value, percent)
                row = {"rep": doc_id, "n": len(tokens), "keys": keys.view(np.int64), "rooms": rooms}
                yield pd.DataFrame([row])

    schema = f"rep {kind(rows)}, n long, keys array<long>, rooms array<int>"
    pairs = rows.join(held, "doc_id", "left_semi").mapInPandas(sign, schema)
    return posted.join(hot, "key", "left_anti").unionByName(posted_keys(stored(pairs, folder)))


def verified(pairs: DataFrame, rows: DataFrame, width: int, percent: int, folder: str) -> DataFrame:
    """Those of ``pairs`` (``a, b``) whose texts are similar, shingle by shingle."""
    # Each text goes once to every pair it is in, and both meet by pair.
    sides = F.explode(
        F.array(
            F.struct(F.col("a").alias("id"), F.lit(True).alias("is_a")),
            F.struct(F.col("b").alias("id"), F.lit(False).alias("is_a")),
        )
    )
    sides = broadcast_if_small(pairs, BROADCAST_ROWS).select("a", "b", sides.alias("side"))
    both = rows.join(sides, F.col("doc_id") == F.col("side.id")).groupBy("a", "b").agg(
        F.first(F.when(F.col("side.is_a"), F.col("text")), True).alias("text_a"),
        F.first(F.when(~F.col("side.is_a"), F.col("text")), True).alias("text_b"),
    )

    def shingles(text: str | None) -> set[tuple[bytes, ...]]:
        words = words_of(text)
        size = min(width, len(words))
        return set(zip(*(words[k:] for k in range(size)), strict=False)) if size else set()

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple = None, set()
        for frame in frames:
            keep = []
            for a, b in zip(frame["text_a"], frame["text_b"], strict=True):
                if last[0] != a:
                    last = a, shingles(a)
                x, y = last[1], shingles(b)
                both = len(x & y)
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield frame.loc[keep, ["a", "b"]]

    kind = rows.schema["doc_id"].dataType.simpleString()
    return stored(both.mapInPandas(compare, f"a {kind}, b {kind}"), folder)


def jaccard_components(
    docs: DataFrame,
    width: int = WIDTH,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Documents are linked when ``100 * |intersection| >= percent * |union|`` of
    their shingle sets; ``component_id`` is the smallest ``doc_id`` reachable.
    A document of fewer words than ``width`` has its whole word sequence as one
    shingle; one without words, null text included, has none and is linked with
    nothing. A row without a ``doc_id`` is linked with nothing and has no
    component. Rows that repeat a ``doc_id`` are documents of their own. An
    empty table gives an empty result.
    """
    rows = texts(docs, id_col, text_col)
    if rows.groupBy("doc_id").count().where("count > 1").limit(1).count() == 0:
        return unique_components(rows, width, percent)
    numbered = stored(rows.withColumn("row", F.monotonically_increasing_id()))
    parts = []
    for part in (numbered.where("doc_id is not null"), numbered.where("doc_id is null")):
        found = unique_components(part.select(F.col("row").alias("doc_id"), "text"), width, percent)
        found = found.select(F.col("doc_id").alias("row"), "n_shingles", "component_id")
        parts.append(stored(part.select("row", "doc_id").join(found, "row")))
    lowest = parts[0].groupBy("component_id").agg(F.min("doc_id").alias("low"))
    known = parts[0].join(lowest, "component_id").select(
        "doc_id", "n_shingles", F.col("low").alias("component_id")
    )
    alone = parts[1].select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return known.unionByName(alone)


def unique_components(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """``jaccard_components`` of ``doc_id, text`` rows with different ids."""
    spark = rows.sparkSession
    folder = scratch(spark)
    sketch, mean = token_sketch(rows, width)
    frequent = max(FREQUENT, 2 * mean + 6 * math.sqrt(mean))
    level = int(levels(np.array([frequent]))[0])
    sent = spark.sparkContext.broadcast(levels(sketch))
    signed = signatures(rows, width, percent, sent, level, folder)
    able = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    same = "n_shingles", "s1", "s2"
    classes = stored(able.groupBy(*same).agg(F.min("doc_id").alias("rep")), folder)

    first = able.join(
        classes.select(*same, F.col("rep").alias("doc_id")), [*same, "doc_id"], "left_semi"
    )
    posted = posted_keys(
        first.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "keys", "rooms")
    )
    # A rare token's counter, hence its group, is below the next level.
    if 2 ** ((level + 1) / 8) > HOT:
        posted = without_hot(posted, rows, width, percent, sent, folder)
    shared = posted.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
    shared = shared.where("low < high").select("key")
    held = stored(gathered(posted.join(shared, "key")), folder)
    sent.destroy()

    links = spark.createDataFrame([], f"a {kind(rows)}, b {kind(rows)}")
    labels, last = None, False
    for turn in range(STARS + 1):
        # Components are joined to documents, then keys are posted.
        if labels is None:
            held = held.withColumn("of", F.col("rep"))
        else:
            of = broadcast_if_small(labels, BROADCAST_ROWS)
            held = held.join(of, held["rep"] == of["node"], "left")
            held = held.withColumn("of", F.coalesce("component", "rep")).drop("node", "component")
        if last:  # pairs will be formed: bring the bitmaps
            bits = [F.get("bits", F.lit(k)).alias(f"bits_{k}") for k in range(BITMAP)]
            bits = able.join(held.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").select(
                F.col("doc_id").alias("rep"), *bits
            )
            held = held.join(broadcast_if_small(stored(bits, folder), BROADCAST_ROWS), "rep")
        posted = posted_keys(held)
        # A group is open while its members are in more than one component. First
        # everyone meets the member most of whose keys are shared: an original has
        # no words of its own, its copies have.
        merit = F.col("n_keys") / F.col("n") if turn == 0 else F.lit(0.0)
        member = "rep", "n", "room", "of"
        open_keys = posted.groupBy("key").agg(
            F.min("of").alias("low"),
            F.max("of").alias("high"),
            F.max(F.struct(merit, F.xxhash64("rep", F.lit(turn)), *member)).alias("pivot"),
        )
        open_keys = open_keys.where("low < high").select("key", "pivot")
        left = stored(posted.join(open_keys, "key"), folder)
        overlap = F.ceil((F.col("x_n") + F.col("y_n")) * percent / F.lit(100.0 + percent))
        x = [F.col(c).alias(f"x_{c}") for c in member]
        if last:
            words = [f"bits_{k}" for k in range(BITMAP)]
            y = left.select("key", *[F.col(c).alias(f"y_{c}") for c in (*member, *words)])
            x += [F.col(c).alias(f"x_{c}") for c in words]
            differ = sum(F.bit_count(F.col(f"x_{c}").bitwiseXOR(F.col(f"y_{c}"))) for c in words)
            pairs = left.select("key", *x).join(y, "key")
            room = F.col("x_n") + F.col("y_n") - 2 * overlap
            pairs = pairs.where((F.col("x_rep") < F.col("y_rep")) & (differ <= room))
        else:
            pairs = left.select(*x, *[F.col(f"pivot.{c}").alias(f"y_{c}") for c in member])
        pairs = pairs.where(
            (F.col("x_of") != F.col("y_of"))
            & (F.least("x_n", "y_n") * 100 >= F.greatest("x_n", "y_n") * percent)
            & (F.least("x_room", "y_room") >= overlap)
        ).select(F.least("x_rep", "y_rep").alias("a"), F.greatest("x_rep", "y_rep").alias("b"))
        pairs = stored(pairs.distinct(), folder)
        count = pairs.count()
        if count:
            found = verified(pairs, rows, width, percent, folder)
            links = links.unionByName(found)
            labels = components(links, folder)
        if last:
            break
        # Another round only while one links many.
        last = not count or turn + 1 >= STARS or 10 * found.count() < count
        held = stored(gathered(left), folder)

    result = able.join(classes, list(same)).select("doc_id", "n_shingles", "rep")
    if labels is not None:
        result = result.join(labels, result["rep"] == labels["node"], "left")
        result = result.withColumn("component_id", F.coalesce("component", "rep"))
    else:
        result = result.withColumn("component_id", F.col("rep"))
    rest = signed.where(F.col("doc_id").isNull() | (F.col("n_shingles") == 0)).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return result.select("doc_id", "n_shingles", "component_id").unionByName(rest)


def posted_keys(held: DataFrame) -> DataFrame:
    """One row a key, from rows of ``keys`` and ``rooms``."""
    other = [c for c in held.columns if c not in ("keys", "rooms")]
    each = F.explode(F.arrays_zip("keys", "rooms")).alias("each")
    return held.select(*other, F.size("keys").alias("n_keys"), each).select(
        *other, "n_keys", F.col("each.keys").alias("key"), F.col("each.rooms").alias("room")
    )


def gathered(posted: DataFrame) -> DataFrame:
    """One row a document again; its keys are bounded by its size."""
    return posted.groupBy("rep").agg(
        F.first("n").alias("n"),
        F.collect_list("key").alias("keys"),
        F.collect_list("room").alias("rooms"),
    )


def kind(rows: DataFrame) -> str:
    return rows.schema["doc_id"].dataType.simpleString()
