"""Quality rules from tokeniser fertility (operator 1).

Text that a public vocabulary cuts into unusually many, unusually few or
unusually monotonous tokens for its language is markup, noise or the wrong
language. Per document, over its words:

* ``chars_per_token`` with a byte-level BPE;
* ``byte_share``: the part of a sentencepiece model's tokens that are single
  bytes, its way out for characters it does not know;
* ``entropy``: Shannon entropy of the byte-level tokens as a part of the most
  that so many tokens can have.

Bands come from all documents of a language that pass the base rules: quartiles
widened by ``width`` times their distance, and more for short texts, whose means
scatter: by the root of ``1 + SCATTER / words``. Quartiles closer than ``LEAST``
count as that far apart: where most documents have no byte tokens at all, both
quartiles of ``byte_share`` are zero, and a few such tokens are no fault. Documents without a language are
judged with their script. Vocabularies cut a word alike wherever it stands, so
every distinct word of a batch is cut once.
"""

from __future__ import annotations

import itertools
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import BLANKS, broadcast_if_small, stored
from tierlake.llm.vocabularies import BYTE_BPE, PIECE_BPE, byte_bpe_ids, piece_bpe

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
METRICS = "chars_per_token", "byte_share", "entropy"
#: At so many words the scatter within a text is like that between texts.
SCATTER = 200
#: Distance of the quartiles that a band is widened by at least. At a ``width`` of 2, a long
#: text may have 6 percent byte tokens more than its language, one of 50 words 13 percent.
LEAST = {"chars_per_token": 0.02, "byte_share": 0.03, "entropy": 0.02}
#: Words whose cut a worker keeps at most.
CACHE = 200_000
#: Characters of texts whose words are cut together.
CHUNK = 2_000_000
#: Bands sent to every task instead of shuffling; there is one a language.
BAND_ROWS = 10_000


def base_counts(text: str, words: list[bytes], ids: np.ndarray, kinds: int) -> tuple:
    """``word_chars, n_symbols, n_dup_lines, n_repeat_words``; ``ids`` numbers equal words alike."""
    word_chars = len(text) - sum(text.count(c) for c in BLANKS)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    repeated = 0
    if len(words) >= 4:
        pairs = ids[:-1] * kinds + ids[1:]
        pairs = np.unique(pairs, return_inverse=True)[1]  # small again: no overflow below
        threes = pairs[:-1] * kinds + ids[2:]
        _, where, times = np.unique(threes, return_inverse=True, return_counts=True)
        again = times[where] >= 2
        covered = np.zeros(len(words), dtype=bool)
        for shift in range(3):
            covered[shift : shift + len(again)] |= again
        repeated = int(covered.sum())
    return word_chars, symbols, len(lines) - len(set(lines)), repeated


class Cutter:
    """Token ids of words in both vocabularies, as bytes, with a bounded cache."""

    def __init__(self, byte_path: str, piece_path: str):
        self.encode = byte_bpe_ids(byte_path)
        self.model, self.is_byte = piece_bpe(piece_path)
        self.cache: dict[bytes, tuple[bytes, int, int]] = {}

    def learn(self, words: set[bytes]) -> None:
        """Cut the words that are not known yet, all in one call: calls are dear."""
        cache = self.cache
        if len(cache) + len(words) > CACHE:
            cache.clear()
        new = [w for w in words if w not in cache]
        if not new:
            return
        plain = [w.decode() for w in new]
        pieces = self.model.encode(plain, num_threads=1)
        sizes = np.array([len(p) for p in pieces])
        flat = np.fromiter(itertools.chain.from_iterable(pieces), dtype=np.int64, count=sizes.sum())
        upto = np.concatenate(([0], np.cumsum(self.is_byte[flat])))
        ends = np.cumsum(sizes)
        in_bytes = (upto[ends] - upto[ends - sizes]).tolist()
        encode = self.encode
        for word, text, size, single in zip(new, plain, sizes.tolist(), in_bytes, strict=True):
            cache[word] = array("I", encode(" " + text)).tobytes(), size, single


def script_of(text: str) -> str:
    """The script of most letters among the distinct characters, by their Unicode names."""
    counts: dict[str, int] = {}
    for c in set(text):
        if c.isalpha():
            name = unicodedata.name(c, "UNKNOWN").split()[0]
            counts[name] = counts.get(name, 0) + text.count(c)
    return min(counts, key=lambda k: (-counts[k], k)) if counts else "NONE"


def chunks(frame: pd.DataFrame, cut: Cutter) -> Iterator[tuple]:
    """``doc_id, lang, text, words`` of each row, once its words are known to ``cut``."""
    held, size = [], 0
    for row in zip(frame["doc_id"], frame["lang"], frame["text"], strict=True):
        text = row[2] or ""
        held.append((*row[:2], text, text.encode().split()))  # at the six blanks, as bytes
        size += len(text)
        if size > CHUNK:
            cut.learn({w for row in held for w in row[3]})
            yield from held
            held, size = [], 0
    cut.learn({w for row in held for w in row[3]})
    yield from held


def measure(frame: pd.DataFrame, cut: Cutter) -> pd.DataFrame:
    out = []
    for doc_id, lang, text, words in chunks(frame, cut):
        numbers: dict[bytes, int] = {}
        ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
        base = base_counts(text, words, ids, len(numbers))
        chars, shares, entropy = None, None, None
        if words:
            times = np.bincount(ids)
            cuts = [cut.cache[w] for w in numbers]
            tokens = np.frombuffer(b"".join(c[0] for c in cuts), dtype="<u4")
            weight = np.repeat(times, [len(c[0]) // 4 for c in cuts])
            pieces = times @ np.array([c[1] for c in cuts])
            total = int(weight.sum())
            held = np.bincount(np.unique(tokens, return_inverse=True)[1], weights=weight) / total
            bits = float(-(held * np.log2(held)).sum())
            chars = base[0] / total
            shares = float(times @ np.array([c[2] for c in cuts]) / max(1, pieces))
            entropy = bits / np.log2(total) if total > 1 else 0.0
        key = lang if isinstance(lang, str) else f"script:{script_of(text)}"
        out.append((doc_id, len(words), *base, key, chars, shares, entropy))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return pd.DataFrame(out, columns=[*columns, "band", *METRICS])


def fertility(
    docs: DataFrame,
    width: float = 2.0,
    byte_path: str = BYTE_BPE,
    piece_path: str = PIECE_BPE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
) -> DataFrame:
    """Counts, metrics, ``base_failed`` and ``kept`` of every row.

    A null or empty text has no words: it fails the base rules, and its metrics
    are null. A null language, or ``lang_col=None``, means the band of the
    text's script. Repeated rows are judged each; quartiles count them all. An
    empty table gives an empty result; a band without passing documents rejects
    nothing.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    lang = F.col(f"`{lang_col}`") if lang_col else F.lit(None)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"),
        lang.cast("string").alias("lang"),
    )

    def measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut = Cutter(byte_path, piece_path)
        for frame in frames:
            yield measure(frame, cut)

    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    metrics = ", ".join(f"{m} double" for m in METRICS)
    found = rows.mapInPandas(measured, f"doc_id {kind}, {counts}, band string, {metrics}")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )
    found = stored(found.withColumn("base_failed", failed))
    quartiles = found.where(~F.col("base_failed")).groupBy("band").agg(
        *[F.percentile_approx(m, [0.25, 0.75], 10_000).alias(f"q_{m}") for m in METRICS]
    )
    limits = quartiles.select(
        F.col("band").alias("of_band"),
        *[
            F.expr(f"q_{m}[{k}]").alias(f"{side}_{m}")
            for m in METRICS
            for k, side in enumerate(("low", "high"))
        ],
    )
    spread = F.lit(width) * F.sqrt(1 + F.lit(SCATTER) / F.greatest(F.col("n_words"), F.lit(1)))
    inside = F.lit(True)
    for m in METRICS:
        low, high = F.col(f"low_{m}"), F.col(f"high_{m}")
        room = spread * F.greatest(high - low, F.lit(LEAST[m]))
        inside &= F.coalesce(F.col(m).between(low - room, high + room), F.lit(True))
    judged = found.join(
        broadcast_if_small(limits, BAND_ROWS), F.col("band") == F.col("of_band"), "left"
    )
    return judged.select(*found.columns, (~F.col("base_failed") & inside).alias("kept"))
