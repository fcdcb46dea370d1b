"""Quality scores from a factorisation machine (operator 6).

Features are hashed words, structure statistics and metadata columns. The
machine adds to a linear model an interaction of every pair of features, the
inner product of two short vectors; the sum over all pairs is

    1/2 * sum_f ((sum_i v_if x_i) ** 2 - sum_i (v_if x_i) ** 2)

so that a document is scored in time linear in its features. The machine is
fitted on a bounded sample of labelled rows (``max_train``, a parameter) and
sent to the tasks that score all documents; its size is fixed by ``slots`` and
``rank``.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import small_frames, stored

SLOTS = 1 << 14
RANK = 8
MAX_TRAIN = 8_000
EPOCHS = 12
BATCH = 256
RATE = 0.1
DECAY = 1e-4
ACCEPT = 0.7
#: Documents are in the held-out fold when crc32 of their id is so, modulo FOLDS.
FOLDS, HELD_OUT = 4, 2

CAPITALS = bytes(range(65, 91))
DIGITS = b"0123456789"
PUNCTUATION = b".,;:!?\"'()-"
SYMBOLS = b"#*$%&|<>@^~_=+{}[]\\/"
STRUCTURE = (
    "log_words word_bytes capitals digits punctuation symbols bars marks distinct_words "
    "top_word repeated_pairs log_lines line_bytes repeated_lines ends"
).split()


def structure(raw: bytes, words: list[bytes], counts: Counter) -> list[float]:
    """One number for each name in ``STRUCTURE``."""
    size, n = max(1, len(raw)), max(1, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    pairs = len(words) - 1
    ends = sum(x.rstrip().endswith((b".", b"!", b"?", b'"')) for x in lines)
    return [
        math.log1p(len(words)),
        sum(len(w) * k for w, k in counts.items()) / n,
        (len(raw) - len(raw.translate(None, CAPITALS))) / size,
        (len(raw) - len(raw.translate(None, DIGITS))) / size,
        (len(raw) - len(raw.translate(None, PUNCTUATION))) / size,
        (len(raw) - len(raw.translate(None, SYMBOLS))) / size,
        raw.count(b"|") / n,
        raw.count(b"!") / n,
        len(counts) / n**0.8,
        max(counts.values(), default=0) / n,
        (pairs - len(set(zip(words, words[1:], strict=False)))) / max(1, pairs),
        math.log1p(len(lines)),
        math.log1p(size / max(1, len(lines))),
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        ends / max(1, len(lines)),
    ]


def meta_slot(name: str, value, slots: int) -> int:
    """A slot for a metadata value; numbers by their order of magnitude, null by itself."""
    if value is None or value != value:
        key = "null"
    elif isinstance(value, (int, float, np.number)):
        key = str(int(math.log2(abs(value) + 1) * 2) * (-1 if value < 0 else 1))
    else:
        key = str(value)
    return len(STRUCTURE) + zlib.crc32(f"{name}={key}".encode()) % (slots - len(STRUCTURE))


def features(text: str | None, meta: list[tuple], slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values: structure first, not yet scaled, then words and metadata."""
    raw = (text or "").encode()
    words = raw.split()
    counts = Counter(words)
    first, room = len(STRUCTURE), slots - len(STRUCTURE)
    hashed = [first + zlib.crc32(w) % room for w in counts]
    weight = np.log1p(np.fromiter(counts.values(), dtype=np.float32, count=len(counts)))
    norm = float(np.sqrt((weight**2).sum())) or 1.0
    at = np.array(
        [*range(first), *hashed, *(meta_slot(k, v, slots) for k, v in meta)], dtype=np.int32
    )
    values = np.concatenate(
        (structure(raw, words, counts), weight / norm, np.full(len(meta), 0.3))
    ).astype(np.float32)
    return at, values


@dataclass
class Machine:
    """``bias + linear . x + pairwise``, through the logistic function."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def scaled(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Structure numbers in units of their spread, kept within three of them."""
        out = values.copy()
        own = at < len(self.mean)
        z = (values[own] - self.mean[at[own]]) / self.spread[at[own]]
        out[own] = np.clip(z, -3, 3) * 0.3
        return out

    def raw(self, at: np.ndarray, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic function, and ``sum_i v_if x_i`` for each row."""
        vx = self.factors[at] * x[:, None]
        sums = np.add.reduceat(vx, starts)
        squares = np.add.reduceat((vx**2).sum(axis=1), starts)
        linear = np.add.reduceat(self.linear[at] * x, starts)
        return self.bias + linear + 0.5 * ((sums**2).sum(axis=1) - squares), sums

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        at, values, starts = flat(rows)
        return logistic(self.raw(at, self.scaled(at, values), starts)[0])


def flat(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = [len(at) for at, _ in rows]
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    return np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), starts


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def fit(
    rows: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    slots: int = SLOTS,
    rank: int = RANK,
    epochs: int = EPOCHS,
    seed: int = 1,
) -> Machine:
    """Minimise the logistic loss in small batches with per-weight step sizes.

    Without both labels there is nothing to tell apart: the score is then the
    share of label 1, and 1 without any label.
    """
    rng = np.random.default_rng(seed)
    own = len(STRUCTURE)
    share = float(labels.mean()) if len(labels) else 1.0
    share = min(max(share, 1e-6), 1 - 1e-6)
    machine = Machine(
        math.log(share / (1 - share)),
        np.zeros(slots),
        np.zeros((slots, rank)),
        np.zeros(own),
        np.ones(own),
    )
    if len(labels) == 0 or labels.min() == labels.max():
        return machine
    machine.factors = rng.normal(0, 0.05, (slots, rank))
    stats = np.array([values[:own] for _, values in rows])
    machine.mean, machine.spread = stats.mean(axis=0), stats.std(axis=0) + 1e-6
    scaled = [(at, machine.scaled(at, values)) for at, values in rows]
    seen = [np.full(slots, 1e-6), np.full((slots, rank), 1e-6)]
    seen_bias = 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for begin in range(0, len(rows), BATCH):
            pick = order[begin : begin + BATCH]
            at, x, starts = flat([scaled[i] for i in pick])
            raw, sums = machine.raw(at, x, starts)
            error = logistic(raw) - labels[pick]
            of = np.repeat(np.arange(len(pick)), np.diff(np.append(starts, len(at))))
            pull = error[of] * x / len(pick)
            touched = np.bincount(at, minlength=slots) > 0
            step = np.bincount(at, weights=pull, minlength=slots)
            step += DECAY * machine.linear * touched
            seen[0] += step**2
            machine.linear -= RATE * step / np.sqrt(seen[0])
            inner = pull[:, None] * (sums[of] - machine.factors[at] * x[:, None])
            for f in range(rank):
                step = np.bincount(at, weights=inner[:, f], minlength=slots)
                step += DECAY * machine.factors[:, f] * touched
                seen[1][:, f] += step**2
                machine.factors[:, f] -= RATE * step / np.sqrt(seen[1][:, f])
            slope = float(error.mean())
            seen_bias += slope**2
            machine.bias -= RATE * slope / math.sqrt(seen_bias)
    return machine


def in_fold(doc_id) -> F.Column:
    """Is the document held out? A null id is not."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    meta_cols: tuple[str, ...] = ("n_chars",),
    max_train: int = MAX_TRAIN,
    slots: int = SLOTS,
    rank: int = RANK,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    row_col: str | None = None,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, and ``row_col`` as ``row`` if given.

    ``labels`` has the id and ``label_col``; null labels and the held-out fold
    teach nothing. At most ``max_train`` labelled ids, the first in the order of
    a hash, are fitted on, and at most as many rows if those ids are repeated. The score uses the text and ``meta_cols`` only. A
    null text is an empty one, which is scored by its structure; null metadata
    is a value of its own. Repeated rows are scored each; an empty table gives
    an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = [f"meta_{k}" for k in range(len(meta_cols))]
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"),
        *[F.col(f"`{c}`").alias(n) for c, n in zip(meta_cols, names, strict=True)],
        F.col(f"`{row_col or id_col}`").alias("row"),
    )
    row_kind = rows.schema["row"].dataType.simpleString()

    def of(frame: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
        metas = zip(*[frame[n] for n in names], strict=True) if names else [()] * len(frame)
        return [
            features(text, list(zip(meta_cols, meta, strict=True)), slots)
            for text, meta in zip(frame["text"], metas, strict=True)
        ]

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = of(frame)
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "label": frame["label"].astype("float64"),
                    "at": [at.tobytes() for at, _ in made],
                    "x": [x.tobytes() for _, x in made],
                }
            )

    taught = labels.select(
        F.col(f"`{id_col}`").alias("label_id"), F.col(f"`{label_col}`").cast("double").alias("label")
    ).where(F.col("label").isNotNull() & ~in_fold(F.col("label_id")))
    taught = taught.orderBy(F.xxhash64("label_id"), "label_id", "label").limit(max_train)
    sample = (
        rows.join(F.broadcast(taught), F.col("doc_id") == F.col("label_id"))
        .drop("label_id")
        .mapInPandas(packed, f"doc_id {kind}, label double, at binary, x binary")
    )
    # The order of arrival must not matter; nor may ids that are repeated bring more rows here.
    with small_frames(docs.sparkSession):
        sample = sample.orderBy("doc_id", "label", "x", "at").limit(max_train).toPandas()
    made = [
        (np.frombuffer(at, dtype=np.int32), np.frombuffer(x, dtype=np.float32))
        for at, x in zip(sample["at"], sample["x"], strict=True)
    ]
    machine = fit(made, (sample["label"] >= 0.5).to_numpy(dtype=float), slots, rank)
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            scores = [
                sent.value.score(of(frame.iloc[k : k + 500])) for k in range(0, len(frame), 500)
            ]
            yield pd.DataFrame(
                {
                    "row": frame["row"],
                    "doc_id": frame["doc_id"],
                    "score": np.concatenate(scores) if scores else np.zeros(0),
                }
            )

    found = stored(rows.mapInPandas(scored, f"row {row_kind}, doc_id {kind}, score double"))
    sent.destroy()
    return found.select(
        "doc_id",
        in_fold(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
        *(["row"] if row_col else []),
    )
