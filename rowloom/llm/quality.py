"""Quality rules: fixed base rules, then a calibrated logistic regression over n-grams.

The classifier sees hashed words, word pairs and three-byte character n-grams of the whole
text, each with the square root of its share. It is learned by per-coordinate online updates
on four fifths of a bounded sample of labelled rows (``rows``, first by a hash of their id)
and calibrated on the last fifth (Platt's two parameters), so that ``keep_from`` is a fixed
probability. Texts are counted and scored in Arrow batches where they are read; nothing is
shuffled.

Edge cases: null and empty texts have no words, fail the base rules and score the bias;
without labels every text scores 0.5 and is kept if the base rules hold; repeated rows
score alike; an empty table gives an empty result; other columns are kept as they are,
except one named like ``into``, which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm.common import text_bytes
from rowloom.llm.linear import Ftrl, Weights, fit, in_one_task, sample_features, sigmoid

ROWS = 4000
KEEP_FROM = 0.3
HASH_BITS = 20
FTRL = Ftrl(alpha=0.5, beta=1.0, l1=0.05, l2=0.05, epochs=4, min_rows=3)
SYMBOLS = b"#*$%&|<>"  # fixed value of the contract
SPACE = b"\x20\t\n\x0b\x0c\r"
MIX = np.uint64(0x9E3779B97F4A7C15)  # an odd factor


@dataclass(frozen=True)
class Model:
    """Weights by bucket (dense), bias, and the calibration ``slope * margin + offset``."""

    weights: Weights
    slope: float
    offset: float


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def base_counts(raw: bytes, words: list[bytes], h: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    solid = np.frombuffer(raw.translate(None, SPACE), np.uint8)
    chars = int(((solid & 0xC0) != 0x80).sum())
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen, dup = set(), 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip(SPACE):
            seen.add(line)
    return len(words), chars, symbols, dup, repeat_words(h)


def repeat_words(h: np.ndarray, window: int = 5) -> int:
    """Words inside any window of words that is found twice or more."""
    n = len(h) - window + 1
    if n < 2:
        return 0
    key = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(window):
            key = (key ^ h[i : i + n]) * MIX
            key ^= key >> np.uint64(29)
    _, back, counts = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[back] > 1)
    edge = np.zeros(len(h) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def buckets(raw: bytes, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram buckets of a text and the square roots of their shares."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint64)
    with np.errstate(over="ignore"):
        chars = (b[:-2] | b[1:-1] << np.uint64(8) | b[2:] << np.uint64(16)) + np.uint64(1)
        all_ = np.concatenate([h * MIX, (h[:-1] * MIX + h[1:]) * MIX, chars * MIX])
    if not len(all_):
        return np.empty(0, np.uint64), np.empty(0)
    found, counts = np.unique((all_ >> np.uint64(64 - HASH_BITS)).astype(np.uint32), return_counts=True)
    return found.astype(np.uint64), np.sqrt(counts / len(all_))


def features(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    return buckets(raw, word_hashes(raw.split()))


def calibration(margins: np.ndarray, labels: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Platt's slope and offset by Newton steps on smoothed targets."""
    good = labels.sum()
    if not len(labels) or good in (0, len(labels)):
        return 1.0, 0.0
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (len(labels) - good + 2))
    x, ab = np.c_[margins, np.ones(len(margins))], np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(x @ ab)
        slope = x.T @ (p - target) + 1e-3 * (ab - [1.0, 0.0])
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        ab = ab - np.linalg.solve(curve, slope)
    return (float(ab[0]), float(ab[1])) if np.isfinite(ab).all() and ab[0] > 0 else (1.0, 0.0)


def _margin(w: Weights, f: np.ndarray, v: np.ndarray) -> float:
    if not len(w.hashes) or not len(f):
        return w.bias
    at = np.minimum(np.searchsorted(w.hashes, f), len(w.hashes) - 1)
    return w.bias + float((w.values[at] * (w.hashes[at] == f)) @ v)


def _learn(rows, labels) -> list[tuple[int, float]]:
    own = [i for i in range(len(rows)) if i % 5]
    w = fit([rows[i] for i in own], [labels[i] for i in own], FTRL)
    rest = [i for i in range(len(rows)) if not i % 5]
    slope, offset = calibration(
        np.array([_margin(w, *rows[i]) for i in rest]), np.array([labels[i] for i in rest], np.int64)
    )
    return [(0, w.bias), (0, slope), (0, offset), *zip(w.hashes.view(np.int64).tolist(), w.values.tolist())]


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    sample = sample_features(docs, labels, label_col, features, rows=rows, id_col=id_col, text_col=text_col)
    found = in_one_task(sample, _learn)
    bias, slope, offset = (r.value for r in found[:3])
    hashes = np.array([r.key for r in found[3:]], np.int64).view(np.uint64)
    return Model(Weights(bias, hashes, np.array([r.value for r in found[3:]], np.float64)), slope, offset)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def assess(docs: DataFrame, model: Model, *, text_col: str = "text", into: str = "quality_of") -> DataFrame:
    """``docs`` with a struct ``into`` of the base counts and the calibrated ``score``."""
    known = docs.sparkSession.sparkContext.broadcast(model)  # at most 2 ** HASH_BITS weights
    dense: list[np.ndarray] = []
    kind = T.StructType([*[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("score", T.DoubleType())])
    arrow = pa.struct([*[(c, pa.int64()) for c in COUNTS], ("score", pa.float64())])

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = known.value
        if not dense:
            dense.append(np.zeros(1 << HASH_BITS))
            dense[0][m.weights.hashes.astype(np.int64)] = m.weights.values
        for batch in batches:
            rows = []
            for raw in batch.to_pylist():
                words = raw.split()
                h = word_hashes(words)
                f, v = buckets(raw, h)
                margin = m.weights.bias + float(dense[0][f.astype(np.int64)] @ v)
                rows.append((*base_counts(raw, words, h), float(sigmoid(m.slope * margin + m.offset))))
            columns = zip(*rows) if rows else [[] for _ in arrow]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow)]
            yield pa.StructArray.from_arrays(arrays, fields=list(arrow))

    return docs.withColumn(into, run(text_bytes(text_col)))


def base_failed(n_words, n_repeat_words):
    """The base rules: too short, or too much of it repeated."""
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)
