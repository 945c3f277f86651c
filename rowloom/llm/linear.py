"""FTRL-proximal logistic regression over hashed features, and its training sample.

The sample is bounded: at most ``rows`` labelled rows, the first by a hash of their id, so
their ids may be broadcast and their features fit one task. The weights that come back are
sparse (L1) and as bounded as the sample.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import quoted, text_bytes


@dataclass(frozen=True)
class Ftrl:
    """Per-coordinate rate ``alpha / (beta + sqrt(n))``, penalties and passes."""

    alpha: float = 0.1
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0
    epochs: int = 3
    min_rows: int = 3  # features of fewer sample rows get no weight


@dataclass(frozen=True)
class Weights:
    """Non-zero weights by ascending feature hash, and the bias."""

    bias: float
    hashes: np.ndarray
    values: np.ndarray


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], how: Ftrl) -> Weights:
    """Weights for rows of (distinct feature hashes, values), taken in the given order."""
    if not rows:
        return Weights(0.0, np.empty(0, np.uint64), np.empty(0))
    base = (sum(labels) + 1) / (len(labels) + 2)
    known, counts = np.unique(np.concatenate([f for f, _ in rows]), return_counts=True)
    known = known[counts >= how.min_rows]
    cols = []
    for f, v in rows:
        at = np.searchsorted(known, f)
        at[at == len(known)] = 0
        ok = known[at] == f if len(known) else np.zeros(len(f), bool)
        cols.append((at[ok], v[ok]))
    z, n = np.zeros(len(known)), np.zeros(len(known))
    bias, bias_n = float(np.log(base / (1 - base))), 0.0
    for _ in range(how.epochs):
        for (at, v), y in zip(cols, labels):
            zi, ni = z[at], n[at]
            rate = (how.beta + np.sqrt(ni)) / how.alpha
            w = np.where(np.abs(zi) <= how.l1, 0.0, (np.sign(zi) * how.l1 - zi) / (rate + how.l2))
            error = float(sigmoid(bias + w @ v)) - y
            g = error * v
            grown = ni + g * g
            z[at] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / how.alpha * w
            n[at] = grown
            bias_n += error * error
            bias -= how.alpha / (how.beta + bias_n**0.5) * error
    w = np.where(np.abs(z) <= how.l1, 0.0, (np.sign(z) * how.l1 - z) / ((how.beta + np.sqrt(n)) / how.alpha + how.l2))
    kept = w != 0
    return Weights(bias, known[kept], w[kept])


def sample_features(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    features: Callable[[bytes], tuple[np.ndarray, np.ndarray]],
    *,
    rows: int,
    may_learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``order``, ``label``, ``hashes``, ``values`` of at most ``rows`` labelled documents."""
    known = labels.select(quoted(id_col).alias("id"), quoted(label).cast("int").alias("label")).filter(
        F.col("id").isNotNull() & F.col("label").isNotNull()
    )
    if may_learn is not None:
        known = known.filter(may_learn)
    chosen = known.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for order, y, text in zip(*[c.to_pylist() for c in batch.columns]):
                f, v = features(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([order], pa.int64()),
                        pa.array([y], pa.int32()),
                        pa.array([f.view(np.int64)], pa.list_(pa.int64())),
                        pa.array([v], pa.list_(pa.float64())),
                    ],
                    names=["order", "label", "hashes", "values"],
                )

    texts = docs.select(quoted(id_col).alias("id"), text_bytes(text_col).alias("text"))
    return (
        texts.join(F.broadcast(chosen), "id")  # at most ``rows`` ids
        .select(F.xxhash64("id", "text").alias("order"), "label", "text")
        .mapInArrow(run, "order long, label int, hashes array<long>, values array<double>")
    )


def in_one_task(sample: DataFrame, learn: Callable[[list, list[int]], list[tuple[int, float]]]) -> list:
    """Run ``learn`` on the bounded sample in one task; its (key, value) rows come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for i in range(batch.num_rows):
                f = batch.column(2)[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                v = batch.column(3)[i].values.to_numpy(zero_copy_only=False)
                rows.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), f.copy(), v.copy()))
        rows.sort(key=lambda r: r[:2])
        keys, values = zip(*learn([(f, v) for _, _, f, v in rows], [y for _, y, _, _ in rows]))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(values, pa.float64())], names=["key", "value"])

    return sample.repartition(1).mapInArrow(run, "key long, value double").collect()
