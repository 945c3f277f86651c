"""Toxicity by FTRL-proximal logistic regression over word n-grams and skip-grams.

Features of a text are the distinct hashes of its words (ASCII letters and digits and all
characters beyond ASCII; A-Z lowered), word pairs and pairs with one word between. Words count
as they stand and, for inflected forms, by their first bytes (``STEMS``). Each
coordinate has its own learning rate; L1 leaves some hundred weights, which are broadcast.
Texts are scored where they are read; nothing is shuffled.

Learning takes a bounded sample, the parameter ``rows``: that many labelled rows, first by a
hash of their id.

Edge cases: null and empty texts have no features and score the bias; without labels every
text scores 0.5; rows whose label is null teach nothing; repeated rows score alike; an empty
table gives an empty result; other columns are kept as they are,
except one named like ``into``, which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import fresh, quoted, text_bytes
from rowloom.llm.decontaminate import words_of
from rowloom.llm.linear import Ftrl, Weights, fit, in_one_task, sample_features, sigmoid

ROWS = 8000
STEMS = (4, 6)  # bytes of a longer word that count as a word of their own
THRESHOLD = 0.3
FTRL = Ftrl(alpha=0.5, beta=1.0, l1=5.0, l2=0.1, epochs=4)
PAIR, SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd factors


def grams(raw: bytes) -> np.ndarray:
    """Hashes of all words, stems, pairs and skip pairs of a text, repeats included."""
    digest = xxhash.xxh3_64_intdigest
    words = words_of(raw)
    h = np.fromiter(map(digest, words), np.uint64)
    stems = {w[:n] + b"-" for w in set(words) for n in STEMS if len(w) > n}
    short = np.fromiter(map(digest, stems), np.uint64)
    with np.errstate(over="ignore"):
        return np.concatenate([h, short, h[:-1] * PAIR + h[1:], h[:-2] * SKIP + (h[2:] ^ SKIP)])


def features(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    found = np.unique(grams(raw))
    return found, np.ones(len(found))


class Scorer:
    """Adds up the weights of a text's distinct features; a bit table skips the rest."""

    MASK = np.uint64((1 << 20) - 1)

    def __init__(self, weights: Weights):
        self.weights = weights
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(weights.hashes & self.MASK).astype(np.int64)] = True

    def margin(self, raw: bytes) -> float:
        w = self.weights
        h = grams(raw)
        h = np.unique(h[self.maybe[(h & self.MASK).astype(np.int64)]])
        if not len(h) or not len(w.hashes):
            return w.bias
        at = np.minimum(np.searchsorted(w.hashes, h), len(w.hashes) - 1)
        return w.bias + float(w.values[at][w.hashes[at] == h].sum())


def _learn(rows, labels) -> list[tuple[int, float]]:
    w = fit(rows, labels, FTRL)
    return [(0, w.bias), *zip(w.hashes.view(np.int64).tolist(), w.values.tolist())]


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    rows: int = ROWS,
    may_learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Weights:
    """Weights learned from labelled rows; ``may_learn`` is a condition on the label's ``id``."""
    sample = sample_features(
        docs, labels, label_col, features, rows=rows, may_learn=may_learn, id_col=id_col, text_col=text_col
    )
    (_, bias), *found = [(r.key, r.value) for r in in_one_task(sample, _learn)]
    hashes = np.array([k for k, _ in found], np.int64).view(np.uint64)
    return Weights(bias, hashes, np.array([v for _, v in found], np.float64))


def score(docs: DataFrame, weights: Weights, *, text_col: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in the column ``into``."""
    known = docs.sparkSession.sparkContext.broadcast(weights)  # bounded by the sample
    made: list[Scorer] = []

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if not made:
            made.append(Scorer(known.value))
        for batch in batches:
            yield pa.array([float(sigmoid(made[0].margin(t))) for t in batch.to_pylist()], pa.float64())

    return docs.withColumn(into, scores(text_bytes(text_col)))


def accepted(docs: DataFrame, weights: Weights, *, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``."""
    into = fresh(docs, "score")
    scored = score(docs, weights, text_col=text_col, into=into)
    return scored.filter(quoted(into) < threshold).select(*[quoted(c) for c in docs.columns])
