"""Language-model scoring: a Katz backoff model of any order, counted on the whole training part.

Tokens are a text's words (A-Z lowered) and one end. For a history ``h`` (up to ``order - 1``
tokens, fewer at the start, which is a token of its own) and a word ``w`` with counts ``c``

    P(w | h) = d(c(hw)) c(hw) / c(h)   if c(hw) > 0,   else   a(h) P(w | h without its first token),
    P(w)     = d1(c(w)) c(w) / N       if c(w) > 0,    else   what is left for unknown words,

``d`` (one per order) and ``d1`` being Good-Turing discounts of counts up to ``GT_MAX``. ``a(h)``
is the mass left by the seen words of ``h`` over the lower order's mass of all others, from sums
over every seen word, so each history sums to one. A history that leaves nothing (no small count)
is divided by ``c(h) + 1`` instead; a history never seen backs off whole.

Layout. Documents are gathered into chunks (about a million tokens of one task) and counted
there first. A chunk sends each bucket of words its sorted distinct words and counts as packed
arrays; the bucket sums them and answers every chunk with the words' numbers and counts. Then
the same for pairs, triples and so on, level by level: a gram is its history's number, which the
level below has answered, and a word's. It is sent with the lower order's probability of its
word, which the answers of the levels below give by the recursion above. Buckets hold whole
histories, so they can sum up followers; histories with more than ``1 / (4 buckets)`` of all
tokens are split over all buckets by gram, and their sums, added up by Spark, reach the driver
(at most ``4 buckets`` histories a level). A chunk asks for each of its grams once, however often
it stands there, so no hot word or text makes a hot group. Counts of each level are kept as a
table partitioned by kind and bucket. Chunks are kept in a table bucketed by chunk, so answers
come back to them without moving texts again. The number of buckets grows with the counted
tokens, so a bucket, which one task holds at a time, stays of one size as the input grows.

Edge cases: null and empty texts are the end alone; a null id is never held out; without
training rows every word is unknown and has probability one; a very long text is one chunk;
repeated rows are counted and scored one by one; only the id and text columns are read, so
others may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import partitions, quoted, scratch, text_bytes

CHUNK_TOKENS = 1 << 20
BUCKET_TOKENS = 1 << 22  # tokens a bucket, about
GT_MAX = 5
END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))  # no word holds white space
MIX = np.uint64(0x9E3779B97F4A7C15)  # an odd factor
CHUNKS = "chunk long, ids array<{}>, held array<boolean>, lengths array<int>, tokens binary, words binary, counts binary"
ANSWERS = "kind string, chunk long, bucket int, a binary, b binary, c binary, d binary"


def pack(values: np.ndarray) -> bytes:
    """Whole numbers or doubles as byte planes under zstandard."""
    values = np.ascontiguousarray(values)
    kind, wide = ("f", values.astype("<f8")) if values.dtype.kind == "f" else ("i", values.astype("<i8"))
    if kind == "i" and len(wide) and 0 <= wide.min() and wide.max() < 1 << 32:
        kind, wide = "u", wide.astype("<u4")
    planes = np.ascontiguousarray(wide.view(np.uint8).reshape(len(wide), wide.itemsize).T)
    return kind.encode() + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(raw: bytes) -> np.ndarray:
    kind = {"f": "<f8", "i": "<i8", "u": "<u4"}[raw[:1].decode()]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8)
    size = np.dtype(kind).itemsize
    out = np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel()
    return out.astype(np.int64) if kind == "<u4" else out


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=values.dtype.type(0)).view(np.int64))


def unpack_sorted(raw: bytes) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumsum(unpack(raw))


def good_turing(n: np.ndarray, top: int = GT_MAX) -> np.ndarray:
    """Discount factors of counts 0 to ``top`` (1 beyond) from the numbers ``n[r]`` of types
    seen ``r`` times. Katz's form, with the largest cut-off that gives factors between 0 and
    1; if none does, half a count is taken off singletons."""
    for k in range(top, 0, -1):
        if n[1] == 0 or any(n[r] == 0 for r in range(1, k + 2)):
            continue
        share = (k + 1) * n[k + 1] / n[1]
        d = np.ones(top + 1)
        for r in range(1, k + 1):
            d[r] = ((r + 1) * n[r + 1] / (r * n[r]) - share) / (1 - share) if share != 1 else 2.0
        if (d[1 : k + 1] > 0).all() and (d[1 : k + 1] < 1).all():
            return d
    d = np.ones(top + 1)
    d[1] = 0.5
    return d


@dataclass
class Unigrams:
    """Totals of the training part: tokens, types, documents, discounts, first word number of
    each bucket, and the probability of an unknown word."""

    tokens: int
    types: int
    docs: int
    discounts: np.ndarray
    unknown: float
    scale: float
    starts: np.ndarray

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.discounts[np.minimum(c, GT_MAX) * (c <= GT_MAX)] * c * self.scale, self.unknown)


@dataclass
class Grams:
    """Totals of one level: discounts, first gram number of each bucket, sums of split histories."""

    discounts: np.ndarray
    starts: np.ndarray
    hot: dict[int, tuple[np.ndarray, float]]


def _factor(d: np.ndarray, c: np.ndarray) -> np.ndarray:
    return d[np.where(c <= GT_MAX, c, 0)]


def unigrams(n: np.ndarray, tokens: int, types: int, docs: int, starts: np.ndarray) -> Unigrams:
    d = good_turing(n)
    d[0] = 1.0
    left = float(sum((1 - d[r]) * r * n[r] for r in range(1, GT_MAX + 1)))
    if tokens == 0:
        unknown, scale = 1.0, 0.0
    elif left > 0:
        unknown, scale = left / tokens, 1 / tokens
    else:
        unknown, scale = 1 / (tokens + 1), 1 / (tokens + 1)
    return Unigrams(tokens, types, docs, d, unknown, scale, starts)


def left_mass(n: np.ndarray, seen: np.ndarray, history: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Backoff weights and denominators of histories, from their numbers of followers seen
    once, twice, ... (rows of ``n``), the followers' lower-order mass, and their counts."""
    taken = ((1 - d[1 : GT_MAX + 1]) * np.arange(1, GT_MAX + 1) * n).sum(1)
    none = ~(n[:, : GT_MAX] * (d[1 : GT_MAX + 1] < 1)).any(1)
    below = np.where(none, history + 1.0, history)
    return np.where(none, 1.0, taken) / below / (1 - seen), below


def tokens_of(raw: bytes) -> np.ndarray:
    words = raw.lower().split()
    h = np.empty(len(words) + 1, np.uint64)
    h[:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    h[-1] = END
    return h


def _chunked(docs: DataFrame, held: Column, id_col: str, text_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, out_type = TaskContext.get().partitionId(), 0, None
        ids, folds, found, total = [], [], [], 0

        def chunk() -> pa.RecordBatch:
            lengths = np.array([len(f) for f in found])
            words, local = np.unique(np.concatenate(found), return_inverse=True)
            learned = np.repeat(~np.array(folds, bool), lengths)
            counts = np.bincount(local[learned], minlength=len(words))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part << 32 | seq]),
                    pa.array([ids], pa.list_(out_type)),
                    pa.array([folds], pa.list_(pa.bool_())),
                    pa.array([lengths], pa.list_(pa.int32())),
                    pa.array([pack(local)], pa.binary()),
                    pa.array([pack_sorted(words)], pa.binary()),
                    pa.array([pack(counts)], pa.binary()),
                ],
                names=["chunk", "ids", "held", "lengths", "tokens", "words", "counts"],
            )

        for batch in batches:
            out_type = batch.schema.field(0).type
            for key, fold, raw in zip(*[c.to_pylist() for c in batch.columns]):
                ids.append(key)
                folds.append(fold)
                found.append(tokens_of(raw))
                total += len(found[-1])
                if total >= CHUNK_TOKENS:
                    yield chunk()
                    seq += 1
                    ids, folds, found, total = [], [], [], 0
        if ids:
            yield chunk()

    source = docs.select(quoted(id_col).alias("id"), F.coalesce(held, F.lit(False)), text_bytes(text_col))
    return source.mapInArrow(run, CHUNKS.format(kind))


def _rows(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


ANSWER_NAMES = ["kind", "chunk", "bucket", "a", "b", "c", "d"]
ANSWER_TYPES = [pa.string(), pa.int64(), pa.int32(), *[pa.binary()] * 4]


def word_bucket(words: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets in the order of the words."""
    return ((words >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _count_words(chunks: DataFrame, buckets: int) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, words, counts in zip(*[c.to_pylist() for c in batch.columns]):
                w, n = unpack_sorted(words).view(np.uint64), unpack(counts)
                cuts = np.searchsorted(word_bucket(w, buckets), np.arange(buckets + 1))
                rows = [
                    (b, chunk, pack_sorted(w[i:j]), pack(n[i:j])) for b, (i, j) in enumerate(zip(cuts, cuts[1:])) if j > i
                ]
                yield _rows(rows, ["bucket", "chunk", "words", "counts"], [pa.int32(), pa.int64(), pa.binary(), pa.binary()])

    def add(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        sent = [(c, unpack_sorted(w), unpack(n)) for c, w, n in zip(*[table[x].to_pylist() for x in ("chunk", "words", "counts")])]
        words, back = np.unique(np.concatenate([w for _, w, _ in sent]).view(np.uint64), return_inverse=True)
        total = np.bincount(back, np.concatenate([n for _, _, n in sent]), len(words)).astype(np.int64)
        known = total > 0
        number = np.where(known, np.cumsum(known) - 1, -1)
        kept = total[known]
        tally = np.bincount(np.minimum(kept, GT_MAX + 2), minlength=GT_MAX + 3)
        rows = [
            ("words", None, bucket, pack_sorted(words[known]), pack(kept), None, None),
            ("tally", None, bucket, pack(np.r_[tally, kept.sum(), known.sum()]), None, None, None),
        ]
        at = 0
        for chunk, w, _ in sent:
            own = back[at : at + len(w)]
            rows.append(("answer", chunk, bucket, pack(number[own] + 1), pack(total[own]), None, None))
            at += len(w)
        return pa.Table.from_batches([_rows(rows, ANSWER_NAMES, ANSWER_TYPES)])

    sent = chunks.select("chunk", "words", "counts").mapInArrow(send, "bucket int, chunk long, words binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(add, ANSWERS)


class Chunk:
    """A chunk's tokens with their probability and gram at one level, and its distinct grams of
    the next: level one at first, one more with each ``extend`` and its answers.

    ``told`` are the answers of all levels so far, as (level, bucket, four packed columns).
    """

    def __init__(self, row: dict, told: list[tuple], uni: Unigrams, levels: list[Grams], buckets: int):
        self.uni, self.buckets = uni, buckets
        self.lengths = np.array(row["lengths"], np.int64)
        self.held = np.array(row["held"], bool)
        self.first = np.cumsum(self.lengths) - self.lengths
        numbers, counts = [], []
        for bucket, a, b, *_ in sorted(t[1:4] for t in told if t[0] == 1):
            number = unpack(a) - 1
            numbers.append(np.where(number >= 0, number + uni.starts[bucket], -1))
            counts.append(unpack(b))
        words = unpack(row["tokens"])
        self.node = np.concatenate(numbers)[words]  # the gram that ends at each token, if seen
        self.count = np.concatenate(counts)[words]
        self.word = np.where(self.node >= 0, self.node, uni.types)
        self.word_count, self.p = self.count, uni.p(self.count)
        self.level = 1
        for level, grams in enumerate(levels, 2):
            self.extend()
            self._answered(grams, [t[1:] for t in told if t[0] == level])

    def extend(self) -> None:
        """The distinct grams one token longer: history, word, and what is known of both."""
        history, below = np.roll(self.node, 1), np.roll(self.count, 1)
        history[self.first] = self.uni.types if self.level == 1 else -1  # the start, a word's number no other has
        below[self.first] = self.uni.docs if self.level == 1 else 0
        every, short = np.unique(history, return_inverse=True)
        _, at, self.gram = np.unique(short * (self.uni.types + 1) + self.word, return_index=True, return_inverse=True)
        learned = np.repeat(~self.held, self.lengths)
        self.times = np.bincount(self.gram[learned], minlength=len(at))
        self.h, self.w, self.h_count, self.at = history[at], self.word[at], below[at], at
        self.hot = self.h_count * 4 * self.buckets > self.uni.tokens
        with np.errstate(over="ignore"):
            mixed = self.h.astype(np.uint64) * MIX
            spread = (mixed ^ (mixed >> np.uint64(31)) ^ self.w.astype(np.uint64)) * MIX
        bucket = np.where(self.hot, spread >> np.uint64(33), mixed >> np.uint64(33)).astype(np.int64) % self.buckets
        asked = np.flatnonzero(self.h_count > 0)
        order = asked[np.argsort(bucket[asked], kind="stable")]
        found, cuts = np.unique(bucket[order], return_index=True)
        self.sent = dict(zip(found.tolist(), np.split(order, cuts[1:])))
        self.level += 1

    def lower(self) -> np.ndarray:
        """What gives the lower order's probability of each gram's word: short counts where
        they do, else the probability."""
        return self.word_count[self.at] if self.level == 2 else self.p[self.at]

    def _answered(self, grams: Grams, told: list[tuple]) -> None:
        size = len(self.h)
        times, node = np.zeros(size, np.int64), np.full(size, -1)
        weight, below = np.ones(size), np.ones(size)
        for bucket, x, y, z, numbers in told:
            at = self.sent[bucket]
            times[at] = unpack(x)
            if numbers is not None:
                number = unpack(numbers) - 1
                node[at] = np.where(number >= 0, number + grams.starts[bucket], -1)
            cold = at[~self.hot[at]]
            every, own = np.unique(self.h[cold], return_inverse=True)
            history = np.zeros(len(every))
            history[own] = self.h_count[cold]
            a, b = left_mass(unpack(y).reshape(len(every), GT_MAX), unpack(z), history, grams.discounts)
            weight[cold], below[cold] = a[own], b[own]
        hot = np.flatnonzero(self.hot & (self.h_count > 0))
        for h in np.unique(self.h[hot]).tolist():
            at = hot[self.h[hot] == h]
            n, mass = grams.hot.get(h, (np.zeros(GT_MAX), 0.0))
            a, b = left_mass(n[None], np.array([mass]), self.h_count[at[:1]], grams.discounts)
            weight[at], below[at] = a[0], b[0]
        p = np.where(times > 0, _factor(grams.discounts, times) * times / below, weight * self.p[self.at])
        # tokens after an unseen history keep their own lower probability
        self.p = np.where(self.h_count[self.gram] > 0, p[self.gram], self.p)
        self.node, self.count = node[self.gram], times[self.gram]


TOLD = ["level", "bucket", "a", "b", "c", "d"]


def _told(frame: pa.Table) -> list[tuple]:
    return list(zip(*[frame[x].to_pylist() for x in TOLD]))


def _count_grams(
    chunks: DataFrame, answers: DataFrame, uni: Unigrams, levels: list[Grams], buckets: int, last: bool
) -> DataFrame:
    """Counts of the level above ``levels``; grams are numbered unless it is the last."""
    words_below = not levels  # the level below is that of words: counts stand for probabilities

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        out, told = [], _told(right)
        for row in left.to_pylist():
            c = Chunk(row, told, uni, levels, buckets)
            c.extend()
            lower = c.lower()
            for bucket, at in c.sent.items():
                grams = pack(np.diff(c.h[at], prepend=0)), pack(c.w[at]), pack(c.times[at] * 2 + c.hot[at]), pack(lower[at])
                out.append((bucket, row["chunk"], *grams))
        names = ["bucket", "chunk", "h", "w", "times", "lower"]
        pa.default_memory_pool().release_unused()
        return pa.Table.from_batches([_rows(out, names, [pa.int32(), pa.int64(), *[pa.binary()] * 4])])

    def add(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        sent = list(zip(*[table[x].to_pylist() for x in ("chunk", "h", "w", "times", "lower")]))
        h = np.concatenate([np.cumsum(unpack(s[1])) for s in sent])
        w, times, lower = (np.concatenate([unpack(s[i]) for s in sent]) for i in (2, 3, 4))
        hot, times = times % 2 == 1, times // 2
        order = np.lexsort((w, h)).astype(np.int32 if len(h) < 1 << 31 else np.int64)
        new = np.r_[True, (np.diff(h[order]) != 0) | (np.diff(w[order]) != 0)]
        group = np.cumsum(new) - 1
        total = np.bincount(group, times[order], group[-1] + 1).astype(np.int64)
        seen = total > 0
        answer = np.empty(len(h), np.int64)
        answer[order] = total[group]
        if not last:
            number = np.empty(len(h), np.int64)
            number[order] = np.where(seen, np.cumsum(seen), 0)[group]
        first = order[new]
        del order, new, group, times
        types_h, types_w, types_c = h[first][seen], w[first][seen], total[seen]
        tally = np.bincount(np.minimum(types_c, GT_MAX + 2), minlength=GT_MAX + 3)
        rows = [
            ("grams", None, bucket, pack(np.diff(types_h, prepend=0)), pack(types_w), pack(types_c), None),
            ("tally", None, bucket, pack(np.r_[tally, len(types_c)]), None, None, None),
        ]
        every, at = np.unique(h, return_inverse=True)
        mine = at[first][seen]
        below = lower[first][seen]
        n = np.stack([np.bincount(mine[types_c == r], minlength=len(every)) for r in range(1, GT_MAX + 1)], 1)
        mass = np.bincount(mine, uni.p(below) if words_below else below, len(every))
        is_hot = np.zeros(len(every), bool)
        is_hot[at[hot]] = True
        if is_hot.any():
            rows.append(("hot", None, bucket, pack(every[is_hot]), pack(n[is_hot].ravel()), pack(mass[is_hot]), None))
        lo = 0
        for chunk, *packed in sent:
            hi = lo + len(unpack(packed[0]))
            own = np.unique(at[lo:hi][~hot[lo:hi]])  # its whole histories, in order
            numbers = None if last else pack(number[lo:hi])
            rows.append(("answer", chunk, bucket, pack(answer[lo:hi]), pack(n[own].ravel()), pack(mass[own]), numbers))
            lo = hi
        pa.default_memory_pool().release_unused()
        return pa.Table.from_batches([_rows(rows, ANSWER_NAMES, ANSWER_TYPES)])

    sent = (
        chunks.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(send, "bucket int, chunk long, h binary, w binary, times binary, lower binary")
    )
    return sent.groupBy("bucket").applyInArrow(add, ANSWERS)


def _score(
    chunks: DataFrame, answers: DataFrame, uni: Unigrams, levels: list[Grams], buckets: int, id_type: str
) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        told = _told(right)
        batches = []
        for row in left.to_pylist():
            c = Chunk(row, told, uni, levels, buckets)
            known = c.word_count
            base = np.log10((known + 0.5) / (uni.tokens + 0.5 * (uni.types + 1)))
            sums = [np.add.reduceat(x, c.first) for x in ((known > 0).astype(np.int64), base, np.log10(c.p))]
            kind = left["ids"].chunk(0).type.value_type
            batches.append(
                pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], kind), pa.array(c.held), pa.array(c.lengths), *map(pa.array, sums)],
                    names=["id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )
            )
        pa.default_memory_pool().release_unused()
        return pa.Table.from_batches(batches)

    schema = f"id {id_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)


def _tallies(rows: DataFrame, width: int, buckets: int) -> np.ndarray:
    """The numbers each bucket tells the driver, a row per bucket."""
    out = np.zeros((buckets, width), np.int64)
    for r in rows.filter("kind = 'tally'").select("bucket", "a").collect():
        out[r.bucket] = unpack(bytes(r.a))
    return out


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _hot_sums(rows: DataFrame) -> dict[int, tuple[np.ndarray, float]]:
    """Sums of the histories that were split, over all buckets."""
    n = [f"n{r}" for r in range(1, GT_MAX + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, c in zip(*[x.to_pylist() for x in batch.columns]):
                h = unpack(a)
                parts = unpack(b).reshape(len(h), GT_MAX).astype(float).T
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h, *parts, unpack(c))], names=["h", *n, "mass"])

    schema = ", ".join(["h long", *[f"{x} double" for x in n], "mass double"])
    found = rows.filter("kind = 'hot'").select("a", "b", "c").mapInArrow(run, schema)
    sums = found.groupBy("h").agg(*[F.sum(x).alias(x) for x in (*n, "mass")])
    return {r.h: (np.array([r[x] for x in n]), r.mass) for r in sums.collect()}


def _answers(rows: DataFrame, level: int) -> DataFrame:
    return rows.filter("kind = 'answer'").select("chunk", F.lit(level).alias("level"), *TOLD[1:])


def score(
    docs: DataFrame,
    held: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = 2,
    path: str | None = None,
) -> DataFrame:
    """Per row: ``id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score``. Rows for which ``held`` holds teach nothing. The model's tables
    stay below ``path`` (default: shared scratch); each level of ``order`` adds one."""
    if order < 1:
        raise ValueError("the order is at least one")
    spark = docs.sparkSession
    path = path or scratch(spark, "katz")
    name = f"katz_{uuid.uuid4().hex}"
    id_type = docs.schema[id_col].dataType.simpleString()
    made = _chunked(docs, held, id_col, text_col)
    made.write.option("path", f"{path}/chunks").bucketBy(partitions(spark), "chunk").saveAsTable(name)
    try:
        chunks = spark.table(name)
        total, n_docs = chunks.select(
            F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda x, y: x + y)), F.lit(0)),
            F.coalesce(F.sum(F.size(F.filter("held", lambda x: ~x))), F.lit(0)),
        ).first()
        buckets = max(2 * partitions(spark), -(-total // BUCKET_TOKENS))
        _count_words(chunks, buckets).write.partitionBy("kind").parquet(f"{path}/words")
        words = spark.read.schema(ANSWERS).parquet(f"{path}/words")
        told = _tallies(words, GT_MAX + 5, buckets)
        *n, tokens, types = told.sum(0).tolist()
        uni = unigrams(np.array(n), tokens, types, n_docs, _starts(told[:, -1]))

        texts = chunks.select("chunk", "ids", "held", "lengths", "tokens")
        answers, levels = _answers(words, 1), []
        for level in range(2, order + 1):
            counted = _count_grams(texts.drop("ids"), answers, uni, list(levels), buckets, level == order)
            counted.write.partitionBy("kind").parquet(f"{path}/grams{level}")
            grams = spark.read.schema(ANSWERS).parquet(f"{path}/grams{level}")
            told = _tallies(grams, GT_MAX + 4, buckets)
            discounts = good_turing(told[:, :-1].sum(0))
            discounts[0] = 1.0
            levels.append(Grams(discounts, _starts(told[:, -1]), _hot_sums(grams)))
            answers = answers.unionByName(_answers(grams, level))
        _score(texts, answers, uni, levels, buckets, id_type).write.parquet(f"{path}/scores")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.parquet(f"{path}/scores").withColumn("train_tokens", F.lit(uni.tokens).cast("long"))
