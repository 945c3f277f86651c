"""Packing documents into sequences by a configuration linear program over the length histogram.

``cut`` encodes whole texts where they are read (no text is shuffled), appends the end id and
cuts what is longer than a sequence into full pieces and a rest. ``pack`` places every piece:

* The histogram of lengths (at most one count per length) is all the driver sees.
* A configuration is a multiset of lengths that fits a sequence; the linear program covers the
  histogram by as few of them as possible. Multiplicative weights solve it: each round prices
  lengths by their weights, one knapsack dynamic program gives the best filling of every
  capacity, and hence for every length the best configuration that holds it. The round's
  answer is a mix of those within ``SLACK`` of the best; lengths that it covers too much get
  lighter, others heavier. Weights start where the program over classes of lengths ends.
* The averaged answer is rounded by running sums, dearest configurations first, and never
  beyond what the histogram has; this is done anew for what is left, and what then remains
  goes best-fit decreasing, on the histogram as well. The result is a table of configurations
  with copies: its size depends on the sequence length and the rounds, not on the documents.
* Pieces of one length are interchangeable: a piece's number among its length (a count within
  its task and a running sum over tasks) gives its sequence and offset by arithmetic.

The staged piece table holds no texts; joins are by (task, length), so a length that a third
of all pieces have is spread over all tasks.

Edge cases: null and empty texts hold only the end id; a repeated row is packed as often as it
stands; null ids are ids like others; texts are whole, however long; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm.common import quoted, staged, text_bytes
from rowloom.llm.pieces import encoder

LENGTH = 4096  # tokens of a sequence
PASSES = 3  # the program is solved anew for what rounding has left
ROUNDS = 12  # of multiplicative weights a pass
CLASSES, CLASS_ROUNDS = 128, 1000  # of the coarse program that gives the weights a start
SEEDS = 1024  # configurations a round's answer mixes, at most
SLACK = 0.03  # how far below the best price a configuration of the mix may be
RATE = 0.05  # how fast weights move

Configuration = tuple[tuple[int, int], ...]  # (length, times), longest first


def cut(
    docs: DataFrame,
    tokenizer_file: str,
    *,
    length: int = LENGTH,
    end_id: int = 1,
    tokens: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of at most ``length`` tokens: ``id``, ``piece``, ``start``, ``length``,
    ``ids_crc32``, with ``tokens`` also the ids as little-endian unsigned 32-bit integers, and
    for ``pack`` the task (``part``) and the number among its pieces of that length (``nth``)."""
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = f.read()
    known = docs.sparkSession.sparkContext.broadcast(spec)  # a tokenizer file
    end = np.array([end_id], "<u4").tobytes()
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            *([T.StructField("tokens", T.BinaryType())] if tokens else []),
            T.StructField("part", T.IntegerType()),
            T.StructField("nth", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, seen = encoder(known.value), TaskContext.get().partitionId(), [0] * (length + 1)
        for batch in batches:
            texts = batch.column(1)
            for lo in range(0, batch.num_rows, 128):
                rows: list[tuple] = []
                for i, ids in enumerate(own.encode(texts.slice(lo, 128).to_pylist())):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * length)):
                        some = ids[at : at + 4 * length]
                        n = len(some) // 4
                        rows.append((lo + i, piece, at // 4, n, zlib.crc32(some), some, seen[n]))
                        seen[n] += 1
                at, piece, start, size, crc, some, nth = zip(*rows)
                columns = [
                    batch.column(0).take(pa.array(at)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.array(crc, pa.int64()),
                    *([pa.array(some, pa.binary())] if tokens else []),
                    pa.array([part] * len(rows), pa.int32()),
                    pa.array(nth, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(quoted(id_col).alias("id"), text_bytes(text_col).alias("text")).mapInArrow(run, schema)


def fillings(prices: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack over all capacities: the best total price and the last length taken (0: leave
    the rest empty). ``prices[s]`` is the price of length ``s``, minus infinity for none."""
    top = len(prices) - 1
    best, last = np.zeros(top + 1), np.zeros(top + 1, np.int64)
    for c in range(1, top + 1):
        gain = prices[1 : c + 1] + best[c - 1 :: -1]
        s = int(gain.argmax())
        if gain[s] > best[c - 1]:
            best[c], last[c] = gain[s], s + 1
        else:
            best[c] = best[c - 1]
    return best, last


def _configuration(seed: int, last: list[int]) -> Configuration:
    """The best configuration that holds ``seed``."""
    times, room = {seed: 1}, len(last) - 1 - seed
    while room > 0:
        s = last[room]
        if s:
            times[s] = times.get(s, 0) + 1
            room -= s
        else:
            room -= 1
    return tuple(sorted(times.items(), reverse=True))


def cover(
    counts: np.ndarray, weight: np.ndarray, rounds: int
) -> tuple[dict[Configuration, float], np.ndarray]:
    """Multiplicative weights: configurations, how often each is used in a cover of ``counts``
    (``counts[s]`` pieces of length ``s``), and the prices of the lengths at the end, one for
    the best configuration. ``weight`` is where the weights start."""
    top = len(counts) - 1
    sizes = np.flatnonzero(counts)
    demand, lengths = counts.astype(float), np.arange(top + 1)
    per_round = (demand * lengths).sum() / top / rounds
    weight, covered = weight.copy(), np.zeros(top + 1)
    used: dict[Configuration, float] = {}
    for t in range(1, rounds + 1):
        prices = np.where(counts > 0, lengths / top * weight, -np.inf)
        best, last = fillings(prices)
        value = prices[sizes] + best[top - sizes]
        near = sizes[value >= (1 - SLACK) * best[top]]
        behind = np.maximum(demand[near] * t / rounds - covered[near], demand[near] / rounds / 4)
        # those furthest behind first
        order = np.argsort(-behind * near, kind="stable")[:SEEDS]
        mix: dict[Configuration, float] = {}
        last = last.tolist()
        for s, want in zip(near[order].tolist(), behind[order].tolist()):
            one = _configuration(s, last)
            mix[one] = max(mix.get(one, 0.0), want / dict(one)[s])
        scale = per_round / sum(mix.values())
        for one, x in mix.items():
            used[one] = used.get(one, 0.0) + x * scale
            for s, k in one:
                covered[s] += k * x * scale
        # what is covered beyond its share gets lighter, what is behind heavier
        off = covered[sizes] / (demand[sizes] * t / rounds) - 1
        weight[sizes] *= np.exp(-RATE * np.clip(off, -1, 1))
        weight[sizes] /= weight[sizes].mean()
    return used, prices / best[top]


def start_weights(counts: np.ndarray) -> np.ndarray:
    """Weights by length from the same program over ``CLASSES`` classes of lengths, where a
    round costs next to nothing and many bring the prices close to the dual solution."""
    top = len(counts) - 1
    if top <= CLASSES:
        return np.ones(top + 1)
    lengths = np.arange(top + 1)
    own = -(-lengths * CLASSES // top)
    coarse = np.bincount(own, counts, CLASSES + 1)
    coarse[0] = 0
    _, prices = cover(coarse, np.ones(CLASSES + 1), CLASS_ROUNDS)
    known = np.flatnonzero(coarse)
    at = np.interp(own, known, prices[known])
    return np.where(lengths > 0, at * top / np.maximum(lengths, 1), 1.0)


def rounded(
    counts: np.ndarray, used: dict[Configuration, float], prices: np.ndarray
) -> list[tuple[Configuration, int]]:
    """Whole copies of configurations, dearest first, using no piece twice; ``counts`` becomes
    what is left."""
    out: list[tuple[Configuration, int]] = []
    total, taken = 0.0, 0
    worth = {one: sum(prices[s] * k for s, k in one) for one in used}
    for one in sorted(used, key=lambda one: (-round(worth[one], 4), -sum(s * k for s, k in one), one)):
        total += used[one]
        copies = min(int(total) - taken, *(int(counts[s]) // k for s, k in one))
        if copies > 0:
            taken += copies
            out.append((one, copies))
            for s, k in one:
                counts[s] -= k * copies
    return out


def best_fit(counts: np.ndarray) -> list[tuple[Configuration, int]]:
    """Best-fit decreasing over the histogram: sequences of one content are one entry."""
    top = len(counts) - 1
    free: dict[int, list[tuple[Configuration, int]]] = {}
    for s in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[s])
        for room in sorted(r for r in free if r >= s):
            if not left:
                break
            per, entries = room // s, free.pop(room)
            while entries and left:
                one, copies = entries.pop()
                for k in (per, left % per):  # full ones, then a last one
                    some = min(copies, left // k) if k else 0
                    some = min(some, 1) if k < per else some
                    if some:
                        free.setdefault(room - k * s, []).append((one + ((s, k),), some))
                        copies, left = copies - some, left - some * k
                    if left >= per or k < per:
                        break
                if copies:
                    entries.append((one, copies))
            if entries:
                free.setdefault(room, []).extend(entries)
        for k in (top // s, left % (top // s)):
            if 0 < k <= left:
                free.setdefault(top - k * s, []).append((((s, k),), left // k))
                left -= left // k * k
    return [entry for room in sorted(free) for entry in free[room]]


def configurations(counts: np.ndarray) -> list[tuple[Configuration, int]]:
    """Configurations with copies that hold exactly the pieces of ``counts``."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[Configuration, int]] = []
    top = len(left) - 1
    if left[top]:
        out.append((((top, 1),), int(left[top])))
        left[top] = 0
    for _ in range(PASSES if left.any() else 0):
        some = rounded(left, *cover(left, start_weights(left), ROUNDS))
        out += some
        if not some or not left.any():
            break
    return out + best_fit(left)


def _places(plan: list[tuple[Configuration, int]]) -> np.ndarray:
    """Rows (length, first number, first sequence, times in a sequence, offset) in order."""
    rows, given, sequence = [], {}, 0
    for one, copies in plan:
        offset = 0
        for s, k in one:
            rows.append((s, given.get(s, 0), sequence, k, offset))
            given[s] = given.get(s, 0) + k * copies
            offset += s * k
        sequence += copies
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, *, length: int = LENGTH) -> DataFrame:
    """``pieces`` as from ``cut``, without ``part`` and ``nth`` and with ``sequence_id`` and
    ``offset``."""
    kept = staged(pieces, "pieces")
    counts = staged(kept.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    histogram = np.zeros(length + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row per length
        histogram[r.length] = r.n
    places = _places(configurations(histogram))
    # one sorted number for (length, first number)
    keys, table = places[:, 0] << 48 | places[:, 1], places
    known = kept.sparkSession.sparkContext.broadcast((keys, table))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    sums = counts.select(F.col("part").alias("p"), F.col("length").alias("l"), before.alias("before"))
    numbered = kept.join(sums, (F.col("part") == F.col("p")) & (F.col("length") == F.col("l")))
    columns = [c for c in kept.columns if c not in ("part", "nth")]
    numbered = numbered.select(*columns, (F.col("before") + F.col("nth")).alias("number"))
    schema = T.StructType(
        [
            *[kept.schema[c] for c in columns],
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, table = known.value
        for batch in batches:
            size, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            row = np.searchsorted(keys, size << 48 | number, "right") - 1
            _, first, sequence, times, offset = table[row].T
            nth = number - first
            own = [pa.array(sequence + nth // times), pa.array(offset + nth % times * size)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *own], names=schema.names)

    return numbered.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from pieces cut with ``tokens``: ``sequence_id`` and the ids
    of its pieces in turn. A group holds one sequence, so its size is bounded."""
    whole = F.array_sort(F.collect_list(F.struct("offset", "tokens")))
    joined = F.reduce(whole, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["tokens"]))
    return packed.groupBy("sequence_id").agg(joined.alias("tokens"))
