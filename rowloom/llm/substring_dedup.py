"""Exact substring deduplication with sharded suffix arrays.

A byte is removed if a string of ``window`` bytes over it also starts anywhere else. Every
window is judged in the shard of its anchor: the least hashed ``gram`` bytes inside it, the
rightmost if several are equal. Equal windows have equal anchors, and each window has one, so
no repeat is lost or seen twice.

1. Each text is cut into contexts: the windows that share an anchor, as one stretch of bytes.
   Anchors found once in the corpus drop out; what is left of a text without repeats is
   nothing.
2. Equal contexts are counted: one found twice is covered whole. Of every different context
   under an anchor that has several, one copy's bytes are fetched.
3. Contexts are dealt by anchor. A task joins some megabytes of whole anchors into one string
   and builds its suffix array by induced sorting; permuted common prefixes of ``window`` bytes
   or more mark the repeated windows.
4. Marks go back to the texts over their contexts, and each text is cut once.

Very common anchors. Where more than ``group_limit`` different contexts share an anchor, their
windows are counted by 128-bit hash instead, with partial sums in the tasks; nothing is
capped. Joins on anchors have one row per anchor or context on one side, so the adaptive plan
splits the other. No side is forced to broadcast. What is collected by document is bounded by
its own length.

Edge cases: null and shorter texts have no windows and stay whole; repeated rows remove each
other; null ids are told apart by their texts; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import partitions, quoted, staged, text_bytes
from rowloom.llm.suffix_array import SEPARATOR, permuted_common_prefixes, suffix_array

WINDOW = 200
GRAM = 32  # a power of two
GROUP_LIMIT = 4096
SHARD_BYTES = 1 << 20
PIECE = 1 << 22  # window starts looked at together
MIX = np.uint64(0x9E3779B97F4A7C15)  # an odd factor


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all runs of ``gram`` bytes (a power of two), by doubling."""
    with np.errstate(over="ignore"):
        h = (raw.astype(np.uint64) + np.uint64(1)) * MIX
        h ^= h >> np.uint64(29)
        span = 1
        while span < gram:
            h = (h[:-span] * MIX) ^ (h[:-span] >> np.uint64(32)) + h[span:]
            span *= 2
        h = (h ^ (h >> np.uint64(31))) * MIX
        return h ^ (h >> np.uint64(30))


def contexts(raw: bytes, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hashes and, for each, the first and last start of its windows."""
    found = [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))]
    n = len(raw) - window + 1
    for base in range(0, max(n, 0), PIECE):
        part = np.frombuffer(raw, np.uint8)[base : base + min(PIECE, n - base) + window - 1]
        h = gram_hashes(part, gram)
        low = np.uint64(0xFFFFFFFF)
        key = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
        width, span, least = window - gram + 1, 1, key
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        count = len(part) - window + 1
        least = np.minimum(least[:count], least[width - span : width - span + count])
        at = (low - (least & low)).astype(np.int64)
        cut = np.flatnonzero(np.diff(at)) + 1
        lo, hi = np.r_[0, cut], np.r_[cut - 1, count - 1]
        found.append((h[at[lo]], lo + base, hi + base))
    return tuple(np.concatenate(x) for x in zip(*found))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``tie`` (a hash of the text; both together are a text's key) and ``text``."""
    text = text_bytes(text_col)
    return docs.select(quoted(id_col).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["id"].eqNullSafe(b["id"]) & (a["tie"] == b["tie"])


def _found(keyed: DataFrame, window: int, gram: int, *, anchors_only: bool) -> DataFrame:
    """One row per context: ``a`` (anchor), ``c`` (hash of its bytes), the text's key and the
    first and last start."""
    kind = keyed.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            ids, ties = batch.column(0), batch.column(1)
            rows, size = [], 0
            for i, raw in enumerate(batch.column(2).to_pylist()):
                a, lo, hi = contexts(raw, window, gram)
                if anchors_only:
                    rows.append((a,))
                elif len(a):
                    spans = zip(lo.tolist(), (hi + window).tolist())
                    c = np.fromiter((digest(raw[s:e]) for s, e in spans), np.uint64, len(a))
                    rows.append((a, c, np.full(len(a), i), lo, hi))
                size += len(a)
                if size > 1 << 16 or i == batch.num_rows - 1:
                    if size:
                        a, *rest = (np.concatenate(x) for x in zip(*rows))
                        columns = [pa.array(a.view(np.int64))]
                        if not anchors_only:
                            c, at, lo, hi = rest
                            at = pa.array(at)
                            columns += [pa.array(c.view(np.int64)), ids.take(at), ties.take(at), pa.array(lo), pa.array(hi)]
                        yield pa.RecordBatch.from_arrays(columns, names=["a", "c", "id", "tie", "lo", "hi"][: len(columns)])
                    rows, size = [], 0

    return keyed.mapInArrow(run, "a long" if anchors_only else f"a long, c long, id {kind}, tie long, lo long, hi long")


def shard_repeats(texts: list[bytes], window: int) -> list[list[tuple[int, int]]]:
    """For each text the stretches covered by windows found twice or more in all of them."""
    sizes = np.array([len(t) for t in texts])
    raw = np.frombuffer(bytes([SEPARATOR]).join(texts), np.uint8)
    order = suffix_array(raw)
    shared, before = permuted_common_prefixes(raw, order)
    repeated = np.zeros(len(raw) + 1, bool)
    ends = np.cumsum(sizes + 1) - 1
    own_end = np.repeat(ends, sizes + 1)[: len(raw)]
    at = np.flatnonzero((shared >= window) & (np.arange(len(raw)) + window <= own_end))
    repeated[at] = True
    repeated[before[at]] = True
    starts = np.flatnonzero(repeated)
    edges = np.zeros(len(raw) + 1, np.int64)
    edges[starts] += 1
    np.add.at(edges, starts + window, -1)
    covered = np.r_[False, np.cumsum(edges)[:-1] > 0, False]
    begin = np.flatnonzero(~covered[:-1] & covered[1:])
    stop = np.flatnonzero(covered[:-1] & ~covered[1:])
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    owner = np.searchsorted(ends, begin, "right")
    first = np.r_[0, ends[:-1] + 1]
    for k, s, e in zip(owner.tolist(), begin.tolist(), stop.tolist()):
        out[k].append((s - int(first[k]), e - int(first[k])))
    return out


SPANS = "a long, c long, starts array<long>, stops array<long>"


def _span_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * 4
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], names=["a", "c", "starts", "stops"]
    )


def _by_suffix_array(bodies: DataFrame, window: int, shard_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []
        size = 0

        def shard(rows):
            spans = shard_repeats([t for _, _, t in rows], window)
            return _span_rows([(a, c, [s for s, _ in x], [e for _, e in x]) for (a, c, _), x in zip(rows, spans) if x])

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if size >= shard_bytes and row[0] != held[-1][0]:
                    yield shard(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2]) + 1
        if held:
            yield shard(held)

    n = partitions(bodies.sparkSession)
    dealt = bodies.select("a", "c", "body").repartition(n, "a").sortWithinPartitions("a")
    return dealt.mapInArrow(run, SPANS)


def _by_window_counts(bodies: DataFrame, window: int) -> DataFrame:
    """The same for anchors with very many contexts: windows counted by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, c, body in zip(*[x.to_pylist() for x in batch.columns]):
                n = len(body) - window + 1
                raw = b"".join([xxhash.xxh3_128_digest(body[i : i + window]) for i in range(n)])
                w = np.frombuffer(raw, "<i8").reshape(n, 2)
                columns = [pa.array(np.full(n, a)), pa.array(np.full(n, c)), pa.array(np.arange(n))]
                columns += [pa.array(np.ascontiguousarray(w[:, i])) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "c", "at", "w1", "w2"])

    windows = bodies.select("a", "c", "body").mapInArrow(run, "a long, c long, at long, w1 long, w2 long")
    twice = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1").select("w1", "w2")
    starts = F.sort_array(F.collect_list("at"))
    return (
        windows.join(twice, ["w1", "w2"])
        .groupBy("a", "c")
        .agg(starts.alias("starts"))
        .select("a", "c", "starts", F.transform("starts", lambda s: s + window).alias("stops"))
    )


def _bodies(keyed: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """``wanted`` contexts (a, c, large and where their copy is) with their bytes."""
    asked = wanted.groupBy("id", "tie").agg(F.collect_list(F.struct("a", "c", "large", "lo", "hi")).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                columns = [[r[k] for r in rows] for k in ("a", "c", "large")]
                body = [raw[r["lo"] : r["hi"] + window] for r in rows]
                types = [pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip([*columns, body], types)], names=["a", "c", "large", "body"]
                )

    texts = keyed.join(asked, _same(keyed, asked)).select(keyed["text"], "asked")
    return texts.mapInArrow(run, "a long, c long, large boolean, body binary").dropDuplicates(["a", "c"])


def repeated_spans(
    docs: DataFrame,
    *,
    window: int = WINDOW,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_limit: int = GROUP_LIMIT,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``id``, ``tie`` and ``spans`` (start, stop; may overlap) of texts with repeated bytes."""
    keyed = _keyed(docs, id_col, text_col)
    anchors = _found(keyed, window, gram, anchors_only=True)
    again = staged(anchors.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").select("a"), "anchors")
    hits = staged(_found(keyed, window, gram, anchors_only=False).join(again, "a", "left_semi"), "contexts")

    place = F.struct("id", "tie", "lo", "hi")
    each = staged(hits.groupBy("a", "c").agg(F.count("*").alias("n"), F.min(place).alias("copy")), "distinct")
    # written, as the plans to come split a hot anchor only if both sides of a join are shuffled
    several = staged(each.groupBy("a").agg(F.count("*").alias("k")).filter("k > 1"), "several")
    wanted = each.join(several, "a").select("a", "c", (F.col("k") > group_limit).alias("large"), "copy.*")
    bodies = staged(_bodies(keyed, wanted, window), "bodies")
    marks = _by_suffix_array(bodies.filter("not large"), window, shard_bytes)
    large = bodies.filter("large")
    if not large.isEmpty():
        marks = marks.unionByName(_by_window_counts(large, window))
    marks = staged(marks, "marks")

    whole = F.struct(F.col("lo").alias("start"), (F.col("hi") + window).alias("stop"))
    twice = each.filter("n > 1").select("a", "c")
    full = hits.join(twice, ["a", "c"]).select("id", "tie", F.array(whole).alias("spans"))
    part = F.zip_with("starts", "stops", lambda s, e: F.struct((F.col("lo") + s).alias("start"), (F.col("lo") + e).alias("stop")))
    single = staged(each.filter("n = 1").select("a", "c").join(marks, ["a", "c"]), "single")
    some = hits.join(single, ["a", "c"]).select("id", "tie", part.alias("spans"))
    # repeats of one row give equal spans, of which each task and group keeps one
    return full.union(some).groupBy("id", "tie").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Touching and overlapping stretches as maximal ones."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.r_[True, starts[1:] > stops[:-1]]
    return starts[new], stops[np.r_[np.flatnonzero(new)[1:] - 1, len(stops) - 1]]


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: ``id``, ``n_bytes``, ``n_removed``, ``spans`` (removed, maximal) and ``kept``
    (the remaining bytes)."""
    keyed = _keyed(docs, id_col, text_col)
    found = staged(repeated_spans(docs, id_col=id_col, text_col=text_col, **options), "spans")
    kind = keyed.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw, spans in zip(batch.column(1).to_pylist(), batch.column(2)):
                if not spans.is_valid or not len(spans):
                    rows.append((len(raw), 0, [], raw))
                    continue
                s, e = merged(*(spans.values.field(k).to_numpy() for k in (0, 1)))
                cuts = list(zip(np.r_[0, e].tolist(), np.r_[s, len(raw)].tolist()))
                kept = b"".join([raw[i:j] for i, j in cuts])
                rows.append((len(raw), len(raw) - len(kept), np.stack([s, e], 1).tolist(), kept))
            types = [pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "n_bytes", "n_removed", "spans", "kept"])

    joined = keyed.join(found, _same(keyed, found), "left").select(keyed["id"], "text", "spans")
    return joined.mapInArrow(run, f"id {kind}, n_bytes long, n_removed long, spans array<array<long>>, kept binary")
