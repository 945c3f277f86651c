"""SimHash near-duplicates found by deletion-variant signatures.

A document's fingerprint is the bitwise majority of the XXH64 hashes (seed 42) of its word
shingles. Documents whose fingerprints differ in few bits are linked; classes are the
connected components.

Method. With ``d`` bits allowed to differ, the bits are cut into ``d // 2 + 1`` segments, so
that in one of them at most one bit differs. Each fingerprint is indexed under every segment
with every single bit of it left out (a variant per bit); two such fingerprints share a
variant, are brought together by its key and compared in full. Only distinct
fingerprints are compared, so copies cost nothing. Inside a key, members are joined to the
smallest member of their component instead of emitting all pairs: at most one link each.

Large groups. A group beyond ``group_limit`` fingerprints is not compared but indexed again:
of the bits outside its segment, cut into ``d + 1`` parts, one part must be equal, so it goes
on under (variant, part, value). A group that is still beyond the limit there is dealt into
blocks by hash, and every pair of blocks is a group of its own, so no task holds more than
about two blocks. Classes are joined by alternating star steps over link tables in shared
scratch. Nothing is collected.

``one_of_each`` keeps one document of each class.

Edge cases: null and empty texts have fingerprint zero, linked like any other; very long
texts are read whole, some thousand shingles at a time; fewer words than a shingle make one
shingle of what there is; repeated rows fall into one class; null ids never name a class
unless it has no other id; other columns are ignored (``one_of_each`` returns them as they
are, whatever their names); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import discard, fresh, partitions, quoted, scratch, staged, text_bytes

SEED = 42  # fixed value of the hash
SIZE = 64  # bits of a fingerprint
CHUNK = 1 << 16  # shingles summed at once
BLOCK = 512  # rows of a comparison block


@dataclass(frozen=True)
class Plan:
    """How to fingerprint and compare: words of a shingle, bits that may differ, segments, and
    the largest group compared at once."""

    shingle: int = 4
    bits: int = 4
    n_segments: int = 3
    group_limit: int = 4096

    @property
    def segments(self) -> list[tuple[int, int]]:
        """(first bit, bits) of each segment."""
        cuts = [SIZE * i // self.n_segments for i in range(self.n_segments + 1)]
        return [(a, b - a) for a, b in zip(cuts, cuts[1:])]

    @property
    def width(self) -> int:
        return max(w for _, w in self.segments)


NARROW = Plan()


def fingerprint(raw: bytes, plan: Plan = NARROW) -> bytes:
    """The fingerprint of a UTF-8 text, highest bit first."""
    words = raw.lower().split()
    if not words:
        return bytes(SIZE // 8)
    joined = b" ".join(words)
    n = max(len(words) - plan.shingle + 1, 1)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(size)
    starts = (ends - size)[:n].tolist()
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_digest
    counts = np.zeros(SIZE, np.int64)
    for lo in range(0, n, CHUNK):
        spans = zip(starts[lo : lo + CHUNK], stops[lo : lo + CHUNK])
        hashes = np.frombuffer(b"".join([digest(joined[i:j], SEED) for i, j in spans]), np.uint8)
        counts += np.unpackbits(hashes.reshape(-1, SIZE // 8), axis=1).sum(0, dtype=np.int64)
    return np.packbits(counts * 2 > n).tobytes()


def signatures(
    docs: DataFrame, plan: Plan = NARROW, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id``, ``fp`` (the fingerprint's bytes) and ``tie`` (a hash of the text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(t, plan) for t in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), found, batch.column(1)], names=["id", "fp", "tie"])

    text = text_bytes(text_col)
    source = docs.select(quoted(id_col).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    return source.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, fp binary, tie long")


def _numbers(column: pa.Array) -> np.ndarray:
    """Fingerprints as unsigned numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").astype(np.uint64)


def _column(fps: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(fps.astype(">u8"))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(SIZE // 8), len(raw), [None, pa.py_buffer(raw)]).cast(pa.binary())


def _bits(fps: np.ndarray) -> np.ndarray:
    """Bits of fingerprints, highest first, a row each."""
    return np.unpackbits(np.ascontiguousarray(fps.astype(">u8")).view(np.uint8).reshape(len(fps), -1), axis=1)


def _number(bits: np.ndarray) -> np.ndarray:
    """Each row of bits as a number."""
    return bits.astype(np.int64) @ (1 << np.arange(bits.shape[1] - 1, -1, -1, dtype=np.int64))


def variants(fps: np.ndarray, plan: Plan) -> np.ndarray:
    """Keys of all one-wildcard variants: a row per bit left out, a column per fingerprint.
    A key holds the bit's number above the segment with that bit cleared."""
    bits, keys = _bits(fps), np.empty((SIZE, len(fps)), np.int64)
    for first, width in plan.segments:
        value = _number(bits[:, first : first + width])
        for b in range(width):
            cleared = value & ~np.int64(1 << (width - 1 - b))
            keys[first + b] = np.int64((first + b) << plan.width) | cleared
    return keys


def parts_outside(fps: np.ndarray, bit: int, plan: Plan) -> list[np.ndarray]:
    """Values of ``bits + 1`` parts of the bits outside the segment of ``bit``; one part is
    equal for two fingerprints that are close enough."""
    first, width = next(s for s in plan.segments if s[0] <= bit < s[0] + s[1])
    outside = np.delete(_bits(fps), np.s_[first : first + width], axis=1)
    return [_number(part) for part in np.array_split(outside, plan.bits + 1, axis=1)]


def _close(a: np.ndarray, b: np.ndarray, plan: Plan) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= plan.bits


def group_links(fps: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Links joining each member of one group to the least member of its component."""
    label, step = np.arange(len(fps)), 1 << 13
    while True:
        least = label.copy()
        for lo in range(0, len(fps), BLOCK):
            for at in range(0, len(fps), step):
                near = _close(fps[lo : lo + BLOCK, None], fps[None, at : at + step], plan)
                found = np.where(near, label[None, at : at + step], len(fps)).min(1)
                np.minimum(least[lo : lo + BLOCK], found, out=least[lo : lo + BLOCK])
        np.minimum.at(least, label, least.copy())
        least = least[least]
        if (least == label).all():
            break
        label = least
    moved = label != np.arange(len(fps))
    return fps[moved], fps[label[moved]]


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return cuts, np.diff(np.r_[cuts, len(keys)])


def sorted_links(
    batches: Iterator[tuple[np.ndarray, np.ndarray]], plan: Plan, limit: int | None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Links (u, v, -1) within equal keys of batches sorted by key; members of a group of more
    than ``limit`` come out uncompared, as (fp, fp, key)."""
    held_k, held_f = np.empty(0, np.int64), np.empty(0, np.uint64)
    passing: int | None = None  # the key of a large group whose members go through
    few = 32 if limit is None else min(32, limit)

    def finish(keys, fps):
        cuts, sizes = _runs(keys)
        some = np.repeat((sizes > 1) & (sizes <= few), sizes)
        k, f = keys[some], fps[some]
        for step in range(1, int(sizes[(sizes > 1) & (sizes <= few)].max(initial=1))):
            hit = np.flatnonzero(k[step:] == k[:-step])
            hit = hit[_close(f[hit + step], f[hit], plan)]
            yield f[hit + step], f[hit], np.full(len(hit), -1)
        for cut, size in zip(cuts[sizes > few], sizes[sizes > few]):
            own = fps[cut : cut + size]
            if limit is not None and size > limit:
                yield own, own, keys[cut : cut + size]
            else:
                u, v = group_links(own, plan)
                yield u, v, np.full(len(u), -1)

    for keys, fps in batches:
        if passing is not None:
            n = np.searchsorted(keys, passing, "right")
            yield fps[:n], fps[:n], keys[:n]
            keys, fps = keys[n:], fps[n:]
            if not len(keys):
                continue
            passing = None
        keys, fps = np.r_[held_k, keys], np.r_[held_f, fps]
        if not len(keys):
            continue
        last = np.searchsorted(keys, keys[-1])
        if last:
            yield from finish(keys[:last], fps[:last])
        held_k, held_f = keys[last:], fps[last:]
        if limit is not None and len(held_k) > limit:
            yield held_f, held_f, held_k
            passing, held_k, held_f = int(held_k[0]), held_k[:0], held_f[:0]
    if len(held_k):
        yield from finish(held_k, held_f)


def _out(found) -> Iterator[pa.RecordBatch]:
    for u, v, key in found:
        if len(u):
            yield pa.RecordBatch.from_arrays([_column(u), _column(v), pa.array(key, pa.int64())], names=["u", "v", "key"])


def links(fps: DataFrame, plan: Plan = NARROW) -> DataFrame:
    """Links (``u``, ``v``) that connect all of ``fps`` (distinct ``fp``) brought together by a
    variant and differing in at most ``bits`` bits; each component of them is one class."""
    n = partitions(fps.sparkSession)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                column = batch.column(0).slice(lo, 1024)
                keys = variants(_numbers(column), plan)
                own = column.take(pa.array(np.tile(np.arange(len(column)), SIZE)))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), own], names=["key", "fp"])

    def compare(limit: int | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sorted_ = ((b.column(0).to_numpy(), _numbers(b.column(1))) for b in batches)
            return _out(sorted_links(sorted_, plan, limit))

        return run

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_keys, all_fps = batch.column(0).to_numpy(), _numbers(batch.column(1))
            for key in np.unique(all_keys):
                own = all_fps[all_keys == key]
                for i, values in enumerate(parts_outside(own, int(key) >> plan.width, plan)):
                    columns = [
                        pa.array(np.full(len(own), key), pa.int64()),
                        pa.array(np.full(len(own), i), pa.int32()),
                        pa.array(values),
                        _column(own),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "part", "value", "fp"])

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(n, "key").sortWithinPartitions("key")

    schema = "u binary, v binary, key long"
    indexed = dealt(fps.select("fp").mapInArrow(index, "key long, fp binary"))
    first = staged(indexed.mapInArrow(compare(plan.group_limit), schema), "links")
    found, large = first.filter("key = -1"), first.filter("key <> -1")
    if not large.isEmpty():
        again = large.select("key", F.col("u").alias("fp")).mapInArrow(split, "key long, part int, value long, fp binary")
        keyed = again.select(F.xxhash64("key", "part", "value").alias("key"), "fp").distinct()
        sizes = keyed.groupBy("key").agg(F.count("*").alias("n"))
        # a block takes about half the limit; a group within the limit is one block
        blocks = F.when(F.col("n") > plan.group_limit, F.ceil(2 * F.col("n") / plan.group_limit)).otherwise(1)
        sizes = staged(sizes.select(F.col("key").alias("group"), blocks.cast("int").alias("blocks")), "sizes")
        own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        paired = keyed.join(sizes, F.col("key") == F.col("group")).select("key", "fp", own.alias("own"), other.alias("other"))
        pair = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
        found = found.union(dealt(paired.select(pair.alias("key"), "fp")).mapInArrow(compare(None), schema))
    return found.select("u", "v").distinct()


def _step(links: DataFrame) -> tuple[DataFrame, str]:
    path = scratch(links.sparkSession, "star")
    links.write.parquet(path)
    return links.sparkSession.read.schema(links.schema).parquet(path), path


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) of every node with an edge.

    Alternating star steps: each node's larger neighbours, then its smaller ones, are linked
    to the least of them. Minima are aggregates, so a node with very many links is no hot
    group; each step is written to shared scratch.
    """
    spark, before = edges.sparkSession, None
    pairs, path = _step(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        state = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
        both = pairs.union(pairs.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old = path
        pairs, path = _step(small.union(down.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        discard(spark, old)
    roots = pairs.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _classes(found: DataFrame, plan: Plan) -> DataFrame:
    """``fp``, ``root`` for each distinct fingerprint of ``found``."""
    fps = staged(found.select("fp").distinct(), "fingerprints")
    roots = components(links(fps, plan))
    return fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, plan: Plan = NARROW, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: ``id``, ``fingerprint`` (hexadecimal), ``component_id`` (least id)."""
    found = staged(signatures(docs, plan, id_col=id_col, text_col=text_col).select("id", "fp"), "signatures")
    own = found.groupBy("fp").agg(F.min("id").alias("least"))
    # written, so that both sides of each join are shuffled rows and a hot side can be split
    least = staged(own.join(_classes(found, plan), "fp"), "least")
    named = staged(least.groupBy("root").agg(F.min("least").alias("component_id")), "named")
    classes = staged(least.join(named, "root").select("fp", "component_id"), "classes")
    return found.join(classes, "fp").select("id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def one_of_each(
    docs: DataFrame, plan: Plan = NARROW, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the least (id, text hash; null ids last),
    once."""
    found = staged(signatures(docs, plan, id_col=id_col, text_col=text_col), "signatures")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "tie")
    own = staged(found.groupBy("fp").agg(F.min(rank).alias("first")), "firsts")
    first = own.join(_classes(found, plan), "fp").groupBy("root").agg(F.min("first").alias("first"))
    first = first.select(F.col("first.id").alias("first_id"), F.col("first.tie").alias("first_tie"))
    times = found.groupBy("id", "tie").agg(F.count("*").alias("n"))
    same = F.col("first_id").eqNullSafe(F.col("id")) & (F.col("first_tie") == F.col("tie"))
    kept = staged(first.join(times, same).select("id", "tie", "n"), "kept")
    own_tie, id_, tie, n = (fresh(docs, c) for c in ("own_tie", "kept_id", "kept_tie", "kept_n"))
    names = kept.select(F.col("id").alias(id_), F.col("tie").alias(tie), F.col("n").alias(n))
    marked = docs.withColumn(own_tie, F.xxhash64(text_bytes(text_col)))
    joined = marked.join(names, (F.col(own_tie) == F.col(tie)) & quoted(id_col).eqNullSafe(F.col(id_)))
    columns = [quoted(c) for c in docs.columns]
    if kept.filter("n > 1").isEmpty():
        return joined.select(*columns)
    once = joined.filter(F.col(n) == 1).select(*columns)
    again = joined.filter(F.col(n) > 1).dropDuplicates([own_tie, id_]).select(*columns)
    return once.union(again)
