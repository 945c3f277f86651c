"""Changes of a keyed stream: last write wins with state, expiries by timer."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState

from rowloom.functions.cells import WRITE_TIME
from rowloom.functions.types import col, quoted, row_hash
from rowloom.keys import KeySpec, key_spec
from rowloom.session import ship

ship(__name__)

CHANGE = "_change"
PUT, EXPIRE = "put", "expire"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# groups of keys that a batch calls Python for, at most
SLOTS = 1 << 16
# rows travel as text that keeps every digit
_FORMAT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
_STAMP = ["at", "seq", "tie"]
_STATE = "key array<string>, at array<long>, seq array<long>, tie array<long>, expires array<long>"
_OUT = "key string, change string, at long, payload string"


def _newest(slot: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Holds the stamp of the newest write of each key of a slot; lets pass what is newer."""
    held = dict(zip(state.get[0], zip(*state.get[1:]))) if state.exists else {}
    new, out = {}, []
    if not state.hasTimedOut:
        for some in rows:
            for key, *one in zip(*(some[c].tolist() for c in ("key", *_STAMP, "expires", "payload"))):
                best = new.get(key) or held.get(key)
                if best is None or tuple(one[:3]) > best[:3]:
                    new[key] = tuple(one)
    for key, one in new.items():
        held[key] = one[:4]
        out.append((key, PUT, one[0], one[4]))
    # the stamp stays, so that an older write that comes late does not bring the row back
    timed = {key: one for key, one in held.items() if one[3] >= 0}
    now = state.getCurrentWatermarkMs() if timed else None
    for key, one in timed.items():
        if one[3] < now:
            held[key] = (*one[:3], -1)
            out.append((key, EXPIRE, one[0], None))
    if out:
        state.update((list(held), *map(list, zip(*held.values()))))
    ends = [one[3] for one in timed.values() if one[3] >= now]
    if ends:
        # a call ends the wait before it
        state.setTimeoutTimestamp(max(min(ends), now + 1))
    if out:
        yield pd.DataFrame(out, columns=["key", "change", "at", "payload"])


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch of rows only the newest of a key, so that a very common key stays cheap."""
    for batch in batches:
        order = pa.compute.sort_indices(batch, [(c, "descending") for c in _STAMP])
        taken = batch.take(order)
        first = ~pd.Series(taken.column("key").to_pylist()).duplicated()
        yield taken.filter(pa.array(first.to_numpy()))


def stream_changes(
    stream: DataFrame,
    key: KeySpec | str | Sequence,
    *,
    event_time: str,
    written_at: Column,
    seq: Column | None = None,
    ttl: int | None = None,
    late: str = "1 day",
    slots: int = SLOTS,
) -> DataFrame:
    """The stream's accepted writes: each row that is newer than all seen of its key before.

    Adds ``_change`` and ``_writetime``. A row is ``put``; with ``ttl`` (seconds
    from ``event_time``) an ``expire`` row, null but for its key, follows once
    the watermark (``late`` behind the newest event time) has passed its end and
    no newer write has come. Equal write times are settled by ``seq``, then a
    hash of the row. A write whose key or write time is null is left out
    (:func:`~rowloom.streaming.jobs.stream_upsert` keeps such rows as rejects).

    State is a stamp a key, in RocksDB (``STATE_STORE``, which the session must
    name); rows are reduced to the newest of each key in every Arrow batch
    before they are shuffled, and only these pass through Python. Keys share
    ``slots`` by their hash: a batch calls Python once for each slot it reaches,
    and writes the stamps of that slot. With very many keys raise it, so that a
    slot holds some hundreds at most; like the number of shuffle partitions it
    stays as it is for the life of a checkpoint.
    """
    if slots < 1:
        raise ValueError("there is at least one slot")
    if not stream.isStreaming:
        raise ValueError("changes are those of a stream")
    spark, spec = stream.sparkSession, key_spec(key)
    spec.require_in(stream)
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != STATE_STORE:
        raise RuntimeError(f"set spark.sql.streaming.stateStore.providerClass to {STATE_STORE}")
    columns = [c for c in stream.columns]
    keys = F.to_json(F.struct(*[col(c) for c in spec.columns]), _FORMAT)
    ends = F.lit(-1) if ttl is None else F.unix_millis(col(event_time).cast("timestamp")) + ttl * 1000
    rows = stream.withWatermark(event_time, late) if ttl is not None else stream
    given = None
    for c in spec.columns:
        given = col(c).isNotNull() if given is None else given & col(c).isNotNull()
    packed = rows.where(given & written_at.isNotNull()).select(
        keys.alias("key"),
        written_at.cast("bigint").alias("at"),
        (F.lit(0) if seq is None else seq).cast("bigint").alias("seq"),
        row_hash(stream).alias("tie"),
        ends.cast("bigint").alias("expires"),
        F.to_json(F.struct(*[col(c) for c in columns]), _FORMAT).alias("payload"),
        *([col(event_time)] if ttl is not None else []),
    )
    packed = packed.mapInArrow(_reduced, packed.schema)
    packed = packed.withColumn("slot", F.pmod(F.xxhash64("key"), F.lit(slots)))
    found = packed.groupBy("slot").applyInPandasWithState(
        _newest, _OUT, _STATE, "append", "NoTimeout" if ttl is None else "EventTimeTimeout"
    )
    row = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema])
    own = F.from_json(F.coalesce("payload", "key"), row, _FORMAT)
    return found.withColumn("row", own).select(
        *[F.col(f"row.{quoted(c)}") for c in columns], F.col("change").alias(CHANGE), F.col("at").alias(WRITE_TIME)
    )
