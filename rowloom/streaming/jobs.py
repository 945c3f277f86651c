"""Structured Streaming forms of the lookup and the load."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import Future

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rowloom.keys import KeySpec, key_spec
from rowloom.operators.batches import BATCH_SIZE, SUB_BATCH_SIZE, sink_batches
from rowloom.operators.lookup import limited, lookup, pairs_of
from rowloom.plans.load import FOLD, Pinned, fold_loads, load_table, pin, read_live


def stream_lookup(
    stream: DataFrame,
    target: DataFrame,
    on: Mapping[str, str] | Sequence[str] | str,
    where: Column | None = None,
) -> DataFrame:
    """:func:`lookup` with a streaming driver: a stateless stream-static join."""
    if not stream.isStreaming:
        raise ValueError("the driver is not a stream")
    return lookup(stream, target, on, where)


def stream_upsert(
    stream: DataFrame,
    table: str,
    key: KeySpec | str | Sequence,
    checkpoint: str,
    name: str,
    *,
    nulls: str,
    rejects: str,
    trigger: dict | None = None,
    fold: int | None = FOLD,
    **load_options,
) -> StreamingQuery:
    """Load each micro-batch into a keyed table; its rejects are written below ``rejects``.

    Load id and reject folder (``query=…/batch=…``) are made of the query's id,
    which lives in the checkpoint, and the batch number: a batch that is run
    again replaces its own load and rejects, and another checkpoint never
    touches those of this one, whatever its ``name``. Late rows lose by write
    time, which makes a watermark needless. The default trigger handles what is
    there and stops. After each batch the loads before it are folded in tiers of
    ``fold`` (:func:`~rowloom.plans.load.fold_loads`; ``None``: never), so a long
    stream leaves few loads; the batch itself stays, as it may be run again.
    """
    spec = key_spec(key)
    if load_options.get("truncate"):
        raise ValueError("each batch would drop the ones before it; truncate before the stream")

    started: Future[str] = Future()

    def load(rows: DataFrame, batch: int) -> None:
        own = started.result()
        load_id = f"{name}-{own}-{batch}"
        load_table(
            table,
            rows,
            spec,
            nulls=nulls,
            load_id=load_id,
            rejects_path=f"{rejects}/query={own}/batch={batch}",
            **load_options,
        )
        if fold:
            fold_loads(rows.sparkSession, table, fold, keep=[load_id])

    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    started.set_result(query.id)
    return query


def stream_sink_batches(
    stream: DataFrame,
    send: Callable[..., None],
    checkpoint: str,
    rejects: str,
    *,
    batch_size: int = BATCH_SIZE,
    sub_batch_size: int = SUB_BATCH_SIZE,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Send each micro-batch to an external sink in batches; refused rows are written at once
    below ``rejects`` (``query=…/batch=…``).

    ``send`` gets the rows and the request's name, ``query/batch/partition/rows``:
    a micro-batch that is run again, or a task of it, repeats its names, so a
    sink can leave out what it has. Its rejects replace their own.
    """
    started: Future[str] = Future()

    def run(rows: DataFrame, batch: int) -> None:
        own = started.result()
        path = f"{rejects}/query={own}/batch={batch}"
        sink_batches(rows, send, path, batch_size, sub_batch_size, run=f"{own}/{batch}")

    query = (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    started.set_result(query.id)
    return query


def stream_lookup_table(
    stream: DataFrame,
    table: str,
    on: Mapping[str, str] | Sequence[str] | str,
    checkpoint: str,
    out: str,
    *,
    pins: str,
    where: Column | None = None,
    as_of: Column | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """:func:`lookup` of every micro-batch in the state a keyed table has when the batch begins.

    What that state is made of (the newest attempts of the table's loads) is written below
    ``pins`` before the batch runs; a batch that is run again reads the same
    state and replaces its own rows below ``out`` (``query=…/batch=…``), even if
    loads came in between. Compaction or folding in between drops what was
    pinned: the batch then fails rather than answer from another state.
    """
    started: Future[str] = Future()

    def run(rows: DataFrame, batch: int) -> None:
        own, spark = started.result(), rows.sparkSession
        held = f"{pins}/query={own}/batch={batch}"
        pinned = _read_pins(spark, held)
        if pinned is None:
            pinned = pin(spark, table)
            names = [(pinned.name, a) for a in pinned.attempts] or [(pinned.name, None)]
            spark.createDataFrame(names, "name string, attempt string").coalesce(1).write.mode("overwrite").parquet(held)
        found = lookup(rows, read_live(spark, table, as_of, pinned=pinned), on, where)
        found.write.mode("overwrite").parquet(f"{out}/query={own}/batch={batch}")

    query = (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    started.set_result(query.id)
    return query


def _read_pins(spark: SparkSession, path: str) -> Pinned | None:
    """The state pinned at a path, if it was written whole."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return None
    rows = spark.read.parquet(path).collect()
    return Pinned(rows[0].name, tuple(r.attempt for r in rows if r.attempt is not None))


def stream_lookup_limit(
    stream: DataFrame,
    target: DataFrame,
    on: Mapping[str, str] | Sequence[str] | str,
    order_by: Sequence[Column],
    n: int,
) -> DataFrame:
    """:func:`lookup_limit` with a streaming driver: the target is limited once per key, then
    joined to the stream."""
    if not stream.isStreaming:
        raise ValueError("the driver is not a stream")
    return lookup(stream, limited(target, [t for t, _ in pairs_of(on)], order_by, n), on)
