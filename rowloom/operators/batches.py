"""Batches of rows: as numbered data, and as requests to an external sink."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.bins import cuts
from rowloom.functions.types import col, row_hash
from rowloom.operators.validate import (
    ERR_CODE,
    ERR_COUNT,
    ERR_DESC,
    ERR_FIELDS,
    INSERT_ERROR,
)
from rowloom.session import ship, stage

ship(__name__)

# Default sizes.
BATCH_SIZE = 100
SUB_BATCH_SIZE = 10
_KIND = "_kind"
_RANGE, _PART, _HASH, _NUMBER = "_range", "_part", "_hash", "_number"
RANGES_PER_PARTITION = 4
MOST_SHARES = 4  # a range may hold so many even shares of the rows
SMALL_RANGE = 10_000  # or so many rows


def batch_size_setting(text: str | None, default: int = BATCH_SIZE) -> int:
    """Batch size from a setting: blank is an error, an unreadable one means the default."""
    if text is None or not text.strip():
        raise ValueError("no batch size set")
    try:
        size = int(text)
    except ValueError:
        return default
    if size < 1:
        raise ValueError("a batch holds at least one row")
    return size


def in_ranges(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """Rows sorted across partitions of about equal size, however often a value repeats."""
    order = [col(c) if isinstance(c, str) else c for c in order_by]
    # Cut ranges inside runs of equal rows as well: by row hash, and for exact copies
    # (whose order does not matter) by the task they come from.
    order += [row_hash(df), F.spark_partition_id()]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def batch_rows(
    df: DataFrame,
    order_by: Sequence[str | Column],
    batch_size: int = BATCH_SIZE,
    staging: str | None = None,
) -> DataFrame:
    """Number rows ``0, 1, …`` in order and put each ``batch_size`` of them in a batch.

    Adds ``batch_id`` and ``batch_pos`` (bigint). All batches are full but the
    last. Rows equal in ``order_by`` follow a hash of the row.

    Nothing goes through one task and nothing is staged: rows are cut into
    ranges at fixed values of the first order column and, where one value is
    very common, of the row's hash. One pass finds these values with a mergeable
    sketch, one counts each range, both over few columns; the numbers are then
    the range's offset and the place in it. Ranges, counts and places follow
    from the rows alone, so tasks that rerun give the same numbers; ``df`` must
    give the same rows each time it is read.

    Fixed values cannot part exact copies, nor order a first column that is
    text or an expression. There, and where a range is found to hold several times
    its share, one sorted copy of the rows is staged instead, cut anywhere;
    a given ``staging`` (a new path) asks for that. The copy goes to scratch by
    default and is the caller's to delete after use. Numbers are the same.
    """
    if batch_size < 1:
        raise ValueError("a batch holds at least one row")
    number = None
    if staging is None:
        placed = _in_fixed_ranges(df, order_by)
        if placed is not None:
            placed, number = placed
    if number is None:
        placed, number = _staged_in_order(df, order_by, staging)
    return placed.select(
        *[col(c) for c in df.columns],
        F.call_function("div", number, F.lit(batch_size)).alias("batch_id"),
        F.pmod(number, F.lit(batch_size).cast("bigint")).alias("batch_pos"),
    )


def _in_fixed_ranges(df: DataFrame, order_by: Sequence[str | Column]) -> tuple[DataFrame, Column] | None:
    """``df`` with a column that gives each row's number, without a copy; none if the rows
    cannot be cut evenly."""
    if not order_by or not isinstance(order_by[0], str):
        return None
    first = col(order_by[0])
    kind = df.select(first).schema[0].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType)):
        return None
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = cuts(df, first, RANGES_PER_PARTITION * parts)
    hash_ = row_hash(df)
    bin_ = found.bin(first)
    # Only with no further order may a common value's rows be cut by their hash, which is
    # what then orders them. Its bin starts with that value and holds others behind it. The
    # sketch must tell the value from its neighbours.
    common = [v for v, w in zip(found.values, found.weights[1:]) if w > 1]
    exact = not isinstance(kind, T.DecimalType) and not (
        isinstance(kind, T.LongType) and any(abs(v) >= 1 << 53 for v in common)
    )
    if common and exact and len(order_by) == 1:
        starts = F.array(*[F.lit(v) for v in found.values]).cast(f"array<{found.type}>")
        value = first.cast("double") if found.type == "double" else first
        weight = found.weight(bin_)
        step = F.when(value == F.get(starts, bin_ - 1), F.shiftright(hash_, 32).cast("long") + F.lit(1 << 31))
        part = F.coalesce(F.shiftright(step * weight, 32).cast("int"), weight)
        part = F.when(weight > 1, part).otherwise(0)
    else:
        part = F.lit(0)
    ranged = df.withColumns({_RANGE: bin_, _PART: part, _HASH: hash_})
    sizes = {(r[_RANGE], r[_PART]): r["n"] for r in ranged.groupBy(_RANGE, _PART).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    if max(sizes.values(), default=0) > max(MOST_SHARES * total // (RANGES_PER_PARTITION * parts), SMALL_RANGE):
        return None
    before, offsets = 0, {}
    for key in sorted(sizes):
        offsets[key] = before
        before += sizes[key]
    # as many numbers as the sketch gave cuts, as one literal
    rows = [[offsets.get((b, p), 0) for p in range(w + 1)] for b, w in enumerate(found.weights)]
    first_of = F.from_json(F.lit(json.dumps(rows)), "array<array<bigint>>")
    offset = F.get(F.get(first_of, F.col(_RANGE)), F.col(_PART))
    order = [col(c) if isinstance(c, str) else c for c in order_by]
    place = F.row_number().over(Window.partitionBy(_RANGE, _PART).orderBy(*order, F.col(_HASH)))
    return ranged.withColumn(_NUMBER, offset + place - 1), F.col(_NUMBER)


def _staged_in_order(
    df: DataFrame, order_by: Sequence[str | Column], staging: str | None
) -> tuple[DataFrame, Column]:
    """A staged sorted copy of ``df``, whose bounds stay when tasks rerun, and each row's number."""
    # upper bits of the id are the partition, the lower 33 the place in it
    place = F.monotonically_increasing_id()
    staged = stage(
        in_ranges(df, order_by).select(
            *[col(c) for c in df.columns],
            F.shiftright(place, 33).alias(_RANGE),
            place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
        ),
        "batches",
        staging,
    )
    # offsets are a running sum over one row per partition, small enough to broadcast
    # whatever the table holds
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("_rows")).select(
        _RANGE, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    return staged.join(F.broadcast(offsets), _RANGE), F.col("_before") + F.col("_place")


def write_batches(
    df: DataFrame,
    send: Callable[[list[dict]], None],
    batch_size: int = BATCH_SIZE,
    sub_batch_size: int = SUB_BATCH_SIZE,
    code: str = INSERT_ERROR,
    run: str | None = None,
    counts: bool = False,
) -> DataFrame:
    """Send rows to an external sink in batches and return the rows it refused.

    ``send`` runs in the tasks, gets a list of row dicts and raises to refuse
    them. A refused batch is sent again in sub-batches, a refused sub-batch row
    by row, so only bad rows are lost. Write the returned frame once (a
    dead-letter table): that action does the sending; ``sink_batches`` is the
    two together. A task that reruns sends its rows again, so the sink must take
    repeats, as an upsert does, or tell them: with ``run`` (a name of this run)
    ``send`` also gets the request's name, ``run/partition/first row-last row``,
    which a rerun of the task repeats as long as its input is in the same order.
    ``counts`` adds a column that tells refused rows from one row a task, which
    only holds how many rows it was given.
    """
    if batch_size < 1 or sub_batch_size < 1:
        raise ValueError("batch sizes start at 1")
    schema = T.StructType(
        [
            *[T.StructField(f.name, f.dataType) for f in df.schema],
            T.StructField(ERR_COUNT, T.LongType()),
            T.StructField(ERR_DESC, T.StringType()),
            T.StructField(ERR_FIELDS, T.StringType()),
            T.StructField(ERR_CODE, T.StringType()),
            *([T.StructField(_KIND, T.StringType())] if counts else []),
        ]
    )
    names = [f.name for f in schema]

    def task(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = 0
        for table in rechunk(chunks, batch_size):
            name = None if run is None else f"{run}/{TaskContext.get().partitionId()}"
            refused = send_split(table.to_pylist(), send, sub_batch_size, name, first)
            first += table.num_rows
            if refused:
                rows = table.take([i for i, _ in refused])
                count = len(refused)
                extra = [
                    pa.array([1] * count, pa.int64()),
                    pa.array([message for _, message in refused], pa.string()),
                    pa.nulls(count, pa.string()),
                    pa.array([code] * count, pa.string()),
                    *([pa.array(["refused"] * count, pa.string())] if counts else []),
                ]
                yield from pa.table([*rows.columns, *extra], names=names).to_batches()
        if counts and first:
            none = [pa.nulls(1, c.type) for c in table.columns]
            extra = [pa.array([first]), *[pa.nulls(1, pa.string())] * 3, pa.array(["sent"])]
            yield pa.RecordBatch.from_arrays([*none, *extra], names=names)

    return df.mapInArrow(task, schema)


@dataclass
class SinkResult:
    """What a sink was sent: rows offered and refused, from the committed copy of the refused
    rows and from counters of the tasks that committed it."""

    rows: int
    refused: int
    rejects: DataFrame


def sink_batches(
    df: DataFrame,
    send: Callable[..., None],
    rejects: str,
    batch_size: int = BATCH_SIZE,
    sub_batch_size: int = SUB_BATCH_SIZE,
    code: str = INSERT_ERROR,
    run: str | None = None,
) -> SinkResult:
    """Send all rows to an external sink and write those it refuses to ``rejects``.

    The refused rows leave the tasks as data, however many they are: Spark's
    writer commits them, so a task that runs again replaces its own. The counts
    are taken from the same commit: every task adds a row with the number of
    rows it was given, beside the refused ones.
    """
    refused = write_batches(df, send, batch_size, sub_batch_size, code, run, counts=True)
    refused.write.mode("overwrite").partitionBy(_KIND).parquet(rejects)
    spark = df.sparkSession
    written = spark.read.schema(refused.schema).parquet(rejects)
    bad = written.where(F.col(_KIND) == "refused").drop(_KIND)
    sums = written.groupBy(_KIND).agg(F.sum(ERR_COUNT).alias("n")).collect()
    found = {r[_KIND]: r.n for r in sums}
    return SinkResult(found.get("sent", 0), found.get("refused", 0), bad)


def rechunk(chunks: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Cut a stream of Arrow batches into tables of ``size`` rows and a shorter last one."""
    held: list[pa.RecordBatch] = []
    count = 0
    for chunk in chunks:
        at = 0
        while at < chunk.num_rows:
            part = chunk.slice(at, size - count)
            held.append(part)
            count += part.num_rows
            at += part.num_rows
            if count == size:
                yield pa.Table.from_batches(held)
                held, count = [], 0
    if count:
        yield pa.Table.from_batches(held)


def send_split(
    rows: list[dict],
    send: Callable[..., None],
    sub_batch_size: int,
    name: str | None = None,
    first: int = 0,
) -> list[tuple[int, str]]:
    """Send rows, narrowing down on failure; returns position and message of refused rows.

    With a ``name``, ``send`` also gets it with the numbers of the rows it holds,
    counted from ``first``.
    """
    refused = []
    waiting = [range(len(rows))]
    while waiting:
        part = waiting.pop()
        try:
            request = [] if name is None else [f"{name}/{first + part[0]}-{first + part[-1]}"]
            send([rows[i] for i in part], *request)
        except Exception as e:  # any refusal of the sink counts
            if len(part) == 1:
                refused.append((part[0], str(e)))
                continue
            step = sub_batch_size if len(part) > sub_batch_size else 1
            waiting += [part[i : i + step] for i in range(0, len(part), step)]
    return sorted(refused)
