"""Last write wins: reconciling a log of writes to one row per primary key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.cells import EXPIRES_AT, WRITE_TIME, WRITTEN, expiry
from rowloom.functions.types import col
from rowloom.keys import KeySpec, key_spec

NULL_RULES = ("overwrite", "ignore")


def _check_rule(nulls: str) -> None:
    if nulls not in NULL_RULES:
        raise ValueError(f"nulls must be one of {NULL_RULES}, not {nulls!r}")


def _has_order(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_order(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_has_order(f.dataType) for f in dtype)
    return not isinstance(dtype, T.MapType)


def _orderable(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Columns to sort by; values without an order (maps) go by their text."""
    return [col(c) if _has_order(df.schema[c].dataType) else F.to_json(col(c)) for c in columns]


def _newest_cell(
    log: DataFrame,
    name: str,
    value: Column,
    wrote: Column,
    order: Sequence[Column],
    *carried: Column,
) -> Column:
    """Aggregate: ``value`` and the carried columns of the newest write of a cell, as a struct.

    Writes equal in ``order`` are settled by the greater value.
    """
    ranks = [c.alias(f"_rank{i}") for i, c in enumerate(order)]
    if _has_order(log.schema[name].dataType):
        return F.max(F.when(wrote, F.struct(*ranks, value.alias("value"), *carried)))
    by_text = F.struct(*ranks, F.to_json(value))
    return F.max_by(F.struct(value.alias("value"), *carried), F.when(wrote, by_text))


def latest_rows(
    log: DataFrame,
    key: KeySpec | str | Sequence,
    written_at: str = WRITE_TIME,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """The newest row per key; its nulls count as written.

    Equal write times are settled by ``ties`` (greatest first, nulls last), by
    default all remaining columns, so the result does not depend on task order.
    Each task reduces its rows to one per key before the shuffle.
    """
    spec = key_spec(key)
    spec.require_in(log)
    taken = {c.lower() for c in (*spec.columns, written_at)}
    rest = [c for c in log.columns if c.lower() not in taken] if ties is None else ties
    order = [c.desc_nulls_last() for c in (col(written_at), *_orderable(log, rest))]
    by_key = Window.partitionBy(*[col(c) for c in spec.columns]).orderBy(*order)
    return log.withColumn("_nth", F.row_number().over(by_key)).where("_nth = 1").drop("_nth")


def latest_cells(
    log: DataFrame,
    key: KeySpec | str | Sequence,
    written_at: str = WRITE_TIME,
    ties: Sequence[str] | None = None,
    blank_is_null: bool = False,
) -> DataFrame:
    """Per key and column the newest non-null value: nulls leave older values alone.

    Equal write times are settled by ``ties``, then by the greater value.
    ``written_at`` comes out as the newest write of the row. ``blank_is_null``
    also treats ``""`` as not written. Partial aggregation runs before the
    shuffle, so many versions of one key stay cheap.
    """
    spec = key_spec(key)
    spec.require_in(log)
    taken = {c.lower() for c in (*spec.columns, written_at)}
    aggs = []
    for f in log.schema:
        if f.name.lower() in taken:
            continue
        value = col(f.name)
        if blank_is_null and isinstance(f.dataType, T.StringType):
            value = F.nullif(value, F.lit(""))
        order = [col(written_at), *[col(t) for t in ties or ()]]
        aggs.append(_newest_cell(log, f.name, value, value.isNotNull(), order).alias(f.name))
    aggs.append(F.max(col(written_at)).alias(written_at))
    merged = log.groupBy(*[col(c) for c in spec.columns]).agg(*aggs)
    return merged.select(
        *[
            col(c) if c.lower() in taken else col(c)["value"].alias(c)
            for c in log.columns
        ]
    )


def upsert(
    base: DataFrame,
    changes: DataFrame,
    key: KeySpec | str | Sequence,
    *,
    nulls: str,
    written_at: str = WRITE_TIME,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """``base`` with ``changes`` applied. ``nulls`` says what a null in a change means:
    ``overwrite`` writes it, ``ignore`` leaves the stored value alone."""
    _check_rule(nulls)
    log = base.unionByName(changes, allowMissingColumns=nulls == "ignore")
    if nulls == "overwrite":
        return latest_rows(log, key, written_at, ties)
    return latest_cells(log, key, written_at, ties)


def with_ttl(df: DataFrame, seconds: int | Column | None, written_at: str = WRITE_TIME) -> DataFrame:
    """Set the expiry of every row written: write time plus ``seconds``, none unless positive."""
    c = seconds if isinstance(seconds, Column) else F.lit(seconds).cast("bigint")
    return df.withColumn(EXPIRES_AT, expiry(col(written_at), c))


def live_rows(reconciled: DataFrame, as_of: Column) -> DataFrame:
    """Rows not expired at ``as_of``. Apply after reconciling: an expired winner must
    not bring an older version back."""
    expires = F.col(EXPIRES_AT)
    return reconciled.where(expires.isNull() | (expires > as_of.cast("timestamp")))


def _wrote(log: DataFrame, name: str) -> Column:
    """Whether a log row wrote this cell: a value always counts, a null if ``_written`` names it."""
    if WRITTEN not in log.columns:
        return col(name).isNotNull()
    listed = F.coalesce(F.array_contains(F.col(WRITTEN), name), F.lit(False))
    return col(name).isNotNull() | listed


def live_cells(
    log: DataFrame,
    key: KeySpec | str | Sequence,
    as_of: Column | None,
    written_at: str = WRITE_TIME,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Like :func:`latest_cells` where each write also carries an expiry (``_expires_at``).

    The newest write of a cell wins first; if it has expired at ``as_of`` the
    cell is null, whatever older writes held. A row stays while its newest
    write is unexpired or any of its cells is. With ``as_of=None`` nothing
    expires. An array column ``_written`` in the log names columns a row wrote
    even where they are null.
    """
    spec = key_spec(key)
    spec.require_in(log)
    hidden = {c.lower() for c in (*spec.columns, written_at, EXPIRES_AT, WRITTEN, *(ties or ()))}
    values = [f.name for f in log.schema if f.name.lower() not in hidden]
    at, expires = col(written_at), F.col(EXPIRES_AT)
    aggs = []
    for name in values:
        order = [at, *[col(t) for t in ties or ()]]
        wrote = _wrote(log, name)
        cell = _newest_cell(log, name, col(name), wrote, order, expires.alias("expires"))
        aggs.append(cell.alias(name))
    newest = F.struct(at, *[col(t) for t in ties or ()], expires)
    aggs.append(F.max(newest).alias("_newest"))
    merged = log.groupBy(*[col(c) for c in spec.columns]).agg(*aggs)

    def live(expiry_column: Column) -> Column:
        if as_of is None:
            return F.lit(True)
        return expiry_column.isNull() | (expiry_column > as_of.cast("timestamp"))

    cells = {n: F.when(live(col(n)["expires"]), col(n)["value"]) for n in values}
    shown = live(F.col("_newest")[EXPIRES_AT])
    for c in cells.values():
        shown = shown | c.isNotNull()
    return merged.where(shown).select(
        *[col(c) for c in spec.columns],
        *[c.alias(n) for n, c in cells.items()],
        F.col("_newest")[written_at].alias(written_at),
        F.col("_newest")[EXPIRES_AT].alias(EXPIRES_AT),
    )


def winning_writes(
    log: DataFrame, key: KeySpec | str | Sequence, stamp: Sequence[str]
) -> DataFrame:
    """Drop what :func:`live_cells` would never show: keep, per key, the newest write of each
    cell and of the row, and put cells of the same write back in one row.

    ``stamp`` names the columns of a write, ordered by them (write time first).
    A key keeps at most one row per column and one more, however many versions
    it had, and is reduced in partial aggregates before the shuffle. Adds
    ``_written``, the columns each kept row wrote.
    """
    spec = key_spec(key)
    hidden = {c.lower() for c in (*spec.columns, *stamp, WRITTEN)}
    values = [f.name for f in log.schema if f.name.lower() not in hidden]
    mark = F.struct(*[col(c) for c in stamp])
    aggs = [F.max(mark).alias("_newest")]
    for name in values:
        wrote = _wrote(log, name)
        cell = _newest_cell(log, name, col(name), wrote, [mark], mark.alias("mark"))
        aggs.append(cell.alias(name))
    cells = log.groupBy(*[col(c) for c in spec.columns]).agg(*aggs)
    marks = F.array("_newest", *[col(n)["mark"] for n in values])
    one_write = cells.withColumn("_mark", F.explode(F.array_distinct(F.array_compact(marks))))
    mine = {n: col(n)["mark"] == F.col("_mark") for n in values}
    names = [F.when(mine[n], F.lit(n)) for n in values]
    kept = F.array_compact(F.array(*names)) if names else F.lit(None).cast("array<string>")
    return one_write.select(
        *[col(c) for c in spec.columns],
        *[F.when(mine[n], col(n)["value"]).alias(n) for n in values],
        *[F.col("_mark")[c].alias(c) for c in stamp],
        kept.alias(WRITTEN),
    )
