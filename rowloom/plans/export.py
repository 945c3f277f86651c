"""Exports: sorted files by key, and insert scripts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.cells import WRITE_TIME
from rowloom.functions.text import identifier, literal
from rowloom.functions.types import col
from rowloom.keys import KeySpec, key_spec
from rowloom.operators.batches import BATCH_SIZE, batch_rows
from rowloom.operators.upsert import latest_cells
from rowloom.operators.validate import (
    EXPORT_ERROR,
    accepted,
    empty_row_problem,
    flag,
    null_key_problem,
    rejected,
)
from rowloom.session import stage

# Fixed value: default write buffer in MB.
BUFFER_MB = 16


def blank_to_null(rows: DataFrame) -> DataFrame:
    """An empty string counts as a missing value."""
    out = []
    for f in rows.schema:
        text = isinstance(f.dataType, T.StringType)
        out.append(F.nullif(col(f.name), F.lit("")).alias(f.name) if text else col(f.name))
    return rows.select(*out)


def flag_export(rows: DataFrame, key: KeySpec | str | Sequence) -> DataFrame:
    """Flag rows that cannot be exported: a part of their key is null or ``""``."""
    spec = key_spec(key)
    spec.require_in(rows)
    filled = blank_to_null(rows)
    return flag(filled, [null_key_problem(filled, spec, filled.columns)], code=EXPORT_ERROR)


def sorted_by_key(
    rows: DataFrame,
    key: KeySpec | str | Sequence,
    written_at: str | None = None,
    partitions: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """Rows reduced to one per key and laid out in key order across partitions.

    Nulls and ``""`` are not written, so older values of a key show through.
    Without ``written_at`` the greatest value of a cell wins. ``unique`` says
    that keys do not repeat, which saves the reduction and its shuffle. Ranges
    are cut on the whole primary key: a partition key that holds much of the
    table is spread over many tasks and files, each still sorted.
    """
    spec = key_spec(key)
    spec.require_in(rows)
    if unique:
        merged = blank_to_null(rows)
    elif written_at is None:
        stamped = rows.withColumn(WRITE_TIME, F.lit(0).cast("bigint"))
        merged = latest_cells(stamped, spec, blank_is_null=True).drop(WRITE_TIME)
    else:
        merged = latest_cells(rows, spec, written_at, blank_is_null=True)
    columns = [col(c) for c in spec.columns]
    ranged = (
        merged.repartitionByRange(partitions, *columns)
        if partitions
        else merged.repartitionByRange(*columns)
    )
    return ranged.sortWithinPartitions(*columns)


def bulk_export(
    rows: DataFrame,
    path: str,
    key: KeySpec | str | Sequence,
    written_at: str | None = None,
    buffer_mb: int = BUFFER_MB,
    max_records: int | None = None,
    partitions: int | None = None,
    unique: bool = False,
    format: str = "parquet",
) -> DataFrame:
    """Write rows as key-sorted files that do not overlap; returns the rejected rows, lazily.

    ``buffer_mb`` is the size of a sorted block (Parquet row group) within a
    file and ``max_records`` limits a file; without ``partitions`` the adaptive
    plan sizes the ranges.
    """
    if buffer_mb < 1:
        raise ValueError("the buffer holds at least 1 MB")
    flagged = flag_export(rows, key)
    laid_out = sorted_by_key(accepted(flagged), key, written_at, partitions, unique)
    writer = laid_out.write.format(format)
    writer = writer.option("parquet.block.size", buffer_mb * 1024 * 1024)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.save(path)
    return rejected(flagged)


def insert_statement(
    df: DataFrame,
    table: str,
    ttl: int | Column | None = None,
    timestamp: int | Column | None = None,
    nulls: str = "ignore",
    columns: list[str] | None = None,
) -> Column:
    """The row as ``INSERT INTO table (…) VALUES (…) [USING TTL n AND TIMESTAMP m]``.

    Null columns are left out, or written as ``null`` with ``nulls="overwrite"``.
    """
    names, values = [], []
    for name in columns or df.columns:
        value = literal(col(name), df.schema[name].dataType)
        shown = F.lit(identifier(name))
        if nulls == "overwrite":
            value = F.coalesce(value, F.lit("null"))
        else:
            shown = F.when(col(name).isNotNull(), shown)
        names.append(shown)
        values.append(value)
    options = []
    for word, value in (("TTL", ttl), ("TIMESTAMP", timestamp)):
        if value is not None:
            c = value if isinstance(value, Column) else F.lit(value)
            options.append(F.concat(F.lit(f"{word} "), c.cast("string")))
    using = F.concat_ws(" AND ", *options) if options else F.lit("")
    target = ".".join(identifier(p) for p in table.split("."))
    return F.concat(
        F.lit(f"INSERT INTO {target} ("),
        F.concat_ws(",", *names),
        F.lit(") VALUES ("),
        F.concat_ws(",", *values),
        F.lit(")"),
        F.when(using != "", F.concat(F.lit(" USING "), using)).otherwise(""),
    )


def insert_script(
    rows: DataFrame,
    table: str,
    order_by: Sequence[str | Column],
    batch_size: int = BATCH_SIZE,
    unlogged: bool = True,
    ttl: int | Column | None = None,
    timestamp: int | Column | None = None,
    nulls: str = "ignore",
    key: KeySpec | str | Sequence | None = None,
    staging: str | None = None,
    rejects_path: str | None = None,
) -> DataFrame:
    """One script per batch: ``batch_id`` and the framed ``script`` text.

    With a ``key``, rows with a null in it, and where nulls are left out rows
    holding nothing but a single-column key, cannot be inserted: they are
    written with their errors to ``rejects_path``. A group holds at most
    ``batch_size`` statements. Write it out with
    ``.select("script").write.text(path)``.
    """
    if nulls not in ("ignore", "overwrite"):
        raise ValueError(f"nulls must be 'ignore' or 'overwrite', not {nulls!r}")
    if key is not None:
        spec = key_spec(key)
        spec.require_in(rows)
        if rejects_path is None:
            raise ValueError("rows without a key need a place: give rejects_path")
        problems = [null_key_problem] + [empty_row_problem] * (nulls == "ignore")
        flagged = stage(flag(rows, [check(rows, spec, rows.columns) for check in problems]), "checked")
        rejected(flagged).write.mode("overwrite").parquet(rejects_path)
        rows = accepted(flagged)
    numbered = batch_rows(rows, order_by, batch_size, staging)
    statement = insert_statement(numbered, table, ttl, timestamp, nulls, rows.columns)
    entry = F.struct("batch_pos", statement.alias("statement"))
    grouped = numbered.groupBy("batch_id").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    head = "BEGIN UNLOGGED BATCH " if unlogged else "BEGIN BATCH "
    return grouped.select(
        "batch_id",
        F.concat(
            F.lit(head), F.array_join("entries.statement", ";"), F.lit(";APPLY BATCH;")
        ).alias("script"),
    )
