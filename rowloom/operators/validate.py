"""Rejects kept as data: rows that cannot be written get an error code and message.

A flagged frame is the input plus the error columns below; good rows have a null
code. ``accepted`` and ``rejected`` are two filters over it, so accepted plus
rejected is always the whole input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.text import row_text
from rowloom.functions.types import col, storage_value
from rowloom.keys import KeySpec, key_spec

# Error codes of rejected rows.
INSERT_ERROR = "ERR_INSERT01"
EXPORT_ERROR = "ERR_SSTABLE_OUTPUT_01"

ERR_CODE, ERR_DESC, ERR_FIELDS, ERR_COUNT = "_err_code", "_err_desc", "_err_fields", "_err_count"
ERROR_COLUMNS = [ERR_COUNT, ERR_DESC, ERR_FIELDS, ERR_CODE]


def flag(
    df: DataFrame,
    problems: Sequence[tuple[Column, Column]],
    fields: Column | None = None,
    code: str = INSERT_ERROR,
) -> DataFrame:
    """Add error columns. ``problems`` are pairs of condition and message; the first that
    holds is the row's error.

    Good rows only pay for the conditions: messages are built from the number
    of the problem found, and filters on the error columns reduce to it.
    """
    found = F.lit(None).cast("int")
    for i, (condition, _) in reversed(list(enumerate(problems))):
        found = F.when(condition, F.lit(i)).otherwise(found)
    columns = [col(c) for c in df.columns]
    message = F.lit(None).cast("string")
    for i, (_, text) in enumerate(problems):
        message = F.when(F.col("_problem") == i, text).otherwise(message)
    named = F.lit(None).cast("string") if fields is None else fields
    bad = F.col("_problem").isNotNull()
    return df.select(*columns, found.alias("_problem")).select(
        *columns,
        F.when(bad, F.lit(1).cast("bigint")).alias(ERR_COUNT),
        message.alias(ERR_DESC),
        F.when(bad, named).alias(ERR_FIELDS),
        F.when(bad, F.lit(code)).alias(ERR_CODE),
    )


def accepted(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col(ERR_CODE).isNull()).drop(*ERROR_COLUMNS)


def rejected(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col(ERR_CODE).isNotNull())


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def null_key_problem(df: DataFrame, key: KeySpec, columns: list[str]) -> tuple[Column, Column]:
    text = F.concat(F.lit("null key: "), row_text(df, columns))
    return _any([col(c).isNull() for c in key.columns]), text


def empty_row_problem(df: DataFrame, key: KeySpec, columns: list[str]) -> tuple[Column, Column]:
    """A single-column key is all the row holds; rows of wider keys, and of tables that are
    only a key, are never empty."""
    keys = {c.lower() for c in key.columns}
    values = [c for c in columns if c.lower() not in keys]
    filled = _any([col(c).isNotNull() for c in values]) if values else F.lit(True)
    key_text = F.coalesce(col(key.columns[0]).cast("string"), F.lit(""))
    text = F.concat(F.lit("no values for key: "), key_text)
    return (~filled if len(keys) == 1 else F.lit(False)), text


def misfits(df: DataFrame, target: T.StructType, columns: list[str]) -> dict[str, Column]:
    """Per column whose type differs from the target's: whether its value would be lost."""
    by_name = {f.name.lower(): f for f in target}
    out = {}
    for name in columns:
        dtype = df.schema[name].dataType
        field = by_name.get(name.lower())
        if field is not None and field.dataType != dtype:
            stored = storage_value(col(name), dtype, field.dataType)
            out[name] = col(name).isNotNull() & stored.isNull()
    return out


def reject_null_key(df: DataFrame, key: KeySpec | str | Sequence) -> DataFrame:
    """Flag rows with a null in any key column."""
    spec = key_spec(key)
    spec.require_in(df)
    return flag(df, [null_key_problem(df, spec, df.columns)])


def reject_empty_row(df: DataFrame, key: KeySpec | str | Sequence) -> DataFrame:
    """Flag rows of a single-column key with no other value."""
    spec = key_spec(key)
    spec.require_in(df)
    return flag(df, [empty_row_problem(df, spec, df.columns)])


def flag_rejects(
    df: DataFrame,
    key: KeySpec | str | Sequence,
    target: T.StructType,
    code: str = INSERT_ERROR,
    columns: list[str] | None = None,
    empty_rows: bool = True,
    more: Sequence[tuple[Column, Column]] = (),
) -> DataFrame:
    """All checks of a load in one pass: null key, empty row, value that does not fit its column,
    and ``more`` problems of the caller's.

    ``columns`` are the input's own columns, if ``df`` carries others too.
    Empty rows are let through without ``empty_rows``: where nulls are written
    they are writes like others.
    """
    spec = key_spec(key)
    spec.require_in(df)
    names = columns or df.columns
    lost = misfits(df, target, names)
    misfit_text = F.concat(F.lit("value does not fit: "), row_text(df, names))
    lost_names = F.concat_ws(",", *[F.when(c, F.lit(n)) for n, c in lost.items()])
    problems = [
        null_key_problem(df, spec, names),
        *([empty_row_problem(df, spec, names)] if empty_rows else []),
        (_any(list(lost.values())), misfit_text),
        *more,
    ]
    return flag(df, problems, F.nullif(lost_names, F.lit("")), code)


def load_report(flagged: DataFrame) -> DataFrame:
    """One row of counters: rows read, written, rejected, and error count."""
    bad = F.col(ERR_CODE).isNotNull()
    return flagged.agg(*report_counters(bad))


def report_counters(bad: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~bad).alias("rows_written"),
        F.count_if(bad).alias("rows_rejected"),
        F.count_if(bad).alias("errors"),
    ]
