"""Projection, filter, limit and count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.types import col, storage_type, storage_value

Item = str | tuple[str, str] | Column


def fold_name(name: str) -> str:
    """Lower-case name, unless double quotes ask to keep its case."""
    if len(name) > 1 and name.startswith('"') and name.endswith('"'):
        return name[1:-1]
    return name.lower()


def project(df: DataFrame, *items: Item) -> DataFrame:
    """Named columns in select-list order; ``(name, alias)`` renames."""
    out = []
    for item in items:
        if isinstance(item, Column):
            out.append(item)
        elif isinstance(item, tuple):
            out.append(col(fold_name(item[0])).alias(fold_name(item[1])))
        else:
            out.append(col(fold_name(item)).alias(fold_name(item)))
    return df.select(*out)


def project_lenient(df: DataFrame, *names: str) -> DataFrame:
    """Like :func:`project`, but a column the table lacks comes out as a null string."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in map(fold_name, names):
        known = name.lower() in have
        out.append((col(name) if known else F.lit(None).cast("string")).alias(name))
    return df.select(*out)


def first_n_columns(df: DataFrame, n: int) -> DataFrame:
    return df.select(*[col(c) for c in df.columns[:n]])


def select_distinct(df: DataFrame, *items: Item) -> DataFrame:
    return (project(df, *items) if items else df).distinct()


def where(df: DataFrame, condition: Column | str) -> DataFrame:
    """Filter by a SQL condition; it is pushed to the source where the format allows."""
    return df.where(condition)


def limit(df: DataFrame, n: int, order_by: list) -> DataFrame:
    """First ``n`` rows in ``order_by``: a top-n per task, merged (no full sort)."""
    return df.orderBy(*order_by).limit(n)


def count_star(df: DataFrame) -> DataFrame:
    """One row, column ``count`` (bigint)."""
    return df.agg(F.count(F.lit(1)).alias("count"))


def align_to_target(df: DataFrame, target: T.StructType, keep_unknown: bool = False) -> DataFrame:
    """Input columns in the target's order and types, matched by name.

    Columns the target lacks are dropped, or kept after the others if
    ``keep_unknown``. A value that does not fit its column becomes null; use
    :func:`rowloom.operators.validate.flag_rejects` first to keep such rows.
    """
    by_name = {f.name.lower(): f for f in df.schema}
    out = []
    for field in target:
        source = by_name.pop(field.name.lower(), None)
        if source is not None:
            value = storage_value(col(source.name), source.dataType, field.dataType)
            out.append(value.alias(field.name))
    if keep_unknown:
        out += [col(f.name) for f in by_name.values()]
    return df.select(*out)


def missing_columns(df: DataFrame, target: T.StructType) -> list[T.StructField]:
    """Storage fields for input columns that ``target`` lacks (schema evolution)."""
    have = {f.name.lower() for f in target}
    return [
        T.StructField(f.name, storage_type(f.dataType))
        for f in df.schema
        if f.name.lower() not in have
    ]
