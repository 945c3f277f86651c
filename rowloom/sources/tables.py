"""Table sources: any Spark format by path, or a catalog table by name."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession

from rowloom.operators.project import project


def read_table(
    spark: SparkSession,
    source: str,
    format: str | None = "parquet",
    schema=None,
    **options,
) -> DataFrame:
    """All schema columns of ``source`` in table order.

    ``format=None`` reads a catalog table. Any format on the classpath works
    (connectors included). A missing table raises :class:`LookupError`, and so
    does a source without columns.
    """
    try:
        if format is None:
            df = spark.table(source)
        else:
            reader = spark.read.format(format).options(**options)
            df = (reader.schema(schema) if schema else reader).load(source)
    except AnalysisException as e:
        missing = ("TABLE_OR_VIEW_NOT_FOUND", "PATH_NOT_FOUND", "SCHEMA_NOT_FOUND")
        if any(name in (e.getCondition() or "") for name in missing):
            raise LookupError(f"no such table: {source}") from e
        raise
    if not df.columns:
        raise LookupError(f"{source} gives no output fields")
    return df


def select_query(table: DataFrame, columns: list, where: Column | str | None = None) -> DataFrame:
    """``SELECT columns FROM table WHERE where``; both reach the file scan."""
    if not columns:
        raise LookupError("the query gives no output fields")
    rows = table if where is None else table.where(where)
    return project(rows, *columns)


def param_query(spark: SparkSession, text: str, args: dict | None = None, **frames) -> DataFrame:
    """Run SQL text with ``:name`` markers bound as typed values, never spliced as text.

    ``identifier(:t)`` takes a table name; ``{name}`` refers to a DataFrame
    given by keyword.
    """
    return spark.sql(text, args=args or {}, **frames)
