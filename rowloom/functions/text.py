"""Row and literal text for scripts and reject messages."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.types import col, is_collection

_PLAIN_NAME = re.compile(r"[a-z][a-z0-9_]*")
# Timestamp pattern of literals and the text shown for null.
INSTANT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSX"
NULL_TEXT = "<null>"


def fix_date(ts: Column) -> Column:
    """UTC day of an instant, for a target column of type ``date``."""
    return F.to_date(ts.cast("timestamp"))


def identifier(name: str) -> str:
    """Name as written in a script: quoted unless it is plain lower case."""
    if _PLAIN_NAME.fullmatch(name):
        return name
    return '"' + name.replace('"', '""') + '"'


def literal(c: Column, dtype: T.DataType) -> Column:
    """Script literal of a typed value (null stays null). Binary and collections are refused."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.concat(F.lit("'"), F.date_format(c.cast("timestamp"), INSTANT_FORMAT), F.lit("'"))
    if isinstance(dtype, T.BinaryType) or is_collection(dtype) or isinstance(dtype, T.StructType):
        raise TypeError(f"no literal form for {dtype.simpleString()}")
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return c.cast("string")
    return F.concat(F.lit("'"), F.replace(c.cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))


def row_text(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The row as ``a,b,<null>`` in column order."""
    parts = []
    for name in columns or df.columns:
        dtype = df.schema[name].dataType
        nested = is_collection(dtype) or isinstance(dtype, T.StructType)
        text = F.to_json(col(name)) if nested else col(name).cast("string")
        parts.append(F.coalesce(text, F.lit(NULL_TEXT)))
    return F.concat_ws(",", *parts)
