"""Unwinding of collection columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.types import col, is_collection


def expand_collection(df: DataFrame, column: str | None = None) -> DataFrame:
    """One row per element of a collection, in place; other columns repeat.

    Without ``column`` the first collection is taken. A map gives its keys. A
    null or empty collection gives one row with null. Further collections are
    handed on as JSON text; a further map whose keys are not text is an error.
    """
    collections = [f for f in df.schema if is_collection(f.dataType)]
    if column is not None:
        chosen = df.schema[column]
        if not is_collection(chosen.dataType):
            raise TypeError(f"{column} is not a collection")
    elif collections:
        chosen = collections[0]
    else:
        return df
    out = []
    for f in df.schema:
        c = col(f.name)
        if f.name == chosen.name:
            elements = F.map_keys(c) if isinstance(f.dataType, T.MapType) else c
            out.append(F.explode_outer(elements).alias(f.name))
        elif is_collection(f.dataType):
            if isinstance(f.dataType, T.MapType) and not isinstance(
                f.dataType.keyType, T.StringType
            ):
                raise TypeError(f"cannot hand on {f.name}: further collections must read as text")
            out.append(F.to_json(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)
