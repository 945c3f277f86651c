"""Registry and helpers of the query catalog."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rowloom.functions.types import col
from rowloom.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL that gives the same rows."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the tables' timestamps have no zone and are meant as UTC
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local["):
                # trial runs in one process may do without a shared folder
                spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
            return without_zone(fn(spark, sf_dir))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as the given tables store them (no zone)."""
    zoned = {f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)}
    if not zoned:
        return df
    return df.select(
        *[(col(c).cast("timestamp_ntz").alias(c) if c in zoned else col(c)) for c in df.columns]
    )
