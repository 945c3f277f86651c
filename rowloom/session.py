"""Session defaults and scratch space."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "rowloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every operator expects (UTC, ANSI, AQE)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call sites in error messages cost more than building the plan itself
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, str(value))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``.

    Executors on other machines must see the path, so the session never picks one itself.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value) -> Iterator[None]:
    """A session setting for the length of a block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def ship(module: str) -> None:
    """Send this module's functions with the tasks that use them, so that executors need
    no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def stage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once to ``path`` (default: scratch) and return it read back.

    The returned frame has no lineage to recompute, so values that depend on
    how tasks were laid out stay the same when executors are lost.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
