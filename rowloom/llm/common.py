"""What the operators of this subpackage share: inputs, words, shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The word of the contracts (everything but ASCII white space), as a Java and
# Python pattern. ``bytes.split()`` and ``bytes.lower()`` follow the same ASCII rules.
WORD = r"[^\x20\x09-\x0D]+"

_BELOW: ContextVar[str | None] = ContextVar("scratch below", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below ``spark.checkpoint.dir``, which all executors share.

    Only a local session that does not set it (as in tests) gets a temporary folder.
    """
    if _BELOW.get():
        return f"{_BELOW.get()}/{label}-{uuid.uuid4().hex}"
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch path that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_for(spark: SparkSession, label: str) -> Iterator[None]:
    """Inside, scratch paths lie below one folder, which goes at the end: all results that
    read it must be written by then."""
    path = scratch(spark, label)
    token = _BELOW.set(path)
    try:
        yield
    finally:
        _BELOW.reset(token)
        discard(spark, path)


def bounded(fn):
    """A query or stage whose session sends Python workers a few megabytes at a time, not
    thousands of rows: documents differ too much in length for a count of rows."""

    @wraps(fn)
    def run(spark: SparkSession, *args):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
        return fn(spark, *args)

    return run


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to shared scratch and read back: no lineage, stable values."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_bytes(name: str) -> Column:
    """The whole text as UTF-8 bytes; a null text is empty."""
    return F.coalesce(quoted(name).cast("string"), F.lit("")).cast("binary")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, *names: str) -> list[Column]:
    """The columns of ``df`` but those of these names, in any case."""
    out = {n.lower() for n in names}
    return [quoted(c) for c in df.columns if c.lower() not in out]


def fold(id_col: Column, parts: int) -> Column:
    """crc32 of the id's text, modulo ``parts``; the fold of a null id is null."""
    return F.crc32(id_col.cast("string").cast("binary")) % parts
