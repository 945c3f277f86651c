"""Streams give what the batch operators give, also when a batch is run again."""

import pytest
from conftest import SF
from pyspark.sql import functions as F

from catalog.common import table
from rowloom.plans.load import load_table, loads, read_live
from rowloom.streaming.jobs import stream_lookup, stream_upsert


def files(spark, path, batches):
    for i, data in enumerate(batches):
        spark.createDataFrame(data, "k bigint, v string, at bigint").coalesce(1).write.mode(
            "append"
        ).parquet(f"{path}/in")


def upsert(spark, path, name):
    stream = (
        spark.readStream.schema("k bigint, v string, at bigint")
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{path}/in")
    )
    stream_upsert(
        stream, name, "k", f"{path}/progress", "feed",
        nulls="overwrite", rejects=f"{path}/rejects", create=True, written_at=F.col("at"),
    ).awaitTermination()


def test_stream_upsert_late_rows_and_restart(spark, tmp_path, table_name):
    files(spark, tmp_path, [[(1, "new", 5), (2, "x", 1)], [(1, "late", 3), (None, "bad", 9)]])
    upsert(spark, tmp_path, table_name)
    want = [(1, "new", 5), (2, "x", 1)]
    assert sorted(tuple(r) for r in read_live(spark, table_name).collect()) == want
    files(spark, tmp_path, [[(2, "y", 2)]])
    upsert(spark, tmp_path, table_name)
    want[1] = (2, "y", 2)
    assert sorted(tuple(r) for r in read_live(spark, table_name).collect()) == want
    ids = sorted(loads(spark, table_name))
    assert [i.rsplit("-", 1)[1] for i in ids] == ["0", "1", "2"]
    again = spark.createDataFrame([(2, "y", 2)], "k bigint, v string, at bigint")
    load_table(table_name, again, "k", nulls="overwrite", written_at=F.col("at"), load_id=ids[2])
    assert sorted(tuple(r) for r in read_live(spark, table_name).collect()) == want
    rejects = spark.read.parquet(f"{tmp_path}/rejects")
    assert [(r.k, r.v, r.batch) for r in rejects.collect()] == [(None, "bad", 1)]


def test_another_checkpoint_of_the_same_name_adds_rows(spark, tmp_path, table_name):
    for i, row in enumerate([(1, "x", 1), (2, "y", 1)]):
        files(spark, f"{tmp_path}/{i}", [[row, (None, "bad", i)]])
        upsert(spark, f"{tmp_path}/{i}", table_name)
    assert sorted(tuple(r) for r in read_live(spark, table_name).collect()) == [(1, "x", 1), (2, "y", 1)]


def test_stream_upsert_does_not_truncate(spark):
    with pytest.raises(ValueError):
        stream_upsert(None, "t", "k", "c", "n", nulls="overwrite", rejects="r", truncate=True)


def test_stream_lookup_needs_a_stream(spark):
    orders = table(spark, SF, "orders")
    with pytest.raises(ValueError):
        stream_lookup(orders, orders, "o_custkey")
