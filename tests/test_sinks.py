"""Sinks whose tasks and micro-batches run again: nothing counted or refused twice."""

import json
import os
import subprocess
import sys

import pytest
from conftest import SF
from pyspark.sql import functions as F

from catalog.common import table
from rowloom.operators.batches import sink_batches, write_batches
from rowloom.plans.load import compact_table, load_table, pin, read_live
from rowloom.streaming import jobs
from rowloom.streaming.jobs import stream_lookup_table, stream_sink_batches

RETRIED = r"""
import json, os, sys
sys.path[:0] = [{repo!r}, {tests!r}]
from pyspark import TaskContext
from pyspark.sql import functions as F
from rowloom import build_session
from rowloom.operators.batches import sink_batches
from rowloom.plans.load import create_table, load_table, read_live
root = {root!r}
spark = build_session("retried", "local[2,3]", **{{
    "spark.sql.shuffle.partitions": 3, "spark.checkpoint.dir": root + "/scratch", "spark.ui.enabled": "false",
    "spark.sql.warehouse.dir": root + "/warehouse", "spark.ui.showConsoleProgress": "false"}})
spark.sparkContext.setLogLevel("OFF")
rows = spark.range(1000).repartition(5).select("id", F.concat("id", F.when(F.col("id") % 10 == 0, "x").otherwise("")).alias("v"))

def send(batch, name):
    # every first attempt fails once it has sent some of its rows
    with open(root + "/requests", "a") as f:
        f.write(json.dumps([name, [r["id"] for r in batch]]) + "\n")
    if TaskContext.get().attemptNumber() == 0 and int(name.rsplit("/", 1)[1].split("-")[0]) >= 100:
        os._exit(1)
    [int(r["v"]) for r in batch]

found = sink_batches(rows, send, root + "/refused", batch_size=50, run="r1")
out = {{"sink": [found.rows, found.refused, sorted(r.id for r in found.rejects.collect())]}}

def fail_first(batches):
    for k, b in enumerate(batches):
        yield b
    if TaskContext.get().attemptNumber() == 0 and not os.path.exists(root + f"/met-{{TaskContext.get().partitionId()}}"):
        open(root + f"/met-{{TaskContext.get().partitionId()}}", "w").close()
        os._exit(1)

name = "t"
create_table(spark, name, spark.createDataFrame([], "id bigint, v bigint").schema, "id")
flaky = rows.mapInArrow(fail_first, rows.schema)
result = load_table(name, flaky, "id", nulls="overwrite", rejects_path=root + "/rejects")
out["report"] = result.report
out["rejects"] = [result.rejects.count(), spark.read.parquet(root + "/rejects").count(), read_live(spark, name).count()]
print("RESULT " + json.dumps(out))
"""


def test_tasks_that_run_again_count_once(tmp_path):
    """First attempts die after sending or counting rows; what is committed is whole and exact."""
    tests = os.path.dirname(os.path.abspath(__file__))
    code = RETRIED.format(repo=os.path.dirname(tests), tests=tests, root=str(tmp_path))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=tmp_path)
    line = [x for x in done.stdout.splitlines() if x.startswith("RESULT ")]
    assert line, done.stderr[-2000:]
    out = json.loads(line[0][7:])
    assert out["sink"] == [1000, 100, list(range(0, 1000, 10))]
    assert out["report"] == {"rows_read": 1000, "rows_written": 900, "rows_rejected": 100, "errors": 100}
    assert out["rejects"] == [100, 100, 900]
    sent = {}
    repeats = 0
    for text in open(f"{tmp_path}/requests"):
        name, ids = json.loads(text)
        # a request that comes again holds the same rows
        repeats += name in sent
        assert sent.setdefault(name, ids) == ids
    assert repeats and {i for ids in sent.values() for i in ids} == set(range(1000))


def test_sinks_name_requests_and_take_empty_input(spark, tmp_path):
    names = f"{tmp_path}/names"

    def send(rows, name):
        with open(names, "a") as f:
            f.write(f"{name} {len(rows)}\n")
        if any(r["id"] == 3 for r in rows):
            raise ValueError("three")

    df = spark.range(0, 12, 1, 1)
    found = sink_batches(df, send, f"{tmp_path}/refused", batch_size=8, sub_batch_size=4, run="a")
    assert (found.rows, found.refused) == (12, 1)
    assert [(r.id, r._err_desc) for r in found.rejects.collect()] == [(3, "three")]
    assert sorted(x.split()[0] for x in open(names)) == sorted(
        f"a/0/{p}" for p in ("0-7", "0-3", "4-7", "0-0", "1-1", "2-2", "3-3", "8-11")
    )
    none = sink_batches(df.limit(0), send, f"{tmp_path}/none", run="b")
    assert (none.rows, none.refused, none.rejects.count()) == (0, 0, 0)
    assert none.rejects.columns == write_batches(df, send).columns


def stream_of(spark, path):
    return spark.readStream.schema("k bigint").option("maxFilesPerTrigger", 1).parquet(path)


def feed(spark, path, *batches):
    for keys in batches:
        spark.createDataFrame([(k,) for k in keys], "k bigint").coalesce(1).write.mode("append").parquet(path)


def test_a_repeated_micro_batch_names_its_requests_alike(spark, tmp_path, monkeypatch):
    log, fail = f"{tmp_path}/log", []

    def send(rows, name):
        with open(log, "a") as f:
            f.write(f"{name}={[r['k'] for r in rows]}\n")
        [1 // r["k"] for r in rows]

    inner = jobs.sink_batches

    def once(*args, **options):
        found = inner(*args, **options)
        if not fail:
            fail.append(1)
            raise RuntimeError("the driver is lost before the batch is committed")
        return found

    monkeypatch.setattr(jobs, "sink_batches", once)
    feed(spark, f"{tmp_path}/in", [1, 0, 2])
    where = (f"{tmp_path}/progress", f"{tmp_path}/refused")
    with pytest.raises(Exception, match="driver is lost"):
        stream_sink_batches(stream_of(spark, f"{tmp_path}/in"), send, *where).awaitTermination()
    stream_sink_batches(stream_of(spark, f"{tmp_path}/in"), send, *where).awaitTermination()
    lines = open(log).read().splitlines()
    half = len(lines) // 2
    assert lines[:half] == lines[half:] and half
    refused = spark.read.parquet(where[1]).where("_kind = 'refused'")
    assert [(r.k, r.batch) for r in refused.collect()] == [(0, 0)]


def test_a_replayed_lookup_reads_the_state_of_its_batch(spark, tmp_path, table_name, monkeypatch):
    def put(v, at):
        rows = spark.createDataFrame([(1, v), (2, v)], "k bigint, v string")
        load_table(table_name, rows, "k", nulls="overwrite", create=True, written_at=F.lit(at))

    put("first", 1)
    feed(spark, f"{tmp_path}/in", [1])
    inner, seen = jobs.lookup, []

    def lost(*args):
        if not seen:
            seen.append(1)
            raise RuntimeError("lost before the batch is committed")
        return inner(*args)

    def go():
        stream_lookup_table(
            stream_of(spark, f"{tmp_path}/in"), table_name, "k", f"{tmp_path}/progress", f"{tmp_path}/out", pins=f"{tmp_path}/pins"
        ).awaitTermination()

    monkeypatch.setattr(jobs, "lookup", lost)
    with pytest.raises(Exception, match="lost before"):
        go()
    put("second", 2)
    feed(spark, f"{tmp_path}/in", [2, 3])
    go()
    found = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((r.batch, r.k, r.v) for r in found.collect()) == [(0, 1, "first"), (1, 2, "second")]


def test_pins_end_with_their_partitions(spark, table_name):
    orders = table(spark, SF, "orders").select("o_orderkey", "o_custkey")
    load_table(table_name, orders, "o_orderkey", nulls="overwrite", create=True)
    state = pin(spark, table_name)
    load_table(table_name, orders.limit(5).withColumn("o_custkey", F.lit(-1)), "o_orderkey", nulls="overwrite")
    assert read_live(spark, table_name, pinned=state).where("o_custkey = -1").count() == 0
    assert read_live(spark, table_name).where("o_custkey = -1").count() == 5
    compact_table(spark, table_name)
    with pytest.raises(LookupError):
        read_live(spark, table_name, pinned=state)
