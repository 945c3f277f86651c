"""The stream of accepted writes: late ones lose, restarts keep state, expiries follow the watermark."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from test_plans import settings

from rowloom.streaming.changes import STATE_STORE, stream_changes

SCHEMA = "k bigint, v string, n decimal(20,4), _at bigint, ts timestamp"
ROCKS = {"spark.sql.streaming.stateStore.providerClass": STATE_STORE}


def stamp(second):
    return dt.datetime.fromtimestamp(1_700_000_000 + second, dt.timezone.utc)


def feed(spark, path, *batches):
    for rows in batches:
        data = [(k, v, None, at, stamp(at)) for k, v, at in rows]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def go(spark, path, **options):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    with settings(spark, **ROCKS):
        found = stream_changes(stream, "k", event_time="ts", written_at=F.col("_at"), **options)
        writer = found.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/progress")
        writer.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{path}/out").collect()
    return sorted((r.k, r._writetime, r._change, r.v) for r in rows)


def test_late_writes_are_no_changes(spark, tmp_path):
    feed(spark, f"{tmp_path}/in", [(1, "a", 5), (1, "older", 3), (2, "b", 1), (None, "no key", 9)], [(1, "late", 4), (2, "c", 2)])
    want = [(1, 5, "put", "a"), (2, 1, "put", "b"), (2, 2, "put", "c")]
    assert go(spark, tmp_path) == want
    # a restart goes on from the state
    feed(spark, f"{tmp_path}/in", [(1, "again late", 4), (1, "new", 6), (2, None, 1)])
    assert go(spark, tmp_path) == sorted([*want, (1, 6, "put", "new")])


def test_changes_are_the_running_maximum(spark, tmp_path):
    """Many rows of one key in one batch are one change; ties fall to seq alike in any order."""
    rng = random.Random(3)
    batches = [[(rng.choice([1, 1, 1, 2, 3]), f"{b}-{i}", rng.randrange(50)) for i in range(60)] for b in range(3)]
    feed(spark, f"{tmp_path}/in", *batches)
    got = go(spark, tmp_path, seq=F.crc32(F.col("v").cast("binary")))
    import zlib

    best, want = {}, []
    for rows in batches:
        new = dict(best)
        for k, v, at in rows:
            new[k] = max(new.get(k, (-1,)), (at, zlib.crc32(v.encode()), v))
        want += [(k, s[0], "put", s[2]) for k, s in new.items() if best.get(k) != s]
        best = new
    assert got == sorted(want)


def test_expiries_follow_the_watermark(spark, tmp_path):
    feed(spark, f"{tmp_path}/in", [(1, "a", 0), (2, "b", 0)], [(2, "c", 50)], [(9, "x", 200)], [(9, "y", 201)], [(1, "too late", -5)])
    got = go(spark, tmp_path, ttl=100, late="1 second")
    assert (1, 0, "expire", None) in got and (2, 50, "expire", None) in got
    # the write that 2 replaced expires nothing, and a late write of 1 does not come back
    assert [g for g in got if g[2] == "expire" and g[0] == 2] == [(2, 50, "expire", None)]
    assert not any(g[3] == "too late" for g in got)


def test_values_come_through_whole(spark, tmp_path):
    schema = "k string, a decimal(38,18), b double, c timestamp, d binary, e date, f boolean, g timestamp_ntz, h array<int>, ts timestamp"
    from decimal import Decimal

    row = ('a"b', Decimal("-12345678901234567890.123456789012345678"), 0.1 + 0.2, stamp(1.000001), bytearray(b"\x00\xff"),
           dt.date(1969, 1, 2), True, dt.datetime(2024, 1, 2, 3, 4, 5, 678901), [1, None], stamp(2))
    rows = [row, ("none", *[None] * 8, stamp(3))]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    with settings(spark, **ROCKS):
        found = stream_changes(stream, "k", event_time="ts", written_at=F.unix_micros("ts"))
        writer = found.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/p")
        writer.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(found.schema).parquet(f"{tmp_path}/out").drop("_change", "_writetime")
    want = spark.read.parquet(f"{tmp_path}/in")
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_what_it_needs(spark, tmp_path):
    still = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        stream_changes(still, "k", event_time="ts", written_at=F.col("_at"))
    feed(spark, f"{tmp_path}/in", [(1, "a", 1)])
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
    with pytest.raises(RuntimeError):
        stream_changes(stream, "k", event_time="ts", written_at=F.col("_at"))


def test_keys_of_a_slot_are_handled_together(spark, tmp_path):
    """One slot for all keys gives the changes and expiries that a slot a key gives."""
    rng = random.Random(5)
    batches = [[(rng.randrange(8), f"{b}-{i}", 40 * b + rng.randrange(60)) for i in range(40)] for b in range(4)]
    got = {}
    for slots in (1, 3, 1 << 16):
        path = f"{tmp_path}/{slots}"
        feed(spark, f"{path}/in", *batches, [(99, "end", 1000)], [(99, "after", 1001)])
        got[slots] = go(spark, path, ttl=30, late="100 seconds", seq=F.crc32(F.col("v").cast("binary")), slots=slots)
    assert got[1] == got[3] == got[1 << 16]
    last = {k: max(at for b in batches for key, _, at in b if key == k) for k in range(8)}
    assert [(k, at) for k, at, change, _ in got[1] if change == "expire" and at == last[k]] == sorted(last.items())
    # calls follow the slots, not the keys
    wide = [[(k, "x", b) for k in range(500)] for b in range(2)]
    feed(spark, f"{tmp_path}/wide/in", *wide)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/wide/in")
    with settings(spark, **ROCKS):
        found = stream_changes(stream, "k", event_time="ts", written_at=F.col("_at"), slots=5)
        writer = found.writeStream.format("parquet").option("path", f"{tmp_path}/wide/out")
        query = writer.option("checkpointLocation", f"{tmp_path}/wide/p").trigger(availableNow=True).start()
        query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 5
    assert spark.read.parquet(f"{tmp_path}/wide/out").count() == 1000
