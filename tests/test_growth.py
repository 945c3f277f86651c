"""Tables that grow: buckets split without a shuffle, loads folded, expired writes purged."""

import glob
import re

import pytest
from pyspark.sql import functions as F
from test_plans import plan, settings

from rowloom.plans import load
from rowloom.plans.load import (
    compact_table,
    create_table,
    fold_loads,
    load_table,
    loads,
    read_live,
    table_info,
)
from rowloom.streaming.jobs import stream_upsert

SCHEMA = "k bigint, a string, b bigint"


def rows(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def live(spark, name, **options):
    return sorted(tuple(r) for r in read_live(spark, name, **options).collect())


def versions(spark, name, buckets=3):
    """Two loads of whole rows, the second over the first."""
    load_table(name, rows(spark, [(i, "old", i) for i in range(100)]), "k", nulls="overwrite", create=True,
               buckets=buckets, written_at=F.lit(1), properties={"team": "sales"})
    load_table(name, rows(spark, [(i, "new", i) for i in range(50, 120)]), "k", nulls="overwrite", written_at=F.lit(2))
    return sorted([(i, "old", i) for i in range(50)] + [(i, "new", i) for i in range(50, 120)])


def test_buckets_split_and_everything_goes_on(spark, table_name):
    want = versions(spark, table_name)
    compact_table(spark, table_name, buckets=6)
    assert live(spark, table_name) == want
    info = table_info(spark, table_name)
    assert (info.buckets, len(loads(spark, table_name))) == (6, 1)
    first = info.name
    # a second split, from another table than the named one
    compact_table(spark, table_name, buckets=12)
    info = table_info(spark, table_name)
    assert info.buckets == 12 and info.name != first and not spark.catalog.tableExists(first)
    assert live(spark, table_name) == want
    assert load._properties(spark, info.name)["team"] == "sales"
    # loads, replays, evolving, truncating
    more = rows(spark, [(7, "x", 1, 2.5)], SCHEMA + ", c double")
    for _ in range(2):
        load_table(table_name, more, "k", nulls="ignore", evolve=True, load_id="again", written_at=F.lit(3))
    assert read_live(spark, table_name).where("k = 7").first().c == 2.5
    assert len(loads(spark, table_name)) == 2
    load_table(table_name, more, "k", nulls="overwrite", truncate=True)
    assert live(spark, table_name) == [(7, "x", 1, 2.5)]


def test_rows_of_a_split_bucket_stay_in_their_task(spark, table_name):
    """Old bucket b becomes b and b + 3; nothing is exchanged on the way."""
    versions(spark, table_name)
    info = table_info(spark, table_name)
    log = load._log(spark, info.name, load._attempts(spark, info.name)).drop(load.LOAD)
    assert "Exchange" not in plan(load._reconciled(log, info, 2)[0])
    old = {r.k: r.b for r in spark.table(info.name).select("k", F.expr("pmod(hash(k), 3)").alias("b")).collect()}
    compact_table(spark, table_name, buckets=6)
    held = spark.table(table_info(spark, table_name).name)
    for r in held.select("k", F.input_file_name().alias("f")).collect():
        bucket = int(re.search(r"_(\d{5})\.c", r.f)[1])
        assert bucket % 3 == old[r.k]


def test_other_bucket_counts_are_refused(spark, table_name):
    versions(spark, table_name)
    for buckets in (2, 4):
        with pytest.raises(ValueError):
            compact_table(spark, table_name, buckets=buckets)


@pytest.mark.parametrize("nulls", ["overwrite", "ignore"])
def test_partial_rows_survive_a_split(spark, table_name, nulls):
    create_table(spark, table_name, rows(spark, [], SCHEMA).schema, "k", buckets=2)
    load_table(table_name, rows(spark, [(1, "a", 1), (2, "b", 2)]), "k", nulls="overwrite", written_at=F.lit(1))
    part = rows(spark, [(1, None), (3, "c")], "k bigint, a string")
    load_table(table_name, part, "k", nulls=nulls, written_at=F.lit(2))
    before = sorted(map(str, live(spark, table_name)))
    compact_table(spark, table_name, buckets=8)
    assert sorted(map(str, live(spark, table_name))) == before


def test_a_load_shuffles_once_whatever_the_buckets(spark, table_name, monkeypatch):
    seen = []
    publish = load._publish

    def spy(spark_, table, log, attempt):
        seen.append(plan(log))
        publish(spark_, table, log, attempt)

    monkeypatch.setattr(load, "_publish", spy)
    with settings(spark, **{"spark.sql.adaptive.enabled": "false"}):
        versions(spark, table_name, buckets=7)
        load_table(table_name, rows(spark, [(1, None, 2)]), "k", nulls="ignore")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert [len(re.findall(r"Exchange hashpartitioning\(k#\d+L?, 7\)", p)) for p in seen] == [1, 1, 1]
    assert [p.count("Exchange") for p in seen] == [1, 1, 1]
    path = spark.sql(f"DESCRIBE FORMATTED {table_name}").where("col_name = 'Location'").first().data_type
    for part in glob.glob(path.removeprefix("file:") + "/_load=*"):
        buckets = [re.search(r"_(\d{5})\.c", f)[1] for f in glob.glob(part + "/*.parquet")]
        assert len(buckets) == len(set(buckets))


def test_loads_fold_in_tiers(spark, table_name):
    want = {}
    for i in range(9):
        data = [(k, f"{i}", i) for k in range(i % 3, 6)]
        load_table(table_name, rows(spark, data), "k", nulls="overwrite", create=True, written_at=F.lit(i + 1), load_id=f"n{i}")
        want |= {k: (k, a, b) for k, a, b in data}
        left = fold_loads(spark, table_name, fanout=2, keep=[f"n{i}"])
        assert f"n{i}" in left and len(left) <= 1 + (i + 1).bit_length()
        assert live(spark, table_name) == sorted(want.values())
    with pytest.raises(ValueError):
        fold_loads(spark, table_name, fanout=1)


def test_a_long_stream_leaves_few_loads(spark, tmp_path, table_name):
    """32 micro-batches; the newest write of every key stays."""
    for i in range(32):
        rows(spark, [(i % 10, f"v{i}", i)]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    with settings(spark, **{"spark.sql.shuffle.partitions": "1"}):
        stream_upsert(
            stream, table_name, "k", f"{tmp_path}/progress", "feed", nulls="overwrite",
            rejects=f"{tmp_path}/rejects", create=True, written_at=F.col("b"), fold=4,
        ).awaitTermination()
    assert len(loads(spark, table_name)) <= 1 + 3 * 3
    assert live(spark, table_name) == [(k, f"v{i}", i) for k, i in enumerate([30, 31, 22, 23, 24, 25, 26, 27, 28, 29])]


def second(n):
    return F.timestamp_seconds(F.lit(n))


def test_purged_writes_uncover_nothing(spark, table_name):
    """An expired write goes with all it hid; what is unexpired stays as it reads."""
    create_table(spark, table_name, rows(spark, [], SCHEMA).schema, "k")
    million = 1_000_000
    forever = [(1, "old", 1), (2, "old", 2), (3, "old", 3), (4, "old", 4)]
    load_table(table_name, rows(spark, forever), "k", nulls="overwrite", written_at=F.lit(million))
    short = rows(spark, [(1, "short", 9), (2, "short", 9)])
    load_table(table_name, short, "k", nulls="overwrite", written_at=F.lit(2 * million), ttl=10)
    cell = rows(spark, [(3, "cell"), (4, None)], "k bigint, a string")
    load_table(table_name, cell, "k", nulls="overwrite", written_at=F.lit(2 * million), ttl=10)
    later = rows(spark, [(2, 77)], "k bigint, b bigint")
    load_table(table_name, later, "k", nulls="ignore", written_at=F.lit(3 * million), ttl=1000)
    for now in (5, 50):
        before = sorted(map(str, live(spark, table_name, as_of=second(now))))
        compact_table(spark, table_name, purge=second(now))
        assert sorted(map(str, live(spark, table_name, as_of=second(now)))) == before
    assert sorted(map(str, live(spark, table_name))) == before
    assert before == ["(2, None, 77)", "(3, None, 3)", "(4, None, 4)"]


def test_random_logs_read_alike_after_purging(spark, table_name):
    import random

    rng = random.Random(5)
    create_table(spark, table_name, rows(spark, [], SCHEMA).schema, "k")
    for at in range(1, 9):
        data = [(k, rng.choice([None, "x", "y"]), rng.choice([None, 1, 2])) for k in rng.sample(range(12), 6)]
        column = rng.choice([["k", "a", "b"], ["k", "a"], ["k", "b"]])
        load_table(
            table_name, rows(spark, data).select(*column), "k", nulls=rng.choice(["overwrite", "ignore"]),
            written_at=F.lit(at * 1_000_000), ttl=rng.choice([None, 5, 20]),
        )
    want = sorted(map(str, live(spark, table_name, as_of=second(12))))
    later = sorted(map(str, live(spark, table_name, as_of=second(22))))
    compact_table(spark, table_name, purge=second(12))
    assert sorted(map(str, live(spark, table_name, as_of=second(12)))) == want
    assert sorted(map(str, live(spark, table_name))) == want
    assert sorted(map(str, live(spark, table_name, as_of=second(22)))) == later


def test_the_report_is_that_of_the_checked_copy(spark, table_name, tmp_path):
    create_table(spark, table_name, rows(spark, [], SCHEMA).schema, "k")
    data = rows(spark, [(1, "a", "1"), (None, "b", "2"), (3, "c", "x")], "k bigint, a string, b string")
    found = load_table(table_name, data, "k", nulls="overwrite", rejects_path=f"{tmp_path}/rejects")
    assert found.report == found.recount.first().asDict()
    assert found.report == {"rows_read": 3, "rows_written": 1, "rows_rejected": 2, "errors": 2}
