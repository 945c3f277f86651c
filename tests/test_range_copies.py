"""Copies of driver rows in range lookups: not broadcast by the size of the rows copied, few under an equality."""

import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F
from test_plans import plan, settings

from rowloom.functions.bins import Cuts, cuts
from rowloom.operators import ranges
from rowloom.operators.ranges import _reach, lookup_range


def test_many_copies_are_not_broadcast(spark):
    target = spark.range(5000).select((F.col("id") % 1000).alias("v"), "id")
    driver = spark.range(2000).select(F.col("id").alias("d"), (F.col("id") % 700).alias("lo"))
    got = lookup_range(driver, target, "v", "lo", F.col("lo") + 200, on={"id": "d"}, bins=1000)
    # about 200 copies of each driver row
    assert "BroadcastHashJoin" not in plan(got)
    want = sorted(i for i in range(2000) if i % 700 <= i % 1000 <= i % 700 + 200)
    assert sorted(r.id for r in got.collect()) == want
    few = lookup_range(driver.limit(20), target, "v", "lo", F.col("lo") + 200, bins=1000)
    assert "BroadcastHashJoin" in plan(few)


def test_bins_are_as_wide_as_bands_under_an_equality(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(30), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(90_000))) for _ in range(6000)]
    asked = [(rng.randrange(30), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(90_000))) for _ in range(300)]
    day = dt.timedelta(days=10)
    want = Counter(r for k, at in asked for r in rows if r[0] == k and at < r[1] < at + day)
    for kind in ("timestamp_ntz", "timestamp"):
        target = spark.createDataFrame(rows, "k int, at timestamp_ntz").withColumn("at", F.col("at").cast(kind))
        driver = spark.createDataFrame(asked, "k int, a timestamp_ntz").withColumn("a", F.col("a").cast(kind))
        until = F.col("a") + F.expr("INTERVAL 10 DAY")
        got = lookup_range(driver, target, "at", "a", until, on="k", inclusive="neither")
        assert Counter((r.k, r["at"]) for r in got.select("k", F.col("at").cast("timestamp_ntz").alias("at")).collect()) == want
        fine = cuts(target, F.col("at"), 1024)
        bands, reach = _reach(driver.withColumn("b", until), fine.bin(F.col("a")), fine.bin(F.col("b")), fine.count)
        coarse = fine.merged(-(-sum(reach) // bands))
        merged = _reach(driver.withColumn("b", until), coarse.bin(F.col("a")), coarse.bin(F.col("b")), coarse.count)
        assert bands == merged[0] == 300 and sum(reach) > 100 * 300 and sum(merged[1]) < 3 * 300


def test_reach_counts_bands_and_merged_bins_keep_common_values(spark):
    bands = spark.createDataFrame([(0, 2), (1, 1), (1, 4), (4, 4)], "a int, b int")
    assert _reach(bands, F.col("a"), F.col("b"), 5) == (4, [1, 3, 2, 1, 2])
    assert _reach(bands.limit(0), F.col("a"), F.col("b"), 2) == (0, [0, 0])
    one = Cuts((1.0, 2.0, 3.0, 4.0, 5.0, 6.0), (1, 1, 1, 9, 1, 1, 1), "double", 100)
    assert one.merged(1) == one
    assert one.merged(3) == Cuts((3.0, 4.0), (1, 3, 1), "double", 100)
    assert Cuts((), (1,), "double").merged(5) == Cuts((), (1,), "double")
    values = spark.createDataFrame([(float("nan"),), (float("inf"),), (-1e300,), (0.1 + 0.2,), (3.0,)], "v double")
    found = Cuts((-1e300, 0.1 + 0.2, float("inf"), float("nan")), (1,) * 5, "double")
    assert [r[0] for r in values.select(found.bin(F.col("v"))).collect()] == [4, 3, 1, 2, 2]


def test_many_pairs_fill_many_tasks(spark, monkeypatch):
    """Small tables with a large result are compared in as many tasks as it asks for, all alike."""
    monkeypatch.setattr(ranges, "TASK_PAIRS", 50_000, raising=False)
    target = spark.range(4000).select((F.col("id") % 1999).cast("double").alias("v"), "id")
    driver = spark.range(600).select((F.col("id") % 3).cast("double").alias("lo"))  # all in one corner
    with settings(spark, **{"spark.sql.adaptive.enabled": "true"}):
        got = lookup_range(driver, target, "v", "lo", F.col("lo") + 1000)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    want = sum(1 for d in range(600) for i in range(4000) if d % 3 <= i % 1999 <= d % 3 + 1000)
    assert sum(sizes) == want and len(sizes) >= 16 and max(sizes) < want / 4
    # the rows themselves, with a value that a third of the rows have
    target = target.withColumn("v", F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("v")))
    got = lookup_range(driver, target, "v", "lo", F.col("lo") + 50)
    values = [(7 if i % 3 == 0 else i % 1999, i) for i in range(4000)]
    want = Counter({i: n for v, i in values if (n := 200 * sum(d <= v <= d + 50 for d in range(3)))})
    assert Counter({r.id: r["count"] for r in got.groupBy("id").count().collect()}) == want


def test_bins_are_dealt_by_their_pairs(monkeypatch):
    monkeypatch.setattr(ranges, "TASK_PAIRS", 1000)
    even = Cuts((1.0, 2.0, 3.0), (1, 1, 2, 1), "double", 5 * 512)
    # 0, 2560, 5120 and 25 600 pairs over groups of 250; parts have 256 rows of 512 or 1024
    assert ranges._dealt(even, [0, 5, 5, 50]) == ([1, 2, 4, 2], [1, 6, 6, 52], 34)
    assert ranges._dealt(Cuts((), (1,), "double"), [7]) == ([1], [1], 0)


def test_repeats_of_a_row_stand_together(spark, monkeypatch, tmp_path):
    """What one target row returns to many bands comes in one run, so the written result takes little disk."""
    target = spark.range(6000).select((F.col("id") % 2999).cast("double").alias("v"), F.xxhash64("id").alias("id"))
    driver = spark.range(900).select(F.col("id").alias("d"), (F.col("id") * 3).cast("double").alias("lo"))
    driver = driver.repartition(3)
    want = Counter({i: n for i in range(6000) if (n := sum(3 * d <= i % 2999 <= 3 * d + 600 for d in range(900)))})
    for few, join in ((0, "SortMergeJoin"), (1_000_000, "BroadcastHashJoin")):
        monkeypatch.setattr(ranges, "FEW_COPIES", few)
        got = lookup_range(driver, target, "v", "lo", F.col("lo") + 600, bins=16)
        assert join in plan(got)
        ids = [r.id for r in got.select("id").collect()]
        assert sum(a != b for a, b in zip(ids, ids[1:])) + 1 == len(set(ids)) == len(want)
        assert sorted(Counter(ids).values()) == sorted(want.values())
        got.write.parquet(path := str(tmp_path / join))
        # 0.9 million rows of 16 bytes
        assert sum(p.stat().st_size for p in (tmp_path / join).glob("*.parquet")) < 300_000
        assert spark.read.parquet(path).count() == sum(want.values())


def test_held_bands_are_dealt(spark, monkeypatch):
    """Few target rows and many bands: these are not held all at once, and each is compared once."""
    assert ranges._dealt(Cuts((), (1,), "double", 1), [10 * ranges.HELD_BANDS]) == ([1], [10], 1)
    monkeypatch.setattr(ranges, "HELD_BANDS", 50)
    target = spark.createDataFrame([(v, i) for i, v in enumerate([1.0, 2.0, 2.0, 7.0, None])], "v double, id int")
    driver = spark.range(0, 1000, 1, 3).select((F.col("id") % 5).cast("double").alias("lo"))
    for few in (0, 1_000_000):
        monkeypatch.setattr(ranges, "FEW_COPIES", few)
        got = lookup_range(driver, target, "v", "lo", F.col("lo") + 3, inclusive="low")
        assert "_tile" in plan(got)
        # 7 lies in the band from 4 to below 7 no more
        assert Counter(r.id for r in got.collect()) == {0: 400, 1: 600, 2: 600}
