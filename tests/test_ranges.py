"""Range and as-of lookups against plain loops; hot values and keys spread over tasks."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_plans import plan, settings

from rowloom.functions.bins import Cuts, cuts
from rowloom.operators.lookup import lookup_limit
from rowloom.operators.ranges import lookup_as_of, lookup_range


def counted(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def values(spark):
    """A value that a third of the rows have, exact copies, nulls, columns named like helpers."""
    rng = random.Random(1)
    rows = [(5.0, "hot", 1)] * 300 + [(rng.choice([None, rng.uniform(-50, 50)]), f"r{i}", i % 3) for i in range(600)]
    return rows, spark.createDataFrame(rows, "v double, _bin string, _part int").repartition(5)


@pytest.mark.parametrize("inclusive", ["both", "low", "high", "neither"])
@pytest.mark.parametrize("bins", [1, 7, 64])
def test_bands_match_a_loop(spark, values, inclusive, bins):
    rows, target = values
    rng = random.Random(bins)
    bands = [(None, 1.0, 1), (1.0, None, 1), (9.0, 3.0, 1), (5.0, 5.0, 1), (-100.0, 100.0, 0), (-100.0, 100.0, 0)]
    bands += [(a, a + rng.uniform(0, 30), rng.randrange(3)) for a in (rng.uniform(-60, 60) for _ in range(20))]
    driver = spark.createDataFrame(bands, "lo double, hi double, _bin int")
    low = lambda v, lo: v >= lo if inclusive in ("both", "low") else v > lo
    high = lambda v, hi: v <= hi if inclusive in ("both", "high") else v < hi
    known = [r for r in rows if r[0] is not None]
    whole = [(lo, hi, k) for lo, hi, k in bands if lo is not None and hi is not None]
    want = Counter(r for lo, hi, _ in whole for r in known if low(r[0], lo) and high(r[0], hi))
    assert counted(lookup_range(driver, target, "v", "lo", "hi", inclusive=inclusive, bins=bins)) == want
    want = Counter(r for lo, hi, _ in bands if lo is not None for r in known if low(r[0], lo))
    assert counted(lookup_range(driver, target, "v", low="lo", inclusive=inclusive, bins=bins)) == want
    want = Counter(r for lo, hi, k in whole for r in known if low(r[0], lo) and high(r[0], hi) and r[2] == k and r[1] != "hot")
    got = lookup_range(
        driver, target, "v", "lo", "hi", on={"_part": "_bin"}, where=F.col("t._bin") != "hot", inclusive=inclusive, bins=bins
    )
    assert counted(got) == want


def test_other_orders_and_empty_tables(spark):
    days = spark.createDataFrame([(f"2024-01-{d:02}",) for d in range(1, 29)], "d string").select(F.to_date("d").alias("d"))
    driver = spark.createDataFrame([("2024-01-05", "2024-01-07")], "a string, b string").select(F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    assert lookup_range(driver, days, "d", "a", "b").count() == 3
    stamps = days.select(F.to_timestamp("d").alias("d"))
    assert lookup_range(driver, stamps, "d", "a", "b", inclusive="low").count() == 2
    for empty in (lookup_range(driver, days.limit(0), "d", "a", "b"), lookup_range(driver.limit(0), days, "d", "a", "b")):
        assert empty.columns == ["d"] and empty.count() == 0
    with pytest.raises(ValueError):
        lookup_range(driver, days, "d")
    with pytest.raises(ValueError):
        lookup_range(driver, days, "d", "a", inclusive="all")


def test_bins_are_even_and_common_values_weigh_more(spark, values):
    rows, target = values
    found = cuts(target, F.col("v"), 20)
    known = sorted(r[0] for r in rows if r[0] is not None)
    assert sum(found.weights) == 20
    got = target.dropna().groupBy(found.bin(F.col("v")).alias("b")).count().collect()
    for r in got:
        assert r["count"] <= 2 * len(known) / 20 * found.weights[r.b]
    hot = max(range(found.count), key=lambda b: found.weights[b])
    assert found.values[hot - 1] == 5.0 and found.weights[hot] >= 5
    assert Cuts((), (1,), "double").count == 1


def test_a_hot_value_is_dealt_to_many_tasks(spark, values):
    _, target = values
    driver = spark.createDataFrame([(4.0, 6.0)], "lo double, hi double")
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "20"}
    with settings(spark, **off):
        got = lookup_range(driver, target, "v", "lo", "hi", bins=20)
        assert "SortMergeJoin" in plan(got)
        sizes = [r["count"] for r in got.where("v = 5").groupBy(F.spark_partition_id()).count().collect()]
    # exact copies go by the task they come from, of which there are five
    assert len(sizes) >= 3 and max(sizes) <= 200


def brute_nearest(driver, target, n, direction, exact):
    out = Counter()
    for key, at in driver:
        if key is None or at is None:
            continue
        before = direction == "before"
        own = [r for r in target if r[0] == key and r[1] is not None and (r[1] < at if before else r[1] > at) | (exact and r[1] == at)]
        own.sort(key=lambda r: (r[1], r[2]), reverse=before)
        out.update(own[:n])
    return out


@pytest.mark.parametrize("direction, exact", [("before", True), ("before", False), ("after", True), ("after", False)])
@pytest.mark.parametrize("n, slices", [(1, 1), (3, 8), (40, 30)])
def test_nearest_rows_match_a_loop(spark, direction, exact, n, slices):
    rng = random.Random(n)
    # a key that most rows have, times that repeat, nulls
    target = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, *range(60)]), i) for i in range(700)]
    driver = [(rng.choice([1, 1, 2, 3, 4, None]), rng.choice([None, *range(-3, 64)])) for _ in range(150)]
    t = spark.createDataFrame(target, "k int, at int, _nth int").repartition(4)
    d = spark.createDataFrame(driver, "user int, at int")
    got = lookup_as_of(
        d, t, {"k": "user"}, {"at": "at"}, n, order_by=[F.col("_nth")], direction=direction, exact=exact, slices=slices
    )
    assert counted(got) == brute_nearest(driver, target, n, direction, exact)


def test_a_hot_key_is_ordered_in_many_tasks(spark):
    t = spark.range(5000).select(F.least("id", F.lit(1)).alias("k"), F.col("id").alias("at"))
    t = t.where("at > 0")
    d = spark.createDataFrame([(1, 4000)], "k long, at long")
    with settings(spark, **{"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}):
        got = lookup_as_of(d, t, "k", {"at": "at"}, 3, slices=32)
        text = plan(got)
        assert sorted(r.at for r in got.collect()) == [3998, 3999, 4000]
    # rows are ordered by (key, slice); only sums of slices are ordered by key alone
    assert "_slice" in text[text.index("Window") :] and "NestedLoop" not in text and "Cartesian" not in text
    found = cuts(t, F.col("at"), 32)
    sizes = [r["count"] for r in t.groupBy("k", found.bin(F.col("at"))).count().collect()]
    assert len(sizes) == 32 and max(sizes) < 2 * 5000 / 32


def test_bad_arguments(spark):
    t = spark.createDataFrame([(1, 1)], "k int, at int")
    for options in ({"n": 0}, {"direction": "near"}):
        with pytest.raises(ValueError):
            lookup_as_of(t, t, "k", {"at": "at"}, **options)
    with pytest.raises(ValueError):
        lookup_as_of(t, t, [], {"at": "at"})
    assert lookup_as_of(t, t.limit(0), "k", {"at": "at"}).count() == 0


def test_limits_hold_per_row_under_a_condition(spark):
    rng = random.Random(4)
    target = [(rng.choice([1, 1, 2, None]), rng.randrange(40), i) for i in range(300)]
    driver = [(rng.choice([1, 2, 3, None]), rng.choice([5, 20, None])) for _ in range(60)]
    t = spark.createDataFrame(target, "k int, v int, _row0 int")
    d = spark.createDataFrame(driver, "k int, most int")
    got = lookup_limit(d, t, "k", [F.desc("v"), F.col("_row0")], 4, F.col("t.v") < F.col("row.most"))
    want = Counter()
    for k, most in driver:
        own = [r for r in target if k is not None and most is not None and r[0] == k and r[1] < most]
        want.update(sorted(own, key=lambda r: (-r[1], r[2]))[:4])
    assert counted(got) == want
