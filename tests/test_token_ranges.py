"""Token ranges: even, complete, pruned, hot tokens dealt out."""

from collections import Counter

from conftest import SF
from pyspark.sql import functions as F
from test_plans import plan

from catalog.common import table
from rowloom.functions.tokens import token
from rowloom.operators.token_ranges import (
    in_token_ranges,
    scan_token_range,
    token_ranges,
    write_token_ranges,
)


def test_ranges_are_even_with_a_hot_token(spark, tmp_path):
    rows = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    for partitioner in ("xxhash64", "Murmur3Partitioner"):
        own = token(rows, ["k"], partitioner)
        ranges = token_ranges(rows, own, 10)
        assert 10 <= len(ranges.ranges) <= 12
        sizes = {r["_range"]: r["count"] for r in in_token_ranges(rows, own, ranges).groupBy("_range").count().collect()}
        assert set(sizes) == set(range(len(ranges.ranges))) and max(sizes.values()) <= 1.1 * 600
        (dealt,) = {(r.low, r.high) for r in ranges.ranges if r.parts > 1}
        parts = [r for r in ranges.ranges if (r.low, r.high) == dealt]
        assert [r.part for r in parts] == list(range(len(parts)))
        path = f"{tmp_path}/{partitioner}"
        write_token_ranges(rows, path, own, ranges)
        back = Counter()
        for i, r in enumerate(ranges.ranges):
            scan = scan_token_range(spark, path, i, r.low, r.high)
            # the bounds leave out nothing of the range
            assert scan.count() == scan_token_range(spark, path, i).count()
            back.update(tuple(x) for x in scan.collect())
        assert back == Counter(tuple(x) for x in rows.collect())


def test_one_range_reads_its_files_only(spark, tmp_path):
    orders = table(spark, SF, "orders").select("o_orderkey", "o_custkey")
    own = token(orders, ["o_custkey"])
    ranges = token_ranges(orders, own, 4)
    write_token_ranges(orders, f"{tmp_path}/t", own, ranges)
    low = ranges.ranges[2].low
    text = plan(scan_token_range(spark, f"{tmp_path}/t", 2, low))
    assert "PartitionFilters: [isnotnull(_range" in text and "GreaterThanOrEqual(_token" in text


def test_exact_copies_and_null_tokens(spark, tmp_path):
    same = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"), F.lit("copy").alias("v"))
    null = spark.createDataFrame([(None, "none")], "k int, v string")
    rows = same.union(null)
    own = F.when(F.col("k").isNotNull(), F.xxhash64("k"))
    ranges = token_ranges(rows, own, 8)
    sizes = [r["count"] for r in in_token_ranges(rows, own, ranges).groupBy("_range").count().collect()]
    assert sum(sizes) == 4001 and max(sizes) < 3000
    write_token_ranges(rows, f"{tmp_path}/t", own, ranges)
    assert sum(scan_token_range(spark, f"{tmp_path}/t", i).count() for i in range(len(ranges.ranges))) == 4001
    empty = token_ranges(rows.limit(0), own, 8)
    assert len(empty.ranges) == 1
    assert in_token_ranges(rows.limit(0), own, empty).count() == 0
