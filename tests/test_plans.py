"""Plans: pushdown, pruning, work done before shuffles, and hot keys."""

from contextlib import contextmanager

import pytest
from conftest import SF
from pyspark.sql import functions as F

from catalog import QUERIES
from catalog.common import table
from rowloom.operators.lookup import lookup, lookup_limit
from rowloom.operators.upsert import latest_cells, latest_rows
from rowloom.plans.export import sorted_by_key
from rowloom.plans.load import load_table, read_live


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["select_query"](spark, SF))
    assert "EqualTo(l_returnflag,R)" in text and "GreaterThanOrEqual(l_shipdate" in text
    assert "l_comment" not in text and "l_tax" not in text
    text = plan(QUERIES["lookup_per_row"](spark, SF))
    assert "ReadSchema: struct<c_custkey:bigint>" in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_multiplies_all_pairs(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_versions_are_reduced_before_the_shuffle(spark):
    lines = table(spark, SF, "lineitem")
    text = plan(latest_rows(lines, ("l_orderkey", "l_linenumber"), "l_shipdate"))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    text = plan(latest_cells(lines, ("l_orderkey", "l_linenumber"), "l_shipdate"))
    assert text.index("Exchange") < text.index("partial_max(")


def test_key_filters_pass_below_reconciling(spark):
    lines = table(spark, SF, "lineitem")
    for reconcile in (latest_rows, latest_cells):
        got = reconcile(lines, ("l_orderkey", "l_linenumber"), "l_shipdate")
        assert "EqualTo(l_orderkey,7)" in plan(got.where("l_orderkey = 7"))


def test_table_reads_need_no_shuffle_and_prune(spark, table_name):
    orders = table(spark, SF, "orders").drop("o_orderdate")
    for _ in range(2):
        load_table(table_name, orders, ("o_custkey", "o_orderkey"), nulls="overwrite", create=True)
    got = read_live(spark, table_name).where("o_custkey = 3").select("o_orderkey", "o_custkey")
    text = plan(got)
    assert "Exchange" not in text and "Bucketed: true" in text
    assert "EqualTo(o_custkey,3)" in text and "o_totalprice" not in text
    load_table(table_name, orders, ("o_custkey", "o_orderkey"), nulls="ignore")
    text = plan(read_live(spark, table_name).where("o_custkey = 3"))
    assert "Exchange" not in text and "EqualTo(o_custkey,3)" in text


HOT = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "2KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.0",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "1KB",
}


def hot_driver(spark):
    """Two thirds of the driver rows are spread, one third holds one key."""
    spread = spark.range(20000, numPartitions=8).select((F.col("id") % 500).alias("id"))
    return spread.union(spark.range(10000, numPartitions=8).select(F.lit(7).cast("bigint")))


def test_hot_driver_key_is_split(spark):
    target = spark.range(500).select("id", F.col("id").cast("string").alias("v"))
    with settings(spark, **HOT):
        got = lookup(hot_driver(spark), target, "id")
        counts = {r["v"]: r["count"] for r in got.groupBy("v").count().collect()}
        assert got.rdd.getNumPartitions() > 4
        assert "skew=true" in plan(got)
    assert counts["7"] == 10040 and len(counts) == 500


def test_hot_driver_key_is_split_with_a_limit(spark):
    target = spark.range(5000).select((F.col("id") % 500).alias("id"), F.col("id").alias("v"))
    with settings(spark, **HOT):
        got = lookup_limit(hot_driver(spark), target, "id", [F.col("v")], 2)
        assert got.rdd.getNumPartitions() > 4
        assert "skew=true" in plan(got)
        counts = {tuple(r): r["count"] for r in got.groupBy("id", "v").count().collect()}
    assert len(counts) == 1000
    assert {k[:2] for k in counts} == {(i, v) for i in range(500) for v in (i, i + 500)}
    assert counts[(7, 7, 10040)] == 10040


def test_hot_target_key_is_cut_before_the_shuffle(spark):
    """Half of the target holds one key; only its first rows per task are shuffled."""
    hot = spark.range(40000, numPartitions=4).select(F.lit(1).cast("bigint").alias("id"), F.col("id").alias("v"))
    target = hot.union(spark.range(40000, numPartitions=4).select("id", F.col("id").alias("v")))
    driver = spark.createDataFrame([(1,), (2,)], "id bigint")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        got = lookup_limit(driver, target, "id", [F.col("v")], 3)
        text = plan(got)
        assert text.index("Exchange hashpartitioning(_w0") < text.index("Partial")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 0), (1, 1), (1, 1), (2, 2)]


def test_large_limits_cut_a_hot_key_in_parts(spark):
    hot = spark.range(9000, numPartitions=4).select(F.lit(1).alias("id"), F.col("id").alias("v"))
    target = hot.union(spark.range(9000, numPartitions=4).select(F.col("id").cast("int"), "id"))
    driver = spark.createDataFrame([(1,), (2,)], "id int")
    got = lookup_limit(driver, target, "id", [F.col("v").desc()], 2500)
    assert "pmod(xxhash64" in plan(got)
    want = [(1, v) for v in range(6500, 9000)] + [(2, 2)]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_export_spreads_a_hot_partition_key(spark):
    """Ranges are cut on the whole key, sorted, and do not overlap."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("p"), F.col("id").alias("c")
    )
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        parts = sorted_by_key(rows, ("p", "c"), partitions=6).rdd.glom().collect()
    keys = [[(r["p"], r["c"]) for r in part] for part in parts]
    assert all(k == sorted(k) for k in keys)
    flat = [k for part in keys for k in part]
    assert flat == sorted(flat) and len(flat) == 6000
    assert sum(any(p == 1 for p, _ in part) for part in keys) > 1
    assert max(map(len, keys)) < 2000
