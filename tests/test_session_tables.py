"""Keyed tables of one session, on a cluster whose catalog is in memory."""

import pytest
from conftest import SF
from pyspark.sql import functions as F

from catalog import QUERIES
from rowloom.plans.load import SESSION_PROPERTY, compact_table, create_table, load_table, read_live, table_info

KEYED = [
    "compact", "compact_rebucket", "create_load", "error_rows_lossy", "evolve_schema", "fold_loads", "load_ignore_nulls",
    "load_null_overwrite", "load_replaced", "load_report_committed", "load_table", "load_versions", "purge_expired",
    "read_live", "read_live_cells", "stream_lookup_table", "stream_upsert", "stream_upsert_rejects", "truncate_load",
    "write_with_ttl",
]


@pytest.fixture
def on_a_cluster(spark, monkeypatch):
    """What the code sees where the master is not a local one."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://elsewhere:7077")


@pytest.mark.parametrize("name", KEYED)
def test_queries_bring_their_own_tables(spark, on_a_cluster, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_other_tables_ask_for_a_lasting_catalog(spark, on_a_cluster, table_name):
    rows = spark.range(6).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for properties in (None, {"owner": "x"}, {SESSION_PROPERTY: "false"}):
        with pytest.raises(RuntimeError, match="outlives the session"):
            create_table(spark, table_name, rows.schema, "k", properties=properties)
    with pytest.raises(RuntimeError, match="outlives the session"):
        load_table(table_name, rows, "k", nulls="overwrite", create=True)
    assert not spark.catalog.tableExists(table_name)
    load_table(table_name, rows, "k", nulls="overwrite", create=True, properties={SESSION_PROPERTY: "true"}, buckets=2)
    compact_table(spark, table_name, buckets=4)
    assert table_info(spark, table_name).buckets == 4
    assert sorted(map(tuple, read_live(spark, table_name).collect())) == [(i, 2 * i) for i in range(6)]
