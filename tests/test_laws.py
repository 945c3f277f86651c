"""Laws that hold for any input."""

from conftest import SF
from pyspark.sql import functions as F

from catalog.common import table
from catalog.writes import ORDER_TARGET, numbers_only_sink, patchy_orders
from rowloom.operators.batches import write_batches
from rowloom.operators.lookup import lookup, lookup_limit
from rowloom.operators.validate import accepted, flag_rejects, load_report, rejected


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_accepted_plus_rejected_is_the_input(spark):
    rows = patchy_orders(spark, SF)
    for key in ("o_orderkey", ("o_custkey", "o_orderkey"), "o_custkey"):
        flagged = flag_rejects(rows, key, ORDER_TARGET)
        parts = accepted(flagged).union(rejected(flagged).select(*rows.columns))
        assert same_rows(parts, rows)
        report = load_report(flagged).first()
        assert report["rows_read"] == report["rows_written"] + report["rows_rejected"]
        assert report["rows_rejected"] == rejected(flagged).count() > 0


def test_split_finds_the_rows_a_filter_finds(spark):
    rows = patchy_orders(spark, SF)
    want = rows.where("items LIKE '% items'")
    for batch, sub in ((100, 10), (7, 3), (1, 1), (1000, 1000)):
        refused = write_batches(rows, numbers_only_sink, batch, sub)
        assert same_rows(refused.select(*rows.columns), want)


def test_a_high_limit_is_no_limit(spark):
    customer, orders = table(spark, SF, "customer"), table(spark, SF, "orders")
    on = {"o_custkey": "c_custkey"}
    order = [F.col("o_orderkey")]
    assert same_rows(lookup(customer, orders, on), lookup_limit(customer, orders, on, order, 900))
    assert same_rows(lookup(customer, orders, on), lookup_limit(customer, orders, on, order, 5000))
