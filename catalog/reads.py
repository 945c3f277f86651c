"""Sources, lookups, projection, filter, limit, count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.common import query, table
from rowloom.functions.types import normalize_types
from rowloom.operators.lookup import lookup, lookup_limit
from rowloom.operators.project import (
    align_to_target,
    count_star,
    first_n_columns,
    limit,
    project,
    project_lenient,
    select_distinct,
    where,
)
from rowloom.operators.ranges import lookup_as_of, lookup_range
from rowloom.sources.tables import param_query, select_query


@query("scan_all", "SELECT * FROM lineitem")
def scan_all(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem")


@query(
    "select_query",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
       WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '1998-01-01'""",
)
def select_query_(spark: SparkSession, d: str) -> DataFrame:
    return select_query(
        table(spark, d, "lineitem"),
        ["l_orderkey", "l_linenumber", "l_extendedprice"],
        "l_returnflag = 'R' AND l_shipdate >= TIMESTAMP_NTZ '1998-01-01'",
    )


@query(
    "normalize_types",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
              CAST(CAST(l_discount AS FLOAT) AS DOUBLE) AS discount,
              CAST(l_extendedprice AS DECIMAL(12, 2)) AS price,
              l_returnflag = 'R' AS returned,
              CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS ship_day,
              l_shipdate, l_linestatus
       FROM lineitem""",
)
def normalize_types_(spark: SparkSession, d: str) -> DataFrame:
    stored = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_discount").cast("float").alias("discount"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        (F.col("l_returnflag") == "R").alias("returned"),
        F.col("l_shipdate").cast("date").alias("ship_day"),
        "l_shipdate",
        "l_linestatus",
    )
    return normalize_types(stored)


def repeated_customers(spark: SparkSession, d: str) -> DataFrame:
    """A driver with repeated rows: all customers, and those of one segment again."""
    customer = table(spark, d, "customer")
    return customer.union(where(customer, "c_mktsegment = 'BUILDING'"))


_REPEATED_CUSTOMERS = """driver AS (
  SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_mktsegment = 'BUILDING')"""


@query(
    "lookup_per_row",
    f"""WITH {_REPEATED_CUSTOMERS}
        SELECT o.* FROM driver JOIN orders o ON o.o_custkey = driver.c_custkey""",
)
def lookup_per_row(spark: SparkSession, d: str) -> DataFrame:
    return lookup(
        repeated_customers(spark, d), table(spark, d, "orders"), {"o_custkey": "c_custkey"}
    )


@query(
    "lookup_per_row_condition",
    f"""WITH {_REPEATED_CUSTOMERS}
        SELECT o.* FROM driver JOIN orders o
        ON o.o_custkey = driver.c_custkey AND o.o_totalprice > driver.c_acctbal * 50""",
)
def lookup_per_row_condition(spark: SparkSession, d: str) -> DataFrame:
    return lookup(
        repeated_customers(spark, d),
        table(spark, d, "orders"),
        {"o_custkey": "c_custkey"},
        F.col("t.o_totalprice") > F.col("row.c_acctbal") * 50,
    )


@query(
    "lookup_limit",
    f"""WITH {_REPEATED_CUSTOMERS}, ranked AS (
          SELECT *, row_number() OVER (
            PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS nth FROM orders)
        SELECT o.* EXCLUDE (nth) FROM driver JOIN ranked o
        ON o.o_custkey = driver.c_custkey AND o.nth <= 3""",
)
def lookup_limit_(spark: SparkSession, d: str) -> DataFrame:
    return lookup_limit(
        repeated_customers(spark, d),
        table(spark, d, "orders"),
        {"o_custkey": "c_custkey"},
        [F.col("o_orderdate").desc(), F.col("o_orderkey")],
        3,
    )


@query(
    "lookup_limit_condition",
    f"""WITH {_REPEATED_CUSTOMERS}
        SELECT o.* FROM driver, LATERAL (
          SELECT * FROM orders WHERE o_custkey = driver.c_custkey AND o_totalprice > driver.c_acctbal * 20
          ORDER BY o_orderdate DESC, o_orderkey LIMIT 2) o""",
)
def lookup_limit_condition(spark: SparkSession, d: str) -> DataFrame:
    return lookup_limit(
        repeated_customers(spark, d),
        table(spark, d, "orders"),
        {"o_custkey": "c_custkey"},
        [F.desc("o_orderdate"), F.col("o_orderkey")],
        2,
        F.col("t.o_totalprice") > F.col("row.c_acctbal") * 20,
    )


@query(
    "lookup_range",
    f"""WITH {_REPEATED_CUSTOMERS}
        SELECT o.* FROM driver JOIN orders o
        ON o.o_totalprice BETWEEN driver.c_acctbal * 20 AND driver.c_acctbal * 20 + 500""",
)
def lookup_range_(spark: SparkSession, d: str) -> DataFrame:
    balance = F.col("c_acctbal") * 20
    return lookup_range(repeated_customers(spark, d), table(spark, d, "orders"), "o_totalprice", balance, balance + 500)


@query(
    "lookup_range_condition",
    """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_shipdate FROM orders o JOIN lineitem l
       ON l.l_orderkey = o.o_orderkey AND l.l_shipdate > o.o_orderdate
          AND l.l_shipdate < o.o_orderdate + INTERVAL 30 DAY AND l.l_quantity > o.o_totalprice / 10000""",
)
def lookup_range_condition(spark: SparkSession, d: str) -> DataFrame:
    """A band of time with an equality and a further condition."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity")
    return lookup_range(
        table(spark, d, "orders"),
        lines,
        "l_shipdate",
        "o_orderdate",
        F.col("o_orderdate") + F.expr("INTERVAL 30 DAY"),
        on={"l_orderkey": "o_orderkey"},
        where=F.col("t.l_quantity") > F.col("row.o_totalprice") / 10000,
        inclusive="neither",
    ).drop("l_quantity")


_AS_OF = """SELECT e.* FROM events p, LATERAL (
              SELECT * FROM events e WHERE e.user_id = p.user_id AND e.event_type <> 'purchase' AND e.ts {how}
              ORDER BY e.ts {way}, e.event_id {way} LIMIT {n}) e
            WHERE p.event_type = 'purchase'"""


@query("lookup_as_of", _AS_OF.format(how="<= p.ts", way="DESC", n=3))
def lookup_as_of_(spark: SparkSession, d: str) -> DataFrame:
    """The last three other events of the user up to each purchase."""
    events = table(spark, d, "events")
    other = events.where("event_type <> 'purchase'")
    return lookup_as_of(
        events.where("event_type = 'purchase'"), other, "user_id", {"ts": "ts"}, 3, order_by=[F.col("event_id")]
    )


@query("lookup_next", _AS_OF.format(how="> p.ts", way="ASC", n=1))
def lookup_next(spark: SparkSession, d: str) -> DataFrame:
    """The first other event of the user after each purchase."""
    events = table(spark, d, "events")
    other = events.where("event_type <> 'purchase'")
    return lookup_as_of(
        events.where("event_type = 'purchase'"),
        other,
        "user_id",
        {"ts": "ts"},
        order_by=[F.col("event_id")],
        direction="after",
        exact=False,
    )


@query(
    "param_query",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE o_orderstatus = 'F' AND o_totalprice BETWEEN 1000 AND 250000""",
)
def param_query_(spark: SparkSession, d: str) -> DataFrame:
    return param_query(
        spark,
        """SELECT o_orderkey, o_custkey, o_totalprice FROM {orders}
           WHERE o_orderstatus = :status AND o_totalprice BETWEEN :low AND :high""",
        {"status": "F", "low": 1000.0, "high": 250000.0},
        orders=table(spark, d, "orders"),
    )


@query("project", "SELECT o_custkey, o_orderkey, o_orderdate FROM orders")
def project_(spark: SparkSession, d: str) -> DataFrame:
    return project(table(spark, d, "orders"), "O_CustKey", "o_orderkey", '"o_orderdate"')


@query("alias", 'SELECT o_orderkey AS id, o_custkey AS "Customer", o_totalprice FROM orders')
def alias(spark: SparkSession, d: str) -> DataFrame:
    items = [("o_orderkey", "ID"), ("o_custkey", '"Customer"'), "o_totalprice"]
    return project(table(spark, d, "orders"), *items)


@query(
    "missing_as_string",
    "SELECT l_orderkey, CAST(NULL AS VARCHAR) AS no_such_column, l_returnflag FROM lineitem",
)
def missing_as_string(spark: SparkSession, d: str) -> DataFrame:
    names = ["l_orderkey", "no_such_column", "l_returnflag"]
    return project_lenient(table(spark, d, "lineitem"), *names)


@query("first_n_columns", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem")
def first_n_columns_(spark: SparkSession, d: str) -> DataFrame:
    return first_n_columns(table(spark, d, "lineitem"), 4)


@query("select_distinct", "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def select_distinct_(spark: SparkSession, d: str) -> DataFrame:
    return select_distinct(table(spark, d, "lineitem"), "l_partkey", "l_returnflag")


@query(
    "align_to_target",
    """SELECT CAST(l_linenumber AS BIGINT) AS l_linenumber, l_orderkey,
              CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem""",
)
def align_to_target_(spark: SparkSession, d: str) -> DataFrame:
    target = T.StructType(
        [
            T.StructField("l_linenumber", T.LongType()),
            T.StructField("l_orderkey", T.LongType()),
            T.StructField("not_in_input", T.StringType()),
            T.StructField("l_shipdate", T.DateType()),
        ]
    )
    return align_to_target(table(spark, d, "lineitem"), target)


@query(
    "where",
    """SELECT * FROM events WHERE event_type IN ('purchase', 'signup') AND value >= 25.5
       AND ts < TIMESTAMP '2024-01-20'""",
)
def where_(spark: SparkSession, d: str) -> DataFrame:
    return where(
        table(spark, d, "events"),
        "event_type IN ('purchase', 'signup') AND value >= 25.5D "
        "AND ts < TIMESTAMP_NTZ '2024-01-20'",
    )


@query("limit", "SELECT * FROM events ORDER BY ts, event_id LIMIT 100")
def limit_(spark: SparkSession, d: str) -> DataFrame:
    return limit(table(spark, d, "events"), 100, ["ts", "event_id"])


@query("count_star", "SELECT count(*) AS count FROM lineitem")
def count_star_(spark: SparkSession, d: str) -> DataFrame:
    return count_star(table(spark, d, "lineitem"))
