"""Upserts, rejects, batches, table loads, exports and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.common import query, table
from catalog.transforms import EVENT_KEY, event_log
from rowloom.functions.cells import to_micros
from rowloom.operators.batches import batch_rows, sink_batches, write_batches
from rowloom.operators.project import where
from rowloom.operators.upsert import latest_cells, latest_rows, live_rows, with_ttl
from rowloom.operators.validate import (
    accepted,
    flag_rejects,
    load_report,
    reject_empty_row,
    reject_null_key,
    rejected,
)
from rowloom.plans.export import bulk_export, insert_script
from rowloom.plans.load import (
    SESSION_PROPERTY,
    compact_table,
    create_table,
    fold_loads,
    load_table,
    read_live,
    table_info,
)
from rowloom.session import scratch_dir, setting, ship, stage
from rowloom.streaming.changes import STATE_STORE, stream_changes
from rowloom.streaming.jobs import (
    stream_lookup,
    stream_lookup_limit,
    stream_lookup_table,
    stream_sink_batches,
    stream_upsert,
)

ship(__name__)

LINE_KEY = ("l_orderkey", "l_linenumber")
# the queries' keyed tables are written and read by one query, so any catalog will do
OF_SESSION = {SESSION_PROPERTY: "true"}


def new_table(spark: SparkSession, label: str) -> str:
    """An unused table name in a database that lives in the scratch folder."""
    if not spark.catalog.databaseExists("rowloom_checks"):
        location = scratch_dir(spark, "tables")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS rowloom_checks LOCATION '{location}'")
    return f"rowloom_checks.{label}_{uuid.uuid4().hex[:12]}"


@query(
    "upsert_overwrite",
    """SELECT * FROM lineitem
       QUALIFY row_number() OVER (
         PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                  l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                  l_linestatus DESC) = 1""",
)
def upsert_overwrite(spark: SparkSession, d: str) -> DataFrame:
    return latest_rows(table(spark, d, "lineitem"), LINE_KEY, "l_shipdate")


def sparse_events(spark: SparkSession, d: str) -> DataFrame:
    """Event log where small values are missing and error rows carry no text."""
    return event_log(spark, d).select(
        "user_id",
        "event_type",
        F.when(F.col("value") >= 20, F.col("value")).alias("value"),
        F.when(F.col("value") < 60, F.col("props")).alias("props"),
        "_writetime",
        "event_id",
    )


_SPARSE_EVENTS = """sparse AS (
  SELECT user_id, event_type, CASE WHEN value >= 20 THEN value END AS value,
         CASE WHEN value < 60 THEN props END AS props, epoch_us(ts) AS w, event_id
  FROM events)"""


@query(
    "upsert_ignore_nulls",
    f"""WITH {_SPARSE_EVENTS}
        SELECT user_id, event_type,
               arg_max(value, w) FILTER (value IS NOT NULL) AS value,
               arg_max(props, w) FILTER (props IS NOT NULL) AS props,
               max(w) AS _writetime, arg_max(event_id, w) AS event_id
        FROM sparse GROUP BY user_id, event_type""",
)
def upsert_ignore_nulls(spark: SparkSession, d: str) -> DataFrame:
    return latest_cells(sparse_events(spark, d), EVENT_KEY)


def patchy_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders with missing keys and values, and text where a number belongs."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.when(status != "P", F.col("o_custkey")).alias("o_custkey"),
        F.when(priority == "5-LOW", F.concat_ws(" ", status, F.lit("items")))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("items"),
        F.when(priority != "1-URGENT", priority).alias("priority"),
    )


_PATCHY_ORDERS = """patchy AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey,
         CASE WHEN o_orderpriority = '5-LOW' THEN o_orderstatus || ' items'
              ELSE CAST(o_custkey AS VARCHAR) END AS items,
         CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS priority
  FROM orders),
shown AS (
  SELECT *, concat_ws(',', o_orderkey, coalesce(CAST(o_custkey AS VARCHAR), '<null>'), items,
                      coalesce(priority, '<null>')) AS text
  FROM patchy)"""


@query(
    "reject_null_key",
    f"""WITH {_PATCHY_ORDERS}
        SELECT o_orderkey, o_custkey, items, priority, CAST(1 AS BIGINT) AS _err_count,
               'null key: ' || text AS _err_desc, CAST(NULL AS VARCHAR) AS _err_fields,
               'ERR_INSERT01' AS _err_code
        FROM shown WHERE o_custkey IS NULL""",
)
def reject_null_key_(spark: SparkSession, d: str) -> DataFrame:
    return rejected(reject_null_key(patchy_orders(spark, d), ("o_custkey", "o_orderkey")))


@query(
    "reject_null_key_accepted",
    f"WITH {_PATCHY_ORDERS} SELECT * FROM patchy WHERE o_custkey IS NOT NULL",
)
def reject_null_key_accepted(spark: SparkSession, d: str) -> DataFrame:
    return accepted(reject_null_key(patchy_orders(spark, d), ("o_custkey", "o_orderkey")))


@query(
    "reject_empty_row",
    f"""WITH {_PATCHY_ORDERS}
        SELECT o_orderkey, o_custkey, priority, CAST(1 AS BIGINT) AS _err_count,
               'no values for key: ' || o_orderkey AS _err_desc,
               CAST(NULL AS VARCHAR) AS _err_fields, 'ERR_INSERT01' AS _err_code
        FROM shown WHERE o_custkey IS NULL AND priority IS NULL""",
)
def reject_empty_row_(spark: SparkSession, d: str) -> DataFrame:
    return rejected(reject_empty_row(patchy_orders(spark, d).drop("items"), "o_orderkey"))


ORDER_TARGET = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("items", T.LongType()),
        T.StructField("priority", T.StringType()),
    ]
)


ERROR_ROWS_SQL = f"""WITH {_PATCHY_ORDERS}
        SELECT o_orderkey, o_custkey, items, priority, CAST(1 AS BIGINT) AS _err_count,
               'value does not fit: ' || text AS _err_desc, 'items' AS _err_fields,
               'ERR_INSERT01' AS _err_code
        FROM shown WHERE TRY_CAST(items AS BIGINT) IS NULL"""


@query("error_rows", ERROR_ROWS_SQL)
def error_rows(spark: SparkSession, d: str) -> DataFrame:
    return rejected(flag_rejects(patchy_orders(spark, d), "o_orderkey", ORDER_TARGET))


_REPORT = f"""WITH {_PATCHY_ORDERS}
        SELECT count(*) AS rows_read, count(TRY_CAST(items AS BIGINT)) AS rows_written,
               count(*) - count(TRY_CAST(items AS BIGINT)) AS rows_rejected,
               count(*) - count(TRY_CAST(items AS BIGINT)) AS errors
        FROM patchy"""


@query("load_report", _REPORT)
def load_report_(spark: SparkSession, d: str) -> DataFrame:
    return load_report(flag_rejects(patchy_orders(spark, d), "o_orderkey", ORDER_TARGET))


@query(
    "batch_rows",
    """SELECT *, (row_number() OVER (ORDER BY o_orderkey) - 1) // 100 AS batch_id,
              (row_number() OVER (ORDER BY o_orderkey) - 1) % 100 AS batch_pos
       FROM orders""",
)
def batch_rows_(spark: SparkSession, d: str) -> DataFrame:
    return batch_rows(table(spark, d, "orders"), ["o_orderkey"])


def numbers_only_sink(rows: list[dict]) -> None:
    """A sink that refuses a request holding a row whose ``items`` is not a number."""
    for row in rows:
        int(row["items"])


_REFUSED = f"""WITH {_PATCHY_ORDERS}
        SELECT o_orderkey, o_custkey, items, priority, CAST(1 AS BIGINT) AS _err_count,
               'invalid literal for int() with base 10: ''' || items || '''' AS _err_desc,
               CAST(NULL AS VARCHAR) AS _err_fields, 'ERR_INSERT01' AS _err_code
        FROM patchy WHERE TRY_CAST(items AS BIGINT) IS NULL"""


@query("split_failed_batch", _REFUSED)
def split_failed_batch(spark: SparkSession, d: str) -> DataFrame:
    return write_batches(patchy_orders(spark, d), numbers_only_sink)


@query("sink_batches", _REFUSED)
def sink_batches_(spark: SparkSession, d: str) -> DataFrame:
    return sink_batches(patchy_orders(spark, d), numbers_only_sink, scratch_dir(spark, "refused")).rejects


def named_numbers_sink(rows: list[dict], request: str) -> None:
    numbers_only_sink(rows)


@query("stream_sink_batches", _REFUSED)
def stream_sink_batches_(spark: SparkSession, d: str) -> DataFrame:
    patchy, refused = patchy_orders(spark, d), scratch_dir(spark, "refused")
    source = stage(patchy.repartition(4, "o_orderkey"), "stream-input")
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 2)
    stream = stream.parquet(source.inputFiles()[0].rsplit("/", 1)[0])
    stream_sink_batches(stream, named_numbers_sink, scratch_dir(spark, "progress"), refused).awaitTermination()
    return spark.read.parquet(refused).where("_kind = 'refused'").drop("query", "batch", "_kind")


@query(
    "load_table",
    f"""WITH {_PATCHY_ORDERS}
        SELECT o_orderkey, o_custkey, CAST(items AS BIGINT) AS items, priority
        FROM patchy WHERE TRY_CAST(items AS BIGINT) IS NOT NULL""",
)
def load_table_(spark: SparkSession, d: str) -> DataFrame:
    name = new_table(spark, "load_table")
    orders = table(spark, d, "orders")
    typed = orders.select(
        "o_orderkey",
        "o_custkey",
        F.col("o_custkey").alias("items"),
        F.col("o_orderpriority").alias("priority"),
    )
    load_table(name, typed, "o_orderkey", nulls="overwrite", create=True, properties=OF_SESSION, truncate=True)
    patchy = patchy_orders(spark, d)
    load_table(name, patchy, "o_orderkey", nulls="overwrite", truncate=True)
    return read_live(spark, name)


@query(
    "create_load",
    """SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice
       FROM part""",
)
def create_load(spark: SparkSession, d: str) -> DataFrame:
    name = new_table(spark, "create_load")
    part = table(spark, d, "part")
    load_table(name, part, "p_partkey", nulls="overwrite", create=True, properties=OF_SESSION, unique=True)
    return read_live(spark, name)


@query(
    "evolve_schema",
    """SELECT c_custkey, c_name, c_mktsegment,
              CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal END AS c_acctbal
       FROM customer""",
)
def evolve_schema(spark: SparkSession, d: str) -> DataFrame:
    name = new_table(spark, "evolve_schema")
    customer = table(spark, d, "customer")
    narrow = customer.select("c_custkey", "c_name", "c_mktsegment")
    load_table(name, narrow, "c_custkey", nulls="overwrite", create=True, properties=OF_SESSION)
    # the second load writes the new column only, and must leave the others alone
    building = where(customer, "c_mktsegment = 'BUILDING'").select("c_custkey", "c_acctbal")
    load_table(name, building, "c_custkey", nulls="overwrite", evolve=True)
    return read_live(spark, name)


@query(
    "truncate_load",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'",
)
def truncate_load(spark: SparkSession, d: str) -> DataFrame:
    name = new_table(spark, "truncate_load")
    orders = table(spark, d, "orders")
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    every = orders.select(*columns)
    load_table(name, every, "o_orderkey", nulls="overwrite", create=True, properties=OF_SESSION)
    some = where(orders, "o_orderstatus = 'O'").select(*columns)
    load_table(name, some, "o_orderkey", nulls="overwrite", truncate=True)
    return read_live(spark, name)


_LOGGED_EVENTS = """newest AS (
  SELECT user_id, event_type, event_id, value, ts FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1)"""


def load_events(spark: SparkSession, d: str, label: str, ttl: int) -> str:
    """All events loaded with a time-to-live; returns the table's name."""
    name = new_table(spark, label)
    log = event_log(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    rows = log.select("user_id", "event_type", "event_id", "value", "ts")
    at, seq = to_micros(F.col("ts")), F.col("event_id")
    load_table(
        name, rows, EVENT_KEY, nulls="overwrite", create=True, properties=OF_SESSION, written_at=at, seq=seq, ttl=ttl
    )
    return name


@query(
    "write_with_ttl",
    f"""WITH {_LOGGED_EVENTS}
        SELECT user_id, event_type, event_id, value, ts, epoch_us(ts) AS _writetime,
               ts + INTERVAL 7 DAY AS _expires_at
        FROM newest""",
)
def write_with_ttl(spark: SparkSession, d: str) -> DataFrame:
    return read_live(spark, load_events(spark, d, "write_with_ttl", 7 * 86400), stamps=True)


@query(
    "read_live",
    f"""WITH {_LOGGED_EVENTS}
        SELECT * FROM newest WHERE ts + INTERVAL 7 DAY > TIMESTAMP '2024-02-02'""",
)
def read_live_(spark: SparkSession, d: str) -> DataFrame:
    name = load_events(spark, d, "read_live", 7 * 86400)
    return read_live(spark, name, F.lit("2024-02-02").cast("timestamp"))


@query(
    "live_rows",
    f"""WITH {_LOGGED_EVENTS}
        SELECT user_id, event_type, event_id FROM newest
        WHERE ts + INTERVAL 3 DAY > TIMESTAMP '2024-01-30'""",
)
def live_rows_(spark: SparkSession, d: str) -> DataFrame:
    newest = latest_rows(with_ttl(event_log(spark, d), 3 * 86400), EVENT_KEY)
    live = live_rows(newest, F.lit("2024-01-30").cast("timestamp"))
    return live.select("user_id", "event_type", "event_id")


@query("bulk_export", "SELECT * FROM orders")
def bulk_export_(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "export")
    bulk_export(table(spark, d, "orders"), path, ("o_custkey", "o_orderkey"), max_records=1000000)
    return spark.read.parquet(path)


@query(
    "bulk_export_text",
    """SELECT conv_id, turn, nullif(role, '') AS role, nullif(text, '') AS text
       FROM conversations""",
)
def bulk_export_text(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "export")
    bulk_export(table(spark, d, "conversations"), path, ("conv_id", "turn"))
    return spark.read.parquet(path)


@query(
    "bulk_export_rejects",
    """SELECT o_orderkey, o_custkey, nullif(o_orderstatus, '') AS o_orderstatus,
              nullif(o_orderpriority, '5-LOW') AS priority, CAST(1 AS BIGINT) AS _err_count,
              'null key: ' || o_orderkey || ',' || o_custkey || ',' || o_orderstatus || ',<null>'
              AS _err_desc, CAST(NULL AS VARCHAR) AS _err_fields,
              'ERR_SSTABLE_OUTPUT_01' AS _err_code
       FROM orders WHERE o_orderpriority = '5-LOW'""",
)
def bulk_export_rejects(spark: SparkSession, d: str) -> DataFrame:
    priority = F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority"))
    rows = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", priority.alias("priority")
    )
    return bulk_export(rows, scratch_dir(spark, "export"), ("priority", "o_orderkey"))


@query(
    "bulk_export_versions",
    """SELECT l_orderkey, l_linenumber, max(l_shipdate) AS l_shipdate,
              arg_max(l_partkey, (l_shipdate, l_partkey)) AS l_partkey,
              arg_max(l_extendedprice, (l_shipdate, l_extendedprice)) AS l_extendedprice
       FROM lineitem GROUP BY l_orderkey, l_linenumber""",
)
def bulk_export_versions(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "export")
    columns = [*LINE_KEY, "l_shipdate", "l_partkey", "l_extendedprice"]
    rows = table(spark, d, "lineitem").select(*columns)
    bulk_export(rows, path, LINE_KEY, written_at="l_shipdate")
    return spark.read.parquet(path)


@query(
    "insert_script",
    """WITH numbered AS (
         SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 100 AS batch_id, o_orderkey,
                'INSERT INTO shop."Order Log" (o_orderkey,o_custkey,o_orderdate'
                || CASE WHEN o_orderpriority <> '5-LOW' THEN ',"Priority"' ELSE '' END
                || ') VALUES (' || o_orderkey || ',' || o_custkey || ',' || ''''
                || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'''
                || CASE WHEN o_orderpriority <> '5-LOW' THEN ',''' || o_orderpriority || ''''
                   ELSE '' END
                || ') USING TTL 3600 AND TIMESTAMP ' || epoch_us(o_orderdate) AS statement
         FROM orders)
       SELECT batch_id, 'BEGIN UNLOGGED BATCH ' || string_agg(statement, ';' ORDER BY o_orderkey)
              || ';APPLY BATCH;' AS script
       FROM numbered GROUP BY batch_id""",
)
def insert_script_(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("Priority"),
    )
    at = to_micros(F.col("o_orderdate"))
    return insert_script(orders, "shop.Order Log", ["o_orderkey"], ttl=3600, timestamp=at)


@query(
    "insert_script_rejects",
    f"""WITH {_PATCHY_ORDERS}
        SELECT o_orderkey, o_custkey, items, priority, CAST(1 AS BIGINT) AS _err_count,
               'null key: ' || text AS _err_desc, CAST(NULL AS VARCHAR) AS _err_fields,
               'ERR_INSERT01' AS _err_code
        FROM shown WHERE o_custkey IS NULL""",
)
def insert_script_rejects(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "rejects")
    key = ("o_custkey", "o_orderkey")
    insert_script(patchy_orders(spark, d), "shop.orders", ["o_orderkey"], key=key, rejects_path=path)
    return spark.read.parquet(path)


@query(
    "stream_lookup",
    "SELECT o.* FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey",
)
def stream_lookup_(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    customer = table(spark, d, "customer")
    stream = (
        spark.readStream.schema(customer.schema)
        .option("pathGlobFilter", "customer.parquet")
        .parquet(d)
    )
    out, checkpoint = scratch_dir(spark, "looked-up"), scratch_dir(spark, "progress")
    found = stream_lookup(stream, orders, {"o_custkey": "c_custkey"})
    found.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(found.schema).parquet(out)


@query(
    "stream_lookup_table",
    """SELECT CAST(o.o_orderkey AS BIGINT) AS o_orderkey, o.o_custkey,
              o.o_totalprice + CASE WHEN c.c_custkey % 2 = 1 AND o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS o_totalprice
       FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey""",
)
def stream_lookup_table_(spark: SparkSession, d: str) -> DataFrame:
    """Even customers come first; then a load changes orders, then odd customers come."""
    name = new_table(spark, "stream_lookup_table")
    price = F.col("o_totalprice").cast("double")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", price.alias("o_totalprice"), "o_orderstatus")
    load_table(name, orders.drop("o_orderstatus"), "o_orderkey", nulls="overwrite", create=True, properties=OF_SESSION, written_at=F.lit(1))
    customer = table(spark, d, "customer").select("c_custkey")
    feed, out = scratch_dir(spark, "feed"), scratch_dir(spark, "looked-up")
    progress, pins = scratch_dir(spark, "progress"), scratch_dir(spark, "pins")
    for odd in (0, 1):
        if odd:
            dearer = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
            load_table(name, dearer.drop("o_orderstatus"), "o_orderkey", nulls="overwrite", written_at=F.lit(2))
        customer.where(F.col("c_custkey") % 2 == odd).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(customer.schema).parquet(feed)
        stream_lookup_table(stream, name, {"o_custkey": "c_custkey"}, progress, out, pins=pins).awaitTermination()
    return spark.read.parquet(out).drop("query", "batch")


@query(
    "stream_upsert",
    """SELECT user_id, event_type, event_id, value, ts FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1""",
)
def stream_upsert_(spark: SparkSession, d: str) -> DataFrame:
    name = new_table(spark, "stream_upsert")
    events = table(spark, d, "events")
    # the files are taken in four micro-batches, so that versions of a key meet across batches
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = stage(events.repartition(files, "event_id"), "stream-input")
    stream = (
        spark.readStream.schema(events.schema)
        .option("maxFilesPerTrigger", max(1, files // 4))
        .parquet(source.inputFiles()[0].rsplit("/", 1)[0])
        .select("user_id", "event_type", "event_id", "value", F.col("ts").cast("timestamp"))
    )
    stream_upsert(
        stream,
        name,
        EVENT_KEY,
        scratch_dir(spark, "progress"),
        "events",
        nulls="overwrite",
        rejects=scratch_dir(spark, "rejects"),
        create=True,
        properties=OF_SESSION,
        written_at=to_micros(F.col("ts")),
        seq=F.col("event_id"),
    ).awaitTermination()
    return read_live(spark, name)


@query(
    "stream_changes",
    """SELECT user_id, event_type, event_id, value, ts FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1""",
)
def stream_changes_(spark: SparkSession, d: str) -> DataFrame:
    """Accepted writes of four micro-batches; the last one of each key is what an upsert leaves."""
    events = table(spark, d, "events")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = stage(events.repartition(files, "event_id"), "stream-input")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", max(1, files // 4))
    stream = stream.parquet(source.inputFiles()[0].rsplit("/", 1)[0])
    stream = stream.select("user_id", "event_type", "event_id", "value", F.col("ts").cast("timestamp"))
    out, progress = scratch_dir(spark, "changes"), scratch_dir(spark, "progress")
    with setting(spark, "spark.sql.streaming.stateStore.providerClass", STATE_STORE):
        found = stream_changes(stream, EVENT_KEY, event_time="ts", written_at=to_micros(F.col("ts")), seq=F.col("event_id"))
        writer = found.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress)
        writer.trigger(availableNow=True).start().awaitTermination()
    changes = spark.read.schema(found.schema).parquet(out)
    return latest_rows(changes, EVENT_KEY).drop("_change", "_writetime")


@query("stream_upsert_rejects", ERROR_ROWS_SQL)
def stream_upsert_rejects(spark: SparkSession, d: str) -> DataFrame:
    name, rejects = new_table(spark, "stream_rejects"), scratch_dir(spark, "rejects")
    source = stage(patchy_orders(spark, d), "stream-input")
    create_table(spark, name, ORDER_TARGET, "o_orderkey", properties=OF_SESSION)
    stream = spark.readStream.schema(source.schema).parquet(source.inputFiles()[0].rsplit("/", 1)[0])
    stream_upsert(
        stream, name, "o_orderkey", scratch_dir(spark, "progress"), "orders", nulls="overwrite", rejects=rejects
    ).awaitTermination()
    return spark.read.parquet(rejects).drop("query", "batch")


@query(
    "stream_lookup_limit",
    """WITH ranked AS (
         SELECT *, row_number() OVER (
           PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS nth FROM orders)
       SELECT o.* EXCLUDE (nth) FROM customer c JOIN ranked o
       ON o.o_custkey = c.c_custkey AND o.nth <= 3""",
)
def stream_lookup_limit_(spark: SparkSession, d: str) -> DataFrame:
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    stream = spark.readStream.schema(customer.schema).option("pathGlobFilter", "customer.parquet").parquet(d)
    out, checkpoint = scratch_dir(spark, "looked-up"), scratch_dir(spark, "progress")
    order = [F.desc("o_orderdate"), F.col("o_orderkey")]
    found = stream_lookup_limit(stream, orders, {"o_custkey": "c_custkey"}, order, 3)
    found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()
    return spark.read.schema(found.schema).parquet(out)


@query(
    "load_replaced",
    """SELECT o_orderkey, o_custkey, o_totalprice + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS o_totalprice
       FROM orders WHERE o_orderstatus IN ('O', 'F')""",
)
def load_replaced(spark: SparkSession, d: str) -> DataFrame:
    """Load ``a`` twice: the second attempt replaces all rows of the first, not those of ``b``."""
    name = new_table(spark, "load_replaced")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    parts = {s: where(orders, f"o_orderstatus = '{s}'").drop("o_orderstatus") for s in "OFP"}
    load_table(name, parts["P"].union(parts["F"]), "o_orderkey", nulls="overwrite", create=True, properties=OF_SESSION, load_id="a")
    load_table(name, parts["O"], "o_orderkey", nulls="overwrite", load_id="b")
    again = parts["F"].withColumn("o_totalprice", F.col("o_totalprice") + 1)
    load_table(name, again, "o_orderkey", nulls="overwrite", load_id="a")
    return read_live(spark, name)


@query(
    "load_null_overwrite",
    f"""WITH {_PATCHY_ORDERS} SELECT o_orderkey, o_custkey, priority FROM patchy""",
)
def load_null_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """Nulls of the second load replace the values of the first, rows of nulls alone included."""
    name = new_table(spark, "load_null_overwrite")
    full = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("priority"))
    load_table(name, full, "o_orderkey", nulls="overwrite", create=True, properties=OF_SESSION, written_at=F.lit(1))
    patchy = patchy_orders(spark, d).drop("items")
    load_table(name, patchy, "o_orderkey", nulls="overwrite", written_at=F.lit(2))
    return read_live(spark, name)


@query(
    "load_ignore_nulls",
    f"""WITH {_PATCHY_ORDERS}
        SELECT o_orderkey, coalesce(p.o_custkey, o.o_custkey) AS o_custkey,
               coalesce(p.priority, o.o_orderpriority) AS priority
        FROM orders o JOIN patchy p USING (o_orderkey)""",
)
def load_ignore_nulls(spark: SparkSession, d: str) -> DataFrame:
    """Nulls of the second load leave the values of the first alone."""
    name = new_table(spark, "load_ignore_nulls")
    full = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("priority"))
    load_table(name, full, "o_orderkey", nulls="overwrite", create=True, properties=OF_SESSION, written_at=F.lit(1))
    patchy = patchy_orders(spark, d).drop("items")
    load_table(name, patchy, "o_orderkey", nulls="ignore", written_at=F.lit(2))
    return read_live(spark, name)


_VERSIONS = """SELECT o_orderkey, o_custkey,
                 CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice ELSE -o_totalprice END AS o_totalprice FROM orders"""


def two_versions(spark: SparkSession, d: str, label: str) -> str:
    """Two loads of all orders, of which the later one was written earlier for a third."""
    name = new_table(spark, label)
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    load_table(name, orders, "o_orderkey", nulls="overwrite", create=True, properties=OF_SESSION, written_at=F.lit(5))
    other = orders.withColumn("o_totalprice", -F.col("o_totalprice"))
    at = F.when(F.col("o_orderkey") % 3 == 0, 4).otherwise(6)
    load_table(name, other, "o_orderkey", nulls="overwrite", written_at=at)
    return name


@query("load_versions", _VERSIONS)
def load_versions(spark: SparkSession, d: str) -> DataFrame:
    return read_live(spark, two_versions(spark, d, "load_versions"))


@query("compact", _VERSIONS)
def compact_(spark: SparkSession, d: str) -> DataFrame:
    name = two_versions(spark, d, "compact")
    compact_table(spark, name)
    return read_live(spark, name)


@query("compact_rebucket", _VERSIONS)
def compact_rebucket(spark: SparkSession, d: str) -> DataFrame:
    """Every bucket split in two, then in two again."""
    name = two_versions(spark, d, "compact_rebucket")
    for _ in range(2):
        compact_table(spark, name, buckets=2 * table_info(spark, name).buckets)
    return read_live(spark, name)


@query("fold_loads", _VERSIONS)
def fold_loads_(spark: SparkSession, d: str) -> DataFrame:
    name = two_versions(spark, d, "fold_loads")
    fold_loads(spark, name, fanout=2)
    return read_live(spark, name)


@query(
    "purge_expired",
    f"""WITH {_LOGGED_EVENTS}
        SELECT * FROM newest WHERE ts + INTERVAL 7 DAY > TIMESTAMP '2024-02-02'""",
)
def purge_expired(spark: SparkSession, d: str) -> DataFrame:
    """Expired writes leave the table for good: the rest is read without an instant."""
    name = load_events(spark, d, "purge_expired", 7 * 86400)
    compact_table(spark, name, purge=F.lit("2024-02-02").cast("timestamp"))
    return read_live(spark, name)


@query("load_report_committed", _REPORT)
def load_report_committed(spark: SparkSession, d: str) -> DataFrame:
    """The counters of a load, from the checked copy that was committed."""
    name, rejects = new_table(spark, "report"), scratch_dir(spark, "rejects")
    create_table(spark, name, ORDER_TARGET, "o_orderkey", properties=OF_SESSION)
    return load_table(name, patchy_orders(spark, d), "o_orderkey", nulls="overwrite", rejects_path=rejects).recount


@query(
    "read_live_cells",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_totalprice
       FROM orders""",
)
def read_live_cells(spark: SparkSession, d: str) -> DataFrame:
    """Two partial loads with other times to live: cells expire one by one."""
    name = new_table(spark, "read_live_cells")
    orders = table(spark, d, "orders")
    keys = orders.select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("double").alias("o_totalprice"))
    create_table(spark, name, keys.schema, "o_orderkey", properties=OF_SESSION)
    ttl = F.when(F.col("o_orderkey") % 2 == 0, 10).otherwise(100)
    second = 1000000
    load_table(name, keys.drop("o_totalprice"), "o_orderkey", nulls="ignore", written_at=F.lit(second), ttl=ttl)
    load_table(name, keys.drop("o_custkey"), "o_orderkey", nulls="ignore", written_at=F.lit(2 * second), ttl=100)
    return read_live(spark, name, F.timestamp_seconds(F.lit(50)))


LOSSY_TARGET = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("price", T.LongType()), T.StructField("big", T.FloatType())])


@query(
    "error_rows_lossy",
    """WITH odd AS (
         SELECT o_orderkey, CAST(o_orderkey % 7 AS DOUBLE) / 2 AS price,
                CASE WHEN o_orderkey % 11 = 0 THEN 1e300 ELSE 1.5 END AS big,
                CASE WHEN o_orderkey % 13 = 0 THEN 'x' WHEN o_orderkey % 17 = 0 THEN '9223372036854775807'
                     ELSE '60' END AS life FROM orders),
       bad AS (
         SELECT *, CASE WHEN price <> floor(price) THEN 'price' END AS p,
                CASE WHEN o_orderkey % 11 = 0 THEN 'big' END AS b FROM odd)
       SELECT o_orderkey, CAST(1 AS BIGINT) AS _err_count,
              nullif(concat_ws(',', p, b), '') AS _err_fields, 'ERR_INSERT01' AS _err_code
       FROM bad WHERE p IS NOT NULL OR b IS NOT NULL OR o_orderkey % 13 = 0 OR o_orderkey % 17 = 0""",
)
def error_rows_lossy(spark: SparkSession, d: str) -> DataFrame:
    """Values a column would cut or overflow, and times to live that cannot be read or reached."""
    name, rejects = new_table(spark, "lossy"), scratch_dir(spark, "rejects")
    key = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(
        "o_orderkey",
        ((key % 7).cast("double") / 2).alias("price"),
        F.when(key % 11 == 0, 1e300).otherwise(1.5).alias("big"),
    )
    life = F.when(key % 13 == 0, "x").when(key % 17 == 0, "9223372036854775807").otherwise("60")
    create_table(spark, name, LOSSY_TARGET, "o_orderkey", properties=OF_SESSION)
    load_table(name, rows, "o_orderkey", nulls="overwrite", ttl=life, rejects_path=rejects)
    return spark.read.parquet(rejects).select("o_orderkey", "_err_count", "_err_fields", "_err_code")
