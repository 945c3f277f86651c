"""Column functions and collections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.common import query, table
from rowloom.functions.cells import ttl, ttl_seconds, writetime
from rowloom.functions.text import fix_date, literal, row_text
from rowloom.functions.timeuuid import date_of, time_uuid, unix_timestamp_of
from rowloom.functions.tokens import token
from rowloom.operators.nested import expand_collection
from rowloom.operators.token_ranges import (
    TokenRanges,
    scan_token_range,
    token_ranges,
    write_token_ranges,
)
from rowloom.operators.upsert import latest_rows, with_ttl
from rowloom.functions.cells import to_micros
from rowloom.session import scratch_dir


_M = "18446744073709551616::UHUGEINT"


def _sql_mul(x: str, c: int) -> str:
    return f"(({x}::UHUGEINT * {c}::UHUGEINT) % {_M})::UBIGINT"


def _sql_add(x: str, y: str) -> str:
    return f"(({x}::UHUGEINT + {y}::UHUGEINT) % {_M})::UBIGINT"


def _sql_rotl(x: str, r: int) -> str:
    return f"(({x}::UHUGEINT * {1 << r}::UHUGEINT) % {_M} + ({x} // {1 << (64 - r)}))::UBIGINT"


def _sql_xor_high(x: str) -> str:
    return f"xor({x}, ({x} // {1 << 33})::UBIGINT)"


def _sql_signed_byte(i: int) -> str:
    """Byte ``i`` of the big-endian key, sign-extended and moved to its place."""
    b = f"((k // {256 ** (7 - i)}::UHUGEINT) % 256)"
    value = f"(CASE WHEN {b} < 128 THEN {b} ELSE {_M} - 256 + {b} END)"
    return f"(({value} * {256 ** i}::UHUGEINT) % {_M})::UBIGINT"


def _murmur3_sql() -> str:
    """Murmur3 x64-128 of an eight-byte key as SQL steps over unsigned integers."""
    c1, c2 = 0x87C37B91114253D5, 0x4CF5AD432745937F
    f1, f2 = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53
    tail = _sql_signed_byte(0)
    for i in range(1, 8):
        tail = f"xor({tail}, {_sql_signed_byte(i)})"
    steps = [
        ("w0", "id, " + tail + " AS x", "keys"),
        ("w1", f"id, {_sql_mul('x', c1)} AS x", "w0"),
        ("w2", f"id, {_sql_rotl('x', 31)} AS x", "w1"),
        ("w3", f"id, {_sql_mul('x', c2)} AS x", "w2"),
        ("w4", "id, xor(x, 8::UBIGINT) AS h1, 8::UBIGINT AS h2", "w3"),
        ("w5", f"id, {_sql_add('h1', 'h2')} AS h1, h2", "w4"),
        ("w6", f"id, h1, {_sql_add('h1', 'h2')} AS h2", "w5"),
        ("w7", f"id, {_sql_xor_high('h1')} AS h1, {_sql_xor_high('h2')} AS h2", "w6"),
        ("w8", f"id, {_sql_mul('h1', f1)} AS h1, {_sql_mul('h2', f1)} AS h2", "w7"),
        ("w9", f"id, {_sql_xor_high('h1')} AS h1, {_sql_xor_high('h2')} AS h2", "w8"),
        ("w10", f"id, {_sql_mul('h1', f2)} AS h1, {_sql_mul('h2', f2)} AS h2", "w9"),
        ("w11", f"id, {_sql_xor_high('h1')} AS h1, {_sql_xor_high('h2')} AS h2", "w10"),
        ("w12", f"id, {_sql_add('h1', 'h2')} AS h", "w11"),
    ]
    ctes = ["keys AS (SELECT o_orderkey AS id, o_orderkey::UHUGEINT AS k FROM orders)"]
    ctes += [f"{name} AS MATERIALIZED (SELECT {what} FROM {source})" for name, what, source in steps]
    half = 1 << 63
    signed = f"CASE WHEN h < {half} THEN h::HUGEINT ELSE h::HUGEINT - {1 << 64}::HUGEINT END"
    return (
        "WITH " + ",\n".join(ctes) + f"\nSELECT id AS o_orderkey, ({signed})::BIGINT AS token FROM w12"
    )


def _xxhash64_sql() -> str:
    """XXH64 of two bigints in turn, each seeded with the hash before it (the first with 42),
    as SQL steps over unsigned integers."""
    p1, p2, p3 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
    p4, p5 = 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
    unsigned = "(CASE WHEN {0} < 0 THEN {0}::HUGEINT + 18446744073709551616::HUGEINT ELSE {0} END)::UBIGINT"
    ctes = [f"t0 AS (SELECT o_orderkey AS id, {unsigned.format('o_custkey')} AS a, {unsigned.format('o_orderkey')} AS b, 42::UBIGINT AS h FROM orders)"]
    n = 0

    def step(h: str, *, x: str | None = None) -> None:
        nonlocal n
        more = "" if x is None else f", {x} AS x"
        ctes.append(f"t{n + 1} AS MATERIALIZED (SELECT id, a, b, {h} AS h{more} FROM t{n})")
        n += 1

    for key in "ab":
        step(_sql_add("h", f"{(p5 + 8) % (1 << 64)}"), x=_sql_mul(key, p2))
        step("h", x=_sql_rotl("x", 31))
        step("h", x=_sql_mul("x", p1))
        step("xor(h, x)")
        step(_sql_rotl("h", 27))
        step(_sql_mul("h", p1))
        step(_sql_add("h", str(p4)))
        for shift, factor in ((33, p2), (29, p3), (32, None)):
            step(f"xor(h, (h // {1 << shift})::UBIGINT)")
            if factor:
                step(_sql_mul("h", factor))
    signed = f"CASE WHEN h < {1 << 63} THEN h::HUGEINT ELSE h::HUGEINT - {1 << 64}::HUGEINT END"
    return "WITH " + ",\n".join(ctes) + f"\nSELECT id AS o_orderkey, ({signed})::BIGINT AS token FROM t{n}"


@query("token", _xxhash64_sql())
def token_(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    return orders.select("o_orderkey", token(orders, ["o_custkey", "o_orderkey"]).alias("token"))


@query("token_murmur3", _murmur3_sql())
def token_murmur3(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    exact = token(orders, ["o_orderkey"], "Murmur3Partitioner")
    return orders.select("o_orderkey", exact.alias("token"))


@query(
    "token_partitioners",
    """SELECT c_custkey, md5(c_name) AS random, hex(c_name) AS ordered,
              '0008' || format('{:016X}', c_custkey) || '00'
              || format('{:04X}', length(c_mktsegment)) || hex(c_mktsegment) || '00' AS packed
       FROM customer""",
)
def token_partitioners(spark: SparkSession, d: str) -> DataFrame:
    customer = table(spark, d, "customer")
    return customer.select(
        "c_custkey",
        token(customer, ["c_name"], "RandomPartitioner").alias("random"),
        F.hex(token(customer, ["c_name"], "ByteOrderedPartitioner")).alias("ordered"),
        F.hex(token(customer, ["c_custkey", "c_mktsegment"], "ByteOrderedPartitioner")).alias(
            "packed"
        ),
    )


RANGES = 16


def stored_ranges(spark: SparkSession, d: str) -> tuple[DataFrame, str, TokenRanges]:
    """Events stored by the token of their user; a third of them are those of one user."""
    hot = F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id"))
    events = table(spark, d, "events").select("event_id", hot.cast("long").alias("user_id"))
    own = token(events, ["user_id"])
    ranges = token_ranges(events, own, RANGES)
    path = scratch_dir(spark, "token-ranges")
    write_token_ranges(events, path, own, ranges)
    return events, path, ranges


@query(
    "token_ranges",
    "SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_events, true AS even FROM events",
)
def token_ranges_(spark: SparkSession, d: str) -> DataFrame:
    """Every row is in one range, none is 10 % larger than its share."""
    _, path, _ = stored_ranges(spark, d)
    stored = spark.read.parquet(path).groupBy("_range", "event_id").agg(F.count("*").alias("n"))
    sizes = stored.groupBy("_range").agg(F.sum("n").alias("n"), F.count("*").alias("events"))
    largest, total = F.max("n"), F.sum("n")
    return sizes.agg(
        total.alias("n_rows"),
        F.sum("events").alias("n_events"),
        (largest <= 1.1 * total / RANGES).alias("even"),
    )


@query(
    "token_range_scan",
    "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id FROM events",
)
def token_range_scan(spark: SparkSession, d: str) -> DataFrame:
    """All ranges, each read on its own."""
    _, path, ranges = stored_ranges(spark, d)
    scans = [scan_token_range(spark, path, i, r.low, r.high) for i, r in enumerate(ranges.ranges)]
    return reduce(DataFrame.union, scans)


def event_log(spark: SparkSession, d: str) -> DataFrame:
    """Events as a log of writes, written at their time stamp."""
    return table(spark, d, "events").withColumn("_writetime", to_micros(F.col("ts")))


EVENT_KEY = ("user_id", "event_type")


@query(
    "writetime",
    """SELECT user_id, event_type, max(epoch_us(ts)) AS written
       FROM events GROUP BY user_id, event_type""",
)
def writetime_(spark: SparkSession, d: str) -> DataFrame:
    newest = latest_rows(event_log(spark, d), EVENT_KEY)
    return newest.select("user_id", "event_type", writetime().alias("written"))


@query(
    "ttl",
    """SELECT event_id,
              CASE WHEN epoch_us(ts) + 864000000000 > epoch_us(TIMESTAMP '2024-01-20 12:00:00')
                   THEN CAST((epoch_us(ts) + 864000000000
                              - epoch_us(TIMESTAMP '2024-01-20 12:00:00')) // 1000000 AS INTEGER)
              END AS seconds_left
       FROM events""",
)
def ttl_(spark: SparkSession, d: str) -> DataFrame:
    written = with_ttl(event_log(spark, d), 10 * 86400)
    as_of = F.lit("2024-01-20 12:00:00").cast("timestamp")
    return written.select("event_id", ttl(as_of).alias("seconds_left"))


@query("date_of", "SELECT event_id, date_trunc('millisecond', ts) AS at FROM events")
def date_of_(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "events").select("event_id", time_uuid(F.col("ts")).alias("id"))
    return ids.select("event_id", date_of(F.col("id")).alias("at"))


@query("unix_timestamp_of", "SELECT event_id, epoch_us(ts) // 1000 AS millis FROM events")
def unix_timestamp_of_(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "events").select("event_id", time_uuid(F.col("ts")).alias("id"))
    return ids.select("event_id", unix_timestamp_of(F.col("id")).alias("millis"))


@query("fix_date", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def fix_date_(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", fix_date(F.col("ts")).alias("day"))


@query(
    "cql_literal",
    """SELECT page_id, CAST(page_id AS VARCHAR) AS id_literal,
              '''' || replace(url, '''', '''''') || '''' AS url_literal,
              '''' || replace(html, '''', '''''') || '''' AS html_literal
       FROM pages""",
)
def literal_text(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    names = {"page_id": "id_literal", "url": "url_literal", "html": "html_literal"}
    literals = [literal(F.col(c), pages.schema[c].dataType).alias(a) for c, a in names.items()]
    return pages.select("page_id", *literals)


@query(
    "cql_literal_instant",
    """SELECT event_id, '''' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z''' AS at_literal,
              CASE WHEN value > 25 THEN 'true' ELSE 'false' END AS flag_literal
       FROM events""",
)
def literal_instant(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").withColumn("flag", F.col("value") > 25)
    return events.select(
        "event_id",
        literal(F.col("ts"), events.schema["ts"].dataType).alias("at_literal"),
        literal(F.col("flag"), events.schema["flag"].dataType).alias("flag_literal"),
    )


@query(
    "row_text",
    """SELECT o_orderkey,
              concat_ws(',', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus,
                        CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR),
                        CAST(o_orderdate AS VARCHAR),
                        coalesce(nullif(o_orderpriority, '5-LOW'), '<null>')) AS row_text
       FROM orders""",
)
def row_text_(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").withColumns(
        {
            "o_totalprice": F.col("o_totalprice").cast("decimal(18,2)"),
            "o_orderpriority": F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")),
        }
    )
    return orders.select("o_orderkey", row_text(orders).alias("row_text"))


@query(
    "ttl_seconds",
    """WITH settings AS (
         SELECT o_orderkey,
                CASE o_orderpriority WHEN '1-URGENT' THEN o_orderpriority WHEN '5-LOW' THEN ''
                     WHEN '3-MEDIUM' THEN CAST(-o_custkey AS VARCHAR)
                     ELSE CAST(o_custkey AS VARCHAR) END AS value,
                CASE o_orderstatus WHEN 'O' THEN 'Minutes' WHEN 'F' THEN 'Days'
                     WHEN 'P' THEN 'None' END AS unit
         FROM orders)
       SELECT o_orderkey,
              CASE WHEN TRY_CAST(value AS INTEGER) IS NULL OR value LIKE '-%' THEN NULL
                   WHEN unit = 'None' THEN -1
                   WHEN unit = 'Minutes' THEN CAST(value AS BIGINT) * 60
                   ELSE CAST(value AS BIGINT) * 86400 END AS seconds
       FROM settings""",
)
def ttl_seconds_(spark: SparkSession, d: str) -> DataFrame:
    priority, customer = F.col("o_orderpriority"), F.col("o_custkey")
    value = (
        F.when(priority == "1-URGENT", priority)
        .when(priority == "5-LOW", "")
        .when(priority == "3-MEDIUM", (-customer).cast("string"))
        .otherwise(customer.cast("string"))
    )
    status = F.col("o_orderstatus")
    unit = F.when(status == "O", "Minutes").when(status == "F", "Days").when(status == "P", "None")
    orders = table(spark, d, "orders")
    return orders.select("o_orderkey", ttl_seconds(value, unit).alias("seconds"))


@query(
    "expand_collection",
    """WITH vectors AS (SELECT vec_id, CASE WHEN label = 0 THEN [] ELSE embedding END AS element,
                               label FROM embeddings)
       SELECT vec_id, unnest(element) AS element, label FROM vectors
       UNION ALL
       SELECT vec_id, NULL, label FROM vectors WHERE len(element) = 0""",
)
def expand_collection_(spark: SparkSession, d: str) -> DataFrame:
    empty = F.array().cast("array<float>")
    vectors = table(spark, d, "embeddings").select(
        "vec_id",
        F.when(F.col("label") == 0, empty).otherwise(F.col("embedding")).alias("element"),
        "label",
    )
    return expand_collection(vectors)


@query(
    "expand_collection_text",
    """WITH numbers AS (SELECT doc_id, lang, regexp_extract_all(text, '[0-9]+') AS number
                        FROM documents)
       SELECT doc_id, lang, unnest(number) AS number FROM numbers
       UNION ALL
       SELECT doc_id, lang, NULL FROM numbers WHERE len(number) = 0""",
)
def expand_collection_text(spark: SparkSession, d: str) -> DataFrame:
    found = F.regexp_extract_all(F.col("text"), F.lit("[0-9]+"), F.lit(0))
    docs = table(spark, d, "documents").select("doc_id", "lang", found.alias("number"))
    return expand_collection(docs)


@query(
    "expand_map_keys",
    "SELECT event_id, unnest(json_keys(props)) AS props, value FROM events",
)
def expand_map_keys(spark: SparkSession, d: str) -> DataFrame:
    props = F.from_json("props", "map<string,bigint>").alias("props")
    return expand_collection(table(spark, d, "events").select("event_id", props, "value"))


@query(
    "extra_collections_text",
    """SELECT event_id, unnest([user_id, event_id]) AS ids, CAST(json(props) AS VARCHAR) AS props,
              '["' || event_type || '","' || user_id || '"]' AS tags
       FROM events""",
)
def extra_collections_text(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select(
        "event_id",
        F.array("user_id", "event_id").alias("ids"),
        F.from_json("props", "map<string,bigint>").alias("props"),
        F.array("event_type", F.col("user_id").cast("string")).alias("tags"),
    )
    return expand_collection(events)
