"""Literal cases of FIXTURES.md (letters) and the extra ones it asks for."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.cells import ttl, ttl_seconds
from rowloom.functions.text import fix_date, identifier, literal, row_text
from rowloom.functions.timeuuid import date_of, time_uuid, unix_timestamp_of
from rowloom.functions.types import (
    FUNCTION_TYPES,
    normalize_types,
    parse_text,
    storage_type,
)
from rowloom.keys import KeySpec, key_spec
from rowloom.operators.lookup import lookup, lookup_limit
from rowloom.operators.nested import expand_collection
from rowloom.operators.project import (
    align_to_target,
    count_star,
    first_n_columns,
    fold_name,
    project,
    project_lenient,
    select_distinct,
)
from rowloom.operators.validate import accepted, flag_rejects, rejected
from rowloom.plans.export import bulk_export, insert_script, sorted_by_key
from rowloom.sources.tables import param_query, read_table, select_query


def rows(df):
    return [tuple(r) for r in df.collect()]


def instant(spark, ms):
    return spark.sql(f"SELECT timestamp_millis({ms}) AS ts")


def test_a_select_query(spark):
    t = spark.createDataFrame([(1, "a", 0.2), (2, "b", 42.0)], "a bigint, b string, c double")
    got = rows(select_query(t, ["a", "b", "c"]).orderBy("a"))
    assert len(got) == 2 and got[1][0] == 2
    with pytest.raises(LookupError):
        select_query(t, [])


def test_missing_table_raises(spark):
    with pytest.raises(LookupError):
        read_table(spark, "/nowhere/at/all.parquet")
    with pytest.raises(LookupError):
        read_table(spark, "no_such_table", format=None)


def test_read_catalog_table_and_other_formats(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("three")
    assert read_table(spark, "three", format=None).count() == 3
    spark.range(4).write.orc(f"{tmp_path}/orc")
    assert read_table(spark, f"{tmp_path}/orc", format="orc").count() == 4
    spark.range(5).write.option("header", True).csv(f"{tmp_path}/csv")
    got = read_table(spark, f"{tmp_path}/csv", "csv", "id bigint", header=True)
    assert sorted(rows(got)) == [(i,) for i in range(5)]


def test_b_expand_collection(spark):
    t = spark.createDataFrame([(1, [1, 2, 3]), (2, []), (3, None)], "id bigint, nums array<bigint>")
    got = sorted(rows(expand_collection(t)), key=str)
    assert got == [(1, 1), (1, 2), (1, 3), (2, None), (3, None)]


def test_expand_first_column_map_keys_and_further_collections(spark):
    t = spark.createDataFrame(
        [({"x": 1}, [1, 2], {"k": "v"}), ({}, None, None)],
        "m map<string,int>, more array<int>, extra map<string,string>",
    )
    got = sorted(rows(expand_collection(t)), key=str)
    assert got == [("x", "[1,2]", '{"k":"v"}'), (None, None, None)] or got == [
        (None, None, None),
        ("x", "[1,2]", '{"k":"v"}'),
    ]
    bad = spark.createDataFrame([([1], {1: 2})], "a array<int>, m map<int,int>")
    with pytest.raises(TypeError):
        expand_collection(bad)
    plain = spark.range(2)
    assert expand_collection(plain) is plain
    with pytest.raises(TypeError):
        expand_collection(plain, "id")


def test_c_insert_script(spark):
    t = spark.createDataFrame([("n1", 2.5, True), ("n2", -1.0, False), ("n3", 0.0, None)], "node string, `Load %` double, up boolean")
    text = [
        'INSERT INTO "Fleet 7" (node,"Load %",up) VALUES (\'n1\',2.5,true)',
        'INSERT INTO "Fleet 7" (node,"Load %",up) VALUES (\'n2\',-1.0,false)',
        'INSERT INTO "Fleet 7" (node,"Load %") VALUES (\'n3\',0.0)',
    ]
    got = sorted(rows(insert_script(t, "Fleet 7", ["node"], batch_size=2)))
    assert got == [
        (0, f"BEGIN UNLOGGED BATCH {text[0]};{text[1]};APPLY BATCH;"),
        (1, f"BEGIN UNLOGGED BATCH {text[2]};APPLY BATCH;"),
    ]
    logged = rows(insert_script(t, "Fleet 7", ["node"], batch_size=3, unlogged=False, ttl=90))
    assert logged == [(0, "BEGIN BATCH " + "".join(f"{x} USING TTL 90;" for x in text) + "APPLY BATCH;")]


def test_insert_script_nulls(spark):
    t = spark.createDataFrame([(1, None)], "id int, name string")
    assert "(id) VALUES (1)" in rows(insert_script(t, "t", ["id"]))[0][1]
    written = rows(insert_script(t, "t", ["id"], nulls="overwrite"))[0][1]
    assert "(id,name) VALUES (1,null)" in written
    with pytest.raises(ValueError):
        insert_script(t, "t", ["id"], nulls="maybe")


def test_d_align_to_target(spark):
    t = spark.sql("SELECT 'p' AS extra, 3 AS Height, DATE '2020-05-06' AS born, 2.0D AS weight, true AS flag")
    target = T.StructType(
        [T.StructField("weight", T.DoubleType()), T.StructField("missing", T.StringType()), T.StructField("height", T.LongType())]
    )
    got = align_to_target(t, target)
    assert got.columns == ["weight", "height"] and rows(got) == [(2.0, 3)]
    assert got.schema["height"].dataType == T.LongType()
    assert align_to_target(t, target, keep_unknown=True).columns == ["weight", "height", "extra", "born", "flag"]


def test_e_normalize_types(spark):
    t = spark.sql(
        "SELECT CAST(7 AS SMALLINT) AS legs, TIMESTAMP '1999-12-31 23:59:59.987654' AS seen, DATE '1970-01-03' AS hatched,"
        " TIMESTAMP_NTZ '2001-02-03 04:05:06.007' AS sold, CAST(0.25 AS FLOAT) AS width,"
        " CAST(-3.5 AS DECIMAL(8, 3)) AS price, named_struct('x', 'q', 'y', 2) AS spot,"
        " X'00FF' AS mark, map('k', 1) AS tags"
    )
    n = normalize_types(t)
    millis = n.select(*[F.unix_millis(c) for c in ("seen", "hatched", "sold")])
    assert rows(millis) == [(946684799987, 2 * 86400000, 981173106007)]
    got = n.select("legs", "width", "price", "spot", "mark", "tags").first()
    assert tuple(got) == (7, 0.25, Decimal("-3.500"), '{"x":"q","y":2}', bytearray(b"\x00\xff"), {"k": 1})
    assert [n.schema[c].dataType.simpleString() for c in ("legs", "width")] == ["bigint", "double"]


def test_f_fix_date(spark):
    got = rows(instant(spark, 1523542916441).select(fix_date(F.col("ts"))))
    assert got == [(dt.date(2018, 4, 12),)]
    target = T.StructType(
        [T.StructField("date", T.DateType()), T.StructField("timestamp", T.TimestampType())]
    )
    t = spark.sql(
        "SELECT timestamp_millis(1023528397418) AS timestamp, timestamp_millis(1523542916441) AS date"
    )
    got = align_to_target(t, target).select("date", F.unix_millis("timestamp"))
    assert rows(got) == [(dt.date(2018, 4, 12), 1023528397418)]


def test_g_literal(spark):
    t = instant(spark, 1520816523456)
    assert rows(t.select(literal(F.col("ts"), T.TimestampType()))) == [
        ("'2018-03-12T01:02:03.456Z'",)
    ]
    t = spark.sql("SELECT 'it''s' AS s, true AS b, 7 AS n, CAST(NULL AS STRING) AS z")
    got = rows(t.select(*[literal(F.col(c), t.schema[c].dataType) for c in t.columns]))
    assert got == [("'it''s'", "true", "7", None)]
    for dtype in (T.BinaryType(), T.ArrayType(T.LongType())):
        with pytest.raises(TypeError):
            literal(F.col("x"), dtype)


def test_h_key_spec():
    assert key_spec("test1") == KeySpec(("test1",))
    assert key_spec(("test1", "test2")) == KeySpec(("test1",), ("test2",))
    assert key_spec((("test1", "test2"), "test3")) == KeySpec(("test1", "test2"), ("test3",))
    nested = key_spec((("test1", ("test2", "test3"), "test4"), "test5"))
    assert nested == KeySpec(("test1", "test2", "test3", "test4"), ("test5",))
    assert key_spec(((("a", "b"), "c"), "d")) == KeySpec(("a", "b", "c"), ("d",))
    for bad in ((), "", ("a", "a")):
        with pytest.raises(ValueError):
            key_spec(bad)


@pytest.mark.parametrize(
    "value, unit, seconds",
    [
        ("1", "None", -1),
        ("1", "Seconds", 1),
        ("1", "Minutes", 60),
        ("1", "Hours", 3600),
        ("1", "Days", 86400),
        ("a", "Seconds", None),
        ("", "Seconds", None),
        ("-5", "Seconds", None),
        (None, "Seconds", None),
        ("120", "Seconds", 120),
        ("+7", "Seconds", 7),
        (" 7", "Seconds", None),
        ("99999999999", "Seconds", None),
        ("2147483647", "Days", 2147483647 * 86400),
    ],
)
def test_i_ttl_seconds(spark, value, unit, seconds):
    t = spark.createDataFrame([(value, unit)], "value string, unit string")
    assert rows(t.select(ttl_seconds(F.col("value"), F.col("unit")))) == [(seconds,)]


def test_ttl_left(spark):
    t = spark.sql(
        "SELECT timestamp_millis(10500) AS a, timestamp_millis(9000) AS b, CAST(NULL AS TIMESTAMP) AS c"
    )
    now = F.timestamp_millis(F.lit(9000))
    got = t.select(*[ttl(now, c) for c in ("a", "b", "c")])
    assert rows(got) == [(1, None, None)]
    assert got.schema[0].dataType == T.IntegerType()


def test_k_bulk_export(spark, tmp_path):
    t = spark.createDataFrame([(1, "some")], "key bigint, two string")
    refused = bulk_export(t, f"{tmp_path}/out", ("key", "two"), buffer_mb=1000)
    assert refused.count() == 0
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == [(1, "some")]
    with pytest.raises(ValueError):
        bulk_export(t, f"{tmp_path}/no", "key", buffer_mb=0)


def test_bulk_export_rejects_and_versions(spark, tmp_path):
    data = [(1, "a", "x", 1), (1, "a", "", 2), (2, "", "y", 1), (None, "b", "z", 1)]
    t = spark.createDataFrame(data, "k int, c string, v string, at int")
    refused = bulk_export(t, f"{tmp_path}/out", ("k", "c"), written_at="at")
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == [(1, "a", "x", 2)]
    got = refused.select("_err_desc", "_err_code").orderBy("_err_desc")
    assert rows(got) == [
        ("null key: 2,<null>,y,1", "ERR_SSTABLE_OUTPUT_01"),
        ("null key: <null>,b,z,1", "ERR_SSTABLE_OUTPUT_01"),
    ]


def test_bulk_export_of_unique_rows_shuffles_once(spark):
    t = spark.range(100).select("id", F.lit("").alias("v"))
    once = sorted_by_key(t, "id", unique=True)
    text = once._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange rangepartitioning") == 1 and text.count("Exchange hash") == 0
    assert once.where("v IS NOT NULL").count() == 0 and once.count() == 100


def test_insert_script_keeps_bad_keys_apart(spark, tmp_path):
    t = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "id int, v string")
    with pytest.raises(ValueError):
        insert_script(t, "t", ["id"], key="id")
    got = rows(insert_script(t, "t", ["id"], key="id", rejects_path=f"{tmp_path}/bad"))
    assert spark.read.parquet(f"{tmp_path}/bad").count() == t.count() - 1
    assert got == [(0, "BEGIN UNLOGGED BATCH INSERT INTO t (id,v) VALUES (1,'a');APPLY BATCH;")]


def test_error_rows_by_type(spark):
    t = spark.sql(
        "SELECT 1 AS k, 5000000000L AS i, 'x' AS n, 1e300D AS f, TIMESTAMP '2024-02-03 04:05:06' AS d"
        " UNION ALL SELECT 2, 7L, '8', 1.5D, NULL"
    )
    target = T.StructType.fromDDL("k bigint, i int, n bigint, f decimal(10,2), d date")
    flagged = flag_rejects(t, "k", target)
    bad = rejected(flagged).select("k", "_err_fields", "_err_count", "_err_code")
    assert rows(bad) == [(1, "i,n,f", 1, "ERR_INSERT01")]
    assert rows(align_to_target(accepted(flagged), target)) == [(2, 7, 8, Decimal("1.50"), None)]
    assert accepted(flagged).columns == t.columns
    with pytest.raises(ValueError):
        flag_rejects(t, "nope", target)


def test_l_m_project(spark):
    assert fold_name('"Keep This Case"') == "Keep This Case"
    assert fold_name("FoldThis_2") == "foldthis_2"
    assert identifier("Needs Quotes") == '"Needs Quotes"'
    assert identifier("fine_9") == "fine_9"
    t = spark.createDataFrame([("a", 1.5, None, 4)], "`First` string, ratio double, note string, rank int")
    got = project(t, "RANK", ('"First"', "lead"), ("ratio", "Share"))
    assert got.columns == ["rank", "lead", "share"] and rows(got) == [(4, "a", 1.5)]
    assert project(t, F.concat("First", "rank").alias("Both In One")).columns == ["Both In One"]


def test_missing_as_string(spark):
    got = project_lenient(spark.range(1), "id", "Nope")
    assert got.columns == ["id", "nope"] and got.schema["nope"].dataType == T.StringType()
    assert rows(got) == [(0, None)]


def test_n_count_star(spark):
    got = count_star(spark.range(7))
    assert got.columns == ["count"] and rows(got) == [(7,)]
    assert rows(count_star(spark.range(0))) == [(0,)]


def test_o_first_columns_and_distinct(spark):
    t = spark.createDataFrame([(1, 2, 3), (1, 2, 4)], "a int, b int, c int")
    assert first_n_columns(t, 2).columns == ["a", "b"]
    assert first_n_columns(t, 25).columns == ["a", "b", "c"]
    assert rows(select_distinct(t, "a", "b")) == [(1, 2)]


def test_p_function_types():
    got = {n: t.simpleString() for n, t in FUNCTION_TYPES.items()}
    assert got == {
        "token": "bigint",
        "count": "bigint",
        "writetime": "bigint",
        "ttl": "int",
        "dateof": "timestamp",
        "unixtimestampof": "bigint",
    }


def test_time_uuid(spark):
    # the version-1 example of RFC 4122's successor text: 2022-02-22 19:22:22 UTC
    t = spark.createDataFrame(
        [("c232ab00-9414-11ec-b3c8-9f6bdeced846",), ("919108f7-52d1-4320-9bac-f847db4148a8",), (None,)],
        "id string",
    )
    got = rows(t.select(unix_timestamp_of(F.col("id")), date_of(F.col("id")).cast("string")))
    assert got == [(1645557742000, "2022-02-22 19:22:22"), (None, None), (None, None)]
    old = spark.sql("SELECT timestamp_micros(-1500) AS ts")
    assert rows(old.select(unix_timestamp_of(time_uuid(F.col("ts"))))) == [(-2,)]


def test_row_text(spark):
    t = spark.createDataFrame([("a", None, [1])], "x string, y int, z array<int>")
    assert rows(t.select(row_text(t))) == [("a,<null>,[1]",)]


def test_storage_types():
    assert storage_type(T.IntegerType()) == T.LongType()
    assert storage_type(T.FloatType()) == T.DoubleType()
    assert storage_type(T.DateType()) == T.TimestampType()
    assert storage_type(T.DecimalType(5, 2)) == T.DecimalType(38, 18)
    assert storage_type(T.BinaryType()) == T.BinaryType()
    for nested in (T.ArrayType(T.LongType()), T.MapType(T.StringType(), T.LongType())):
        with pytest.raises(TypeError):
            storage_type(nested)


@pytest.mark.parametrize("target", ["bigint", "int", "double", "boolean", "decimal(10,2)"])
def test_parse_text_equals_try_cast(spark, target):
    texts = ["1", " 2 ", "+3", "-4", "007", "1.5", ".5", "5.", "1e3", "1E-2", "0x1p3", "Infinity",
             "-inf", "NaN", "nan", "x", "", " ", "1 2", "9223372036854775808", "true", "T", "No",
             " yes ", "off", "1d", "2f", "\t8\n", "--1", "é", None]
    t = spark.createDataFrame([(x,) for x in texts], "x string")
    dtype = T.StructType.fromDDL(f"x {target}")[0].dataType
    got = t.select("x", parse_text(F.col("x"), dtype).cast("string"), F.col("x").try_cast(dtype).cast("string"))
    assert [r for r in rows(got) if r[1] != r[2]] == []


def test_param_query(spark):
    spark.range(10).createOrReplaceTempView("ten")
    text = "SELECT id FROM identifier(:t) WHERE id > :low"
    assert rows(param_query(spark, text, {"t": "ten", "low": 7})) == [(8,), (9,)]
    quoted = param_query(spark, "SELECT :v AS v", {"v": "it's; DROP"})
    assert rows(quoted) == [("it's; DROP",)]


def test_lookup_edges(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "k int, v string")
    none = spark.createDataFrame([], "id int")
    assert rows(lookup(none, target, {"k": "id"})) == []
    driver = spark.createDataFrame([(1,), (1,), (3,), (None,)], "id int")
    got = sorted(rows(lookup(driver, target, {"k": "id"})))
    assert got == [(1, "a"), (1, "a"), (1, "b"), (1, "b")]
    limited = lookup_limit(driver, target, {"k": "id"}, [F.col("v").desc()], 1)
    assert rows(limited) == [(1, "b"), (1, "b")] and limited.columns == ["k", "v"]
    same_name = lookup(driver.withColumnRenamed("id", "k"), target, "k")
    assert same_name.columns == ["k", "v"] and same_name.count() == 4
    with pytest.raises(ValueError):
        lookup(driver, target, {})
    with pytest.raises(ValueError):
        lookup_limit(driver, target, {"k": "id"}, [], 1)
