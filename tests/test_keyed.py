"""Upserts and keyed tables: laws, and random logs against a plain-Python model."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.operators.upsert import (
    latest_cells,
    latest_rows,
    live_cells,
    live_rows,
    upsert,
    winning_writes,
    with_ttl,
)
from rowloom.plans import load as load_module
from rowloom.plans.load import (
    compact_table,
    create_table,
    evolve_table,
    load_table,
    loads,
    read_live,
    table_info,
    value_schema,
)

LOG = "p int, c int, a int, b string, _writetime bigint, _seq bigint, _expires_at timestamp, _written array<string>"
KEY = ("p", "c")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_log(spark, seed, count=300):
    rng = random.Random(seed)
    out = []
    for seq in range(count):
        a = rng.choice([None, 1, 2, 3])
        b = rng.choice([None, "x", "y", ""])
        at = rng.randrange(20)
        expires = None if rng.random() < 0.5 else at + rng.randrange(1, 10)
        written = rng.choice([None, ["a"], ["b"], ["a", "b"]])
        out.append((rng.randrange(4), rng.randrange(3), a, b, at, seq, expires, written))
    df = spark.createDataFrame(out, LOG.replace("_expires_at timestamp", "e bigint"))
    df = df.withColumn("_expires_at", F.timestamp_seconds("e")).drop("e")
    return out, df


def model_cells(log, as_of):
    """Newest write per cell, then expiry; a row shows while its newest write or a cell is live."""
    keys = {}
    for p, c, a, b, at, seq, expires, written in log:
        cells = keys.setdefault((p, c), {"a": None, "b": None, "row": None})
        mark = (at, seq)
        if cells["row"] is None or mark > cells["row"][0]:
            cells["row"] = (mark, expires)
        for name, value in (("a", a), ("b", b)):
            wrote = value is not None or (written and name in written)
            if wrote and (cells[name] is None or mark > cells[name][0]):
                cells[name] = (mark, expires, value)
    out = []
    for key, cells in keys.items():
        live = lambda e: as_of is None or e is None or e > as_of
        values = [
            cells[n][2] if cells[n] is not None and live(cells[n][1]) else None for n in ("a", "b")
        ]
        if live(cells["row"][1]) or any(v is not None for v in values):
            out.append((*key, *values))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("as_of", [None, 8, 19])
def test_live_cells_and_winning_writes_match_model(spark, seed, as_of):
    log, df = random_log(spark, seed)
    now = None if as_of is None else F.timestamp_seconds(F.lit(as_of))
    want = model_cells(log, as_of)
    shown = live_cells(df, KEY, now, ties=["_seq"]).select("p", "c", "a", "b")
    assert rows(shown) == want
    stamp = ["_writetime", "_seq", "_expires_at"]
    kept = winning_writes(df, KEY, stamp)
    per_key = kept.groupBy(*KEY).count().agg(F.max("count")).first()[0]
    assert per_key <= 3
    again = live_cells(kept, KEY, now, ties=["_seq"]).select("p", "c", "a", "b")
    assert rows(again) == want
    assert rows(winning_writes(kept, KEY, stamp)) == rows(kept.select(*winning_writes(kept, KEY, stamp).columns))


@pytest.mark.parametrize("seed", range(3))
def test_latest_rows_and_cells_match_model(spark, seed):
    log, df = random_log(spark, seed)
    df = df.select("p", "c", "a", "b", "_writetime", "_seq")
    newest = {}
    for p, c, a, b, at, seq, _, _ in log:
        if (p, c) not in newest or (at, seq) > newest[(p, c)][:2]:
            newest[(p, c)] = (at, seq, a, b)
    want = sorted(((*k, v[2], v[3]) for k, v in newest.items()), key=str)
    assert rows(latest_rows(df, KEY, ties=["_seq"]).select("p", "c", "a", "b")) == want
    blank = [(p, c, a, b or None, at, seq, None, None) for p, c, a, b, at, seq, _, _ in log]
    cells = latest_cells(df, KEY, ties=["_seq"], blank_is_null=True).select("p", "c", "a", "b")
    assert rows(cells) == model_cells(blank, None)


def test_equal_write_times_do_not_depend_on_layout(spark):
    _, df = random_log(spark, 9)
    df = df.select("p", "c", "a", "b", F.lit(1).cast("bigint").alias("_writetime"))
    mixed = df.orderBy(F.rand(3)).repartition(7)
    assert rows(latest_rows(df, KEY)) == rows(latest_rows(mixed, KEY))
    assert rows(latest_cells(df, KEY)) == rows(latest_cells(mixed, KEY))


@pytest.mark.parametrize("nulls", ["overwrite", "ignore"])
def test_upsert_twice_is_upsert_once(spark, nulls):
    _, base = random_log(spark, 1)
    _, changes = random_log(spark, 2)
    base, changes = (d.select("p", "c", "a", "b", "_writetime", "_seq") for d in (base, changes))
    start = latest_rows(base, KEY)
    once = upsert(start, changes, KEY, nulls=nulls)
    assert rows(upsert(once, changes, KEY, nulls=nulls)) == rows(once)
    assert once.groupBy(*KEY).count().where("count > 1").count() == 0


def test_cells_may_hold_maps(spark):
    log = spark.sql(
        "SELECT 1 AS k, map('a', 1) AS m, array(map('x', 1)) AS l, 1L AS _writetime UNION ALL "
        "SELECT 1, map('b', 2), NULL, 2L UNION ALL SELECT 1, map('c', 3), NULL, 2L"
    )
    assert latest_cells(log, "k").collect()[0][1:] == ({"c": 3}, [{"x": 1}], 2)
    assert latest_rows(log, "k").collect()[0][1:] == ({"c": 3}, None, 2)


def test_upsert_needs_a_null_rule(spark):
    df = spark.createDataFrame([(1, 1)], "k int, _writetime bigint")
    with pytest.raises(TypeError):
        upsert(df, df, "k")
    with pytest.raises(ValueError):
        upsert(df, df, "k", nulls="sometimes")


def test_nulls_overwrite_or_leave_alone(spark):
    base = spark.createDataFrame([(1, "old", 1)], "k int, v string, _writetime bigint")
    change = spark.createDataFrame([(1, None, 2)], "k int, v string, _writetime bigint")
    assert rows(upsert(base, change, "k", nulls="overwrite")) == [(1, None, 2)]
    assert rows(upsert(base, change, "k", nulls="ignore")) == [(1, "old", 2)]


def test_expired_winner_does_not_revive_older_version(spark):
    log = spark.createDataFrame(
        [(1, "old", 0, None), (1, "new", 1_000_000, 5)], "k int, v string, _writetime bigint, ttl int"
    )
    log = with_ttl(log, F.col("ttl")).drop("ttl")
    newest = latest_rows(log, "k")
    assert live_rows(newest, F.timestamp_seconds(F.lit(5))).count() == 1
    assert live_rows(newest, F.timestamp_seconds(F.lit(6))).count() == 0
    for seconds in (None, 0, -3):
        assert with_ttl(log, seconds).where("_expires_at IS NOT NULL").count() == 0


def frame(spark, data, schema="k bigint, a string, n bigint"):
    return spark.createDataFrame(data, schema)


def test_load_creates_upserts_and_reports(spark, table_name):
    first = load_table(
        table_name, frame(spark, [(1, "x", 1), (2, "y", 2), (None, "z", 3), (4, None, None)]), "k",
        nulls="overwrite", create=True, written_at=F.lit(10),
    )
    assert first.report == {"rows_read": 4, "rows_written": 3, "rows_rejected": 1, "errors": 1}
    assert [r["_err_desc"] for r in first.rejects.collect()] == ["null key: <null>,z,3"]
    assert first.rejects.columns == ["k", "a", "n", "_err_count", "_err_desc", "_err_fields", "_err_code"]
    load_table(table_name, frame(spark, [(2, None, 5)]), "k", nulls="overwrite", written_at=F.lit(11))
    load_table(table_name, frame(spark, [(1, "late", 9)]), "k", nulls="overwrite", written_at=F.lit(9))
    assert rows(read_live(spark, table_name)) == [(1, "x", 1), (2, None, 5), (4, None, None)]
    assert table_info(spark, table_name).key.columns == ["k"]
    assert first.recount.first().asDict() == first.report
    assert value_schema(spark, table_name).names == ["k", "a", "n"]


def test_load_by_cell(spark, table_name):
    load_table(table_name, frame(spark, [(1, "x", 1), (2, "y", 2)]), "k",
               nulls="overwrite", create=True, written_at=F.lit(1))
    load_table(table_name, frame(spark, [(1, None, 7), (2, "w", None)]), "k",
               nulls="ignore", written_at=F.lit(2))
    assert rows(read_live(spark, table_name)) == [(1, "x", 7), (2, "w", 2)]
    partial = frame(spark, [(2, "short")], "k bigint, a string")
    load_table(table_name, partial, "k", nulls="overwrite", written_at=F.lit(3), ttl=10)
    assert rows(read_live(spark, table_name)) == [(1, "x", 7), (2, "short", 2)]
    later = F.timestamp_seconds(F.lit(60))
    assert rows(read_live(spark, table_name, later)) == [(1, "x", 7), (2, None, 2)]
    before = rows(read_live(spark, table_name, stamps=True))
    compact_table(spark, table_name)
    assert len(loads(spark, table_name)) == 1
    assert rows(read_live(spark, table_name, stamps=True)) == before


def test_partial_overwrite_writes_only_its_columns(spark, table_name):
    load_table(table_name, frame(spark, [(1, "x", 1)]), "k",
               nulls="overwrite", create=True, written_at=F.lit(1))
    wide = frame(spark, [(1, None, True)], "k bigint, a string, flag boolean")
    load_table(table_name, wide, "k", nulls="overwrite", written_at=F.lit(2))
    # `a` was written as null, `n` was not written, `flag` is unknown and dropped
    assert rows(read_live(spark, table_name)) == [(1, None, 1)]


def test_evolve_keeps_old_cells(spark, table_name):
    load_table(table_name, frame(spark, [(1, "x", 1), (2, "y", 2)]), "k",
               nulls="overwrite", create=True, written_at=F.lit(5))
    wide = frame(spark, [(1, "w", 3, 1.5)], "k bigint, a string, n bigint, extra float")
    load_table(table_name, wide, "k", nulls="overwrite", evolve=True, written_at=F.lit(4))
    # the older write time loses `a` and `n`, but nobody else wrote `extra`
    assert rows(read_live(spark, table_name)) == [(1, "x", 1, 1.5), (2, "y", 2, None)]
    assert value_schema(spark, table_name)["extra"].dataType == T.DoubleType()
    assert evolve_table(spark, table_name, wide) == []


def test_ttl_by_load_and_by_row(spark, table_name):
    data = frame(spark, [(1, "x", 1), (2, "y", 100)])
    load_table(table_name, data, "k", nulls="overwrite", create=True,
               written_at=F.lit(0), ttl=F.col("n"))
    live = lambda s: rows(read_live(spark, table_name, F.timestamp_seconds(F.lit(s))).select("k"))
    assert live(0) == [(1,), (2,)] and live(1) == [(2,)] and live(100) == []
    assert read_live(spark, table_name).count() == 2


def test_input_may_carry_its_own_stamps(spark, table_name):
    data = frame(spark, [(1, "new", 9, 3), (1, "old", 8, 3), (2, "x", 1, 0)],
                 "k bigint, a string, _writetime bigint, keep bigint")
    load_table(table_name, data, "k", nulls="overwrite", create=True,
               written_at=F.col("_writetime"), ttl=F.col("keep"))
    assert value_schema(spark, table_name).names == ["k", "a", "keep"]
    got = read_live(spark, table_name, stamps=True).select("k", "a", "_writetime", "_expires_at")
    assert [r[:3] for r in rows(got)] == [(1, "new", 9), (2, "x", 1)]
    assert got.where("_expires_at IS NULL").select("k").collect()[0][0] == 2


def test_truncate_and_replay(spark, table_name):
    load_table(table_name, frame(spark, [(1, "x", 1), (2, "y", 2)]), "k",
               nulls="overwrite", create=True)
    again = load_table(table_name, frame(spark, [(3, "z", 3)]), "k",
                       nulls="overwrite", truncate=True, load_id="day-1")
    assert loads(spark, table_name) == ["day-1"] and again.load_id == "day-1"
    load_table(table_name, frame(spark, [(3, "z", 4)]), "k", nulls="overwrite", load_id="day-1")
    assert rows(read_live(spark, table_name)) == [(3, "z", 4)]


def test_failed_load_leaves_the_table_as_it_was(spark, table_name):
    load_table(table_name, frame(spark, [(1, "x", 1)]), "k", nulls="overwrite", create=True)
    broken = frame(spark, [(2, "y", 2)]).withColumn("n", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        load_table(table_name, broken, "k", nulls="overwrite", truncate=True)
    assert rows(read_live(spark, table_name)) == [(1, "x", 1)]
    assert len(loads(spark, table_name)) == 1


def test_load_refuses(spark, table_name):
    data = frame(spark, [(1, "x", 1)])
    with pytest.raises(LookupError):
        load_table(table_name, data, "k", nulls="overwrite")
    with pytest.raises(ValueError, match="key fields"):
        load_table(table_name, data, "missing", nulls="overwrite", create=True)
    assert not spark.catalog.tableExists(table_name)
    with pytest.raises(TypeError):
        load_table(table_name, data, "k", create=True)
    with pytest.raises(ValueError):
        load_table(table_name, data, "k", nulls="overwrite", create=True, load_id="a/b")
    load_table(table_name, data, "k", nulls="overwrite", create=True)
    with pytest.raises(ValueError, match="has the key"):
        load_table(table_name, data, "a", nulls="overwrite")
    nested = spark.createDataFrame([(1, [1])], "k bigint, l array<int>")
    with pytest.raises(TypeError):
        load_table(table_name + "_nested", nested, "k", nulls="overwrite", create=True)


def test_load_into_other_bucket_count_writes_one_file_per_bucket(spark, table_name):
    schema = T.StructType.fromDDL("k bigint, a string, n bigint")
    create_table(spark, table_name, schema, "k", buckets=3, properties={"comment": "it's"})
    data = spark.range(200).select(F.col("id").alias("k"), F.lit("x").alias("a"), F.col("id").alias("n"))
    load_table(table_name, data, "k", nulls="overwrite")
    assert table_info(spark, table_name).buckets == 3
    assert len(spark.table(table_name).inputFiles()) == 3
    assert read_live(spark, table_name).count() == 200


@pytest.mark.parametrize("nulls", ["overwrite", "ignore"])
def test_unique_loads_skip_the_reduction_but_stay_right(spark, table_name, nulls):
    data = [(1, "x", 1), (1, "y", 2), (2, "z", 3)]
    load_table(table_name, frame(spark, data), "k", nulls=nulls, create=True, unique=True,
               written_at=F.col("n"))
    assert not table_info(spark, table_name).reduced
    assert rows(read_live(spark, table_name)) == [(1, "y", 2), (2, "z", 3)]
    compact_table(spark, table_name)
    assert table_info(spark, table_name).reduced
    assert rows(read_live(spark, table_name)) == [(1, "y", 2), (2, "z", 3)]


def test_one_whole_load_is_read_by_a_plain_scan(spark, table_name):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    load_table(table_name, frame(spark, [(1, "x", 1), (1, "y", 2)]), "k", nulls="overwrite",
               create=True, written_at=F.col("n"), ttl=5)
    single = read_live(spark, table_name)
    assert "Window" not in plan(single) and "Sort" not in plan(single)
    load_table(table_name, frame(spark, [(1, "z", 3)]), "k", nulls="overwrite", written_at=F.col("n"))
    assert "Window" in plan(read_live(spark, table_name))
    assert rows(single) == [(1, "y", 2)] and rows(read_live(spark, table_name)) == [(1, "z", 3)]
    compact_table(spark, table_name)
    assert "Window" not in plan(read_live(spark, table_name))
    assert rows(read_live(spark, table_name)) == [(1, "z", 3)]
    load_table(table_name, frame(spark, [(9, None, 1)]), "k", nulls="ignore", truncate=True, unique=True)
    load_table(table_name, frame(spark, [(8, "t", 1)]), "k", nulls="overwrite", truncate=True)
    assert "Window" not in plan(read_live(spark, table_name))
    assert rows(read_live(spark, table_name)) == [(8, "t", 1)]


def test_compact_rows(spark, table_name):
    for at in range(3):
        load_table(table_name, frame(spark, [(1, f"v{at}", at), (at + 10, "o", 0)]), "k",
                   nulls="overwrite", create=True, written_at=F.lit(at))
    before = rows(read_live(spark, table_name))
    compact_table(spark, table_name)
    assert spark.table(table_name).count() == len(before) == 4
    assert rows(read_live(spark, table_name)) == before


def test_failing_reload_of_a_load_keeps_its_rows(spark, table_name):
    load_table(table_name, frame(spark, [(1, "x", 1), (2, "y", 2)]), "k", nulls="overwrite", create=True, load_id="a")
    broken = frame(spark, [(3, "z", 3)]).withColumn("n", F.raise_error(F.lit("stop")).cast("int"))
    with pytest.raises(Exception):
        load_table(table_name, broken, "k", nulls="overwrite", load_id="a")
    want = [(1, "x", 1), (2, "y", 2)]
    assert rows(read_live(spark, table_name)) == want
    assert rows(read_live(spark.newSession(), table_name)) == want
    load_table(table_name, frame(spark, [(2, "w", 9)]), "k", nulls="overwrite", load_id="a")
    assert rows(read_live(spark, table_name)) == [(2, "w", 9)]


def test_crash_before_the_drop_counts_the_newest_attempt(spark, table_name, monkeypatch):
    load_table(table_name, frame(spark, [(1, "x", 1), (2, "y", 2)]), "k", nulls="overwrite", create=True, load_id="a")
    monkeypatch.setattr(load_module, "_drop_attempts", lambda *_: None)
    load_table(table_name, frame(spark, [(2, "w", 9)]), "k", nulls="overwrite", load_id="a")
    monkeypatch.undo()
    assert rows(read_live(spark, table_name)) == [(2, "w", 9)]
    assert loads(spark, table_name) == ["a"]
    compact_table(spark, table_name)
    assert rows(read_live(spark, table_name)) == [(2, "w", 9)]
    assert len(loads(spark, table_name)) == 1


@pytest.mark.parametrize("swap", [False, True])
def test_equal_stamps_read_alike_in_both_merge_modes(spark, table_name, swap):
    first = frame(spark, [(i, f"a{i}", i) for i in range(200)])
    second = frame(spark, [(i, f"b{i % 7}", -i) for i in range(200)])
    for i, data in enumerate([second, first] if swap else [first, second]):
        load_table(table_name, data, "k", nulls="overwrite", create=True, written_at=F.lit(5), load_id=f"l{i}")
    by_rows = rows(read_live(spark, table_name))
    load_module._set_property(spark, table_name, load_module._MERGE_PROPERTY, "cells")
    assert rows(read_live(spark, table_name)) == by_rows
    compact_table(spark, table_name)
    assert rows(read_live(spark, table_name)) == by_rows


def test_nulls_overwrite_and_key_only_tables_load(spark, table_name):
    load_table(table_name, frame(spark, [(1, "x", 5)]), "k", nulls="overwrite", create=True, written_at=F.lit(1))
    done = load_table(table_name, frame(spark, [(1, None, None)]), "k", nulls="overwrite", written_at=F.lit(2))
    assert done.report["rows_rejected"] == 0
    assert rows(read_live(spark, table_name)) == [(1, None, None)]
    keys = spark.range(5).select(F.col("id").alias("k"))
    load_table(table_name + "_keys", keys, "k", nulls="ignore", create=True)
    assert read_live(spark, table_name + "_keys").count() == 5


def test_compaction_goes_back_to_whole_rows(spark, table_name):
    load_table(table_name, frame(spark, [(1, "x", 1), (2, "y", 2)]), "k", nulls="overwrite", create=True, written_at=F.lit(1))
    load_table(table_name, frame(spark, [(1, None, 7)]), "k", nulls="ignore", written_at=F.lit(2))
    compact_table(spark, table_name)
    assert table_info(spark, table_name).merge == "cells"
    assert rows(read_live(spark, table_name)) == [(1, "x", 7), (2, "y", 2)]
    load_table(table_name, frame(spark, [(1, "z", None), (3, "w", 3)]), "k", nulls="overwrite", written_at=F.lit(3))
    compact_table(spark, table_name)
    assert table_info(spark, table_name).merge == "rows"
    assert rows(read_live(spark, table_name)) == [(1, "z", None), (2, "y", 2), (3, "w", 3)]
