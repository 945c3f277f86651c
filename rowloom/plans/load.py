"""Keyed tables in the Spark catalog, and the load job that fills them.

A keyed table is a Parquet catalog table holding a log of writes: one partition
per attempt of a load (``_load``), bucketed and sorted by the primary key. A load
writes one new partition and nothing else, so its cost follows its input and not
the table. Spark registers the partition when the write job has succeeded, so a
load is seen whole or not at all. Repeating a load id writes a new attempt and
only then drops the ones before; readers take the newest attempt of each id, so
neither a failure nor a crash between the two steps loses or doubles a row.
Reading reconciles the log, last write wins; all loads share their buckets, so
this needs no shuffle.

A table grows with its data: ``compact_table(buckets=…)`` splits every bucket by
further bits of the key's hash into a table of more buckets, which takes the place
of the old one by one change of a property; ``fold_loads`` keeps the number of
loads of a stream logarithmic.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.cells import EXPIRES_AT, WRITE_TIME, WRITTEN, expiry, expiry_micros
from rowloom.functions.text import row_text
from rowloom.functions.types import col, quoted, row_hash, storage_type
from rowloom.keys import KeySpec, key_spec
from rowloom.operators.project import align_to_target, missing_columns
from rowloom.operators.upsert import (
    NULL_RULES,
    latest_rows,
    live_cells,
    live_rows,
    winning_writes,
)
from rowloom.operators.validate import (
    ERR_CODE,
    ERROR_COLUMNS,
    accepted,
    flag_rejects,
    load_report,
    rejected,
    report_counters,
)
from rowloom.session import setting, stage

SEQ, TIE, LOAD = "_seq", "_tie", "_load"
# what orders writes: the hash of the stored row comes last, so that writes equal in all
# else are settled alike however the table is read
TIES = [SEQ, TIE]
STAMP = [WRITE_TIME, SEQ, TIE, EXPIRES_AT]
_TTL, _TTL_OK = "_ttl", "_ttl_seconds"
LOG_FIELDS = [
    T.StructField(WRITE_TIME, T.LongType()),
    T.StructField(SEQ, T.LongType()),
    T.StructField(TIE, T.LongType()),
    T.StructField(EXPIRES_AT, T.TimestampType()),
    T.StructField(WRITTEN, T.ArrayType(T.StringType())),
]
_HIDDEN = {WRITE_TIME, SEQ, TIE, EXPIRES_AT, WRITTEN, LOAD}
# how reading reconciles: "rows" while every load wrote whole rows, else "cells"
_KEY_PROPERTY, _MERGE_PROPERTY = "rowloom.key", "rowloom.merge"
# "true" while every load was reduced to one row per key (or write) before it was stored
_BUCKETS_PROPERTY, _REDUCED_PROPERTY = "rowloom.buckets", "rowloom.reduced"
# "true" says that the table may end with its session; only then may its catalog be in memory
SESSION_PROPERTY = "rowloom.session"
# name of the catalog table that holds the data, once buckets were split
_AT_PROPERTY = "rowloom.at"
_FOLD_ID = re.compile(r"fold(\d+)-")
FOLD = 8  # loads of one tier that are folded together
_LOAD_ID = re.compile(r"[A-Za-z0-9_.-]+")


@dataclass
class LoadResult:
    """What a load did.

    ``report`` holds the counters. With ``rejects_path`` they are those of the
    checked copy that was committed, so exact whatever tasks ran again; without,
    they are observed while loading, and tasks run again after a lost executor
    may count their rows twice. ``rejects`` and ``recount`` (the counters anew)
    are lazy frames over the checked copy or the input.
    """

    load_id: str
    report: dict[str, int]
    rejects: DataFrame
    recount: DataFrame


def _name(table: str) -> str:
    return ".".join(quoted(p) for p in table.split("."))


@dataclass(frozen=True)
class TableInfo:
    name: str  # of the catalog table that holds the data
    key: KeySpec
    buckets: int
    merge: str
    reduced: bool


def table_info(spark: SparkSession, table: str) -> TableInfo:
    """Key, bucket count and way of reconciling of a keyed table."""
    stored = _properties(spark, table)
    if _AT_PROPERTY in stored:
        table = stored[_AT_PROPERTY]
        stored = _properties(spark, table)
    if _KEY_PROPERTY not in stored:
        raise LookupError(f"{table} is not a keyed table")
    partition, clustering = json.loads(stored[_KEY_PROPERTY])
    key = KeySpec(tuple(partition), tuple(clustering))
    return TableInfo(
        table,
        key,
        int(stored[_BUCKETS_PROPERTY]),
        stored[_MERGE_PROPERTY],
        stored[_REDUCED_PROPERTY] == "true",
    )


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {_name(table)}").collect()
    return {r["key"]: r["value"] for r in rows}


def _at(spark: SparkSession, table: str) -> str:
    """The catalog table that holds a keyed table's data."""
    return _properties(spark, table).get(_AT_PROPERTY, table)


def value_schema(spark: SparkSession, table: str) -> T.StructType:
    """User columns of a keyed table."""
    held = spark.table(_at(spark, table)).schema
    return T.StructType([f for f in held if f.name not in _HIDDEN])


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    key: KeySpec | str | Sequence,
    buckets: int | None = None,
    properties: dict[str, str] | None = None,
) -> None:
    """Create a keyed table with ``schema``'s columns.

    ``buckets`` (default: the session's shuffle partitions) is the parallelism
    of loads and reads; size it so that a bucket fits one task. Key, buckets and
    merge rule live in the catalog, so outside local trials it must be one that
    outlives the session, unless ``properties`` has ``SESSION_PROPERTY`` as
    ``"true"``: the table is then meant to be written and read in this session
    alone.
    """
    of_session = (properties or {}).get(SESSION_PROPERTY) == "true"
    if not of_session and _in_memory(spark) and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "keyed tables need a catalog that outlives the session; this one is in memory "
            f"(the property {SESSION_PROPERTY} = 'true' makes a table of this session)"
        )
    spec = key_spec(key)
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fields = [*schema.fields, *LOG_FIELDS]
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    keys = ", ".join(map(quoted, spec.columns))
    stored = {
        **(properties or {}),
        _KEY_PROPERTY: json.dumps([spec.partition, spec.clustering]),
        _MERGE_PROPERTY: "rows",
        _BUCKETS_PROPERTY: str(count),
        _REDUCED_PROPERTY: "true",
    }
    props = ", ".join(f"'{k}' = '{_text(v)}'" for k, v in stored.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_name(table)} ({columns}, {LOAD} STRING) USING parquet "
        f"PARTITIONED BY ({LOAD}) CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {count} BUCKETS "
        f"TBLPROPERTIES ({props})"
    )


def _in_memory(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.catalogImplementation") == "in-memory"


def _text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def _set_property(spark: SparkSession, table: str, name: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {_name(table)} SET TBLPROPERTIES ('{name}' = '{value}')")


def _attempts(spark: SparkSession, table: str) -> list[str]:
    """Partitions of a keyed table: ``<load id>~<attempt>-<random>``, oldest attempt first."""
    rows = spark.sql(f"SHOW PARTITIONS {_name(table)}").collect()
    return sorted(unquote(r[0].split("=", 1)[1]) for r in rows)


def _newest(attempts: Sequence[str]) -> list[str]:
    """The partitions that count: of each load its newest attempt."""
    return list({a.partition("~")[0]: a for a in sorted(attempts)}.values())


def _next_attempt(attempts: Sequence[str], load_id: str) -> str:
    """A partition no failed attempt has left files in."""
    done = [int(a.partition("~")[2][:9]) for a in attempts if a.partition("~")[0] == load_id]
    return f"{load_id}~{max(done, default=0) + 1:09d}-{uuid.uuid4().hex[:12]}"


def loads(spark: SparkSession, table: str) -> list[str]:
    """Ids of the loads a keyed table holds."""
    return [a.partition("~")[0] for a in _newest(_attempts(spark, _at(spark, table)))]


def _drop_attempts(spark: SparkSession, table: str, attempts: Sequence[str]) -> None:
    """Drop partitions; replaced attempts go first, so that none comes back to life."""
    newest = set(_newest(attempts))
    for some in ([a for a in attempts if a not in newest], [a for a in attempts if a in newest]):
        if some:
            specs = ", ".join(f"PARTITION ({LOAD} = '{_text(i)}')" for i in some)
            spark.sql(f"ALTER TABLE {_name(table)} DROP IF EXISTS {specs}")


def _log(spark: SparkSession, table: str, attempts: Sequence[str]) -> DataFrame:
    """The writes that count, without what other sessions have dropped meanwhile."""
    spark.catalog.refreshTable(_name(table))
    newest = _newest(attempts)
    log = spark.table(_name(table))
    return log.where(col(LOAD).isin(newest) if newest else F.lit(False))


def evolve_table(spark: SparkSession, table: str, rows: DataFrame) -> list[str]:
    """Add the input's unknown columns to the table; returns their names."""
    table = _at(spark, table)
    new = missing_columns(rows, value_schema(spark, table))
    if new:
        if loads(spark, table):
            # rows stored so far did not write the new cells
            _set_property(spark, table, _MERGE_PROPERTY, "cells")
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {_name(table)} ADD COLUMNS ({columns})")
    return [f.name for f in new]


def load_table(
    table: str,
    rows: DataFrame,
    key: KeySpec | str | Sequence,
    *,
    nulls: str,
    create: bool = False,
    evolve: bool = False,
    truncate: bool = False,
    written_at: Column | None = None,
    seq: Column | None = None,
    ttl: int | Column | None = None,
    load_id: str | None = None,
    unique: bool = False,
    buckets: int | None = None,
    properties: dict[str, str] | None = None,
    rejects_path: str | None = None,
) -> LoadResult:
    """Check the key, create, evolve, reject, align and publish, in this order.

    ``nulls`` is ``overwrite`` or ``ignore``. ``written_at`` is the write time
    in µs (default: the time of the load) and ``seq`` orders equal write times
    (default: none); a hash of the stored row settles the rest. Both, and a
    ``ttl`` column, are evaluated on the input rows; a row whose stamp cannot
    be read, or whose expiry is out of range, is a reject. Input columns named
    like the log's own (``_writetime`` …) serve such expressions only. With
    ``truncate`` earlier loads are dropped once the new one is in, so a failing
    load loses nothing. A ``load_id`` used before is replaced once the new rows
    are in. Rows without values are rejects only where nulls are left out.
    With ``rejects_path`` the checked input is written once to scratch and the
    rejects from it to that path, so they are the very rows that were refused;
    without, ``rejects`` looks at the input anew. ``unique`` says
    that keys do not repeat in the input, which saves reducing it first; rows
    are only brought to their buckets (results stay right if a key does repeat).
    """
    if nulls not in NULL_RULES:
        raise ValueError(f"nulls must be one of {NULL_RULES}, not {nulls!r}")
    load_id = load_id or uuid.uuid4().hex
    if not _LOAD_ID.fullmatch(load_id):
        raise ValueError(f"a load id is made of letters, digits, '_', '.' and '-': {load_id!r}")
    spark = rows.sparkSession
    stamped = _stamped(rows, written_at, seq, ttl)
    rows = rows.drop(*_HIDDEN)
    spec = key_spec(key)
    spec.require_in(rows)
    if not spark.catalog.tableExists(table):
        if not create:
            raise LookupError(f"no such table: {table}")
        stored = [T.StructField(f.name, storage_type(f.dataType)) for f in rows.schema]
        create_table(spark, table, T.StructType(stored), spec, buckets, properties)
    info = table_info(spark, table)
    if info.key != spec:
        raise ValueError(f"{table} has the key {info.key}")
    table = info.name
    if evolve:
        evolve_table(spark, table, rows)
    target = value_schema(spark, table)
    present = {c.lower() for c in rows.columns}
    written = [f.name for f in target if f.name.lower() in present]
    whole_rows = nulls == "overwrite" and len(written) == len(target)
    if not whole_rows and info.merge != "cells":
        _set_property(spark, table, _MERGE_PROPERTY, "cells")

    flagged = flag_rejects(
        stamped,
        spec,
        target,
        columns=rows.columns,
        empty_rows=nulls == "ignore",
        more=_stamp_problems(stamped, rows.columns),
    )
    if rejects_path:
        flagged = stage(flagged, "checked")
        refused = rejected(flagged).select(*[col(c) for c in (*rows.columns, *ERROR_COLUMNS)])
        refused.write.mode("overwrite").parquet(rejects_path)
    seen, counters = Observation(), report_counters(F.col(ERR_CODE).isNotNull())
    # of a written copy the counters are taken afterwards, from what is in it
    good = accepted(flagged if rejects_path else flagged.observe(seen, *counters))
    good = good.withColumn(EXPIRES_AT, expiry(F.col(WRITE_TIME), F.col(_TTL_OK)))
    stored = [f for f in LOG_FIELDS[:4] if f.name != TIE]
    log = align_to_target(good, T.StructType([*target, *stored]))
    log = log.withColumn(TIE, row_hash(log, written))
    every = F.array(*[F.lit(c) for c in written])
    if unique:
        if info.reduced:
            _set_property(spark, table, _REDUCED_PROPERTY, "false")
        marks = every if nulls == "overwrite" else F.lit(None).cast("array<string>")
        log = log.repartition(info.buckets, *[col(c) for c in spec.columns])
        log = log.withColumn(WRITTEN, marks)
    elif nulls == "overwrite":
        log = latest_rows(log, spec, ties=TIES).withColumn(WRITTEN, every)
    else:
        log = winning_writes(log, spec, STAMP)
    if not unique:
        # each task writes whole buckets; reducing shuffles by key into as many parts, so Spark
        # adds an exchange here only where the input was laid out by key in another way
        log = log.repartition(info.buckets, *[col(c) for c in spec.columns])
    before = _attempts(spark, table)
    attempt = _next_attempt(before, load_id)
    with setting(spark, "spark.sql.shuffle.partitions", info.buckets):
        _publish(spark, table, log, attempt)
    if truncate:
        _drop_attempts(spark, table, before)
        if whole_rows:
            _set_property(spark, table, _MERGE_PROPERTY, "rows")
        if not unique:
            _set_property(spark, table, _REDUCED_PROPERTY, "true")
    else:
        _drop_attempts(spark, table, [a for a in before if a.partition("~")[0] == load_id])
    rejects = rejected(flagged).select(*[col(c) for c in (*rows.columns, *ERROR_COLUMNS)])
    report = flagged.agg(*counters).first().asDict() if rejects_path else dict(seen.get)
    return LoadResult(load_id, report, rejects, load_report(flagged))


def _stamped(
    rows: DataFrame, written_at: Column | None, seq: Column | None, ttl: int | Column | None
) -> DataFrame:
    at = F.unix_micros(F.current_timestamp()) if written_at is None else written_at
    names = [c for c in rows.columns if c not in _HIDDEN]
    order = F.lit(0) if seq is None else seq
    seconds = ttl if isinstance(ttl, Column) else F.lit(ttl)
    return rows.select(
        *[col(c) for c in names],
        at.try_cast("bigint").alias(WRITE_TIME),
        order.try_cast("bigint").alias(SEQ),
        seconds.cast("string").alias(_TTL),
        seconds.try_cast("bigint").alias(_TTL_OK),
    )


def _stamp_problems(stamped: DataFrame, columns: list[str]) -> list[tuple[Column, Column]]:
    """Write times that are none, and times to live that cannot be read or reached."""
    at, seconds = F.col(WRITE_TIME), F.col(_TTL_OK)
    unread = F.col(_TTL).isNotNull() & seconds.isNull()
    too_far = (seconds > 0) & expiry_micros(at, seconds).isNull()
    text = row_text(stamped, columns)
    return [
        (at.isNull(), F.concat(F.lit("no write time: "), text)),
        (F.coalesce(unread | too_far, F.lit(False)), F.concat(F.lit("bad time to live: "), text)),
    ]


def _publish(spark: SparkSession, table: str, log: DataFrame, attempt: str) -> None:
    spark.sql(
        f"INSERT INTO {_name(table)} PARTITION ({LOAD} = '{attempt}') BY NAME SELECT * FROM {{log}}",
        log=log,
    )


@dataclass(frozen=True)
class Pinned:
    """One state of a keyed table: the catalog table and the partitions that counted."""

    name: str
    attempts: tuple[str, ...]


def pin(spark: SparkSession, table: str) -> Pinned:
    """The present state of a keyed table, to be read again later."""
    held = _at(spark, table)
    return Pinned(held, tuple(_newest(_attempts(spark, held))))


def read_live(
    spark: SparkSession,
    table: str,
    as_of: Column | None = None,
    stamps: bool = False,
    pinned: Pinned | None = None,
) -> DataFrame:
    """The table's rows: newest writes, without what has expired at ``as_of``.

    ``as_of=None`` keeps expired cells. ``stamps`` adds ``_writetime`` and
    ``_expires_at``. Filters on key columns reach the file scan. A table of one
    load of whole rows (new, truncated or compacted) is read by a plain scan.
    ``pinned`` (:func:`pin`) reads an earlier state, without later loads; it
    fails once its partitions are gone.
    """
    info = table_info(spark, table)
    attempts = _attempts(spark, info.name)
    if pinned:
        if pinned.name != info.name or not set(pinned.attempts) <= set(attempts):
            raise LookupError(f"the pinned state of {table} is no longer held")
        attempts = list(pinned.attempts)
    log = _log(spark, info.name, attempts).drop(LOAD)
    names = [c for c in log.columns if c not in _HIDDEN]
    if info.merge == "rows":
        if info.reduced and len(_newest(attempts)) == 1:
            rows = log  # keys are unique within one load
        else:
            rows = latest_rows(log.drop(WRITTEN), info.key, ties=TIES)
        if as_of is not None:
            rows = live_rows(rows, as_of)
    else:
        rows = live_cells(log, info.key, as_of, ties=TIES)
    return rows.select(*map(col, [*names, *([WRITE_TIME, EXPIRES_AT] if stamps else [])]))


def _reconciled(log: DataFrame, info: TableInfo, values: int) -> tuple[DataFrame, Observation | None]:
    """The writes of a log that have not lost, and how many of them are not whole rows."""
    if info.merge == "rows":
        return latest_rows(log, info.key, ties=TIES), None
    seen = Observation()
    partial = F.size(F.coalesce(F.col(WRITTEN), F.array())) < values
    return winning_writes(log, info.key, STAMP).observe(seen, F.count_if(partial).alias("partial")), seen


def compact_table(
    spark: SparkSession,
    table: str,
    buckets: int | None = None,
    purge: Column | None = None,
) -> str:
    """Rewrite all loads as one, without the writes that lost.

    The new load is added before the old ones are dropped; reconciling twice
    changes nothing, so readers see the same rows throughout. Where every row
    left was written whole, later reads reconcile by rows again.

    ``buckets``, a multiple of the present number, splits each bucket by further
    bits of the key's hash. A task reads one old bucket and writes its parts, so
    nothing is shuffled. The rows go to a new catalog table; one change of a
    property of the old one lets readers and loads go there, then the old data
    is dropped. Reads begun before fail if they run on; a crash in between
    leaves the table as it was.

    ``purge`` drops writes that have expired at this instant. All loads are in
    the rewrite, so no older write of their cells is left that could come back;
    a load that brings writes older than the purged ones afterwards would show,
    so leave a span in which late writes may still come. ``_writetime`` of a
    row is then that of its newest write left.
    """
    info = table_info(spark, table)
    held = info.name
    old = _attempts(spark, held)
    log = _log(spark, held, old).drop(LOAD)
    schema = value_schema(spark, held)
    if buckets and (buckets < info.buckets or buckets % info.buckets):
        raise ValueError(f"{buckets} is no multiple of {info.buckets} buckets")
    kept, seen = _reconciled(log, info, len(schema) - len(info.key.columns))
    if purge is not None:
        kept = _unexpired(kept, info, schema, purge)
    load_id = f"compact-{uuid.uuid4().hex}"
    attempt = _next_attempt(old, load_id)
    if buckets and buckets != info.buckets:
        new = f"{table}__{uuid.uuid4().hex[:12]}"
        create_table(spark, new, schema, info.key, buckets, _user_properties(spark, held))
        _set_property(spark, new, _MERGE_PROPERTY, info.merge)
        _publish(spark, new, kept, attempt)
        _whole_again(spark, new, info, seen)
        _set_property(spark, table, _AT_PROPERTY, new)
        if held == table:
            _drop_attempts(spark, held, old)
        else:
            spark.sql(f"DROP TABLE {_name(held)}")
        return load_id
    _publish(spark, held, kept, attempt)
    _drop_attempts(spark, held, old)
    if loads(spark, held) == [load_id]:
        _set_property(spark, held, _REDUCED_PROPERTY, "true")
        _whole_again(spark, held, info, seen)
    return load_id


def _whole_again(spark: SparkSession, table: str, info: TableInfo, seen: Observation | None) -> None:
    if info.merge == "cells" and not seen.get["partial"]:
        _set_property(spark, table, _MERGE_PROPERTY, "rows")  # one whole write for each key


def _user_properties(spark: SparkSession, table: str) -> dict[str, str]:
    """Properties that came with the table's creation."""
    own = {_KEY_PROPERTY, _MERGE_PROPERTY, _BUCKETS_PROPERTY, _REDUCED_PROPERTY, _AT_PROPERTY}
    stored = _properties(spark, table)
    return {k: v for k, v in stored.items() if k not in own and not k.startswith("transient")}


def _unexpired(kept: DataFrame, info: TableInfo, schema: T.StructType, as_of: Column) -> DataFrame:
    """Without the writes that reading at ``as_of`` or later shows nothing of."""
    expires = F.col(EXPIRES_AT)
    live = expires.isNull() | (expires > as_of.cast("timestamp"))
    if info.merge == "rows":
        return kept.where(live)
    keys = {c.lower() for c in info.key.columns}
    values = [col(f.name) for f in schema if f.name.lower() not in keys]
    # nulls that a write holds hide nothing any more; without the newest write they show nothing
    newest = Window.partitionBy(*[col(c) for c in info.key.columns])
    stamp = F.struct(*[col(c) for c in STAMP])
    marked = kept.withColumn("_last", F.max(stamp).over(newest) == stamp)
    holds = F.lit(False)
    for v in values:
        holds = holds | v.isNotNull()
    return marked.where(live & (F.col("_last") | holds)).drop("_last")


def fold_loads(
    spark: SparkSession, table: str, fanout: int = FOLD, keep: Sequence[str] = ()
) -> list[str]:
    """Fold loads together in tiers, and return the loads the table holds then.

    As soon as a tier has ``fanout`` loads they become one load of the next
    tier, so n loads leave at most ``fanout - 1`` of each of about log n tiers,
    and a row is rewritten once a tier. Loads in ``keep`` (those that may be
    repeated) stay as they are; a folded load can no longer be replaced under
    its id, repeating it is one more write of the same rows.
    """
    if fanout < 2:
        raise ValueError("at least two loads are folded")
    info = table_info(spark, table)
    held = info.name
    values = len(value_schema(spark, held)) - len(info.key.columns)
    while True:
        present = _attempts(spark, held)
        tiers: dict[int, list[str]] = {}
        for a in _newest(present):
            load = a.partition("~")[0]
            found = _FOLD_ID.match(load)
            if load not in keep:
                tiers.setdefault(int(found[1]) if found else 0, []).append(a)
        full = [t for t in sorted(tiers) if len(tiers[t]) >= fanout]
        if not full:
            return [a.partition("~")[0] for a in _newest(present)]
        group = tiers[full[0]]
        log = _log(spark, held, present).where(col(LOAD).isin(group)).drop(LOAD)
        kept, _ = _reconciled(log, info, values)
        folded = f"fold{full[0] + 1}-{uuid.uuid4().hex}"
        _publish(spark, held, kept, _next_attempt(present, folded))
        ids = {a.partition("~")[0] for a in group}
        _drop_attempts(spark, held, [a for a in present if a.partition("~")[0] in ids])
