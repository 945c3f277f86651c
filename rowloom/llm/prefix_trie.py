"""Prefix trie of conversations by burst tries.

A conversation is the sequence of its turns' ids (a digest of role and text) with their code
points. Equal sequences are one row with its number of members and their least id. All start
in one container under the root head; a container of more than ``limit`` different sequences
bursts: its head becomes a trie node, each sequence goes on under the head one turn longer, and
what ends there stays. Only bursting rows are written again. The containers that remain are
sorted by their suffixes and swept into nodes, each in one task; sums over the burst nodes
above them are grouped aggregates by ancestor. Joins with heads are salted, as one head (the
root, a very common first turn) may have a large part of all rows. The digest of the members
that end at a node reads their sorted ids range by range: ids of one very common conversation
become text chunks in many tasks, and only these meet, as the digest needs.

A sequence is one row (16 bytes and a number a turn), and a container holds at most ``limit``.

Edge cases: null roles and texts are empty; a null turn comes first, ties follow the turns'
ids, repeated rows are turns like others; rows without an id belong to no conversation; texts
are whole, however long; other columns are ignored; an empty table gives no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import partitions, quoted, staged

LIMIT = 256  # different sequences of a container
CHUNK = 1 << 16  # ids of a chunk of text that a digest reads


def sequences(
    conversations: DataFrame,
    *,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``id`` and ``turns``, in order: ``key`` (a digest of role and text) and ``chars``. Texts
    are not shuffled."""
    role, text = (F.coalesce(quoted(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    key = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.filter(quoted(id_col).isNotNull()).select(
        quoted(id_col).cast("long").alias("id"), F.struct(quoted(turn_col).alias("turn"), key.alias("key"), F.length(text).alias("chars")).alias("t")
    )
    listed = rows.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return listed.select("id", F.transform("ts", lambda t: F.struct(F.unhex(t["key"]).alias("key"), t["chars"].alias("chars"))).alias("turns"))


def _salted(rows: DataFrame, few: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``few`` by a column that a large part of ``rows`` may share. ``few``
    is one row for each value that occurs often, and is repeated for every salt."""
    n = partitions(rows.sparkSession)
    salt = F.pmod(F.xxhash64(*[c for c, kind in rows.dtypes if not kind.startswith("array")]), F.lit(n)).cast("int")
    many = few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return rows.withColumn("salt", salt).join(many, [on, "salt"], how).drop("salt")


def _ends(paths: DataFrame) -> DataFrame:
    """``path`` and the SHA-256 of its ids, ascending, joined by commas."""
    n = partitions(paths.sparkSession)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, key, ids = TaskContext.get().partitionId(), 0, None, []
        out: list[tuple] = []
        for batch in batches:
            for path, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if path != key or len(ids) == CHUNK:
                    if ids:
                        out.append((key, part, nth, ",".join(map(str, ids))))
                    key, ids, nth = path, [], nth + 1
                ids.append(i)
            if len(out) >= 512:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["path", "part", "nth", "text"])
                out = []
        if ids:
            out.append((key, part, nth, ",".join(map(str, ids))))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["path", "part", "nth", "text"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for batch in batches:
            for path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if path != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = path, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["path", "ends"])
                done = []
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["path", "ends"])

    texts = paths.repartitionByRange(n, "path", "id").sortWithinPartitions("path", "id")
    texts = texts.mapInArrow(chunks, "path binary, part long, nth long, text string")
    dealt = texts.repartition(n, "path").sortWithinPartitions("path", "part", "nth")
    return dealt.select("path", "text").mapInArrow(digest, "path binary, ends string")


def _longer(head: Column, key: Column) -> Column:
    """The head one turn below."""
    return F.unhex(F.md5(F.concat(head, key)))


def trie(sequences: DataFrame, *, limit: int = LIMIT) -> DataFrame:
    """Nodes of the trie over ``id``, ``turns``: ``id`` (least member), ``depth``, ``parent``
    (the parent's), ``n`` (members), ``children``, ``leaves`` (childless nodes of the
    subtree), ``saved`` (summed over the subtree: members but one times code points of the last
    turn) and ``ends`` (SHA-256 of the ids that end there, null: none)."""
    path = F.unhex(F.md5(F.reduce("turns", F.lit(b""), lambda a, t: F.concat(a, t["key"]))))
    named = staged(sequences.select("id", path.alias("path"), "turns"), "sequences")
    distinct = named.groupBy("path").agg(F.min("id").alias("least"), F.count("*").alias("n"), F.first("turns").alias("turns"))
    root, none = F.lit(b"root").cast("binary"), F.lit(None).cast("binary")
    held = distinct.join(_ends(named.select("path", "id")), "path").select(
        root.alias("head"), none.alias("above"), F.lit(0).alias("depth"), F.lit(0).alias("chars"), "least", "n", "ends", "turns"
    )
    held = staged(held, "containers")
    settled, burst, stopped = [], [], []
    while True:
        own = F.struct("above", "depth", "chars")
        sizes = held.groupBy("head").agg(F.count("*").alias("size"), F.first(own).alias("own")).filter(F.col("size") > limit)
        sizes = staged(sizes, "sizes")
        if sizes.isEmpty():
            settled.append(held)
            break
        marked = _salted(held, sizes.select("head", F.lit(True).alias("bursts")), "head", "left")
        marked = staged(marked, "marked")
        settled.append(marked.filter("bursts is null").drop("bursts"))
        going = marked.filter("bursts")
        burst.append(sizes.select("head", "own.*"))
        stopped.append(going.filter("size(turns) = 0").select("head", "least", "n", "ends"))
        next_ = F.element_at("turns", 1)
        held = going.filter("size(turns) > 0").select(
            _longer(F.col("head"), next_["key"]).alias("head"),
            F.col("head").alias("above"),
            (F.col("depth") + 1).alias("depth"),
            next_["chars"].alias("chars"),
            "least",
            "n",
            "ends",
            F.slice("turns", 2, F.size("turns")).alias("turns"),
        )
    containers = settled[0]
    for more in settled[1:]:
        containers = containers.unionByName(more)
    swept = staged(_swept(containers), "nodes")
    result = ["id", "depth", "parent", "n", "children", "leaves", "saved", "ends"]
    if not burst:
        return swept.select(*result)
    inner, tops = _above(swept, burst, stopped)
    found = _salted(swept.filter("above is not null").drop("parent"), inner.select(F.col("head").alias("above"), F.col("id").alias("parent")), "above")
    return swept.filter("above is null").select(*result).union(found.select(*result)).union(tops.select(*result))


def _swept(containers: DataFrame) -> DataFrame:
    """Nodes of the containers; the top node of each names the head ``above`` it."""
    schema = (
        "above binary, id long, depth int, parent long, n long, children long, leaves long, saved long, ends string"
    )

    def nodes(top: dict, rows: list[tuple]) -> Iterator[dict]:
        made = [{"parent_at": None, "depth": top["depth"], "chars": top["chars"], "id": None, "n": 0, "children": 0, "ends": None}]
        open_, before = [0], []  # the path of the last sequence, its keys
        for keys, chars, least, n, ends in rows:
            same = 0
            while same < min(len(keys), len(before)) and keys[same] == before[same]:
                same += 1
            del open_[same + 1 :]
            for c in chars[same:]:
                above = open_[-1]
                made[above]["children"] += 1
                open_.append(len(made))
                made.append({"parent_at": above, "depth": made[above]["depth"] + 1, "chars": c, "id": None, "n": 0, "children": 0, "ends": None})
            for at in open_:
                one = made[at]
                one["n"] += n
                one["id"] = least if one["id"] is None else min(one["id"], least)
            made[open_[-1]]["ends"] = ends
            before = keys
        for one in reversed(made):  # children come after their parents
            one["leaves"] = one.get("leaves", 0) + (not one["children"])
            one["saved"] = one.get("saved", 0) + (one["n"] - 1) * one["chars"]
            if one["parent_at"] is not None:
                up = made[one["parent_at"]]
                up["leaves"] = up.get("leaves", 0) + one["leaves"]
                up["saved"] = up.get("saved", 0) + one["saved"]
        for one in made:
            up = one["parent_at"]
            one["parent"] = None if up is None else made[up]["id"]
            one["above"] = top["above"] if up is None else None
            yield one

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["above", "id", "depth", "parent", "n", "children", "leaves", "saved", "ends"]
        types = [pa.binary(), pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string()]
        shape = pa.schema(list(zip(names, types)))
        top, rows = None, []
        for batch in batches:
            out: list[dict] = []
            for r in batch.to_pylist():
                if top is None or r["head"] != top["head"]:
                    out.extend(nodes(top, rows) if top else ())
                    top, rows = r, []
                turns = r["turns"]
                rows.append(([t["key"] for t in turns], [t["chars"] for t in turns], r["least"], r["n"], r["ends"]))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=shape)
        if top:
            yield pa.RecordBatch.from_pylist(list(nodes(top, rows)), schema=shape)

    keys = F.transform("turns", lambda t: t["key"])
    dealt = containers.repartition(partitions(containers.sparkSession), "head").sortWithinPartitions("head", keys)
    return dealt.mapInArrow(sweep, schema)


def _above(swept: DataFrame, burst: list[DataFrame], stopped: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Burst nodes: ``head`` with their figures, and the same as nodes with their parents."""
    # each burst node with the heads above it and itself; they are at most as many as the
    # sequences divided by the limit, times their depth
    known = burst[0].select("*", F.array("head").alias("up"))
    level = known
    for one in burst[1:]:
        ups = level.select(F.col("head").alias("above"), "up")
        level = one.join(ups, "above").select("head", "above", "depth", "chars", F.concat("up", F.array("head")).alias("up"))
        known = known.unionByName(level)
    known = staged(known, "burst")
    ended = stopped[0]
    for one in stopped[1:]:
        ended = ended.union(one)
    tops = swept.filter("above is not null").select("above", "id", "n", F.lit(1).alias("child"), "leaves", "saved", F.lit(None).cast("string").alias("ends"))
    zero = F.lit(0).cast("long")
    ends = ended.select(F.col("head").alias("above"), F.col("least").alias("id"), "n", F.lit(0).alias("child"), zero.alias("leaves"), zero.alias("saved"), "ends")
    # first what lies directly under each burst node, then what lies under those below it
    direct = tops.union(ends).groupBy("above").agg(
        F.min("id").alias("id"), F.sum("n").alias("n"), F.sum("child").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends")
    )
    own = known.join(direct.withColumnRenamed("above", "own"), F.col("head") == F.col("own"), "left").drop("own")
    own = staged(own, "burst-own")
    inside = own.select(F.explode("up").alias("top"), "id", "n", "leaves", "saved")
    sums = inside.groupBy("top").agg(F.min("id").alias("id"), F.sum("n").alias("n"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("below"))
    inner = own.select("head", "above", "depth", "chars", "up", F.col("children").alias("plain"), "ends").join(sums, F.col("head") == F.col("top")).drop("top")
    inner = staged(inner.withColumn("gain", (F.col("n") - 1) * F.col("chars")), "burst-sums")
    gains = inner.select(F.explode("up").alias("top"), "gain").groupBy("top").agg(F.sum("gain").alias("gain"))
    below = inner.filter("above is not null").groupBy(F.col("above").alias("over")).agg(F.count("*").alias("inner_children"))
    full = (
        inner.drop("gain")
        .join(gains, F.col("head") == F.col("top"))
        .join(below, F.col("head") == F.col("over"), "left")
        .select(
            "head", "above", "id", "depth", "n", "leaves", "ends",
            (F.coalesce("plain", F.lit(0)) + F.coalesce("inner_children", F.lit(0))).alias("children"),
            (F.coalesce("below", F.lit(0)) + F.col("gain")).alias("saved"),
        )
    )
    full = staged(full, "burst-nodes")
    parents = full.select(F.col("head").alias("above"), F.col("id").alias("parent"))
    return full, full.join(parents, "above", "left")


ORACLE = """
WITH t AS (
  SELECT conv_id AS c, turn, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         length(coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT c, list({'k': k, 'n': n} ORDER BY turn NULLS FIRST, k) AS s FROM t GROUP BY c),
-- crc32 of the decimal id: each byte, then eight single bits (-1)
h AS (
  SELECT c, s, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(c::VARCHAR, ''),
             lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END),
         4294967295) % 6 AS h
  FROM s),
r AS (
  SELECT h.c, list_concat(coalesce(b.s, [])[1:h.h], h.s[h.h + 1:]) AS s
  FROM h LEFT JOIN s AS b ON b.c = h.c - h.c % 100),
p AS (
  SELECT c, d, len(s) = d AS ends, CASE WHEN d > 0 THEN s[d].n ELSE 0 END AS n,
         md5(array_to_string(list_transform(s[1:d], lambda e: e.k), '')) AS p,
         CASE WHEN d > 0 THEN md5(array_to_string(list_transform(s[1:d - 1], lambda e: e.k), '')) END AS up
  FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM r)),
node AS (
  SELECT p, d, min(c) AS c, count(*) AS n_convs, any_value(n) AS n, any_value(up) AS up,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends
  FROM p GROUP BY p, d),
kids AS (SELECT up, count(*) AS k FROM node GROUP BY up),
own AS (SELECT node.*, coalesce(k, 0) AS k FROM node LEFT JOIN kids ON kids.up = node.p),
sums AS (
  SELECT p.p, sum((own.n_convs - 1) * own.n) AS saved, count(*) FILTER (own.k = 0) AS leaves
  FROM own JOIN p ON p.c = own.c AND p.d <= own.d GROUP BY p.p)
SELECT own.c AS conv_id, own.d::BIGINT AS depth, above.c AS parent_conv_id, own.n_convs::BIGINT AS n_convs,
       own.k::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, own.ends AS ends_sha256
FROM own JOIN sums USING (p) LEFT JOIN node AS above ON above.p = own.up
"""
