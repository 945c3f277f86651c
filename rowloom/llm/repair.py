"""Conversation structure repair by weighted CYK interval parsing.

Every conversation's rows, in order of turn, are mended by the cheapest edits that give role
initials ``(s?(ua)+)?``: Keep (0), Rerole to user or assistant (2), Delete (3; blank and
repeated rows must go), Insert an empty user or assistant turn anywhere (2); a truncated row
that stays costs 1 more. Among the cheapest, the edits whose initials are least are taken.

Grammar. In Chomsky normal form: nonterminal ``[p q]`` derives the rows and inserted turns that
lead from state p of the wanted pattern to state q (before all, after s, after u, after a),
``[p q] -> [p r] [r q]`` for every r, ``[p q] ->`` one edited row. The cell of a span holds
per nonterminal the least (cost, audit) and is closed under insertion at both ends. Audits of
one cost are never prefixes of one another (they hold a letter a row, and more insertions cost
more), so least cells of parts give least cells of wholes. As every [p q] splits through every
state, any split point of a span gives the same cell: spans are combined bottom-up by length,
1, 2, 4, ..., one split each, and cells of short spans are remembered, as there are few.

Spark. Rows are range partitioned and sorted by (id, turn, role, text hash); a conversation
inside one partition is parsed there. One that reaches over a partition's end, or has more
than ``HELD`` rows, goes on in chunks of ``CHUNK`` rows: repeats are found by a window over
(id, role, text), each chunk is parsed to its cell where it lies, and only cells (16 bytes a
row) meet per conversation; the audit goes back to the chunks. So a conversation that holds a
third of all rows is read, sorted, compared and parsed by many tasks.

Edge cases: null roles and texts are one space; null ids are one conversation of their own;
null turns come first; ties in turn follow role and text hash, and exact copies are repeats;
texts are whole, however long; other columns are ignored, whatever their names; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm.common import partitions, quoted, staged

# Costs, and the ASCII white space that makes no text.
RETAG, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
BLANK = " \t\n\x0b\x0c\r"
HELD = 1 << 14  # rows of a conversation that a task holds at most
CHUNK = 1 << 12  # rows of a chunk of a longer one

STATES = range(4)  # before all, after s, after u, after a
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FINAL = (0, 3)

Cell = tuple[tuple[int, str] | None, ...]  # (cost, audit) by 4 * p + q


def combine(a: Cell, b: Cell) -> Cell:
    """The cell of two spans in turn: ``[p q] -> [p r] [r q]``."""
    out: list[tuple[int, str] | None] = []
    for p in STATES:
        for q in STATES:
            best = None
            for r in STATES:
                x, y = a[4 * p + r], b[4 * r + q]
                if x and y and (best is None or x[0] + y[0] <= best[0]):
                    one = (x[0] + y[0], x[1] + y[1])
                    best = one if best is None or one < best else best
            out.append(best)
    return tuple(out)


def _of(entries: Iterable[tuple[int, int, int, str]]) -> Cell:
    found: dict[int, tuple[int, str]] = {}
    for p, q, cost, audit in entries:
        at = 4 * p + q
        found[at] = min(found.get(at, (cost, audit)), (cost, audit))
    return tuple(found.get(i) for i in range(16))


def _insertions() -> Cell:
    """What insertion alone leads to: the closure of single insertions."""
    cell = _of([(p, p, 0, "") for p in STATES])
    once = _of([*((p, p, 0, "") for p in STATES), *((p, q, INSERT, "I") for (p, i), q in STEPS.items() if i in "ua")])
    while combine(cell, once) != cell:
        cell = combine(cell, once)
    return cell


INSERTED = _insertions()


@lru_cache(maxsize=1 << 16)
def _short(symbols: str) -> Cell:
    if len(symbols) > 1:
        cut = 1 << (len(symbols) - 1).bit_length() - 1
        return combine(_short(symbols[:cut]), _short(symbols[cut:]))
    initial, more = symbols.lower(), TRUNCATED * symbols.isupper()
    edits = [(p, p, DELETE, "D") for p in STATES]
    if symbols != "d":
        edits += [(p, q, more, "K") for (p, i), q in STEPS.items() if i == initial]
        edits += [(p, q, RETAG + more, "R") for (p, i), q in STEPS.items() if i in "ua"]
    return combine(combine(INSERTED, _of(edits)), INSERTED)


def span(symbols: str) -> Cell:
    """The cell of a span of rows, each by its symbol (``symbol``)."""
    if not symbols:
        return INSERTED
    if len(symbols) <= 16:
        return _short(symbols)
    cut = 1 << (len(symbols) - 1).bit_length() - 1
    return combine(span(symbols[:cut]), span(symbols[cut:]))


def accepted(cell: Cell) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    return min(cell[q] for q in FINAL if cell[q])


def symbol(role: str, fault: str) -> str:
    """``d`` for a row that must go, else the role's initial (``x``: no s, u or a), upper case
    for a truncated row."""
    if fault in ("blank", "duplicate"):
        return "d"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return initial.upper() if fault == "truncated" else initial


def fault(text: str, again: bool) -> str:
    """A row's first fault."""
    bare = text.strip(BLANK)
    if not bare:
        return "blank"
    return "duplicate" if again else "" if bare[-1] in ".!?" else "truncated"


def illegal(first: str, second: str) -> bool:
    return first[:1] + second[:1] not in ("su", "ua", "au")


def facts(turns: list, roles: list[str], texts: list[str], again: list[bool]) -> dict:
    """What the report counts in rows that follow each other, and their symbols."""
    faults = [fault(t, a) for t, a in zip(texts, again)]
    known = [t for t in turns if t is not None]
    return {
        "n_rows": len(turns),
        "first_turn": known[0] if known else None,
        "last_turn": known[-1] if known else None,
        "turns": len(set(known)),
        "first_role": roles[0][:1],
        "last_role": roles[-1][:1],
        "illegal": sum(map(illegal, roles, roles[1:])),
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "symbols": "".join(map(symbol, roles, faults)),
    }


def joined(parts: list[dict]) -> dict:
    """Facts of rows from those of its chunks in turn, without symbols."""
    out = dict(parts[0])
    for one in parts[1:]:
        same = one["first_turn"] is not None and one["first_turn"] == out["last_turn"]
        out["turns"] += one["turns"] - same
        out["illegal"] += one["illegal"] + illegal(out["last_role"], one["first_role"])
        for c in ("n_rows", "blank", "duplicate", "truncated"):
            out[c] += one[c]
        out["first_turn"] = one["first_turn"] if out["first_turn"] is None else out["first_turn"]
        out["last_turn"] = out["last_turn"] if one["last_turn"] is None else one["last_turn"]
        out["last_role"] = one["last_role"]
    return out


def turned(edits: str, roles: list[str], texts: list[str], before: int, odd: bool) -> list[dict]:
    """Repaired turns of rows: ``before`` turns stand before them; ``odd``: the whole starts
    with a system turn."""
    out, at = [], 0
    for e in edits:
        wanted = "user" if (before + len(out) - odd) % 2 == 0 else "assistant"
        if e == "I":
            out.append({"role": wanted, "text": ""})
            continue
        if e != "D":
            out.append({"role": roles[at] if e == "K" else wanted, "text": texts[at]})
        at += 1
    return out


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
TURNS = "array<struct<role: string, text: string>>"
FACTS = (
    "n_rows long, first_turn long, last_turn long, turns long, first_role string, last_role string, "
    "illegal long, blank long, duplicate long, truncated long"
)


def _report(found: dict, cost: int) -> dict:
    known = found["first_turn"] is not None
    gaps = found["last_turn"] - found["first_turn"] + 1 - found["turns"] if known else 0
    return {"gaps": gaps, **{c: found[c] for c in ("blank", "duplicate", "truncated", "illegal")}, "cost": cost}


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def repair(
    conversations: DataFrame,
    *,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    held: int = HELD,
    chunk: int = CHUNK,
) -> tuple[DataFrame, DataFrame]:
    """Two frames. Per conversation ``id``, gaps, blank, duplicate, truncated, illegal, cost,
    ``audit``. And its repaired turns in pieces: ``id``, ``pieces`` (how many the conversation
    has), ``piece`` and ``part`` (their order), ``turns`` (role and text)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = conversations.sparkSession
    one_space = lambda c: F.coalesce(quoted(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        quoted(id_col).alias("id"), quoted(turn_col).cast("long").alias("turn"), one_space(role_col).alias("role"), one_space(text_col).alias("text")
    )
    order = ["id", "turn", "role", F.xxhash64("text")]
    id_type = rows.schema["id"].dataType
    struct = T.StructType.fromDDL
    first_schema = T.StructType(
        [
            T.StructField("id", id_type),
            *struct("whole boolean, part int, piece long, nth long, turn long, role string, text string").fields,
            *struct(REPORT).fields,
            *struct(f"audit string, repaired {TURNS}").fields,
        ]
    )
    arrow = to_arrow_schema(first_schema)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole conversations repaired; rows of those that may go on elsewhere as they are."""
        part, out = TaskContext.get().partitionId(), []
        own: list[tuple] = []  # rows of the conversation at hand
        at, open_, key = 0, True, None  # open_: it may have begun in the partition before

        def raw():
            nonlocal at
            for turn, role, text in own:
                out.append({"id": key, "whole": False, "part": part, "piece": at // chunk, "nth": at, "turn": turn, "role": role, "text": text})
                at += 1
            own.clear()

        def close():
            nonlocal at, open_
            if own:
                turns, roles, texts = map(list, zip(*own))
                seen: set = set()
                again = [(x in seen, seen.add(x))[0] for x in zip(roles, texts)]
                found = facts(turns, roles, texts, again)
                cost, audit = accepted(span(found["symbols"]))
                done = turned(audit, roles, texts, 0, (len(audit) - audit.count("D")) % 2 == 1)
                out.append({"id": key, "whole": True, "part": 0, "piece": 0, **_report(found, cost), "audit": audit, "repaired": done})
                own.clear()
            at, open_ = 0, False

        started = False
        for batch in batches:
            for i, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if started and i != key:
                    close()
                key, started = i, True
                own.append((turn, role, text))
                if open_ or at or len(own) > held:
                    raw()
            if out:
                yield _batch(out, arrow)
                out = []
        raw()  # the last one may go on in the next partition
        if out:
            yield _batch(out, arrow)

    dealt = rows.repartitionByRange(partitions(spark), *order, F.spark_partition_id()).sortWithinPartitions(*order, "text")
    found = staged(dealt.mapInArrow(first, first_schema), "conversations")
    whole = found.filter("whole")
    names = [f.name for f in struct(REPORT).fields]
    reports = whole.select("id", *names, "audit")
    pieces = whole.select("id", F.lit(1).cast("long").alias("pieces"), "part", "piece", F.col("repaired").alias("turns"))
    rest = found.filter("not whole").select("id", "part", "piece", "nth", "turn", "role", "text")
    if rest.isEmpty():
        return reports, pieces
    more_reports, more_pieces = _in_chunks(rest, id_type)
    return reports.union(more_reports), pieces.union(more_pieces)


def digests(pieces: DataFrame) -> DataFrame:
    """``id`` and the SHA-256 of the repaired ``role:text``, joined by newlines. Of
    conversations in several pieces one task reads these in turn, as the digest needs."""
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    whole = pieces.filter("pieces = 1").select("id", F.sha2(F.array_join(line, "\n"), 256).alias("repaired_sha256"))
    schema = T.StructType([pieces.schema["id"], T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, left = None, None, 0
        for batch in batches:
            done: list[tuple] = []
            for r in batch.to_pylist():
                if not left:
                    key, state, left, glue = r["id"], hashlib.sha256(), r["pieces"], b""
                for t in r["turns"]:
                    state.update(glue + f"{t['role']}:{t['text']}".encode())
                    glue = b"\n"
                left -= 1
                if not left:
                    done.append((key, state.hexdigest()))
            if done:
                ids, found = zip(*done)
                yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(found)], names=schema.names)

    order = ["id", "part", "piece"]
    parts = pieces.filter("pieces > 1").select("id", "pieces", "part", "piece", "turns")
    parts = parts.repartition(partitions(pieces.sparkSession), "id").sortWithinPartitions(*order)
    return whole.union(parts.mapInArrow(run, schema))


def _in_chunks(rest: DataFrame, id_type: T.DataType) -> tuple[DataFrame, DataFrame]:
    """Reports and repaired turns of conversations whose rows lie in several chunks (part,
    piece), in order (part, nth)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    struct = T.StructType.fromDDL
    order = Window.partitionBy("id", "role", "text").orderBy("part", "nth")
    again = F.row_number().over(order) > 1
    row = F.struct("nth", "turn", "role", "text", again.alias("again"))
    marked = rest.select("id", "part", "piece", row.alias("row"))
    # a chunk has a bounded number of rows
    chunks = staged(marked.groupBy("id", "part", "piece").agg(F.array_sort(F.collect_list("row")).alias("rows")), "chunks")
    key = [T.StructField("id", id_type), *struct("part int, piece long").fields]
    cell_schema = T.StructType([*key, *struct(f"{FACTS}, costs array<int>, audits array<string>").fields])
    cell_arrow = to_arrow_schema(cell_schema)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                turns, roles, texts, again = ([x[c] for x in r["rows"]] for c in ("turn", "role", "text", "again"))
                own = facts(turns, roles, texts, again)
                cell = span(own.pop("symbols"))
                cells = {"costs": [c[0] if c else None for c in cell], "audits": [c[1] if c else None for c in cell]}
                yield _batch([{c: r[c] for c in ("id", "part", "piece")} | own | cells], cell_arrow)

    cells = chunks.mapInArrow(parse, cell_schema)
    names = [f.name for f in struct(REPORT).fields]
    meet_schema = T.StructType([*key, *struct(f"{REPORT}, audit string, edits string, before long, odd boolean, pieces long").fields])
    meet_arrow = to_arrow_schema(meet_schema)

    def meet(table: pa.Table) -> pa.Table:
        """Cells of one conversation combined in turn, two by two; the audit cut to chunks."""
        parts = sorted(table.to_pylist(), key=lambda r: (r["part"], r["piece"]))
        spans = [tuple(None if c is None else (c, a) for c, a in zip(r["costs"], r["audits"])) for r in parts]
        while len(spans) > 1:
            spans = [combine(*spans[i : i + 2]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
        cost, audit = accepted(spans[0])
        odd = (len(audit) - audit.count("D")) % 2 == 1
        report = _report(joined(parts), cost)
        out, at, before = [], 0, 0
        for k, r in enumerate(parts):
            end, left = at, r["n_rows"]
            while left or (end < len(audit) and (audit[end] == "I" or k + 1 == len(parts))):
                left -= audit[end] != "I"
                end += 1
            edits = audit[at:end]
            first = {**report, "audit": audit} if not k else {}
            out.append({c: r[c] for c in ("id", "part", "piece")} | first | {"edits": edits, "before": before, "odd": odd, "pieces": len(parts)})
            at, before = end, before + len(edits) - edits.count("D")
        return pa.Table.from_pylist(out, schema=meet_arrow)

    plans = staged(cells.groupBy("id").applyInArrow(meet, meet_schema), "plans")
    reports = plans.filter("cost is not null").select("id", *names, "audit")
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"p.{c}")) for c in ("id", "part", "piece")]
    planned = chunks.alias("c").join(plans.alias("p"), same).select("c.*", "edits", "before", "odd", "pieces")
    turn_schema = T.StructType([key[0], *struct(f"pieces long, part int, piece long, turns {TURNS}").fields])
    turn_arrow = to_arrow_schema(turn_schema)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                roles, texts = ([x[c] for x in r["rows"]] for c in ("role", "text"))
                turns = turned(r["edits"], roles, texts, r["before"], r["odd"])
                yield _batch([{c: r[c] for c in ("id", "pieces", "part", "piece")} | {"turns": turns}], turn_arrow)

    return reports, planned.mapInArrow(apply, turn_schema)


ORACLE = """
WITH RECURSIVE source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations),
-- crc32 of the name: each byte, then eight single bits (-1)
kinds AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(name, ''),
             lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END),
         4294967295) % 20 AS kind
  FROM source),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM damaged),
marked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
faulty AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate'
                 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM marked),
facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
-- states: 0 before all, 1 after s, 2 after u, 3 after a; what insertion alone leads to
steps AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) AS t(p, role, q)),
inserted AS (
  SELECT * FROM (VALUES (0, 0, 0, ''), (0, 2, 2, 'I'), (0, 3, 4, 'II'), (1, 1, 0, ''), (1, 2, 2, 'I'), (1, 3, 4, 'II'),
                        (2, 2, 0, ''), (2, 3, 2, 'I'), (3, 3, 0, ''), (3, 2, 2, 'I')) AS t(p, q, cost, audit)),
edits AS (
  SELECT conv_id, i, p, p AS q, 3 AS cost, 'D' AS audit FROM faulty, range(4) AS s(p)
  UNION ALL
  SELECT conv_id, i, p, q, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END, 'K'
  FROM faulty JOIN steps ON steps.role = left(faulty.role, 1) WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT conv_id, i, p, q, 2 + CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END, 'R'
  FROM faulty JOIN steps ON steps.role <> 's' WHERE fault NOT IN ('blank', 'duplicate')),
cells AS (
  SELECT conv_id, 0::BIGINT AS i, q, {'cost': cost, 'audit': audit} AS best FROM facts, inserted WHERE p = 0
  UNION ALL
  SELECT c.conv_id, c.i + 1, s.q,
         min({'cost': c.best.cost + e.cost + s.cost, 'audit': c.best.audit || e.audit || s.audit})
  FROM cells AS c JOIN edits AS e ON e.conv_id IS NOT DISTINCT FROM c.conv_id AND e.i = c.i + 1 AND e.p = c.q
  JOIN inserted AS s ON s.p = e.q
  GROUP BY c.conv_id, c.i, s.q),
found AS (
  SELECT f.*, c.best.cost AS cost, c.best.audit AS audit
  FROM facts AS f JOIN (
    SELECT c.conv_id, min(best) AS best FROM cells AS c JOIN facts AS f
    ON f.conv_id IS NOT DISTINCT FROM c.conv_id AND f.n = c.i WHERE q IN (0, 3) GROUP BY c.conv_id) AS c
  ON c.conv_id IS NOT DISTINCT FROM f.conv_id),
letters AS (
  SELECT conv_id, audit, pos, substr(audit, pos, 1) AS letter, length(replace(audit, 'D', '')) % 2 AS odd,
         length(replace(left(audit, pos), 'I', '')) AS i, length(replace(left(audit, pos), 'D', '')) - 1 AS o
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS pos FROM found)),
lines AS (
  SELECT l.conv_id, l.pos, CASE WHEN letter = 'K' THEN r.role WHEN (o - odd) % 2 = 0 THEN 'user' ELSE 'assistant' END
         || ':' || CASE WHEN letter = 'I' THEN '' ELSE r.text END AS line
  FROM letters AS l LEFT JOIN faulty AS r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = l.i
  WHERE letter <> 'D'),
mended AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM lines GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(m.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS a
LEFT JOIN found AS f ON f.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN mended AS m ON m.conv_id IS NOT DISTINCT FROM a.conv_id
"""
