"""Conversation repair against a brute-force search, on whole and on cut conversations."""

import hashlib
import heapq
import random
import re
import zlib
from itertools import groupby

import pytest
from checker import differences, duck
from conftest import SF
from rowloom.llm import repair
from rowloom.llm.queries import damaged, op11_repair

WANTED = re.compile("(s?(ua)+)?")


def brute(rows):
    """All results of a conversation's rows in order, by search over (row, turns so far)."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    heap = [(0, "", 0, "", ())]
    done = set()
    while True:
        cost, audit, at, initials, out = heapq.heappop(heap)
        if at == len(rows) and WANTED.fullmatch(initials):
            break
        state = (at, initials[-1:], len(initials) > 1)
        if state in done:
            continue
        done.add(state)

        def follow(more, letter, role, text, step):
            if any(WANTED.fullmatch(initials + role[:1] + tail) for tail in ("", "a", "ua")) and role[:1] in "sua" and role:
                heapq.heappush(heap, (cost + more, audit + letter, at + step, initials + role[0], (*out, f"{role}:{text}")))

        for role in ("user", "assistant"):
            follow(2, "I", role, "", 0)
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, initials, out))
            if faults[at] not in ("blank", "duplicate"):
                more = faults[at] == "truncated"
                follow(more, "K", role, text, 1)
                for other in ("user", "assistant"):
                    follow(2 + more, "R", other, text, 1)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    legal = sum(a[1][:1] + b[1][:1] in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    text = "\n".join(out)
    return (gaps, *counts, max(len(rows) - 1, 0) - legal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def in_order(rows):
    """Rows (id, turn, role, text) by id, in the operator's order."""
    key = lambda r: (r[0] is not None, r[0] or 0)
    for i, own in groupby(sorted(rows, key=key), key):
        yield (i[1] if i[0] else None), sorted((r[1:] for r in own), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def results(frames):
    reports, pieces = frames
    shas = {r.id: r.repaired_sha256 for r in repair.digests(pieces).collect()}
    return {r.id: (*tuple(r)[1:], shas[r.id]) for r in reports.collect()}


def test_conversations_of_the_table(spark):
    rows = []
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        role, text = (" " if x is None else x for x in (r.role, r.text))
        kind = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        if kind:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
            rows += [(r.conv_id, r.turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    want = {i: brute(own) for i, own in in_order(rows)}
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r.conv_id: tuple(r)[1:] for r in op11_repair(spark, SF).collect()}
    ids = {r.conv_id for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").collect()}
    assert got == {i: want.get(i, empty) for i in ids}


def test_results_match_sql(spark):
    got = op11_repair(spark, SF).toArrow()
    assert differences(got, duck(SF).sql(repair.ORACLE).to_arrow_table()) == []


def random_rows(rng, conversations, longest):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "umpire"]
    texts = ["Yes.", "No!", "and so", "", " \t", "Why?", "more. "]
    rows = []
    for i in range(conversations):
        turn = 0
        for _ in range(rng.randint(1, longest)):
            turn += rng.choice([0, 1, 1, 1, 3])
            rows.append((i, turn * 10**6 + len(rows), rng.choice(roles), rng.choice(texts) + rng.choice(["", f" {len(rows)}."])))
    return rows


@pytest.mark.parametrize("held, chunk", [(repair.HELD, repair.CHUNK), (3, 4)])
def test_random_conversations(spark, held, chunk):
    """Cut into chunks of four rows as well, where cells must meet."""
    rows = random_rows(random.Random(held), 120, 14)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    want = {i: brute(own) for i, own in in_order(rows)}
    assert results(repair.repair(table, held=held, chunk=chunk)) == want


def test_one_long_conversation_spans_tasks(spark):
    rng = random.Random(8)
    rows = [(7, i, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "and", f"{i}."])) for i in range(3000)]
    rows += [(i, 0, "user", "Hi.") for i in range(6)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    reports, pieces = repair.repair(table, chunk=256)
    parts = pieces.filter("id = 7").select("part").distinct().count()
    assert parts > 1
    got = results((reports, pieces))
    want = brute([r[1:] for r in rows[:3000]])
    assert got[7] == want


def test_every_split_gives_the_same_cell():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("dsuaxSUAX") for _ in range(rng.randint(2, 12)))
        for cut in range(1, len(text)):
            assert repair.combine(repair.span(text[:cut]), repair.span(text[cut:])) == repair.span(text)


def test_odd_rows_are_repaired(spark):
    rows = [
        (1, None, "user", "Null turn."),
        (1, 2, None, "No role."),
        (1, 2, "user", None),
        (1, 2, "user", None),
        (1, 5, "assistant", "x" * 200_000 + "."),
        (None, 1, "user", "No id."),
        (None, None, None, None),
        (2, None, "user", "Only null turns"),
        (2, None, "user", "Only null turns"),
        (3, 4, "système", "S initial."),
    ]
    extra = ("k", 1, "w", 2)
    schema = "conv_id long, turn long, role string, text string, id string, part int, audit string, whole int"
    table = spark.createDataFrame([r + extra for r in rows], schema)
    plain = [(i, t, " " if r is None else r, " " if x is None else x) for i, t, r, x in rows]
    assert results(repair.repair(table)) == {i: brute(own) for i, own in in_order(plain)}
    reports, pieces = repair.repair(table.limit(0))
    assert reports.count() == pieces.count() == repair.digests(pieces).count() == 0
    assert damaged(table).columns == ["conv_id", "turn", "role", "text"]
