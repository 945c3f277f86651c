"""Packing: every piece against the tokenizer, sequences without gaps, few of them."""

import random
import zlib

import numpy as np
import pytest
from conftest import SF
from rowloom.llm import packing
from rowloom.llm.queries import TOKENIZER, op13_packing
from test_token_mixing import plain_ids


def check_sequences(rows, length):
    """Each sequence is filled from 0 without gaps; returns how many there are."""
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
        assert ends[r.sequence_id] <= length
    return len(ends)


def test_pieces_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    want = set()
    for d, ids in zip(docs, plain_ids(d.text for d in docs)):
        for i, at in enumerate(range(0, len(ids), 4096)):
            some = ids[at : at + 4096]
            want.add((d.doc_id, i, at, len(some), zlib.crc32(np.array(some, "<u4").tobytes())))
    rows = op13_packing(spark, SF).collect()
    assert len(rows) == len(want)
    assert {tuple(r)[:5] for r in rows} == want
    least = -(-sum(r.length for r in rows) // 4096)
    assert check_sequences(rows, 4096) <= least + 1


def brute_best(counts):
    """The least number of sequences, by search over what is left."""
    top, known = len(counts) - 1, {}

    def best(left):
        if not any(left):
            return 0
        if left not in known:
            first = max(s for s, n in enumerate(left) if n)
            known[left] = 1 + min(best(rest) for rest in fill(left, first, top))
        return known[left]

    def fill(left, size, room):
        left = left[:size] + (left[size] - 1,) + left[size + 1 :]
        room -= size
        more = [s for s in range(1, min(size, room) + 1) if left[s]]
        return {r for s in more for r in fill(left, s, room)} or {left}

    return best(tuple(counts))


def test_few_more_than_the_best(spark):
    rng = random.Random(2)
    for _ in range(25):
        counts = [0] + [rng.choice([0, 0, 1, 2]) for _ in range(9)]
        plan = packing.configurations(np.array(counts))
        held = [0] * 10
        for one, copies in plan:
            assert copies > 0 and sum(s * k for s, k in one) <= 9
            for s, k in one:
                held[s] += k * copies
        assert held == counts
        assert sum(c for _, c in plan) <= brute_best(counts) + 1


@pytest.mark.parametrize("case", ["halves", "thirds", "mixed"])
def test_configurations_are_near_the_bound(case):
    """Large histograms whose best cover is known or bounded by their tokens."""
    counts = np.zeros(1025, np.int64)
    if case == "halves":
        counts[513], counts[511], best = 5000, 5000, 5000
    elif case == "thirds":
        counts[342], counts[341], counts[340], best = 1000, 2000, 1000, 4000 / 3
    else:
        counts[1:1025] = np.random.default_rng(1).integers(0, 900, 1024)
        best = (counts * np.arange(1025)).sum() / 1024
    before = counts.copy()
    plan = packing.configurations(counts)
    assert (counts == before).all()
    assert sum(c for _, c in plan) <= 1.03 * best + 1


def test_knapsack_matches_brute_force():
    rng = random.Random(3)
    for _ in range(50):
        top = rng.randint(1, 14)
        prices = np.array([-np.inf] + [rng.choice([-np.inf, rng.random()]) for _ in range(top)])
        best, last = packing.fillings(prices)
        want = [0.0] * (top + 1)
        for c in range(1, top + 1):
            want[c] = max([want[c - 1], *(prices[s] + want[c - s] for s in range(1, c + 1))])
        assert best == pytest.approx(np.array(want))
        assert all(s == 0 or np.isfinite(prices[s]) for s in last)


def test_odd_rows_are_packed(spark, odd_docs, no_docs):
    packed = packing.pack(packing.cut(odd_docs, TOKENIZER, length=512, tokens=True), length=512)
    rows = packed.collect()
    check_sequences(rows, 512)
    docs = odd_docs.collect()
    ids = sorted(((d.doc_id or 0, i) for d, i in zip(docs, plain_ids(d.text for d in docs))), key=str)
    assert sum(r.length for r in rows) == sum(len(i) for _, i in ids)
    assert all(zlib.crc32(bytes(r.tokens)) == r.ids_crc32 for r in rows)
    whole = {r.sequence_id: bytes(r.tokens) for r in packing.sequences(packed).collect()}
    for r in rows:
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.tokens)
    assert packing.pack(packing.cut(no_docs, TOKENIZER)).count() == 0
