"""SimHash classes, benchmark hits and repeated strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from checker import differences, duck
from conftest import SF

from rowloom.llm import decontaminate, simhash, substring_dedup
from rowloom.llm.queries import op3_substring_dedup, op7_simhash, op8_decontamination
from rowloom.llm.suffix_array import permuted_common_prefixes, suffix_array


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[k : k + 4]) for k in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(fps, bits):
    label = list(range(len(fps)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_classes_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    fps = [brute_fingerprint(d.text) for d in docs]
    roots = brute_classes(fps, 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op7_simhash(spark, SF).collect()}
    assert got == {d.doc_id: (f"{f:016x}", docs[r].doc_id) for d, f, r in zip(docs, fps, roots)}


@pytest.mark.parametrize("limit", [4096, 40, 3])
def test_links_join_all_close_fingerprints(spark, limit):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(60)}
    center = rng.getrandbits(64)
    while len(fps) < 200:
        fps.add(center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))))
    fps = sorted(fps)
    table = spark.createDataFrame([(bytearray(f.to_bytes(8, "big")),) for f in fps], "fp binary")
    pairs = simhash.components(simhash.links(table, simhash.Plan(group_limit=limit))).collect()
    root = {int.from_bytes(bytes(r.node), "big"): int.from_bytes(bytes(r.root), "big") for r in pairs}
    want = brute_classes(fps, 4)
    assert [root.get(f, f) for f in fps] == [fps[r] for r in want]


def test_a_family_beyond_the_limit_is_compared_in_blocks(spark):
    rng = random.Random(9)
    center = rng.getrandbits(64)
    fps = {center}
    while len(fps) < 20_000:
        fps.add(center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    rows = [(bytearray(f.to_bytes(8, "big")),) for f in fps]
    table = spark.createDataFrame(rows, "fp binary").repartition(8)
    pairs = simhash.components(simhash.links(table, simhash.Plan(group_limit=512)))
    assert {r.n for r in pairs.groupBy("root").count().withColumnRenamed("count", "n").collect()} == {20_000}


def test_one_document_of_each_class_stays(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    roots = brute_classes([brute_fingerprint(d.text) for d in docs], 4)
    table = spark.read.parquet(f"{SF}/documents.parquet")
    kept = simhash.one_of_each(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == [docs[r].doc_id for r in sorted(set(roots))]


def test_odd_rows_fall_into_classes(spark, odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {r.id: r for r in got}
    assert by_id[1].component_id == by_id[2].component_id == 1
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {3}
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 6, 7, 8]
    assert simhash.near_duplicates(no_docs).count() == simhash.one_of_each(no_docs).count() == 0


def test_hits_match_sql(spark):
    got = op8_decontamination(spark, SF).toArrow()
    assert differences(got, duck(SF).sql(decontaminate.ORACLE).to_arrow_table()) == []
    assert any(got["contaminated"].to_pylist())


def test_spans_point_into_the_original(spark):
    docs = spark.createDataFrame(
        [(1, "Intro: One TWO, three four-five six seven eight nine TEN eleven. End"), (2, "é Short Item! here"), (3, None)],
        "doc_id long, text string",
    )
    items = spark.createDataFrame(
        [(7, "one two three four five six seven eight nine ten eleven"), (8, "short item"), (None, "item here"), (9, " ..")],
        "item_id long, text string",
    )
    for size in (1 << 20, 30):
        got = {r.id: r for r in decontaminate.contamination(docs, items, max_pattern_chars=size).collect()}
        assert (got[1].n_hit, got[1].items, got[1].spans) == (11, ["7"], [[7, 63]])
        assert (got[2].n_words, got[2].n_hit, got[2].items, got[2].spans) == (4, 3, ["", "8"], [[2, 18]])
        assert (got[3].n_words, got[3].n_hit) == (0, 0)
    assert [r.doc_id for r in decontaminate.clean_rows(docs, items).collect()] == [3]
    assert decontaminate.contamination(docs, items.limit(0)).filter("n_hit > 0").count() == 0


def test_odd_rows_are_scanned(odd_docs, no_docs):
    items = odd_docs.select(odd_docs.doc_id.alias("item_id"), "text")
    got = decontaminate.contamination(odd_docs, items).collect()
    assert len(got) == odd_docs.count()
    assert all(r.n_hit == r.n_words for r in got)
    assert decontaminate.clean_rows(odd_docs, items.limit(0)).columns == odd_docs.columns
    assert decontaminate.contamination(no_docs, items).count() == 0


def brute_removed(rows, window):
    found = Counter(b[i : i + window] for _, b in rows for i in range(len(b) - window + 1))
    out = Counter()
    for key, b in rows:
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if found[b[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        n = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[key, len(b), len(b) - len(kept), n, hashlib.sha256(kept).hexdigest()] += 1
    return out


def removed(docs, **options):
    rows = substring_dedup.remove_repeats(docs, **options).collect()
    return Counter((r.id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in rows)


def test_repeats_match_brute_force(spark):
    docs = [(d.doc_id, (d.text or "").encode()) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = Counter(tuple(r) for r in op3_substring_dedup(spark, SF).collect())
    assert got == brute_removed(docs, 200)


@pytest.mark.parametrize("window, gram, options", [(12, 4, {}), (12, 4, {"group_limit": 2}), (9, 8, {"shard_bytes": 50})])
def test_repeats_in_small_alphabets(spark, window, gram, options):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for i in range(40)]
    rows += [(50, None), (51, "a" * 90), (52, "a" * 40), (53, "abcabc" * 20), (54, "xé" * 30), (None, "abab" * 9), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_removed([(k, (t or "").encode()) for k, t in rows], window)
    assert removed(docs, window=window, gram=gram, **options) == want


def test_pieces_of_long_texts_meet(monkeypatch):
    raw = bytes(random.Random(1).choice(b"abc") for _ in range(5000))
    whole = substring_dedup.contexts(raw, 30, 8)
    starts = lambda found: {s: a for a, lo, hi in zip(*found) for s in range(lo, hi + 1)}
    monkeypatch.setattr(substring_dedup, "PIECE", 700)
    assert starts(substring_dedup.contexts(raw, 30, 8)) == starts(whole)
    assert set(starts(whole)) == set(range(len(raw) - 29))


def test_odd_rows_lose_their_repeats(odd_docs, no_docs):
    got = substring_dedup.remove_repeats(odd_docs, window=40, gram=16).collect()
    assert len(got) == odd_docs.count()
    assert {r.n_bytes - r.n_removed for r in got if r.id in (1, 2)} == {0}
    assert all(r.n_removed == 0 for r in got if r.id in (3, 4, 5, 7, 8, None))
    assert substring_dedup.remove_repeats(no_docs).count() == 0


def test_suffix_arrays_match_sorting():
    rng = np.random.default_rng(1)
    for t in range(120):
        raw = rng.integers(0, rng.integers(1, 6), rng.integers(1, 150)).astype(np.uint8)
        raw = np.tile(raw[: max(len(raw) // 3, 1)], 3) if t % 3 == 0 else raw
        raw = raw + 250 if t % 7 == 0 else raw
        b = raw.tobytes()
        want = sorted(range(len(b)), key=lambda i: b[i:])
        order = suffix_array(raw)
        assert order.tolist() == want
        shared, before = permuted_common_prefixes(raw, order)
        for i, j in zip(want[1:], want):
            n = next((k for k in range(len(b) - max(i, j)) if b[i + k] != b[j + k]), len(b) - max(i, j))
            assert (shared[i], before[i]) == (n, j)
