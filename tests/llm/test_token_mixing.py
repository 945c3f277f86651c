"""Token output by exact round trips; mixing by its SQL, its bounds and its targets."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from checker import differences, duck
from conftest import SF
from tokenizers import Tokenizer

from rowloom.llm import mixing, pieces, token_output
from rowloom.llm.common import scratch
from rowloom.llm.queries import TOKENIZER, op1_token_output, op2_mixing


def plain_ids(texts):
    t = Tokenizer.from_file(TOKENIZER)
    return [t.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]


def test_documents_come_back_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = sorted(op1_token_output(spark, SF).collect())
    start = 0
    for row, doc, ids in zip(got, docs, plain_ids(d.text for d in docs)):
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(row)[:4] == (doc.doc_id, start, len(ids), crc)
        start += len(ids)
    assert len(got) == len(docs)


def test_odd_rows_round_trip(spark, odd_docs):
    path = scratch(spark, "tokens")
    token_output.write_tokens(odd_docs, path, TOKENIZER, parts=3)
    got = token_output.read_tokens(spark, path).collect()
    want = odd_docs.collect()
    pairs = Counter((d.doc_id, np.array(i, "<u4").tobytes()) for d, i in zip(want, plain_ids(d.text for d in want)))
    assert Counter((r.id, bytes(r.tokens)) for r in got) == pairs
    spans = sorted((r.start, r.n_tokens, r.id is not None, r.id or 0) for r in got)
    assert [s[0] for s in spans] == [0, *np.cumsum([s[1] for s in spans])[:-1]]
    assert [s[2:] for s in spans] == sorted(s[2:] for s in spans)


def test_one_document_is_read_alone(spark, odd_docs):
    path = scratch(spark, "tokens")
    token_output.write_tokens(odd_docs, path, TOKENIZER)
    (ids,) = plain_ids(["one"])
    assert token_output.read_document(spark, path, 8) == [ids]
    assert len(token_output.read_document(spark, path, 1)) == 2
    assert token_output.read_document(spark, path, 99) == []


def test_empty_table_gives_no_tokens(spark, no_docs):
    path = scratch(spark, "tokens")
    token_output.write_tokens(no_docs, path, TOKENIZER)
    assert token_output.read_tokens(spark, path).count() == 0


def test_pieces_encode_like_whole_texts(monkeypatch):
    """Every plain character alone and inside words, odd strings, little and much memory."""
    with open(TOKENIZER, encoding="utf-8") as f:
        spec = f.read()
    plain = [chr(c) for c in range(0x21, 0x250)]
    texts = ["A<|endoftext|>b c", "don't we'll x", "ÀÉ é ́x", "　東京 Σας ΣΑΣ", "x\x0by\x1cz", "a" * 5000, ""]
    texts += [f"{c} a{c} {c}b A{c}B 1{c}{c}" for c in plain]
    rng = random.Random(4)
    some = [*"abXY'sStT.,!?-12²ª \u0085éÅİſıΣ中\U0001f600\u00ad\x7f", "<|endoftext|>", "'LL", "n't"]
    texts += ["".join(rng.choices(some, k=rng.randint(0, 30))) for _ in range(2000)]
    want = plain_ids(texts)
    for known, recent in ((pieces.KNOWN_BYTES, pieces.RECENT_BYTES), (3000, 2000), (0, 0)):
        monkeypatch.setattr(pieces, "KNOWN_BYTES", known)
        monkeypatch.setattr(pieces, "RECENT_BYTES", recent)
        encoder = pieces.PieceEncoder(spec)
        for _ in range(2):
            got = [i for k in range(0, len(texts), 100) for i in encoder.encode([t.encode() for t in texts[k : k + 100]])]
            assert [np.frombuffer(b, "<u4").tolist() + [1] for b in got] == want


def test_other_tokenizers_encode_whole_pieces():
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        assert pieces.PieceEncoder(f.read()).plain is None


def test_dictionary_of_another_hash_is_refused(spark, no_docs):
    path = scratch(spark, "tokens")
    token_output.write_tokens(no_docs, path, TOKENIZER)
    spark.createDataFrame([("0" * 32, 2, bytearray(b"x"))], "dict_hash string, width int, data binary").write.mode(
        "overwrite"
    ).parquet(f"{path}/dictionary")
    with pytest.raises(ValueError):
        token_output.read_tokens(spark, path)


def test_mixing_matches_its_sql(spark):
    got = op2_mixing(spark, SF).toArrow()
    assert differences(got, duck(SF).sql(mixing.ORACLE).to_arrow_table()) == []


def test_targets_are_reached_and_bounded(spark):
    rows = [(i, "w " * (i % 7 + 1), f"s{i % 5}" if i % 3 else "hot") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert sum(r.size for r in got) == pytest.approx(sum({r.source_size: r.target for r in got}.values()), rel=0.02)
    by = {}
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    for (size, target), taken in by.items():
        assert target <= 3 * size
        assert abs(sum(taken) - target) <= 7
    again = {(r.id, r.taken) for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {(r.id, r.taken) for r in got}


def test_small_sources_stop_at_three_times(spark):
    rows = [(1, "a b", "a"), *[(i, "w " * 10, "b") for i in range(2, 40)]]
    got = {r.id: r for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert (got[1].target, got[1].taken) == (6.0, 6)


def test_odd_rows_are_mixed(spark, odd_docs, no_docs):
    got = mixing.mix(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {r.size for r in got if r.id in (3, 4, 5)} == {0}
    rows = mixing.mixed_rows(odd_docs)
    assert rows.columns == odd_docs.columns
    assert rows.count() == sum(r.copies for r in got)
    assert mixing.mix(no_docs).count() == mixing.mixed_rows(no_docs).count() == 0
