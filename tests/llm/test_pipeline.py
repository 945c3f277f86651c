"""The pipeline stage by stage, each against brute force or SQL on its own input."""

import os
import zlib

import corpus_pipeline
import duckdb
import numpy as np
from conftest import SF
from rowloom.llm import decontaminate, mixing, toxicity
from rowloom.llm.common import scratch
from test_near_exact import brute_classes, brute_fingerprint
from test_token_mixing import plain_ids


def oracle(docs, sql):
    """SQL over these documents and the given tables."""
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    con.sql(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    return con.sql(sql).fetchdf()


def test_each_stage_does_its_part(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, inputs, outputs = docs.columns, {}, {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(spark, name)
        stage(spark, docs, SF).write.parquet(path)
        inputs[name], docs = docs, spark.read.parquet(path)
        outputs[name] = docs
        if name != "token_output":
            assert docs.columns == columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    weights = toxicity.train(inputs["toxicity"], spark.read.parquet(f"{SF}/labels.parquet"))
    scored = toxicity.score(inputs["toxicity"], weights)
    assert ids(outputs["toxicity"]) == ids(scored.filter(scored.score < toxicity.THRESHOLD))

    rows = inputs["simhash"].orderBy("doc_id").collect()
    roots = brute_classes([brute_fingerprint(r.text) for r in rows], 4)
    assert ids(outputs["simhash"]) == sorted(rows[r].doc_id for r in set(roots))
    assert len(set(roots)) < len(rows)

    hits = oracle(inputs["decontamination"], decontaminate.ORACLE)
    assert ids(outputs["decontamination"]) == sorted(hits[~hits.contaminated].doc_id)
    assert hits.contaminated.any()

    mix = oracle(inputs["mixing"], mixing.ORACLE)
    copies = outputs["mixing"].groupBy("doc_id").count().toPandas().set_index("doc_id")["count"]
    for r in mix.itertuples():
        assert r.taken == r.size * copies.get(r.doc_id, 0)

    start, got = 0, outputs["token_output"].orderBy("start").collect()
    rows = inputs["token_output"].orderBy("doc_id").collect()
    for r, d, own in zip(got, rows, plain_ids(d.text for d in rows), strict=True):
        assert tuple(r)[:4] == (d.doc_id, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()} == {tuple(r) for r in got}


def test_run_keeps_only_its_last_stage(spark):
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(root))
    corpus_pipeline.run(spark, SF).count()
    (left,) = [n for n in set(os.listdir(root)) - before if not n.startswith(".")]
    assert left.startswith("stage-token_output")


def test_odd_rows_pass_all_stages(spark, odd_docs, no_docs):
    counts = {}
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            path = scratch(spark, name)
            stage(spark, docs, SF).write.parquet(path)
            before, docs = docs, spark.read.parquet(path)
            counts.setdefault(name, []).append(docs.count())
            if name != "token_output":
                assert docs.columns == before.columns
    assert {n: c[1] for n, c in counts.items()} == dict.fromkeys(counts, 0)
    # ids 1 to 2 and all texts without words are one class each
    assert counts["simhash"][0] == 6
    assert counts["token_output"][0] == counts["mixing"][0]
