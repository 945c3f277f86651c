"""Language ID: the posterior recomputed row by row, odd documents, hot hosts."""

import math
from collections import defaultdict

import pytest
from conftest import SF
from pyspark.sql import functions as F

from rowloom.llm import langid
from rowloom.llm.queries import op9_language_id


def brute(rows, languages):
    """Language and confidence from likelihoods, declarations, hosts and suffixes, with sums over
    all rows; rows are (host, suffix, declared, likelihoods)."""
    n = len(languages)

    def normal(a):
        e = [math.exp(x - max(a)) for x in a]
        return [x / sum(e) for x in e]

    votes = [normal(r[3]) for r in rows]
    sums = lambda key: {k: [sum(v[i] for v, r in zip(votes, rows) if key(r) == k) for i in range(n)] for k in set(map(key, rows))}
    everyone = [sum(v[i] for v in votes) for i in range(n)]
    prior = [(x + 1) / (sum(everyone) + n) for x in everyone]
    told = {k: v for k, v in sums(lambda r: r[2]).items() if k in languages}
    of = [sum(v[i] for v in told.values()) for i in range(n)]
    hosts, ends = sums(lambda r: (r[0], r[1])), sums(lambda r: r[1])
    out = []
    for (host, suffix, declared, own), vote in zip(rows, votes):
        def smooth(all_votes, above):
            size = sum(all_votes)
            return [(v + langid.STRENGTH * p) / (size + langid.STRENGTH) for v, p in zip(all_votes, above)]

        less = lambda all_votes: [max(v - mine, 0.0) for v, mine in zip(all_votes, vote)]
        place = smooth(less(hosts[host, suffix]), smooth(less(ends[suffix]), prior))
        told_log = [0.0] * n
        if declared in languages:
            told_log = [math.log((told[declared][i] + 0.5) / (of[i] + 0.5 * n)) for i in range(n)]
        posterior = normal([a + b + math.log(p) for a, b, p in zip(own, told_log, place)])
        out.append((languages[posterior.index(max(posterior))], max(posterior)))
    return out


def test_posteriors_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = langid.train(docs)
    evidence = langid.page_evidence(pages, model)
    rows = evidence.orderBy("page_id").collect()
    got = {r.page_id: r for r in langid.fuse(evidence, model.languages).collect()}
    want = brute([(r.host, r.suffix, r.declared, r.likelihoods) for r in rows], model.languages)
    assert len(got) == len(rows)
    for r, (language, confidence) in zip(rows, want):
        assert got[r.page_id].confidence == pytest.approx(confidence, rel=1e-9)
        assert got[r.page_id].language == language


def test_the_query_answers_for_documents_and_pages(spark):
    rows = op9_language_id(spark, SF).collect()
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").count()
    assert len(rows) == len(docs) + pages
    told = {r.doc_id: r.language for r in rows if r.doc_id is not None}
    assert told.keys() == docs.keys() and sum(r.page_id is not None for r in rows) == pages
    assert sum(told[i] == x for i, x in docs.items()) >= 0.97 * len(docs)


def test_odd_documents_get_languages(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs)
    evidence = langid.text_evidence(odd_docs, model, F.concat(F.lit("source:"), "source"))
    got = langid.fuse(evidence, model.languages).collect()
    assert len(got) == odd_docs.count()
    assert all(r.language in model.languages and 0 < r.confidence <= 1 for r in got)
    same = defaultdict(set)
    for r in got:
        same[r.doc_id].add((r.language, r.confidence))
    assert len(same[1]) == 1
    none = langid.text_evidence(no_docs, model, F.lit("x"))
    assert langid.fuse(none, model.languages).count() == 0
    # odd rows may teach as well
    assert set(langid.train(odd_docs).languages) == {"de", "en"}


def test_a_hot_host_is_split(spark):
    """One host has nearly all rows; the join that brings its sums back is a skew join."""
    n = 3
    likely = F.array(*[F.rand(i) for i in range(n)])
    rows = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("page_id"),
        F.when(F.col("id") % 20 == 0, F.concat(F.lit("h"), F.col("id"))).otherwise("hot.example").alias("host"),
        F.lit("example").alias("suffix"),
        F.lit(None).cast("string").alias("declared"),
        likely.alias("likelihoods"),
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        found = langid.fuse(rows, ["a", "b", "c"])
        assert found.count() == 60_000
        found.write.format("noop").mode("overwrite").save()
        ran = found.select("host", "confidence")
        ran.collect()
        text = ran._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in text
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
