"""Language ID by Bayesian evidence fusion.

For a record the posterior of language ``l`` joins

* text: naive Bayes over hashed character trigrams of the whole text, learned from labelled
  texts (a bounded sample, ``rows`` per language, first by a hash of their id). Trigrams of a
  text depend on each other, so its log likelihood counts as that of ``EVIDENCE`` trigrams at
  most;
* declared markup language: ``P(declared | l)``, smoothed, learned from all records by how
  often records whose text speaks for ``l`` declare it;
* host and address suffix: ``P(l | host)`` from the votes of the host's other records,
  smoothed by its suffix, which is smoothed by all records. ``STRENGTH`` votes of the level
  above are added at each level.

Votes are soft (each record's text posterior) and summed by grouped aggregation with partial
sums, so a host with most records is no hot group; the join that brings sums back is split by
the adaptive plan. A record's own vote is taken out of its prior.

Edge cases: a text without letters leaves the other evidence; a null or foreign declaration is
no evidence; a null address has the empty host and suffix; empty tables give empty results;
without labelled texts there is no language to tell and an error says so; repeated rows get
equal answers; input columns named like an added one give way to it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import fresh, quoted, staged, text_bytes, without
from rowloom.llm.style_tree import Page, host_of

ROWS = 400
HASH_BITS = 16
EVIDENCE = 50.0
STRENGTH = 5.0
EVIDENCE_COLUMNS = ("host", "suffix", "declared", "likelihoods")
ADDED = ("vote", "posterior", "language", "confidence", "text_language", "of_host", "of_suffix", "host_votes", "end_votes")
MIX = np.uint64(0x9E3779B97F4A7C15)  # an odd factor
LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]{2,3})", re.I)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_p: np.ndarray  # a row per language, a column per trigram bucket


def trigrams(raw: bytes) -> np.ndarray:
    """Buckets of a text's trigrams over letters, other bytes being one blank."""
    joined = b" " + b" ".join(raw.translate(LOWER).translate(LETTERS).split()) + b" "
    b = np.frombuffer(joined, np.uint8).astype(np.uint64)
    if len(b) < 3:
        return np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        h = (b[:-2] | b[1:-1] << np.uint64(8) | b[2:] << np.uint64(16)) * MIX
    return (h >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def train(
    docs: DataFrame, *, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> Model:
    """Trigram counts per language of at most ``rows`` labelled texts of each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = trigrams(raw)
                mine = total.setdefault(lang, np.zeros(1 << HASH_BITS, np.int64))
                mine += np.bincount(found, minlength=1 << HASH_BITS)
        for lang, mine in total.items():
            at = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(mine[at])], names=["lang", "bucket", "n"]
            )

    known = docs.select(
        quoted(lang_col).cast("string").alias("lang"), F.xxhash64(quoted(id_col)).alias("order")
    ).filter(F.col("lang").isNotNull())
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language
    if not sizes:
        raise ValueError("no labelled texts to learn languages from")
    share = reduce(
        lambda c, kv: F.when(quoted(lang_col) == kv[0], F.lit(max(1, kv[1] // rows))).otherwise(c), sizes.items(), F.lit(None)
    )
    chosen = docs.filter(F.pmod(F.xxhash64(quoted(id_col)), share) == 0)
    counts = (
        chosen.select(quoted(lang_col).cast("string").alias("lang"), text_bytes(text_col).alias("text"))
        .mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .collect()  # languages times buckets at most
    )
    languages = sorted(sizes)
    table = np.full((len(languages), 1 << HASH_BITS), 0.5)
    for r in counts:
        table[languages.index(r.lang), r.bucket] += r.n
    return Model(languages, np.log(table / table.sum(1, keepdims=True)).astype(np.float32))


def text_likelihoods(raw: bytes, log_p: np.ndarray, evidence: float = EVIDENCE) -> list[float]:
    found = trigrams(raw)
    if not len(found):
        return [0.0] * len(log_p)
    return (log_p[:, found].sum(1, dtype=np.float64) * min(1.0, evidence / len(found))).tolist()


def _likelihoods(model: Model, docs: DataFrame):
    known = docs.sparkSession.sparkContext.broadcast(model.log_p)  # languages times buckets

    @F.arrow_udf("array<double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([text_likelihoods(t, known.value) for t in batch.to_pylist()], pa.list_(pa.float64()))

    return run


def _reader():
    @F.arrow_udf("struct<text:binary,declared:string>")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for source in batch.to_pylist():
                found = DECLARED.search(source)
                rows.append({"text": Page(source).text().encode(), "declared": found[1].lower() if found else None})
            yield pa.array(rows, pa.struct([("text", pa.binary()), ("declared", pa.string())]))

    return read


def page_evidence(pages: DataFrame, model: Model, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` with ``host``, ``suffix``, ``declared`` and the texts' ``likelihoods``."""
    host = host_of(quoted(url_col))
    source = F.coalesce(quoted(html_col).cast("string"), F.lit(""))
    name = fresh(pages, "read")
    read = pages.withColumn(name, _reader()(source))
    return read.select(
        *without(pages, html_col, *EVIDENCE_COLUMNS),
        host.alias("host"),
        F.substring_index(host, ".", -1).alias("suffix"),
        F.col(f"{name}.declared").alias("declared"),
        _likelihoods(model, pages)(F.col(f"{name}.text")).alias("likelihoods"),
    )


def text_evidence(docs: DataFrame, model: Model, host: Column, *, text_col: str = "text") -> DataFrame:
    """``docs`` without an address: ``host`` groups them, and nothing is declared."""
    return docs.select(
        *without(docs, text_col, *EVIDENCE_COLUMNS),
        F.coalesce(host.cast("string"), F.lit("")).alias("host"),
        F.lit("").alias("suffix"),
        F.lit(None).cast("string").alias("declared"),
        _likelihoods(model, docs)(text_bytes(text_col)).alias("likelihoods"),
    )


def _normal(a: Column) -> Column:
    """Log weights as probabilities."""
    top = F.array_max(a)
    e = F.transform(a, lambda x: F.exp(x - top))
    total = F.aggregate(e, F.lit(0.0), lambda s, x: s + x)
    return F.transform(e, lambda x: x / total)


def _sums(n: int) -> list[Column]:
    return [F.sum(F.col("vote")[i]).alias(f"v{i}") for i in range(n)]


def _votes(n: int) -> Column:
    return F.array(*[F.coalesce(F.col(f"v{i}"), F.lit(0.0)) for i in range(n)])


def fuse(evidence: DataFrame, languages: list[str], *, strength: float = STRENGTH) -> DataFrame:
    """``evidence`` with ``language``, ``confidence`` and ``text_language``; its own columns
    besides ``host``, ``suffix``, ``declared`` stay as they are."""
    n = len(languages)
    named = F.array(*[F.lit(x) for x in languages])
    evidence = evidence.select(*without(evidence, *ADDED))
    rows = staged(evidence.withColumn("vote", _normal(F.col("likelihoods"))), "evidence")
    everyone = rows.agg(*_sums(n)).first()  # one row
    total = sum(v or 0.0 for v in everyone)
    prior = F.array(*[F.lit(((v or 0.0) + 1.0) / (total + n)) for v in everyone])

    declared = rows.filter(F.col("declared").isin(languages)).groupBy("declared").agg(*_sums(n)).collect()
    seen = {r.declared: r for r in declared}  # a row per language
    of = [sum(r[f"v{i}"] for r in declared) for i in range(n)]
    told = [x for c in languages for x in (F.lit(c), F.array(*[F.lit(float(np.log(((seen[c][f"v{i}"] if c in seen else 0.0) + 0.5) / (of[i] + 0.5 * n)))) for i in range(n)]))]
    declaration = F.coalesce(F.create_map(*told)[F.col("declared")], F.array(*[F.lit(0.0)] * n))

    def smoothed(votes: Column, above: Column) -> Column:
        size = F.aggregate(votes, F.lit(0.0), lambda s, x: s + x)
        return F.zip_with(votes, above, lambda v, p: (v + strength * p) / (size + strength))

    hosts = rows.groupBy("host", "suffix").agg(*_sums(n)).select("host", "suffix", _votes(n).alias("host_votes"))
    suffixes = rows.groupBy("suffix").agg(*_sums(n)).select(F.col("suffix").alias("end"), _votes(n).alias("end_votes"))
    levels = hosts.join(suffixes, F.col("suffix") == F.col("end")).select(
        F.col("host").alias("of_host"), F.col("suffix").alias("of_suffix"), "host_votes", "end_votes"
    )
    # written: Spark splits a hot host only if both sides of the join are shuffled as they are
    levels = staged(levels, "hosts")
    joined = rows.join(levels, (F.col("host") == F.col("of_host")) & (F.col("suffix") == F.col("of_suffix")))
    less = lambda votes: F.zip_with(votes, F.col("vote"), lambda v, own: F.greatest(v - own, F.lit(0.0)))
    place = smoothed(less(F.col("host_votes")), smoothed(less(F.col("end_votes")), prior))
    log_post = F.zip_with(
        F.zip_with(F.col("likelihoods"), declaration, lambda a, b: a + b), F.transform(place, lambda p: F.log(p)), lambda a, b: a + b
    )
    best = lambda a: F.element_at(named, F.array_position(a, F.array_max(a)).cast("int"))
    return (
        joined.withColumn("posterior", _normal(log_post))
        .withColumn("language", best(F.col("posterior")))
        .withColumn("confidence", F.array_max("posterior"))
        .withColumn("text_language", best(F.col("vote")))
        .drop("of_host", "of_suffix", "host_votes", "end_votes", "vote", "likelihoods", "posterior")
    )
