"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised (A-Z to lower case, everything but ASCII letters and digits and
characters beyond ASCII to single blanks). Every run of ``window`` words of a test item, or
all words of a shorter item, is a pattern; all patterns go into one automaton, and every
document is scanned once, from end to end. A hit's offset in the normalised text gives its
word, and the word its place in the original text.

Size. The automaton is sent to the tasks only because its size is bounded: patterns are
counted first, and above ``max_pattern_chars`` characters the items are dealt into so many
groups by hash, each group's automaton scanning the documents in a pass of its own, whose rows
are written. Items
longer than a group are dealt by pattern, so no group is beyond the bound. Only the patterns
of one group are on the driver at a time. Documents are never shuffled by the scan.

Edge cases: null and empty texts have no words; items without words match nothing; a null
item id is reported as an empty text; repeated rows are scanned one by one, repeated items
count once per id; texts are scanned whole, however long; other columns are kept as they are,
whatever their names; empty tables give no hits or no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm.common import fresh, quoted, staged, text_bytes

WINDOW = 10
MAX_PATTERN_CHARS = 16_000_000  # an automaton of some hundred megabytes at most

# What is no word becomes a blank, A-Z become a-z.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
NORMAL = bytes.maketrans(
    SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(SEPARATORS) + bytes(range(0x61, 0x7B))
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # of texts as they are


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(NORMAL).split()


def windows(raw: bytes, window: int = WINDOW) -> list[str]:
    """The patterns of one item's text, each between blanks."""
    words = words_of(raw)
    n = max(len(words) - window + 1, 1) if words else 0
    return [f" {b' '.join(words[i : i + window]).decode()} " for i in range(n)]


def _patterns(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = windows(text, window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.string()), pa.array([item] * len(found), pa.string())],
                    names=["pattern", "item"],
                )

    named = F.coalesce(quoted(id_col).cast("string"), F.lit(""))
    source = items.select(named.alias("item"), text_bytes(text_col).alias("text"))
    return source.mapInArrow(run, "pattern string, item string").distinct()


def automaton(patterns: list[tuple[str, str]]) -> ahocorasick.Automaton:
    """One automaton of (pattern, item) pairs; a pattern's value is (its words, its items)."""
    items: dict[str, list[str]] = {}
    for pattern, item in patterns:
        items.setdefault(pattern, []).append(item)
    built = ahocorasick.Automaton()
    for pattern, own in items.items():
        built.add_word(pattern, (pattern.count(" ") - 1, sorted(own)))
    if items:
        built.make_automaton()
    return built


def scan(raw: bytes, built: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int, list[str]]]]:
    """Words of a text, and its hits as (first word, word after the last, items)."""
    words = words_of(raw)
    if not words or not len(built):
        return len(words), []
    joined = f" {b' '.join(words).decode()} "
    found = list(built.iter(joined))
    if not found:
        return len(words), []
    blanks = np.flatnonzero(np.frombuffer(joined.encode("utf-32-le"), "<u4") == 32)
    last = np.searchsorted(blanks, [end for end, _ in found]).tolist()
    return len(words), [(stop - n, stop, items) for stop, (_, (n, items)) in zip(last, found)]


def runs(hits: list[tuple[int, int, list[str]]]) -> list[list[int]]:
    """Hit words as runs of touching or overlapping windows."""
    out: list[list[int]] = []
    for start, stop, _ in sorted(hits, key=lambda h: h[:2]):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return out


def original_spans(text: str, found: list[list[int]]) -> list[list[int]]:
    """Runs of words as places in the original text, in characters."""
    if not found:
        return []
    places = [m.span() for m in WORD.finditer(text)]
    return [[places[i][0], places[j - 1][1]] for i, j in found]


HIT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("words", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    ]
)


def _scanner(docs: DataFrame, patterns: list[tuple[str, str]]):
    known = docs.sparkSession.sparkContext.broadcast(patterns)  # one group, so bounded
    made: list[ahocorasick.Automaton] = []

    @F.arrow_udf(HIT)
    def hits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if not made:
            made.append(automaton(known.value))
        for batch in batches:
            rows = []
            for raw in batch.to_pylist():
                n, found = scan(raw, made[0])
                if found:
                    joined = runs(found)
                    items = sorted({i for _, _, own in found for i in own})
                    rows.append(
                        {"n_words": n, "items": items, "words": joined, "spans": original_spans(raw.decode(), joined)}
                    )
                else:
                    rows.append({"n_words": n, "items": [], "words": [], "spans": []})
            yield pa.array(rows, pa.struct([("n_words", pa.int64()), ("items", pa.list_(pa.string())), ("words", pa.list_(pa.list_(pa.int64()))), ("spans", pa.list_(pa.list_(pa.int64())))]))

    return hits


def _merged(a: str, b: str):
    """Two passes over the same rows as one: items and runs together."""

    @F.arrow_udf(HIT)
    def merge(first: pa.Array, second: pa.Array) -> pa.Array:
        rows = []
        for x, y in zip(first.to_pylist(), second.to_pylist()):
            join = [runs([(*r, []) for r in x[k] + y[k]]) for k in ("words", "spans")]
            rows.append({"n_words": x["n_words"], "items": sorted({*x["items"], *y["items"]}), "words": join[0], "spans": join[1]})
        return pa.array(rows, first.type)

    return merge(F.col(a), F.col(b))


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    *,
    window: int = WINDOW,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    max_pattern_chars: int = MAX_PATTERN_CHARS,
    into: str = "hits",
) -> DataFrame:
    """``docs`` with a struct column ``into``: ``n_words``, ``items`` (sorted as text),
    ``words`` (hit runs of words) and ``spans`` (the runs in the original text)."""
    patterns = _patterns(items, window, item_id_col, item_text_col)
    size = patterns.agg(F.sum(F.length("pattern"))).first()[0] or 0
    groups = size // max_pattern_chars + 1
    text = text_bytes(text_col)
    out = docs
    for g in range(groups):
        own = patterns.filter(F.pmod(F.xxhash64("pattern"), F.lit(groups)) == g) if groups > 1 else patterns
        pairs = [(r.pattern, r.item) for r in own.collect()]  # of one bounded group
        found = _scanner(docs, pairs)(text)
        if g == 0:
            out = out.withColumn(into, found)
        else:
            more = fresh(out, f"{into}_more")
            out = out.withColumn(more, found).withColumn(into, _merged(into, more)).drop(more)
        if groups > 1:  # a pass of its own, so that one automaton is held at a time
            out = staged(out, "scanned")
    return out


def contamination(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """Per row: ``id``, ``n_words``, ``n_hit``, ``items`` and ``spans``."""
    found = find_hits(docs, items, into=fresh(docs, "hits"), **options)
    hits = quoted(fresh(docs, "hits"))
    length = F.transform(hits["words"], lambda r: F.element_at(r, 2) - F.element_at(r, 1))
    return found.select(
        quoted(id_col).alias("id"),
        hits["n_words"].alias("n_words"),
        F.aggregate(length, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_hit"),
        hits["items"].alias("items"),
        hits["spans"].alias("spans"),
    )


def clean_rows(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a single hit."""
    into = fresh(docs, "hits")
    found = find_hits(docs, items, into=into, **options)
    return found.filter(F.size(quoted(into)["items"]) == 0).select(*[quoted(c) for c in docs.columns])


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


ORACLE = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows
), grams AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words CROSS JOIN sizes WHERE len(w) >= n)
), found AS (
  SELECT g.doc_id, g.i, g.n, x.item_id FROM grams g JOIN windows x ON g.n = x.n AND g.g = x.g
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
       coalesce(n.n_items, 0)::BIGINT AS n_items, sha256(coalesce(n.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit h USING (doc_id) LEFT JOIN named n USING (doc_id)
"""
