"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Sources in code-point order (null last) take the given weights in turn. Together they are to
give ``total`` words (default: as many as the input has); no source gives more than
``max_epochs`` times its own words. The level is found by clamping: share out by weight, clamp
every source whose share is above its cap, share the excess among the rest by weight, until
none is above. Each round is one aggregate over the sources and brings back one row.

A source taken ``e`` times gives every document ``floor(e)`` times, and once more the
documents that come first in a seeded order until the words still wanted are reached; the
last one counts if at least half of it fits. So taken words miss the target by at most half
a document. Running sums go over 4096 hash buckets of each source, then inside a bucket, so
no task ever holds a whole source, however large.

Edge cases: a null text has size 0; documents without words add nothing; a null source is a
source; repeated rows are taken one by one; an empty table gives an empty result. A source
without words has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import WORD, fresh, partitions, quoted, staged

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BUCKET_DIGITS = 3  # hexadecimal digits of the seeded order that name a bucket


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A text that is never null: equal for equal sources, in their order, null last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def seeded_order(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` by ``key`` from 0: ranges are ranked side by side."""
    n = partitions(sources.sparkSession)
    dealt = staged(
        sources.repartitionByRange(n, "key").withColumn("part", F.spark_partition_id()), "sources"
    )
    counts = {r.part: r.n for r in dealt.groupBy("part").agg(F.count("*").alias("n")).collect()}
    before, offsets = 0, []
    for part in sorted(counts):  # a row per range
        offsets += [F.lit(part), F.lit(before)]
        before += counts[part]
    offset = F.create_map(*offsets)[F.col("part")] if offsets else F.lit(0)
    rank = F.row_number().over(Window.partitionBy("part").orderBy("key")) - 1 + offset
    return dealt.withColumn("rank", rank.cast("long")).drop("part")


def water_fill(
    sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, total: int | None = None
) -> DataFrame:
    """``sources`` (key, source_size) with ``target``, in words."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    filled = ranked(sources).select(
        "key",
        "source_size",
        F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight"),
        (F.lit(float(max_epochs)) * F.col("source_size")).alias("cap"),
    )
    first = filled.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    whole = float((first["size"] or 0) if total is None else total)
    rest, free, clamped = whole, first["weight"] or 1.0, -1
    while True:
        above = F.col("cap") * F.lit(free) < F.lit(rest) * F.col("weight")
        row = filled.agg(
            F.count_if(above).alias("n"),
            F.sum(F.when(above, F.col("cap"))).alias("cap"),
            F.sum(F.when(~above, F.col("weight"))).alias("free"),
        ).first()
        if row.n == clamped or not row.free:
            break
        clamped, rest, free = row.n, whole - (row.cap or 0.0), row.free
    return filled.withColumn(
        "target",
        F.when(above, F.col("cap")).otherwise(F.lit(rest) * F.col("weight") / F.lit(free)),
    )


def _shares(sized: DataFrame, weights, max_epochs, total) -> DataFrame:
    """One row per source and bucket: the source's numbers and its words in earlier buckets."""
    sums = sized.groupBy("key", "bucket").agg(F.sum("size").alias("words"))
    sources = sums.groupBy("key").agg(F.sum("words").alias("source_size"))
    plan = water_fill(sources, weights, max_epochs, total)
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        sums.select("key", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
        .join(plan.select("key", "source_size", "target"), "key")
        .withColumn("whole", F.floor(F.least(epochs, F.lit(float(max_epochs)))))
        .withColumn("quota", F.col("target") - F.col("whole") * F.col("source_size"))
    )


def _copies(dealt: DataFrame, size: str, whole: str, quota: str, before: str, key: str, bucket: str, order) -> Column:
    """Times a row is taken; the running sum inside its bucket decides on the last one."""
    inside = Window.partitionBy(key, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col(before) + F.coalesce(F.sum(size).over(inside), F.lit(0))
    more = (2 * ahead + F.col(size) <= 2 * F.col(quota)) & (F.col(quota) > 0)
    return F.col(whole) + F.when(more, 1).otherwise(0)


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    order = seeded_order(quoted(id_col), seed)
    return docs.select(
        quoted(id_col).alias("id"),
        source_key(quoted(source_col)).alias("key"),
        n_words(quoted(text_col)).alias("size"),
        order.alias("order"),
        F.substring(order, 1, BUCKET_DIGITS).alias("bucket"),
        F.xxhash64(quoted(text_col).cast("string")).alias("tie"),
    )


def mix(
    docs: DataFrame,
    *,
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    total: int | None = None,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per row of ``docs``: ``id``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``."""
    sized = staged(_sized(docs, id_col, text_col, source_col, seed), "sized")
    shares = _shares(sized, weights, max_epochs, total)
    dealt = sized.join(shares, ["key", "bucket"])
    copies = _copies(dealt, "size", "whole", "quota", "before", "key", "bucket", ["order", "size", "tie"])
    return (
        dealt.withColumn("copies", copies)
        .withColumn("taken", (F.col("size") * F.col("copies")).cast("long"))
        .select("id", "size", "source_size", "target", "copies", "taken")
    )


def mixed_rows(
    docs: DataFrame,
    *,
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    total: int | None = None,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` takes it, with the columns of ``docs``."""
    sized = _sized(docs, id_col, text_col, source_col, seed)
    shares = _shares(staged(sized.select("key", "bucket", "size"), "sized"), weights, max_epochs, total)
    name = {c: fresh(docs, f"mix_{c}") for c in ("key", "bucket", "size", "order", "tie", "whole", "quota", "before", "copies")}
    order = seeded_order(quoted(id_col), seed)
    dealt = docs.withColumns(
        {
            name["key"]: source_key(quoted(source_col)),
            name["size"]: n_words(quoted(text_col)),
            name["order"]: order,
            name["bucket"]: F.substring(order, 1, BUCKET_DIGITS),
            name["tie"]: F.xxhash64(quoted(text_col).cast("string")),
        }
    ).join(
        shares.select(*[F.col(c).alias(name[c]) for c in ("key", "bucket", "whole", "quota", "before")]),
        [name["key"], name["bucket"]],
    )
    ties = [name["order"], name["size"], name["tie"]]
    copies = _copies(dealt, *[name[c] for c in ("size", "whole", "quota", "before", "key", "bucket")], ties)
    return (
        dealt.withColumn(name["copies"], copies.cast("int"))
        .filter(F.col(name["copies"]) > 0)
        .withColumn(name["copies"], F.explode(F.array_repeat(F.lit(0), F.col(name["copies"]))))
        .select(*[quoted(c) for c in docs.columns])
    )


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source
), capped AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap, (sum(source_size) OVER ())::DOUBLE AS whole,
         sum(weight) OVER () AS all_weight,
         coalesce(sum(3.0::DOUBLE * source_size) OVER before, 0) AS cap_before,
         coalesce(sum(weight) OVER before, 0) AS weight_before
  FROM src
  WINDOW before AS (ORDER BY source_size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, cap * (all_weight - weight_before) < (whole - cap_before) * weight AS clamped FROM capped
), level AS (
  SELECT whole - cap_before AS rest, all_weight - weight_before AS free
  FROM levels WHERE NOT clamped ORDER BY weight_before LIMIT 1
), plan AS (
  SELECT source, source_size, CASE WHEN clamped THEN cap ELSE rest * weight / free END AS target
  FROM levels CROSS JOIN level
), parts AS (
  SELECT *, floor(least(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END, 3.0)) AS whole_copies FROM plan
), dealt AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole_copies,
         p.target - p.whole_copies * p.source_size AS quota,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix' || coalesce(d.doc_id::VARCHAR, '')), d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       (size * (whole_copies + CASE WHEN quota > 0 AND 2 * ahead + size <= 2 * quota THEN 1 ELSE 0 END))::BIGINT AS taken
FROM dealt
"""
