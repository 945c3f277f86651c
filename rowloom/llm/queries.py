"""The queries of this subpackage, each over its whole tables, with SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import decontaminate, katz, langid, mixing, packing, prefix_trie, quality, repair, simhash, style_tree, substring_dedup, token_output, toxicity
from rowloom.llm.common import bounded, fold, scratch, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@bounded
def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, written and read back: its place and checksum."""
    path = scratch(spark, "tokens")
    token_output.write_tokens(table(spark, sf_dir, "documents"), path, TOKENIZER, end_id=1)
    return token_output.read_tokens(spark, path, digest=True).withColumnRenamed("id", "doc_id")


@bounded
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's part in the mix of sources."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@bounded
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and near-duplicate class."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@bounded
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words inside windows of benchmark items."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@bounded
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned without the rows of fold 2 of 4."""
    docs = table(spark, sf_dir, "documents")
    weights = toxicity.train(docs, table(spark, sf_dir, "labels"), may_learn=fold(F.col("id"), 4) != 2)
    return toxicity.score(docs.select("doc_id", "text"), weights).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@bounded
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base counts and verdict."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    found = quality.assess(docs.select("doc_id", "text"), model, into="q").select("doc_id", "q.*")
    failed = quality.base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return found.select(
        "doc_id",
        *quality.COUNTS,
        failed.alias("base_failed"),
        (~failed & (F.col("score") >= quality.KEEP_FROM)).alias("kept"),
        "score",
    )


@bounded
def op10_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    found = style_tree.main_text(table(spark, sf_dir, "pages"), into="main_text")
    return found.select(
        "page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars")
    )


@bounded
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document (a row with ``doc_id``) and of every page (``page_id``)."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = langid.train(docs)
    none = F.lit(None)
    texts = langid.text_evidence(docs.select("doc_id", "text", "source"), model, F.concat(F.lit("source:"), "source"))
    sites = langid.page_evidence(pages.select("page_id", "url", "html"), model)
    evidence = texts.select(
        "doc_id", none.cast("long").alias("page_id"), none.cast("string").alias("url"), "host", "suffix", "declared", "likelihoods"
    ).unionByName(sites.withColumn("doc_id", none.cast("long")))
    return langid.fuse(evidence, model.languages)


@bounded
def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability under a model learned without fold 1 of 5."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = katz.score(docs, fold(F.col("doc_id"), 5) == 1)
    return found.select(
        F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@bounded
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of repeated 200-byte strings."""
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@bounded
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence of at most 4096 tokens."""
    pieces = packing.cut(table(spark, sf_dir, "documents"), TOKENIZER, end_id=1)
    return packing.pack(pieces).withColumnRenamed("id", "doc_id")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with dropped, emptied, cut, repeated and retagged turns, by crc32."""
    named = conversations.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    kept = named.withColumn("kind", kind).filter("kind <> 0")
    return kept.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


@bounded
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after damage, and its cheapest repair."""
    conversations = table(spark, sf_dir, "conversations")
    reports, pieces = repair.repair(damaged(conversations))
    mended = reports.join(repair.digests(pieces).withColumnRenamed("id", "own"), F.col("id").eqNullSafe(F.col("own")))
    all_ids = conversations.select("conv_id").distinct()
    none = F.sha2(F.lit("").cast("binary"), 256)
    return all_ids.join(mended, F.col("conv_id").eqNullSafe(F.col("id")), "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", none).alias("repaired_sha256"),
    )


def rebuilt(sequences: DataFrame) -> DataFrame:
    """Every conversation with its first turns replaced by those of the first of its hundred."""
    heads = F.crc32(F.col("id").cast("string").cast("binary")) % 6
    firsts = sequences.filter("id % 100 = 0").select(F.col("id").alias("base"), F.slice("turns", 1, 5).alias("shared"))
    joined = sequences.withColumn("h", heads.cast("int")).join(firsts, F.col("id") - F.col("id") % 100 == F.col("base"), "left")
    shared = F.coalesce(F.expr("slice(shared, 1, h)"), F.expr("slice(turns, 1, 0)"))
    return joined.select("id", F.concat(shared, F.expr("slice(turns, h + 1, size(turns))")).alias("turns"))


@bounded
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of rebuilt conversations."""
    sequences = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    none = F.sha2(F.lit("").cast("binary"), 256)
    return prefix_trie.trie(rebuilt(sequences)).select(
        F.col("id").alias("conv_id"),
        F.col("depth").cast("long").alias("depth"),
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", none).alias("ends_sha256"),
    )


QUERIES = {
    "op1_token_output": op1_token_output,
    "op2_mixing": op2_mixing,
    "op7_simhash": op7_simhash,
    "op8_decontamination": op8_decontamination,
    "op4_toxicity": op4_toxicity,
    "op5_quality": op5_quality,
    "op10_style_tree": op10_style_tree,
    "op9_language_id": op9_language_id,
    "op6_katz": op6_katz,
    "op3_substring_dedup": op3_substring_dedup,
    "op11_repair": op11_repair,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_packing": op13_packing,
}
ORACLES: dict[str, str] = {
    "op2_mixing": mixing.ORACLE,
    "op8_decontamination": decontaminate.ORACLE,
    "op11_repair": repair.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
}
