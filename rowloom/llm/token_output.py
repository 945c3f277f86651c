"""Token-id output: per-document zstandard frames that share one trained dictionary.

``write_tokens`` encodes whole texts and writes, below one path,

* ``dictionary``: one row, the dictionary's bytes and its hash;
* ``blocks``: documents in ascending id order (nulls first, ties by text hash), some
  hundreds to a row. A row holds the ids, token counts and frame offsets of its documents
  (the offset index; readable without the frames), the dictionary's hash and the frames;
* ``parts``: one row per written partition with the number of ids before it.

Each document is its own frame, so one short document is read without its neighbours.
Texts are dealt to tasks by id range and encoded after the shuffle; nothing but the
dictionary (bounded), its training sample (bounded) and one row per partition reaches the
driver. Blocks are committed by Spark's writer, so a lost executor only repeats its tasks.

Edge cases: null and empty texts hold only the end id; a repeated row is written as often
as it stands; an empty table gives no blocks; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from rowloom.llm.common import partitions, quoted, text_bytes
from rowloom.llm.pieces import encoder as _encoder

SAMPLE_DOCS = 512  # different documents in the dictionary's training sample, at most
SAMPLE_IDS = 4096  # ids in a row of each that train it
DICTIONARY_BYTES = 1 << 16
BLOCK_BYTES = 1 << 22
BLOCK_DOCS = 1024


def dictionary_hash(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()[:32]


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from serialized id arrays; too few to train on serve as they are."""
    samples = [s for s in samples if s]
    try:
        if len(samples) >= 16:
            return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        pass
    return b"".join(samples)[-size:]


def _dict(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def _narrow(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def _wide(raw: bytes, width: int) -> bytes:
    return raw if width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()


def _sample(docs: DataFrame, spec: str, width: int, text_col: str, id_col: str) -> list[bytes]:
    """Id arrays of the ``SAMPLE_DOCS`` different documents least in hash order, of each
    ``SAMPLE_IDS`` ids in a row from a place that the hash picks. Reruns choose alike."""
    text = text_bytes(text_col)
    total = docs.count()
    rows = docs.select(F.xxhash64(quoted(id_col), text, F.lit("dictionary")).alias("h"), text.alias("text"))
    # about twice what is needed goes on to be told apart and ordered
    rows = rows.filter(F.pmod("h", F.lit(max(1, total // (2 * SAMPLE_DOCS)))) == 0)
    rows = rows.groupBy("h").agg(F.first("text").alias("text")).orderBy("h").limit(SAMPLE_DOCS)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = _encoder(spec).encode([raw])[0]
                at = 4 * (h % max(1, len(ids) // 4 - SAMPLE_IDS))
                own = _narrow(ids[at : at + 4 * SAMPLE_IDS], width)
                yield pa.RecordBatch.from_pydict({"ids": pa.array([own], pa.binary())})

    return sorted(bytes(r.ids) for r in rows.mapInArrow(encode, "ids binary").collect())


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    *,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    parts: int | None = None,
) -> None:
    """Encode every text of ``docs`` (plus ``end_id``) and write it below ``path``."""
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = f.read()
    width = 2 if max(Tokenizer.from_str(spec).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    shared = train_dictionary(_sample(docs, spec, width, text_col, id_col))
    name = dictionary_hash(shared)
    spark.createDataFrame([(name, width, bytearray(shared))], "dict_hash string, width int, data binary").coalesce(
        1
    ).write.parquet(f"{path}/dictionary")

    id_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("first_id", id_type),
            T.StructField("last_id", id_type),
            T.StructField("start_in_part", T.LongType()),
            T.StructField("tokens", T.LongType()),
            T.StructField("dict_hash", T.StringType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("n_tokens", T.ArrayType(T.IntegerType())),
            T.StructField("offsets", T.ArrayType(T.LongType())),
            T.StructField("frames", T.BinaryType()),
        ]
    )
    end = np.array([end_id], "<u4").tobytes()
    known = spark.sparkContext.broadcast((spec, shared))  # a tokenizer file and 64 KB

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec, data = known.value
        encoder = _encoder(spec)
        pack = zstandard.ZstdCompressor(level=3, dict_data=_dict(data))
        part, before, tokens = TaskContext.get().partitionId(), 0, 0
        ids: list = []
        counts: list[int] = []
        offsets, frames = [0], []
        out_type = None

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([next((i for i in ids if i is not None), None)], out_type),
                    pa.array(ids[-1:], out_type),
                    pa.array([before], pa.int64()),
                    pa.array([tokens], pa.int64()),
                    pa.array([name]),
                    pa.array([ids], pa.list_(out_type)),
                    pa.array([counts], pa.list_(pa.int32())),
                    pa.array([offsets], pa.list_(pa.int64())),
                    pa.array([b"".join(frames)], pa.binary()),
                ],
                names=schema.names,
            )

        for batch in batches:
            out_type = batch.schema.field(0).type
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for lo in range(0, len(keys), 128):
                coded = encoder.encode(texts.slice(lo, 128).to_pylist())
                for key, found in zip(keys[lo : lo + 128], coded):
                    frames.append(pack.compress(_narrow(found + end, width)))
                    offsets.append(offsets[-1] + len(frames[-1]))
                    ids.append(key)
                    counts.append(len(found) // 4 + 1)
                    tokens += counts[-1]
                    if len(ids) >= BLOCK_DOCS or offsets[-1] >= BLOCK_BYTES:
                        yield block()
                        before += tokens
                        ids, counts, offsets, frames, tokens = [], [], [0], [], 0
        if ids:
            yield block()

    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    (
        docs.select(quoted(id_col).alias("key"), text_bytes(text_col).alias("text"))
        # exact repeats of one row are told apart by the task they come from
        .repartitionByRange(parts or partitions(spark), *order, F.spark_partition_id())
        .sortWithinPartitions(*order)
        .mapInArrow(blocks, schema)
        .write.parquet(f"{path}/blocks")
    )
    _write_parts(spark, path)


def _write_parts(spark: SparkSession, path: str) -> None:
    """Ids before each partition: sums of one row per partition, so bounded by their number."""
    sums = (
        spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("tokens").alias("n")).orderBy("part").collect()
    )
    before, rows = 0, []
    for r in sums:
        rows.append((r.part, before))
        before += r.n
    spark.createDataFrame(rows, "part int, part_start long").coalesce(1).write.parquet(f"{path}/parts")


def _opener(spark: SparkSession, path: str):
    row = spark.read.parquet(f"{path}/dictionary").first()
    name, width, data = row.dict_hash, row.width, bytes(row.data)
    if dictionary_hash(data) != name:
        raise ValueError(f"the dictionary of {path} does not have the hash {name}")
    return name, width, data


def read_tokens(spark: SparkSession, path: str, *, digest: bool = False) -> DataFrame:
    """One row per document: ``id``, ``start`` (ids before it), ``n_tokens`` and its ids as
    little-endian unsigned 32-bit integers (``tokens``), or their crc32 with ``digest``."""
    name, width, data = _opener(spark, path)
    files = spark.read.parquet(f"{path}/blocks")
    parts = spark.read.parquet(f"{path}/parts")  # a row per written partition
    schema = T.StructType(
        [
            T.StructField("id", files.schema["first_id"].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()) if digest else T.StructField("tokens", T.BinaryType()),
        ]
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor(dict_data=_dict(data))
        for batch in batches:
            id_type = batch.schema.field("ids").type.value_type
            for row in range(batch.num_rows):
                one = {c: batch.column(c)[row] for c in batch.schema.names}
                if one["dict_hash"].as_py() != name:
                    raise ValueError("a block names another dictionary")
                counts = np.asarray(one["n_tokens"].values, np.int64)
                cuts, frames = one["offsets"].as_py(), one["frames"].as_py()
                start = one["start"].as_py() + np.cumsum(counts) - counts
                tokens = [_wide(unpack.decompress(frames[i:j]), width) for i, j in zip(cuts, cuts[1:])]
                last = (
                    pa.array([zlib.crc32(t) for t in tokens], pa.int64()) if digest else pa.array(tokens, pa.binary())
                )
                ids = pa.array(one["ids"].as_py(), id_type)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(start), pa.array(counts), last], names=[f.name for f in schema]
                )

    return (
        files.join(F.broadcast(parts), "part")
        .select(
            "dict_hash", "ids", "n_tokens", "offsets", "frames", (F.col("part_start") + F.col("start_in_part")).alias("start")
        )
        .mapInArrow(documents, schema)
    )


def read_document(spark: SparkSession, path: str, doc_id) -> list[list[int]]:
    """Ids of the documents with this id: block statistics and the offset index find their
    frames; no other frame is unpacked."""
    name, width, data = _opener(spark, path)
    unpack = zstandard.ZstdDecompressor(dict_data=_dict(data))
    spot = F.array_position("ids", F.lit(doc_id))
    rows = (
        spark.read.parquet(f"{path}/blocks")
        .filter((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id) & (spot > 0))
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.size("ids"))))
        .filter(F.element_at("ids", F.col("at")) == doc_id)
        .select(
            F.substring(
                "frames",
                (F.element_at("offsets", F.col("at")) + 1).cast("int"),
                (F.element_at("offsets", F.col("at") + 1) - F.element_at("offsets", F.col("at"))).cast("int"),
            ).alias("frame")
        )
        .collect()
    )
    return [np.frombuffer(_wide(unpack.decompress(bytes(r.frame)), width), "<u4").tolist() for r in rows]
