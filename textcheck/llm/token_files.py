"""Token-id files: zstandard frames, one per document, with a shared dictionary and an index."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textcheck.llm.token_cache import shared_encoder
from textcheck.llm.words import text_slices
from textcheck.session import small_batches

#: A block holds the frames of about so many bytes; a longer frame is a block of its own.
BLOCK_BYTES = 1 << 20
#: Whole texts that travel to a worker at once.
BATCH_ROWS = 1_024
#: Sample that the dictionary is trained on: documents, and bytes of each, from a place that a hash
#: chooses. It bears on the size of the files alone, never on what is read back.
SAMPLE_ROWS, SAMPLE_BYTES, DICTIONARY_BYTES, LEVEL = 1_000, 4_096, 65_536, 3

BLOCK_SCHEMA = ("shard int, block int, first_doc_id long, last_doc_id long, n_tokens long, "
                "dictionary_sha256 string, doc_ids array<long>, counts array<long>, "
                "offsets array<long>, frames binary")


def _section(ids: bytes, limit: int) -> bytes:
    """At most ``limit`` bytes of ``ids``, from a place chosen by their CRC-32."""
    start = zlib.crc32(ids) % (max(len(ids) - limit, 0) // 2 + 1) * 2
    return ids[start:start + limit]


def _id_rows(tokenizer: str, end_id: int, limit: int | None):
    """mapInArrow function: serialized ids (little-endian, 16 bits), or ``limit`` bytes of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The sort before this takes the larger part of an executor's memory.
        encoder = shared_encoder(tokenizer, 64 << 20)
        end = end_id.to_bytes(2, "little")
        for batch, texts in text_slices(batches, "text"):
            ids = [x + end for x in encoder.encode(texts.to_pylist())]
            ids = [_section(x, limit) for x in ids] if limit else ids
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())],
                                             ["doc_id", "ids"])

    return run


def train_dictionary(rows: DataFrame, tokenizer: str, end_id: int) -> bytes:
    """A dictionary from the id arrays of SAMPLE_ROWS documents, chosen by a hash over all rows.

    It has an eighth of their bytes, DICTIONARY_BYTES at most. Arrays that no dictionary can be
    trained on (a handful of short ones) give an empty one, which means plain frames.
    """
    import zstandard

    some = rows.orderBy(F.xxhash64("doc_id", "text")).limit(SAMPLE_ROWS)
    samples = [r["ids"] for r in some.mapInArrow(
        _id_rows(tokenizer, end_id, SAMPLE_BYTES), "doc_id long, ids binary").collect()]
    samples = [bytes(x) for x in samples if len(x) >= 8]
    size = max(256, min(DICTIONARY_BYTES, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples, k=min(512, size // 4), d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def _frame_rows(tokenizer: str, end_id: int, dictionary: bytes):
    """mapInArrow function: one compressed frame per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if shared:
            shared.precompute_compress(level=LEVEL)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        for batch in _id_rows(tokenizer, end_id, None)(batches):
            ids = batch.column("ids").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) // 2 for x in ids], pa.int64()),
                 pa.array([compressor.compress(x) for x in ids], pa.binary())],
                ["doc_id", "n_tokens", "frame"])

    return run


def _block_rows(tokenizer: str, end_id: int, dictionary: bytes, digest: str):
    """mapInArrow function over sorted partitions: frames gathered into indexed blocks."""
    encoded = _frame_rows(tokenizer, end_id, dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, number = TaskContext.get().partitionId(), 0
        ids: list = []
        counts: list[int] = []
        frames: list[bytes] = []
        size = 0

        def block() -> pa.RecordBatch:
            nonlocal size, number
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in frames])])
            known = [x for x in ids if x is not None]
            row = (shard, number, min(known, default=None), max(known, default=None), sum(counts),
                   digest, list(ids), list(counts), offsets.tolist(), b"".join(frames))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
                     pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            for held in (ids, counts, frames):
                held.clear()
            size, number = 0, number + 1
            return pa.RecordBatch.from_arrays(
                [pa.array([x], k) for x, k in zip(row, kinds)],
                ["shard", "block", "first_doc_id", "last_doc_id", "n_tokens", "dictionary_sha256",
                 "doc_ids", "counts", "offsets", "frames"])

        for batch in encoded(batches):
            for doc_id, n, frame in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "frame"))):
                ids.append(doc_id)
                counts.append(n)
                frames.append(frame)
                size += len(frame)
                if size >= BLOCK_BYTES:
                    yield block()
        if ids:
            yield block()

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, text: str = "text",
                      doc_id: str = "doc_id", end_id: int = 1) -> None:
    """Write the token ids of all documents below ``path``, in ascending order of doc_id.

    ``path/dictionary`` holds the shared dictionary and its hash. ``path/blocks`` holds Parquet
    rows, one per block: frames one after the other, and an index with the doc_id, the number
    of ids and the offset of each frame, the range of ids (statistics that a reader of single
    documents skips by) and the hash of the dictionary. Shards are ranges of doc_id, numbered
    in order. Null and empty texts are ``end_id`` alone; rows that repeat a doc_id stay apart;
    null ids come first. Written by Spark's own writers, so that a lost task is written again.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dictionary = train_dictionary(rows, tokenizer, end_id)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary))], "sha256 string, dictionary binary").coalesce(
        1).write.parquet(f"{path}/dictionary")
    # Ranges are found on the ids, before the texts are encoded, so that each is encoded once; rows
    # that share an id are dealt by their texts.
    with small_batches(spark, BATCH_ROWS):
        (rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie")
         .sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
         .mapInArrow(_block_rows(tokenizer, end_id, dictionary, digest), BLOCK_SCHEMA)
         .write.option("compression", "none").parquet(f"{path}/blocks"))


def _document_rows(dictionary: bytes, digest: str, wanted: set[int] | None):
    """mapInArrow function: the documents of each block, ids as little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        reader = zstandard.ZstdDecompressor(dict_data=shared)
        for batch in batches:
            # A block is large: one at a time.
            for row in (batch.slice(r, 1).to_pylist()[0] for r in range(batch.num_rows)):
                if row["dictionary_sha256"] != digest:
                    raise ValueError("block was written with another dictionary")
                start, out = row["start"], []
                for i, (doc_id, n) in enumerate(zip(row["doc_ids"], row["counts"])):
                    if wanted is None or doc_id in wanted:
                        frame = row["frames"][row["offsets"][i]:row["offsets"][i + 1]]
                        ids = np.frombuffer(reader.decompress(frame), "<u2").astype("<u4").tobytes()
                        if len(ids) != 4 * n:
                            raise ValueError(f"document {doc_id}: {len(ids) // 4} ids, {n} indexed")
                        out.append((doc_id, start, n, ids))
                    start += n
                columns = list(zip(*out)) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                    ["doc_id", "start", "n_tokens", "ids"])

    return run


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all documents, or of ``doc_ids``.

    ``start`` is the number of ids of all documents before. Blocks outside the wanted ids are
    skipped by their range, other frames by the index. Only the dictionary (DICTIONARY_BYTES at
    most) and one total per shard are read by the driver or broadcast.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    head = spark.read.parquet(f"{path}/dictionary").first()
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(
            Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    earlier = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("shard", "block", "n_tokens").withColumn(
        "within", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))).join(shards, "shard").select(
        "shard", "block", (F.col("base") + F.col("within")).alias("start"))
    wanted = None
    if doc_ids is not None:
        wanted = set(doc_ids)
        low, high = min(wanted, default=0), max(wanted, default=-1)
        blocks = blocks.where((F.col("first_doc_id") <= high) & (F.col("last_doc_id") >= low))
    return (blocks.join(F.broadcast(starts) if doc_ids is not None else starts, ["shard", "block"])
            .select("start", "dictionary_sha256", "doc_ids", "counts", "offsets", "frames")
            .mapInArrow(_document_rows(bytes(head["dictionary"]), head["sha256"], wanted),
                        "doc_id long, start long, n_tokens long, ids binary"))
