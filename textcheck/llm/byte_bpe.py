"""Byte-level BPE: merges folded by Spark higher-order functions, once for a word that many blocks have."""

from __future__ import annotations

import base64
import heapq
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textcheck.session import discard, materialise

#: Text bytes whose distinct words are folded together, as one row.
BLOCK_BYTES = 2 << 20
#: Words of most blocks that are folded once and known to every worker, and words of a row that is folded.
COMMON_WORDS, ROW_WORDS = 1 << 18, 4_096
#: Rows of documents that travel to a Python worker at once.
BATCH_ROWS = 1_024
#: Buckets of the literal rank map: a look-up reads one small map.
BUCKETS = 1 << 15
#: Longer words are merged with a heap (n log n), as a fold over n pieces has n * n steps.
LONGEST = 64

BLOCK_SCHEMA = ("doc_ids array<long>, counts array<int>, places binary, words array<string>, "
                "heaped array<string>")


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks (also their ids) from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _letters(data: bytes) -> str:
    """Bytes as a string with one character for each byte."""
    return data.decode("latin-1")


def _rank_map(ranks: dict[bytes, int]) -> Column:
    """The literal array of maps from pieces to ranks; a piece lies in the bucket of its crc32."""
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for token, rank in ranks.items():
        piece = _letters(token)
        buckets[zlib.crc32(piece.encode()) % BUCKETS][piece] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def _bucket(piece: Column) -> Column:
    return (F.crc32(piece) % BUCKETS).cast("int")


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fold_merges(word: Column, ranks: Column) -> Column:
    """The ids of ``word`` (one character a byte), by its rank or by merges of lowest rank.

    The fold starts from single bytes and the ranks of neighbours' unions. Each step joins the
    leftmost neighbours of the lowest rank and looks up the two unions that this changes, until
    no union has a rank.
    """
    rank_of = lambda piece: F.get(ranks, _bucket(piece))[piece]
    none = F.array().cast("array<int>")

    def joined(state: Column, at: Column) -> Column:
        pieces, unions = state["pieces"], state["unions"]
        size = F.size(pieces)

        def around(union: Column) -> Column:
            left = F.when(at > 1, F.array(rank_of(F.concat(F.get(pieces, at - 2), union)))).otherwise(none)
            right = F.when(at + 1 < size, F.array(rank_of(F.concat(union, F.get(pieces, at + 1))))).otherwise(none)
            return F.struct(
                F.concat(F.slice(pieces, 1, at - 1), F.array(union), F.slice(pieces, at + 2, size)).alias("pieces"),
                F.concat(F.slice(unions, 1, F.greatest(at - 2, F.lit(0))), left, right,
                         F.slice(unions, at + 2, size)).alias("unions"))

        return _let(F.concat(F.get(pieces, at - 1), F.get(pieces, at)), around)

    def step(state: Column, _) -> Column:
        lowest = F.array_position(state["unions"], F.array_min(state["unions"])).cast("int")
        return _let(lowest, lambda at: F.when(F.coalesce(at, F.lit(0)) == 0, state).otherwise(joined(state, at)))

    length = F.length(word)
    start = _let(F.split(word, ""), lambda p: F.struct(p.alias("pieces"), F.transform(
        F.sequence(F.lit(1), length - 1), lambda i: rank_of(F.concat(F.get(p, i - 1), F.get(p, i)))).alias("unions")))
    folded = F.aggregate(F.sequence(F.lit(1), length - 1), start, step, lambda state: state["pieces"])
    pieces = F.when(rank_of(word).isNotNull() | (length < 2), F.array(word)).otherwise(folded)
    return F.transform(pieces, rank_of)


def _java_pattern(pattern: str) -> str:
    """White space by Unicode, as in the tokenizer's own expressions."""
    return "(?U)" + pattern


def _block_rows(pattern: str):
    """mapInArrow function: blocks of documents with their distinct words and word numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(
            r"\S", r"\P{White_Space}"))
        held: list[tuple[pa.Array, pa.Array, pa.Array]] = []
        size = 0

        def block() -> pa.RecordBatch:
            ids = pa.concat_arrays([x[0] for x in held])
            counts = pa.concat_arrays([x[1] for x in held])
            words = pa.concat_arrays([x[2] for x in held]).dictionary_encode()
            held.clear()
            distinct = [w.encode() for w in words.dictionary.to_pylist()]
            short = [_letters(w) if len(w) <= LONGEST else "" for w in distinct]
            heaped = [_letters(w) if len(w) > LONGEST else None for w in distinct]
            places = words.indices.to_numpy(zero_copy_only=False).astype("<u4").tobytes()
            columns = (ids.to_pylist(), counts.to_pylist(), places, short, heaped)
            kinds = (pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.string()),
                     pa.list_(pa.string()))
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(columns, kinds)],
                                              ["doc_ids", "counts", "places", "words", "heaped"])

        for batch in batches:
            rare = batch.column("rare")
            words = batch.column("words")
            for start in range(0, batch.num_rows, 256):
                some = words.slice(start, 256)
                texts = rare.slice(start, 256)
                if texts.null_count < len(texts):
                    some = pa.array([splitter.findall(t) if t is not None else w for t, w in zip(
                        texts.to_pylist(), some.to_pylist())], pa.list_(pa.string()))
                counts = pc.fill_null(pc.list_value_length(some), 0).cast(pa.int32())
                flat = some.flatten()
                held.append((batch.column("doc_id").slice(start, 256), counts, flat))
                size += pc.sum(pc.binary_length(flat)).as_py() or 0
                if size >= BLOCK_BYTES:
                    yield block()
                    size = 0
        if held:
            yield block()

    return run


def _packed_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(words): rows of at most ROW_WORDS words."""
    for batch in batches:
        for a in range(0, batch.num_rows, ROW_WORDS):
            some = batch.column("word").slice(a, ROW_WORDS)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some.cast(pa.string()))], ["words"])


def _marked_rows(common: pa.Array):
    """mapInArrow function: blocks without the words that are ``common``; ``known`` has their places there, or -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(r, 1) for r in range(batch.num_rows)):
                words = row.column("words").flatten().cast(pa.string())
                known = pc.index_in(words, value_set=common)
                left = pc.if_else(known.is_valid(), "", words)
                ends = pa.array([0, len(words)], pa.int32())
                columns = {c: row.column(c) for c in row.schema.names} | {
                    "words": pa.ListArray.from_arrays(ends, left),
                    "known": pa.ListArray.from_arrays(ends, pc.fill_null(known, -1))}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges as the fold, for a long word: neighbours kept in a heap by rank and place."""
    if word in ranks:
        return [ranks[word]]
    ends = list(range(1, len(word) + 1))
    before = list(range(-1, len(word) - 1))
    alive = [True] * len(word)
    heap: list[tuple[int, int, int, int]] = []

    def offer(a: int) -> None:
        b = ends[a]
        if b < len(word):
            rank = ranks.get(word[a:ends[b]])
            if rank is not None:
                heapq.heappush(heap, (rank, a, b, ends[b]))

    for a in range(len(word) - 1):
        offer(a)
    while heap:
        _, a, b, end = heapq.heappop(heap)
        if not (alive[a] and ends[a] == b and alive[b] and ends[b] == end):
            continue
        alive[b], ends[a] = False, end
        if end < len(word):
            before[end] = a
        offer(a)
        if before[a] >= 0:
            offer(before[a])
    found, at = [], 0
    while at < len(word):
        found.append(ranks[word[at:ends[at]]])
        at = ends[at]
    return found


def _document_rows(path: str, common: np.ndarray, bounds: np.ndarray):
    """mapInArrow function: the ids of each document of a block, from the ids of its words; those of ``common`` words
    lie one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(path)
        for batch in batches:
            for r in range(batch.num_rows):
                found = batch.column("ids")[r].values
                # Places of long words hold one null id, which is replaced below.
                ids = pc.fill_null(found.flatten(), 0).to_numpy().astype("<u4")
                ends = np.cumsum(np.diff(np.asarray(found.offsets)))
                starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                coded = [ids[a:b].tobytes() for a, b in zip(starts, ends)]
                known = batch.column("known")[r].values.to_numpy()
                at = np.flatnonzero(known >= 0)
                for i, a, b in zip(at.tolist(), bounds[known[at]].tolist(), bounds[known[at] + 1].tolist()):
                    coded[i] = common[a:b].tobytes()
                for i, word in enumerate(batch.column("heaped")[r].as_py()):
                    if word is not None:
                        merged = merge_long(word.encode("latin-1"), ranks)
                        coded[i] = struct.pack(f"<{len(merged)}I", *merged)
                places = np.frombuffer(batch.column("places")[r].as_py(), "<u4")
                at, doc_ids, out = 0, batch.column("doc_ids")[r].as_py(), []
                for n in batch.column("counts")[r].as_py():
                    out.append(b"".join([coded[p] for p in places[at:at + n].tolist()]))
                    at += n
                for start in range(0, len(out), 512):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids[start:start + 512], pa.int64()),
                         pa.array(out[start:start + 512], pa.binary())], ["doc_id", "ids"])

    return run


def encode(docs: DataFrame, rank_path: str, pattern: str, text: str = "text",
           doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, ids): the token ids of each text as little-endian 32-bit integers, without special tokens.

    Each match of ``pattern`` is encoded on its own. Texts are cut by the regular expressions of
    the JVM; where a text has characters that its Unicode tables do not know, by the regex
    library. Documents are gathered in blocks where they lie and written as numbers of the block's
    distinct words. These are folded by ``fold_merges`` against the literal rank map: a word that
    several blocks have once, if it is among the COMMON_WORDS of most blocks, the others in their
    block. Words of more than LONGEST bytes get the same merges from a heap. Null and empty texts
    have no ids; rows that repeat stay apart; ``docs`` may hold any other columns.
    """
    ranks = _rank_map(load_ranks(rank_path))
    body = F.coalesce(F.col(text), F.lit(""))
    unknown = body.rlike(r"\p{Cn}")
    cut = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.when(~unknown, F.regexp_extract_all(body, F.lit(_java_pattern(pattern)), F.lit(0))).alias("words"),
        F.when(unknown, body).alias("rare"))
    blocks = materialise(cut.mapInArrow(_block_rows(pattern), BLOCK_SCHEMA), BATCH_ROWS, compression="zstd")

    def folded(rows: DataFrame) -> DataFrame:
        return rows.withColumn("ids", _let(ranks, lambda r: F.transform("words", lambda w: fold_merges(w, r))))

    words, ids, bounds = _common_words(blocks, folded)
    marked = blocks.mapInArrow(_marked_rows(words), f"{BLOCK_SCHEMA}, known array<int>")
    return folded(marked).drop("words").mapInArrow(_document_rows(rank_path, ids, bounds), "doc_id long, ids binary")


def _common_words(blocks: DataFrame, folded) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """At most COMMON_WORDS words that most blocks have, two at least, their ids one after the other, and the bounds
    of these; the driver sees no more."""
    counted = materialise(blocks.select(F.explode("words").alias("word")).where("word != ''").groupBy("word").agg(
        F.count("*").alias("n")))
    sizes = sorted(counted.where("n > 1").groupBy("n").count().collect(), reverse=True)
    if not sizes:
        discard(counted)
        return pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(1, np.int64)
    upto = np.cumsum([size for _, size in sizes]).tolist()
    whole = sum(total <= COMMON_WORDS for total in upto)
    rows = counted.where(F.col("n") > sizes[whole][0] if whole < len(sizes) else F.col("n") > 1)
    if whole < len(sizes):
        room = COMMON_WORDS - (upto[whole - 1] if whole else 0)
        rows = rows.unionByName(counted.where(F.col("n") == sizes[whole][0]).limit(room))
    parts = 4 * blocks.sparkSession.sparkContext.defaultParallelism
    rows = rows.select("word").repartition(parts).mapInArrow(_packed_words, "words array<string>")
    found = folded(rows).toArrow().combine_chunks()
    discard(counted)
    lists = pa.concat_arrays(found.column("ids").chunks).flatten()
    ends = np.cumsum(pc.list_value_length(lists).to_numpy())
    words = pa.concat_arrays(found.column("words").chunks).flatten().cast(pa.string())
    return words, lists.flatten().to_numpy().astype("<u4"), np.concatenate([[0], ends])


def decode(encoded: DataFrame, rank_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its tokens, concatenated."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = np.array(sorted(load_ranks(rank_path).items(), key=lambda x: x[1]), dtype=object)[:, 0]
        for batch in batches:
            texts = [b"".join(pieces[np.frombuffer(x, "<u4")].tolist()) if x else b""
                     for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())],
                                             names=[*batch.schema.names, out])

    schema = T.StructType([*encoded.schema.fields, T.StructField(out, T.BinaryType())])
    return encoded.mapInArrow(run, schema)
