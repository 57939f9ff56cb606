"""Near-duplicate documents by a multi-index Hamming join of MinHash signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textcheck.llm.components import components
from textcheck.llm.marks import sieved, with_numbers
from textcheck.llm.words import WordHasher, gram_hashes, mix, text_slices, window_positions
from textcheck.session import materialise

#: Signature: CHUNKS chunks of WIDTH symbols of 16 bits. A pair whose signatures differ in
#: fewer than 2 * CHUNKS symbols has a chunk with at most one error (pigeonhole), so that the
#: keys "chunk without one symbol" of both meet. At a similarity of 0.75 the distance has mean
#: 16 and deviation 3.5, so that 31 is passed by one pair in 100,000.
CHUNKS, WIDTH = 16, 4
MAX_DISTANCE = 2 * CHUNKS - 1
#: Rows of a block in the last comparison, where every row meets blocks, not all others.
BLOCK = 2_048


def _shingle_sets(words: int, lower_ascii: bool):
    """A function from an Arrow text array to (sorted distinct shingle hashes, set sizes)."""
    hasher = WordHasher(lower_ascii)

    def sets(texts: pa.Array) -> list[np.ndarray]:
        hashes, _, _, per_text = hasher.words(texts)
        starts, counts = window_positions(per_text, words)
        grams = gram_hashes(hashes, words)[starts] if len(starts) else np.zeros(0, np.uint64)
        gram_ends, word_ends = np.cumsum(counts), np.cumsum(per_text)
        found = []
        for i, count in enumerate(counts):
            if count:
                found.append(np.unique(grams[gram_ends[i] - count:gram_ends[i]]))
            else:
                # Fewer words than a shingle: the whole sequence is one; no words, none.
                few = hashes[word_ends[i] - per_text[i]:word_ends[i]]
                found.append(gram_hashes(few, len(few)) if len(few) else few)
        return found

    return sets


def _signature_rows(words: int, lower_ascii: bool):
    """mapInArrow function: size, digest and signature of each document's shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _shingle_sets(words, lower_ascii)
        rng = np.random.default_rng(91)
        factors = rng.integers(0, 1 << 63, size=(CHUNKS * WIDTH, 1), dtype=np.uint64) | np.uint64(1)
        for batch, texts in text_slices(batches, "text"):
            found = sets(texts)
            sizes = np.array([len(x) for x in found], dtype=np.int64)
            digest = np.zeros((len(found), 2), np.uint64)
            signature = np.zeros((len(found), CHUNKS * WIDTH), np.uint16)
            for i, members in enumerate(found):
                if not len(members):
                    continue
                spread = mix(members)
                digest[i] = spread.sum(), mix(members ^ np.uint64(0x5851F42D4C957F2D)).sum()
                # The smallest product's high bits are almost equal everywhere; mix, keep 16 bits.
                lowest = np.concatenate([(spread * factors[k:k + 8]).min(axis=1)
                                         for k in range(0, len(factors), 8)])
                signature[i] = mix(lowest).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(digest[:, 0].view(np.int64)),
                 pa.array(digest[:, 1].view(np.int64)),
                 pa.array([row.tobytes() for row in signature], pa.binary())],
                ["doc_id", "n_shingles", "d1", "d2", "signature"])

    return run


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each signature its CHUNKS * WIDTH keys: a chunk with one symbol left out."""
    for batch in batches:
        if not batch.num_rows:
            continue
        symbols = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16)
        symbols = symbols.reshape(batch.num_rows, CHUNKS, WIDTH).astype(np.uint64)
        keys = np.empty((batch.num_rows, CHUNKS, WIDTH), np.uint64)
        place = np.arange(CHUNKS, dtype=np.uint64)
        for left_out in range(WIDTH):
            key = place * np.uint64(WIDTH) + np.uint64(left_out)
            for j in range(WIDTH):
                if j != left_out:
                    key = (key << np.uint64(16)) | symbols[:, :, j]
            keys[:, :, left_out] = key
        nodes = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), CHUNKS * WIDTH)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.reshape(-1).view(np.int64)), pa.array(nodes)], ["key", "node"])


def _set_rows(words: int, lower_ascii: bool):
    """mapInArrow function: the full shingle set of each document, by its first digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _shingle_sets(words, lower_ascii)
        for batch, texts in text_slices(batches, "text"):
            found = [x.view(np.int64) for x in sets(texts)]
            node = [mix(x.view(np.uint64)).sum() if len(x) else np.uint64(0) for x in found]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(node, np.uint64).view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["node", "members"])

    return run


def _near_signatures(table: pa.Table, numerator: int, denominator: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per row of two blocks the rows of larger label that its signature and size do not rule out."""
    labels, blocks, sizes = (table.column(c).to_numpy() for c in ("label", "block", "n_shingles"))
    signatures = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16)
    signatures = signatures.reshape(table.num_rows, CHUNKS * WIDTH)
    two = blocks.min() != blocks.max()
    for i in range(table.num_rows):
        near = (labels > labels[i]) & (denominator * np.minimum(sizes, sizes[i])
                                       >= numerator * np.maximum(sizes, sizes[i]))
        if two:
            near &= blocks != blocks[i]
        others = np.flatnonzero(near)
        if len(others):
            distance = (signatures[others] != signatures[i]).sum(axis=1)
            others = others[distance <= MAX_DISTANCE]
            if len(others):
                yield i, others


def _block_candidates(numerator: int, denominator: int):
    """applyInArrow function: the rows of two blocks that have a partner by their signatures."""

    def run(table: pa.Table) -> pa.Table:
        found = [np.append(others, i) for i, others in _near_signatures(table, numerator, denominator)]
        at = pa.array(np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64))
        return pa.table({"job": table.column("job").take(at), "node": table.column("node").take(at)})

    return run


def _block_links(numerator: int, denominator: int):
    """applyInArrow function: links between the rows of two blocks that carry other labels."""

    def run(table: pa.Table) -> pa.Table:
        labels = table.column("label").to_numpy()
        members = [np.asarray(x.values) for x in table.column("members")]
        found: set[tuple[int, int]] = set()
        for i, others in _near_signatures(table, numerator, denominator):
            for j in others:
                same = len(np.intersect1d(members[i], members[j], assume_unique=True))
                if denominator * same >= numerator * (len(members[i]) + len(members[j]) - same):
                    found.add((labels[i], labels[j]))
        return pa.table({"a": pa.array([x for x, _ in sorted(found)], pa.int64()),
                         "b": pa.array([x for _, x in sorted(found)], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 5,
                    numerator: int = 75, denominator: int = 100,
                    lower_ascii: bool = True) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when ``denominator * intersection >= numerator * union`` of their sets
    of distinct ``words``-word shingles (fewer words: the whole sequence is one shingle).

    1. Documents with equal sets form a class, the node of all later steps.
    2. Classes meet by the keys of their signatures: every pair within MAX_DISTANCE shares one.
       In each key, all are compared with the first node; the verified links give first labels.
    3. Keys that still hold several labels are settled exactly: their classes are dealt into
       blocks by hash, each class goes to the pairs of blocks in which it has a partner with
       another label, and each pair of blocks compares signatures, then the full sets of those
       that are near. Only links
       between labels are put out, so that no group of copies is expanded into its pairs.

    Null, empty or blank texts have no shingles: they link with nothing and are kept. Rows that
    repeat a doc_id count by their texts; a null doc_id is the smallest of a component only where
    all its rows lack one, and such rows are kept. ``docs`` may hold any other columns.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = materialise(rows.mapInArrow(
        _signature_rows(words, lower_ascii),
        "doc_id long, n_shingles long, d1 long, d2 long, signature binary"))
    classes = materialise(
        signed.where("n_shingles > 0").groupBy("d1", "d2", "n_shingles")
        .agg(F.min("doc_id").alias("first_id"), F.first("signature").alias("signature"))
        .withColumn("node", F.col("d1")))
    keys = classes.select("node", "signature").mapInArrow(_key_rows, "key long, node long")
    shared = materialise(keys.groupBy("key").agg(
        F.min("node").alias("low"), F.max("node").alias("high")).where("low < high"))
    met = materialise(keys.join(shared.select("key", "low"), "key"))

    # The sets of all classes that met another one, computed once from their texts.
    meeting = materialise(met.select("node").distinct().join(classes, "node")
                          .select(F.col("first_id").alias("id")).distinct())
    sets = materialise(
        sieved(rows, meeting, "doc_id").join(meeting, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
        .mapInArrow(_set_rows(words, lower_ascii), "node long, members array<long>"))

    pairs = met.where("node <> low").select("low", "node").distinct()
    wide = (pairs.join(sets, "node")
            .join(sets.select(F.col("node").alias("low"), F.col("members").alias("low_members")), "low"))
    same = F.size(F.array_intersect("members", "low_members"))
    union = F.size("members") + F.size("low_members") - same
    first = components(wide.where(denominator * same >= numerator * union).select("low", "node"),
                       "low", "node")
    first = materialise(first)

    linked = _cross_links(met, first, classes, sets, numerator, denominator)
    second = materialise(components(linked, "a", "b"))
    label = (first.join(second.select(F.col("node").alias("component"), F.col("component").alias("top")),
                        "component", "left")
             .select("node", F.coalesce("top", "component").alias("label"))
             .union(second.join(first.select("node"), "node", "left_anti").select("node", "component")))
    labelled = materialise(classes.drop("signature").join(materialise(label), "node", "left")
                           .withColumn("label", F.coalesce("label", "node")))
    smallest = materialise(labelled.groupBy("label").agg(F.min("first_id").alias("component_id")))
    by_class = labelled.join(smallest, "label").select("d1", "d2", "n_shingles", "component_id")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return (signed.select("doc_id", "n_shingles", "d1", "d2")
            .join(materialise(by_class), ["d1", "d2", "n_shingles"], "left")
            .select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _cross_links(met: DataFrame, first: DataFrame, classes: DataFrame, sets: DataFrame,
                 numerator: int, denominator: int) -> DataFrame:
    """Links (a, b) between labels, from the keys whose classes carry several labels."""
    labelled = materialise(met.join(first, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("label")))
    open_keys = labelled.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    mixed = materialise(labelled.join(materialise(open_keys), "key", "left_semi"))
    n_blocks = 1 + mixed.select("node").distinct().count() // BLOCK
    block = F.pmod(F.xxhash64("node"), F.lit(n_blocks)).cast("int")
    mixed = mixed.withColumn("block", block)
    # Per key the blocks in it with their range of labels: at most n_blocks entries.
    present = materialise(
        mixed.groupBy("key", "block").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .groupBy("key").agg(F.collect_list(F.struct("block", "low", "high")).alias("present")))
    wanted = F.filter("present", lambda x: (x["low"] != F.col("label")) | (x["high"] != F.col("label")))
    needs = (mixed.join(present, "key")
             .select("node", "label", "block", F.transform(wanted, lambda x: x["block"]).alias("partners"))
             .groupBy("node", "label", "block")
             .agg(F.array_distinct(F.flatten(F.collect_set("partners"))).alias("partners")))
    jobs = (needs.withColumn("partner", F.explode("partners"))
            .select("node", "label", "block",
                    (F.least("block", "partner").cast("long") * n_blocks
                     + F.greatest("block", "partner")).alias("job")))
    signed = materialise(jobs.join(classes.select("node", "n_shingles", "signature"), "node"))
    # Signatures first: the full sets, many times larger, go only where a partner is possible.
    possible = materialise(signed.groupBy("job").applyInArrow(
        _block_candidates(numerator, denominator), "job long, node long"))
    full = signed.join(possible, ["job", "node"]).join(sets, "node")
    return materialise(full.groupBy("job").applyInArrow(
        _block_links(numerator, denominator), "a long, b long").distinct())


def without_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the smallest id.

    Rows are told apart by a number of their own, so rows that share an id, or have none, are
    judged each by its text; of rows with the same text and id one stays. Null ids go first.
    """
    others = [F.col(f"`{c}`").alias(c) for c in docs.columns if c != text]
    rows = materialise(docs.select(
        F.struct(F.lit(0).alias(text), *others).alias("source"), F.col(f"`{text}`").alias("text"),
        F.col(f"`{doc_id}`").alias("id"), F.monotonically_increasing_id().alias("row")))
    found = materialise(near_duplicates(rows, "text", "row", **how).select(F.col("doc_id").alias("row"), "component_id"))
    first = found.join(rows.select("row", "id"), "row").groupBy("component_id").agg(
        F.min(F.struct("id", "row")).alias("first")).select(F.col("first.row").alias("row"))
    return with_numbers(rows, first, "row").select(
        *[(F.col("text") if c == text else F.col("source").getField(c)).alias(c) for c in docs.columns])
