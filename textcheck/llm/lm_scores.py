"""Stupid-backoff scores: n-gram counts partitioned by hash, joined to the n-grams of documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textcheck.llm.words import WordHasher, gram_hashes, mix, text_slices, window_positions

#: Text bytes of a block of documents, whose distinct n-grams are looked up together; and text
#: bytes for each hash partition of the count table.
BLOCK_BYTES, PART_BYTES = 12 << 20, 4 << 20
#: Key under which the number of all words is counted.
ALL_WORDS = np.uint64(0)


def _planes(values: np.ndarray) -> bytes:
    """Bytes of 64-bit numbers, most significant ones first, so that equal ones lie together."""
    return values.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(8, -1).T.copy().view(">u8").ravel().astype(np.uint64)


class _Grams:
    """Words and word pairs of the texts of a block."""

    def __init__(self, texts: pa.ChunkedArray):
        hasher = WordHasher(lower_ascii=True)
        batches = pa.table({"text": texts}).to_batches()
        found = [hasher.words(column) for _, column in text_slices(iter(batches), "text")]
        words = np.concatenate([x[0] for x in found]) if found else np.zeros(0, np.uint64)
        self.per_text = np.concatenate([x[3] for x in found]) if found else np.zeros(0, np.int64)
        self.owner = np.repeat(np.arange(len(self.per_text), dtype=np.int64), self.per_text)
        self.at, _ = window_positions(self.per_text, 2)
        self.words = mix(words) | np.uint64(1)
        pairs = gram_hashes(words, 2)
        self.pairs = pairs[self.at] if len(self.at) else np.zeros(0, np.uint64)
        self.keys, which, self.counts = np.unique(
            np.concatenate([[ALL_WORDS], self.words, self.pairs]), return_inverse=True, return_counts=True)
        self.counts = self.counts.astype(np.int64)
        self.counts[0] = len(words)
        self.word_no, self.pair_no = which[1:1 + len(words)], which[1 + len(words):]

    def parts(self, n_parts: int) -> np.ndarray:
        """Hash partition of each key, ascending as the keys are."""
        return (((self.keys >> np.uint64(32)) * np.uint64(n_parts)) >> np.uint64(32)).astype(np.int64)


def _requests(n_parts: int):
    """applyInArrow function over blocks: their distinct n-grams and counts, one row per partition."""

    def run(table: pa.Table) -> pa.Table:
        grams = _Grams(table.column("text"))
        parts = grams.parts(n_parts)
        edges = np.flatnonzero(np.diff(parts, prepend=-1))
        ends = np.append(edges[1:], len(parts))
        return pa.table({
            "part": pa.array(parts[edges]),
            "block": pa.array(np.full(len(edges), table.column("block")[0].as_py(), np.int64)),
            "keys": pa.array([_planes(grams.keys[a:b]) for a, b in zip(edges, ends)], pa.binary()),
            "counts": pa.array([_planes(grams.counts[a:b]) for a, b in zip(edges, ends)], pa.binary())})

    return run


def _answers(table: pa.Table) -> pa.Table:
    """applyInArrow function over hash partitions: the count table, looked up for every block."""
    keys = [_numbers(x) for x in table.column("keys").to_pylist()]
    counts = np.concatenate([_numbers(x) for x in table.column("counts").to_pylist()])
    _, which = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(which, weights=counts.astype(np.float64)).astype(np.uint64)[which]
    ends = np.cumsum([len(x) for x in keys])
    return pa.table({
        "block": table.column("block"), "part": table.column("part"),
        "totals": pa.array([_planes(totals[b - len(x):b]) for b, x in zip(ends, keys)], pa.binary())})


def _scores(alpha: float):
    """Cogrouped function: scores of a block's documents, from the corpus counts of its n-grams."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()),
                             "n_backed_off": pa.array([], pa.int64()), "log_score": pa.array([], pa.float64())})
        grams = _Grams(docs.column("text"))
        order = np.argsort(answers.column("part").to_numpy())
        planes = answers.column("totals").to_pylist()
        totals = np.concatenate([_numbers(planes[i]) for i in order]).astype(np.int64)
        n_docs = len(grams.per_text)
        # Own counts are taken off, so that a document is no evidence for itself.
        word_keys, word_counts = np.unique((grams.owner << 32) | grams.word_no, return_counts=True)

        def others(owner: np.ndarray, number: np.ndarray) -> np.ndarray:
            own = word_counts[np.searchsorted(word_keys, (owner << 32) | number)]
            return totals[number] - own

        rest = totals[0] - grams.per_text
        with np.errstate(divide="ignore", invalid="ignore"):
            def unigram(owner: np.ndarray, number: np.ndarray) -> np.ndarray:
                seen = others(owner, number)
                return np.where(seen > 0, np.log(seen / np.maximum(rest[owner], 1)),
                                np.log(alpha / (rest[owner] + 1.0)))

            firsts = (np.cumsum(grams.per_text) - grams.per_text)[grams.per_text > 0]
            first_owner = grams.owner[firsts]
            score = np.bincount(first_owner, weights=unigram(first_owner, grams.word_no[firsts]),
                                minlength=n_docs)
            pair_owner = grams.owner[grams.at] if len(grams.at) else np.zeros(0, np.int64)
            pairs, place, n = np.unique((pair_owner << 32) | grams.pair_no, return_index=True,
                                        return_counts=True)
            owner = pairs >> 32
            seen = totals[pairs & 0xFFFFFFFF] - n
            before = others(owner, grams.word_no[grams.at[place]]) if len(place) else seen
            after = grams.word_no[grams.at[place] + 1] if len(place) else seen
            value = np.where(seen > 0, np.log(seen / np.maximum(before, 1)),
                             np.log(alpha) + unigram(owner, after))
            score += np.bincount(owner, weights=n * value, minlength=n_docs)
            backed = np.bincount(owner, weights=n * (seen <= 0), minlength=n_docs)
        return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array(grams.per_text),
                         "n_backed_off": pa.array(backed.astype(np.int64)), "log_score": pa.array(score)})

    return run


def backoff_scores(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                   alpha: float = 0.4) -> DataFrame:
    """One row per document: doc_id, n_words, n_backed_off, log_score, mean_log_score.

    A bigram model with stupid backoff over lower-cased (A-Z) words, counted over all documents;
    a document's own counts are taken off before it is scored. A word scores
    count(previous, word) / count(previous), or alpha * count(word) / words where the pair is
    unknown, or alpha / (words + 1) for an unknown word; the first word has no previous one.
    log_score adds the natural logarithms; n_backed_off counts the unknown pairs.

    Documents are dealt into blocks by hash. A block sends its distinct n-grams once to the hash
    partitions of the count table and gets their counts back, so that a frequent n-gram crosses
    the network once per block, not once per occurrence. Null and blank texts have no words,
    log_score 0 and a null mean; rows that repeat count and score each on its own; ``docs``
    may hold any other columns.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks, n_parts = 1 + size // BLOCK_BYTES, 1 + size // PART_BYTES
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks))
    blocks = rows.withColumn("block", block.cast("long"))
    answers = (blocks.groupBy("block").applyInArrow(
        _requests(n_parts), "part long, block long, keys binary, counts binary")
        .groupBy("part").applyInArrow(_answers, "block long, part long, totals binary"))
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _scores(alpha), "doc_id long, n_words long, n_backed_off long, log_score double")
    return scored.withColumn("mean_log_score", F.try_divide("log_score", "n_words"))
