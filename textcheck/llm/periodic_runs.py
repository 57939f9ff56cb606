"""Periodic stretches of words: repetitions that a text makes of itself, one copy after the other."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textcheck.llm.words import WordHasher, mix, run_hashes, text_slices, window_positions

#: A run has at least so many words, and at least so many periods.
MIN_LENGTH, MIN_EXPONENT = 24, 3

RUNS = "array<struct<start:long,length:long,period:long>>"


class _SuffixOrder:
    """The suffixes of one text in order, and the number of words that neighbours share.

    Ranks of the runs of 1, 2, 4, 8 ... words from each position come from pairs of ranks, until
    all are distinct; a run that the end of the text cuts short goes before the longer ones.
    """

    def __init__(self, words: np.ndarray):
        size, width = len(words), 1
        self.ranks = [np.unique(words, return_inverse=True)[1].astype(np.int64)]
        while self.ranks[-1].max() + 1 < size:
            after = np.full(size, -1, np.int64)
            after[:max(size - width, 0)] = self.ranks[-1][width:]
            pair = self.ranks[-1] * (size + 1) + after + 1
            self.ranks.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))
            width *= 2
        self.order = np.argsort(self.ranks[-1])

    def shared(self) -> np.ndarray:
        """Words that each suffix of the order shares with the next one."""
        size = len(self.order)
        one, two = self.order[:-1].copy(), self.order[1:].copy()
        for level in range(len(self.ranks) - 1, -1, -1):
            # Runs of full length only: those cut short by the end are counted by narrower ones.
            whole = np.maximum(one, two) + (1 << level) <= size
            ranks = self.ranks[level]
            step = (whole & (ranks[np.minimum(one, size - 1)] == ranks[np.minimum(two, size - 1)])) << level
            one += step
            two += step
        return one - self.order[:-1]


def _text_runs(words: np.ndarray, least: int, min_length: int,
               min_exponent: int) -> list[tuple[int, int, int]]:
    """All runs of one text as (start, length, period), by start, then period.

    Only suffixes that share at least ``least`` words can begin one. Classes of suffixes are united by decreasing number of shared words l (union-find; each class
    has its positions in order, the smaller class goes into the larger). Two positions that become
    neighbours at distance d <= l begin a stretch of d + l words with period d. It ends where the
    period ends, as l is all that the two share. It is a run if the word before breaks the period;
    a smaller period p would have put the position p after the first one between the two before.
    """
    suffixes = _SuffixOrder(words)
    shared = suffixes.shared()
    close = np.flatnonzero(shared >= least)
    numbers = np.unique(np.concatenate([close, close + 1]))
    members = {i: [p] for i, p in zip(numbers.tolist(), suffixes.order[numbers].tolist())}
    parent = {i: i for i in members}
    pairs: list[tuple[int, int, int]] = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    falling = close[np.argsort(-shared[close], kind="stable")]
    for edge, l in zip(falling.tolist(), shared[falling].tolist()):
        big, small = root(edge), root(edge + 1)
        if len(members[big]) < len(members[small]):
            big, small = small, big
        into, moved = members[big], members[small]
        farthest = l // (min_exponent - 1)
        before = -1
        for k, p in enumerate(moved):
            place = bisect_left(into, p)
            if place:
                left = into[place - 1]
                if left > before and p - left <= farthest and p - left + l >= min_length:
                    pairs.append((left, p - left + l, p - left))
            if place < len(into):
                right = into[place]
                if (k + 1 == len(moved) or moved[k + 1] > right) and (
                        right - p <= farthest and right - p + l >= min_length):
                    pairs.append((p, right - p + l, right - p))
            before = p
        for p in moved:
            insort(into, p)
        parent[small] = big
        del members[small]
    return sorted(((s, n, q) for s, n, q in pairs if s == 0 or words[s - 1] != words[s + q - 1]),
                  key=lambda run: (run[0], run[2]))


def _dropped(n_words: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stand in a run after its first period."""
    change = np.zeros(n_words + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) > 0


def _run_rows(schema: pa.Schema, min_length: int, min_exponent: int):
    """mapInArrow function: runs and the collapsed text of each row."""
    # A run of length n and period p shares n - p words with itself, at least this many.
    least = -(-min_length * (min_exponent - 1) // min_exponent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch, texts in text_slices(batches, "text"):
            hashes, _, _, per_text = hasher.words(texts)
            first = np.cumsum(per_text) - per_text
            found: dict[int, list[tuple[int, int, int]]] = {}
            starts, counts = window_positions(per_text, least)
            if len(starts):
                text_of = np.repeat(np.arange(len(per_text)), counts)
                keys = mix(run_hashes(hashes, least)[starts]
                           + mix(text_of.astype(np.uint64) + np.uint64(1)))
                order = np.argsort(keys, kind="stable")
                same = keys[order[1:]] == keys[order[:-1]]
                again = np.zeros(len(keys), bool)
                again[order[1:]] = same
                again[order[:-1]] |= same
                for number in np.unique(text_of[again]).tolist():
                    words = hashes[first[number]:first[number] + per_text[number]]
                    if runs := _text_runs(words, least, min_length, min_exponent):
                        found[number] = runs
            collapsed = []
            for number, text in enumerate(texts.to_pylist()):
                words = text.encode().split()
                if number in found:
                    words = compress(words, (~_dropped(len(words), found[number])).tolist())
                collapsed.append(b" ".join(words).decode())
            runs = [[dict(zip(("start", "length", "period"), r)) for r in found.get(i, ())]
                    for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(per_text, pa.int64()),
                 pa.array(runs, schema.field("runs").type),
                 pa.array(collapsed, schema.field("collapsed").type)],
                ["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): one row per row of ``docs``, without a shuffle.

    Words are runs of characters other than space and the controls 9 to 13. A run is a stretch of
    words with smallest period q (words q apart are equal) and at least ``min_length`` words and
    ``min_exponent`` >= 2 periods, which neither neighbour prolongs; ``runs`` has (start, length,
    period) by start, then period, starts counted from 0. ``collapsed`` has the words that no run
    holds after its first period, joined by one space. Null, empty and blank texts have no words,
    no runs and an empty ``collapsed``; equal rows, and null or repeated ids, are handled row by
    row; other columns of ``docs`` are not read. Words count as equal if their 64-bit hashes are.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T._parse_datatype_string(RUNS)),
                           T.StructField("collapsed", T.StringType())])
    return rows.mapInArrow(_run_rows(to_arrow_schema(schema), min_length, min_exponent), schema)


def strongest_run(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties: smallest start, then period."""
    def first(a: Column, b: Column) -> Column:
        ahead = b["length"] * a["period"] - a["length"] * b["period"]
        apart = F.when(ahead != 0, ahead).when(
            a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["period"] - b["period"])
        return F.signum(apart).cast("int")

    return F.try_element_at(F.array_sort(runs, first), F.lit(1))


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): texts of which every tenth, by the CRC-32 h of the decimal doc_id, gets a
    periodic end: with g = h div 10 and n words, each word i >= a = g mod n becomes word
    a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). Null ids have no h: unchanged."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    g, n = F.expr("h div 10"), F.size("words")
    start = F.expr("CAST((h div 10) % size(words) AS INT)")
    period = F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + g % 8)).cast("int")
    planted = docs.select("doc_id", "text", crc.alias("h")).withColumn(
        "words", F.when((F.col("h") % 10 == 0) & F.col("text").isNotNull(), words)).withColumn(
        "a", F.when(n > 0, start)).withColumn("p", period)
    tail = F.transform(F.sequence(F.lit(0), n - F.col("a") - 1),
                       lambda i: F.element_at("words", F.col("a") + i % F.col("p") + 1))
    whole = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return planted.select("doc_id", F.coalesce(F.when(F.col("a").isNotNull(), whole), "text").alias("text"))
