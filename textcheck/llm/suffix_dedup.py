"""Repeated passages by a sparse suffix array over content-selected positions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textcheck.llm.words import (
    WordHasher, mix, raw_bytes, run_hashes, text_slices, window_positions,
)
from textcheck.session import materialise


def _lowest(keys: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest key, the leftmost of equal ones, of each run of ``width`` keys."""
    def better(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(keys[right] < keys[left], right, left)

    at, step = np.arange(len(keys)), 1
    while step * 2 <= width:
        at = better(at[:-step], at[step:])
        step *= 2
    rest = width - step
    return better(at[:len(at) - rest], at[rest:]) if rest else at


def _region_hashes(words: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of runs of words of any lengths: differences of sums with an odd base, shifted back."""
    base = np.full(len(words) + 1, 0x9E3779B97F4A7C15, np.uint64)
    inverse = np.full(len(words) + 1, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64)
    base[0] = inverse[0] = 1
    power, back = np.cumprod(base), np.cumprod(inverse)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[:-1], out=total[1:])
    return mix((total[stop] - total[start]) * back[start] + (stop - start).astype(np.uint64))


SUFFIX_SCHEMA = "row long, position int, key long, context long, least_back int, most_back int"


def _suffix_rows(shared: int, least: int):
    """mapInArrow function: the retained suffixes of each text.

    The key of a suffix is its first ``shared`` words. Each run of ``least`` words belongs to the
    suffix with the smallest of the keys in it, the leftmost of equal ones: these suffixes are
    retained, each with the runs it holds, which start ``most_back`` to ``least_back`` words
    before it, and the hash ``context`` of all words of these runs.
    """
    window = least - shared + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch, texts in text_slices(batches, "text"):
            hashes, _, _, per_text = hasher.words(texts)
            at, counts = window_positions(per_text, shared)
            starts, _ = window_positions(counts, window)
            if not len(starts):
                continue
            keys = run_hashes(hashes, shared)[at]
            holder = _lowest(keys, window)[starts]
            turns = np.flatnonzero(np.diff(holder))
            heads, tails = np.append(0, turns + 1), np.append(turns, len(holder) - 1)
            chosen = holder[heads]
            most, fewest = chosen - starts[heads], chosen - starts[tails]
            here = at[chosen]
            context = _region_hashes(hashes, here - most, here - fewest + least)
            context = mix(context + mix((most * window + fewest).astype(np.uint64)))
            owner = np.searchsorted(np.cumsum(per_text), here, side="right")
            position = here - (np.cumsum(per_text) - per_text)[owner]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(owner)), pa.array(position.astype(np.int32)),
                 pa.array(keys[chosen].view(np.int64)), pa.array(context.view(np.int64)),
                 pa.array(fewest.astype(np.int32)), pa.array(most.astype(np.int32))],
                ["row", "position", "key", "context", "least_back", "most_back"])

    return run


START_SCHEMA = ("class long, back int, words long, first_place long, first_position int, "
                "last_place long, last_position int, n long")


def _start_rows(least: int):
    """mapInArrow function: each run of ``least`` words of the suffixes in ``wanted``, by the hash
    of its words and its start (``back`` words before the suffix)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch, texts in text_slices(batches, "text"):
            hashes, _, _, per_text = hasher.words(texts)
            wanted = batch.column("wanted")
            suffixes = wanted.flatten()
            field = dict(zip((f.name for f in suffixes.type), suffixes.flatten()))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(wanted.offsets)))
            fewest = field["least_back"].to_numpy().astype(np.int64)
            runs = field["most_back"].to_numpy() - fewest + 1
            suffix = np.repeat(np.arange(len(owner)), runs)
            back = np.arange(len(suffix)) - np.repeat(np.cumsum(runs) - runs, runs) + fewest[suffix]
            firsts = np.cumsum(per_text) - per_text
            start = firsts[owner[suffix]] + field["first_position"].to_numpy()[suffix] - back
            words = mix(run_hashes(hashes, least)[start] + back.astype(np.uint64))
            taken = pa.array(suffix)
            yield pa.RecordBatch.from_arrays(
                [field["class"].take(taken), pa.array(back.astype(np.int32)), pa.array(words.view(np.int64)),
                 *(field[c].take(taken) for c in (
                     "first_place", "first_position", "last_place", "last_position", "n"))],
                ["class", "back", "words", "first_place", "first_position", "last_place", "last_position", "n"])

    return run


def _rows(docs: DataFrame, text: str, doc_id: str, *more: Column) -> DataFrame:
    """Id, text, its hash and a number for each row. Written, as the numbers must not change."""
    return materialise(docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"),
        F.xxhash64(f"`{text}`").alias("digest"), F.monotonically_increasing_id().alias("row"), *more))


def _places(rows: DataFrame) -> DataFrame:
    """(row, doc_id, place): ``place`` numbers the rows by doc_id, text hash and row; null ids first."""
    return materialise(rows.select("row", "doc_id", "digest").repartitionByRange("doc_id", "digest", "row")
                       .sortWithinPartitions("doc_id", "digest", "row")
                       .select("row", "doc_id", F.monotonically_increasing_id().alias("place")))


def _spans(rows: DataFrame, places: DataFrame, least: int) -> DataFrame:
    """(place, first_word, last_word, repeats, other_place): runs of ``least`` or more words that
    occur again, each around one retained suffix.

    The key of a suffix is its first ``least // 2`` words. A run of ``least`` words belongs to one
    suffix, chosen by the words of the run alone, so equal runs have equal keys and starts.
    Suffixes whose keys repeat form classes by all words of their runs, so that copies are one
    class. Classes that meet in a key are extended left to the start of each of their runs; runs
    of the same words are matches. A class that has its key alone matches in itself. Occurrences
    are ordered by doc_id, text hash, row and position.
    """
    suffix_rows = rows.select("row", "text").mapInArrow(_suffix_rows(least // 2, least), SUFFIX_SCHEMA)
    repeated = materialise(suffix_rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    suffixes = materialise(suffix_rows.join(repeated, "key").join(places.select("row", "place"), "row").drop("row"))
    at = F.struct("place", "position")
    classes = materialise(suffixes.groupBy("key", "context", "least_back", "most_back").agg(
        F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("n")).select(
        "key", "context", "least_back", "most_back", "n", F.monotonically_increasing_id().alias("class"),
        F.col("first.place").alias("first_place"), F.col("first.position").alias("first_position"),
        F.col("last.place").alias("last_place"), F.col("last.position").alias("last_position")))
    met = materialise(classes.groupBy("key").agg(F.count("*").alias("classes")).where("classes > 1").select("key"))
    # Classes that meet others: their runs, from one occurrence of each.
    wanted = classes.join(met, "key", "left_semi").join(
        places.select("row", F.col("place").alias("first_place")), "first_place").groupBy("row").agg(
        F.collect_list(F.struct("class", "least_back", "most_back", "first_place", "first_position",
                                "last_place", "last_position", "n")).alias("wanted"))
    held = materialise(rows.select("row", "text").join(wanted, "row").mapInArrow(_start_rows(least), START_SCHEMA))
    again = held.groupBy("words").agg(
        F.min(F.struct("first_place", (F.col("first_position") - F.col("back")).alias("start"))).alias("first"),
        F.max("last_place").alias("last_place"), F.sum("n").alias("n")).where("n > 1").select(
        "words", F.col("first.first_place").alias("first_place"), F.col("first.start").alias("first_start"), "last_place")
    by_start = held.select("class", "back", "words").join(again, "words").groupBy(
        "class", "first_place", (F.col("first_start") + F.col("back")).alias("first_position"), "last_place").agg(
        F.min("back").alias("least_back"), F.max("back").alias("most_back"))
    matched = materialise(by_start.join(classes.select("class", "key", "context"), "class").drop("class"))
    # Within a class that has its key alone, all runs repeat those of its first occurrence.
    alone = classes.where("n > 1").join(met, "key", "left_anti").select(*matched.columns)
    # The runs of a suffix start at most ``least`` words apart, so the first and the last touch.
    repeats = (F.col("place") != F.col("first_place")) | (F.col("position") != F.col("first_position"))
    return suffixes.select("place", "position", "key", "context").join(
        matched.unionByName(alone), ["key", "context"]).select(
        "place", (F.col("position") - F.col("most_back")).alias("first_word"),
        (F.col("position") - F.col("least_back") + least).alias("last_word"), repeats.alias("repeats"),
        F.when(repeats, F.col("first_place")).otherwise(F.col("last_place")).alias("other_place"))


def _islands(spans: DataFrame) -> DataFrame:
    """Spans of a text that overlap or touch, put together."""
    order = Window.partitionBy("place").orderBy("first_word", "last_word")
    reached = F.max("last_word").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("first_word") > reached).cast("int"), F.lit(1))
    return (spans.withColumn("opens", opens).withColumn("island", F.sum("opens").over(order))
            .groupBy("place", "island")
            .agg(F.min("first_word").cast("long").alias("first_word"),
                 F.max("last_word").cast("long").alias("last_word"),
                 F.max("repeats").alias("duplicate"), F.min("other_place").alias("other_place")))


def repeated_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                      least_words: int = 50) -> DataFrame:
    """One row per passage of ``least_words`` or more words that occurs elsewhere, too.

    Columns: doc_id, first_word (from 0), n_words, duplicate (it repeats, at least in part, an
    occurrence that comes earlier by doc_id and position), other_doc_id (the document of the
    earliest occurrence of any part of it or, for the earliest itself, of the last one). Words are
    runs without white space, told apart by 64-bit hashes; a document can also repeat itself.
    Null, empty and short texts have no passages. Each row counts, also one equal to another: the
    later repeats the earlier. Null ids come first. ``docs`` may hold any other columns.

    Every run of ``least_words`` that occurs twice is found, however the table is dealt out; runs
    of a text that overlap or touch are joined (see ``_spans``).
    """
    rows = _rows(docs, text, doc_id)
    places = _places(rows)
    found = _islands(_spans(rows, places, least_words))
    others = places.select(F.col("place").alias("other_place"), F.col("doc_id").alias("other_doc_id"))
    return found.join(places.select("place", "doc_id"), "place").join(others, "other_place").select(
        "doc_id", "first_word", (F.col("last_word") - F.col("first_word")).alias("n_words"),
        "duplicate", "other_doc_id")


def drop_repeated_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                           least_words: int = 50, length: str | None = None) -> DataFrame:
    """``docs`` without the passages that repeat an earlier one; the earliest stays.

    Only texts with such a passage change, and ``length``, if named, is set to their new number
    of characters. A text with nothing but repeats goes with its row. Every cut word remains in
    an occurrence that comes earlier by doc_id and position.
    """
    kept = [f for f in docs.schema.fields]
    rows = _rows(docs, text, doc_id, F.struct(F.lit(0).alias(text), *[
        F.col(f"`{f.name}`").alias(f.name) for f in kept if f.name != text]).alias("source"))
    places = _places(rows)
    spans = _spans(rows, places, least_words).where("repeats")
    cuts = materialise(_islands(spans).join(places.select("row", "place"), "place").groupBy("row").agg(F.sort_array(F.collect_list(
        F.struct("first_word", "last_word"))).alias("cuts")))
    packed = rows.select("source", "text", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch, texts in text_slices(batches, "text"):
            _, starts, stops, per_text = hasher.words(texts)
            _, offsets = raw_bytes(texts)
            firsts = np.cumsum(per_text) - per_text
            bodies, left = [], []
            for i, spans in enumerate(batch.column("cuts").to_pylist()):
                if spans is None:
                    bodies.append(batch.column("text")[i].as_py())
                    left.append(True)
                    continue
                body, parts, at = texts[i].as_py().encode(), [], 0
                for span in spans:
                    parts.append(body[at:starts[firsts[i] + span["first_word"]] - offsets[i]])
                    at = int(stops[firsts[i] + span["last_word"] - 1] - offsets[i])
                rest = b"".join([*parts, body[at:]]).decode()
                bodies.append(rest)
                left.append(bool(rest.strip(" \t\n\v\f\r")))
            out = pa.RecordBatch.from_arrays(
                [batch.column("source"), pa.array(bodies, pa.string()),
                 pa.array([x is not None for x in batch.column("cuts").to_pylist()])],
                ["source", "text", "changed"])
            yield out.filter(pa.array(left))

    schema = T.StructType([T.StructField("source", packed.schema["source"].dataType),
                           T.StructField("text", T.StringType()), T.StructField("changed", T.BooleanType())])
    cut = packed.join(cuts, "row", "left").select("source", "text", "cuts").mapInArrow(run, schema)
    columns = []
    for f in kept:
        value = F.col("source").getField(f.name)
        if f.name == text:
            value = F.col("text")
        elif f.name == length:
            value = F.when(F.col("changed"), F.char_length("text").cast(f.dataType)).otherwise(value)
        columns.append(value.alias(f.name))
    return cut.select(*columns)
