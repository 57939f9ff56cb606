"""Pairs of TF-IDF vectors with a cosine at or above a threshold, exactly, reduced where they meet.

Vectors are unit length, their terms in one order from common to rare. Two vectors can only reach
the threshold if the part up to their rarest shared term is long enough in both: the product of
the two lengths is at least the threshold. So only the rare end of a vector is indexed (prefix
filter for cosine joins, WWW 2007). Vectors are dealt into blocks, and a pair is looked at in one
place, the tile of its two blocks: the products of the shared indexed terms are added up, the rest
is bounded by the lengths of the common ends, the whole by sketches (the lengths of the parts in
SKETCH buckets of terms), and only vectors with a partner that can still reach the threshold are
sent whole, verified and reduced there. Pairs are not shuffled. In a tile the texts of one block are
held, and those of the other pass by in batches. Blocks are held in rounds, and what a round has
shuffled goes with it, so disk grows in proportion to the texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from functools import reduce as fold
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textcheck.functions.runs import as_lists, list_parts, pieces, sorted_runs
from textcheck.session import discard, materialise

# Rounding slack of the bounds; the final test uses the plain threshold.
SLACK = 1e-9
# Indexed terms of a block, and terms of its texts that have a partner, which bound a worker's memory; smaller
# inputs are cut into SPREAD blocks.
BLOCK, BLOCK_TERMS, WHOLE_TERMS, LEAST_TERMS, SPREAD = 256, 1 << 22, 1 << 23, 1 << 15, 8
# Rows of whole vectors that travel to a worker at once, and terms of them that are handled at once.
BATCH_ROWS, ROW_TERMS = 1_024, 1 << 19
# Terms of a row that travels, so that a batch of rows is small; products and pairs handled at once.
PIECE, PRODUCTS, PAIRS = 128, 1 << 21, 1 << 19
# Terms in the tails of a batch of postings; a long text has thousands of postings.
TAIL_TERMS = 1 << 20
# Cells of a table of products for each product, up to which a table is faster than a sort.
DENSE = 2
# Steps of a product that is sorted with its pair of texts, rounded up.
STEPS = 20
# Commonest terms that every worker knows; those of the others alone are shuffled.
COMMON = 1 << 20
# Texts up to which every worker knows the first ones of all groups, and parts in which texts meet their rare terms.
HELD_GROUPS, RARE_PARTS = 1 << 21, 4
# Buckets of a sketch, its rounding slack, and pairs of sketches compared at once.
SKETCH, SKETCH_SLACK, SKETCHES = 256, 1e-4, 4_096


def _counts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, tf) of the bags of term numbers of a batch: ``terms``, cut into bags of ``bags`` terms."""
    flat, _ = list_parts(batch.column("terms"))
    sizes, bounds = list_parts(batch.column("bags"))
    bag = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((flat, bag))
    flat, bag = flat[order], bag[order]
    new = np.ones(len(flat), bool)
    new[1:] = (flat[1:] != flat[:-1]) | (bag[1:] != bag[:-1])
    first = np.flatnonzero(new)
    row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))[bag[first]]
    return row, flat[first], np.diff(np.append(first, len(flat))).astype(np.int32)


def _bag_rows(reps: np.ndarray, copies: np.ndarray):
    """mapInArrow function: (rep, copies, terms, bags) of the rows (id, terms) that are the first of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").cast(pa.int64())
            at, known = _places(ids.fill_null(0).to_numpy(), reps)
            kept = np.flatnonzero(known & ids.is_valid().to_numpy(zero_copy_only=False))
            terms = batch.column("terms").take(pa.array(kept))
            sizes = np.diff(list_parts(terms)[1]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(reps[at[kept]]), pa.array(copies[at[kept]]), terms, as_lists(sizes, np.ones(len(kept), int))],
                ["rep", "copies", "terms", "bags"])

    return run


def _frequency_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, doc_freq, n_groups) from (copies, terms, bags): sums over the rows handled at once."""
    for batch in pieces(batches, "terms", ROW_TERMS):
        row, term, _ = _counts(batch)
        order = np.argsort(term, kind="stable")
        term, copies = term[order], batch.column("copies").to_numpy()[row[order]]
        first = np.flatnonzero(np.append(True, term[1:] != term[:-1])[:len(term)])
        if len(first):
            yield pa.RecordBatch.from_arrays(
                [pa.array(term[first]), pa.array(np.add.reduceat(copies, first)),
                 pa.array(np.diff(np.append(first, len(term))))], ["term", "doc_freq", "n_groups"])


def _places(term: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each term is in the sorted ``known``, and whether it is there."""
    if not len(known):
        return np.zeros(len(term), np.int64), np.zeros(len(term), bool)
    at = np.minimum(np.searchsorted(known, term), len(known) - 1)
    return at, known[at] == term


def _rare_rows(common: np.ndarray):
    """mapInArrow function: (rep, term, tf) of the terms that are not ``common``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "terms", ROW_TERMS):
            row, term, tf = _counts(batch)
            rare = np.flatnonzero(~_places(term, common)[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep").take(pa.array(row[rare])), pa.array(term[rare]), pa.array(tf[rare])],
                ["rep", "term", "tf"])

    return run


def _weights(tf: np.ndarray, seen: np.ndarray, bounds: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the terms of unit vectors, and the length of each vector up to each term."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    weight = tf * (np.log((1.0 + n_docs) / (1.0 + seen)) + 1.0)
    x = weight / np.sqrt(np.add.reduceat(weight * weight, bounds[:-1]))[owner]
    upto = np.cumsum(x * x)
    before = np.concatenate([[0.0], upto])[bounds[:-1]]
    return x, np.sqrt(np.maximum(upto - before[owner], 0.0))


def _vector_rows(common: np.ndarray, frequency: np.ndarray, n_docs: int, threshold: float):
    """mapInArrow function: the terms of each row from common to rare, with their numbers in it and in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "terms", ROW_TERMS):
            row, term, tf = _counts(batch)
            at, known = _places(term, common)
            row, term, tf, seen = row[known], term[known], tf[known], frequency[at[known]] if len(common) else at[known]
            if "rare" in batch.schema.names:
                column = batch.column("rare")
                rare = column.flatten()
                parts = [rare.field(f).to_numpy(zero_copy_only=False) for f in ("term", "tf", "doc_freq")]
                row = np.concatenate([row, np.repeat(np.arange(batch.num_rows), np.diff(column.offsets.to_numpy()))])
                term, tf, seen = map(np.concatenate, zip((term, tf, seen), parts))
            order = np.lexsort((term, -seen, row))
            row, term, tf, seen = row[order], term[order], tf[order], seen[order]
            sizes = np.bincount(row, minlength=batch.num_rows)
            _, reach = _weights(tf, seen, np.concatenate([[0], np.cumsum(sizes)]), n_docs)
            # Rounding of the running total must not leave the last term out.
            indexed = (reach >= threshold - SLACK) & (seen > batch.column("copies").to_numpy()[row])
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("copies"),
                 pa.array(np.bincount(row[indexed], minlength=batch.num_rows).astype(np.int32)), as_lists(term, sizes),
                 as_lists(tf.astype(np.int32), sizes), as_lists(seen.astype(np.int32), sizes)],
                ["rep", "own_copies", "indexed", "terms", "tf", "seen"])

    return run


VECTOR = "rep long, own_copies long, indexed int, terms array<long>, tf array<int>, seen array<int>"


def _sketches(terms: np.ndarray, x: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    """Length of the part of each vector in each bucket of terms, a byte each, rounded up."""
    bucket = (terms >> 48) & (SKETCH - 1)
    parts = np.sqrt(np.bincount(owner * SKETCH + bucket, x * x, n * SKETCH))
    coded = np.minimum(np.ceil(255 * np.sqrt(parts) + 1e-6 * (parts > 0)), 255).astype(np.uint8)
    return pa.array([r.tobytes() for r in coded.reshape(n, SKETCH)], pa.binary())


#: Lengths by their bytes in a sketch.
LENGTHS = ((np.arange(256) / 255.0) ** 2).astype(np.float32)


def _unit_rows(n_docs: int, threshold: float):
    """mapInArrow function over vectors: unit vectors, the indexed part, and sketches of terms that others have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "terms", ROW_TERMS):
            terms, bounds = list_parts(batch.column("terms"))
            tf, seen = (list_parts(batch.column(c))[0] for c in ("tf", "seen"))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            x, reach = _weights(tf, seen, bounds, n_docs)
            shared = seen > batch.column("own_copies").to_numpy()[owner]
            lists = np.where((reach >= threshold - SLACK) & shared, seen, 0)
            sketch = _sketches(terms[shared], x[shared], owner[shared], batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), sketch, *[as_lists(v, np.diff(bounds)) for v in (terms, x, reach, lists, seen)]],
                ["rep", "sketch", "terms", "x", "reach", "lists", "seen"])

    return run


def _posting_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, rep, reach, n, tail): a row for each indexed term; ``tail`` has the rarer ones. The search
    itself no longer sends tails.

    The tails of a text grow with the square of its terms, so they go out in batches of bounded size."""
    for batch in batches:
        terms, bounds = list_parts(batch.column("terms"))
        reach, _ = list_parts(batch.column("reach"))
        lists, _ = list_parts(batch.column("lists"))
        owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
        at = np.flatnonzero(lists > 0)
        ends = np.searchsorted(at, bounds[1:][owner[at]])
        lengths = ends - np.arange(len(at)) - 1
        upto = np.concatenate([[0], np.cumsum(lengths)])
        a = 0
        while a < len(at):
            b = max(a + 1, int(np.searchsorted(upto, upto[a] + TAIL_TERMS, "right")) - 1)
            some, part = lengths[a:b], at[a:b]
            flat = np.repeat(np.arange(a, b) + 1 - (upto[a:b] - upto[a]), some) + np.arange(int(some.sum()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms[part]), batch.column("rep").take(pa.array(owner[part])), pa.array(reach[part]),
                 pa.array(lists[part]), as_lists(terms[at][flat], some)],
                ["term", "rep", "reach", "n", "tail"])
            a = b


def _piece_rows(whole: bool, *keys: str):
    """mapInArrow function: (keys, part, term, x, reach, seen) in rows of at most PIECE terms, of the
    indexed terms or of all (``whole``), where a reach of 0 marks a term that is not indexed.

    The indexed terms alone are for bounds: halves of the term numbers, and the bits of numbers in half
    precision, rounded up."""

    def up(values: np.ndarray) -> np.ndarray:
        return np.nextafter(values.astype(np.float16), np.float16(np.inf)).view(np.int16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "terms", ROW_TERMS):
            flat = {c: list_parts(batch.column(c))[0] for c in ("terms", "x", "reach", "lists", "seen")}
            bounds = list_parts(batch.column("terms"))[1]
            indexed = flat["lists"] > 0
            if whole:
                x, reach = flat["x"], np.where(indexed, flat["reach"], 0.0)
                kept = np.arange(len(x))
            else:
                kept = np.flatnonzero(indexed)
                x, reach = up(flat["x"][kept]), up(flat["reach"][kept])
            term, seen = flat["terms"][kept], flat["seen"][kept].astype(np.int32)
            term = term if whole else term.astype(np.int32)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))[kept]
            yield from _cut(batch, keys, owner, {"term": term, "x": x, "reach": reach, "seen": seen})

    return run


def _cut(batch: pa.RecordBatch, keys: Iterable[str], owner: np.ndarray, columns: dict) -> Iterator[pa.RecordBatch]:
    """Rows of at most PIECE values of each of ``columns``, in order of their ``owner`` in the batch."""
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    starts = np.flatnonzero(place % PIECE == 0)
    sizes = np.diff(np.append(starts, len(owner)))
    # A long text is many rows: so many at once go out.
    for a in range(0, len(starts), 2_048):
        b = min(a + 2_048, len(starts))
        at = slice(starts[a], starts[a] + int(sizes[a:b].sum()))
        rows = pa.array(owner[starts[a:b]])
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(k).take(rows) for k in keys], pa.array((place[starts[a:b]] // PIECE).astype(np.int32)),
             *[as_lists(v[at], sizes[a:b]) for v in columns.values()]], [*keys, "part", *columns])


def _whole_rows(*keys: str):
    """mapInArrow function: vectors in rows of at most PIECE terms, with the numbers that their weights come from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "terms", ROW_TERMS):
            bounds = list_parts(batch.column("terms"))[1]
            yield from _cut(batch, keys, np.repeat(np.arange(batch.num_rows), np.diff(bounds)), {
                name: list_parts(batch.column(c))[0] for name, c in (("term", "terms"), ("tf", "tf"), ("seen", "seen"))})

    return run


def _unpacked(n_docs: int, threshold: float):
    """mapInArrow function over such rows, in order: with the weights, and the reach, 0 where a term is not indexed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in sorted_runs(batches, ("lo", "hi", "own", "rep")):
            seen, bounds = list_parts(batch.column("seen"))
            copies = np.repeat(batch.column("own_copies").to_numpy(), np.diff(bounds))
            x, reach = _weights(list_parts(batch.column("tf"))[0], seen, bounds[texts], n_docs)
            reach = np.where((reach >= threshold - SLACK) & (seen > copies), reach, 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[as_lists(v, np.diff(bounds)) for v in (x, reach)]],
                                             [*batch.schema.names, "x", "reach"])

    return run


def seated(rows: DataFrame, blocks: int, first: int = 0, last: int | None = None) -> DataFrame:
    """Deal the rows into blocks, and seat each row with the blocks (lo = hi) that are held while it passes by:
    its own and the half of the others before it, so that two blocks meet once; those from ``first`` to ``last``."""
    own = F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int")
    half, last = blocks // 2, blocks if last is None else last

    def is_met(held):
        opposite = F.pmod(own - held, F.lit(blocks)) * 2 == blocks
        return (held >= first) & (held < last) & (~opposite | (held < own))

    held = F.filter(F.transform(F.sequence(F.lit(0), F.lit(half)), lambda k: F.pmod(own - k, F.lit(blocks))), is_met)
    return rows.select("*", F.inline(F.transform(held, lambda h: F.struct(
        h.alias("lo"), h.alias("hi"), own.alias("own")))))


def by_seat(rows: DataFrame) -> DataFrame:
    """Rows of a seat in one task, one seat after the other, the block that is held first, the pieces of a text in order."""
    return rows.repartition("lo", "hi").sortWithinPartitions(
        "lo", "hi", F.col("own") != F.col("lo"), "own", "rep", "part")


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of the ranges that begin at ``starts``, one range after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def _slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Neighbours with a total size of at most ``most``, or one."""
    upto, a = np.concatenate([[0], np.cumsum(sizes)]), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + most, "right")) - 1)
        yield a, b
        a = b


def _compact(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """Arrays of the texts of a batch of pieces, which hold no more than is worked with later."""
    rep = batch.column("rep").to_numpy()
    first = np.flatnonzero(np.append(True, rep[1:] != rep[:-1]))
    term, pieces = list_parts(batch.column("term"))
    x, reach, seen = (list_parts(batch.column(c))[0] for c in ("x", "reach", "seen"))
    if x.dtype == np.int16:
        x, reach = (v.view(np.float16).astype(np.float32) for v in (x, reach))
    bounds = np.append(pieces[first], len(term))
    # Terms go from common to rare; where they do not, rows repeat an id.
    after = (seen[1:] < seen[:-1]) | ((seen[1:] == seen[:-1]) & (term[1:] > term[:-1]))
    after[bounds[1:-1] - 1] = True
    # Halves of numbers have no order, and are for bounds alone.
    after |= term.dtype == np.int32
    indexed = np.flatnonzero(reach > 0)
    out = {"rep": rep[first], "sizes": np.diff(bounds), "term": term.copy(), "x": x.copy(),
           "indexed": np.diff(np.searchsorted(indexed, bounds)), "reach": reach[indexed], "seen": seen[indexed],
           "is_indexed": reach > 0, "repeats": np.array([not after.all()])}
    if "sketch" in batch.schema.names:
        raw = b"".join(batch.column("sketch").take(pa.array(first)).to_pylist())
        out["sketch"] = np.frombuffer(raw, np.uint8).reshape(len(first), -1)
    return out | {c: batch.column(c).to_numpy()[first] for c in ("copies", "train_rows") if c in batch.schema.names}


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; for some 100,000 of them a sort is faster than hashing."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])[:len(values)]]


class _Texts:
    """Texts of one block in a tile, from batches of whole texts."""

    def __init__(self, batches: Iterable[pa.RecordBatch]):
        parts = [_compact(batch) for batch in batches]
        # Terms by 32-bit numbers: their order, a batch at a time, as all at once would take many times the block.
        self.terms = _distinct(np.concatenate([_distinct(part["term"]) for part in parts]))
        for part in parts:
            part["term"] = np.searchsorted(self.terms, part["term"]).astype(np.int32)
        joined = {c: np.concatenate([part.pop(c) for part in parts]) for c in list(parts[0])}
        self.rep, self.number, self.x, self.reach, self.seen = (
            joined.pop(c) for c in ("rep", "term", "x", "reach", "seen"))
        self.numbers = {c: joined[c] for c in ("copies", "train_rows") if c in joined}
        self.sketch = joined.pop("sketch", None)
        self.bounds, self.starts = (np.concatenate([[0], np.cumsum(joined[c])]) for c in ("sizes", "indexed"))
        self.doc = np.repeat(np.arange(len(self.rep), dtype=np.int32), joined["indexed"])
        all_indexed = len(self.doc) == len(self.number)
        self.indexed_number = self.number if all_indexed else self.number[joined["is_indexed"]]
        self.indexed_x = self.x if all_indexed else self.x[joined["is_indexed"]]
        if joined["repeats"].any():
            self._once()

    def _once(self) -> None:
        """Rows that repeat an id hold a term more than once: it counts once."""
        owner = np.repeat(np.arange(len(self.rep)), np.diff(self.bounds))
        kept = np.unique(owner * len(self.terms) + self.number, return_index=True)[1]
        self.number, self.x = self.number[kept], self.x[kept]
        self.bounds = np.searchsorted(owner[kept], np.arange(len(self.rep) + 1))

    @cached_property
    def by_term(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the indexed places of each number begin, up to one past the last number, and the places by number."""
        order = np.argsort(self.indexed_number, kind="stable").astype(np.int32)
        sizes = np.bincount(self.indexed_number, minlength=len(self.terms) + 1)
        return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), order

    @cached_property
    def order(self) -> tuple[np.ndarray, int]:
        """Texts one after the other, in each the indexed terms from common to rare."""
        wide = int(self.seen.max(initial=0)) + 1
        return self.doc.astype(np.int64) * wide + (wide - 1 - self.seen), wide

    @cached_property
    def first(self) -> np.ndarray:
        """Texts that have the commonest indexed term of each text."""
        return self.seen[np.minimum(self.starts[:-1], len(self.seen) - 1)].astype(np.int64)

    def length(self, docs: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Length of the part of ``docs`` with terms in at least ``seen`` texts."""
        order, wide = self.order
        return self.reach[np.searchsorted(order, docs * wide + (wide - 1 - seen), "right") - 1]


class _Meeting:
    """Texts of a block, which are held, and some of another one (or themselves): which pairs may reach the threshold."""

    def __init__(self, threshold: float, held: _Texts, other: _Texts):
        self.threshold, self.held, self.other = threshold, held, other

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of the texts on either side, in order of the other side; of a block with itself, the first is smaller."""
        held, other = self.held, self.other
        lists, places = held.by_term
        met = self._numbers if other.indexed_number is other.number else self._known[other.indexed_number]
        left = lists[met]
        sizes = lists[met + 1] - left
        upto = np.concatenate([[0], np.cumsum(sizes)])
        across = len(held.rep)
        for a, b in _slices(np.diff(upto[other.starts]), PRODUCTS):
            part = slice(other.starts[a], other.starts[b])
            met = places[_ranges(left[part], sizes[part])]
            cell = np.repeat((other.doc[part].astype(np.int64) - a) * across, sizes[part]) + held.doc[met]
            value = np.repeat(other.indexed_x[part].astype(np.float64), sizes[part]) * held.indexed_x[met]
            if (b - a) * across <= DENSE * len(cell):
                total = np.bincount(cell, value, (b - a) * across)
                cell = np.flatnonzero(total)
                total = total[cell]
            else:
                # Pairs and products are sorted at once; a product, at most 1, in steps, rounded up.
                most = (1 << STEPS) - 1
                cell = np.sort(cell << STEPS | np.minimum(np.ceil(value * most), most).astype(np.int64))
                value, cell = cell & most, cell >> STEPS
                first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])[:len(cell)])
                total = np.add.reduceat(value, first) / most if len(first) else np.zeros(0)
                cell = cell[first]
            i, k = cell % across, cell // across + a
            if held is other:
                i, k, total = i[i < k], k[i < k], total[i < k]
            # From the later of the two first indexed terms on, all shared terms are indexed in both.
            seen = np.minimum(held.first[i], other.first[k])
            near = total + held.length(i, seen) * other.length(k, seen).astype(np.float64) >= self.threshold - SLACK
            yield self._alike(i[near], k[near])

    def _alike(self, i: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those pairs whose sketches, if there are any, allow the threshold."""
        if self.held.sketch is None or self.other.sketch is None:
            return i, k
        keep = np.zeros(len(i), bool)
        for a in range(0, len(i), SKETCHES):
            one, two = LENGTHS[self.held.sketch[i[a:a + SKETCHES]]], LENGTHS[self.other.sketch[k[a:a + SKETCHES]]]
            keep[a:a + SKETCHES] = np.einsum("ij,ij->i", one, two) >= self.threshold - SKETCH_SLACK
        return i[keep], k[keep]

    @cached_property
    def _known(self) -> np.ndarray:
        """The held side's number of each term of the other side, one past the last for those it lacks."""
        terms, asked = self.held.terms, self.other.terms
        at = np.searchsorted(terms, asked)
        known = at < len(terms)
        known[known] = terms[at[known]] == asked[known]
        return np.where(known, at, len(terms)).astype(np.int32)

    @property
    def _numbers(self) -> np.ndarray:
        """The held side's numbers of the other side's terms, place by place."""
        return self.other.number if self.held is self.other else self._known[self.other.number]

    def cosines(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Inner products of the whole vectors; the pairs are in order of ``two``."""
        held, other, number, numbers = self.held, self.other, self.held.number, self._numbers
        out, dense = np.zeros(len(one)), np.zeros(len(held.terms) + 1)
        sizes = np.diff(held.bounds)
        at = np.append(np.flatnonzero(np.append(True, two[1:] != two[:-1])), len(two))
        for a, b in zip(at[:-1], at[1:]):
            own = slice(other.bounds[two[a]], other.bounds[two[a] + 1])
            dense[numbers[own]] = other.x[own]
            for p, q in _slices(sizes[one[a:b]], PRODUCTS):
                some = one[a + p:a + q]
                flat = _ranges(held.bounds[some], sizes[some])
                out[a + p:a + q] = np.add.reduceat(
                    held.x[flat] * dense[number[flat]], np.cumsum(sizes[some]) - sizes[some])
            dense[numbers[own]] = 0.0
        return out


class _Tile(_Meeting):
    """A tile that lies in one batch; texts are numbered through both blocks."""

    def __init__(self, threshold: float, two_blocks: bool, batch: pa.RecordBatch):
        own = batch.column("own").to_numpy()
        cut = int(np.searchsorted(own, own[-1])) if two_blocks else batch.num_rows
        held = _Texts([batch.slice(0, cut)])
        super().__init__(threshold, held, _Texts([batch.slice(cut)]) if two_blocks else held)
        self.shift = len(held.rep) if two_blocks else 0

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return ((one, two + self.shift) for one, two in super(_Tile, self).pairs())

    def cosines(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return super().cosines(one, two - self.shift)


def _block_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, pa.RecordBatch]]:
    """(lo, hi, own, pieces) of whole texts of one block, as many as came at once."""
    for batch, _ in sorted_runs(batches, ("lo", "hi", "own", "rep")):
        lo, hi, own = (batch.column(c).to_numpy() for c in ("lo", "hi", "own"))
        new = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]) | (own[1:] != own[:-1])
        bounds = np.concatenate([[0], np.flatnonzero(new) + 1, [batch.num_rows]])
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield int(lo[a]), int(hi[a]), int(own[a]), batch.slice(a, b - a)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, _Texts, Iterable[tuple[int, _Texts]]]]:
    """(lo, hi, texts of block lo, (block, texts) that meet them): the first are held, the others pass by in batches.

    A block meets itself if lo = hi."""
    for (lo, hi), tile in groupby(_block_parts(batches), lambda part: part[:2]):
        blocks = groupby(tile, lambda part: part[2])
        own, first = next(blocks)
        if own == lo:
            held = _Texts(part[3] for part in first)
            others = ((part[2], _Texts([part[3]])) for _, parts in blocks for part in parts)
            yield lo, hi, held, chain([(lo, held)] if lo == hi else [], others)
            del held, others
            pa.default_memory_pool().release_unused()


def _candidate_rows(threshold: float):
    """mapInArrow function over seated pieces: (rep, lo, hi, own) of the texts with a possible partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lo, _, held, others in _tiles(batches):
            for own, parts in groupby(others, lambda other: other[0]):
                found, tile = np.zeros(len(held.rep), bool), (min(lo, own), max(lo, own))
                for _, other in parts:
                    met = found if other is held else np.zeros(len(other.rep), bool)
                    for one, two in _Meeting(threshold, held, other).pairs():
                        found[one] = met[two] = True
                    if other is not held:
                        yield rows(other.rep[met], *tile, own)
                yield rows(held.rep[found], *tile, lo)

    def rows(reps: np.ndarray, *place: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(reps), *[pa.array(np.full(len(reps), n, np.int32)) for n in place]], ["rep", "lo", "hi", "own"])

    return run


def _match_rows(threshold: float, reduce: Callable):
    """mapInArrow function over seated vectors: verified pairs of each tile, given to ``reduce``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, held, others in _tiles(batches):
            for _, other in others:
                met = _Meeting(threshold, held, other)
                for one, two in _joined(met.pairs()):
                    cosine = met.cosines(one, two)
                    keep = cosine >= threshold
                    one, two = one[keep], two[keep]
                    if len(one):
                        yield from reduce(verified(held, other, cosine[keep], one, two))

    def verified(held: _Texts, other: _Texts, cosine: np.ndarray, one: np.ndarray, two: np.ndarray) -> dict:
        a, b = held.rep[one], other.rep[two]
        swap = a > b
        out = {"idx1": np.where(swap, b, a), "idx2": np.where(swap, a, b), "similarity": cosine}
        for c in held.numbers:
            x, y = held.numbers[c][one], other.numbers[c][two]
            out |= {f"{c}1": np.where(swap, y, x), f"{c}2": np.where(swap, x, y)}
        return out

    return run


def _joined(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs, about PAIRS at once: a reduction has one row per text and call."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for found in pairs:
        if len(found[0]):
            held.append(found)
        if sum(len(one) for one, _ in held) >= PAIRS:
            yield tuple(map(np.concatenate, zip(*held)))
            held = []
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


@dataclass
class TextPairs:
    """Vectors that may have a partner, seated by tile: what every reduction starts from.

    They are many times the input and read once by each reduction, so they are sent, not written."""

    seated: DataFrame
    n_docs: int
    threshold: float
    batch_rows = BATCH_ROWS

    def reduced(self, reduce: Callable, schema: str) -> DataFrame:
        return by_seat(self.seated).mapInArrow(
            _chained(_unpacked(self.n_docs, self.threshold), _match_rows(self.threshold, reduce)), schema)


def _common_terms(frequency: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """At most COMMON terms of most groups, in order, their rows, and the least groups of one; the driver sees no more."""
    sizes = sorted(frequency.groupBy("n_groups").count().collect(), reverse=True)
    least, total = (sizes[0][0] + 1 if sizes else 1), 0
    for n_groups, n in sizes:
        total += n
        if total > COMMON:
            break
        least = n_groups
    known = frequency.where(F.col("n_groups") >= least).select("term", "doc_freq").toArrow()
    term, doc_freq = (known.column(c).to_numpy() for c in ("term", "doc_freq"))
    order = np.argsort(term)
    return term[order], doc_freq[order], least


def text_vectors(rows: DataFrame, groups: DataFrame, n_docs: int, threshold: float) -> DataFrame:
    """Vectors of ``groups`` (key, rep, copies), whose first ``rows`` (id, terms) hold bags of term numbers.

    Every worker knows the frequencies of the common terms, and the groups if they are not too many, so a
    bag is weighed where it lies; only rare terms are shuffled to their frequencies, and the texts to these in
    parts. Rows that repeat a rep are one vector of several bags.
    """
    n_groups = groups.count()
    again = n_groups != groups.select("rep").distinct().count()
    wide = []
    if again or n_groups > HELD_GROUPS:
        counted = groups.select("key", "rep", "copies").distinct().drop("key")
        wide.append(materialise(counted.join(rows.select(F.col("id").alias("rep"), "terms"), "rep")))
        each = bags = wide[0].withColumn("bags", F.array(F.size("terms")))
        if again:
            bags = wide[0].groupBy("rep").agg(F.collect_list(F.struct("copies", "terms")).alias("all")).select(
                "rep", F.array_min("all.copies").alias("copies"), F.flatten("all.terms").alias("terms"),
                F.transform("all.terms", F.size).alias("bags"))
        bag_rows: Callable = _unchanged
    else:
        held = groups.select("rep", "copies").toArrow().sort_by("rep")
        each = bags = rows.select("id", "terms")
        bag_rows = _bag_rows(*(held.column(c).to_numpy() for c in ("rep", "copies")))
    frequency = materialise(each.mapInArrow(
        _chained(bag_rows, _frequency_rows), "term long, doc_freq long, n_groups long").groupBy("term").agg(
        F.sum("doc_freq").alias("doc_freq"), F.sum("n_groups").alias("n_groups")), BATCH_ROWS)
    common, seen, least = _common_terms(frequency)
    vector_rows = _vector_rows(common, seen, n_docs, threshold)
    rare = frequency.where(F.col("n_groups") < least).select("term", "doc_freq")
    if rare.isEmpty():
        parts = [materialise(bags.mapInArrow(_chained(bag_rows, vector_rows), VECTOR), BATCH_ROWS)]
    else:
        bag = "rep long, copies long, terms array<long>, bags array<int>"
        lists = materialise(bags.mapInArrow(
            _chained(bag_rows, _rare_rows(common)), "rep long, term long, tf int").join(rare, "term").groupBy("rep").agg(
            F.collect_list(F.struct("term", "tf", "doc_freq")).alias("rare")), BATCH_ROWS)
        none = F.array().cast("array<struct<term:bigint,tf:int,doc_freq:bigint>>")
        parts = []
        for n in range(RARE_PARTS):
            here = F.pmod(F.xxhash64("rep"), F.lit(RARE_PARTS)) == n
            some = bags.mapInArrow(bag_rows, bag).where(here).join(lists.where(here), "rep", "left").withColumn(
                "rare", F.coalesce("rare", none))
            parts.append(materialise(some.mapInArrow(vector_rows, VECTOR), BATCH_ROWS))
        discard(lists)
    discard(frequency, *wide)
    return fold(DataFrame.unionByName, parts)


def text_pairs(vectors: DataFrame, groups: DataFrame, n_docs: int, threshold: float) -> TextPairs:
    """Search among the ``vectors`` of ``groups`` (rep, copies, train_rows).

    First the indexed terms and sketches tell which vectors have a possible partner in which tile; the
    whole vectors then go to those tiles only.
    """
    indexed = vectors.agg(F.sum("indexed")).first()[0]
    rows = vectors.where("indexed > 0").mapInArrow(
        _chained(_unit_rows(n_docs, threshold), _piece_rows(False, "rep", "sketch")),
        "rep long, sketch binary, part int, term array<int>, x array<smallint>, reach array<smallint>, seen array<int>")
    blocks = blocks_of(indexed or 0)
    held = max(SPREAD, vectors.sparkSession.sparkContext.defaultParallelism)
    if blocks > held:
        rows = materialise(rows, BATCH_ROWS)
    possible = [materialise(by_seat(seated(rows, blocks, a, a + held)).mapInArrow(
        _candidate_rows(threshold), "rep long, lo int, hi int, own int"), BATCH_ROWS) for a in range(0, blocks, held)]
    keys = {"rep": "long", "copies": "long", "train_rows": "long", "lo": "int", "hi": "int", "own": "int"}
    counted = groups.groupBy("rep").agg(F.max("copies").alias("copies"), F.max("train_rows").alias("train_rows"))
    places = materialise(fold(DataFrame.unionByName, possible).join(counted, "rep").select(*keys))
    discard(*possible, *([rows] if blocks > held else []))
    tiles = places.join(vectors.select("rep", F.size("terms").alias("n")), "rep").groupBy("lo", "hi", "own")
    most = tiles.agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
    whole = vectors.join(finer(places, -(-(most or 1) // WHOLE_TERMS)), "rep").mapInArrow(
        _whole_rows(*keys, "own_copies"), ", ".join(f"{k} {t}" for k, t in keys.items())
        + ", own_copies long, part int, term array<long>, tf array<int>, seen array<int>")
    return TextPairs(whole, n_docs, threshold)


def finer(places: DataFrame, parts: int) -> DataFrame:
    """Places of texts in tiles of blocks that are cut into ``parts``."""
    if parts == 1:
        return places
    part, other = F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(parts)).cast("int"), F.col("hi") + F.col("lo") - F.col("own")
    own = F.col("own") * parts + part
    met = F.inline(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda k: F.struct(
        F.least(own, other * parts + k).alias("lo"), F.greatest(own, other * parts + k).alias("hi"), own.alias("own"))))
    return places.select("rep", "copies", "train_rows", met)


def _unchanged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from batches


def _chained(one: Callable, two: Callable) -> Callable:
    """mapInArrow function: one after the other, a batch at a time."""
    return lambda batches: two(one(batches))


def blocks_of(indexed: int) -> int:
    """Number of blocks: of at most BLOCK_TERMS indexed terms on average."""
    return max(1, -(-indexed // BLOCK_TERMS), min(SPREAD, indexed // LEAST_TERMS))
