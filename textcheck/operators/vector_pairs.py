"""Pairs of dense vectors with a cosine at or above a threshold: exact blocks, and hash tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce as fold

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textcheck.functions.runs import list_parts, sorted_runs
from textcheck.functions.seeded import seeded_hash
from textcheck.functions.skew import join_by_key
from textcheck.session import discard, materialise

# Rounding slack of the bounds; the final test uses the plain threshold.
SLACK = 1e-9
# Vectors of a block; vectors per cell aimed at, and the most cells. They bear on the work alone:
# a large cell has many blocks.
BLOCK, CELL_ROWS, MAX_CELLS = 4_096, 4_096, 2_048
# Pairs of blocks that travel to a worker at once, and pairs of vectors compared at once.
BATCH_ROWS, COMPARED = 4, 1 << 21
# Least hash tables of the approximate search and bits of a key, and vectors of a key: bits grow with
# the logarithm of the vectors. Vectors meet in a table if at most one bit differs; there are tables
# enough that a pair at the threshold is missed in MISSED of cases at most.
TABLES, BITS, SEED, KEY_ROWS, MISSED = 20, 12, 11, 8, 1e-4
# Pairs of a key compared at once, and keys that are shuffled at once: the tables are searched in rounds.
MET, ROUND_KEYS = 1 << 17, 1 << 24
# Standard deviations that the differing bits of a pair may exceed those expected at the threshold by.
DEVIATIONS = 6.5

PACKED = ("cell int, block int, reps array<long>, copies array<long>, train_rows array<long>, "
          "matrix binary, centre array<double>, radius double")


def _unit(column: pa.Array) -> np.ndarray:
    flat, bounds = list_parts(column)
    matrix = flat.astype(np.float64).reshape(len(bounds) - 1, -1)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def _cell_rows(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cosine = _unit(batch.column("vector")) @ pivots.T
                cell = cosine.argmax(axis=1)
                away = _angle(cosine[np.arange(len(cell)), cell])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away)],
                    [*batch.schema.names, "cell", "away"])

    return run


def _packed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block: its unit vectors, their centre and the largest angle to it."""
    names = [part.split()[0] for part in PACKED.split(", ")]
    for batch, bounds in sorted_runs(batches, ("cell", "block")):
        for a, b in zip(bounds[:-1], bounds[1:]):
            some = batch.slice(a, b - a)
            unit = _unit(some.column("vector"))
            centre = unit.mean(axis=0)
            length = np.linalg.norm(centre)
            # Vectors that cancel out have no direction in common: any centre, the widest angle.
            centre = centre / length if length > SLACK else unit[0]
            lists = [pa.array([some.column(c).to_pylist()], pa.list_(pa.int64()))
                     for c in ("rep", "copies", "train_rows")]
            yield pa.RecordBatch.from_arrays(
                [some.column("cell").slice(0, 1), some.column("block").slice(0, 1), *lists,
                 pa.array([unit.tobytes()], pa.binary()), pa.array([centre.tolist()], pa.list_(pa.float64())),
                 pa.array([float(_angle(unit @ centre).max())])], names)


def _verified(one: dict, two: dict, similarity: np.ndarray, i: np.ndarray, k: np.ndarray) -> dict:
    """Pair columns for the rows ``i`` of one block and ``k`` of another, smaller rep first."""
    a, b = one["rep"][i], two["rep"][k]
    swap = a > b
    out = {"idx1": np.where(swap, b, a), "idx2": np.where(swap, a, b), "similarity": similarity}
    for c in ("copies", "train_rows"):
        x, y = one[c][i], two[c][k]
        out |= {f"{c}1": np.where(swap, y, x), f"{c}2": np.where(swap, x, y)}
    return out


def _block_matches(threshold: float, reduce: Callable):
    """mapInArrow function over pairs of blocks: their verified pairs, given to ``reduce``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                sides = []
                for side in ("1", "2"):
                    rows = {c: batch.column(f"{n}{side}")[r].values.to_numpy() for c, n in
                            (("rep", "reps"), ("copies", "copies"), ("train_rows", "train_rows"))}
                    matrix = np.frombuffer(batch.column(f"matrix{side}")[r].as_py())
                    sides.append((rows, matrix.reshape(len(rows["rep"]), -1)))
                (one, a), (two, b) = sides
                itself = all(batch.column(f"{c}1")[r].as_py() == batch.column(f"{c}2")[r].as_py()
                             for c in ("cell", "block"))
                rows = max(1, COMPARED // len(b))
                for start in range(0, len(a), rows):
                    cosine = a[start:start + rows] @ b.T
                    keep = cosine >= threshold
                    if itself:
                        keep = np.triu(keep, start + 1)
                    i, k = np.nonzero(keep)
                    if len(i):
                        yield from reduce(_verified(one, two, cosine[i, k], i + start, k))

    return run


@dataclass
class BlockPairs:
    """Packed blocks, and the pairs of blocks that are near enough to hold a pair of vectors."""

    packed: DataFrame
    near: DataFrame
    threshold: float
    batch_rows = BATCH_ROWS

    def reduced(self, reduce: Callable, schema: str) -> DataFrame:
        def side(k: str) -> DataFrame:
            return self.packed.select(*[F.col(c).alias(f"{c}{k}") for c in (
                "cell", "block", "reps", "copies", "train_rows", "matrix")])

        met = self.near.join(side("1"), ["cell1", "block1"]).join(side("2"), ["cell2", "block2"])
        return met.mapInArrow(_block_matches(self.threshold, reduce), schema)


def block_pairs(groups: DataFrame, threshold: float) -> BlockPairs | None:
    """Exact search among ``groups`` (rep, copies, train_rows, vector); None without rows.

    Vectors go to the cell of the nearest pivot (a sample of bounded size), cells are cut into
    blocks of about BLOCK, and a block is one row. Two vectors within the threshold are no farther
    apart than its angle, so two blocks (or cells) can be skipped if the angle between their
    centres, less both radii, is wider. The driver sees one row per cell, MAX_CELLS at most.
    """
    n_rows = groups.count()
    if not n_rows:
        return None
    n_cells = max(1, min(MAX_CELLS, n_rows // CELL_ROWS))
    picked = groups.orderBy(seeded_hash(0, F.col("rep")), "rep").select("vector").limit(n_cells).toArrow()
    pivots = _unit(picked.column("vector").combine_chunks())
    columns = "rep long, copies long, train_rows long, vector array<double>"
    placed = materialise(groups.select("rep", "copies", "train_rows", F.col("vector").cast("array<double>")).mapInArrow(
        _cell_rows(pivots), f"{columns}, cell int, away double"))
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("away")).collect()
    limit = float(np.arccos(np.clip(threshold, -1.0, 1.0))) + 1e-6
    numbers = np.array([r["cell"] for r in cells])
    radius = np.array([r["away"] for r in cells])
    gap = _angle(pivots[numbers] @ pivots[numbers].T) - radius[:, None] - radius[None, :]
    first, second = np.nonzero((gap <= limit) & (numbers[:, None] <= numbers[None, :]))
    spark = groups.sparkSession
    near_cells = spark.createDataFrame(
        list(zip(numbers[first].tolist(), numbers[second].tolist())), "cell1 int, cell2 int")
    sizes = F.broadcast(spark.createDataFrame(
        [(r["cell"], -(-r["n"] // BLOCK)) for r in cells], "cell int, blocks int"))
    packed = materialise(
        placed.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
        .repartition("cell", "block").sortWithinPartitions("cell", "block", "rep")
        .select("cell", "block", "rep", "copies", "train_rows", "vector").mapInArrow(_packed_rows, PACKED))

    def outline(k: str) -> DataFrame:
        return packed.select(*[F.col(c).alias(f"{c}{k}") for c in ("cell", "block", "centre", "radius")])

    cosine = F.aggregate(F.zip_with("centre1", "centre2", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))
    near = (near_cells.join(outline("1"), "cell1").join(outline("2"), "cell2")
            .where((F.col("cell1") < F.col("cell2")) | (F.col("block1") <= F.col("block2")))
            .where(angle - F.col("radius1") - F.col("radius2") <= limit)
            .select("cell1", "block1", "cell2", "block2"))
    return BlockPairs(packed, materialise(near), threshold)


def seated(rows: DataFrame, n: str, block: int) -> DataFrame:
    """Deal the ``n`` rows of a term into blocks, and seat each row at every pair of blocks (lo, hi)
    it belongs to; most terms have one block, whose rows are seated once, at (0, 0)."""
    blocks = F.ceil(F.col(n) / block).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    return rows.select("*", F.inline(F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: F.struct(
        F.least(own, other).alias("lo"), F.greatest(own, other).alias("hi"), own.alias("own")))))


def by_seat(rows: DataFrame) -> DataFrame:
    """Rows of a seat in one task, one seat after the other."""
    return rows.repartition("term", "lo", "hi").sortWithinPartitions("term", "lo", "hi", "own", "rep")


def shipped(possible: DataFrame, whole: DataFrame, block: int) -> DataFrame:
    """The rows of ``whole`` seated at the terms where ``possible`` (term, rep) has them."""
    lengths = possible.groupBy("term").agg(F.count("*").alias("n"))
    places = join_by_key(possible, lengths, "term", "n").groupBy("rep").agg(
        F.collect_list(F.struct("term", "n")).alias("at"))
    return seated(whole.join(places, "rep").select(*whole.columns, F.inline("at")), "n", block).drop("n")


def _signatures(sides: np.ndarray, bits: int) -> np.ndarray:
    """A key of ``bits`` bits for each table: on which side of random planes a vector lies."""
    return (sides.reshape(len(sides), -1, bits).astype(np.int64) << np.arange(bits)).sum(axis=2)


def _apart(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first table in which at most one bit differs, the bit or 0) of pairs of signatures; the
    table is -1 without one."""
    differ = a ^ b
    one_bit = (differ & (differ - 1)) == 0
    table = np.where(one_bit.any(axis=1), one_bit.argmax(axis=1), -1)
    bit = differ[np.arange(len(differ)), table]
    return table, np.log2(np.maximum(bit, 1)).astype(np.int64)


def key_bits(n: int) -> int:
    """Bits of a key such that it has about KEY_ROWS of ``n`` vectors that lie at random."""
    return max(BITS, int(np.ceil(np.log2(max(n, 1) / KEY_ROWS))) + 1)


def least_tables(threshold: float, bits: int) -> int:
    """Tables in which a pair at ``threshold`` meets at least once, but for MISSED of cases."""
    differ = float(_angle(np.float64(threshold))) / np.pi
    meets = (1 - differ) ** bits + bits * differ * (1 - differ) ** (bits - 1)
    return int(np.ceil(np.log(MISSED) / np.log1p(-min(meets, 1 - 1e-9))))


def most_bits(threshold: float, planes: int) -> int:
    """Bits of all tables in which a pair at ``threshold`` differs at most, but for less than one in 10^10 pairs."""
    differ = float(_angle(np.float64(threshold))) / np.pi
    return int(np.ceil(planes * differ + DEVIATIONS * np.sqrt(planes * differ * (1 - differ)))) + 1


def _signed(batch: pa.RecordBatch, planes: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """On which side of each plane the vectors lie, and the same packed."""
    sides = _unit(batch.column("vector")) @ planes.T >= 0
    return sides, pa.array(np.array([s.tobytes() for s in np.packbits(sides, axis=1)], object), pa.binary())


def _signature_rows(planes: np.ndarray):
    """mapInArrow function: the same rows with their signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, _signed(batch, planes)[1]], [*batch.schema.names, "signature"])

    return run


def _key_rows(planes: np.ndarray, bits: int, first: int, last: int):
    """mapInArrow function: for the tables from ``first`` to ``last`` ``bits`` keys (term), each without one bit, and
    the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            # A vector is some hundreds of rows.
            for some in (batch.slice(a, 512) for a in range(0, batch.num_rows, 512)):
                sides, packed = _signed(some, planes)
                signature, n_keys = _signatures(sides, bits)[:, first:last], (last - first) * bits
                place = np.arange(first * bits, last * bits).reshape(1, -1, bits)
                left = signature[:, :, None] & ~(np.int64(1) << np.arange(bits))
                keys = (place << bits) | left
                at = np.repeat(np.arange(some.num_rows), n_keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.reshape(-1)), some.column("rep").take(pa.array(at)), packed.take(pa.array(at))],
                    ["term", "rep", "signature"])

    return run


def _met(batch: pa.RecordBatch, bounds: np.ndarray, planes: int, bits: int,
         most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a key that meet there for the first time and differ in at most ``most`` bits of all tables;
    many small keys are handled at once."""
    lo, hi, own, term = (batch.column(c).to_numpy() for c in ("lo", "hi", "own", "term"))
    raw = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
    signature = np.concatenate([_signatures(np.unpackbits(raw[a:a + 4_096], axis=1, count=planes), bits)
                                for a in range(0, batch.num_rows, 4_096)])
    # Each row with the rows after it in its key.
    after = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(batch.num_rows) - 1
    upto, a = np.concatenate([[0], np.cumsum(after)]), 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + MET, "right")) - 1)
        one = np.repeat(np.arange(a, b), after[a:b])
        two = one + 1 + np.arange(len(one)) - np.repeat(upto[a:b] - upto[a], after[a:b])
        if len(one):
            near = np.bitwise_count(raw[one] ^ raw[two]).sum(axis=1, dtype=np.int32) <= most
            one, two = one[near], two[near]
        if len(one):
            table, bit = _apart(signature[one], signature[two])
            here = ((table * bits + bit) == term[one] >> bits) & ((lo[one] == hi[one]) | (own[one] != own[two]))
            yield one[here], two[here]
        a = b


def _candidate_rows(planes: int, bits: int, most: int):
    """mapInArrow function over seated keys: (term, rep) of the rows that meet another one there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in sorted_runs(batches, ("term", "lo", "hi")):
            found = np.zeros(batch.num_rows, bool)
            for one, two in _met(batch, bounds, planes, bits, most):
                found[one] = found[two] = True
            at = pa.array(np.flatnonzero(found))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in ("term", "rep")], ["term", "rep"])

    return run


def _hash_matches(threshold: float, planes: int, bits: int, reduce: Callable):
    """mapInArrow function over seated vectors: verified pairs of each key, given to ``reduce``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in sorted_runs(batches, ("term", "lo", "hi")):
            unit = _unit(batch.column("vector"))
            rows = {c: batch.column(c).to_numpy() for c in ("rep", "copies", "train_rows")}
            for one, two in _met(batch, bounds, planes, bits, most_bits(threshold, planes)):
                cosine = (unit[one] * unit[two]).sum(axis=1)
                keep = cosine >= threshold
                if keep.any():
                    yield from reduce(_verified(rows, rows, cosine[keep], one[keep], two[keep]))

    return run


@dataclass
class HashPairs:
    """Vectors seated at the keys at which they first meet another one."""

    seated: DataFrame
    threshold: float
    planes: int
    bits: int
    batch_rows = None

    def reduced(self, reduce: Callable, schema: str) -> DataFrame:
        return by_seat(self.seated).mapInArrow(
            _hash_matches(self.threshold, self.planes, self.bits, reduce), schema)


def hash_pairs(groups: DataFrame, threshold: float, tables: int = TABLES, seed: int = SEED) -> HashPairs | None:
    """Approximate search by random-projection hash tables with probes, verified exactly.

    Two vectors at angle w agree in a bit with probability 1 - w / pi. They meet in a table if at
    most one of its bits differs (each key is probed without one bit), and are compared in
    the first table in which they meet. All pairs put out are true; the share of pairs found grows
    with ``tables``, the least number. Narrow rows (key, signature) are dealt out first, some tables in a
    round, vectors only to keys where they meet another one whose signature is near enough.
    """
    head = groups.select(F.size("vector").alias("width")).first()
    if head is None:
        return None
    n_groups = groups.count()
    bits = key_bits(n_groups)
    tables = max(tables, least_tables(threshold, bits))
    planes = np.random.default_rng(seed).normal(size=(tables * bits, head["width"]))
    most, each = most_bits(threshold, len(planes)), max(1, ROUND_KEYS // (n_groups * bits))
    vectors = groups.select("rep", F.col("vector").cast("array<double>"))
    found = []
    for first in range(0, tables, each):
        keys = vectors.mapInArrow(
            _key_rows(planes, bits, first, min(first + each, tables)), "term long, rep long, signature binary")
        # Only keys of several blocks, which are few, need a length.
        large = F.broadcast(keys.groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK))
        sized = keys.join(large, "term", "left").withColumn("n", F.coalesce("n", F.lit(1)))
        found.append(materialise(by_seat(seated(sized, "n", BLOCK)).mapInArrow(
            _candidate_rows(len(planes), bits, most), "term long, rep long").distinct()))
    possible = fold(DataFrame.unionByName, found)
    whole = groups.select("rep", "copies", "train_rows", F.col("vector").cast("array<double>")).mapInArrow(
        _signature_rows(planes), "rep long, copies long, train_rows long, vector array<double>, signature binary")
    out = materialise(shipped(possible, whole, BLOCK))
    discard(*found)
    return HashPairs(out, threshold, len(planes), bits)
