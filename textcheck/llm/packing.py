"""Packing of documents into sequences of bounded length: best fit, then local search."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textcheck.llm.token_cache import shared_encoder
from textcheck.llm.words import text_slices
from textcheck.session import materialise

#: Whole texts that travel to a worker at once.
BATCH_ROWS = 1_024
#: Pieces that one task packs together.
GROUP = 16_384
#: Rounds of the local search over the underfull sequences of a group.
ROUNDS = 50


def _piece_rows(tokenizer: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer)
        end = end_id.to_bytes(2, "little")
        for batch, texts in text_slices(batches, "text"):
            ids = batch.column("doc_id").to_pylist()
            rows: list[tuple] = []
            for doc_id, encoded in zip(ids, encoder.encode(texts.to_pylist())):
                tokens = np.frombuffer(encoded + end, "<u2").astype("<u4")
                for piece, start in enumerate(range(0, len(tokens), capacity)):
                    part = tokens[start:start + capacity]
                    rows.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


class _Bins:
    """Bins of one group, and those of each fill in a bit set, so that best fit is one look-up."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.items: list[list[int]] = []
        self.fill: list[int] = []
        self.of_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0

    def tightest(self, size: int) -> int | None:
        """The bin with the least room that is at least ``size``."""
        fitting = self.rooms >> size
        if not fitting:
            return None
        room = size + (fitting & -fitting).bit_length() - 1
        return self.of_room[room][-1]

    def _take(self, bin_no: int) -> None:
        room = self.capacity - self.fill[bin_no]
        entries = self.of_room[room]
        entries.remove(bin_no)
        if not entries:
            self.rooms &= ~(1 << room)

    def _put(self, bin_no: int) -> None:
        room = self.capacity - self.fill[bin_no]
        self.of_room[room].append(bin_no)
        self.rooms |= 1 << room

    def open(self) -> int:
        self.items.append([])
        self.fill.append(0)
        self._put(len(self.fill) - 1)
        return len(self.fill) - 1

    def change(self, bin_no: int, add: list[int], drop: list[int], sizes: list[int]) -> None:
        self._take(bin_no)
        for item in drop:
            self.items[bin_no].remove(item)
        self.items[bin_no].extend(add)
        self.fill[bin_no] += sum(sizes[i] for i in add) - sum(sizes[i] for i in drop)
        self._put(bin_no)


def pack(sizes: list[int], capacity: int, rounds: int = ROUNDS) -> list[list[int]]:
    """Bins (lists of item numbers) of at most ``capacity``; no item is larger.

    Best fit, largest items first. Then a local search over underfull bins: from the emptiest
    bin on, an item moves to the fullest bin that has room, or takes the place of one or two
    smaller items there, wherever that raises the sum of squared fills. Bins that run empty
    go. It ends when a round changes nothing, when no bin can be saved any more (the total
    would not fit in fewer), or after ``rounds`` rounds.
    """
    bins = _Bins(capacity)
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        place = bins.tightest(sizes[item])
        bins.change(bins.open() if place is None else place, [item], [], sizes)
    fewest = -(-sum(sizes) // capacity)
    for _ in range(rounds):
        underfull = sorted((b for b, f in enumerate(bins.fill) if 0 < f < capacity),
                           key=lambda b: bins.fill[b])
        if sum(f > 0 for f in bins.fill) <= fewest or not _improve(bins, underfull, sizes):
            break
    return [items for items in bins.items if items]


def _improve(bins: _Bins, underfull: list[int], sizes: list[int]) -> bool:
    """One pass of moves and exchanges out of the emptiest bins; True if anything changed."""
    changed = False
    for source in underfull[:64]:
        for item in sorted(bins.items[source], key=lambda i: -sizes[i]):
            if not bins.fill[source]:
                break
            changed |= _relocate(bins, underfull, source, item, sizes)
    return changed


def _relocate(bins: _Bins, underfull: list[int], source: int, item: int, sizes: list[int]) -> bool:
    size = sizes[item]
    # Move: the tightest other bin; fill squares grow if it is fuller than what stays behind.
    place = bins.tightest(size)
    if place is not None and place != source and bins.fill[place] + size > bins.fill[source]:
        bins.change(source, [], [item], sizes)
        bins.change(place, [item], [], sizes)
        return True
    for target in reversed(underfull):
        room = bins.capacity - bins.fill[target]
        if target == source or bins.fill[target] <= bins.fill[source]:
            continue
        # Exchange: as many tokens as fit go in; what comes out is smaller and goes back.
        members = sorted(bins.items[target], key=lambda i: sizes[i])
        least = size - room
        one = next((i for i in members if least <= sizes[i] < size), None)
        if one is not None:
            bins.change(source, [one], [item], sizes)
            bins.change(target, [item], [one], sizes)
            return True
        for k, first in enumerate(members):
            second = next((i for i in members[k + 1:] if least <= sizes[first] + sizes[i] < size), None)
            if second is not None:
                bins.change(source, [first, second], [item], sizes)
                bins.change(target, [item], [first, second], sizes)
                return True
    return False


def _group_rows(capacity: int):
    """mapInArrow function: pack the pieces of a partition, GROUP at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        waiting: list[pa.RecordBatch] = []

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal number
            table = pa.Table.from_batches(waiting).combine_chunks()
            lengths = table.column("length").to_pylist()
            sequence = np.zeros(len(lengths), np.int64)
            offset = np.zeros(len(lengths), np.int64)
            for items in pack(lengths, capacity):
                at = 0
                for item in items:
                    sequence[item], offset[item] = number, at
                    at += lengths[item]
                number += 1
            out = table.append_column("sequence_id", pa.array(sequence)).append_column(
                "offset", pa.array(offset))
            waiting.clear()
            yield from out.to_batches()

        for batch in batches:
            for start in range(0, batch.num_rows, GROUP):
                waiting.append(batch.slice(start, GROUP))
                if sum(x.num_rows for x in waiting) >= GROUP:
                    yield from packed()
        if waiting:
            yield from packed()

    return run


def pack_documents(docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id",
                   capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids by the tokenizers file ``tokenizer``, then ``end_id``; a longer
    one than ``capacity`` is cut into pieces of that length, the last may be shorter. Pieces are
    dealt evenly, whatever their ids or sources, into groups of about GROUP, and each group is
    packed by ``pack``. Null and empty texts are one token long; rows that repeat a doc_id are
    packed each on its own; a null doc_id stays null. ``docs`` may hold any other columns.
    """
    pieces = materialise(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .mapInArrow(_piece_rows(tokenizer, capacity, end_id),
                    "doc_id long, piece int, start long, length long, ids_crc32 long"), BATCH_ROWS)
    groups = max(1, round(pieces.count() / GROUP))
    return pieces.repartition(groups).mapInArrow(
        _group_rows(capacity),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
