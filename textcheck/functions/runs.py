"""Arrow helpers for functions that walk over partitions sorted by a key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str],
                ) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches that end where a key ends, and the bounds of the runs of equal keys in each.

    Rows of a run that the next batch goes on with wait for it, so a run is never cut; what is
    held at once is one batch and one run.
    """
    held: list[pa.RecordBatch] = []

    def whole(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    def starts(batch: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for key in keys:
            column = batch.column(key).to_numpy(zero_copy_only=False)
            new[1:] |= column[1:] != column[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if len(held) > 1 and all(held[0].column(k)[0] == batch.column(k)[-1] for k in keys):
            continue
        joined = whole(held)
        bounds = starts(joined)
        cut = int(bounds[-1])
        held = [joined.slice(cut)]
        if cut:
            yield joined.slice(0, cut), bounds
    if held:
        joined = whole(held)
        yield joined, np.append(starts(joined), joined.num_rows)


def list_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list array one after the other, and the n + 1 bounds of its rows."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches with at most ``most`` elements of a list column, or one row."""
    for batch in batches:
        bounds, a = batch.column(column).offsets.to_numpy().astype(np.int64), 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + most, "right")) - 1)
            yield batch.slice(a, b - a)
            a = b


def as_lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
