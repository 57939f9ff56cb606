"""Words, n-grams and their hashes over whole Arrow batches, in numpy.

A word is a run of bytes without space or the control characters 9 to 13. UTF-8
bytes of other characters never equal these, so byte runs and character runs agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once; a longer text is handled alone.
SLICE_BYTES = 512 << 10
#: Positions of a word that get hash values of their own; later ones reuse them, multiplied.
LANES = 64
MAX64 = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (xor-shift and multiply rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(batches: Iterator[pa.RecordBatch], text: str,
                limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Cut batches into runs of rows with about ``limit`` text bytes; null texts become empty."""
    for batch in batches:
        column = pc.fill_null(batch.column(text), "")
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start), column.slice(start, stop - start)
            start = stop
    # A worker goes on to other stages; what Arrow has freed goes back first.
    pa.default_memory_pool().release_unused()


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string array and the n + 1 offsets of its texts."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[texts.offset:texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return body[offsets[0]:offsets[-1]], offsets - offsets[0]


class WordHasher:
    """Hashes words: a sum of random values, one per (byte, position), then mixed."""

    def __init__(self, lower_ascii: bool = False, seed: int = 20240607):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 1 << 64, size=(256, LANES), dtype=np.uint64).ravel()
        self.separator = np.zeros(256, dtype=bool)
        self.separator[[9, 10, 11, 12, 13, 32]] = True
        self.table = np.arange(256, dtype=np.uint8)
        if lower_ascii:
            self.table[65:91] += 32

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, first byte, byte after the last, words per text) of all words in order."""
        body, offsets = raw_bytes(texts)
        inside = ~self.separator[body]
        if not inside.any():
            empty = np.zeros(0, np.int64)
            return np.zeros(0, np.uint64), empty, empty, np.zeros(len(texts), np.int64)
        size = len(body)
        before = np.zeros(size, dtype=bool)
        before[1:] = inside[:-1]
        before[offsets[:-1][offsets[:-1] < size]] = False
        after = np.zeros(size, dtype=bool)
        after[:-1] = inside[1:]
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        starts = np.flatnonzero(inside & ~before)
        stops = np.flatnonzero(inside & ~after) + 1
        lengths = stops - starts
        first = np.zeros(len(starts), np.int64)
        np.cumsum(lengths[:-1], out=first[1:])
        position = (np.arange(first[-1] + lengths[-1], dtype=np.int64)
                    - np.repeat(first, lengths))
        picked = self.values[self.table[body[inside]].astype(np.int64) * LANES
                             + (position & (LANES - 1))]
        if lengths.max() > LANES:
            far = np.flatnonzero(position >= LANES)
            picked[far] *= mix((position[far] // LANES).astype(np.uint64)) | np.uint64(1)
        total = np.add.reduceat(picked, first)
        hashes = mix(total + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        per_text = np.diff(np.searchsorted(starts, offsets))
        return hashes, starts, stops, per_text


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words: one value per start, len(words) - n + 1 of them."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    count = len(words) - n + 1
    total = np.zeros(count, np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    power = factor
    with np.errstate(over="ignore"):
        for i in range(n):
            total = total + words[i:i + count] * power
            power = power * factor
        return mix(total + np.uint64(n))


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """As gram_hashes, for long runs: by doubling, log2(n) passes instead of n."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    done, have, width = None, mix(words + np.uint64(1)), 1
    taken = 0
    while True:
        if n & width:
            if done is None:
                done, taken = have, width
            else:
                count = min(len(done), len(have) - taken)
                done = mix(done[:count] * np.uint64(0x9E3779B97F4A7C15) + have[taken:taken + count])
                taken += width
        width *= 2
        if width > n:
            break
        have = mix(have[:len(have) - width // 2] * np.uint64(0xD6E8FEB86659FD93)
                   + have[width // 2:])
    return done[:len(words) - n + 1]


def window_positions(per_text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of ``n`` words that stay in one text, and their number per text."""
    counts = np.maximum(per_text - n + 1, 0)
    firsts = np.cumsum(per_text) - per_text
    total = int(counts.sum())
    skip = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(firsts - skip, counts), counts
