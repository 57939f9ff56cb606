"""Token counts of sections: a document is encoded once, its tokens are joined to character spans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textcheck.llm.byte_bpe import load_ranks
from textcheck.llm.words import text_slices

RULES = ("start", "stop", "largest")


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Character spans of the lines of ``text``; a line end belongs to the line it closes."""
    lengths = np.array([len(x) + 1 for x in text.split("\n")], dtype=np.int64)
    lengths[-1] -= 1
    if lengths[-1] == 0:
        lengths = lengths[:-1]
    stops = np.cumsum(lengths)
    return stops - lengths, stops


def token_spans(body: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character spans of tokens with these numbers of bytes; part of a character counts as it."""
    if not len(lengths):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = np.frombuffer(body, np.uint8)
    character = np.cumsum((raw & 0xC0) != 0x80) - 1
    ends = np.cumsum(lengths)
    return character[ends - lengths], character[ends - 1] + 1


def allocate(starts: np.ndarray, stops: np.ndarray, section_starts: np.ndarray,
             section_stops: np.ndarray, rule: str) -> np.ndarray:
    """The section of each token, -1 for none. Sections are sorted and do not overlap.

    A token inside one section belongs to it. One that crosses a boundary goes by ``rule``:
    to the section with its first character, with its last, or with most of its characters
    (the earlier one of equals). A character between sections belongs to none.
    """
    if not len(section_starts):
        return np.full(len(starts), -1, np.int64)

    def holding(at: np.ndarray) -> np.ndarray:
        place = np.searchsorted(section_starts, at, side="right") - 1
        return np.where((place >= 0) & (at < section_stops[np.maximum(place, 0)]), place, -1)

    first, last = holding(starts), holding(stops - 1)
    if rule == "start":
        return first
    if rule == "stop":
        return last
    owner = first.copy()
    for i in np.flatnonzero((first != last) | (first < 0)):
        a = int(np.searchsorted(section_stops, starts[i], side="right"))
        b = int(np.searchsorted(section_starts, stops[i], side="left"))
        if a < b:
            shared = (np.minimum(section_stops[a:b], stops[i])
                      - np.maximum(section_starts[a:b], starts[i]))
            owner[i] = a + int(shared.argmax())
    return owner


def section_counts(docs: DataFrame, rank_path: str, pattern: str, text: str = "text",
                   doc_id: str = "doc_id", sections: str | None = None,
                   rule: str = "largest") -> DataFrame:
    """One row per section: doc_id, section (from 0), start, stop, n_tokens.

    Each text is encoded once, as a whole, by the ranks in ``rank_path``, each match of
    ``pattern`` on its own. ``sections`` names a column with an array of (start, stop)
    character spans, in order and without overlap; without it, the lines of the text are its
    sections. Tokens that no section gets are counted in a row with a null section, so that
    the counts of a document add up to its tokens. ``rule``: see ``allocate``. A null or empty
    text has no tokens, and rows only where ``sections`` gives it some. Rows that repeat stay
    apart; ``docs`` may hold any other columns.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    spans = F.lit(None).cast("array<struct<start:long,stop:long>>") if sections is None else F.col(sections)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       spans.alias("sections"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = load_ranks(rank_path)
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            width[rank] = len(token)
        for batch, texts in text_slices(batches, "text"):
            owners, numbers, begins, ends, counts = [], [], [], [], []
            given = None if sections is None else batch.column("sections").to_pylist()
            for i, body in enumerate(texts.to_pylist()):
                ids = np.array(encoding.encode_ordinary(body), np.int64)
                starts, stops = token_spans(body.encode(), width[ids])
                if given is None:
                    a, b = line_spans(body)
                else:
                    a, b = (np.array([s[k] for s in given[i] or []], np.int64) for k in ("start", "stop"))
                owner = allocate(starts, stops, a, b, rule)
                found = np.bincount(owner + 1, minlength=len(a) + 1)
                outside = int(found[0] > 0)
                owners.append(np.full(len(a) + outside, i))
                numbers.append(np.concatenate([np.arange(len(a)), np.full(outside, -1)]))
                begins.append(np.concatenate([a, np.zeros(outside, np.int64)]))
                ends.append(np.concatenate([b, np.zeros(outside, np.int64)]))
                counts.append(np.concatenate([found[1:], found[:1][:outside]]))
            owner, number, begin, end, count = (
                np.concatenate(x).astype(np.int64) for x in (owners, numbers, begins, ends, counts))
            none = number < 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner)), pa.array(number, mask=none),
                 pa.array(begin, mask=none), pa.array(end, mask=none), pa.array(count)],
                ["doc_id", "section", "start", "stop", "n_tokens"])

    return rows.mapInArrow(run, "doc_id long, section long, start long, stop long, n_tokens long")
