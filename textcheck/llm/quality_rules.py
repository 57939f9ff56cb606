"""Quality rules: repetition and symbols, then how well public tokenizers fit the text."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textcheck.llm.words import WordHasher, gram_hashes, mix, raw_bytes, text_slices, window_positions

#: Scripts by ranges of code points (first, last); all other letters are "other".
SCRIPTS = ("latin", "greek", "cyrillic", "arabic", "cjk", "other")
RANGES = (
    ("latin", 0x41, 0x24F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x370, 0x3FF),
    ("greek", 0x1F00, 0x1FFF), ("cyrillic", 0x400, 0x52F), ("arabic", 0x600, 0x6FF),
    ("arabic", 0x750, 0x77F), ("cjk", 0x3040, 0x30FF), ("cjk", 0x3400, 0x4DBF),
    ("cjk", 0x4E00, 0x9FFF), ("cjk", 0xAC00, 0xD7AF), ("cjk", 0x20000, 0x323AF),
)
#: Per script: characters per token (least, most), least letters per token, most byte fallback,
#: least token entropy in bits per bit that the number of tokens allows.
BANDS = {
    "latin": (1.3, 8.0, 1.4, 0.10, 0.52), "greek": (0.8, 8.0, 0.7, 0.30, 0.40),
    "cyrillic": (0.8, 8.0, 0.7, 0.20, 0.40), "arabic": (0.6, 8.0, 0.5, 0.40, 0.40),
    "cjk": (0.3, 4.0, 0.2, 0.60, 0.40), "other": (0.2, 8.0, 0.1, 0.95, 0.30),
}
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
CACHED, LONGEST = 250_000, 64
NO_LETTER, UNKNOWN = -1, -2
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens",
            "n_byte_tokens", "n_letters")


def _script(point: int) -> int:
    """The number of a code point's script, or NO_LETTER."""
    if not chr(point).isalpha():
        return NO_LETTER
    return SCRIPTS.index(next((s for s, a, b in RANGES if a <= point <= b), "other"))


class _Fertility:
    """Ids, byte tokens and letters per script of words; short words are kept."""

    def __init__(self, model: str):
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.vocab_size())])
        #: The script of each code point, NO_LETTER, or UNKNOWN until one is met.
        self.scripts = np.full(0x110000, UNKNOWN, np.int8)
        self.kept: dict[str, tuple[bytes, bytes]] = {}
        self.rows: dict[bytes, bytes] = {}

    def _letters(self, words: list[str]) -> np.ndarray:
        """Letters of each script in each word."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        unknown = np.unique(points[self.scripts[points] == UNKNOWN])
        self.scripts[unknown] = [_script(p) for p in unknown.tolist()]
        owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        script = self.scripts[points]
        letter = script >= 0
        size = len(SCRIPTS)
        return np.bincount(owner[letter] * size + script[letter], minlength=len(words) * size).reshape(-1, size)

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and a row per word: tokens, byte tokens, letters of each script.

        Kept as bytes; words with equal rows share one object.
        """
        if len(self.kept) > CACHED:
            self.kept.clear()
            self.rows.clear()
        new = [w for w in words if w not in self.kept]
        fresh: dict[str, tuple[bytes, bytes]] = {}
        found = self.pieces.encode(new, num_threads=1)
        counts = np.fromiter(map(len, found), np.int64, len(new))
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum()))
        rows = np.empty((len(new), 2 + len(SCRIPTS)), np.int64)
        rows[:, 0], rows[:, 1] = counts, _per_text(self.is_byte[ids].astype(np.int64), counts)
        rows[:, 2:] = self._letters(new)
        # All as bytes, cut by word.
        ids, rows, wide = ids.tobytes(), rows.tobytes(), rows.itemsize * rows.shape[1]
        at = 0
        for i, (word, n) in enumerate(zip(new, (4 * counts).tolist())):
            row = rows[i * wide:(i + 1) * wide]
            if len(word) <= LONGEST:
                self.kept[word] = ids[at:at + n], self.rows.setdefault(row, row)
            else:
                fresh[word] = ids[at:at + n], row
            at += n
        entries = [self.kept.get(w) or fresh[w] for w in words]
        return (np.frombuffer(b"".join([x[0] for x in entries]), np.int32),
                np.frombuffer(b"".join([x[1] for x in entries]), np.int64).reshape(-1, 2 + len(SCRIPTS)))


def _per_text(values: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``, of the lengths ``per_text``."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), np.int64), np.cumsum(values, axis=0)])
    ends = np.cumsum(per_text)
    return total[ends] - total[ends - per_text]


def _repeated_words(hashes: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Per text, the words in WINDOW-word windows that occur twice or more in it."""
    starts, counts = window_positions(per_text, WINDOW)
    if not len(starts):
        return np.zeros(len(per_text), np.int64)
    owner = np.repeat(np.arange(len(per_text), dtype=np.uint64), counts)
    keys = gram_hashes(hashes, WINDOW)[starts] ^ mix(owner + np.uint64(1))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, starts[twice], 1)
    np.add.at(change, starts[twice] + WINDOW, -1)
    return _per_text((np.cumsum(change)[:-1] > 0).astype(np.int64), per_text)


def _repeated_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
    return len(lines) - len(set(lines))


def _entropy(ids: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Entropy of the token ids of each text, in bits."""
    owner = np.repeat(np.arange(len(per_text), dtype=np.int64), per_text)
    pairs, counts = np.unique((owner << 32) | ids, return_counts=True)
    text = pairs >> 32
    share = counts / per_text[text]
    return np.bincount(text, weights=-share * np.log2(share), minlength=len(per_text)).astype(float)


def _with_text(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches of ``source`` with its text beside it; the bytes are not copied."""
    for batch in batches:
        source = batch.column("source")
        yield pa.RecordBatch.from_arrays([source, source.flatten()[source.type.get_field_index(text)]],
                                         ["source", "text"])


def _measure_rows(model: str, text: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, fertility = WordHasher(), _Fertility(model)
        symbol, separator = np.zeros(256, bool), np.zeros(256, bool)
        symbol[list(SYMBOLS)] = True
        separator[[9, 10, 11, 12, 13, 32]] = True
        for batch, texts in text_slices(_with_text(batches, text), "text"):
            hashes, starts, stops, per_text = hasher.words(texts)
            body, offsets = raw_bytes(texts)
            lengths = np.diff(offsets)
            chars = _per_text((~separator[body] & ((body & 0xC0) != 0x80)).astype(np.int64), lengths)
            symbols = _per_text(symbol[body].astype(np.int64), lengths)
            _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
            flat = body.tobytes()
            all_ids, rows = fertility.of([flat[starts[i]:stops[i]].decode() for i in first])
            per_word = rows[which]
            sums = _per_text(per_word, per_text)
            id_starts = np.cumsum(rows[:, 0]) - rows[:, 0]
            n = per_word[:, 0]
            at = np.repeat(id_starts[which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            entropy = _entropy(all_ids[at].astype(np.int64), sums[:, 0])
            script = np.array(SCRIPTS)[sums[:, 2:].argmax(axis=1)]
            columns = (per_text, chars, symbols,
                       np.array([_repeated_lines(x) for x in texts.to_pylist()], np.int64),
                       _repeated_words(hashes, per_text), sums[:, 0], sums[:, 1],
                       sums[:, 2:].sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [_kept(batch.column("source"), keep), *(pa.array(c.astype(np.int64)) for c in columns),
                 pa.array(entropy), pa.array(script.tolist(), pa.string())],
                ["source", *MEASURES, "token_entropy", "script"])

    return run


def _kept(source: pa.StructArray, keep: list[str]) -> pa.StructArray:
    if keep == [f.name for f in source.type]:
        return source
    parts = source.flatten()
    return pa.StructArray.from_arrays([parts[source.type.get_field_index(c)] for c in keep], names=keep)


def measure(docs: DataFrame, model: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``source`` (the row of ``docs`` as a struct, or its columns ``keep``) and its measures.

    Words are runs without space and control characters 9 to 13. Each is encoded by the
    sentencepiece file ``model`` on its own; token_entropy is that of a text's ids, script the
    one with most letters (the first of SCRIPTS on ties and without letters).
    """
    keep = docs.columns if keep is None else keep
    packed = docs.select(F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns]).alias("source"))
    schema = T.StructType([
        T.StructField("source", T.StructType([packed.schema["source"].dataType[c] for c in keep])),
        *(T.StructField(c, T.LongType()) for c in MEASURES),
        T.StructField("token_entropy", T.DoubleType()), T.StructField("script", T.StringType())])
    return packed.mapInArrow(_measure_rows(model, text, keep), schema)


def verdict(bands: dict = BANDS) -> tuple:
    """(base_failed, kept) as expressions over the measures.

    ``base_failed``: under 20 words, or over 30 % of the words in repeated windows. ``kept``
    also asks that characters and letters per token, byte share and relative token entropy lie
    in the bands of the text's script.
    """
    n, tokens = F.col("n_words"), F.col("n_tokens")
    failed = (n < 20) | (100 * F.col("n_repeat_words") > 30 * n)
    per_token = F.try_divide(F.col("word_chars"), tokens)
    letters = F.try_divide(F.col("n_letters"), tokens)
    byte_share = F.try_divide(F.col("n_byte_tokens"), tokens)
    relative = F.try_divide(F.col("token_entropy"), F.log2(F.least(tokens, F.lit(4096)).cast("double")))
    inside = F.lit(False)
    for script, (least, most, letters_least, bytes_most, entropy_least) in bands.items():
        inside = inside | ((F.col("script") == script) & per_token.between(least, most)
                           & (letters >= letters_least) & (byte_share <= bytes_most) & (relative >= entropy_least))
    return failed, ~failed & F.coalesce(inside, F.lit(False))


def quality(docs: DataFrame, model: str, text: str = "text", doc_id: str = "doc_id",
            bands: dict = BANDS) -> DataFrame:
    """One row per document: doc_id, the measures, base_failed and kept.

    A null, empty or blank text has no words and fails. Rows that repeat are judged each on
    its own; ``docs`` may hold any other columns.
    """
    failed, kept = verdict(bands)
    return measure(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), model, keep=["doc_id"]).select(
        F.col("source.doc_id").alias("doc_id"), *MEASURES, "token_entropy", "script",
        failed.alias("base_failed"), kept.alias("kept"))


def keep_good(docs: DataFrame, model: str, text: str = "text", bands: dict = BANDS) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    return measure(docs, model, text).where(verdict(bands)[1]).select("source.*")
