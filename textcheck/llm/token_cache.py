"""Token ids of whole texts, with a bounded cache of the chunks between blanks."""

from __future__ import annotations

import os
import sys
from array import array
from functools import lru_cache

#: Bytes of chunks kept at once, those of the objects around a chunk, and the longest one kept.
CACHED_BYTES, ENTRY_BYTES, LONGEST = 256 << 20, 160, 64
#: Texts on which the short way for plain words must agree with the tokenizer, or it is not used.
PROBES = ("The naïve École, straße.", "ÅNGSTRÖM ñandú. a, b ªº µ", "x.\ny")


class ChunkEncoder:
    """Encodes texts with a tokenizers file whose tokens never span a blank or line end.

    Holds for tokenizers that drop white space when they split (as word_bpe_49k.json does): the
    ids of a text are then those of its chunks, one after the other. A chunk of letters up to
    U+00FF, with a full stop or comma behind, is lower-cased and goes straight to the merges of
    the tokenizer's model, as its normalizer and splitter do nothing else to it; every other chunk
    goes through the whole tokenizer, and a text that holds an added token (such as
    ``<|endoftext|>``) does so as a whole. ``encode`` gives little-endian unsigned 16-bit ids; a
    larger vocabulary is refused. When the cache has half of its bytes, it becomes the older half:
    chunks that come again move on, the others go with it.
    """

    def __init__(self, path: str, cached_bytes: int = CACHED_BYTES):
        # A task has one core; threads of the library would each keep memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids do not fit 16 bits")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        spelling = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelled = str.maketrans({c: spelling.pre_tokenize_str(c)[0][0] for c in map(chr, range(33, 256))})
        self.model = self.tokenizer.model
        self.cache: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.old_cache: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.held, self.cached_bytes, self.plain = 0, cached_bytes, True
        probes = self._library(list(PROBES))
        self.plain = self.encode(list(PROBES)) == probes
        self.cache.clear()

    def _library(self, texts: list[str]) -> list[bytes]:
        return [_packed(x.ids) for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _word(self, letters: str) -> bytes:
        ids = self.words.get(letters)
        if ids is None:
            ids = self.old_words.get(letters)
            if ids is None:
                ids = _packed([x.id for x in self.model.tokenize(letters.translate(self.spelled))])
            self.words[letters] = ids
            self.held += len(letters) + ENTRY_BYTES
        return ids

    def _chunk(self, chunk: str) -> bytes | None:
        """Ids of letters up to U+00FF with a full stop or comma at most; None for all else."""
        stem, mark = (chunk[:-1], chunk[-1]) if chunk[-1:] in (".", ",") else (chunk, "")
        if not stem.isalpha() or max(stem) > "\u00ff":
            return None
        return self._word(stem.lower()) + (self._word(mark) if mark else b"")

    def _fill(self, ids: dict[str, bytes | None]) -> None:
        """The ids of the chunks that have none yet, which go into the cache if they are short."""
        cache, old, rest, held = self.cache, self.old_cache, [], 0
        for chunk in [c for c, found in ids.items() if found is None]:
            if len(chunk) <= LONGEST:
                found = old.get(chunk)
                if found is None and self.plain:
                    found = self._chunk(chunk)
                if found is not None:
                    ids[chunk] = cache[chunk] = found
                    held += len(chunk) + ENTRY_BYTES
                    continue
            rest.append(chunk)
        for start in range(0, len(rest), 10_000):
            some = rest[start:start + 10_000]
            for chunk, found in zip(some, self._library(some)):
                ids[chunk] = found
                if len(chunk) <= LONGEST:
                    cache[chunk] = found
                    held += len(chunk) + ENTRY_BYTES
        self.held += held

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.held > self.cached_bytes // 2:
            self.old_cache, self.cache, self.old_words, self.words = self.cache, {}, self.words, {}
            self.held = 0
        whole = [i for i, text in enumerate(texts) if any(t in text for t in self.added)]
        split = [text.replace("\n", " ").split(" ") for text in texts]
        for i in whole:
            split[i] = []
        # The chunks of these texts in a small table: the cache is looked up once for each.
        chunks = set().union(*split)
        known = dict(zip(chunks, map(self.cache.get, chunks)))
        self._fill(known)
        ids = [b"".join(map(known.__getitem__, some)) for some in split]
        for i, found in zip(whole, self._library([texts[i] for i in whole])):
            ids[i] = found
        return ids


@lru_cache(maxsize=1)
def shared_encoder(path: str, cached_bytes: int = CACHED_BYTES) -> ChunkEncoder:
    """The encoder of this worker: its tokenizer and cache outlast a task."""
    return ChunkEncoder(path, cached_bytes)


def _packed(ids: list[int]) -> bytes:
    out = array("H", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()
