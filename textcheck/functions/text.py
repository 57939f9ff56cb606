"""Text expressions; everything stays in JVM column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from textcheck.constants import CONTRACTIONS, KEYBOARD_NEIGHBOURS
from textcheck.functions.seeded import hex_number, seeded_digest

# Java leaves U+001C..U+001F out of \s; text splitting counts them as space.
SPACE = r"(?U)[\s\x1C-\x1F]+"
URL = r"(?U)https?://[^\s\x1C-\x1F]+"
TAG = r"(?d)<.*?>"
NOT_ALPHANUMERIC = r"(?U)[^a-zA-Z0-9\s\x1C-\x1F]"
PUNCTUATION = r"[\p{P}\p{S}]"
TOKEN = r"[\p{L}\p{N}_]{2,}"


def clean(text: Column, lowercase: bool = True, strip_urls: bool = True,
          strip_html: bool = True, decontract: bool = True,
          remove_punct: bool = False) -> Column:
    """Normalised text; null becomes the empty string."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    if lowercase:
        out = F.lower(out)
    if strip_urls:
        out = F.regexp_replace(out, URL, " ")
    if strip_html:
        out = F.regexp_replace(out, TAG, " ")
    if decontract:
        for short, long in CONTRACTIONS.items():
            out = F.replace(out, F.lit(short), F.lit(long))
    if remove_punct:
        out = F.regexp_replace(out, NOT_ALPHANUMERIC, " ")
    return F.trim(F.regexp_replace(out, SPACE, " "))


def tokens(text: Column, lowercase: bool = True) -> Column:
    """Words of two or more letters, digits or underscores."""
    base = F.coalesce(text, F.lit(""))
    return F.regexp_extract_all(F.lower(base) if lowercase else base, F.lit(TOKEN), F.lit(0))


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once: Spark computes an array again for each
    higher-order function that reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ngrams(words: Column) -> Column:
    """Unigrams followed by bigrams (two neighbours joined by a space)."""
    rest = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(words, F.lit(1), rest), F.slice(words, F.lit(2), rest),
                       lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(words, pairs)


def word_digests(text: Column, seed: int, row_id: Column) -> Column:
    """Array of (word, md5 of seed:row:position); the randomness of the typo modes."""
    words = F.filter(F.split(text, SPACE, -1), lambda w: w != "")
    return F.transform(words, lambda w, p: F.struct(
        w.alias("word"), seeded_digest(seed, row_id, p).alias("digest")))


def typo_swap(digests: Column) -> Column:
    """Swap two neighbouring characters in every word of two or more characters."""
    placed = F.transform(digests, lambda d: F.struct(
        d["word"].alias("word"),
        F.when(F.length(d["word"]) >= 2,
               F.pmod(hex_number(d["digest"], 1, 8), F.length(d["word"]) - 1))
        .cast("int").alias("at")))

    def swap(entry: Column) -> Column:
        word, at = entry["word"], entry["at"]
        swapped = F.concat(word.substr(F.lit(1), at), word.substr(at + 2, F.lit(1)),
                           word.substr(at + 1, F.lit(1)),
                           word.substr(at + 3, F.length(word)))
        return F.when(at.isNull(), word).otherwise(swapped)

    return F.array_join(F.transform(placed, swap), " ")


def typo_keyboard(digests: Column) -> Column:
    """Replace one character of every word by a neighbouring key, if it has one."""
    keys = F.create_map(*[F.lit(x) for pair in KEYBOARD_NEIGHBOURS.items() for x in pair])

    def place(entry: Column) -> Column:
        word, digest = entry["word"], entry["digest"]
        at = F.pmod(hex_number(digest, 1, 8), F.length(word)).cast("int")
        return F.struct(word.alias("word"), at.alias("at"),
                        hex_number(digest, 9, 8).alias("pick"))

    def look_up(entry: Column) -> Column:
        near = keys[F.lower(entry["word"].substr(entry["at"] + 1, F.lit(1)))]
        return F.struct(entry["word"].alias("word"), entry["at"].alias("at"),
                        entry["pick"].alias("pick"), near.alias("near"))

    def press(entry: Column) -> Column:
        word, at, near = entry["word"], entry["at"], entry["near"]
        key = near.substr(F.pmod(entry["pick"], F.length(near)).cast("int") + 1, F.lit(1))
        typed = F.concat(word.substr(F.lit(1), at), key, word.substr(at + 2, F.length(word)))
        return F.when(near.isNull(), word).otherwise(typed)

    return F.array_join(F.transform(F.transform(F.transform(digests, place), look_up), press), " ")
