"""Document fingerprints by I-Match over randomised subsets of a lexicon of mid-frequency terms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textcheck.llm.words import WordHasher, mix, text_slices

#: Random subsets of the lexicon for which a document has a hash, and levels of their size: at
#: level i a subset holds 1 in SUBSETS * 2**i terms, so that texts of any length find a level
#: at which a subset holds about one of their terms.
SUBSETS, LEVELS = 64, 3
#: Text bytes that one block of neighbouring documents holds, about.
BLOCK_BYTES = 16 << 20


class Lexicon:
    """Hashes of the terms within the band, sorted."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.zeros(len(hashes), bool)
        place = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return self.terms[place] == hashes


def _document_terms(hashes: np.ndarray, per_text: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct term hashes of each text."""
    ends = np.cumsum(per_text)
    return [np.unique(hashes[b - n:b]) for b, n in zip(ends, per_text)]


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms with the number of documents that hold them, added up within batches."""
    hasher = WordHasher(lower_ascii=True)
    for _, texts in text_slices(batches, "text", 16 << 20):
        parts = []
        for start in range(0, len(texts), 512):
            hashes, _, _, per_text = hasher.words(texts.slice(start, 512))
            parts += _document_terms(hashes, per_text)
        terms, counts = np.unique(np.concatenate(parts), return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms.view(np.int64)), pa.array(counts.astype(np.int64))], ["term", "n"])


def fit_lexicon(docs: DataFrame, text: str = "text", least_share: float = 0.001,
                most_share: float = 0.2, most_terms: int = 2_000_000) -> Lexicon:
    """Terms whose share of documents lies in [least_share, most_share]: an idf band.

    Terms are the lower-cased (A-Z) words of a text. As each document counts once per term, at
    most (mean terms of a document) / least_share terms can lie in the band, however large the
    table: that bounds what is broadcast. Where documents are so long that this exceeds
    ``most_terms``, least_share is raised to keep to it.
    """
    counts = docs.select(F.col(text).alias("text")).mapInArrow(_term_rows, "term long, n long").groupBy(
        "term").agg(F.sum("n").alias("n"))
    total = docs.count()
    least = max(least_share * total, 2)
    in_band = counts.where(f"n >= {least} and n <= {max(most_share * total, 2)}")
    size = in_band.agg(F.count("*"), F.sum("n")).first()
    if size[0] > most_terms:
        least = size[1] / most_terms
        in_band = in_band.where(f"n >= {least}")
    terms = in_band.select("term").toPandas()["term"].to_numpy(np.int64).view(np.uint64)
    return Lexicon(np.sort(terms))


def _fingerprint(terms: np.ndarray, lexicon: Lexicon) -> str:
    """``level:whole:hashes``; hashes of two hex digits, SUBSETS for each of LEVELS levels.

    The terms in the band (all terms, if none is) are sorted and distinct. ``whole`` hashes all
    of them; a subset's hash adds those of its terms, and an empty subset is ``00``.
    """
    inside = terms[lexicon.holds(terms)]
    if not len(inside):
        inside = terms
    if not len(inside):
        return "-"
    place = np.arange(1, len(inside) + 1, dtype=np.uint64)
    whole = mix(inside * place).sum(dtype=np.uint64)
    level = max(0, int(np.ceil(np.log2(len(inside) / SUBSETS))))
    dealt = mix(inside ^ np.uint64(0xA0761D6478BD642F))
    spread = mix(inside)
    parts = []
    for i in range(level, level + LEVELS):
        subset = (dealt & np.uint64(SUBSETS * (1 << i) - 1)).astype(np.int64)
        kept = subset < SUBSETS
        found = np.zeros(SUBSETS, np.uint64)
        np.add.at(found, subset[kept], spread[kept])
        parts.append(np.where(found > 0, mix(found) % np.uint64(255) + np.uint64(1), 0).astype(np.uint8).tobytes())
    return f"{level}:{int(whole):016x}:{b''.join(parts).hex()}"


def likeness(a: str, b: str) -> float:
    """Share of equal hashes among the subsets that are not empty in both; 1 for equal fingerprints.

    Compared at the level of the longer text; texts too different in length have likeness 0.
    """
    if a == b:
        return 1.0
    if "-" in (a, b):
        return 0.0
    (level_a, _, hashes_a), (level_b, _, hashes_b) = a.split(":"), b.split(":")
    level = max(int(level_a), int(level_b))
    if level - min(int(level_a), int(level_b)) >= LEVELS:
        return 0.0
    x, y = (np.frombuffer(bytes.fromhex(hashes), np.uint8).reshape(LEVELS, SUBSETS)[level - int(own)]
            for own, hashes in ((level_a, hashes_a), (level_b, hashes_b)))
    held = int(((x > 0) | (y > 0)).sum())
    return float(((x == y) & (x > 0)).sum()) / held if held else 0.0


class Fingerprinter:
    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.hasher = lexicon, WordHasher(lower_ascii=True)

    def of(self, texts: list[str]) -> list[str]:
        out = []
        for batch, column in text_slices(iter([pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.large_string())], ["text"])]), "text"):
            hashes, _, _, per_text = self.hasher.words(column)
            out += [_fingerprint(terms, self.lexicon) for terms in _document_terms(hashes, per_text)]
        return out


def fingerprints(docs: DataFrame, lexicon: Lexicon, text: str = "text",
                 doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fingerprint) of every document. Null and empty texts have the fingerprint ``-``."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Fingerprinter(Lexicon(shared.value))
        for batch, texts in text_slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(maker.of(texts.to_pylist()), pa.string())],
                ["doc_id", "fingerprint"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Blocks of neighbours in descending doc_id: (block, doc_id, text, is_next).

    A block is a range of doc_id of about BLOCK_BYTES; after its rows it holds the first row of
    the next block (``is_next``), the last block that of the first. The cuts come from
    quantiles, one number per block; texts are shuffled once. Null ids come last.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // BLOCK_BYTES))
    cuts = sorted(set(rows.approxQuantile("doc_id", [i / n_blocks for i in range(1, n_blocks)],
                                          0.2 / n_blocks))) if n_blocks > 1 else []
    order = F.col("doc_id").cast("double")
    if cuts:
        placed = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="place",
                            outputCol="block", handleInvalid="keep").transform(
            rows.withColumn("place", F.coalesce(order, F.lit(-float("inf"))))).drop("place")
    else:
        placed = rows.withColumn("block", F.lit(0.0))
    # One row per block: its first document, wanted at the end of the block before (or the last).
    heads = placed.groupBy("block").agg(F.max("doc_id").alias("head"))
    down = Window.orderBy(F.desc("block"))
    heads = heads.select(
        "head", F.coalesce(F.lag("block").over(down), F.min("block").over(Window.partitionBy())).alias("also"))
    also = F.broadcast(heads.where("head is not null").groupBy("head").agg(F.max("also").alias("also")))
    return (placed.join(also, placed["doc_id"] == also["head"], "left")
            .select("doc_id", "text", F.explode(F.when(F.col("also").isNull(), F.array(
                F.struct(F.col("block").alias("block"), F.lit(False).alias("is_next")))).otherwise(F.array(
                    F.struct(F.col("block").alias("block"), F.lit(False).alias("is_next")),
                    F.struct(F.col("also").alias("block"), F.lit(True).alias("is_next"))))).alias("x"))
            .select(F.col("x.block").alias("block"), "doc_id", "text", F.col("x.is_next").alias("is_next")))


def edited_fingerprints(docs: DataFrame, lexicon: Lexicon, text: str = "text",
                        doc_id: str = "doc_id") -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many
    (or all) of the next document, in descending order of doc_id; after the last comes the
    first. Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. Rows that repeat a doc_id follow each other by their texts; a
    single document is its own next one. ``docs`` may hold any other columns.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon.terms)

    def run(table: pa.Table) -> pa.Table:
        import hashlib

        maker = Fingerprinter(Lexicon(shared.value))
        rows = list(zip(*(table.column(c).to_pylist() for c in ("is_next", "doc_id", "text"))))
        rows.sort(key=lambda r: (r[0], r[1] is None, -(r[1] or 0), r[2]))
        own = [r for r in rows if not r[0]]
        # A head that repeats its id has copies; the first in order of text is the next one.
        follow = [r for r in rows if r[0]][:1] or own[:1]
        chain = own + follow
        edited = []
        for (_, _, body), (_, _, after) in zip(chain, chain[1:]):
            half = len(body) // 2
            edited.append(body[:len(body) - half] + after[:half] if half else body)
        prints = maker.of([r[2] for r in chain])
        changed = maker.of(edited)
        return pa.table({
            "doc_id": pa.array([r[1] for r in own], pa.int64()),
            "n_chars": pa.array([len(r[2]) for r in own], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
            "fingerprint": pa.array(prints[:len(own)], pa.string()),
            "edited_fingerprint": pa.array(changed, pa.string()),
            "near_edited": pa.array([likeness(a, b) for a, b in zip(prints, changed)], pa.float64()),
            "near_next": pa.array([likeness(a, b) for a, b in zip(prints, prints[1:])], pa.float64())})

    return with_next(docs, text, doc_id).groupBy("block").applyInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")
