"""Hard negatives of anchor vectors by an inverted multi-index with certified windows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textcheck.session import materialise

#: Rows that the codebooks are fitted on (by a hash over all rows), and rounds of the fit. They
#: bear on how many cells a search visits, never on what it returns.
FIT_ROWS, FIT_ROUNDS = 16_384, 8
#: Classes of equal vectors that a cell holds on average, and the most codes of a half.
CELL_ROWS, MOST_CODES = 1_024, 256
#: Classes of a block, and searches that meet one block at once.
BLOCK, CHUNK = 1_024, 256
#: Cells that a search visits in its first round, and the growth from round to round.
FIRST, GROWTH = 16, 8
#: Stands for a row without an id: such a row goes last among ties.
NO_ID = (1 << 63) - 1
FAR = (1 << 62)


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of an Arrow list array as int64; missing components at the end are 0."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` and ``b``, exact within 64 bits."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squared = ((rows * rows).sum(1)[:, None] + (centres * centres).sum(1)[None, :]
               - 2.0 * (rows @ centres.T))
    return np.sqrt(np.maximum(squared, 0.0))


def _fit_half(rows: np.ndarray, codes: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's k-means; a centre without rows moves to the row farthest from its own."""
    rows = rows.astype(np.float64)
    centres = rows[rng.permutation(len(rows))[:codes]].copy()
    for _ in range(FIT_ROUNDS):
        away = _distances(rows, centres)
        nearest = away.argmin(1)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        empty = np.flatnonzero(counts == 0)
        centres[empty] = rows[np.argsort(-away[np.arange(len(rows)), nearest])[:len(empty)]]
    return centres


@dataclass
class MultiIndex:
    """``cells`` (cell, block, label, code, ids): all classes; the two codebooks, the radius of
    each code, and per cell the number of its blocks."""

    cells: DataFrame
    width: int
    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    blocks: np.ndarray


def _assign(books: tuple[np.ndarray, np.ndarray], width: int):
    """mapInArrow function: the nearest code of either half, and its distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("code"), width).astype(np.float64)
            half = width // 2
            away = [_distances(part, book) for part, book in
                    zip((rows[:, :half], rows[:, half:]), books)]
            nearest = [x.argmin(1) for x in away]
            far = [x[np.arange(len(rows)), n] for x, n in zip(away, nearest)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nearest[0] * len(books[1]) + nearest[1], pa.int32()),
                 *map(pa.array, far)], [*batch.schema.names, "cell", "far1", "far2"])

    return run


def fit_index(classes: DataFrame, cell_rows: int = CELL_ROWS) -> MultiIndex | None:
    """Index of all ``classes`` (label, code, ids); None without rows.

    The codebooks are fitted on FIT_ROWS classes; every class is then put into the cell of its two
    nearest codes, and the radius of a code is the largest distance of any row in it. What the
    driver reads is one row per cell (MOST_CODES squared at most) and the sample.
    """
    head = classes.agg(F.count("*").alias("n"), F.max(F.size("code")).alias("width")).first()
    if not head["n"]:
        return None
    width, half = head["width"], head["width"] // 2
    sample = classes.select("code").orderBy(F.xxhash64("code"), "code").limit(FIT_ROWS).toArrow()
    rows = _matrix(sample.column("code"), width)
    codes = int(min(MOST_CODES, max(1, round((head["n"] / cell_rows) ** 0.5)), len(rows)))
    rng = np.random.default_rng(1)
    books = (_fit_half(rows[:, :half], codes, rng), _fit_half(rows[:, half:], codes, rng))
    placed = materialise(classes.mapInArrow(
        _assign(books, width),
        "label long, code array<long>, ids array<long>, cell int, far1 double, far2 double"))
    blocks, radii = np.zeros(codes * codes, np.int64), (np.zeros(codes), np.zeros(codes))
    for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far1").alias("one"),
                                        F.max("far2").alias("two")).collect():
        i, j = divmod(r["cell"], codes)
        blocks[r["cell"]] = -(-r["n"] // BLOCK)
        radii[0][i], radii[1][j] = max(radii[0][i], r["one"]), max(radii[1][j], r["two"])
    counted = classes.sparkSession.createDataFrame(
        [(i, n) for i, n in enumerate(blocks.tolist()) if n], "cell int, blocks long")
    cells = placed.join(F.broadcast(counted), "cell").select(
        "cell", F.pmod(F.xxhash64("label", "code"), "blocks").cast("int").alias("block"),
        "label", "code", "ids")
    return MultiIndex(cells, width, books, radii, blocks)


def _visits(high: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[float, int, int]]:
    """Cells by decreasing sum of two half bounds: (sum, code of the first, of the second half)."""
    one, two = (np.argsort(-x, kind="stable") for x in high)
    a, b = high[0][one].tolist(), high[1][two].tolist()
    heap = [(-(a[0] + b[0]), 0, 0)]
    while heap:
        bound, i, j = heappop(heap)
        yield -bound, one[i], two[j]
        # Each (i, j) has one parent: the row above if j is 0, else the place to the left.
        if j == 0 and i + 1 < len(a):
            heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))
        if j + 1 < len(b):
            heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))


def _requests(index: MultiIndex, skip: int, count: int):
    """mapInArrow function: the cells that each search visits next, after ``skip`` earlier ones.

    A cell is asked for if a window could still gain from it: its upper bound is not below the
    window's ``floor`` and its lower bound not above the window's ``hi``. A search ends when no
    later cell can reach any floor; one that goes on is marked by a row with cell -1.
    """
    books, radii, blocks, width = index.books, index.radii, index.blocks, index.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = width // 2
        for batch in batches:
            rows = _matrix(batch.column("code"), width).astype(np.float64)
            parts = (rows[:, :half], rows[:, half:])
            dots = [part @ book.T for part, book in zip(parts, books)]
            reach = [np.linalg.norm(part, axis=1)[:, None] * radius[None, :]
                     for part, radius in zip(parts, radii)]
            # Rounding of the bounds is covered by a margin far above it.
            reach = [r + 1e-9 * (np.abs(d) + r) + 1e-6 for r, d in zip(reach, dots)]
            floors, highs = batch.column("floor").to_pylist(), batch.column("hi").to_pylist()
            row_of, cell_of, block_of = [], [], []
            for k, (floor, high) in enumerate(zip(floors, highs)):
                least = min(floor, default=None)
                seen = 0
                for bound, i, j in _visits((dots[0][k] + reach[0][k], dots[1][k] + reach[1][k])):
                    if least is None or bound < least:
                        break
                    seen += 1
                    if seen <= skip:
                        continue
                    if seen > skip + count:
                        row_of.append(k)
                        cell_of.append(-1)
                        block_of.append(0)
                        break
                    lowest = dots[0][k, i] - reach[0][k, i] + dots[1][k, j] - reach[1][k, j]
                    cell = int(i) * len(books[1]) + int(j)
                    if any(bound >= f and lowest <= h for f, h in zip(floor, high)):
                        n = int(blocks[cell])
                        row_of += [k] * n
                        cell_of += [cell] * n
                        block_of += range(n)
            picked = batch.take(pa.array(row_of, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, pa.array(cell_of, pa.int32()), pa.array(block_of, pa.int32())],
                [*batch.schema.names, "cell", "block"])

    return run


def _meet(width: int, same_label: bool, need: int, n_ids: int):
    """cogroup function: the best classes of one block for each window of up to CHUNK searches."""
    schema = pa.schema([("key", pa.int64()), ("place", pa.int32()), ("loss", pa.int64()),
                        ("ids", pa.list_(pa.int64()))])

    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        if not block.num_rows or not asked.num_rows:
            return schema.empty_table()
        ids = block.column("ids").to_pylist()
        # Ties go to the smallest id, so classes are tried in the order of theirs.
        order = np.array(sorted(range(len(ids)), key=lambda i: ids[i]))
        rows = _matrix(block.column("code"), width)[order]
        labels = block.column("label").to_numpy()[order]
        searched = _matrix(asked.column("code"), width)
        scores = _products(searched, rows)
        fits = (labels[None, :] == asked.column("label").to_numpy()[:, None]) == same_label
        keys = asked.column("key").to_pylist()
        lists = [asked.column(c).to_pylist() for c in ("floor", "hi")]
        out: tuple[list, list, list, list] = ([], [], [], [])
        for k, (key, floors, highs) in enumerate(zip(keys, *lists)):
            inside = np.flatnonzero(fits[k] & (scores[k] >= min(floors)) & (scores[k] <= max(highs)))
            if not len(inside):
                continue
            inside = inside[np.argsort(-scores[k, inside], kind="stable")]
            loss = -scores[k, inside]
            for place, (floor, high) in enumerate(zip(floors, highs)):
                first, stop = np.searchsorted(loss, (-high, -floor + 1))
                for i in range(first, min(stop, first + need)):
                    out[0].append(key)
                    out[1].append(place)
                    out[2].append(int(loss[i]))
                    out[3].append(ids[order[inside[i]]][:n_ids])
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema)], schema=schema)

    return run


def best_classes(searches: DataFrame, index: MultiIndex, same_label: bool, need: int,
                 n_ids: int) -> DataFrame:
    """(key, place, loss, ids): per search and window the ``need`` best classes, exactly.

    ``searches`` has (key, code, label, lo, hi): arrays of windows; a class is in a window if its
    label is equal (``same_label``) or different and lo <= score <= hi. ``loss`` is the score
    negated. Searches visit cells in rounds; after each, a window's floor rises to the score of
    its last class if it has ``need`` of them. Any row of an unvisited cell scores below its bound,
    so a search whose next bound is below all floors is certified. Requests of a cell are dealt
    into chunks and its rows into blocks: no group grows with a popular cell.
    """
    columns = ["key", "code", "label", "lo", "hi", "floor"]
    active = searches.withColumn("floor", F.col("lo")).select(*columns)
    best, skip, count = None, 0, FIRST
    while True:
        asked = materialise(active.mapInArrow(_requests(index, skip, count),
                                              "key long, code array<long>, label long, lo array<long>, "
                                              "hi array<long>, floor array<long>, cell int, block int"))
        visits = asked.where("cell >= 0")
        # One row per cell, MOST_CODES squared at most.
        chunks = F.broadcast(visits.groupBy("cell").agg(
            F.ceil(F.count_distinct("key") / CHUNK).cast("int").alias("chunks")))
        dealt = visits.join(chunks, "cell").withColumn(
            "chunk", F.pmod(F.xxhash64("key"), "chunks").cast("int"))
        copies = index.cells.join(chunks, "cell").withColumn(
            "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        group = ["cell", "block", "chunk"]
        met = copies.select(*group, "label", "code", "ids").groupBy(*group).cogroup(
            dealt.select(*group, "key", "label", "code", "floor", "hi").groupBy(*group)).applyInArrow(
            _meet(index.width, same_label, need, n_ids),
            "key long, place int, loss long, ids array<long>")
        ahead = Window.partitionBy("key", "place").orderBy("loss", "ids")
        merged = met if best is None else met.unionByName(best)
        best = materialise(merged.withColumn("rank", F.row_number().over(ahead))
                           .where(F.col("rank") <= need).drop("rank"))
        going = asked.where("cell < 0").select(*columns)
        if going.isEmpty():
            return best
        last = best.groupBy("key", "place").agg(
            F.count("*").alias("n"), F.max("loss").alias("loss")).where(F.col("n") >= need)
        reached = last.groupBy("key").agg(F.map_from_entries(F.collect_list(
            F.struct("place", -F.col("loss")))).alias("reached"))
        floor = F.transform("lo", lambda lo, i: F.greatest(lo, F.coalesce(F.col("reached")[i], lo)))
        active = going.join(reached, "key", "left").withColumn("floor", floor).select(*columns)
        skip, count = skip + count, count * GROWTH


def hard_negatives(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id",
                   label_col: str = "label", vector_col: str = "embedding", positives: int = 5,
                   negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
                   cell_rows: int = CELL_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exactly.

    Components become floor(scale * x); scores are integer inner products, higher first, ties by
    smaller id. An anchor's positives are its first other rows with its label; each one's
    negatives are the first rows with another label whose score is between ``low`` and ``high``
    percent of the positive's. Rows with a null label, a null vector or a null or non-finite
    component take no part. Vectors of unequal length: missing components are 0. Rows without an
    id come last among ties and are no anchors; equal rows, and rows that repeat an id, are rows of
    their own, also as anchors. Products must fit 64 bits. Other columns are not read.

    Rows with equal components and label are one class with its smallest ids, and equal anchors
    are one search, so copies cost as much as one row; a rank never needs more of a class than
    ``positives`` + 1 ids.
    """
    vector = F.transform(vector_col, lambda x: x.cast("double"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    code = F.transform(vector, lambda x: F.floor(x * scale))
    usable = materialise(rows.where(
        F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(label_col).cast("long").alias("label"), code.alias("code"),
        (F.coalesce(is_anchor, F.lit(False)) & F.col(id_col).isNotNull()).alias("anchor")))
    by_id = Window.partitionBy("label", "code").orderBy("id")
    classes = materialise(usable.select("id", "label", "code").withColumn(
        "n", F.row_number().over(by_id)).where(F.col("n") <= positives + 1).groupBy("label", "code").agg(
        F.array_sort(F.collect_list("id")).alias("ids")))
    shape = ("anchor_id long, positive_id long, rank int, negative_id long, "
             "positive_score long, negative_score long")
    index = fit_index(classes, cell_rows)
    if index is None:
        return rows.sparkSession.createDataFrame([], shape)
    anchors = usable.where("anchor")
    keyed = materialise(anchors.select("label", "code").distinct().withColumn(
        "key", F.monotonically_increasing_id()))
    everything = [F.array(F.lit(x).cast("long")).alias(n) for n, x in (("lo", -FAR), ("hi", FAR))]
    near = best_classes(keyed.select("key", "code", "label", *everything), index, True,
                        positives + 1, positives + 1)
    # At most (positives + 1) squared rows a search.
    members = near.groupBy("key").agg(F.array_sort(F.flatten(F.collect_list(
        F.transform("ids", lambda i: F.struct("loss", i.alias("id")))))).alias("members"))
    members = materialise(members)
    percent = lambda p: F.expr(
        f"transform(scores, s -> ({p} * s - pmod({p} * s, 100L)) div 100L)")
    up = F.expr(f"transform(scores, s -> ({low} * s + pmod(-{low} * s, 100L)) div 100L)")
    windows = members.join(keyed, "key").select(
        "key", "code", "label", F.array_sort(F.array_distinct(
            F.transform("members", lambda m: -m["loss"]))).alias("scores"))
    windows = materialise(windows.withColumns({"lo": up, "hi": percent(high)}))
    far = best_classes(windows, index, False, negatives, negatives)
    order = Window.partitionBy("key", "place").orderBy("loss", "id")
    ranked = far.select("key", "place", "loss", F.explode("ids").alias("id")).withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    scored = ranked.join(windows.select("key", "scores"), "key").select(
        "key", F.col("scores")[F.col("place")].alias("positive_score"), "rank",
        F.col("id").alias("negative_id"), (-F.col("loss")).alias("negative_score"))
    # The anchor itself goes (one row with its id and its product with itself), then the first stay.
    itself = -F.aggregate("code", F.lit(0).cast("long"), lambda total, x: total + x * x)
    own = F.array_position("members", F.struct(itself.alias("loss"), F.col("id").alias("id")))
    others = F.when(own > 0, F.filter("members", lambda _, i: i + 1 != own)).otherwise(F.col("members"))
    pairs = anchors.select("id", "label", "code").join(keyed, ["label", "code"]).join(
        members, "key").select(
        "key", F.col("id").alias("anchor_id"),
        F.inline(F.slice(others, F.lit(1), F.lit(positives)))).select(
        "key", "anchor_id", F.col("id").alias("positive_id"), (-F.col("loss")).alias("positive_score"))
    real = lambda c: F.nullif(c, F.lit(NO_ID))
    return pairs.join(scored, ["key", "positive_score"]).select(
        "anchor_id", real(F.col("positive_id")).alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        real(F.col("negative_id")).alias("negative_id"), "positive_score", "negative_score")
