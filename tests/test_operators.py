import glob
import math
import os
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark import SparkFiles
from pyspark.sql import functions as F

from textcheck import session
from textcheck.constants import PERTURBATIONS
from textcheck.functions.runs import as_lists
from textcheck.functions.skew import join_by_key
from textcheck.operators import (batch, classify, drift, explain, fairness, features, health, repair, report,
                                 robustness, scoring, similarity, text_pairs, vector_pairs)

WORDS = scoring.LexiconScorer("a/words", ("good", "fine"), ("1", "0"), 0.5)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_profile_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "", 3), (3, None, 0), (4, None, 1), (5, "a", 1),
                                (6, "a", 2), (7, "b", 2)], "id long, t string, n int")
    assert {r["column_name"]: (r["n_null"], r["n_empty"]) for r in health.column_profile(df).collect()} \
        == {"id": (0, 0), "t": (2, 1), "n": (1, 0)}
    assert health.exact_duplicate_count(df, "t").first()[0] == 3
    assert [r["id"] for r in health.duplicate_rows(df, "t", "id").orderBy("id").collect()] == [4, 5, 6]
    assert health.exact_duplicate_count(df.limit(0), "t").first()[0] == 0


def test_label_ties_and_nulls(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("a",)], "l string")
    assert tuple(health.label_extremes(df, "l").first()) == ("a", 2, "a", 2)
    assert {r["l"]: r["fraction"] for r in health.class_balance(df, "l").collect()} == {
        "a": 0.4, "b": 0.4, None: 0.2}


def test_join_by_key_equals_plain_join(spark):
    left = spark.range(3000).select((F.col("id") % 3 * F.col("id") % 500).alias("k"), "id")
    keyed = left.groupBy("k").agg(F.count("*").alias("n"))
    assert rows(join_by_key(left, keyed, "k", "n")) == rows(left.join(keyed, "k"))


def brute_pairs(texts, threshold):
    import re
    docs = [re.findall(r"\w{2,}", t.lower()) for t in texts]
    terms = sorted({w for d in docs for w in d})
    tf = np.array([[d.count(t) for t in terms] for d in docs], dtype=float)
    x = tf * (np.log((1 + len(docs)) / (1 + (tf > 0).sum(0))) + 1)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    x = x / np.where(norm == 0, 1, norm)
    s = x @ x.T
    return {(i, j): s[i, j] for i in range(len(docs)) for j in range(i + 1, len(docs)) if s[i, j] >= threshold}


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.9])
@pytest.mark.parametrize("block", [256, 3])
def test_tfidf_pairs_match_brute_force(spark, threshold, block, monkeypatch):
    monkeypatch.setattr(text_pairs, "BLOCK", block)
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i:02d}" for i in range(30)]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(1, 8))) for _ in range(50)]
    texts += [texts[0]] * 9 + [" ".join(reversed(texts[1].split())), "!!", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    want = brute_pairs(texts, threshold)
    found = similarity.similar_texts(df, "text", "id", threshold)
    assert similarity.pair_count(found).first()[0] == len(want)
    table = {(r["idx1"], r["idx2"]): r["similarity"] for r in similarity.pair_table(found).collect()}
    assert table.keys() <= want.keys()
    assert all(table[k] == pytest.approx(want[k]) for k in table)
    listed = [(r["idx1"], r["idx2"]) for r in similarity.pair_preview(found, 40).collect()]
    assert listed == [k for _, k in sorted((-round(v, 6), k) for k, v in want.items())][:40]
    # Dropping the later row of every pair gives the same rows from both lists.
    later = similarity.later_rows(found)
    for pairs in (similarity.pair_table(found), later):
        kept = {r["id"] for r in repair.apply_dedupe(df, pairs, "id", threshold).collect()}
        assert kept == set(range(len(texts))) - {j for _, j in want}
    for row in later.collect():
        earlier = {i: v for (i, j), v in want.items() if j == row["idx2"]}
        assert row["idx1"] == min(earlier) and row["similarity"] == pytest.approx(max(earlier.values()))
    assert {r["id"]: r["n_links"] for r in similarity.linked_rows(found).collect()} == {
        i: sum(i in k for k in want) for i in range(len(texts))}


def _posting_batch(sizes):
    rng = np.random.default_rng(0)
    n, cut = sum(sizes), np.array(sizes)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(sizes))), as_lists(rng.integers(0, 1 << 60, n), cut),
         as_lists(rng.random(n), cut), as_lists(np.where(rng.random(n) < 0.9, 2, 0), cut)],
        ["rep", "terms", "reach", "lists"])


def test_postings_go_out_in_bounded_batches(monkeypatch):
    batch_in = _posting_batch([300, 0, 1, 2, 500, 40]).slice(1)
    monkeypatch.setattr(text_pairs, "TAIL_TERMS", 1_000, raising=False)
    found = list(text_pairs._posting_rows(iter([batch_in])))
    # A batch has one posting or tails of at most so many terms.
    assert all(b.num_rows == 1 or len(b.column("tail").flatten()) <= 1_000 for b in found)
    got = [(r["term"], r["rep"], r["reach"], r["tail"]) for b in found for r in b.to_pylist()]
    want = []
    for r in batch_in.to_pylist():
        kept = [(t, x) for t, x, n in zip(r["terms"], r["reach"], r["lists"]) if n]
        want += [(t, r["rep"], x, [u for u, _ in kept[i + 1:]]) for i, (t, x) in enumerate(kept)]
    assert got == want


def test_common_terms_are_seated_by_their_postings(spark, monkeypatch):
    """A word of all texts that only short ones index does not spread these over many blocks."""
    monkeypatch.setattr(text_pairs, "BLOCK", 8)
    seats = []
    monkeypatch.setattr(text_pairs, "by_seat", lambda rows, f=text_pairs.by_seat: seats.append(rows) or f(rows))
    texts = ["the of"] + [f"the {' '.join(f'w{i % 40}x{k}' for k in range(9))} u{i}" for i in range(80)]
    found = similarity.similar_texts(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), "text", "id", 0.9)
    postings = seats[0].select("term", "rep").distinct().count()
    assert seats[0].count() == postings
    assert similarity.pair_count(found).first()[0] == len(brute_pairs(texts, 0.9))


def test_templates_give_linear_output(spark):
    rng = np.random.default_rng(5)
    words = [f"t{i}" for i in range(60)]
    texts = [" ".join([*words, f"x{i}"]) for i in range(600)] + [
        " ".join(rng.choice([f"o{i}" for i in range(900)], 40)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = similarity.similar_texts(df, "text", "id", 0.6)
    want = brute_pairs(texts, 0.6)
    assert len(want) >= 600 * 599 / 2
    assert found.links.count() <= 800 and similarity.pair_count(found).first()[0] == len(want)
    assert found.search.seated.where("rep < 600").count() <= 600 * 3
    preview = [(r["idx1"], r["idx2"]) for r in similarity.pair_preview(found, 30).collect()]
    assert preview == [k for _, k in sorted((-round(v, 6), k) for k, v in want.items())][:30]


@pytest.mark.parametrize("terms, spread", [(1 << 21, 6), (40, 1)])
def test_text_pairs_over_many_tiles(spark, terms, spread, monkeypatch):
    """Long texts, near copies and short ones: the pairs of brute force, from pieces of bounded size."""
    for name, value in (("BLOCK_TERMS", terms), ("LEAST_TERMS", 8), ("SPREAD", spread)):
        monkeypatch.setattr(text_pairs, name, value)
    rng = np.random.default_rng(8)
    words = np.array([f"w{i}" for i in range(400)])
    share = 1 / np.arange(3, 403)
    texts = [" ".join(rng.choice(words, n, p=share / share.sum())) for n in [3, 6] * 8 + [900, 1500] * 4 + [60] * 6]
    texts += [" ".join(t.split()[:-1 - i % 3]) for i, t in enumerate(texts[16:])] + [f"{t} w399 new{i}" for i, t in enumerate(texts[16:24])]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for threshold in (0.5, 0.9):
        want = brute_pairs(texts, threshold)
        found = similarity.similar_texts(df, "text", "id", threshold)
        table = {(r["idx1"], r["idx2"]): r["similarity"] for r in similarity.pair_table(found).collect()}
        copies = {k for k, v in want.items() if texts[k[0]] == texts[k[1]]}
        assert table.keys() | copies == want.keys() and len(want) > 20
        assert all(table[k] == pytest.approx(want[k]) for k in table)
        assert found.search.seated.where(F.size("term") > text_pairs.PIECE).count() == 0
    assert {r["id"]: r["n_links"] for r in similarity.linked_rows(found).collect()} == {
        i: sum(i in k for k in want) for i in range(len(texts))}


def test_rows_that_repeat_an_id_are_no_closer_than_equal(spark):
    texts = [(1, "aa bb cc dd ee ff"), (1, "aa bb cc dd ee ff"), (2, "aa bb cc dd ee ff aa"), (2, "aa bb cc dd ee ff aa"),
             (3, "xx yy zz"), (4, "zz yy xx"), (5, "xx yy zz ww")]
    found = similarity.similar_texts(spark.createDataFrame(texts, "id long, text string"), "text", "id", 0.4)
    near = {(r["idx1"], r["idx2"]): r["similarity"] for r in found.near.collect()}
    assert near.keys() >= {(1, 2), (3, 5)} and max(near.values()) <= 1.0


def test_a_tile_is_worked_off_in_steps(monkeypatch):
    """Pieces of the vectors, put together again, give the same pairs and products however few are held at once."""
    rng = np.random.default_rng(2)
    sizes = np.array([40, 3, 17, 40, 1, 25] * 3)
    terms = np.concatenate([rng.choice(60, n, replace=False) for n in sizes])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((terms, owner))
    x = (1 / np.sqrt(sizes))[owner]
    reach = np.sqrt(np.concatenate([np.arange(1, n + 1) / n for n in sizes]))
    whole = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(sizes))), *[pa.array([0 + i // 9 * (c == "own") for i in range(len(sizes))], pa.int32()) for c in ("lo", "own")],
         *[as_lists(v, sizes) for v in (terms[order], x, reach, np.where(reach >= 0.5, 2, 0), 1000 - terms[order])]],
        ["rep", "lo", "own", "terms", "x", "reach", "lists", "seen"])
    dense = np.zeros((len(sizes), 60))
    dense[owner, terms] = x
    for piece, products, pairs in ((128, 1 << 21, 1 << 19), (7, 50, 9)):
        for name, value in (("PIECE", piece), ("PRODUCTS", products), ("PAIRS", pairs)):
            monkeypatch.setattr(text_pairs, name, value)
        for two in (False, True):
            parts = pa.Table.from_batches(text_pairs._piece_rows(True, "rep", "lo", "own")(iter([whole])))
            assert max(len(t) for t in parts.column("term").to_pylist()) <= piece
            tile = text_pairs._Tile(0.5, two, parts.combine_chunks().to_batches()[0])
            found = {}
            for one, other in text_pairs._joined(tile.pairs()):
                found |= dict(zip(zip(one.tolist(), other.tolist()), tile.cosines(one, other).tolist()))
            near = dense @ dense.T
            want = {(i, k) for i in range(18) for k in range(i + 1, 18) if near[i, k] >= 0.5 and (not two or i < 9 <= k)}
            assert want and want <= found.keys() and all(i < k and (not two or i < 9 <= k) for i, k in found)
            assert all(v == pytest.approx(near[k]) for k, v in found.items())


def test_a_tile_holds_one_block_and_lets_the_other_pass_by():
    """Links come out before the last batch of a tile is read, so its second block is never held whole."""
    sizes = np.full(42, 20)
    terms = np.concatenate([np.arange(20) + 100 * (i % 2) for i in range(42)])
    reach = np.sqrt(np.tile(np.arange(1, 21) / 20, 42))
    whole = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(42)), *[pa.array(np.full(42, n)) for n in (1, 0)],
         *[pa.array(v, pa.int32()) for v in ([0] * 42, [1] * 42, [0] * 2 + [1] * 40)],
         *[as_lists(v, sizes) for v in (terms, np.full(840, 1 / np.sqrt(20)), reach, np.where(reach >= 0.9, 2, 0), 1000 - terms)]],
        ["rep", "copies", "train_rows", "lo", "hi", "own", "terms", "x", "reach", "lists", "seen"])
    keys = ("rep", "copies", "train_rows", "lo", "hi", "own")
    rows = pa.Table.from_batches(text_pairs._piece_rows(True, *keys)(iter([whole]))).combine_chunks().to_batches()[0]
    for step, names in ((text_pairs._match_rows(0.9, similarity._listed), ("idx1", "idx2")),
                        (text_pairs._candidate_rows(0.9), ("rep", "own"))):
        read, found = 0, []

        def batches():
            nonlocal read
            for a in range(rows.num_rows):
                read += 1
                yield rows.slice(a, 1)

        for batch in step(batches()):
            assert found or read < 10 or not batch.num_rows
            found += zip(*(batch.column(c).to_pylist() for c in names))
        want = [(i % 2, i) for i in range(2, 42)] if names[0] == "idx1" else [(i, int(i > 1)) for i in range(42)]
        assert sorted(found) == sorted(want)


def test_long_texts_are_not_sent_term_by_term(spark):
    """60 long texts that share rare words, none of them alike; each was sent whole to the lists of these."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choice(words, 900)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = similarity.similar_texts(df, "text", "id", 0.9)
    # With one block a text goes out once, or not at all.
    assert found.search.seated.agg(F.sum(F.size("term"))).first()[0] <= sum(len(set(t.split())) for t in texts)
    assert similarity.pair_count(found).first()[0] == 0


def test_a_cell_of_vectors_is_sent_once_and_compared_in_steps(spark, monkeypatch):
    """2,500 vectors are one block, which meets itself once; few of its products are held at once."""
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(2500, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, v array<double>")
    found = similarity.similar_vectors(df, "v", "id", threshold=0.99)
    assert found.search.packed.count() == 1 and found.search.near.count() == 1
    met = found.search.near.join(found.search.packed, [F.col("cell1") == F.col("cell"), F.col("block1") == F.col("block")])
    monkeypatch.setattr(vector_pairs, "COMPARED", 7 * 2500)
    names = ("cell", "block", "reps", "copies", "train_rows", "matrix")
    batch = met.select(*[F.col(c).alias(f"{c}{k}") for k in "12" for c in names]).toArrow().combine_chunks().to_batches()[0]
    parts = list(vector_pairs._block_matches(0.99, similarity._listed)(iter([batch])))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    want = set(zip(*np.nonzero(np.triu(unit @ unit.T >= 0.99, 1))))
    assert len(parts) > 100 and len(want) > 300
    assert {p for b in parts for p in zip(*(b.column(c).to_pylist() for c in ("idx1", "idx2")))} == want
    assert {(r["idx1"], r["idx2"]) for r in found.near.collect()} == want


@pytest.mark.parametrize("cell_rows, block", [(4096, 2000), (25, 7)])
def test_embedding_pairs_match_brute_force(spark, cell_rows, block, monkeypatch):
    monkeypatch.setattr(vector_pairs, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(vector_pairs, "BLOCK", block)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 5))
    v = centres[rng.integers(0, 6, 150)] + rng.normal(scale=0.3, size=(150, 5))
    v[20], v[30], v[40] = v[10], v[10], 0.0
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    unit = v / np.where(np.linalg.norm(v, axis=1, keepdims=True) == 0, 1, np.linalg.norm(v, axis=1, keepdims=True))
    s = unit @ unit.T
    want = {(i, j) for i in range(150) for j in range(i + 1, 150) if s[i, j] >= 0.95}
    found = similarity.similar_vectors(df, "v", "id", threshold=0.95)
    assert similarity.pair_count(found).first()[0] == len(want)
    near = [(r["idx1"], r["idx2"]) for r in found.near.collect()]
    assert len(near) == len(set(near)) and set(near) <= want


@pytest.mark.parametrize("threshold", [0.9, 0.95])
def test_hash_tables_find_nearly_all(spark, threshold):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(150, 24))
    v = np.concatenate([centres + rng.normal(scale=s, size=centres.shape) for s in (0, 0.2, 0.35, 0.45)])
    v[40] = v[41]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    exact = {(r["idx1"], r["idx2"]) for r in similarity.similar_vectors(df, "v", "id", threshold=threshold).near.collect()}
    found = similarity.hashed_vectors(df, "v", "id", threshold=threshold)
    listed = [(r["idx1"], r["idx2"]) for r in found.near.collect()]
    assert len(listed) == len(set(listed)) and set(listed) <= exact
    assert len(exact) > 100 and len(listed) >= 0.95 * len(exact)
    assert found.links.count() <= len(v)


def test_hash_keys_grow_with_the_vectors(spark, monkeypatch):
    """Vectors of a key stay as few, and the pairs found as many, however many vectors there are."""
    assert [vector_pairs.key_bits(n) for n in (1, 1 << 14, 1 << 20)] == [12, 12, 18]
    assert vector_pairs.least_tables(0.95, 12) <= 20 < vector_pairs.least_tables(0.9, 18)
    monkeypatch.setattr(vector_pairs, "KEY_ROWS", 1 / 64)
    rng = np.random.default_rng(2)
    v = rng.normal(size=(300, 24))
    v = np.concatenate([v, v + rng.normal(scale=0.2, size=v.shape)])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    exact = {(r["idx1"], r["idx2"]) for r in similarity.similar_vectors(df, "v", "id", threshold=0.95).near.collect()}
    found = similarity.hashed_vectors(df, "v", "id", threshold=0.95)
    listed = [(r["idx1"], r["idx2"]) for r in found.near.collect()]
    assert found.search.bits == 17 and len(listed) == len(set(listed)) and set(listed) <= exact
    assert len(exact) > 100 and len(listed) >= 0.99 * len(exact)


def test_empty_tables_have_no_pairs(spark):
    none = spark.createDataFrame([], "id long, text string, v array<double>")
    for found in (similarity.similar_texts(none, "text", "id"), similarity.similar_vectors(none, "v", "id"),
                  similarity.hashed_vectors(none, "v", "id")):
        assert similarity.pair_table(found).count() == 0 and similarity.pair_count(found).first()[0] == 0
        assert similarity.linked_rows(found).count() == 0 and similarity.pair_preview(found).count() == 0


def test_leakage(spark):
    df = spark.createDataFrame([(1, "aa bb cc", True), (2, "aa bb cc", False), (3, "CC bb aa!", False),
                                (4, "dd ee", False)], "id long, text string, is_train boolean")
    pairs = similarity.leakage_pairs(df, "text", "id").collect()
    assert [(r["idx1"], r["idx2"], r["n_leaks"]) for r in pairs] == [(1, 1, 2)]
    assert [r["id"] for r in similarity.leakage_free_test(df, "text", "id").collect()] == [4]


def test_scores(spark):
    df = spark.createDataFrame([(1, "Good fine bad bad"), (2, "!"), (3, None)], "id long, text string")
    assert rows(WORDS.predict(df, "text").select("id", "y_prob", "y_pred")) == [(1, 0.5, 1), (2, 0.0, 0), (3, 0.0, 0)]
    named = scoring.LexiconScorer("t", ("bad",), ("non-toxic", "toxic"))
    assert rows(scoring.score_toxicity(df, "text", named).select("id", "toxicity"))[0] == (1, 0.5)
    # Substring matching also accepts the first label.
    loose = scoring.score_toxicity(df, "text", named, contains=True).select("id", "toxicity")
    assert rows(loose)[1] == (2, 0.0)
    assert rows(scoring.score_toxicity(df, "text", named, label="absent").select("toxicity")) == [(0.0,)] * 3
    scored = scoring.score_identity(df, "text", [WORDS])
    assert "words_score" in scored.columns and rows(scored.select("words_score"))[0] == (0.5,)


PREDICTIONS = {
    "never predicted": ([0, 1, 1, 2], [0, 1, 1, 1]), "perfect": ([0, 1], [0, 1]), "constant": ([0, 1, 1], [1, 1, 1]),
}


@pytest.mark.parametrize("case", PREDICTIONS)
def test_classification_report(spark, case):
    truth, guess = map(np.array, PREDICTIONS[case])
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(truth, guess)], "y_true int, y_pred int")
    got = {r["label"]: r for r in classify.classification_report(df).collect()}
    f1s, supports = [], []
    for label in sorted(set(truth) | set(guess)):
        hits = ((truth == label) & (guess == label)).sum()
        f1 = 2 * hits / ((truth == label).sum() + (guess == label).sum())
        assert got[str(label)]["f1_score"] == pytest.approx(f1)
        f1s.append(f1)
        supports.append((truth == label).sum())
    assert got["macro avg"]["f1_score"] == pytest.approx(np.mean(f1s))
    weighted = np.average(f1s, weights=supports)
    assert got["weighted avg"]["f1_score"] == pytest.approx(weighted)
    assert classify.weighted_f1(df).first()[0] == pytest.approx(weighted)
    assert got["accuracy"]["recall"] == pytest.approx((truth == guess).mean())


def test_keywords_and_slices(spark):
    texts = ["he", "the", "She,", "ñhe", "he-man", None]
    df = spark.createDataFrame([(i, t, 0, 1) for i, t in enumerate(texts)],
                               "id int, text string, y_true int, y_pred int")
    tagged = fairness.tag_protected(df, "text")
    assert [r["is_protected"] for r in tagged.orderBy("id").collect()] == [True, False, True, False, True, False]
    metrics = {r["slice"]: r for r in fairness.group_metrics(tagged).collect()}
    assert metrics["protected"]["tpr"] == 0.0 and metrics["protected"]["accuracy"] == 0.0
    empty = fairness.group_metrics(tagged.filter("is_protected"))
    assert {r["slice"]: r["accuracy"] for r in empty.collect()}["non_protected"] is None
    assert tuple(fairness.fairness_gaps(empty).first()) == (None, None, None)


def test_constant_predictions_have_no_attribute_gap(spark):
    df = spark.createDataFrame([(1, 0, 1), (0, 0, 1), (1, 1, 1), (0, 1, 1), (1, 1, 1)], "y int, a int, p int")
    got = fairness.attribute_fairness(df, "y", "p", "a").first()
    assert tuple(got)[:4] == (0.0, 1.0, 0.0, 0.0) and got["error_rate_difference"] == pytest.approx(0.5 - 1 / 3)


def test_perturbations(spark):
    texts = ["a", "12 345", "ñandú straße", "...!?", "two   words\n", "İx"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {}
    for r in robustness.perturb_all(df, "text", "id", (*PERTURBATIONS, "unknown")).collect():
        got.setdefault(r["perturb"], {})[r["id"]] = r["perturbed_text"]
    assert got["unknown"] == dict(enumerate(texts))
    assert got["upper"][2] == "ÑANDÚ STRASSE" and got["no_punc"][3] == "     "
    assert got["extra_ws"][4] == "two   words   " and got["typo_swap"][0] == "a"
    for i, text in enumerate(texts):
        words = text.split()
        for mode in ("typo_swap", "typo_keyboard"):
            changed = got[mode][i].split(" ") if words else []
            assert [len(w) for w in changed] == [len(w) for w in words]
        assert [sorted(w) for w in got["typo_swap"][i].split()] == [sorted(w) for w in words]
    assert got["typo_keyboard"][1] == "12 345"
    single = robustness.perturb(df, "text", "id", "typo_swap").collect()
    assert {r["id"]: r["perturbed_text"] for r in single} == got["typo_swap"]


def test_robustness(spark):
    df = spark.createDataFrame([(1, "good x1", 1), (2, None, 1), (3, "bad x2", 0)], "id long, t string, y int")
    upper = scoring.LexiconScorer("w", ("good",), lowercase=False)
    details = robustness.robustness_details(df, "t", "y", "id", upper)
    summary = {r["perturb"]: r for r in robustness.robustness_summary(details).collect()}
    assert details.count() == 12 and summary["upper"]["flip_rate"] == 0.5
    assert summary["lower"]["flip_rate"] == 0.0 and summary["upper"]["avg_conf_change"] == 0.25


def test_linear_importance_equals_dense(spark):
    x = np.array([[0.5, 0.0, 0.1], [0.0, 0.2, 0.3], [0.4, 0.4, 0.0], [0.0, 0.0, 0.0]])
    c = np.array([2.0, -1.0, 0.5])
    weights = spark.createDataFrame([(i, f"t{j}", float(x[i, j])) for i in range(4) for j in range(3) if x[i, j]],
                                    "id long, term string, weight double")
    coefficients = spark.createDataFrame([(f"t{j}", float(c[j])) for j in range(3)], "term string, coefficient double")
    want = np.abs(c * (x - x.mean(0))).mean(0)
    got = {r["term"]: r["importance"] for r in explain.linear_importance(weights, coefficients, 4).collect()}
    assert [got[f"t{j}"] for j in range(3)] == pytest.approx(want)


def test_occlusion_forms_agree(spark):
    df = spark.createDataFrame([(1, "good bad bad ok fine"), (2, "good")], "id long, text string")
    general = explain.token_occlusion(df, "text", "id", WORDS).select("id", "token", "prob_without", "rank")
    additive = explain.lexicon_occlusion(df, "text", "id", WORDS).select("id", "token", "prob_without", "rank")
    assert rows(general) == rows(additive)


@pytest.fixture(scope="module")
def trained(spark):
    texts = ["good film really good", "bad film really bad", "good plot", "bad plot", "fine good", "poor bad"] * 4
    df = spark.createDataFrame([(i, t, 1 if "good" in t else 0) for i, t in enumerate(texts)], "id long, t string, y int")
    return df, scoring.ModelScorer("m", classify.train_classifier(df, "t", "y", "id"))


def test_training(spark, trained, tmp_path):
    df, scorer = trained
    predictions = classify.predictions_table(df, "t", "y", "id", scorer)
    assert classify.accuracy(predictions).first()[0] == 1.0
    classify.save_model(scorer.model, str(tmp_path / "m"))
    again = scoring.ModelScorer("m", classify.load_model(str(tmp_path / "m")))
    assert rows(again.predict(df, "t")) == rows(scorer.predict(df, "t"))
    # The long-form features are the model's features, and its optimum is the library's.
    terms, intercept = classify.model_terms(spark, scorer.model)
    x = features.weigh(features.row_terms(df, "t", "id"), terms).join(terms, "term").groupBy("id").agg(
        F.sum(F.col("weight") * F.col("coefficient")).alias("s"))
    logits = {r["id"]: r["s"] + intercept for r in x.collect()}
    for r in predictions.collect():
        assert r["y_prob"] == pytest.approx(1 / (1 + math.exp(-logits[r["id"]])))
    coefficient = {r["term"]: r["coefficient"] for r in terms.collect()}
    dense = {r["id"]: {} for r in df.collect()}
    for r in features.weigh(features.row_terms(df, "t", "id"), terms).collect():
        dense[r["id"]][r["term"]] = r["weight"]
    # Gradient of C * loss + |w|^2 / 2 at the solution.
    error = {r["id"]: r["y_prob"] - r["y_true"] for r in predictions.collect()}
    for term, w in coefficient.items():
        assert w + sum(error[i] * dense[i].get(term, 0.0) for i in dense) == pytest.approx(0.0, abs=0.05)


def test_linear_occlusion_base_is_the_prediction(spark, trained):
    df, scorer = trained
    terms, intercept = classify.model_terms(spark, scorer.model)
    base = {r["id"]: r["base_prob"] for r in explain.linear_occlusion(df, "t", "id", terms, intercept).collect()}
    want = {r["id"]: r["y_prob"] for r in scorer.predict(df, "t").collect()}
    assert base == pytest.approx(want)


def sides(spark, ref, cur):
    return spark.createDataFrame([(float(v), False) for v in ref] + [(float(v), True) for v in cur],
                                 "v double, is_current boolean")


@pytest.mark.parametrize("ref, cur, distance", [
    (range(50), range(50), 0.0), (range(10), range(100, 110), 1.0), ([1] * 30 + [2] * 10, [1] * 10 + [2] * 10, 0.25),
])
def test_ks(spark, ref, cur, distance):
    got = drift.ks_two_sample(drift.drift_features(sides(spark, ref, cur), {"v": F.col("v")})).first()
    assert got["ks_distance"] == pytest.approx(distance)
    assert got["p_value"] == pytest.approx(1.0) if distance == 0 else 0 <= got["p_value"] < 1


def test_psi_with_empty_bins(spark):
    got = drift.psi(drift.drift_features(sides(spark, range(100), [1000] * 10), {"v": F.col("v")})).first()["psi"]
    r = np.full(10, 0.1)
    c = np.maximum(np.array([0.0] * 9 + [1.0]), 1e-4)
    assert got == pytest.approx(((c - r) * np.log(c / r)).sum())
    same = drift.psi(drift.drift_features(sides(spark, range(100), range(100)), {"v": F.col("v")}))
    assert same.first()["psi"] == pytest.approx(0.0)


def test_target_drift(spark):
    df = sides(spark, [0] * 30 + [1] * 30, [0] * 10 + [1] * 50)
    plain, tested = drift.target_drift(df, "v").first(), drift.target_drift_test(df, "v").first()
    assert plain["chi_square"] == pytest.approx(15.0) and plain["dof"] == 1
    assert tested["chi_square"] == pytest.approx(15.0) and tested["p_value"] == pytest.approx(math.erfc(math.sqrt(7.5)))
    assert tuple(drift.target_share(df, "v").first()) == pytest.approx((0.5, 5 / 6, 1 / 3))


def one(spark, **values):
    return spark.createDataFrame([tuple(values.values())], list(values))


def plan(spark, pairs=0, major=0.59, p95=0.7, gap=0.1, flips=None):
    balance = spark.createDataFrame([("a", major), ("b", 1 - major)], "l string, fraction double")
    summary = None if flips is None else spark.createDataFrame(flips, "perturb string, flip_rate double")
    found = repair.repair_plan(balance, "l", one(spark, n_pairs=pairs), summary, one(spark, toxicity_p95=p95),
                               one(spark, equalized_odds_tpr_diff=gap))
    return [(r["position"], r["rule"], r["reason"]) for r in found.orderBy("position").collect()]


def test_repair_rules_at_their_limits(spark):
    assert plan(spark) == []
    assert [r for _, r, _ in plan(spark, 1, 0.6, 0.71, 0.11)] == ["dedup", "rebalance", "toxicity", "fairness"]
    got = plan(spark, 8, 0.5, flips=[("upper", 0.2), ("lower", 0.2)])
    assert got == [(1, "dedup", "Found 8 pairs above similarity threshold."),
                   (2, "augment", "Highest flip rate under 'lower' perturbation.")]


@pytest.mark.parametrize("mode, majority", [("reference", 60), ("exact", 30)])
def test_rebalance(spark, mode, majority):
    df = spark.range(100).select("id", F.when(F.col("id") < 80, "big").otherwise("small").alias("l"))
    got = {r["l"]: r["count"] for r in repair.apply_rebalance(df, "l", "id", mode=mode).groupBy("l").count().collect()}
    assert got == {"big": majority, "small": 20}
    even = spark.range(10).select("id", (F.col("id") < 6).alias("l"))
    assert repair.apply_rebalance(even, "l", "id").count() == 10


def test_takeaways(spark):
    def metrics(*data):
        return spark.createDataFrame([("model", *d) for d in data],
                                     "section string, metric string, key string, value double, version string")
    both = metrics(("accuracy", "", 0.9, "original"), ("accuracy", "", 0.95, "repaired"),
                   ("flip_rate", "upper", 0.3, "repaired"), ("flip_rate", "lower", 0.3, "repaired"))
    got = {r["takeaway"]: (r["name"], r["value"]) for r in report.takeaways(both).collect()}
    assert got["worst_after_repair"] == ("lower", 0.3) and got["accuracy_delta"][1] == pytest.approx(0.05)
    only = report.takeaways(metrics(("accuracy", "", 0.9, "original"))).collect()
    assert [r["takeaway"] for r in only] == ["baseline_only"]


def test_chi_square_p_matches_known_values(spark):
    # Upper tail points of printed tables, both parities, and a large number of degrees.
    known = [(3.841458820694124, 1, 0.05), (0.0039321400000195, 1, 0.95), (5.991464547107979, 2, 0.05),
             (7.814727903251179, 3, 0.05), (18.307038053275146, 10, 0.05), (24.99579013972863, 15, 0.05),
             (0.0, 4, 1.0), (124.3421134004, 100, 0.05), (10.0, 0, None), (None, 3, None), (200.0, 1, 2.0884e-45)]
    df = spark.createDataFrame([(c, n) for c, n, _ in known], "c double, n long")
    got = [r["p"] for r in df.select(drift.chi_square_p(F.col("c"), F.col("n")).alias("p")).collect()]
    for value, (_, _, want) in zip(got, known):
        assert value == (want if want is None else pytest.approx(want, rel=1e-4, abs=1e-50))


def test_many_labels_and_one_sided_tables(spark):
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("v"), (F.col("id") % 3 == 0).alias("is_current"))
    got = drift.target_drift_test(df, "v").first()
    assert got["dof"] == 19_999 and 0 <= got["p_value"] <= 1
    lone = sides(spark, range(10), [])
    features = drift.drift_features(lone, {"v": F.col("v")})
    assert drift.psi(features).first()["psi"] is None
    found = drift.ks_two_sample(features).first()
    assert found["ks_distance"] is None and found["p_value"] is None
    assert drift.target_drift_test(lone, "v").first()["chi_square"] is None
    current = drift.drift_features(sides(spark, [], range(10)), {"v": F.col("v")})
    assert drift.psi(current).first()["psi"] is None and drift.ks_two_sample(current).first()["p_value"] is None


def test_auc_is_exact_with_ties(spark):
    rng = np.random.default_rng(4)
    scores, good = rng.integers(0, 5_000, 12_000) / 7, rng.random(12_000) < 0.3
    df = spark.createDataFrame([(float(s), bool(g)) for s, g in zip(scores, good)] + [(None, True)], "s double, g boolean")
    ordered = np.sort(scores[~good])
    below = np.searchsorted(ordered, scores[good], "left") + np.searchsorted(ordered, scores[good], "right")
    assert drift.exact_auc(df, "s", "g").first()["auc"] == pytest.approx(below.sum() / 2 / good.sum() / (~good).sum(), abs=1e-12)
    assert drift.exact_auc(df.where("g"), "s", "g").first()["auc"] is None


def test_vocabulary_cut_breaks_ties_by_term(spark):
    texts = ["aa bb cc", "aa bb dd", "aa ee", "", None, "ff ff"]
    counts = features.term_counts(spark.createDataFrame(list(enumerate(texts)), "id long, t string"), "t", "id", False)
    for n, want in ((1, {"aa"}), (2, {"aa", "bb"}), (3, {"aa", "bb", "ff"}), (4, {"aa", "bb", "ff", "cc"}), (99, {*"aa bb cc dd ee ff".split()})):
        assert {r["term"] for r in features.fit_vocabulary(counts, F.lit(6), n).collect()} == want
    assert features.tfidf_features(spark.createDataFrame([], "id long, t string"), "t", "id").count() == 0


def test_weights_go_out_in_bounded_batches(monkeypatch):
    monkeypatch.setattr(features, "PIECE", 50, raising=False)
    rows_in = [[{"term": f"t{k}", "tf": 1 + k % 3} for k in range(n)] for n in (0, 30, 30, 70, 1, 0)]
    batch_in = pa.RecordBatch.from_arrays(
        [pa.array(range(6)), pa.array(rows_in, pa.list_(pa.struct([("term", pa.string()), ("tf", pa.int64())])))], ["id", "terms"])
    shared = type("Shared", (), {"value": ([f"t{k}" for k in range(70)], np.ones(70))})
    schema = pa.schema([("id", pa.int64()), ("term", pa.string()), ("weight", pa.float64())])
    found = list(features._weighed_rows(shared, schema)(iter([batch_in.slice(1)])))
    assert all(len(set(b.column("id").to_pylist())) <= 1 or b.num_rows <= 50 for b in found)
    assert [r["id"] for b in found for r in b.to_pylist()] == [1] * 30 + [2] * 30 + [3] * 70 + [4]


def test_lexicon_occlusion_stays_in_the_row(spark):
    df = spark.createDataFrame([(1, "good Fine good bad"), (2, ""), (3, None), (3, "bad bad"), (4, "bad"), (4, "good"),
                                (None, "good"), (None, "bad bad")], "id long, t string")
    left = explain._row_occlusion(df, "t", "id", WORDS, 2)
    assert "Exchange" not in left._jdf.queryExecution().executedPlan().toString()
    # Rows of one id, or without one, are one text.
    got = {(r["id"], r["token"], round(r["base_prob"], 6), r["prob_without"], r["rank"])
           for r in explain.lexicon_occlusion(df, "t", "id", WORDS, 2).collect()}
    assert got == {(1, "bad", 0.75, 1.0, 1), (1, "good", 0.75, 0.5, 2), (3, "bad", 0.0, 0.0, 1), (4, "bad", 0.5, 1.0, 1),
                   (4, "good", 0.5, 0.0, 2), (None, "bad", 0.333333, 1.0, 1), (None, "good", 0.333333, 0.0, 2)}


def test_features_shuffle_no_text(spark):
    df = spark.createDataFrame([(i, f"some text {i}") for i in range(50)], "id long, t string")
    plan = features.tfidf_features(df, "t", "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_batch_scorer_is_the_lexicon(spark):
    df = spark.createDataFrame([(1, "Good fine bad bad"), (2, "!"), (3, None), (4, "good good Fine x_1")], "id long, text string")
    same = batch.lexicon_scorer(spark, WORDS)
    assert rows(same.predict(df, "text").select("id", "y_prob", "y_pred")) == rows(
        WORDS.predict(df, "text").select("id", "y_prob", "y_pred"))
    named = scoring.score_identity(df, "text", [same]).select("id", "words_score")
    assert rows(named) == rows(scoring.score_identity(df, "text", [WORDS]).select("id", "words_score"))
    got = explain.lexicon_occlusion(df, "text", "id", WORDS, 3)
    assert rows(batch.batch_occlusion(df, "text", "id", same, 3).select(*got.columns)) == rows(got)


def test_model_is_sent_as_one_file(spark):
    """A cluster's driver sends no local folders."""
    sent = set(spark.sparkContext.listFiles)
    scorers = [batch.lexicon_scorer(spark, WORDS), batch.lexicon_scorer(spark, WORDS)]
    new = set(spark.sparkContext.listFiles) - sent
    assert len(new) == len(scorers)
    assert all(os.path.isfile(SparkFiles.get(os.path.basename(f))) for f in new)


def test_word_odds_and_their_masks(spark):
    df = spark.createDataFrame([(i, f"vile word{i % 3}" if i % 4 == 0 else f"nice word{i % 3} day", int(i % 4 == 0))
                                for i in range(40)], "id long, t string, y int")
    scorer = batch.fit_word_odds(df, "t", "y", "id", 50)
    scored = {r["id"]: r["y_prob"] for r in scorer.predict(df, "t").collect()}
    assert all((p > 0.5) == (i % 4 == 0) for i, p in scored.items())
    # Each mask is the score of the text without the word.
    for r in batch.batch_occlusion(df.where("id < 6"), "t", "id", scorer, 9).collect():
        text = df.where(F.col("id") == r["id"]).first()["t"]
        left = " ".join(w for w in text.split() if w != r["token"])
        alone = spark.createDataFrame([(0, left)], "id long, t string")
        assert r["prob_without"] == pytest.approx(scorer.predict(alone, "t").first()["y_prob"])


def test_lexicon_cuts_a_text_once(spark):
    """A word list that is read three times is still cut from the text once."""
    df = spark.createDataFrame([(1, "good bad fine"), (2, ""), (3, None), (4, "a bad")], "id long, t string")
    scored = df.select("id", WORDS.probability(F.col("t")).alias("p"))
    assert rows(scored) == [(1, pytest.approx(2 / 3)), (2, 0.0), (3, 0.0), (4, 0.0)]
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_domain_classifier_scores_a_row_once(spark, monkeypatch):
    """The filter on the score must not run the model again: it reads written scores."""
    df = spark.createDataFrame([(i, f"old word{i % 3}" if i % 2 else f"new word{i % 3}", i % 2 == 1)
                                for i in range(40)], "id long, text string, is_current boolean")
    plans, exact_auc = [], drift.exact_auc

    def seen(scored, *names):
        found = exact_auc(scored, *names)
        plans.append(scored.where("score IS NOT NULL")._jdf.queryExecution().optimizedPlan().toString())
        return found

    monkeypatch.setattr(drift, "exact_auc", seen)
    assert drift.domain_classifier_auc(df, "text", "id").first()["auc"] == 1.0
    assert "UDF" not in plans[0]


def test_a_block_of_texts_is_held_in_few_bytes_a_term():
    """What a worker needs at its peak for the whole texts of a block: not ten numbers for each term."""
    rng = np.random.default_rng(4)
    n, size = 400, 1_000
    terms = np.concatenate([np.sort(rng.choice(50_000, size, replace=False)) for _ in range(n)]).astype(np.int64)
    flat = lambda v: as_lists(v, np.full(n, size))
    batches = [pa.RecordBatch.from_arrays(
        [pa.array(np.arange(n)), flat(terms), flat(np.full(n * size, 0.1)), flat(np.zeros(n * size)),
         flat(np.full(n * size, 2, np.int32))], ["rep", "term", "x", "reach", "seen"]).slice(a, 20) for a in range(0, n, 20)]
    tracemalloc.start()
    try:
        held = text_pairs._Texts(batches)
        met = text_pairs._Meeting(0.5, held, held)
        assert met.cosines(np.array([0]), np.array([0]))[0] == pytest.approx(10.0)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40 * n * size


@pytest.mark.parametrize("common, held, whole", [(1 << 20, 1 << 21, 1 << 23), (10, 1 << 21, 300), (10, 1, 1 << 23)])
def test_text_pairs_leave_little_behind(spark, common, held, whole, monkeypatch):
    """Rare terms, many groups and large tiles take other ways to the same pairs; tables with terms go but for the vectors."""
    for name, value in (("COMMON", common), ("HELD_GROUPS", held), ("WHOLE_TERMS", whole), ("LEAST_TERMS", 8)):
        monkeypatch.setattr(text_pairs, name, value)
    written = []
    for module in (similarity, text_pairs):
        monkeypatch.setattr(module, "materialise", lambda *a, f=module.materialise: written.append(f(*a)) or written[-1])
    rng = np.random.default_rng(12)
    words = np.array([f"w{i}" for i in range(200)])
    texts = [" ".join(rng.choice(words, 30, p=(1 / np.arange(3, 203)) / (1 / np.arange(3, 203)).sum())) for _ in range(40)]
    texts += [t + " new" + str(i) for i, t in enumerate(texts[:20])] + texts[5:9]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = similarity.similar_texts(df, "text", "id", 0.7)
    want = brute_pairs(texts, 0.7)
    table = {(r["idx1"], r["idx2"]): r["similarity"] for r in similarity.pair_table(found).collect()}
    assert similarity.pair_count(found).first()[0] == len(want) > 20 and table.keys() <= want.keys()
    assert all(table[k] == pytest.approx(want[k]) for k in table)
    left = [t for t in written if "terms" in t.columns and os.path.exists(t.inputFiles()[0].removeprefix("file:"))]
    assert all("own_copies" in t.columns for t in left) and len(left) == (1 if common > 10 else text_pairs.RARE_PARTS)


def test_blocks_of_texts_meet_once_and_are_sent_to_half(spark):
    for blocks in (1, 2, 5, 8):
        rows = spark.range(400).withColumnRenamed("id", "rep")
        parts = [text_pairs.seated(rows, blocks, a, a + 3) for a in range(0, blocks, 3)]
        seats = [tuple(r) for part in parts for r in part.select("lo", "own").distinct().collect()]
        assert sorted(tuple(sorted(s)) for s in seats) == [(a, b) for a in range(blocks) for b in range(a, blocks)]
        assert sum(part.count() for part in parts) <= 400 * (blocks // 2 + 1)


def test_sketches_are_bounds():
    rng = np.random.default_rng(6)
    terms = rng.integers(-1 << 62, 1 << 62, 500)
    x = rng.random((30, 500)) ** 8 * (rng.random((30, 500)) < 0.3)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    owner, at = np.nonzero(x)
    sketch = np.frombuffer(b"".join(text_pairs._sketches(terms[at], x[owner, at], owner, 30).to_pylist()), np.uint8)
    lengths = text_pairs.LENGTHS[sketch.reshape(30, -1)]
    assert (lengths @ lengths.T >= x @ x.T - text_pairs.SKETCH_SLACK).all()


def test_shuffle_files_go_with_the_table_that_is_written(spark):
    def files():
        return {f for folder in glob.glob(f"{root}/blockmgr-*") for f in glob.glob(f"{folder}/*/shuffle_*")}

    root = spark.sparkContext._jvm.org.apache.spark.util.Utils.getLocalDir(spark.sparkContext._jsc.sc().conf())
    before = files()
    rows = session.materialise(spark.range(1_000).repartition(5, "id"))
    assert rows.count() == 1_000 and not files() - before
    session.discard(rows)
    assert not os.path.exists(rows.scratch_folder.removeprefix("file:"))


def test_vectors_go_only_where_their_signatures_are_near(spark, monkeypatch):
    """Vectors at random share keys in most tables; they were sent there whole. Keys are dealt out in rounds."""
    monkeypatch.setattr(vector_pairs, "ROUND_KEYS", 30_000, raising=False)
    monkeypatch.setattr(vector_pairs, "BLOCK", 50)
    rng = np.random.default_rng(7)
    v = rng.normal(size=(500, 48))
    v = np.concatenate([v, v[:40] + rng.normal(scale=0.1, size=(40, 48))])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    found = similarity.hashed_vectors(df, "v", "id", threshold=0.95)
    assert {(r["idx1"], r["idx2"]) for r in found.near.collect()} == {(i, 500 + i) for i in range(40)}
    assert found.search.seated.select("rep").distinct().count() < 200
    assert vector_pairs.most_bits(0.95, 240) < 70 and vector_pairs.most_bits(0.0, 240) > 120
