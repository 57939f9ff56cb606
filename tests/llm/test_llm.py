"""The llm operators against brute force, on a small table with nulls, copies, ties and a long text."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from textcheck.llm import byte_bpe, marks, near_dup, quality_rules, queries, token_cache
from textcheck.llm.byte_bpe import load_ranks
from textcheck.llm.quality_rules import quality
from textcheck.llm.suffix_dedup import drop_repeated_passages, repeated_passages
from textcheck.llm.token_cache import ChunkEncoder
from textcheck.llm.token_files import read_token_files, write_token_files
from textcheck.session import BATCH_CONF, materialise, small_batches

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, words string, part long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _texts():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghijklmnoprstuvw", k=rng.randint(2, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    base, shared = prose(120), prose(70)
    near = base.split()
    near[60] = "changed"
    return [None, "", "   \n\t", "one", "Two words", base, base, base.upper(), " ".join(near),
            prose(90) + " " + shared + " " + prose(30), prose(40) + " " + shared, prose(6000),
            "line of words here\n" * 9, "#$%&* <>| 12 34", "naïve café — 漢字 😀  x", "x" * 700,
            *[prose(rng.randint(5, 150)) for _ in range(24)]]


@pytest.fixture(scope="module")
def texts():
    return dict(enumerate(_texts()))


@pytest.fixture(scope="module")
def folder(spark, texts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm"))
    rows = [(i, t, ("aa", "bb", None)[i % 3], None, None, "x", None, 7) for i, t in texts.items()]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/documents.parquet")
    return path


def _by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


def _pack(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def _encoding():
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=load_ranks(queries.BYTE_RANKS))


def _word_ids(text):
    tokenizer = Tokenizer.from_file(queries.WORD_BPE)
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_empty_table(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).collect() == []


def test_byte_bpe_is_tiktoken(spark, folder, texts):
    found, encoding = _by_id(queries.op1_byte_bpe(spark, folder)), _encoding()
    assert found.keys() == texts.keys()
    for i, text in texts.items():
        ids = encoding.encode_ordinary(text or "")
        assert found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(_pack(ids)).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("most", [1 << 18, 40])
def test_byte_bpe_folds_a_shared_word_once(spark, folder, texts, most, monkeypatch):
    """Words that blocks share come folded; a block has left only what it alone has, or what is not among the commonest."""
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", 1_500)
    monkeypatch.setattr(byte_bpe, "COMMON_WORDS", most, raising=False)
    shared, marked = [], []
    monkeypatch.setattr(byte_bpe, "_common_words", lambda *a, f=byte_bpe._common_words: shared.append(f(*a)) or shared[0])
    monkeypatch.setattr(byte_bpe, "_marked_rows", lambda words, f=byte_bpe._marked_rows: marked.append(f(words)) or marked[0])
    test_byte_bpe_is_tiktoken(spark, folder, texts)
    words = shared[0][0].to_pylist()
    assert 0 < len(words) <= most and len(set(words)) == len(words)
    batch = pa.RecordBatch.from_pylist([{"words": [words[0], "not one", ""]}, {"words": ["", words[-1]]}])
    left = [r for b in marked[0](iter([batch])) for r in b.to_pylist()]
    assert left == [{"words": ["", "not one", ""], "known": [0, -1, -1]}, {"words": ["", ""], "known": [-1, len(words) - 1]}]


def test_fingerprints(spark, folder, texts):
    found = _by_id(queries.op2_document_fingerprints(spark, folder))
    order = sorted(texts, reverse=True)
    by_text = defaultdict(set)
    for place, i in enumerate(order):
        text, after = texts[i] or "", texts[order[(place + 1) % len(order)]] or ""
        cut = len(text) // 2
        edited = text[:len(text) - cut] + after[:cut]
        assert found[i].n_chars == len(text)
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= found[i].near_edited <= 1 and 0 <= found[i].near_next <= 1
        by_text[text].add(found[i].fingerprint)
        by_text[edited].add(found[i].edited_fingerprint)
    assert all(len(x) == 1 for x in by_text.values())


def _shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def test_near_duplicates(spark, folder, texts):
    found = _by_id(queries.op3_minhash_near_dedup(spark, folder))
    sets = {i: _shingles(t) for i, t in texts.items()}
    label = {i: i for i in texts}
    for _ in texts:
        for a in texts:
            for b in texts:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    label[a] = min(label[a], label[b])
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in found.items()} == {
        i: (len(sets[i]), label[i], label[i] == i) for i in texts}


def test_section_counts_add_up(spark, folder, texts):
    counts = {r.doc_id: r.n for r in queries.op4_token_counts(spark, folder).groupBy("doc_id").agg(
        F.sum("n_tokens").alias("n")).collect()}
    encoding = _encoding()
    for i, text in texts.items():
        assert counts.get(i, 0) == len(encoding.encode_ordinary(text or ""))


def test_backoff_scores(spark, folder, texts):
    found = _by_id(queries.op5_lm_scores(spark, folder))
    words = {i: WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) for i, t in texts.items()}
    ones, twos = Counter(), Counter()
    for w in words.values():
        ones.update(w)
        twos.update(zip(w, w[1:]))
    total = sum(ones.values())
    for i, w in words.items():
        own, own_pairs, score = Counter(w), Counter(zip(w, w[1:])), 0.0
        rest = total - len(w)

        def unigram(x):
            n = ones[x] - own[x]
            return math.log(n / rest) if n else math.log(0.4 / (rest + 1))

        for k, x in enumerate(w):
            n = twos[w[k - 1], x] - own_pairs[w[k - 1], x] if k else 0
            if n:
                score += math.log(n / (ones[w[k - 1]] - own[w[k - 1]]))
            else:
                score += unigram(x) + (math.log(0.4) if k else 0)
        assert found[i].n_words == len(w)
        assert found[i].log_score == pytest.approx(score, rel=1e-9, abs=1e-9)


def test_token_files_round_trip(spark, folder, texts):
    found, start = _by_id(queries.op6_token_id_files(spark, folder)), 0
    for i in sorted(texts):
        ids = _word_ids(texts[i])
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (start, len(ids), zlib.crc32(_pack(ids)))
        start += len(ids)


def test_repeated_passages(spark, folder, texts):
    rows = queries.op7_suffix_array_dedup(spark, folder).collect()
    spans = defaultdict(list)
    for r in rows:
        spans[r.doc_id].append((r.first_word, r.first_word + r.n_words))
    assert any(a <= 90 and b >= 160 for a, b in spans[9])
    assert any(a <= 40 and b >= 110 for a, b in spans[10])
    words = {i: (t or "").split() for i, t in texts.items()}
    places = Counter()
    for w in words.values():
        places.update(tuple(w[k:k + 50]) for k in range(len(w) - 49))
    for i, w in words.items():
        repeated = {k for s in range(len(w) - 49) if places[tuple(w[s:s + 50])] > 1 for k in range(s, s + 50)}
        assert {k for a, b in spans[i] for k in range(a, b)} == repeated


def _passages(table):
    """Per row (id, first word, last word, repeats) by all windows of 50 words, earliest by id."""
    places = defaultdict(list)
    for i, text in table:
        words = (text or "").split()
        for k in range(len(words) - 49):
            places[tuple(words[k:k + 50])].append((i, k))
    spans = defaultdict(set)
    for at in places.values():
        for i, k in sorted(at)[1:] if len(at) > 1 else ():
            spans[i].update((x, True) for x in range(k, k + 50))
        if len(at) > 1:
            spans[min(at)[0]].update((x, False) for x in range(min(at)[1], min(at)[1] + 50))
    return spans


@pytest.mark.parametrize("partitions", [1, 2, 40])
def test_passages_with_shared_beginnings_and_ends(spark, partitions):
    """Blocks of 25 to 49 words that many share, some of them longer on either side."""
    rng = random.Random(11)

    def words(n):
        return [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]

    table, number = [], 0
    for core in (25, 30, 45, 49):
        block = words(core)
        left, right = words(30), words(30)
        for k in range(12):
            back, ahead = rng.choice([(0, 0), (8, 0), (0, 8), (50 - core, 0), (0, 50 - core), (30, 30), (3, 50 - core)])
            body = words(20) + left[len(left) - back:] + block + right[:ahead] + words(20)
            table.append((number, " ".join(body)))
            number += 1
    table += [(number, " ".join(words(70))), (number + 1, "a b c d e f g " * 20)]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(partitions)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        found = defaultdict(set)
        for r in repeated_passages(docs).collect():
            found[r.doc_id].update(range(r.first_word, r.first_word + r.n_words))
            repeats = {x for x, again in _passages(table)[r.doc_id] if again}
            assert r.duplicate == any(x in repeats for x in range(r.first_word, r.first_word + r.n_words))
        assert found == {i: {x for x, _ in s} for i, s in _passages(table).items()}
        kept = {r.doc_id: r.text.split() for r in drop_repeated_passages(docs).collect()}
        for i, text in table:
            gone = {x for x, again in _passages(table)[i] if again}
            left = [w for x, w in enumerate(text.split()) if x not in gone]
            assert kept.get(i, []) == left
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def _rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, _lang_pred string, `a.b` int, score int")


def test_repeated_rows_leave_one(spark):
    rng = random.Random(3)
    long, other = (" ".join(f"x{rng.randrange(9 ** 9)}" for _ in range(60)) for _ in range(2))
    rows = [(7, long, "a", "u", 1, 1), (7, long, "a", "u", 1, 1), (None, other, "b", "u", 2, 2), (None, other, "b", "v", 3, 3),
            (7, "short one", "a", "u", 4, 4), (7, "short one", "a", "u", 4, 4), (None, None, None, None, None, None)]
    kept = drop_repeated_passages(_rows(spark, rows)).collect()
    assert Counter(r.text for r in kept) == {long: 1, other: 1, "short one": 2, None: 1}
    assert sum(r.duplicate for r in repeated_passages(_rows(spark, rows)).collect()) == 2


def test_near_duplicate_stage_judges_rows_not_ids(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(3, b, "x", "u", 1, 1), (7, a, "x", "u", 2, 2), (7, b, "x", "u", 3, 3), (None, "lone text of five words", "x", "u", 4, 4),
            (None, None, "x", "u", 5, 5), (None, None, "x", "u", 5, 5), (9, a, "x", "u", 6, 6)]
    frame = _rows(spark, rows)
    kept = corpus_pipeline.drop_near_duplicates(spark, frame, "")
    assert kept.columns == frame.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == {
        (3, b): 1, (7, a): 1, (None, "lone text of five words"): 1, (None, None): 2}


def test_language_stage_keeps_columns_of_its_own_names(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns(
        {"_lang_pred": F.lit("mine"), "score": F.lit(5), "a.b": F.lit(1)})
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert kept.columns == docs.columns and kept.count() > 0
    assert {(r["_lang_pred"], r["score"], r["a.b"]) for r in kept.collect()} == {("mine", 5, 1)}
    sure = {r.doc_id for r in queries.op10_language_id(spark, folder).where("lang_pred <> 'und' AND score >= 0.5").collect()}
    assert {r.doc_id for r in kept.collect()} == sure


def test_quality_stage_follows_the_verdicts(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.apply_quality_rules(spark, docs, "").collect()}
    assert kept == {r.doc_id for r in queries.op9_quality_rules(spark, folder).where("kept").collect()}


def test_quality_of_a_table_without_words(spark):
    docs = _rows(spark, [(i, t, "en", "x", 1, 2) for i, t in ((1, None), (2, ""), (3, " \n"), (None, ""))])
    assert corpus_pipeline.apply_quality_rules(spark, docs, "").count() == 0
    judged = quality(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert [(r.n_words, r.token_entropy, r.base_failed, r.kept) for r in judged] == [(0, 0.0, True, False)] * 4


def test_token_ids_are_the_librarys_in_any_script():
    rng = random.Random(17)
    bits = ["A", "É", "é", "ß", "İ", "\u212a", "ſ", "ς", "Σ", "Paris", "“", "”", "—", "€", "ª", "µ", "÷", "\u0301", "漢", "Москва", "😀",
            "'s", "'", "n't", "3", "42", ".", ",", "<|endoftext|>", "<|", " ", "  ", "\n", "\r\n", "\t", "\u00a0", "\u2028", "\x85",
            "ÿ", "Ÿ", "ﬁ", "\u212b", "ǅ", "\u200d", "ا", "각"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(12_000)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x250, 0x3000), 32, 10]))
                      for _ in range(rng.randint(0, 20))) for _ in range(8_000)]
    tokenizer, encoder = Tokenizer.from_file(queries.WORD_BPE), ChunkEncoder(queries.WORD_BPE)
    assert encoder.plain
    for ids, want in zip(encoder.encode(texts), tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert list(struct.unpack(f"<{len(ids) // 2}H", ids)) == want.ids


def test_token_files_give_single_documents(spark, folder, texts, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    again = docs.unionByName(docs.where("doc_id IN (5, 11)")).unionByName(
        docs.where("doc_id = 9").withColumn("doc_id", F.lit(None).cast("long")))
    path = str(tmp_path / "files")
    write_token_files(again, path, queries.WORD_BPE)
    assert len(spark.read.parquet(f"{path}/dictionary").first()["dictionary"]) > 0
    found = read_token_files(spark, path, [5, 11, 40]).collect()
    assert Counter(r.doc_id for r in found) == {5: 2, 11: 2, **({40: 1} if 40 in texts else {})}
    assert all(bytes(r.ids) == _pack(_word_ids(texts[r.doc_id])) for r in found)
    everything = sorted(read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert len(everything) == len(texts) + 3 and everything[0].doc_id is None
    at = 0
    for r in everything:
        assert r.start == at
        at += r.n_tokens


def test_cut_passages_leave_the_first(spark, folder, texts):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id: r.text for r in drop_repeated_passages(docs).collect()}
    assert kept[5] == texts[5] and kept[9] == texts[9] and 6 not in kept
    assert len(kept[10].split()) == 40
    assert kept[0] is None and kept[1] == ""


def test_packing(spark, folder, texts):
    pieces, bins = defaultdict(dict), defaultdict(list)
    for r in queries.op8_best_fit_packing(spark, folder).collect():
        pieces[r.doc_id][r.piece] = r
        bins[r.sequence_id].append((r.offset, r.length))
    total = 0
    for i, text in texts.items():
        ids = _word_ids(text)
        total += len(ids)
        cuts = [(k, ids[k:k + 4096]) for k in range(0, len(ids), 4096)]
        assert {(n, r.start, r.length, r.ids_crc32) for n, r in pieces[i].items()} == {
            (n, k, len(x), zlib.crc32(_pack(x))) for n, (k, x) in enumerate(cuts)}
    for items in bins.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(bins) <= -(-total // 4096) + 1


def test_quality_rules(spark, folder, texts):
    found = _by_id(queries.op9_quality_rules(spark, folder))
    for i, text in texts.items():
        words = WORD.findall(text or "")
        windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
        often = Counter(windows)
        repeat = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(8)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
                    len(lines) - len(set(lines)), len(repeat))
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        failed = len(words) < 20 or 100 * len(repeat) > 30 * len(words)
        assert r.base_failed == failed and not (failed and r.kept)


def test_language_id(spark, folder, texts):
    found = _by_id(queries.op10_language_id(spark, folder))
    for i, text in texts.items():
        r = found[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        if not re.search(r"[^\W\d_]", text or ""):
            assert r.lang_pred == "und"
        else:
            assert r.lang_pred in ("aa", "bb")


def test_language_id_on_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = queries.op10_language_id(spark, sf_dir).where("held_out and lang_pred != 'und'").join(
        docs.where("lang is not null"), "doc_id").collect()
    assert rows and sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows)


def test_pipeline(spark, sf_dir):
    assert "pipeline" in __spark_entry__.queries()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    packed = corpus_pipeline.run(spark, sf_dir)
    ids = {r.doc_id for r in packed.select("doc_id").collect()}
    assert ids and ids < {r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_on_an_empty_table(spark, empty):
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_chunks_that_come_again_outlast_a_full_cache():
    """A full cache kept nothing, so that common words were encoded anew; the encoder was made anew in each task."""
    encoder = ChunkEncoder(queries.WORD_BPE)
    text, want = "alpha beta, gamma.", encoder.tokenizer.encode("alpha beta, gamma.", add_special_tokens=False).ids
    assert list(np.frombuffer(encoder.encode([text])[0], "<u2")) == want
    encoder.cached_bytes = 0
    encoder.encode(["others"])
    encoder.cached_bytes, encoder.model = 1 << 20, None
    assert list(np.frombuffer(encoder.encode([text])[0], "<u2")) == want
    assert token_cache.shared_encoder(queries.WORD_BPE) is token_cache.shared_encoder(queries.WORD_BPE)


def test_small_batches_end_with_the_write(spark):
    before = spark.conf.get(BATCH_CONF)
    sizes = spark.range(0, 2_500, 1, 1).mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in batches), "n long")
    assert {r["n"] for r in materialise(sizes, 1_000).collect()} == {1_000, 500}
    with pytest.raises(ValueError), small_batches(spark, 7):
        raise ValueError
    assert spark.conf.get(BATCH_CONF) == before


def test_letters_by_script_of_many_words(monkeypatch):
    """Tokens and letters of new words as one by one; the script of a character is looked up once."""
    asked, script = [], quality_rules._script
    monkeypatch.setattr(quality_rules, "_script", lambda point: asked.append(point) or script(point))
    fertility = quality_rules._Fertility(public_tokenizers.path("piece_bpe_32k.model"))
    words = ["word", "a1b2", "\u03b1\u03b2x", "\u0416\u0416", "\u4e2d\U00020000", "##", "\u00aa\u0e01", "x" * 90, "\u0627\U0001f600"]
    for some in (words, words[:3], ["word", "new", "\u0416"]):
        ids, rows = fertility.of(some)
        alone = [fertility.pieces.encode(w) for w in some]
        assert ids.tolist() == [i for x in alone for i in x]
        for word, found, row in zip(some, alone, rows.tolist()):
            named = [next((s for s, a, b in quality_rules.RANGES if a <= ord(c) <= b), "other") for c in word if c.isalpha()]
            assert row == [len(found), sum(fertility.pieces.is_byte(i) for i in found),
                           *(named.count(s) for s in quality_rules.SCRIPTS)]
    assert len(asked) == len(set(asked))


def test_rows_are_picked_by_bitmaps(spark):
    """Exactly the numbered rows; of other keys all that are wanted and few others; no text is shuffled."""
    rows = spark.range(0, 50_000, 1, 3).select(
        (F.col("id") * 7919 - 9).alias("key"), F.monotonically_increasing_id().alias("row"), F.col("id").cast("string").alias("text"))
    wanted = rows.where("key % 5 = 0")
    found = marks.with_numbers(rows, wanted.select("row"), "row")
    assert sorted(r.key for r in found.collect()) == sorted(r.key for r in wanted.collect())
    assert found.columns == rows.columns
    odd = rows.unionByName(spark.createDataFrame([(None, 1, "x"), (None, 2, "y")], "key long, row long, text string"))
    keys = wanted.select(F.col("key").alias("id")).unionByName(spark.createDataFrame([(None,)], "id long"))
    sieved = marks.sieved(odd, keys, "key")
    kept = [r.key for r in sieved.collect()]
    assert {r.key for r in wanted.collect()} <= set(kept) and kept.count(None) == 2
    assert len(kept) < 0.4 * 50_000
    assert marks.sieved(odd, keys.limit(0), "key").count() == 0
    plan = sieved._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_near_duplicates_do_not_shuffle_their_texts(spark, folder, monkeypatch):
    """Texts are picked by bitmaps, whichever join Spark would take for the ids."""
    picked = []
    monkeypatch.setattr(near_dup, "with_numbers", lambda *a: picked.append("kept") or marks.with_numbers(*a))
    monkeypatch.setattr(near_dup, "sieved", lambda *a: picked.append("met") or marks.sieved(*a))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    found = near_dup.near_duplicates(docs)
    assert kept.count() <= found.where("kept").count()
    assert {r.doc_id for r in kept.collect()} <= {r.component_id for r in found.collect()}
    assert sorted(set(picked)) == ["kept", "met"]
