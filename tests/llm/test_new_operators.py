"""Sanitisation, hard negatives and periodic runs against brute force on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from textcheck.llm import hard_negatives as hn
from textcheck.llm import queries, sanitise
from textcheck.llm.periodic_runs import periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
DOCS = "doc_id long, text string, lang string, source string, n_chars long, spans string, `a.b` int, row int"


def _documents(spark, tmp_path, texts, ids=None):
    rows = [(i, t, "x", None, None, "y", 3, 4) for i, t in zip(ids or range(len(texts)), texts)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


# ---- personal data

def _luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _base(text):
    out = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 16 <= len(digits) <= 19 and _luhn(digits)
                    or kind == "phone" and 8 <= len(digits) <= 15)
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def _listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


HOSTILE = [
    None, "", "  \n", "a@b.c", "a@b.c_d@e.f", "a@b..c", "é.x@y.z,é", "@@a@b@c.d.", "a" * 3000, "a" * 500 + "@" + "b" * 500,
    "1.2.3.4.5.6.7.8", "256.1.1.1 1.256.1.1", "0000255.00.0.1", "1.2.3", "999999999999999999999.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111x", "41111111111111112", "4111  1111 1111 1111", "1" * 19, "0" * 16,
    "5 5 5 5 5 5 5 5 5 5 5 5 5 5 5 4", "0 " * 4000, "+1 (386) 555-3733", "+12", "+123", "+1 2 3 4 5 6 7 8 ) (", "++49 30 1234567",
    "+1-234-567-8901+1-234-567-8901", "😀 a@b.co 😀 1.1.1.1 😀", "x@y.z " * 300, "tel:+4930123456.7", "A@B.C-D@E.F",
]


def test_base_spans(spark, tmp_path):
    rng = random.Random(4)
    bits = ["a", "é", "😀", "@", ".", "-", " ", "+", "1", "25", "4111111111111111", "(", ")", "_", "%", "\n", "a@b.c", "1.2.3.4"]
    texts = HOSTILE + ["".join(rng.choices(bits, k=rng.randint(1, 40))) for _ in range(600)]
    found = {r.doc_id: r for r in queries.op11_private_data(spark, _documents(spark, tmp_path, texts)).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        spans, counts = _base(text), Counter(k for k, _, _ in _base(text))
        assert found[i].spans == _listed(spans), text
        assert found[i].base_sha256 == hashlib.sha256(_listed(spans).encode()).hexdigest()
        assert [found[i][f"n_{k}"] for k in BASE] == [counts[k] for k in BASE]


def _blank(text):
    return BASE["email"].sub(lambda m: " " * len(m[0]), text)


def _terms(text):
    return [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W\d_]{3,}", _blank(text))]


def _actions(texts):
    """The definition: shares of information over documents, windows as evidence."""
    with_entity, with_term, together, windows = Counter(), Counter(), Counter(), defaultdict(set)
    for text in texts:
        with_term.update({t for _, _, t in _terms(text)})
        seen = set()
        for kind, a, b in _base(text):
            blank, reach = _blank(text), sanitise.REACH
            lo = max(a - reach - 1, 0)
            before, after = blank[lo:a], blank[b:b + reach + 1]
            before = re.sub(r"^[^\W\d_]+", "", before) if lo else before
            after = re.sub(r"[^\W\d_]+$", "", after) if b + reach + 1 < len(text) else after
            value = text[a:b].lower() if kind == "email" else re.sub("[ ().-]", ".", text[a:b])
            near = tuple(sorted({t for _, _, t in _terms(before + " " + after)}))
            seen.add((f"{kind}:{value}", near))
        for entity, near in seen:
            with_entity[entity] += 1
            for t in near:
                together[entity, t] += 1
                windows[entity, t].add(near)
    share = defaultdict(float)
    for (entity, t), n in together.items():
        if len(windows[entity, t]) >= sanitise.LEAST_WINDOWS and with_entity[entity] < len(texts):
            n = min(n, with_term[t], with_entity[entity])
            pmi = math.log2(n * len(texts) / (with_entity[entity] * with_term[t]))
            share[t] = max(share[t], pmi / math.log2(len(texts) / with_entity[entity]))
    return {t: "removed" if s >= sanitise.REMOVE_AT else "generalised"
            for t, s in share.items() if s >= sanitise.GENERALISE_AT}


def test_terms_that_give_an_entity_away(spark, tmp_path):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghijklmno", k=6)) for _ in range(150)]

    def prose(n):
        return " ".join(rng.choices(words, k=n))

    texts = [prose(rng.randint(3, 60)) for _ in range(250)]
    texts += [f"{prose(9)} Zorblax of {prose(2)} ana@corp.example, {prose(20)}" for _ in range(6)]
    texts += [f"{prose(4)} ZORBLAX was here {prose(5)}"]
    texts += [f"quintle {prose(3)} +49 30 1234567 {prose(4)}" for _ in range(9)]
    texts += ["call Vexil at 10.1.2.3 " + words[0]] * 30  # copies: one surrounding
    actions = _actions(texts)
    assert {"zorblax": "generalised", "quintle": "removed"}.items() <= actions.items() and "vexil" not in actions
    path = _documents(spark, tmp_path, texts)
    found = {r.doc_id: r for r in queries.op11_private_data(spark, path).collect()}
    sanitised = {r.doc_id: r.sanitised for r in sanitise.sanitise(
        spark.read.parquet(f"{path}/documents.parquet")).collect()}
    for i, text in enumerate(texts):
        marks = sorted((actions[t], a, b) for a, b, t in _terms(text) if t in actions)
        spans = _base(text) + marks
        assert found[i].spans == _listed(spans)
        for kind, a, b in sorted(spans, key=lambda s: -s[1]):
            label = {"removed": "[REMOVED]", "generalised": "[NAME]" if text[a].isupper() else "[WORD]"}.get(
                kind, f"[{kind.upper()}]")
            text = text[:a] + label + text[b:]
        assert sanitised[i] == text


def test_overlapping_spans_are_masked_once(spark):
    text = "n a@1.2.3.4x, +10.20.30.40, 4111 1111 1111 1111. "
    docs = spark.createDataFrame([(1, text * 40, 2)], "doc_id long, text string, kept int")
    row = sanitise.sanitise(docs, keep=("doc_id", "kept")).first()
    assert row.kept == 2 and len(row.spans) == 40 * 5
    assert row.sanitised == "n [EMAIL], [PHONE], [CARD]. " * 40
    with pytest.raises(ValueError):
        sanitise.sanitise(docs.withColumnRenamed("kept", "spans"), keep=("spans",))


def test_repeated_rows_and_null_ids_stay(spark, tmp_path):
    texts = ["a@b.c x", "a@b.c x", None, "plain", "plain"]
    ids = [1, 1, None, None, 2]
    path = _documents(spark, tmp_path, texts, ids)
    for name, column in (("op11_private_data", "n_email"), ("op13_periodic_runs", "n_runs")):
        rows = queries.QUERIES[name](spark, path).collect()
        assert Counter(r.doc_id for r in rows) == Counter(ids)
    assert sum(r.n_email for r in queries.op11_private_data(spark, path).collect()) == 2


# ---- hard negatives

def _negatives(rows):
    some = []
    for i, label, vector in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        some.append((i, label, [math.floor(256 * x) for x in vector]))
    out = []
    key = lambda t: (-t[0], 1 << 63 if t[1] is None else t[1])
    for k, (i, label, vector) in enumerate(some):
        if i is None or i % 50:
            continue
        scores = [(sum(a * b for a, b in zip(vector, other)), j) for j, _, other in some]
        same = sorted((scores[m] for m in range(len(some)) if m != k and some[m][1] == label), key=key)[:5]
        rest = sorted((scores[m] for m in range(len(some)) if some[m][1] != label), key=key)
        for positive, j in same:
            window = [t for t in rest if 50 * positive <= 100 * t[0] <= 95 * positive][:3]
            out += [(i, j, rank + 1, n, positive, s) for rank, (s, n) in enumerate(window)]
    return Counter(out)


@pytest.mark.parametrize("cell_rows, first, growth", [(4, 5, 6), (1024, 16, 8)])
def test_hard_negatives_are_exact(spark, monkeypatch, cell_rows, first, growth):
    monkeypatch.setattr(hn, "FIRST", first)
    monkeypatch.setattr(hn, "GROWTH", growth)
    rng = random.Random(cell_rows)
    base = [[rng.gauss(0, 1) + 2 * (d == c) for d in range(6)] for c in range(4)]
    rows = []
    for i in range(400):
        c = rng.randint(0, 3)
        v = [x + rng.gauss(0, 0.5) for x in base[c]] if rng.random() < 0.7 else list(base[0])
        v = v[:4] if rng.random() < 0.02 else v
        v[2] = rng.choice([None, math.nan, math.inf]) if rng.random() < 0.03 else v[2]
        i = None if rng.random() < 0.02 else i if rng.random() < 0.9 else 50 * (i // 50)
        rows.append((i, None if rng.random() < 0.03 else c, None if rng.random() < 0.02 else v, 1, "k"))
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, id int, key string")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hn.hard_negatives(frame.withColumn("label", label), F.col("vec_id") % 50 == 0, cell_rows=cell_rows)
    rows = [(r.vec_id, r.label, r.embedding) for r in frame.collect()]
    assert Counter(map(tuple, found.collect())) == _negatives(rows)


def test_hard_negatives_of_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    found = queries.op12_hard_negatives(spark, "/root/testdata/sf0.001").collect()
    assert found and Counter(map(tuple, found)) == _negatives([(r.vec_id, r.label, r.embedding) for r in rows])


def test_cells_come_in_the_order_of_their_bounds():
    import numpy as np

    rng = np.random.default_rng(2)
    one, two = rng.normal(size=7), rng.normal(size=5)
    seen = list(hn._visits((one, two)))
    assert sorted((i, j) for _, i, j in seen) == [(i, j) for i in range(7) for j in range(5)]
    assert [b for b, _, _ in seen] == sorted((b for b, _, _ in seen), reverse=True)


# ---- periodic runs

def _runs(words, least=24, times=3):
    out = []
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            n = j - i + q
            if n >= max(least, times * q) and not any(
                    words[i:i + n - d] == words[i + d:i + n] for d in range(1, q)):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def _kept(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def _repetitive(rng):
    words = []
    for _ in range(rng.randint(1, 6)):
        period = [rng.choice("ab" if rng.random() < 0.5 else "abcdéfgh😀") for _ in range(rng.randint(1, 12))]
        part = period * rng.randint(1, 9)
        words += part[:rng.randint(1, len(part))]
    return words


@pytest.mark.parametrize("least, times", [(24, 3), (6, 2), (9, 3), (12, 4)])
def test_runs_are_all_runs(spark, least, times):
    rng = random.Random(least)
    texts = {i: rng.choice([" ", "\n ", "\t"]).join(_repetitive(rng)) for i in range(300)}
    docs = spark.createDataFrame([(i, t, "z") for i, t in texts.items()], "doc_id long, text string, runs string")
    for r in periodic_runs(docs, min_length=least, min_exponent=times).collect():
        words = WORD.findall(texts[r.doc_id])
        runs = _runs(words, least, times)
        assert [tuple(x) for x in r.runs] == runs and r.n_words == len(words)
        assert r.collapsed == _kept(words, runs)


def test_periodic_query(spark, tmp_path):
    rng = random.Random(6)
    some = ["w%d" % k for k in range(90)]
    texts = [None, "", " \n", "one", "\x1c x y " * 30, "same " * 4000, "a b\x0b" * 50,
             *[" ".join(rng.choices(some, k=rng.randint(1, 400))) for _ in range(120)],
             *["\n".join(_repetitive(rng)) for _ in range(60)]]
    found = {r.doc_id: r for r in queries.op13_periodic_runs(spark, _documents(spark, tmp_path, texts)).collect()}
    assert len(found) == len(texts) and sum(r.n_runs for r in found.values()) > 20
    for i, text in enumerate(texts):
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = [(0, 4000, 1)] if words[:1] == ["same"] and n == 4000 else _runs(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        r = found[i]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(_kept(words, runs).encode()).hexdigest()
