"""SQL counterparts of the catalog queries, for checking on small tables.

They are written the plain way (all pairs, windows over whole tables), so that
they share no idea with the distributed plans they check.
"""

from __future__ import annotations

from textcheck.constants import (CONTRACTIONS, KEYBOARD_NEIGHBOURS, MAX_FEATURES, PERTURBATIONS,
                                 PROTECTED_WORDS, SUGGESTIONS)
from textcheck.operators.scoring import LexiconScorer, score_column
from textcheck.plans import datasets as ds

ORACLES: dict[str, str] = {}

TOKEN = r"[\p{L}\p{N}_]{2,}"


def quoted(*words: str) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def clean(text: str, remove_punct: bool = False) -> str:
    out = f"lower(coalesce({text}, ''))"
    out = rf"regexp_replace({out}, 'https?://\S+', ' ', 'g')"
    out = f"regexp_replace({out}, '<.*?>', ' ', 'g')"
    for short, long in CONTRACTIONS.items():
        out = f"replace({out}, {quoted(short)}, {quoted(long)})"
    if remove_punct:
        out = rf"regexp_replace({out}, '[^a-zA-Z0-9\s]', ' ', 'g')"
    return rf"trim(regexp_replace({out}, '\s+', ' ', 'g'))"


def tokens(text: str, lowercase: bool = True) -> str:
    return f"regexp_extract_all({f'lower({text})' if lowercase else text}, '{TOKEN}')"


def share(text: str, scorer: LexiconScorer) -> str:
    words = tokens(text, scorer.lowercase)
    hits = f"len(list_filter({words}, lambda w: w IN ({quoted(*scorer.words)})))"
    return f"(CASE WHEN len({words}) > 0 THEN {hits} / len({words}) ELSE 0.0 END)::DOUBLE"


def seeded(expr: str, seed: int = 42) -> str:
    return f"('0x' || substr(md5('{seed}:' || {expr}), 1, 15))::BIGINT"


LABELLED = """labelled AS (
  SELECT d.doc_id, d.text, d.lang, l.quality, l.toxic, (d.lang = 'en')::INT AS is_en
  FROM documents d JOIN labels l USING (doc_id))"""
ALL_ROWS = """all_rows AS (
  SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"""


def split(source: str, label: str, key: str, frac: float = 0.8) -> str:
    """CTEs ending in ``flagged``: source.* plus is_train."""
    return f"""
  label_n AS (SELECT {label} AS label, count(*) AS n FROM {source} GROUP BY 1),
  label_total AS (SELECT sum(n)::BIGINT AS total, floor({frac}::DOUBLE * sum(n)) AS wanted FROM label_n),
  label_share AS (
    SELECT label, n, (n / total) * wanted AS part, floor((n / total) * wanted) AS base
    FROM label_n, label_total),
  label_take AS (
    SELECT label, base + CASE WHEN row_number() OVER (ORDER BY part - base DESC, label)
      <= (SELECT wanted FROM label_total) - (SELECT sum(base) FROM label_share)
      THEN 1 ELSE 0 END AS take FROM label_share),
  flagged AS (
    SELECT s.*, row_number() OVER (PARTITION BY s.{label} ORDER BY {seeded(f's.{key}')}, s.{key})
      <= t.take AS is_train
    FROM {source} s JOIN label_take t ON s.{label} IS NOT DISTINCT FROM t.label)"""


# --- preparation -------------------------------------------------------------

ORACLES["load_dataset"] = """
SELECT count(*) AS n_rows,
  (SELECT count(*) FROM (DESCRIBE documents)) AS n_columns FROM documents"""
ORACLES["clean_text"] = f"SELECT doc_id, {clean('text')} AS text FROM documents"
ORACLES["clean_html"] = f"SELECT page_id, {clean('html')} AS html FROM pages"
ORACLES["clean_url"] = f"""
SELECT page_id, {clean("'See ' || url || ' now, it''s there'")} AS text FROM pages"""
ORACLES["clean_text_no_punct"] = f"""
SELECT conv_id, turn, {clean('text', True)} AS text FROM conversations"""
ORACLES["drop_empty_text"] = f"""
SELECT kind, count(*) AS n_before, count(*) FILTER (length(t) > 0) AS n_after,
  count(*) FILTER (length(t) = 0) AS n_dropped
FROM (SELECT 'url' AS kind, {clean('url')} AS t FROM pages
      UNION ALL SELECT role, {clean('text')} FROM conversations) GROUP BY kind"""
for _name in ("normalize_labels_long", "normalize_labels_short"):
    ORACLES[_name] = "SELECT doc_id, quality::BIGINT AS label FROM labels"
ORACLES["coerce_labels"] = ORACLES["normalize_labels_long"]
ORACLES["normalize_labels_digits"] = """
SELECT doc_id, (quality + 2 * toxic)::BIGINT AS label FROM labels"""
ORACLES["normalize_labels_unchanged"] = "SELECT doc_id, lang AS label FROM documents"
ORACLES["stratified_split"] = f"""
WITH {LABELLED}, {split('labelled', 'quality', 'doc_id')}
SELECT doc_id, quality, is_train FROM flagged"""
ORACLES["prepare_and_split"] = f"""
WITH {LABELLED},
  cleaned AS (SELECT doc_id, {clean('text')} AS text, quality::BIGINT AS label FROM labelled),
  kept AS (SELECT * FROM cleaned WHERE length(text) > 0), {split('kept', 'label', 'doc_id')}
SELECT doc_id, text, label, CASE WHEN is_train THEN 'train' ELSE 'test' END AS side FROM flagged"""
ORACLES["head_rows"] = """
SELECT event_id, event_type, round(value, 6) AS value FROM events ORDER BY event_id LIMIT 1500"""
ORACLES["sample_rows"] = f"""
SELECT doc_id, text FROM documents ORDER BY {seeded('doc_id')}, doc_id LIMIT 800"""
ORACLES["drop_null_rows"] = f"""
WITH {ALL_ROWS} SELECT text, quality FROM all_rows WHERE text IS NOT NULL AND quality IS NOT NULL"""

# --- dataset health ------------------------------------------------------------

DOCUMENT_COLUMNS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string",
                    "n_chars": "bigint", "quality": "int", "toxic": "int"}
LINEITEM_COLUMNS = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}


def profile(source: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS column_type, "
        f"count(*) FILTER ({name} IS NULL) AS n_null, "
        + (f"count(*) FILTER ({name} = '')" if kind == "string" else "0::BIGINT")
        + f" AS n_empty FROM {source}" for name, kind in columns.items())


ORACLES["column_profile"] = f"WITH {ALL_ROWS} {profile('all_rows', DOCUMENT_COLUMNS)}"
ORACLES["column_profile_lineitem"] = profile("lineitem", LINEITEM_COLUMNS)
ORACLES["exact_duplicate_count"] = """
SELECT (SELECT count(*) FROM documents)
  - (SELECT count(*) FROM (SELECT DISTINCT text FROM documents)) AS exact_duplicates"""
ORACLES["duplicate_rows"] = """
SELECT doc_id, text, lang, source, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 ORDER BY doc_id LIMIT 5"""
ORACLES["label_distribution"] = f"""
WITH {ALL_ROWS} SELECT quality, count(*) AS n FROM all_rows WHERE quality IS NOT NULL GROUP BY 1"""
EXTREMES = """
SELECT (SELECT quality FROM c ORDER BY n DESC, quality LIMIT 1) AS most_common, max(n) AS n_most,
  (SELECT quality FROM c ORDER BY n, quality LIMIT 1) AS least_common, min(n) AS n_least FROM c"""
ORACLES["label_extremes"] = f"""
WITH {ALL_ROWS}, c AS (SELECT quality, count(*) AS n FROM all_rows WHERE quality IS NOT NULL GROUP BY 1)
{EXTREMES}"""
ORACLES["class_balance"] = f"""
WITH {ALL_ROWS} SELECT quality, count(*) AS n,
  round(count(*) / (SELECT count(*) FROM all_rows), 6) AS fraction FROM all_rows GROUP BY 1"""

# --- toxicity and identity -----------------------------------------------------

TOXICITY = share("text", ds.TOXIC)
ORACLES["score_toxicity"] = f"SELECT doc_id, round({TOXICITY}, 6) AS toxicity FROM documents"


def identity(scorer: LexiconScorer) -> str:
    return f"greatest({share('text', scorer)}, 1 - {share('text', scorer)})"


ORACLES["score_identity"] = "SELECT doc_id, " + ", ".join(
    f"round({identity(s)}, 6) AS {score_column(s)}" for s in ds.IDENTITY) + " FROM documents"
TOP = f"""top_of AS (SELECT *, CASE WHEN share > 0.5 THEN 'toxic' ELSE 'non-toxic' END AS label,
  greatest(share, 1 - share) AS score FROM (SELECT *, {TOXICITY} AS share FROM %s))"""
ORACLES["top_label"] = f"""
WITH {TOP % 'documents'} SELECT doc_id, label, round(score, 6) AS score FROM top_of"""


def bias(source: str, digits: int = 6) -> str:
    maxima = ", ".join(
        f"round(max({identity(s)}), {digits}) AS max_{score_column(s)}" for s in ds.IDENTITY)
    return f"""SELECT count(*) AS n_scored, round(avg({TOXICITY}), {digits}) AS toxicity_mean, {maxima},
      round(quantile_cont({TOXICITY}, 0.95), {digits}) AS toxicity_p95 FROM {source}"""


ORACLES["bias_summary"] = bias("documents")

# --- similarity ------------------------------------------------------------------


def text_pairs(source: str, threshold: float = 0.9, keep: str = "") -> str:
    """CTEs: all_pairs over single rows, by brute force, and grp (rows with equal words)."""
    return f"""
  tok AS (SELECT doc_id, text, {keep} {tokens('text')} AS words FROM {source}),
  grp AS (SELECT doc_id, text, {keep} first_value(doc_id) OVER g AS rep, count(*) OVER (PARTITION BY list_sort(words)) AS copies
          FROM tok WHERE len(words) > 0 WINDOW g AS (PARTITION BY list_sort(words) ORDER BY doc_id)),
  tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM tok) GROUP BY 1, 2),
  df AS (SELECT term, ln((1 + (SELECT count(*) FROM {source})) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY 1),
  raw AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN df USING (term)),
  vec AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS x FROM raw),
  all_pairs AS (SELECT a.doc_id AS idx1, b.doc_id AS idx2, sum(a.x * b.x) AS similarity
    FROM vec a JOIN vec b ON a.term = b.term AND a.doc_id < b.doc_id
    GROUP BY 1, 2 HAVING sum(a.x * b.x) >= {threshold})"""


# Pairs of group representatives, and every later copy next to its representative.
COMPACT = """
SELECT p.idx1, p.idx2, round(CASE WHEN a.rep = b.rep THEN 1.0 ELSE p.similarity END, 6) AS similarity,
  a.copies AS copies1, b.copies AS copies2, left(a.text, 200) AS text1, left(b.text, 200) AS text2
FROM all_pairs p JOIN grp a ON a.doc_id = p.idx1 JOIN grp b ON b.doc_id = p.idx2
WHERE a.doc_id = a.rep AND (a.rep = b.rep OR b.doc_id = b.rep)"""
ORACLES["tfidf_pairs"] = f"WITH {text_pairs('documents')} {COMPACT}"
ORACLES["tfidf_links"] = f"""
WITH {text_pairs('documents')},
  n AS (SELECT id, count(*) AS n FROM (SELECT idx1 AS id FROM all_pairs UNION ALL SELECT idx2 FROM all_pairs) GROUP BY 1)
SELECT d.doc_id AS id, coalesce(g.rep, d.doc_id) AS class_id, coalesce(n.n, 0) AS n_links
FROM documents d LEFT JOIN grp g ON g.doc_id = d.doc_id LEFT JOIN n ON n.id = d.doc_id"""
ORACLES["tfidf_later_rows"] = f"""
WITH {text_pairs('documents')}
SELECT min(idx1) AS idx1, idx2, round(max(similarity), 6) AS similarity FROM all_pairs GROUP BY idx2"""
ORACLES["hashed_embedding_pairs"] = f"""
WITH e AS (SELECT 2 * vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
  v AS (SELECT * FROM e UNION ALL SELECT id + 1, [floor(x * 16 + 0.5) / 16 for x in v] FROM e),
  p AS (SELECT a.id AS idx1, b.id AS idx2,
    list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)) AS s
    FROM v a JOIN v b ON a.id < b.id)
SELECT idx1, idx2, round(s, 6) AS similarity FROM p WHERE s >= {ds.COARSE_THRESHOLD}"""
ORACLES["pair_count"] = f"""
WITH {text_pairs('documents')} SELECT count(*) AS n_pairs FROM all_pairs"""
ORACLES["pair_preview"] = f"""
WITH {text_pairs('documents')}
SELECT p.idx1, p.idx2, round(p.similarity, 6) AS similarity, left(a.text, 200) AS text1,
  left(b.text, 200) AS text2
FROM all_pairs p JOIN documents a ON a.doc_id = p.idx1 JOIN documents b ON b.doc_id = p.idx2
ORDER BY round(p.similarity, 6) DESC, p.idx1, p.idx2 LIMIT 100"""
ORACLES["embedding_pairs"] = f"""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e, min(vec_id) OVER (PARTITION BY embedding) AS rep,
    count(*) OVER (PARTITION BY embedding) AS copies FROM embeddings),
  p AS (SELECT a.vec_id AS idx1, b.vec_id AS idx2, a.copies AS copies1, b.copies AS copies2, a.rep AS r1, b.rep AS r2,
    list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) AS s
    FROM v a JOIN v b ON a.vec_id < b.vec_id)
SELECT idx1, idx2, round(s, 6) AS similarity, copies1, copies2, 'vector ' || idx1 AS text1,
  'vector ' || idx2 AS text2 FROM p
WHERE s >= {ds.EMBEDDING_THRESHOLD} AND idx1 = r1 AND (r1 = r2 OR idx2 = r2)"""
HALVES = f"""
  {split('documents', 'lang', 'doc_id')}, {text_pairs('flagged', keep='is_train,')},
  leaks AS (SELECT least(a.rep, b.rep) AS idx1, greatest(a.rep, b.rep) AS idx2, similarity,
      CASE WHEN a.is_train THEN b.doc_id ELSE a.doc_id END AS test_id, a.rep = b.rep AS same
    FROM all_pairs p JOIN grp a ON a.doc_id = p.idx1 JOIN grp b ON b.doc_id = p.idx2
    WHERE a.is_train <> b.is_train)"""
ORACLES["leakage_pairs"] = f"""
WITH {HALVES} SELECT idx1, idx2, round(CASE WHEN idx1 = idx2 THEN 1.0 ELSE max(similarity) END, 6) AS similarity,
  count(*) AS n_leaks FROM leaks GROUP BY idx1, idx2"""
ORACLES["leakage_free_test"] = f"""
WITH {HALVES} SELECT doc_id, lang FROM flagged
WHERE NOT is_train AND doc_id NOT IN (SELECT test_id FROM leaks)"""

# --- classifier ------------------------------------------------------------------

WORD_PAIRS = """
  tok AS (SELECT doc_id, {tokens} AS words FROM documents),
  grams AS (SELECT doc_id, unnest(words || list_transform(range(1, len(words)),
      lambda i: words[i] || ' ' || words[i + 1])) AS term FROM tok WHERE len(words) > 0),
  tf AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY 1, 2),
  vocabulary AS (SELECT term, sum(tf) AS total, count(*) AS doc_freq FROM tf GROUP BY 1
    ORDER BY total DESC, term LIMIT {limit}),
  raw AS (SELECT doc_id, term, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + doc_freq)) + 1) AS w
    FROM tf JOIN vocabulary USING (term)),
  vec AS (SELECT doc_id AS id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)
""".format(tokens=tokens("text"), limit=MAX_FEATURES)
ORACLES["tfidf_features"] = f"WITH {WORD_PAIRS} SELECT id, term, round(weight, 6) AS weight FROM vec"


def predicted(source: str) -> str:
    return f"""predicted AS (SELECT *, (y_prob >= {ds.QUALITY.cut})::INT AS y_pred
      FROM (SELECT *, {share('text', ds.QUALITY)} AS y_prob FROM {source}))"""


ORACLES["predict"] = f"""
WITH {predicted('documents')} SELECT doc_id, round(y_prob, 6) AS y_prob, y_pred FROM predicted"""
PREDICTIONS = f"{LABELLED}, {predicted('labelled')}"
ORACLES["predictions_table"] = f"""
WITH {PREDICTIONS} SELECT doc_id AS id, text, quality AS y_true, y_pred, round(y_prob, 6) AS y_prob
FROM predicted"""
ORACLES["accuracy"] = f"""
WITH {PREDICTIONS} SELECT round(avg((quality = y_pred)::INT), 6) AS accuracy FROM predicted"""


def classes(source: str = "predicted") -> str:
    return f"""classes AS (
    SELECT l.label::VARCHAR AS label, count(*) FILTER (quality = l.label) AS support,
      count(*) FILTER (y_pred = l.label) AS predicted_n,
      count(*) FILTER (quality = l.label AND y_pred = l.label) AS hits
    FROM {source}, (SELECT DISTINCT quality AS label FROM {source} UNION SELECT DISTINCT y_pred FROM {source}) l
    GROUP BY 1),
  scores AS (SELECT label, support, hits, CASE WHEN predicted_n = 0 THEN 0 ELSE hits / predicted_n END AS precision,
      CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall,
      CASE WHEN support + predicted_n = 0 THEN 0 ELSE 2 * hits / (support + predicted_n) END AS f1_score FROM classes)"""


ORACLES["weighted_f1"] = f"""
WITH {PREDICTIONS}, {classes()}
SELECT round(sum(f1_score * support) / sum(support), 6) AS weighted_f1 FROM scores"""
ORACLES["classification_report"] = f"""
WITH {PREDICTIONS}, {classes()}, t AS (SELECT sum(support) AS n, sum(hits) / sum(support) AS acc FROM scores)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1_score, 6) AS f1_score, support::BIGINT AS support FROM scores
UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), n::BIGINT FROM t
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1_score), 6),
  sum(support)::BIGINT FROM scores
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1_score * support) / sum(support), 6),
  sum(support)::BIGINT FROM scores"""

# --- fairness ------------------------------------------------------------------

# RE2 takes \b for ASCII letters only, hence the explicit borders.
HAS_WORD = (r"regexp_matches(lower(text), '(^|[^\p{L}\p{N}_])("
            + "|".join(PROTECTED_WORDS) + r")($|[^\p{L}\p{N}_])')")
ORACLES["tag_protected"] = f"SELECT doc_id, {HAS_WORD} AS is_protected FROM documents"


def slices(mask: str) -> str:
    return f"""slices AS (
    SELECT CASE WHEN {mask} THEN 'protected' ELSE 'non_protected' END AS slice, count(*) AS n,
      avg((quality = y_pred)::INT) AS accuracy,
      coalesce(count(*) FILTER (quality = 1 AND y_pred = 1) / nullif(count(*) FILTER (quality = 1), 0), 0) AS tpr,
      avg((y_pred = 1)::INT) AS selection_rate FROM predicted GROUP BY 1)"""


ORACLES["group_metrics"] = f"""
WITH {PREDICTIONS}, {slices(HAS_WORD)} SELECT slice, n, round(accuracy, 6) AS accuracy,
  round(tpr, 6) AS tpr, round(selection_rate, 6) AS selection_rate FROM slices"""


def gap(column: str) -> str:
    return (f"abs(max(CASE WHEN slice = 'protected' THEN {column} END)"
            f" - max(CASE WHEN slice = 'non_protected' THEN {column} END))")


ORACLES["fairness_gaps"] = f"""
WITH {PREDICTIONS}, {slices(HAS_WORD)} SELECT round({gap('accuracy')}, 6) AS demographic_parity_diff,
  round({gap('tpr')}, 6) AS equalized_odds_tpr_diff,
  round({gap('selection_rate')}, 6) AS selection_rate_diff FROM slices"""


def by_attribute(pred: str, source: str) -> str:
    return f"""rates AS (
    SELECT is_en, avg(({pred} = 1)::INT) AS sel, avg(({pred} <> quality)::INT) AS err,
      count(*) FILTER (quality = 1 AND {pred} = 1) / nullif(count(*) FILTER (quality = 1), 0) AS tpr,
      count(*) FILTER (quality <> 1 AND {pred} = 1) / nullif(count(*) FILTER (quality <> 1), 0) AS fpr
    FROM {source} GROUP BY 1)"""


FIVE = {
    "statistical_parity_difference": "u.sel - p.sel",
    "disparate_impact": "u.sel / nullif(p.sel, 0)",
    "equal_opportunity_difference": "u.tpr - p.tpr",
    "average_abs_odds_difference": "(abs(u.fpr - p.fpr) + abs(u.tpr - p.tpr)) / 2",
    "error_rate_difference": "u.err - p.err",
}
FIVE_SQL = "SELECT " + ", ".join(f"round({e}, 6) AS {n}" for n, e in FIVE.items()) + (
    " FROM (SELECT * FROM rates WHERE is_en = 0) u, (SELECT * FROM rates WHERE is_en = 1) p")
ORACLES["attribute_fairness"] = f"WITH {PREDICTIONS}, {by_attribute('y_pred', 'predicted')} {FIVE_SQL}"
ORACLES["attribute_fairness_constant"] = f"WITH {LABELLED}, {by_attribute('1', 'labelled')} {FIVE_SQL}"

# --- robustness ------------------------------------------------------------------

KEYS = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in KEYBOARD_NEIGHBOURS.items()) + "}"


def perturbed(mode: str, key: str) -> str:
    words = r"list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')"

    def number(start: int) -> str:
        return f"('0x' || substr(md5('42:' || {key} || ':' || (p - 1)), {start}, 8))::BIGINT"

    swap_at = f"({number(1)} % (length(w) - 1))"
    key_at = f"({number(1)} % length(w))"
    near = f"{KEYS}[lower(substr(w, ({key_at} + 1)::INT, 1))]"
    return {
        "lower": "lower(text)",
        # Full case mapping: DuckDB maps the sharp s to its capital letter.
        "upper": "replace(upper(text), 'ẞ', 'SS')",
        "no_punc": r"regexp_replace(text, '[\p{P}\p{S}]', ' ', 'g')",
        "extra_ws": r"regexp_replace(text, '\s+', '   ', 'g')",
        "typo_swap": f"""array_to_string(list_transform({words}, lambda w, p: CASE WHEN length(w) < 2 THEN w
          ELSE substr(w, 1, {swap_at}::INT) || substr(w, ({swap_at} + 2)::INT, 1)
            || substr(w, ({swap_at} + 1)::INT, 1) || substr(w, ({swap_at} + 3)::INT) END), ' ')""",
        "typo_keyboard": f"""array_to_string(list_transform({words}, lambda w, p: CASE WHEN {near} IS NULL THEN w
          ELSE substr(w, 1, {key_at}::INT)
            || substr({near}, ({number(9)} % length({near}) + 1)::INT, 1)
            || substr(w, ({key_at} + 2)::INT) END), ' ')""",
    }[mode]


for _mode in PERTURBATIONS:
    ORACLES[f"perturb_{_mode}"] = (
        f"SELECT doc_id, {perturbed(_mode, 'doc_id')} AS perturbed_text FROM documents")
ORACLES["perturb_all"] = "WITH turns AS (SELECT conv_id || '-' || turn AS turn_id, text FROM conversations) " + (
    " UNION ALL ".join(
        f"SELECT turn_id, '{mode}' AS perturb, {perturbed(mode, 'turn_id')} AS perturbed_text FROM turns"
        for mode in PERTURBATIONS))


def details(source: str) -> str:
    """CTE details over ``source`` (doc_id, text, quality)."""
    rows = " UNION ALL ".join(
        f"SELECT doc_id, text, quality, '{mode}' AS perturb, {perturbed(mode, 'doc_id')} AS changed FROM {source}"
        for mode in PERTURBATIONS)
    return f"""details AS (
    SELECT *, (p0 >= {ds.QUALITY.cut})::INT AS y0, (p1 >= {ds.QUALITY.cut})::INT AS y1
    FROM (SELECT *, {share('text', ds.QUALITY)} AS p0, {share('changed', ds.QUALITY)} AS p1 FROM ({rows})))"""


ORACLES["robustness_details"] = f"""
WITH {LABELLED}, {details('labelled')}
SELECT doc_id AS id, text AS orig_text, perturb, changed AS perturbed_text, quality AS y_true,
  y0 AS y_pred_base, y1 AS y_pred_perturbed, round(p0, 6) AS y_prob_base,
  round(p1, 6) AS y_prob_perturbed FROM details"""
SUMMARY = """SELECT perturb, count(*) AS n_examples, avg((y0 <> y1)::INT) AS flip_rate,
  avg(abs(p1 - p0)) AS avg_conf_change FROM details GROUP BY 1"""
ORACLES["robustness_summary"] = f"""
WITH {LABELLED}, {details('labelled')}, s AS ({SUMMARY})
SELECT perturb, n_examples, round(flip_rate, 6) AS flip_rate,
  round(avg_conf_change, 6) AS avg_conf_change FROM s"""

# --- explainability ----------------------------------------------------------------

COEFFICIENTS = ", ".join(f"({quoted(term)}, {c}::DOUBLE)" for term, c in ds.COEFFICIENTS.items())
ORACLES["linear_importance"] = f"""
WITH {WORD_PAIRS},
  c(term, coefficient) AS (VALUES {COEFFICIENTS}),
  dense AS (SELECT d.doc_id, c.term, c.coefficient, coalesce(v.weight, 0) AS x
    FROM documents d CROSS JOIN c LEFT JOIN vec v ON v.id = d.doc_id AND v.term = c.term
    WHERE c.term IN (SELECT term FROM vocabulary)),
  centred AS (SELECT term, coefficient, x - avg(x) OVER (PARTITION BY term) AS dx FROM dense)
SELECT term, round(coefficient, 6) AS coefficient, round(avg(abs(coefficient * dx)), 6) AS importance
FROM centred GROUP BY term, coefficient"""
ORACLES["token_occlusion"] = f"""
WITH tok AS (SELECT doc_id AS id, {tokens('text', False)} AS words FROM documents),
  hit AS (SELECT id, len(words) AS size, len(list_filter(words, lambda w: w IN ({quoted(*ds.QUALITY.words)}))) AS hits FROM tok),
  c AS (SELECT id, token, count(*) AS n FROM (SELECT id, unnest(words) AS token FROM tok) GROUP BY 1, 2),
  r AS (SELECT id, token, hits / size AS base_prob, CASE WHEN size = n THEN 0.0
      ELSE (hits - CASE WHEN token IN ({quoted(*ds.QUALITY.words)}) THEN n ELSE 0 END) / (size - n) END AS prob_without
    FROM c JOIN hit USING (id)),
  k AS (SELECT *, base_prob - prob_without AS change, row_number() OVER (
      PARTITION BY id ORDER BY round(abs(base_prob - prob_without), 9) DESC, token) AS rank FROM r)
SELECT id, token, round(base_prob, 6) AS base_prob, round(prob_without, 6) AS prob_without,
  round(change, 6) AS change, rank::INT AS rank FROM k WHERE rank <= 10"""

ORACLES["batch_occlusion"] = ORACLES["token_occlusion"]
ORACLES["batch_toxicity"] = f"""
WITH l AS (SELECT doc_id, toxic, {tokens('text')} AS words FROM labels JOIN documents USING (doc_id)),
  n AS (SELECT count(*) FILTER (toxic = 1) AS n1, count(*) FILTER (toxic <> 1) AS n0 FROM l),
  w AS (SELECT doc_id, toxic, unnest(words) AS term FROM l),
  k AS (SELECT term FROM w GROUP BY term ORDER BY count(*) DESC, term LIMIT {ds.ODDS_TERMS}),
  odds AS (SELECT term, ln((count(DISTINCT doc_id) FILTER (toxic = 1) + 1) / (n1 + 2))
      - ln((count(DISTINCT doc_id) FILTER (toxic <> 1) + 1) / (n0 + 2)) AS weight
    FROM w JOIN k USING (term), n GROUP BY term, n1, n0),
  found AS (SELECT DISTINCT doc_id, unnest({tokens('text')}) AS term FROM documents),
  pushed AS (SELECT doc_id, sum(weight) AS z FROM found JOIN odds USING (term) GROUP BY 1)
SELECT doc_id, round(1 / (1 + exp(-(coalesce(z, 0) + ln((n1 + 1) / (n0 + 1))))), 6) AS toxicity
FROM documents LEFT JOIN pushed USING (doc_id), n"""

# --- drift ---------------------------------------------------------------------------

NUMBERS = """numbers AS (
  SELECT 'n_chars' AS feature, lang <> 'en' AS is_current, n_chars::DOUBLE AS value FROM documents
  UNION ALL SELECT 'event_value', epoch_us(ts) > (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) / 2 FROM events),
    value FROM events)"""
DIMENSIONS = """numbers AS (
  SELECT printf('dim_%03d', dim - 1) AS feature, is_current, e[dim]::DOUBLE AS value
  FROM (SELECT vec_id % 2 = 1 AS is_current, embedding AS e, unnest(range(1, len(embedding) + 1)) AS dim
        FROM embeddings))"""
PSI = """
  edges AS (SELECT feature, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q
    FROM numbers WHERE NOT is_current GROUP BY 1),
  binned AS (SELECT feature, is_current, len(list_filter(q, lambda x: x < value)) AS bin
    FROM numbers JOIN edges USING (feature)),
  grid AS (SELECT feature, unnest(range(10)) AS bin FROM edges),
  sums AS (SELECT feature, count(*) FILTER (NOT is_current) AS nr, count(*) FILTER (is_current) AS nc
    FROM numbers GROUP BY 1),
  shares AS (SELECT g.feature, g.bin,
      greatest(count(b.bin) FILTER (NOT is_current) / any_value(nr), 0.0001::DOUBLE) AS r,
      greatest(count(b.bin) FILTER (is_current) / any_value(nc), 0.0001::DOUBLE) AS c
    FROM grid g JOIN sums USING (feature) LEFT JOIN binned b ON b.feature = g.feature AND b.bin = g.bin GROUP BY 1, 2)
SELECT feature, round(sum((c - r) * ln(c / r)), 6) AS psi FROM shares GROUP BY 1"""
KS = """
  sums AS (SELECT feature, count(*) FILTER (NOT is_current) AS n_ref, count(*) FILTER (is_current) AS n_cur
    FROM numbers GROUP BY 1),
  steps AS (SELECT feature, value, sum(count(*) FILTER (NOT is_current)) OVER w AS r,
      sum(count(*) FILTER (is_current)) OVER w AS c FROM numbers GROUP BY feature, value
    WINDOW w AS (PARTITION BY feature ORDER BY value)),
  d AS (SELECT feature, max(abs(r / n_ref - c / n_cur)) AS d, any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur
    FROM steps JOIN sums USING (feature) GROUP BY 1),
  x AS (SELECT *, sqrt(n_ref::DOUBLE * n_cur / (n_ref + n_cur)) * d AS x FROM d)
SELECT feature, round(d, 6) AS ks_distance, n_ref, n_cur,
  round(CASE WHEN x < 0.2 THEN 1.0 ELSE least(greatest(2 * list_sum(list_transform(range(1, 101),
    lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * k * k * x * x))), 0), 1) END, 6) AS p_value FROM x"""
ORACLES["psi"] = f"WITH {NUMBERS}, {PSI}"
ORACLES["psi_embedding"] = f"WITH {DIMENSIONS}, {PSI}"
ORACLES["ks_two_sample"] = f"WITH {NUMBERS}, {KS}"
ORACLES["ks_two_sample_embedding"] = f"WITH {DIMENSIONS}, {KS}"
ORACLES["target_drift"] = f"""
WITH {LABELLED}, o AS (SELECT quality, is_en, count(*) AS n FROM labelled GROUP BY 1, 2),
  g AS (SELECT q.quality, s.is_en, coalesce(o.n, 0) AS n,
      (SELECT sum(n) FROM o WHERE o.quality = q.quality) * (SELECT sum(n) FROM o WHERE o.is_en = s.is_en)
        / (SELECT sum(n) FROM o) AS e
    FROM (SELECT DISTINCT quality FROM o) q CROSS JOIN (SELECT DISTINCT is_en FROM o) s
    LEFT JOIN o ON o.quality = q.quality AND o.is_en = s.is_en)
SELECT round(sum((n - e) * (n - e) / e), 6) AS chi_square, count(DISTINCT quality) - 1 AS dof FROM g"""
# Lower tail of the gamma function by its power series, from logarithms.
ORACLES["target_drift_test"] = f"""
WITH t AS ({ORACLES['target_drift']}), x AS (SELECT *, dof / 2 AS a, chi_square / 2 AS x FROM t)
SELECT chi_square, dof, round(1 - (SELECT sum(exp((a + k) * ln(x) - x - lgamma(a + k + 1)))
  FROM generate_series(0, 2000) s(k)), 6) AS p_value FROM x"""
ORACLES["lexicon_auc"] = f"""
WITH {PREDICTIONS}, g AS (SELECT y_prob, quality = 1 AS good FROM predicted),
  r AS (SELECT good, rank() OVER (ORDER BY y_prob) + (count(*) OVER (PARTITION BY y_prob) - 1) / 2 AS r FROM g)
SELECT round((sum(r) FILTER (good) - (count(*) FILTER (good)) * ((count(*) FILTER (good)) + 1) / 2)
  / ((count(*) FILTER (good)) * (count(*) FILTER (NOT good))), 6) AS auc FROM r"""
ORACLES["label_quotas"] = """
WITH s AS (SELECT l_suppkey AS "group", count(*) AS n FROM lineitem GROUP BY 1),
  w AS (SELECT *, floor(0.8 * (SELECT sum(n) FROM s)) AS wanted, (SELECT sum(n) FROM s) AS total FROM s),
  q AS (SELECT *, n::DOUBLE / total * wanted AS share FROM w),
  r AS (SELECT *, row_number() OVER (ORDER BY floor(share) - share, "group") AS place,
    wanted - (SELECT sum(floor(share)) FROM q) AS spare FROM q)
SELECT "group", n, (floor(share) + CASE WHEN place <= spare THEN 1 ELSE 0 END)::BIGINT AS take FROM r"""
ORACLES["target_share"] = f"""
WITH {LABELLED}, m AS (SELECT avg(quality) FILTER (is_en = 1) AS reference,
  avg(quality) FILTER (is_en = 0) AS current FROM labelled)
SELECT round(reference, 6) AS reference, round(current, 6) AS current,
  round(current - reference, 6) AS shift FROM m"""

# --- repair --------------------------------------------------------------------------


def rebalanced(source: str, out: str, keep: str) -> str:
    """CTE ``out``: source with a majority above 0.6 cut down to ``keep`` rows."""
    return f"""{out}_n AS (SELECT quality, count(*) AS n, sum(count(*)) OVER () AS total FROM {source} GROUP BY 1),
  {out}_top AS (SELECT quality AS top, n, total FROM {out}_n ORDER BY n DESC, quality LIMIT 1),
  {out} AS (SELECT {source}.* FROM {source}, {out}_top QUALIFY quality <> top OR n / total <= 0.6::DOUBLE
    OR row_number() OVER (PARTITION BY quality ORDER BY {seeded('doc_id')}, doc_id) <= {keep})"""


REFERENCE_KEEP = "floor(0.6::DOUBLE * total)"


def deduped(source: str, out: str) -> str:
    return f"""{out} AS (SELECT * FROM {source}
    WHERE doc_id NOT IN (SELECT idx2 FROM all_pairs WHERE similarity >= 0.92))"""


REPAIRED = f"""{LABELLED}, {text_pairs('labelled')}, {deduped('labelled', 'deduped')},
  {rebalanced('deduped', 'repaired', REFERENCE_KEEP)}"""
ORACLES["apply_dedupe"] = f"""
WITH {text_pairs('documents')}, {deduped('documents', 'deduped')} SELECT doc_id, text FROM deduped"""
ORACLES["apply_rebalance"] = f"""
WITH {LABELLED}, {rebalanced('labelled', 'kept', REFERENCE_KEEP)} SELECT doc_id, quality FROM kept"""
ORACLES["apply_rebalance_exact"] = f"""
WITH {LABELLED}, {rebalanced('labelled', 'kept',
    'floor(0.6::DOUBLE * (total - n) / (1 - 0.6::DOUBLE))')} SELECT doc_id, quality FROM kept"""
ORACLES["repair_chain"] = f"WITH {REPAIRED} SELECT doc_id, quality FROM repaired"


def rule(order: int, name: str, source: str, fires: str, reason: list[str],
         action: list[str] | None = None) -> str:
    title, reason_text, action_text = SUGGESTIONS[name]
    filled = f"printf({quoted(reason_text)}, {', '.join(reason)})"
    act = f"printf({quoted(action_text)}, {', '.join(action)})" if action else quoted(action_text)
    return (f"SELECT {order} AS o, '{name}' AS rule, {quoted(title)} AS title, {filled} AS reason, "
            f"{act} AS action FROM {source} WHERE {fires}")


WORST = "CASE perturb " + " ".join(
    f"WHEN '{m}' THEN {i}" for i, m in enumerate(PERTURBATIONS)) + " END"
ORACLES["repair_plan"] = f"""
WITH {PREDICTIONS}, {text_pairs('labelled')}, {details('labelled')}, {slices('is_en = 1')},
  n_pairs AS (SELECT count(*) AS n FROM all_pairs),
  balance AS (SELECT quality::VARCHAR AS label, count(*) / (SELECT count(*) FROM labelled) AS f FROM labelled GROUP BY 1),
  ends AS (SELECT (SELECT label FROM balance ORDER BY f DESC, label LIMIT 1) AS hi, max(f) AS hf,
      (SELECT label FROM balance ORDER BY f, label LIMIT 1) AS lo, min(f) AS lf FROM balance),
  worst AS (SELECT perturb FROM ({SUMMARY}) ORDER BY flip_rate DESC, {WORST} LIMIT 1),
  tox AS ({bias('labelled')}), gaps AS (SELECT {gap('tpr')} AS g FROM slices),
  plan AS ({rule(0, 'dedup', 'n_pairs', 'n > 0', ['n'])}
    UNION ALL {rule(1, 'rebalance', 'ends', 'hf >= 0.6::DOUBLE', ['hi', 'hf', 'lo', 'lf'])}
    UNION ALL {rule(2, 'augment', 'worst', 'true', ['perturb'], ['perturb'])}
    UNION ALL {rule(3, 'toxicity', 'tox', 'toxicity_p95 > 0.7', ['toxicity_p95'])}
    UNION ALL {rule(4, 'fairness', 'gaps', 'g > 0.1', ['g'])})
SELECT row_number() OVER (ORDER BY o) AS position, rule, title, reason, action FROM plan"""
ORACLES["repair_document"] = f"""
WITH {LABELLED}, p AS ({ORACLES['repair_plan']})
SELECT 'class_balance' AS part, quality::VARCHAR AS name, round(count(*) / (SELECT count(*) FROM labelled), 6) AS fraction,
  count(*) AS n FROM labelled GROUP BY 2
UNION ALL SELECT 'suggestion', rule, NULL, position FROM p"""
ORACLES["dataset_document"] = f"""
WITH {LABELLED}, {text_pairs('labelled')},
  d AS (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM labelled),
  f AS (SELECT doc_id FROM d WHERE k > 1 ORDER BY doc_id LIMIT 5),
  t AS (SELECT idx1, idx2, round(similarity, 6) AS s FROM all_pairs ORDER BY 3 DESC, 1, 2 LIMIT 100)
SELECT (SELECT count(*) FROM d WHERE k > 1) AS exact_duplicates, (SELECT count(*) FROM all_pairs) AS n_pairs,
  (SELECT '[' || coalesce(string_agg(doc_id, ', ' ORDER BY doc_id), '') || ']' FROM f) AS duplicates,
  (SELECT '[' || coalesce(string_agg(idx1 || '-' || idx2, ', ' ORDER BY s DESC, idx1, idx2), '') || ']' FROM t) AS pairs,
  (SELECT quality FROM labelled GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS most_common,
  0.0::DOUBLE AS statistical_parity_difference"""

# --- report --------------------------------------------------------------------------


def cells(section: str, source: str, values: dict[str, str], key: str = "''", note: bool = False,
          digits: int = 6) -> str:
    kind = ("NULL::DOUBLE AS value, ({0})::VARCHAR AS note" if note
            else f"round(({{0}})::DOUBLE, {digits}) AS value, NULL::VARCHAR AS note")
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, '{metric}' AS metric, ({key})::VARCHAR AS key, "
        f"{kind.format(expr)} FROM {source}" for metric, expr in values.items())


LABELLED_COLUMNS = {"doc_id": "bigint", "text": "string", "lang": "string", "quality": "int",
                    "toxic": "int", "is_en": "int"}
ORACLES["audit_report"] = f"""
WITH {LABELLED}, {text_pairs('labelled')}, {by_attribute('1', 'labelled')}, {TOP % 'labelled'},
  prof AS ({profile('labelled', LABELLED_COLUMNS)}),
  c AS (SELECT quality, count(*) AS n FROM labelled WHERE quality IS NOT NULL GROUP BY 1),
  ex AS ({EXTREMES}), fair AS ({FIVE_SQL}),
  tops AS (SELECT label, count(*) AS n, avg(score) AS mean_score, max(score) AS max_score FROM top_of GROUP BY 1)
{cells('schema', 'prof', {'n_null': 'n_null', 'n_empty': 'n_empty'}, 'column_name')}
UNION ALL {cells('schema', 'prof', {'column_type': 'column_type'}, 'column_name', True)}
UNION ALL {cells('duplicates', '(SELECT count(*) - count(DISTINCT text) AS x FROM labelled)', {'exact_duplicates': 'x'})}
UNION ALL {cells('class_imbalance', 'c', {'n': 'n'}, 'quality')}
UNION ALL {cells('class_imbalance', 'ex', {'n_most': 'n_most', 'n_least': 'n_least'})}
UNION ALL {cells('class_imbalance', 'ex', {'most_common': 'most_common', 'least_common': 'least_common'}, note=True)}
UNION ALL {cells('toxicity', 'tops', {m: m for m in ('n', 'mean_score', 'max_score')}, 'label')}
UNION ALL {cells('similarity', '(SELECT count(*) AS x FROM all_pairs)', {'n_pairs': 'x'})}
UNION ALL {cells('fairness', 'fair', {m: m for m in FIVE})}"""


def version(source: str, name: str) -> str:
    """CTE m_<name>: the compared metrics of one version."""
    tag = f"{name}_rows"
    return f"""
  {predicted(source).replace('predicted AS', f'{tag}_p AS', 1)},
  {classes(f'{tag}_p').replace('classes AS', f'{tag}_c AS', 1).replace('scores AS', f'{tag}_s AS', 1).replace('FROM classes', f'FROM {tag}_c')},
  {details(source).replace('details AS', f'{tag}_d AS', 1)},
  {tag}_r AS ({SUMMARY.replace('FROM details', f'FROM {tag}_d')}), {tag}_b AS ({bias(source, 12)}),
  m_{name} AS (
    {cells('model', f'{tag}_p', {'accuracy': 'avg((quality = y_pred)::INT)'}, digits=12)}
    UNION ALL {cells('model', f'{tag}_s', {'weighted_f1': 'sum(f1_score * support) / sum(support)'}, digits=12)}
    UNION ALL {cells('bias', f'{tag}_b', {m: m for m in ('toxicity_mean', 'toxicity_p95')}, digits=12)}
    UNION ALL {cells('robustness', f'{tag}_r', {m: m for m in ('flip_rate', 'avg_conf_change')}, 'perturb', digits=12)})"""


BOTH = f"{REPAIRED}, {version('labelled', 'original')}, {version('repaired', 'repaired')}"
COMPARED = """compared AS (
  SELECT section, metric, key, o.value AS original, r.value AS repaired, r.value - o.value AS delta
  FROM m_original o FULL JOIN m_repaired r USING (section, metric, key))"""
ORACLES["version_compare"] = f"""
WITH {BOTH}, {COMPARED} SELECT section, metric, key, round(original, 6) AS original,
  round(repaired, 6) AS repaired, round(delta, 6) AS delta FROM compared"""
ORACLES["takeaways"] = f"""
WITH {BOTH}, {COMPARED}
SELECT 'accuracy_delta' AS takeaway, '' AS name, round(delta, 6) AS value FROM compared WHERE metric = 'accuracy'
UNION ALL (SELECT 'worst_after_repair', key, round(value, 6) FROM m_repaired WHERE metric = 'flip_rate'
  ORDER BY value DESC, {WORST.replace('perturb', 'key')} LIMIT 1)"""
