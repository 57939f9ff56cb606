"""Query name -> function of (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textcheck.constants import PERTURBATIONS
from textcheck.functions import ranks
from textcheck.operators import (batch, classify, drift, explain, fairness, features, health, prepare,
                                 repair, report, robustness, scoring, similarity)
from textcheck.plans import artifacts, audit
from textcheck.plans import datasets as ds
from textcheck.session import materialise, new_folder
from textcheck.sources.tables import dataset_shape, spread

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
# Doubles are reported with this many digits.
DIGITS = 6


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.round(F.col(f.name), DIGITS).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema])


def query(build: Query) -> Query:
    REGISTRY[build.__name__] = lambda spark, sf_dir: rounded(build(spark, sf_dir))
    return build


# --- preparation -------------------------------------------------------------

@query
def load_dataset(spark, d):
    return dataset_shape(ds.documents(spark, d))


@query
def clean_text(spark, d):
    return prepare.clean_text(ds.texts(spark, d), "text")


@query
def clean_html(spark, d):
    return prepare.clean_text(
        spread(ds.table(spark, d, "pages").select("page_id", "html"), "page_id"), "html")


@query
def clean_url(spark, d):
    link = F.concat(F.lit("See "), F.col("url"), F.lit(" now, it's there"))
    return prepare.clean_text(
        ds.table(spark, d, "pages").select("page_id", link.alias("text")), "text")


@query
def clean_text_no_punct(spark, d):
    return prepare.clean_text(ds.table(spark, d, "conversations").select("conv_id", "turn", "text"),
                              "text", remove_punct=True)


@query
def drop_empty_text(spark, d):
    urls = ds.table(spark, d, "pages").select(F.lit("url").alias("kind"), F.col("url").alias("text"))
    turns = ds.table(spark, d, "conversations").select("role", "text")
    return prepare.empty_text_counts(
        prepare.clean_text(urls.union(turns), "text"), "text", "kind")


def _word_labels(spark, d, yes: str, no: str) -> DataFrame:
    return ds.table(spark, d, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, yes).otherwise(no).alias("label"))


@query
def normalize_labels_long(spark, d):
    return prepare.normalize_labels(_word_labels(spark, d, "Positive", "negative"), "label")


@query
def normalize_labels_short(spark, d):
    return prepare.normalize_labels(_word_labels(spark, d, "pos", "NEG"), "label")


@query
def normalize_labels_digits(spark, d):
    return prepare.normalize_labels(ds.table(spark, d, "labels").select(
        "doc_id", (F.col("quality") + 2 * F.col("toxic")).cast("string").alias("label")), "label")


@query
def normalize_labels_unchanged(spark, d):
    return prepare.normalize_labels(
        ds.documents(spark, d, "doc_id", F.col("lang").alias("label")), "label")


@query
def coerce_labels(spark, d):
    mixed = F.when(F.col("toxic") == 1, F.col("quality").cast("string")).otherwise(
        F.when(F.col("quality") == 1, "POS").otherwise("Negative"))
    return prepare.coerce_labels(
        ds.table(spark, d, "labels").select("doc_id", mixed.alias("label")), "label")


@query
def stratified_split(spark, d):
    return ds.flagged(spark, d).select("doc_id", "quality", "is_train")


@query
def prepare_and_split(spark, d):
    raw = ds.labelled(spark, d).select("doc_id", "text", F.when(
        F.col("quality") == 1, "positive").otherwise("negative").alias("label"))
    train, test = prepare.prepare_and_split(raw, "text", "label", "doc_id")
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test")))


@query
def head_rows(spark, d):
    events = ds.table(spark, d, "events").select("event_id", "event_type", "value")
    return prepare.head_rows(events, 1500, "event_id")


@query
def sample_rows(spark, d):
    return prepare.sample_rows(ds.texts(spark, d), 800, "doc_id")


@query
def drop_null_rows(spark, d):
    return prepare.drop_null_rows(ds.all_with_labels(spark, d), "text", "quality")


# --- dataset health ------------------------------------------------------------

@query
def column_profile(spark, d):
    return health.column_profile(ds.all_with_labels(spark, d))


@query
def column_profile_lineitem(spark, d):
    return health.column_profile(ds.table(spark, d, "lineitem"))


@query
def exact_duplicate_count(spark, d):
    return health.exact_duplicate_count(ds.documents(spark, d), "text")


@query
def duplicate_rows(spark, d):
    return health.duplicate_rows(ds.documents(spark, d), "text", "doc_id")


@query
def label_distribution(spark, d):
    return health.label_distribution(ds.all_with_labels(spark, d), "quality")


@query
def label_extremes(spark, d):
    return health.label_extremes(ds.all_with_labels(spark, d), "quality")


@query
def class_balance(spark, d):
    return health.class_balance(ds.all_with_labels(spark, d), "quality")


# --- toxicity and identity -----------------------------------------------------

@query
def score_toxicity(spark, d):
    return scoring.score_toxicity(
        ds.texts(spark, d), "text", ds.TOXIC).drop("text")


@query
def score_identity(spark, d):
    return scoring.score_identity(
        ds.texts(spark, d), "text", ds.IDENTITY).drop("text")


@query
def top_label(spark, d):
    return scoring.top_label(
        ds.texts(spark, d), "text", ds.TOXIC).drop("text")


def _bias(docs: DataFrame) -> DataFrame:
    scored = scoring.score_identity(scoring.score_toxicity(docs, "text", ds.TOXIC), "text",
                                    ds.IDENTITY)
    return scoring.bias_summary(scored, [scoring.score_column(s) for s in ds.IDENTITY])


@query
def bias_summary(spark, d):
    return _bias(ds.texts(spark, d))


@query
def trained_bias_scores(spark, d):
    """Toxicity and a second trained scorer over every document."""
    data = ds.labelled(spark, d)
    toxic = scoring.ModelScorer("trained/toxic", classify.train_classifier(data, "text", "toxic", "doc_id"),
                                ("non-toxic", "toxic"))
    other = scoring.ModelScorer("trained/quality",
                                classify.train_classifier(data, "text", "quality", "doc_id"))
    docs = ds.texts(spark, d)
    return scoring.score_identity(scoring.score_toxicity(docs, "text", toxic), "text",
                                  [toxic, other]).drop("text")


# --- similarity ------------------------------------------------------------------

@query
def tfidf_pairs(spark, d):
    return similarity.tfidf_pairs(ds.texts(spark, d), "text", "doc_id")


@query
def embedding_pairs(spark, d):
    return similarity.embedding_pairs(
        ds.table(spark, d, "embeddings"), "embedding", "vec_id",
        text=F.concat(F.lit("vector "), F.col("vec_id")), threshold=ds.EMBEDDING_THRESHOLD)


def _similar(spark, d):
    return similarity.similar_texts(ds.texts(spark, d), "text", "doc_id")


@query
def tfidf_links(spark, d):
    return similarity.linked_rows(_similar(spark, d))


@query
def tfidf_later_rows(spark, d):
    return similarity.later_rows(_similar(spark, d))


@query
def hashed_embedding_pairs(spark, d):
    """Vectors and their copies in steps of 1/16, found again by hash tables."""
    exact = ds.table(spark, d, "embeddings").select((2 * F.col("vec_id")).alias("id"), F.col(
        "embedding").cast("array<double>").alias("v"))
    coarse = exact.select(F.col("id") + 1, F.transform("v", lambda x: F.floor(x * 16 + 0.5) / 16.0))
    return similarity.hashed_vectors(exact.union(coarse), "v", "id", threshold=ds.COARSE_THRESHOLD).near


@query
def pair_count(spark, d):
    return similarity.pair_count(_similar(spark, d))


@query
def pair_preview(spark, d):
    return similarity.pair_preview(_similar(spark, d))


def _halves(spark, d) -> DataFrame:
    docs = ds.texts(spark, d, "lang")
    return prepare.flag_train(docs, "lang", "doc_id")


@query
def leakage_pairs(spark, d):
    return similarity.leakage_pairs(_halves(spark, d), "text", "doc_id")


@query
def leakage_free_test(spark, d):
    return similarity.leakage_free_test(_halves(spark, d), "text", "doc_id").select(
        "doc_id", "lang")


# --- classifier ------------------------------------------------------------------

def _predictions(spark, d) -> DataFrame:
    return classify.predictions_table(ds.labelled(spark, d), "text", "quality", "doc_id",
                                      ds.QUALITY)


@query
def tfidf_features(spark, d):
    return features.tfidf_features(ds.texts(spark, d), "text", "doc_id")


@query
def predict(spark, d):
    return classify.predict(ds.texts(spark, d), "text", ds.QUALITY).drop(
        "text")


@query
def predictions_table(spark, d):
    return _predictions(spark, d)


@query
def accuracy(spark, d):
    return classify.accuracy(_predictions(spark, d))


@query
def weighted_f1(spark, d):
    return classify.weighted_f1(_predictions(spark, d))


@query
def classification_report(spark, d):
    return classify.classification_report(_predictions(spark, d))


def _trained(spark, d) -> tuple[scoring.ModelScorer, DataFrame, DataFrame]:
    data = ds.flagged(spark, d)
    test = data.filter("NOT is_train")
    scorer, predictions = classify.train_and_predict(data.filter("is_train"), test, "text",
                                                     "quality", "doc_id")
    return scorer, test, predictions


@query
def trained_predictions(spark, d):
    return _trained(spark, d)[2]


@query
def trained_report(spark, d):
    return classify.classification_report(_trained(spark, d)[2])


# --- fairness ------------------------------------------------------------------

@query
def tag_protected(spark, d):
    return fairness.tag_protected(ds.texts(spark, d), "text").drop("text")


def _slices(spark, d) -> DataFrame:
    return fairness.group_metrics(fairness.tag_protected(_predictions(spark, d), "text"))


@query
def group_metrics(spark, d):
    return _slices(spark, d)


@query
def fairness_gaps(spark, d):
    return fairness.fairness_gaps(_slices(spark, d))


@query
def attribute_fairness(spark, d):
    predicted = classify.predict(ds.labelled(spark, d), "text", ds.QUALITY)
    return fairness.attribute_fairness(predicted, "quality", "y_pred", "is_en")


@query
def attribute_fairness_constant(spark, d):
    ones = ds.labelled(spark, d).withColumn("y_pred", F.lit(1))
    return fairness.attribute_fairness(ones, "quality", "y_pred", "is_en")


# --- robustness ------------------------------------------------------------------

def _perturb(mode: str) -> Query:
    def build(spark, d):
        docs = ds.texts(spark, d)
        return robustness.perturb(docs, "text", "doc_id", mode).drop("text")
    build.__name__ = f"perturb_{mode}"
    return build


for _mode in PERTURBATIONS:
    query(_perturb(_mode))


@query
def perturb_all(spark, d):
    turns = ds.table(spark, d, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("turn_id"), "text")
    return robustness.perturb_all(turns, "text", "turn_id").drop("text")


def _details(spark, d, scorer=ds.QUALITY, data=None) -> DataFrame:
    data = ds.labelled(spark, d) if data is None else data
    return robustness.robustness_details(data, "text", "quality", "doc_id", scorer)


@query
def robustness_details(spark, d):
    return _details(spark, d)


@query
def robustness_summary(spark, d):
    return robustness.robustness_summary(_details(spark, d))


@query
def trained_robustness_summary(spark, d):
    scorer, test, _ = _trained(spark, d)
    return robustness.robustness_summary(_details(spark, d, scorer, test))


# --- explainability ----------------------------------------------------------------

@query
def linear_importance(spark, d):
    docs = ds.texts(spark, d)
    coefficients = spark.createDataFrame(list(ds.COEFFICIENTS.items()),
                                         "term string, coefficient double")
    return explain.linear_importance(features.tfidf_features(docs, "text", "doc_id"), coefficients,
                                     docs.agg(F.count("*")).scalar())


@query
def token_occlusion(spark, d):
    return explain.lexicon_occlusion(ds.texts(spark, d), "text", "doc_id",
                                     ds.QUALITY)


@query
def batch_toxicity(spark, d):
    """Word odds of the labelled documents, as a model file that workers load once, over all texts."""
    toxic = ds.table(spark, d, "labels").join(ds.texts(spark, d), "doc_id")
    scorer = batch.fit_word_odds(toxic, "text", "toxic", "doc_id", ds.ODDS_TERMS, labels=("toxic", "other"))
    return scoring.score_toxicity(ds.texts(spark, d), "text", scorer).drop("text")


@query
def batch_occlusion(spark, d):
    return batch.batch_occlusion(ds.texts(spark, d), "text", "doc_id", batch.lexicon_scorer(spark, ds.QUALITY))


@query
def trained_importance(spark, d):
    """Over the training texts, of which the model's weights speak."""
    train = ds.flagged(spark, d).filter("is_train")
    model = classify.train_classifier(train, "text", "quality", "doc_id")
    terms, _ = classify.model_terms(spark, model)
    weights = features.weigh(features.row_terms(train, "text", "doc_id"), terms)
    return explain.linear_importance(weights, terms, train.agg(F.count("*")).scalar())


@query
def trained_occlusion(spark, d):
    scorer, test, _ = _trained(spark, d)
    terms, intercept = classify.model_terms(spark, scorer.model)
    return explain.linear_occlusion(test, "text", "doc_id", terms, intercept)


# --- drift ---------------------------------------------------------------------------

def _numbers(spark, d) -> DataFrame:
    texts = drift.drift_features(
        ds.documents(spark, d, "n_chars", "lang").withColumn("is_current", F.col("lang") != "en"),
        {"n_chars": F.col("n_chars")})
    events = drift.drift_features(ds.event_halves(spark, d), {"event_value": F.col("value")})
    return texts.unionByName(events)


def _dimensions(spark, d) -> DataFrame:
    return drift.vector_features(ds.table(spark, d, "embeddings").withColumn(
        "is_current", F.col("vec_id") % 2 == 1), "embedding")


@query
def psi(spark, d):
    return drift.psi(_numbers(spark, d))


@query
def psi_embedding(spark, d):
    return drift.psi(_dimensions(spark, d))


@query
def ks_two_sample(spark, d):
    return drift.ks_two_sample(_numbers(spark, d))


@query
def ks_two_sample_embedding(spark, d):
    return drift.ks_two_sample(_dimensions(spark, d))


@query
def target_drift(spark, d):
    return drift.target_drift(_lang_sides(spark, d), "quality")


@query
def lexicon_auc(spark, d):
    """How well the share of lexicon words tells good from poor documents."""
    scored = ds.QUALITY.predict(ds.labelled(spark, d), "text")
    return drift.exact_auc(scored.withColumn("good", F.col("quality") == 1), "y_prob", "good")


@query
def label_quotas(spark, d):
    """Training share of every supplier's line items: many small groups."""
    sizes = ds.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("group")).agg(F.count("*").alias("n"))
    return ranks.largest_remainders(sizes, 0.8)


@query
def target_drift_test(spark, d):
    return drift.target_drift_test(_lang_sides(spark, d), "quality")


@query
def target_share(spark, d):
    return drift.target_share(_lang_sides(spark, d), "quality")


def _lang_sides(spark, d) -> DataFrame:
    return ds.labelled(spark, d).withColumn("is_current", F.col("is_en") == 0)


@query
def domain_classifier_auc(spark, d):
    return drift.domain_classifier_auc(ds.sides(spark, d), "text", "doc_id")


@query
def data_drift(spark, d):
    return drift.data_drift(ds.sides(spark, d), "text", "quality", "doc_id",
                            {"text_length": F.length("text")})


# --- repair --------------------------------------------------------------------------

@query
def repair_plan(spark, d):
    data = ds.labelled(spark, d)
    found = similarity.similar_texts(data, "text", "doc_id")
    gaps = fairness.fairness_gaps(fairness.group_metrics(
        _predictions(spark, d).join(data.select(F.col("doc_id").alias("id"), (
            F.col("is_en") == 1).alias("is_protected")), "id")))
    return repair.repair_plan(
        health.class_balance(data, "quality"), "quality", similarity.pair_count(found),
        robustness.robustness_summary(_details(spark, d)), _bias(data), gaps)


@query
def repair_document(spark, d):
    """The repair artifact, written as JSON and read back: class balance, then suggestions."""
    balance = health.class_balance(ds.labelled(spark, d), "quality")
    document = artifacts.repair_document(REGISTRY["repair_plan"](spark, d), balance, "quality")
    folder = new_folder(spark)
    artifacts.write_document(document, folder)
    back = spark.read.schema(document.schema).json(folder)
    shares = back.select(F.explode("class_balance").alias("name", "share")).select(
        F.lit("class_balance").alias("part"), "name", "share.fraction", F.col("share.n").alias("n"))
    return shares.unionByName(back.select(F.inline("suggestions")).select(
        F.lit("suggestion").alias("part"), F.col("rule").alias("name"),
        F.lit(None).cast("double").alias("fraction"), F.col("position").alias("n")))


@query
def dataset_document(spark, d):
    """Pairs and duplicates shown in the dataset artifact, read back from its JSON."""
    document = artifacts.dataset_document(ds.labelled(spark, d), "text", "quality", "doc_id", "is_en", ds.TOXIC)
    folder = new_folder(spark)
    artifacts.write_document(document, folder)
    back = spark.read.schema(document.schema).json(folder)
    return back.select(
        "exact_duplicates.exact_duplicates", "similarity.n_pairs",
        F.transform("duplicate_rows", lambda r: r["doc_id"]).cast("string").alias("duplicates"),
        F.transform("similar_pairs", lambda p: F.concat_ws("-", p["idx1"], p["idx2"])).cast("string").alias("pairs"),
        F.col("class_extremes.most_common").alias("most_common"), "fairness.statistical_parity_difference")


@query
def apply_dedupe(spark, d):
    docs = ds.texts(spark, d)
    return repair.apply_dedupe(docs, similarity.later_rows(_similar(spark, d)), "doc_id")


@query
def apply_rebalance(spark, d):
    return repair.apply_rebalance(ds.labelled(spark, d), "quality", "doc_id").select(
        "doc_id", "quality")


@query
def apply_rebalance_exact(spark, d):
    return repair.apply_rebalance(ds.labelled(spark, d), "quality", "doc_id", mode="exact").select(
        "doc_id", "quality")


def _repaired(data: DataFrame) -> DataFrame:
    later = similarity.later_rows(similarity.similar_texts(data, "text", "doc_id"))
    return repair.repair_chain(data, later, "quality", "doc_id")


@query
def repair_chain(spark, d):
    return _repaired(ds.labelled(spark, d)).select("doc_id", "quality")


# --- report --------------------------------------------------------------------------

@query
def audit_report(spark, d):
    return audit.dataset_report(ds.labelled(spark, d), "text", "quality", "doc_id", "is_en",
                                ds.TOXIC)


def _versions(spark, d) -> DataFrame:
    data = ds.labelled(spark, d)

    def measured(rows: DataFrame, version: str) -> DataFrame:
        predictions = classify.predictions_table(rows, "text", "quality", "doc_id", ds.QUALITY)
        parts = audit.version_metrics(predictions, _bias(rows),
                                      robustness.robustness_summary(_details(spark, d, data=rows)))
        return report.with_version(parts, version)

    return measured(data, "original").unionByName(
        measured(materialise(_repaired(data)), "repaired"))


@query
def version_compare(spark, d):
    return report.version_compare(_versions(spark, d))


@query
def takeaways(spark, d):
    return report.takeaways(_versions(spark, d))


@query
def run_audit(spark, d):
    return audit.run_audit(ds.labelled(spark, d), "text", "quality", "doc_id", "is_en", ds.TOXIC,
                           ds.IDENTITY).metrics
