"""Model stand-in queries (rows-only checks: no SQL oracle for fitted models).

Classification: documents joined with labels (``quality`` as the survival
target, ``toxic = 0`` as the second, stacked target), text statistics as
features. Regression: customers with their order count as the
establishment count. Tree counts and grids are the library defaults, which
equal the reference's; where a job refits at the tuned depth, so do they.
"""

from __future__ import annotations

import hashlib

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from geoscore.functions import columns as X
from geoscore.operators import explain, metrics, ml
from geoscore.operators.joins import bounded_broadcast
from geoscore.plans.catalog import register
from geoscore.session import work_dir
from geoscore.sources import tables
from geoscore.sources.testdata import load

DOC_FEATURES = ["n_chars", "n_words", "n_lines", "upper_frac", "digit_frac", "punct_frac",
                "n_at", "lang_code", "source_id"]
CUST_FEATURES = ["c_acctbal", "c_nationkey", "n_regionkey", "segment_code", "name_len"]
LANG_CODES = {"en": 1, "fr": 2, "de": 3, "es": 4}
SEGMENT_CODES = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4, "MACHINERY": 5}


def doc_features(spark, d):
    docs = load(spark, d, "documents")
    n = F.greatest(F.col("n_chars").cast("double"), F.lit(1.0))
    text_len = F.length("text")

    def count_of(chars):
        # occurrences of a character set: one translate pass, no regex
        return (text_len - F.length(F.translate("text", chars, ""))).cast("double")

    return docs.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", r"\s+")).cast("double").alias("n_words"),
        (count_of("\n") + F.lit(1.0)).alias("n_lines"),
        (count_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ") / n).alias("upper_frac"),
        (count_of("0123456789") / n).alias("digit_frac"),
        (count_of(".!?") / n).alias("punct_frac"),
        count_of("@").alias("n_at"),
        X.ordinal_recode("lang", LANG_CODES).cast("double").alias("lang_code"),
        F.regexp_extract("source", r"(\d+)", 1).cast("double").alias("source_id"),
    )


def labelled_docs(spark, d):
    """Feature table of the labelled documents, written once (text features
    are the expensive part; every fit then reads the written table)."""
    lab = load(spark, d, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("label"),
        (F.lit(1) - F.col("toxic")).cast("double").alias("label_2"))
    return ml.materialize(doc_features(spark, d).join(lab, "doc_id"))


def customer_counts(spark, d):
    return ml.materialize(_customer_counts(spark, d))


def _customer_counts(spark, d):
    c = load(spark, d, "customer")
    n = load(spark, d, "nation").select("n_nationkey", "n_regionkey")
    o = load(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).cast("double").alias("label"))
    return (c.join(bounded_broadcast(n), c.c_nationkey == n.n_nationkey)
            .join(o, "c_custkey", "left")
            .select("c_custkey", F.col("c_acctbal"), F.col("c_nationkey").cast("double").alias("c_nationkey"),
                    F.col("n_regionkey").cast("double").alias("n_regionkey"),
                    X.ordinal_recode("c_mktsegment", SEGMENT_CODES).cast("double").alias("segment_code"),
                    F.length("c_name").cast("double").alias("name_len"),
                    F.coalesce("label", F.lit(0.0)).alias("label")))


# ---------------------------------------------------------------------------
# M1 / M3 / M4 / M5: grid searches
# ---------------------------------------------------------------------------
def rf_tune(spark, d):
    res = ml.tune_rf_classifier(labelled_docs(spark, d), DOC_FEATURES, "doc_id", "label",
                                depths=ml.SURVIVAL_DEPTHS)
    return res.grid


register("rf_tune", note="grid metrics; rows-only")(rf_tune)


def rf_regress_tune(spark, d):
    res = ml.tune_rf_regressor(customer_counts(spark, d), CUST_FEATURES, "c_custkey", "label",
                               depths=ml.OPPORTUNITY_DEPTHS)
    return res.grid


register("rf_regress_tune", note="grid metrics; rows-only")(rf_regress_tune)


def gbt_tune(spark, d):
    res = ml.tune_gbt(labelled_docs(spark, d), DOC_FEATURES, "doc_id", "label", True, ml.GBT_CLASSIFIER_GRID)
    return res.grid


register("gbt_tune", note="grid metrics; rows-only")(gbt_tune)


def gbt_regress_tune(spark, d):
    res = ml.tune_gbt(customer_counts(spark, d), CUST_FEATURES, "c_custkey", "label", False, ml.GBT_REGRESSOR_GRID)
    return res.grid


register("gbt_regress_tune", note="grid metrics; rows-only")(gbt_regress_tune)


# M16 on a small space: the number of draws and the space are the job's
# parameters; the library's own hold 100 draws of up to 2000 trees.
SMALL_SPACE = {"numTrees": [10, 20, 40], "featureSubsetStrategy": ["auto", "sqrt"], "maxDepth": [2, 5, 10],
               "minInstancesPerNode": [1, 2, 4], "bootstrap": [True, False]}
SMALL_STEPS = {"numTrees": (10, range(-1, 2), 5), "maxDepth": (3, range(-1, 2), 1), "minInstancesPerNode": (1, range(0, 2), 1)}


def random_search(spark, d):
    res = ml.random_search(labelled_docs(spark, d), DOC_FEATURES, "doc_id", space=SMALL_SPACE, draws=6,
                           steps=SMALL_STEPS, values={}, local_folds=ml.RANDOM_FOLDS)
    return res.grid


register("random_search", note="drawn and local settings; rows-only")(random_search)


# ---------------------------------------------------------------------------
# M6 / M7 / M8 / M9 / M13
# ---------------------------------------------------------------------------
def _survival_estimator(depth: int = 10, trees: int = ml.SURVIVAL_TREES_3Y):
    return ml.rf_classifier(trees, "label", "weight", maxDepth=depth)


def feature_importances(spark, d):
    data = metrics.with_class_weights(labelled_docs(spark, d), "label")
    model = ml.fit(data, DOC_FEATURES, _survival_estimator())
    return ml.feature_importances(spark, model, DOC_FEATURES)


register("feature_importances", note="importances; rows-only")(feature_importances)


def feature_sweep(spark, d):
    data = labelled_docs(spark, d)
    w = metrics.with_class_weights(data, "label")
    model = ml.fit(w, DOC_FEATURES, _survival_estimator())
    imp = ml.feature_importances(spark, model, DOC_FEATURES)
    return ml.feature_sweep(data, DOC_FEATURES, imp, "doc_id", "label", step=3)


register("feature_sweep", note="hold-out metrics per k; rows-only")(feature_sweep)


def oof_predictions(spark, d):
    data = metrics.with_class_weights(labelled_docs(spark, d), "label")
    return ml.out_of_fold(data, DOC_FEATURES, _survival_estimator(), "doc_id", "label",
                          ml.EVALUATION_FOLDS)


register("oof_predictions", note="each key once; rows-only")(oof_predictions)


def oof_report(spark, d):
    return metrics.class_report(oof_predictions(spark, d), "label", "prediction")


register("oof_report", note="report on out-of-fold predictions; rows-only")(oof_report)


def regression_oof(spark, d):
    data = customer_counts(spark, d)
    tuned = ml.tune_rf_regressor(data, CUST_FEATURES, "c_custkey")
    est = ml.rf_regressor(ml.OPPORTUNITY_TREES, "label", maxDepth=int(tuned.best_params.get("maxDepth", 5)))
    oof = ml.out_of_fold(data, CUST_FEATURES, est, "c_custkey", "label", ml.EVALUATION_FOLDS, stratified=False)
    return metrics.regression_errors(oof, "label", "prediction")


register("regression_oof", note="out-of-fold MSE/MAE; rows-only")(regression_oof)


def stacked_score(spark, d):
    data = metrics.with_class_weights(labelled_docs(spark, d), "label")
    est = _survival_estimator(trees=ml.SURVIVAL_TREES_5Y)
    stacked = ml.stack(data, DOC_FEATURES, est, "doc_id", "label", "p_first")
    second = (stacked.drop("weight", "label").withColumnRenamed("label_2", "label"))
    second = metrics.with_class_weights(second, "label")
    oof = ml.out_of_fold(second, DOC_FEATURES + ["p_first"], est, "doc_id",
                         "label", ml.EVALUATION_FOLDS, keep=["p_first"])
    return oof.select("doc_id", "label", "p_first", F.col("p1").alias("p_second"), "prediction")


register("stacked_score", note="model 1 probability feeds model 2; rows-only")(stacked_score)


# ---------------------------------------------------------------------------
# attribution
# ---------------------------------------------------------------------------
def attribution_model(spark, d, max_features: int = 15):
    """Tuned forest refitted on its top features, and those features. Tuned
    once for each data folder and application: the attribution jobs load the
    stored run (S14, S15)."""
    store = work_dir(spark, "attribution-models", spark.sparkContext.applicationId, hashlib.sha256(str(d).encode()).hexdigest())
    if not tables.exists(spark, f"{store}/documents/quality/1_artifacts/settings/_SUCCESS"):
        docs = labelled_docs(spark, d)
        data = metrics.with_class_weights(docs, "label")
        tuned = ml.tune_rf_classifier(docs, DOC_FEATURES, "doc_id")
        imp = ml.feature_importances(spark, tuned.model, DOC_FEATURES)
        chosen = [r["feature"] for r in imp.orderBy("rank").limit(max_features).collect()]
        model = ml.fit(data, chosen, _survival_estimator(int(tuned.best_params.get("maxDepth", 10))))
        tables.save_model(model, store, "documents", "quality", 1)
        tables.save_artifacts(spark, store, "documents", "quality", 1, chosen, tuned.best_params)
    return (tables.load_model(PipelineModel, store, "documents", "quality", 1),
            tables.load_features(spark, store, "documents", "quality", 1))


def tree_attribution(spark, d):
    model, chosen = attribution_model(spark, d)
    # attribution needs no label: every document is explained
    rows = ml.materialize(doc_features(spark, d))
    return explain.shap_values(model.stages[-1], rows, "doc_id", chosen, classifier=True)


register("tree_attribution", note="base + sum(phi) = prediction; rows-only")(tree_attribution)


def attribution_summary(spark, d):
    return explain.attribution_summary(tree_attribution(spark, d))


register("attribution_summary", note="mean |phi| per feature; rows-only")(attribution_summary)


def attribution_additivity(spark, d):
    """base + sum(phi) against the probability that the fitted model itself
    gives every document."""
    model, chosen = attribution_model(spark, d)
    rows = ml.materialize(doc_features(spark, d))
    sv = explain.shap_values(model.stages[-1], rows, "doc_id", chosen, classifier=True)
    own = ml.score(model, rows, "p1").select("doc_id", "p1")
    sums = sv.groupBy("doc_id").agg((F.first("base") + F.sum("phi")).alias("total"))
    return sums.join(own, "doc_id").select("doc_id", (F.round(F.col("total") - F.col("p1"), 6) + F.lit(0.0)).alias("difference"))


register("attribution_additivity", oracle="SELECT doc_id, CAST(0 AS DOUBLE) AS difference FROM documents")(attribution_additivity)


def oof_coverage(spark, d):
    """Rows of the out-of-fold table per label; every labelled document once."""
    return oof_predictions(spark, d).groupBy("label").agg(
        F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_documents"))


register("oof_coverage", oracle="""
SELECT CAST(l.quality AS DOUBLE) AS label, count(*) AS n, count(DISTINCT doc_id) AS n_documents
FROM labels l JOIN documents USING (doc_id) GROUP BY 1""")(oof_coverage)
