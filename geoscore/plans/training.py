"""Training jobs (C3, C4, C17 - C19) on the location model's schema.

One driver program: each stage returns its run id and frames, the next
stage takes them as arguments (no process boundary, no read-back).
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoscore.operators import explain, metrics, ml, scoring
from geoscore.plans import features as FT
from geoscore.sources import tables as T

KIND_3Y, KIND_5Y, KIND_OPP = "survie_3_ans", "survie_5_ans", "opportunite"
REGION_CODE = 51010         # region whose cells receive opportunity scores
ATTRIBUTION_FEATURES = 15   # survival models are explained on their top features


@dataclass
class TrainedModel:
    run_id: int
    model: PipelineModel
    features: list[str]
    metrics: dict
    importances: DataFrame
    extra: dict = field(default_factory=dict)


def _paths(base: str) -> dict:
    return {"registry": os.path.join(base, "entrainements_modeles"),
            "active": os.path.join(base, "modeles_actifs"),
            "artifacts": os.path.join(base, "modeles"),
            "predictions": os.path.join(base, "predictions_nombre_etablissements"),
            "cell_scores": os.path.join(base, "res_carreaux_scores")}


# ---------------------------------------------------------------------------
# C17: train one survival model end to end
# ---------------------------------------------------------------------------
def train_survival(spark: SparkSession, t: dict, trade: str, base: str, kind: str = KIND_3Y,
                   num_trees: int | None = None, depths=ml.SURVIVAL_DEPTHS,
                   stacked_from: TrainedModel | None = None, sweep_step: int = ml.SWEEP_STEP,
                   parallelism: int = ml.FIT_PARALLELISM, tune_folds: int = ml.TUNING_FOLDS,
                   eval_folds: int = ml.EVALUATION_FOLDS) -> TrainedModel:
    """C2 -> M1 -> M6/M7 -> M8/M9 -> S10 -> M10 -> M11 -> S14.

    For the 5-year model (``kind=survie_5_ans``) pass the 3-year result as
    ``stacked_from``: its out-of-fold probability becomes a feature (M13)."""
    target = "survie_3_ans" if kind == KIND_3Y else "survie_5_ans"
    trees = num_trees or (ml.SURVIVAL_TREES_3Y if kind == KIND_3Y else ml.SURVIVAL_TREES_5Y)
    data = FT.survival_training_set(t, trade, target).withColumn("label", F.col(target).cast("double"))
    data = data.drop(target, "survie_3_ans", "survie_5_ans") if kind == KIND_3Y else data.drop(target)
    feats = [c for c in data.columns if c not in ("siret", "label", "code_commune", "code_iris", "idinspire")]
    if stacked_from is not None:
        # model 1 is refitted fold by fold on the 3-year label of these rows,
        # so each row's stacked probability comes from a model that never saw it
        s3 = t["taux_survie_etablissements"].select(
            "siret", F.col("survie_3_ans").cast("double").alias("label_3y"))
        first = metrics.with_class_weights(data.join(s3, "siret").where(F.col("label_3y").isNotNull()),
                                           "label_3y")
        est1 = ml.rf_classifier(trees, "label_3y", "weight",
                                maxDepth=int(stacked_from.extra.get("maxDepth", 10)))
        data = ml.stack(first.na.fill(0.0, subset=stacked_from.features), stacked_from.features, est1,
                        "siret", "label_3y", "proba_survie_3_ans", folds=eval_folds).drop("weight", "label_3y")
        feats = feats + ["proba_survie_3_ans"]
    data = ml.materialize(data.select("siret", "label", *feats).na.fill(0.0, subset=feats))
    tuned = ml.tune_rf_classifier(data, feats, "siret", "label", depths, trees, tune_folds, parallelism)
    imp = ml.feature_importances(spark, tuned.model, feats)
    sweep = ml.feature_sweep(data, feats, imp, "siret", "label", trees,
                             int(tuned.best_params.get("maxDepth", 10)), sweep_step, parallelism)
    best_k = sweep.where("best").first()
    chosen = best_k["features"].split(",")
    weighted = metrics.with_class_weights(data, "label")
    est = ml.rf_classifier(trees, "label", "weight", maxDepth=int(tuned.best_params.get("maxDepth", 10)))
    oof = ml.out_of_fold(weighted, chosen, est, "siret", "label", eval_folds, parallelism=parallelism)
    ev = ml.evaluate_classifier(oof)
    ev["n_rows"] = data.count()          # A12: rows entering the model (table is materialised)
    params = {"maxDepth": int(tuned.best_params.get("maxDepth", 10)), "numTrees": trees,
              "features": chosen, "sweep": [r.asDict() for r in sweep.collect()]}
    paths = _paths(base)
    run_id = T.register_run(spark, paths["registry"], trade, kind, params, ev)
    final = ml.fit(weighted, chosen, est)
    T.save_model(final, paths["artifacts"], trade, kind, run_id)
    T.save_artifacts(spark, paths["artifacts"], trade, kind, run_id, chosen, params, imp, data)
    return TrainedModel(run_id, final, chosen, ev, imp,
                        {"maxDepth": params["maxDepth"], "oof": oof, "data": data})


def best_run(spark: SparkSession, base: str, trade: str, kind: str, metric: str = "accuracy",
             higher_is_better: bool = True, candidates: DataFrame | None = None) -> DataFrame:
    """Best run of a trade and kind (numeric metric,
    newest on ties), and the registry with the derived ``actif`` flag."""
    reg = T.read_table(spark, _paths(base)["registry"])
    reg = reg.where((F.col("fk_metier") == trade) & (F.col("fk_modele") == kind))
    best = T.best_runs(reg, ["fk_metier", "fk_modele"], T.metric_of(reg, metric), higher_is_better,
                       "id", candidates)
    return T.with_active_flag(reg, best, ["fk_metier", "fk_modele"])


def activate_best(spark: SparkSession, base: str, trade: str, kind: str, metric: str = "accuracy",
                  higher_is_better: bool = True, candidates: DataFrame | None = None) -> int | None:
    """Record the best run of a trade and kind as the active one (its
    slice of the table of active runs, S8) and return its id."""
    best = best_run(spark, base, trade, kind, metric, higher_is_better, candidates).where("actif")
    best = ml.materialize(best.select("fk_metier", "fk_modele", F.col("id").alias("id_actif")))
    T.replace_slices(best, _paths(base)["active"], ["fk_metier", "fk_modele"], [(trade, kind)])
    row = best.first()
    return None if row is None else int(row["id_actif"])


def find_latest_model(spark: SparkSession, base: str, trade: str, kind: str) -> tuple[int, PipelineModel, list[str]] | None:
    """C13 + S15: newest run id of (trade, kind) from the registry, its saved
    pipeline and its selected features; None without a run."""
    from geoscore.plans.inference import latest_model_run
    reg = T.read_table(spark, _paths(base)["registry"])
    row = latest_model_run(reg, trade, kind).first()
    if row is None:
        return None
    rid = int(row["latest_id"])
    where = _paths(base)["artifacts"]
    return rid, T.load_model(PipelineModel, where, trade, kind, rid), T.load_features(spark, where, trade, kind, rid)


def load_latest_model(spark: SparkSession, base: str, trade: str, kind: str) -> tuple[int, PipelineModel, list[str]]:
    """:func:`find_latest_model`, which must find one."""
    found = find_latest_model(spark, base, trade, kind)
    if found is None:
        raise LookupError(f"no run for {trade}/{kind}")
    return found


# ---------------------------------------------------------------------------
# Opportunity model, C3 and C4
# ---------------------------------------------------------------------------
def train_opportunity(spark: SparkSession, t: dict, trade: str, base: str,
                      num_trees: int = ml.OPPORTUNITY_TREES, depths=ml.OPPORTUNITY_DEPTHS,
                      parallelism: int = ml.FIT_PARALLELISM, tune_folds: int = ml.TUNING_FOLDS,
                      eval_folds: int = ml.EVALUATION_FOLDS, region_code: int = REGION_CODE) -> TrainedModel:
    """C17 for the regressor: C1 -> M3 -> M6 -> M8 (10 folds) -> S10 -> M11,
    in-sample and out-of-fold predictions per IRIS. The trade's columns of the
    prediction table are updated (S6 S7), and its opportunity scores (C3)
    replace their slice of the cell score table (S8), both below ``base``."""
    data = FT.opportunity_features(t, trade).withColumnRenamed("nb_etablissements", "label")
    feats = [c for c in data.columns if c not in ("code_iris", "label")]
    data = ml.materialize(data)
    tuned = ml.tune_rf_regressor(data, feats, "code_iris", "label", depths, num_trees,
                                 tune_folds, parallelism)
    imp = ml.feature_importances(spark, tuned.model, feats)
    est = ml.rf_regressor(num_trees, "label", maxDepth=int(tuned.best_params.get("maxDepth", 5)))
    oof = ml.out_of_fold(data, feats, est, "code_iris", "label", eval_folds, stratified=False,
                         parallelism=parallelism)
    final = ml.fit(data, feats, est)
    insample = ml.score(final, data, "pred").select("code_iris", "label", "pred")
    e_in = metrics.regression_errors(insample, "label", "pred").first()
    ev = dict(ml.evaluate_regressor(oof), mean_squared_error=e_in["mse"], mean_absolute_error=e_in["mae"])
    paths = _paths(base)
    run_id = T.register_run(spark, paths["registry"], trade, KIND_OPP,
                            {"maxDepth": int(tuned.best_params.get("maxDepth", 5)), "numTrees": num_trees}, ev)
    T.save_model(final, paths["artifacts"], trade, KIND_OPP, run_id)
    T.save_artifacts(spark, paths["artifacts"], trade, KIND_OPP, run_id, feats,
                     {"maxDepth": int(tuned.best_params.get("maxDepth", 5)), "numTrees": num_trees}, imp, data)
    preds = (insample.select("code_iris", F.col("pred").alias(trade))
             .join(oof.select("code_iris", F.col("prediction").alias(f"{trade}_cv")), "code_iris"))
    table = stored_predictions(spark, t, base)
    table = ml.materialize(update_predictions(table, preds, trade))
    T.replace_slices(table.withColumn("lot", F.lit(0)), paths["predictions"], ["lot"])
    scores = ml.materialize(opportunity_cell_scores(t, table, trade, region_code))
    write_opportunity_scores(scores, paths["cell_scores"], trade)
    return TrainedModel(run_id, final, feats, ev, imp, {"predictions": preds, "data": data, "cell_scores": scores})


def stored_predictions(spark: SparkSession, t: dict, base: str) -> DataFrame:
    """The prediction table below ``base``: every IRIS, two columns a trade
    trained so far."""
    path = _paths(base)["predictions"]
    if T.exists(spark, path):
        T.recover(spark, path)
        return T.read_table(spark, path).drop("lot")
    return t["nb_etablissements_iris"].select("code_iris").distinct()


def update_predictions(predictions_table: DataFrame, new: DataFrame, trade: str) -> DataFrame:
    """S6 + S7: add the trade's two prediction columns if absent, then update
    them for matching IRIS (unmatched rows keep theirs, new IRIS ignored)."""
    p = T.ensure_columns(predictions_table, {trade: "double", f"{trade}_cv": "double"})
    return T.keyed_update(p, new, ["code_iris"], [trade, f"{trade}_cv"])


def opportunity_cell_scores(t: dict, predictions: DataFrame, trade: str,
                            region_code: int = REGION_CODE, now=None) -> DataFrame:
    """Relative gap per IRIS (in-sample prediction vs active count),
    global statistics, piecewise score, fanned out to the region's cells.
    Rows ready to replace the (opportunite, trade) slice (S8)."""
    counts = t["nb_etablissements_iris"].select(
        "code_iris", F.col(f"nb_etablissements_actifs_{trade}").alias("actual"))
    areas = predictions.select("code_iris", F.col(trade).alias("predicted")).join(counts, "code_iris")
    sc = scoring.gap_scores(areas, ["code_iris"], "predicted", "actual")
    region = t["mailles_geographiques"].where(F.col("fk_geo_1") == region_code).select(
        F.col("geo_value").alias("code_iris"))
    bridge = t["carreaux_iris"].select("idinspire", "code_iris").join(region, "code_iris")
    ts = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return scoring.fan_out(sc, bridge, "code_iris").select(
        "idinspire", F.lit("opportunite").alias("score"), F.col("score").alias("valeur"),
        F.lit(trade).alias("fk_metier"), ts.alias("date_prediction"), F.lit(True).alias("reel"))


def write_opportunity_scores(scores: DataFrame, path: str, trade: str) -> None:
    """Replace the trade's opportunity slice of the cell score table
    (layout score / trade / project; opportunity scores belong to no project)."""
    from geoscore.plans.inference import SCORE_SLICES
    T.replace_slices(scores.withColumn("fk_projet", F.lit(None).cast("long")), path, SCORE_SLICES,
                     [("opportunite", trade, None)])


def residual_tables(t: dict, predictions: DataFrame, trade: str, cv: bool = False,
                    region_code: int = REGION_CODE, bins: int = 20) -> tuple[DataFrame, DataFrame]:
    """C4 + A13: per IRIS residuals (in-sample or out-of-fold) with the
    region flag, ordered by actual count; and the histogram of the relative
    gap."""
    col = f"{trade}_cv" if cv else trade
    counts = t["nb_etablissements_iris"].select(
        "code_iris", F.col(f"nb_etablissements_actifs_{trade}").alias("actual"))
    p = predictions.where(F.col(trade).isNotNull()).select("code_iris", F.col(col).alias("predicted"))
    m = t["mailles_geographiques"].select(F.col("geo_value").alias("code_iris"),
                                          (F.col("fk_geo_1") == region_code).alias("na"))
    ic = t["iris_communes"].select("code_iris").distinct()
    areas = counts.join(p, "code_iris").join(m, "code_iris").join(ic, "code_iris")
    res = (scoring.residual_table(areas, ["code_iris", "na"], "predicted", "actual")
           )
    return res.orderBy(F.desc("nb_effectif"), "code_iris"), scoring.histogram(res, "ecart_relatif", bins)


# ---------------------------------------------------------------------------
# C18 / C19
# ---------------------------------------------------------------------------
def explain_model(spark: SparkSession, trained: TrainedModel, data: DataFrame, key: str,
                  classifier: bool = True, refit_top: int | None = ATTRIBUTION_FEATURES,
                  sample: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(M15) refit on the top features, (T10) optional seeded sample,
    (M14) per-row attributions, (A18) mean |phi| per feature."""
    model, feats = trained.model, trained.features
    if refit_top is not None:
        top = [r["feature"] for r in trained.importances.where(F.col("feature").isin(feats))
               .orderBy("rank").limit(refit_top).collect()]
        est = model.stages[-1]
        params = {"numTrees": est.getNumTrees, "maxDepth": est.getOrDefault("maxDepth")}
        new_est = (ml.rf_classifier(params["numTrees"], "label", "weight", maxDepth=params["maxDepth"])
                   if classifier else ml.rf_regressor(params["numTrees"], "label", maxDepth=params["maxDepth"]))
        fit_data = metrics.with_class_weights(data, "label") if classifier else data
        model, feats = ml.fit(fit_data, top, new_est), top
    rows = ml.sample_rows(data, key, sample)
    sv = explain.shap_values(model.stages[-1], rows, key, feats, classifier)
    return sv, explain.attribution_summary(sv)


def train_trade(spark: SparkSession, t: dict, trade: str, base: str,
                attribution_rows: int | None = None, **kw) -> dict:
    """3-year -> 5-year (stacked) -> attribution -> opportunity ->
    attribution, in dependency order, each stage handing over its result."""
    m3 = train_survival(spark, t, trade, base, KIND_3Y, **kw)
    m5 = train_survival(spark, t, trade, base, KIND_5Y, stacked_from=m3, **kw)
    attributions = {
        KIND_3Y: explain_model(spark, m3, m3.extra["data"], "siret", sample=attribution_rows),
        KIND_5Y: explain_model(spark, m5, m5.extra["data"], "siret", sample=attribution_rows),
    }
    opp_kw = {k: v for k, v in kw.items() if k in ("num_trees", "parallelism", "tune_folds", "eval_folds")}
    opp = train_opportunity(spark, t, trade, base, **opp_kw)
    attributions[KIND_OPP] = explain_model(spark, opp, opp.extra["data"], "code_iris", classifier=False,
                                           refit_top=None, sample=attribution_rows)
    active = {kind: activate_best(spark, base, trade, kind, metric, higher)
              for kind, metric, higher in ((KIND_3Y, "accuracy", True), (KIND_5Y, "accuracy", True), (KIND_OPP, "mean_squared_error_cv", False))}
    return {KIND_3Y: m3, KIND_5Y: m5, KIND_OPP: opp, "attributions": attributions, "active": active}
