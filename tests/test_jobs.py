"""End-to-end jobs on a synthetic world in the location model's schema."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoscore.plans import features as FT
from geoscore.plans import inference as INF
from geoscore.plans import training as TR

import world


@pytest.fixture(scope="module")
def t(spark):
    return world.build(spark)


@pytest.fixture(scope="module")
def located(spark, t):
    return INF.locate_projects(t).cache()


def test_locate_projects(located):
    rows = {r.id_projet: r for r in located.collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[1].milieu == "URBAIN" and rows[1].code_commune == "C11"
    assert rows[3].code_commune != "C11"
    assert rows[2].hull is not None and rows[2].localisation_type == INF.DRAWN_ZONE
    # project 1 sits about 100 m east and 78 m north of the projection origin
    assert 0 < rows[1].cx - 700_000 < 200 and 0 < rows[1].cy - 6_600_000 < 200


def test_candidate_cells(spark, t, located):
    cand = INF.candidate_cells(t, located)
    per = {r.id_projet: r["count"] for r in cand.groupBy("id_projet").count().collect()}
    # centre commune: own commune cells with census + 8 neighbours' cells
    assert per[1] > 8 * 400 and per[1] <= 9 * 400
    assert cand.count() == cand.distinct().count()
    census = {r.idinspire for r in t["insee_donnees_carroyees_niveau_200m"].select("idinspire").collect()}
    own = [r.idinspire for r in cand.where("id_projet = 1").join(
        t["carreaux_communes"].where("code_commune = 'C11'"), "idinspire").collect()]
    assert own and all(c in census for c in own)
    capped = INF.candidate_cells(t, located, cap=100)
    assert max(r["count"] for r in capped.groupBy("id_projet").count().collect()) == 100


def test_competitors_and_inhabitants(spark, t, located):
    cand = INF.candidate_cells(t, located).where("id_projet = 3")
    comp = INF.competitor_counts(t, world.TRADE, cand)
    have = {r.idinspire for r in t[f"res_carreaux_varexp_{world.TRADE}"].where("varexp = 'nb_concurrents'").collect()}
    got = {r.idinspire: r.valeur for r in comp.collect()}
    assert got and not (set(got) & have)
    # brute force for a few cells
    sites = t[f"etablissements_cibles_{world.TRADE}"].where("date_fin IS NULL").toPandas()
    cells = t["insee_carreaux"].toPandas().set_index("idinspire")
    mil = t["carreaux_communes"].toPandas().set_index("idinspire").milieu
    for cid in list(got)[:25]:
        r = 500.0 if mil[cid] == "URBAIN" else 10_000.0
        d2 = (sites.x_m - cells.x_m[cid]) ** 2 + (sites.y_m - cells.y_m[cid]) ** 2
        assert got[cid] == float((d2 <= r * r).sum())
    inh = INF.inhabitants_per_establishment(t, world.TRADE, cand, comp)
    assert inh.count() > 0 and inh.where(F.col("valeur") < 0).count() == 0


def test_feature_matrix_vectors_records(spark, t, located):
    d = world.dictionary(spark)
    cand = INF.candidate_cells(t, located)
    comp = INF.competitor_counts(t, world.TRADE, cand)
    inh = INF.inhabitants_per_establishment(t, world.TRADE, cand, comp)
    t2 = dict(t)
    t2[f"res_carreaux_varexp_{world.TRADE}"] = t[f"res_carreaux_varexp_{world.TRADE}"].unionByName(comp).unionByName(inh)
    m = INF.cell_feature_matrix(t2, world.TRADE, cand, d).cache()
    feats = [r.feature for r in d.collect()]
    assert set(feats) <= set(m.columns) and m.count() > 0
    # complete-case rule: a cell missing a global attribute is absent
    missing = t["res_carreaux_varexp"].groupBy("idinspire").count().where("count < 3")
    assert m.join(missing, "idinspire").count() == 0
    v = INF.project_vectors(t2, world.TRADE, located, d, feats)
    assert {r.id_projet for r in v.collect()} == {1, 2, 3}
    rec = INF.project_feature_records(v, feats, d)
    assert rec.count() == 3 * len(feats)
    assert rec.where((F.col("centile") <= 0) | (F.col("centile") > 1)).count() == 0
    opp = INF.project_opportunity(t, located, world.TRADE)
    assert opp.count() == 3


def test_training_features(spark, t):
    s = FT.survival_training_set(t, world.TRADE)
    cols = set(s.columns)
    assert {"age_moyen", "taux_pauvrete", "taux_residences_secondaires", "milieu", "zone",
            "indice_artisanat_proximite", "caractere_employeur"} <= cols
    assert "ind_0_3" not in cols and "depcom" not in cols
    assert s.where(F.col("taux_motorisation").isNull()).count() == 0
    o = FT.opportunity_features(t, world.TRADE)
    assert o.where(F.col("age_moyen").isNull()).count() == 0
    assert "indice_naf_niveau_1_coiffure" not in o.columns


def test_train_infer_explain_end_to_end(spark, t, tmp_path):
    base = str(tmp_path)
    res = TR.train_trade(spark, t, world.TRADE, base, attribution_rows=40, num_trees=5, depths=[2, 4],
                         parallelism=4, tune_folds=3, eval_folds=3, sweep_step=20)
    m3, m5, opp, active = res[TR.KIND_3Y], res[TR.KIND_5Y], res[TR.KIND_OPP], res["active"]
    assert (m3.run_id, m5.run_id, opp.run_id) == (1, 2, 3)
    assert "proba_survie_3_ans" in m5.extra["data"].columns
    for kind, (sv_k, summary_k) in res["attributions"].items():
        a = sv_k.groupBy(sv_k.columns[0]).agg(F.first("base").alias("b"), F.first("prediction").alias("p"),
                                             F.sum("phi").alias("s")).toPandas()
        assert 0 < len(a) <= 40 and np.allclose(a.b + a.s, a.p), kind
    assert set(m3.metrics) >= {"accuracy", "kappa", "f1", "confusion_matrix"}
    best = TR.best_run(spark, base, world.TRADE, TR.KIND_3Y)
    assert best.where("actif").count() == 1
    rid, loaded, chosen = TR.load_latest_model(spark, base, world.TRADE, TR.KIND_5Y)
    assert rid == 2 and loaded.stages[0].getInputCols() == m5.features == chosen
    assert m3.metrics["n_rows"] > 0
    preds = opp.extra["predictions"]
    table = t["nb_etablissements_iris"].select("code_iris")
    upd = TR.update_predictions(table, preds, world.TRADE)
    assert upd.where(F.col(world.TRADE).isNull()).count() == 0
    scores = TR.opportunity_cell_scores(t, upd, world.TRADE)
    vals = [r.valeur for r in scores.collect()]
    assert vals and all(v is None or 0 <= v <= 1 for v in vals)
    res, hist = TR.residual_tables(t, upd, world.TRADE, cv=True)
    assert sum(r.n for r in hist.collect()) == res.count()
    # attribution on the 3-year model
    data = FT.survival_training_set(t, world.TRADE).withColumn("label", F.col("survie_3_ans").cast("double"))
    data = data.select("siret", "label", *m3.features).na.fill(0.0)
    sv, summary = TR.explain_model(spark, m3, data, "siret", refit_top=3, sample=50)
    agg = sv.groupBy("siret").agg(F.first("base").alias("b"), F.first("prediction").alias("p"),
                                  F.sum("phi").alias("s")).toPandas()
    assert len(agg) == 50 and np.allclose(agg.b + agg.s, agg.p)
    assert summary.count() == 3
    # inference with the models just trained: every feature they kept is stored for every cell
    names = sorted(set(m3.features + m5.features) - {INF.STACKED, *INF.RECORDED})
    d = spark.createDataFrame([(f, f, "global") for f in names], "feature string, varexp string, scope string")
    rng = np.random.default_rng(5)
    cells = [r.idinspire for r in t["insee_carreaux"].collect()]
    rows = [(c, f, float(v), True, datetime.datetime(2021, 1, 1)) for f in names
            for c, v in zip(cells, rng.uniform(0, 50, len(cells)).round(5))]
    t2 = dict(t)
    t2["res_carreaux_varexp"] = t["res_carreaux_varexp"].unionByName(spark.createDataFrame(rows, t["res_carreaux_varexp"].schema))
    ids = t["projets"].select("id_projet")
    out = INF.infer_projects(spark, t2, world.TRADE, ids, d, base=base, out_dir=base + "/out")
    p3, p5 = ({r.id_projet: r.valeur for r in out[f"project_scores_{k}y"].collect()} for k in (3, 5))
    assert set(p3) == set(p5) == {1, 2, 3} and all(0 <= v <= 1 for v in [*p3.values(), *p5.values()])
    assert out["cell_scores_5y"].count() == out["cell_scores_3y"].count() > 0
    status = spark.read.parquet(base + "/out/statut_projets")
    from geoscore.sources import tables as T
    assert {r.status for r in T.current_status(status, ["id_projet"]).collect()} == {INF.STATUS_DONE}
    # a project scored alone gets what it gets in a batch
    alone = INF.infer_projects(spark, t2, world.TRADE, ids.where("id_projet = 2"), d, base=base)
    assert {r.id_projet: r.valeur for r in alone["project_scores_3y"].collect()} == {2: p3[2]}
    assert {r.id_projet: r.valeur for r in alone["project_scores_5y"].collect()} == {2: p5[2]}
    # zone means: over all cells that meet the hull; for the 5-year model over those with a 3-year score
    zone = {r.idinspire for r in INF.zone_cells(t2, out["located"]).collect()}
    values = {(c, f): v for c, f, v, *_ in rows}
    vec = INF.zone_vectors(t2, world.TRADE, out["located"], d, names).first()
    for f in names[:5]:
        assert abs(vec[f] - np.mean([values[c, f] for c in zone])) <= 0.000501
    stored = {r.idinspire: r.valeur for r in out["cell_scores_3y"].where("fk_projet = 2").collect()}
    five = INF.zone_vectors(t2, world.TRADE, out["located"], d, names, out["cell_scores_3y"]).first()
    scored = [c for c in zone if c in stored]
    assert abs(five[INF.STACKED] - np.mean([stored[c] for c in scored])) <= 0.000501
    assert abs(five[names[0]] - np.mean([values[c, names[0]] for c in scored])) <= 0.000501
    # records hold the constants too; unknown locations are reported
    recorded = {r.varexp for r in out["project_records"].select("varexp").distinct().collect()}
    assert set(INF.RECORDED) <= recorded
    odd = out["located"].withColumn("localisation_type", F.lit("ailleurs"))
    assert INF.unknown_locations(odd).count() == 3 and out["errors"].count() == 0
    # the opportunity job wrote its predictions and its slice of the cell scores
    stored = spark.read.parquet(base + "/res_carreaux_scores")
    assert {(r.score, r.fk_metier, r.fk_projet) for r in stored.select("score", "fk_metier", "fk_projet").distinct().collect()} == {
        ("opportunite", world.TRADE, None)}
    assert {(r.idinspire, r.valeur) for r in stored.collect()} == {(r.idinspire, r.valeur) for r in opp.extra["cell_scores"].collect()}
    table = TR.stored_predictions(spark, t, base)
    assert {world.TRADE, world.TRADE + "_cv"} <= set(table.columns)
    assert {r.code_iris: r[world.TRADE] for r in table.collect()} == {r.code_iris: r[world.TRADE] for r in preds.collect()}
    # the best run of each kind is the active one
    assert active == {TR.KIND_3Y: 1, TR.KIND_5Y: 2, TR.KIND_OPP: 3}
    from geoscore.sources import tables as T
    T.register_run(spark, base + "/entrainements_modeles", world.TRADE, TR.KIND_3Y, {}, {"accuracy": 1.5})
    T.register_run(spark, base + "/entrainements_modeles", world.TRADE, TR.KIND_OPP, {}, {"mean_squared_error_cv": 1e30})
    assert TR.activate_best(spark, base, world.TRADE, TR.KIND_3Y) == 4
    assert TR.activate_best(spark, base, world.TRADE, TR.KIND_OPP, "mean_squared_error_cv", False) == 3
    actives = spark.read.parquet(base + "/modeles_actifs")
    assert {(r.fk_modele, r.id_actif) for r in actives.collect()} == {(TR.KIND_3Y, 4), (TR.KIND_5Y, 2), (TR.KIND_OPP, 3)}
    # a failed run repeated under its batch id adds nothing, and a project without cells loses its old scores
    score_rows = spark.read.parquet(base + "/out/res_projets_scores").count()
    cells_before = spark.read.parquet(base + "/out/res_carreaux_scores").count()
    for _ in range(2):
        INF.infer_projects(spark, t2, world.TRADE, ids.where("id_projet = 2"), d, base=None, model_3y=m3.model, features_3y=m3.features,
                           out_dir=base + "/out", batch="again")
    again = spark.read.parquet(base + "/out/res_projets_scores").where("batch LIKE 'again%'")
    assert again.groupBy("score", "id_projet").count().where("count > 1").count() == 0 and again.count() > 0
    assert spark.read.parquet(base + "/out/res_projets_scores").where("batch NOT LIKE 'again%'").count() == score_rows
    assert spark.read.parquet(base + "/out/res_carreaux_scores").count() == cells_before
    gone = dict(t2, projets=t2["projets"].where("id_projet != 2"))
    INF.infer_projects(spark, gone, world.TRADE, ids.where("id_projet = 2"), d, model_3y=m3.model, features_3y=m3.features, out_dir=base + "/out")
    left = spark.read.parquet(base + "/out/res_carreaux_scores").where("fk_projet = 2")
    assert {r.score for r in left.select("score").distinct().collect()} == {INF.SCORE_5Y}
    # opportunity scores share the cell score table
    TR.write_opportunity_scores(scores, base + "/out/res_carreaux_scores", world.TRADE)
    TR.write_opportunity_scores(scores.limit(0), base + "/out/res_carreaux_scores", world.TRADE)
    table = spark.read.parquet(base + "/out/res_carreaux_scores")
    assert {r.score for r in table.select("score").distinct().collect()} == {INF.SCORE_3Y, INF.SCORE_5Y}


def test_inference_without_a_five_year_run(spark, t, tmp_path):
    base = str(tmp_path)
    m3 = TR.train_survival(spark, t, world.TRADE, base, num_trees=3, depths=[2], parallelism=4, tune_folds=2, eval_folds=2, sweep_step=40)
    assert TR.find_latest_model(spark, base, world.TRADE, TR.KIND_5Y) is None
    names = sorted(set(m3.features) - set(INF.RECORDED))
    d = spark.createDataFrame([(f, f, "global") for f in names], "feature string, varexp string, scope string")
    out = INF.infer_projects(spark, t, world.TRADE, t["projets"].select("id_projet"), d, base=base)
    assert "cell_scores_5y" not in out and {r.id_projet for r in out["project_scores_3y"].collect()} <= {1, 2, 3}


def test_fill_is_per_project(spark):
    df = spark.createDataFrame([(1, 10.0, 3e9), (1, None, 1.0), (2, None, 2.0)], "id_projet int, taux_motorisation double, indice_frequentation_train double")
    rows = {(r.id_projet, r.indice_frequentation_train): r for r in INF.prepare_for_model(df, ["taux_motorisation"], 1, 0).collect()}
    assert rows[1, 1.0].taux_motorisation == 10.0 and rows[2, 2.0].taux_motorisation == 0.0
    assert rows[1, 2140000000.0].caractere_employeur == 1 and rows[2, 2.0].inscription_registre_metiers == 0
