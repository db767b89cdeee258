"""Project inference jobs (C5 - C16) on the location model's schema.

The reference scores one project per run and re-evaluates its candidate
cell query four times. Here every step takes the *set* of projects to
score: candidate cells are one DataFrame ``(id_projet, idinspire)``
written once to the shared folder and reused by every later step.

Geometry: cells are 200 m squares given by their Lambert-93 centre
(``x_m, y_m``); communes are geometries in the same metres (one ring, or all
rings of their parts and holes); project clicks and
addresses arrive as longitude / latitude and are projected on the fly (X23).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoscore.functions import columns as X
from geoscore.functions.geometry import lambert93
from geoscore.operators import eav, ranking
from geoscore.operators import spatial as S
from geoscore.operators.joins import bounded_broadcast
from geoscore.operators.ml import materialize
from geoscore.sources import tables as T

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
CELL_SIDE_M = 200.0
DRAWN_ZONE = "dessin sur une zone"
ADDRESS = "adresse"
COMMUNE_LEVEL = 3
STATUS_RUNNING = "calculs en cours"
STATUS_DONE = "disponible"
STATUS_FAILED = "erreur"
SCORE_3Y, SCORE_5Y, SCORE_OPPORTUNITY = "survie_3", "survie_5", "opportunite"
VAR_COMPETITORS = "nb_concurrents"
VAR_INHABITANTS = "nb_habitants_etablissement"
VAR_DENSITY = "densite_pop"
STACKED = "proba_survie_3_ans"
MOTORISATION, RIDERSHIP = "taux_motorisation", "indice_frequentation_train"
RECORDED = ["milieu", "zone", "caractere_employeur", "inscription_registre_metiers"]
SCORE_SLICES = ["score", "fk_metier", "fk_projet"]  # layout of the cell score table
# tile side of the spatial joins: a few cells wide
TILE_M = 2_000.0


def cell_rectangles(insee_carreaux: DataFrame) -> DataFrame:
    """Cells as rectangles keyed by ``cell_id`` (= idinspire)."""
    h = CELL_SIDE_M / 2
    return insee_carreaux.select(
        F.col("idinspire").alias("cell_id"), F.col("x_m").alias("xc"), F.col("y_m").alias("yc"),
        (F.col("x_m") - h).alias("xmin"), (F.col("y_m") - h).alias("ymin"),
        (F.col("x_m") + h).alias("xmax"), (F.col("y_m") + h).alias("ymax"))


def communes(formes: DataFrame, mailles: DataFrame) -> DataFrame:
    """Commune polygons: ``id_geo, code_commune, ring``."""
    m = mailles.where(F.col("geo_level") == COMMUNE_LEVEL).select("id_geo", F.col("geo_value").alias("code_commune"))
    return formes.join(m, formes.fk_geo == m.id_geo).select("id_geo", "code_commune", F.col("geom").alias("ring"))


# ---------------------------------------------------------------------------
# Locate projects
# ---------------------------------------------------------------------------
def locate_projects(t: dict, project_ids: DataFrame | None = None) -> DataFrame:
    """Centre of each project (hull centroid of the drawing, or the address),
    its cell (smallest id on a shared edge), milieu, commune and zone."""
    p = t["projets"]
    if project_ids is not None:
        p = p.join(project_ids.select("id_projet").distinct(), "id_projet", "left_semi")
    p = p.join(bounded_broadcast(t["ref_metier"]), p.activite == F.col("id_metier")).select(
        "id_projet", F.col("activite").alias("label_metier"),
        F.col("libelle_metier").alias("libelle_activite"), "localisation_type", "longitude", "latitude")
    ax, ay = lambert93("longitude", "latitude")
    p = p.withColumn("ax", ax).withColumn("ay", ay)
    d = t["projets_dessin"].join(p.select("id_projet"), "id_projet", "left_semi")
    dx, dy = lambert93("longitude", "latitude")
    hulls = S.convex_hulls(d.select("id_projet", dx.alias("x"), dy.alias("y")), "id_projet", "x", "y")
    j = p.join(hulls, "id_projet", "left")
    drawn = F.col("localisation_type") == DRAWN_ZONE
    j = (j.withColumn("cx", F.when(drawn, F.col("centroid_x")).otherwise(F.col("ax")))
          .withColumn("cy", F.when(drawn, F.col("centroid_y")).otherwise(F.col("ay"))))
    cells = cell_rectangles(t["insee_carreaux"])
    # tiles of one cell: each point meets 1 (edge: 2, corner: 4) candidate cells
    loc = S.locate_points(j.select("id_projet", "cx", "cy"), cells, "id_projet", "cx", "cy", CELL_SIDE_M)
    cc = t["carreaux_communes"].select(F.col("idinspire").alias("cell_id"), "milieu", "code_commune")
    uu = t["unites_urbaines"].select(F.col("codgeo").alias("code_commune"), F.col("statut_2017").alias("zone"))
    loc = loc.select("id_projet", "cell_id").join(cc, "cell_id").join(bounded_broadcast(uu), "code_commune")
    out = (j.join(loc, "id_projet")
           .select("id_projet", "label_metier", "libelle_activite", "localisation_type", "ax", "ay",
                   "cx", "cy", "hull", F.col("cell_id").alias("idinspire"), "milieu", "code_commune", "zone"))
    return materialize(out)


# ---------------------------------------------------------------------------
# Candidate cells
# ---------------------------------------------------------------------------
def candidate_cells(t: dict, located: DataFrame, cap: int | None = None) -> DataFrame:
    """Cells of the project's zone (drawing hull and own commune; cells with
    census data only) united with the cells of the neighbouring communes.
    Result ``(id_projet, idinspire)``, distinct (U1); no cap by default (T5)."""
    cells = cell_rectangles(t["insee_carreaux"])
    com = communes(t["formes_mailles_geographiques"], t["mailles_geographiques"])
    # Commune strictly containing the project's address point
    own = S.points_within(located.select("id_projet", "ax", "ay"), com, "id_projet", "ax", "ay",
                          "id_geo", "ring", TILE_M)
    # Communes touching the project's commune
    touch = S.touching_areas(com.select("id_geo", "ring"), "id_geo", "ring", TILE_M)
    neigh = own.join(touch, own.id_geo == touch.a).select("id_projet", F.col("b").alias("id_geo"))
    census = t["insee_donnees_carroyees_niveau_200m"].select(F.col("idinspire").alias("cell_id")).distinct()
    # cells by commune, once for all communes involved
    involved = own.select("id_geo").union(neigh.select("id_geo")).distinct()
    com_cells = S.cells_meet_polygons(cells, com.join(involved, "id_geo", "left_semi"), "id_geo", "ring", TILE_M)
    own_cells = (own.join(com_cells, "id_geo").select("id_projet", "cell_id")
                 .join(census, "cell_id", "left_semi"))
    hull = located.where(F.col("hull").isNotNull()).select("id_projet", "hull")
    hull_cells = (S.cells_in_zones(cells, hull, "id_projet", TILE_M)
                  .join(census, "cell_id", "left_semi"))
    neigh_cells = neigh.join(com_cells, "id_geo").select("id_projet", "cell_id")
    out = S.union_cells(own_cells.select("id_projet", "cell_id"), hull_cells.select("id_projet", "cell_id"),
                        neigh_cells, key_cols=("id_projet", "cell_id"), cap=None)
    if cap is not None:   # optional per-project cap, lowest ids kept
        out = (ranking.row_number_unique(out, ["id_projet"], "cell_id", "_rn")
               .where(F.col("_rn") <= cap).drop("_rn"))
    # computed once, read by every later step (the reference re-ran it 4 times)
    return materialize(out.select("id_projet", F.col("cell_id").alias("idinspire")))


# ---------------------------------------------------------------------------
# Missing cell attributes
# ---------------------------------------------------------------------------
def competitor_counts(t: dict, trade: str, candidates: DataFrame, now=None) -> DataFrame:
    """For candidate cells lacking ``nb_concurrents`` in the trade store,
    the number of open establishments of the trade within the milieu's radius
    (500 m urban, 10 km rural), 0 when none. Rows ready to append (S5)."""
    store = t[f"res_carreaux_varexp_{trade}"]
    cells = candidates.select("idinspire").distinct()
    todo = eav.missing_entities(cells, store, ["idinspire"], "varexp", VAR_COMPETITORS, "valeur")
    cc = t["carreaux_communes"].select("idinspire", "milieu")
    pts = t["insee_carreaux"].select("idinspire", F.col("x_m").alias("xc"), F.col("y_m").alias("yc"))
    sites = (t[f"etablissements_cibles_{trade}"].where(F.col("date_fin").isNull())
             .select(F.col("x_m").alias("x"), F.col("y_m").alias("y")))
    parts = []
    for milieu, radius in X.COMPETITOR_RADIUS_M.items():
        centres = todo.join(cc.where(F.col("milieu") == milieu), "idinspire").join(pts, "idinspire")
        parts.append(S.range_count(centres, sites, "idinspire", radius, out="valeur"))
    out = parts[0].unionByName(parts[1])
    return materialize(_store_rows(out, VAR_COMPETITORS, now))


def inhabitants_per_establishment(t: dict, trade: str, candidates: DataFrame,
                                  competitors: DataFrame | None = None, now=None) -> DataFrame:
    """Density / (competitors + 1) * 3.14 * 25 / 4 for candidate cells
    lacking ``nb_habitants_etablissement`` (competitor rows just computed can
    be passed in, as the reference reads them back after inserting)."""
    store = t[f"res_carreaux_varexp_{trade}"]
    if competitors is not None:
        store = store.select("idinspire", "varexp", "valeur").unionByName(
            competitors.select("idinspire", "varexp", "valeur"))
    cells = candidates.select("idinspire").distinct()
    todo = eav.missing_entities(cells, store, ["idinspire"], "varexp", VAR_INHABITANTS, "valeur")
    dens = t["res_carreaux_varexp"].where(F.col("varexp") == VAR_DENSITY).select(
        "idinspire", F.col("valeur").alias("density"))
    comp = store.where(F.col("varexp") == VAR_COMPETITORS).select("idinspire", F.col("valeur").alias("n"))
    out = todo.join(dens, "idinspire").join(comp, "idinspire").select(
        "idinspire", X.inhabitants_per_site("density", "n").alias("valeur"))
    return _store_rows(out, VAR_INHABITANTS, now)


def _store_rows(df: DataFrame, varexp: str, now=None) -> DataFrame:
    ts = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return df.select("idinspire", F.lit(varexp).alias("varexp"), F.col("valeur").cast("double").alias("valeur"),
                     F.lit(True).alias("reel"), ts.alias("date_calcul"))


# ---------------------------------------------------------------------------
# Feature matrices and project vectors
# ---------------------------------------------------------------------------
def cell_feature_matrix(t: dict, trade: str, candidates: DataFrame, dictionary: DataFrame,
                        scale: int | None = 3, area: bool = True) -> DataFrame:
    """One row per (project, candidate cell) with every dictionary
    feature (J4: complete cells only), plus milieu and zone code (``area``;
    without it only cells that belong to a commune are kept).

    ``dictionary`` = ``(feature, varexp, scope)``, scope ``global`` for the
    shared store and ``trade`` for the trade store; it has tens of rows and
    is read to the driver to name the pivot columns."""
    entries = [(r["feature"], r["varexp"], r["scope"]) for r in dictionary.collect()]
    cells = candidates.select("idinspire").distinct()
    g = t["res_carreaux_varexp"].withColumn("_scope", F.lit("global"))
    m = t[f"res_carreaux_varexp_{trade}"].withColumn("_scope", F.lit("trade"))
    cols = ["idinspire", "varexp", "valeur", "date_calcul", "_scope"]
    store = g.select(*cols).unionByName(m.select(*cols)).join(cells, "idinspire", "left_semi")
    store = store.withColumn("_attr", F.concat_ws(":", "_scope", "varexp"))
    # latest value per (cell, attribute) and widening in one aggregate
    wide = eav.widen(store, ["idinspire"], "_attr", "valeur",
                     [f"{s}:{v}" for _, v, s in entries], [f for f, _, _ in entries],
                     complete=True, round_to=scale, latest_by=["date_calcul"])
    cc = t["carreaux_communes"].select("idinspire", "milieu", "code_commune")
    if not area:
        return candidates.join(wide.join(cc.select("idinspire"), "idinspire", "left_semi"), "idinspire")
    uu = t["unites_urbaines"].select(F.col("codgeo").alias("code_commune"), F.col("statut_2017").alias("zone"))
    wide = (wide.join(cc, "idinspire").join(bounded_broadcast(uu), "code_commune")
            .withColumn("milieu", X.milieu_flag_strict("milieu"))
            .withColumn("zone", X.ordinal_recode("zone")).drop("code_commune"))
    return candidates.join(wide, "idinspire")


def stored_scores(scores: DataFrame, score: str = SCORE_3Y, out: str = STACKED) -> DataFrame:
    """Latest stored cell score of each (project, cell)."""
    s = scores.where(F.col("score") == score).select(
        "idinspire", F.col("fk_projet").alias("id_projet"), F.col("valeur").alias(out), "date_prediction")
    return eav.latest_per_key(s, ["idinspire", "id_projet"], [out], ["date_prediction", out])


def with_stored_score(matrix: DataFrame, scores: DataFrame, score: str = SCORE_3Y,
                      out: str = STACKED) -> DataFrame:
    """Attach the stored cell score of the same project."""
    return matrix.join(stored_scores(scores, score, out), ["idinspire", "id_projet"])


def zone_cells(t: dict, located: DataFrame) -> DataFrame:
    """(id_projet, idinspire): every cell that meets the drawn zone (J6),
    candidate or not."""
    zone = located.where(F.col("localisation_type") == DRAWN_ZONE).select("id_projet", "hull")
    hit = S.cells_in_zones(cell_rectangles(t["insee_carreaux"]), zone, "id_projet", TILE_M, mode="intersects")
    return hit.select("id_projet", F.col("cell_id").alias("idinspire")).distinct()


def zone_vectors(t: dict, trade: str, located: DataFrame, dictionary: DataFrame, features: list[str],
                 scores: DataFrame | None = None) -> DataFrame:
    """Mean of each feature over all cells meeting the drawn zone,
    rounded after the mean. With ``scores`` (the 5-year model) only over the
    cells that have a stored 3-year score, whose mean is a feature too."""
    m = cell_feature_matrix(t, trade, zone_cells(t, located), dictionary, scale=None, area=False)
    if scores is not None:
        m, features = with_stored_score(m, scores), features + [STACKED]
    return eav.group_means(m, ["id_projet"], features, 3)


def address_vectors(t: dict, trade: str, located: DataFrame, dictionary: DataFrame,
                    features: list[str], scores: DataFrame | None = None) -> DataFrame:
    """Features of the cell holding the address (one cell per
    project, J5 + T4), and with ``scores`` its stored 3-year score."""
    a = located.where(F.col("localisation_type") == ADDRESS).select("id_projet", "idinspire")
    m = cell_feature_matrix(t, trade, a, dictionary, area=False)
    if scores is not None:
        m, features = with_stored_score(m, scores), features + [STACKED]
    return m.select("id_projet", *features)


def project_vectors(t: dict, trade: str, located: DataFrame, dictionary: DataFrame, features: list[str],
                    scores: DataFrame | None = None) -> DataFrame:
    """Zone or address vector per project, with the project's milieu / zone
    recodes (P12, P13). Projects of another localisation type have none; see
    :func:`unknown_locations`."""
    v = zone_vectors(t, trade, located, dictionary, features, scores).unionByName(
        address_vectors(t, trade, located, dictionary, features, scores))
    meta = located.select("id_projet", X.milieu_flag_strict("milieu").alias("milieu"),
                          X.ordinal_recode("zone").alias("zone"))
    return v.join(meta, "id_projet")


def unknown_locations(located: DataFrame) -> DataFrame:
    """Projects that can't be scored, with the reason."""
    known = F.coalesce(F.col("localisation_type").isin(DRAWN_ZONE, ADDRESS), F.lit(False))
    return located.where(~known).select("id_projet", F.concat(
        F.lit("unknown localisation_type: "), F.coalesce("localisation_type", F.lit("NULL"))).alias("error"))


def prepare_for_model(df: DataFrame, features: list[str], employer_flag: int | None = None,
                      registry_flag: int | None = None) -> DataFrame:
    """A11 + X9 + P10, project by project, so a project's scores don't depend
    on the batch it is scored in: the motorisation rate is filled with its mean
    within the project, the train ridership index is capped, the two flags are
    integer constants, and what is still missing becomes 0 as in training."""
    flags = {"caractere_employeur": employer_flag, "inscription_registre_metiers": registry_flag}
    df = df.withColumns({c: F.lit(int(v)) for c, v in flags.items() if v is not None})
    if MOTORISATION in df.columns:
        df = group_mean_fill(df, ["id_projet"], MOTORISATION)
    if RIDERSHIP in df.columns:
        df = df.withColumn(RIDERSHIP, X.null_safe_cap(RIDERSHIP))
    return df.na.fill(0.0, subset=[c for c in features if c in df.columns])


def group_mean_fill(df: DataFrame, group_cols: list[str], column: str) -> DataFrame:
    """NULLs of a column become the mean of their group (NULL if the
    group has no value). The means are one row per group, pre-aggregated."""
    means = df.groupBy(*group_cols).agg(F.avg(column).alias("_mean"))
    return (df.join(means, group_cols, "left").withColumn(column, F.coalesce(F.col(column), F.col("_mean")))
            .select(*df.columns))


# ---------------------------------------------------------------------------
# C13 / C14 / C15
# ---------------------------------------------------------------------------
def latest_model_run(registry: DataFrame, trade: str, kind: str) -> DataFrame:
    """Newest run id for (trade, model kind)."""
    r = registry.where((F.col("fk_metier") == trade) & (F.col("fk_modele") == kind))
    return T.latest_runs(r, ["fk_metier", "fk_modele"])


def project_opportunity(t: dict, located: DataFrame, trade: str) -> DataFrame:
    """C14: mean opportunity score of the zone cells, or the address cell's."""
    sc = t["res_carreaux_scores"].where((F.col("score") == SCORE_OPPORTUNITY) & (F.col("fk_metier") == trade))
    sc = sc.select("idinspire", "valeur")
    hit = zone_cells(t, located)
    z = hit.join(sc, "idinspire").groupBy("id_projet").agg(F.round(F.avg("valeur"), 3).alias("valeur"))
    a = (located.where(F.col("localisation_type") == ADDRESS).select("id_projet", "idinspire")
         .join(sc, "idinspire").select("id_projet", F.round("valeur", 3).alias("valeur")))
    return z.unionByName(a).select("id_projet", F.lit(SCORE_OPPORTUNITY).alias("score"), "valeur")


def project_feature_records(vectors: DataFrame, features: list[str], dictionary: DataFrame,
                            now=None) -> DataFrame:
    """Project vector transposed (X16), feature names mapped to
    catalogue names (P15), percent rank of each value across projects (W3)."""
    long = eav.unpivot(vectors, ["id_projet"], features, "varexp", "valeur")
    ranked = ranking.percent_rank_avg(long, ["varexp"], "valeur", "centile")
    renamed = eav.rename_values(ranked, "varexp", dictionary.select("feature", "varexp"))
    ts = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return renamed.select("varexp", "valeur", "id_projet", ts.alias("date_calcul"),
                          F.lit(True).alias("reel"), "centile")


# ---------------------------------------------------------------------------
# Full inference for a set of projects
# ---------------------------------------------------------------------------
def infer_projects(spark, t: dict, trade: str, project_ids: DataFrame, dictionary: DataFrame,
                   model_3y=None, features_3y: list[str] | None = None, model_5y=None,
                   features_5y: list[str] | None = None, employer_flag: int = 1, registry_flag: int = 1,
                   out_dir: str | None = None, base: str | None = None, batch: str | None = None) -> dict:
    """Locate, candidate cells, missing attributes, 3-year then 5-year
    cell and project scores, project opportunity. Returns the result frames;
    with ``out_dir`` they are also written: cell scores replace their
    (score, trade, project) slice, also for projects that have no cell any
    more; everything else is appended under ``batch`` (a new id unless
    passed), so a failed run repeated with its batch id adds no row twice.

    Models and their selected features are those of the newest runs below
    ``base`` (C13) unless they are passed; a trade without a 5-year run gets
    3-year scores only."""
    from geoscore.operators.ml import score
    if base is not None and model_3y is None:
        from geoscore.plans.training import KIND_3Y, KIND_5Y, find_latest_model, load_latest_model
        _, model_3y, features_3y = load_latest_model(spark, base, trade, KIND_3Y)
        _, model_5y, features_5y = find_latest_model(spark, base, trade, KIND_5Y) or (None, None, None)
    batch = batch or uuid.uuid4().hex
    if out_dir:
        T.log_status(spark, f"{out_dir}/statut_projets", project_ids, STATUS_RUNNING, batch=f"{batch}-running")
    located = locate_projects(t, project_ids)
    cand = candidate_cells(t, located)
    comp = competitor_counts(t, trade, cand)
    inh = inhabitants_per_establishment(t, trade, cand, comp)
    t = dict(t)
    t[f"res_carreaux_varexp_{trade}"] = (t[f"res_carreaux_varexp_{trade}"]
                                         .select("idinspire", "varexp", "valeur", "reel", "date_calcul")
                                         .unionByName(comp).unionByName(inh))
    errors = unknown_locations(located)
    results = {"located": located, "candidates": cand, "new_varexp": comp.unionByName(inh), "errors": errors}
    feats = [r["feature"] for r in dictionary.collect()]
    flags = {"employer_flag": employer_flag, "registry_flag": registry_flag}
    matrix = materialize(cell_feature_matrix(t, trade, cand, dictionary))

    def cell_scores(model, rows, features, name):
        return materialize(score(model, prepare_for_model(rows, features, **flags), "valeur").select(
            "idinspire", F.lit(name).alias("score"), "valeur", F.lit(trade).alias("fk_metier"),
            F.col("id_projet").alias("fk_projet"), F.current_timestamp().alias("date_prediction"),
            F.lit(True).alias("reel")))

    def project_scores(model, rows, features, name):
        return score(model, prepare_for_model(rows, features, **flags), "valeur").select(
            "id_projet", F.lit(name).alias("score"), "valeur")

    vec = materialize(project_vectors(t, trade, located, dictionary, feats))
    cell3 = cell_scores(model_3y, matrix, features_3y, SCORE_3Y)
    records = prepare_for_model(vec, [], **flags)
    records = records.withColumns({c: F.col(c).cast("double") for c in RECORDED})
    results.update(cell_scores_3y=cell3, project_scores_3y=project_scores(model_3y, vec, features_3y, SCORE_3Y),
                   project_records=project_feature_records(records, feats + RECORDED, dictionary))
    if model_5y is not None:
        f5 = features_5y or features_3y + [STACKED]
        vec5 = project_vectors(t, trade, located, dictionary, feats, cell3)
        results["cell_scores_5y"] = cell_scores(model_5y, with_stored_score(matrix, cell3), f5, SCORE_5Y)
        results["project_scores_5y"] = project_scores(model_5y, vec5, f5, SCORE_5Y)
    if "res_carreaux_scores" in t:
        results["project_opportunity"] = project_opportunity(t, located, trade)
    if out_dir:
        T.append(results["new_varexp"], f"{out_dir}/res_carreaux_varexp_{trade}", batch=batch)
        for k, name in (("cell_scores_3y", SCORE_3Y), ("cell_scores_5y", SCORE_5Y)):
            if k in results:
                scored = results[k].select(F.col("fk_projet").alias("id_projet")).distinct()
                bare = project_ids.select("id_projet").distinct().join(scored, "id_projet", "left_anti").collect()
                T.replace_slices(results[k], f"{out_dir}/res_carreaux_scores", SCORE_SLICES,
                                 [(name, trade, r["id_projet"]) for r in bare])
        for k in ("project_scores_3y", "project_scores_5y", "project_opportunity"):
            if k in results:
                T.append(results[k].withColumn("date_prediction", F.current_timestamp())
                         .withColumn("reel", F.lit(True)), f"{out_dir}/res_projets_scores", batch=f"{batch}-{k}")
        T.append(results["project_records"], f"{out_dir}/res_projets_varexp", batch=batch)
        T.log_status(spark, f"{out_dir}/statut_projets", project_ids.join(errors, "id_projet", "left_anti"), STATUS_DONE,
                     batch=f"{batch}-done")
        T.log_status(spark, f"{out_dir}/statut_projets", errors, STATUS_FAILED, batch=f"{batch}-failed")
    return results
