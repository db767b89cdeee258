"""A small synthetic world in the location model's schema, for job tests.

3 x 3 square communes of 4 km around Lambert-93 (700 000, 6 600 000), a
200 m cell grid, establishments, census, attribute stores and projects.
"""

from __future__ import annotations

import datetime

import numpy as np
import pandas as pd

TRADE = "boulangerie"
X0, Y0 = 694_000.0, 6_594_000.0
COMMUNE_M = 4_000.0
CELL_M = 200.0
N_CELLS = int(3 * COMMUNE_M / CELL_M)  # 60 per side
GLOBAL_VARS = ["densite_pop", "ind_equipements_commerce", "revenu_median"]
TRADE_VARS = ["nb_concurrents", "nb_habitants_etablissement", "indice_naf_1"]


def _ring(x0, y0, x1, y1):
    return [{"x": float(x0), "y": float(y0)}, {"x": float(x1), "y": float(y0)},
            {"x": float(x1), "y": float(y1)}, {"x": float(x0), "y": float(y1)}]


def build(spark, seed: int = 0, n_sites: int = 400, n_est: int = 600) -> dict:
    rng = np.random.default_rng(seed)
    t = {}
    # communes and their shapes
    com_rows, shape_rows, maille_rows, uu_rows, cat_rows = [], [], [], [], []
    for i in range(3):
        for j in range(3):
            code = f"C{i}{j}"
            gid = 100 + 3 * i + j
            x0, y0 = X0 + i * COMMUNE_M, Y0 + j * COMMUNE_M
            shape_rows.append((gid, _ring(x0, y0, x0 + COMMUNE_M, y0 + COMMUNE_M)))
            maille_rows.append((gid, code, 3, 51010))
            urban = (i, j) == (1, 1)
            uu_rows.append((code, "URBAIN" if urban else "RURAL", "C" if urban else "BIR"[(i + j) % 3]))
            cat_rows.append((code, float(rng.uniform(0, 2))))
            com_rows.append(code)
    t["formes_mailles_geographiques"] = spark.createDataFrame(
        shape_rows, "fk_geo int, geom array<struct<x:double,y:double>>")
    # IRIS: one per commune quadrant (4 per commune)
    iris_rows, iris_com = [], []
    for code in com_rows:
        for q in range(4):
            iris = f"{code}I{q}"
            iris_rows.append(iris)
            iris_com.append((iris, code))
    maille_rows += [(500 + k, iris, 5, 51010 if k % 5 else 99999) for k, iris in enumerate(iris_rows)]
    t["mailles_geographiques"] = spark.createDataFrame(maille_rows, "id_geo int, geo_value string, geo_level int, fk_geo_1 int")
    t["unites_urbaines"] = spark.createDataFrame(uu_rows, "codgeo string, type_com string, statut_2017 string")
    t["categories_communes_aires_urbaines"] = spark.createDataFrame(cat_rows, "codgeo string, indice_densite_emplois double")
    t["iris_communes"] = spark.createDataFrame(iris_com, "code_iris string, code_commune string")

    # cells
    cells = []
    for ix in range(N_CELLS):
        for iy in range(N_CELLS):
            xc, yc = X0 + (ix + 0.5) * CELL_M, Y0 + (iy + 0.5) * CELL_M
            ci, cj = int(ix * CELL_M // COMMUNE_M), int(iy * CELL_M // COMMUNE_M)
            q = (2 if (ix * CELL_M % COMMUNE_M) >= COMMUNE_M / 2 else 0) + (1 if (iy * CELL_M % COMMUNE_M) >= COMMUNE_M / 2 else 0)
            cells.append((f"N{iy:03d}E{ix:03d}", xc, yc, f"C{ci}{cj}", f"C{ci}{cj}I{q}"))
    cdf = pd.DataFrame(cells, columns=["idinspire", "x_m", "y_m", "code_commune", "code_iris"])
    milieu = {c: ("URBAIN" if c == "C11" else "RURAL") for c in com_rows}
    cdf["milieu"] = cdf.code_commune.map(milieu)
    t["insee_carreaux"] = spark.createDataFrame(cdf[["idinspire", "x_m", "y_m"]])
    t["carreaux_communes"] = spark.createDataFrame(cdf[["idinspire", "milieu", "code_commune"]])
    t["carreaux_iris"] = spark.createDataFrame(cdf[["idinspire", "code_iris"]])
    # census on 90 % of cells
    census = cdf.sample(frac=0.9, random_state=seed)[["idinspire"]].copy()
    bands = ["ind_0_3", "ind_4_5", "ind_6_10", "ind_11_17", "ind_18_24", "ind_25_39", "ind_40_54",
             "ind_55_64", "ind_65_79", "ind_80p"]
    for b in bands:
        census[b] = rng.integers(0, 30, len(census)).astype(float)
    census["ind"] = census[bands].sum(axis=1)
    for c in ["men", "men_pauv", "men_1ind", "men_5ind", "men_prop", "men_fmp", "men_surf", "men_coll",
              "men_mais", "log_av45", "log_45_70", "log_70_90", "log_ap90", "log_soc", "ind_snv"]:
        census[c] = rng.integers(0, 40, len(census)).astype(float)
    census["men"] = census["men"] + 1
    census["depcom"] = "x"
    census["groupe"] = 1.0
    t["insee_donnees_carroyees_niveau_200m"] = spark.createDataFrame(census)
    t["donnees_agregees_carreau"] = spark.createDataFrame(
        pd.DataFrame({"idinspire": cdf.idinspire, "nb_transactions_immobilieres": rng.integers(0, 9, len(cdf))}))
    pond = pd.concat([pd.DataFrame({"idinspire": cdf.idinspire, "fk_donnees_ponderees": k,
                                    "valeur": rng.uniform(0, 100, len(cdf))}) for k in (3, 4)])
    t["donnees_ponderees_carreau"] = spark.createDataFrame(pond)
    t["data_immobiliere_final"] = spark.createDataFrame(
        pd.DataFrame({"idinspire": cdf.idinspire, "prix_m2": rng.uniform(1000, 5000, len(cdf))}))

    # establishments of the trade (training rows and competitor sites)
    pick = rng.integers(0, len(cdf), n_est)
    est = cdf.iloc[pick].reset_index(drop=True)
    est["siret"] = [f"S{k:06d}" for k in range(n_est)]
    est["x_m"] = est.x_m + rng.uniform(-90, 90, n_est)
    est["y_m"] = est.y_m + rng.uniform(-90, 90, n_est)
    est["date_fin"] = pd.to_datetime(np.where(rng.random(n_est) < 0.2, "2020-01-01", None))
    t[f"etablissements_cibles_{TRADE}"] = spark.createDataFrame(
        est[["siret", "code_commune", "code_iris", "idinspire", "x_m", "y_m", "date_fin"]],
        "siret string, code_commune string, code_iris string, idinspire string, x_m double, y_m double, date_fin timestamp")
    s3 = rng.random(n_est) < 0.6
    t["taux_survie_etablissements"] = spark.createDataFrame(pd.DataFrame({
        "siret": est.siret, "duree_vie": rng.integers(0, 10, n_est), "survie_3_ans": s3,
        "survie_5_ans": s3 & (rng.random(n_est) < 0.7)}))
    t["insee_logements_iris"] = spark.createDataFrame(pd.DataFrame({
        "iris": iris_rows, "p16_log": rng.integers(0, 50, len(iris_rows)).astype(float),
        "p16_rsecocc": rng.integers(0, 10, len(iris_rows)).astype(float)}))
    mot = rng.uniform(0, 1, len(iris_rows))
    mot[::7] = np.nan
    t["datagouv_taux_motorisation"] = spark.createDataFrame(
        pd.DataFrame({"code_iris": iris_rows, "taux_motorisation_iris": mot}).astype({"taux_motorisation_iris": "float64"}))
    csp = pd.DataFrame({"code_iris": iris_rows, "c15_pop15p": rng.integers(0, 100, len(iris_rows)).astype(float)})
    for k in range(1, 9):
        csp[f"c15_pop15p_cs{k}"] = rng.integers(0, 12, len(iris_rows)).astype(float)
    t["insee_csp_iris"] = spark.createDataFrame(csp)
    t["sirene_etablissements"] = spark.createDataFrame(pd.DataFrame({
        "siret": est.siret, "caractere_employeur_etablissement": np.where(rng.random(n_est) < 0.5, "O", "N"),
        "activite_principale_registre_metiers_etablissement": np.where(rng.random(n_est) < 0.5, "1071C", None)}))
    conc = {"siret": est.siret}
    for m in ("urbain", "rural"):
        conc[f"nb_concurrents_debut_{m}"] = rng.integers(0, 20, n_est).astype(float)
        conc[f"nb_habitants_etablissement_debut_{m}"] = rng.uniform(0, 500, n_est)
        conc[f"taux_etablissements_concurrents_debut_{m}"] = rng.uniform(0, 1, n_est)
    t["indices_concurrence"] = spark.createDataFrame(pd.DataFrame(conc))
    syn = {"siret": est.siret}
    for c in ["indice_concurrence_restreinte_urbain", "indice_concurrence_large_urbain",
              "indice_artisanat_proximite_urbain", "indice_artisanat_proximite_rural",
              "indice_equipements_commerces", "nb_stagiaires"]:
        syn[c] = rng.uniform(0, 1, n_est)
    t["indices_synergie_territoriale"] = spark.createDataFrame(pd.DataFrame(syn))

    # opportunity training tables (per IRIS)
    agg = pd.DataFrame({"code_iris": iris_rows})
    for c in ["population", "age_moyen", "taux_pauvrete", f"indice_naf_niveau_1_{TRADE}",
              "indice_naf_niveau_1_coiffure", "nb_equipements_commerces"]:
        agg[c] = rng.uniform(0, 100, len(iris_rows))
    agg.loc[::5, "age_moyen"] = np.nan
    t["donnees_agregees_iris"] = spark.createDataFrame(agg)
    cnt = est[est.date_fin.isna()].groupby("code_iris").size()
    t["nb_etablissements_iris"] = spark.createDataFrame(pd.DataFrame({
        "code_iris": iris_rows, f"nb_etablissements_actifs_{TRADE}": [int(cnt.get(i, 0)) for i in iris_rows]}))

    # attribute stores: global and per trade; some cells miss attributes
    rows = []
    for k, cid in enumerate(cdf.idinspire):
        for v in GLOBAL_VARS:
            if (k + len(v)) % 23 == 0:
                continue
            rows.append((cid, v, None if (k + len(v)) % 31 == 0 else float(rng.uniform(0, 50)), True,
                         datetime.datetime(2021, 1, 1)))
    t["res_carreaux_varexp"] = spark.createDataFrame(
        rows, "idinspire string, varexp string, valeur double, reel boolean, date_calcul timestamp")
    rows = []
    for k, cid in enumerate(cdf.idinspire):
        if k % 3 == 0:
            rows.append((cid, "nb_concurrents", float(k % 5), True, datetime.datetime(2021, 1, 1)))
        rows.append((cid, "indice_naf_1", float(rng.uniform(0, 1)), True, datetime.datetime(2021, 1, 1)))
    t[f"res_carreaux_varexp_{TRADE}"] = spark.createDataFrame(
        rows, "idinspire string, varexp string, valeur double, reel boolean, date_calcul timestamp")
    t["res_carreaux_scores"] = spark.createDataFrame(pd.DataFrame({
        "idinspire": cdf.idinspire, "score": "opportunite", "valeur": rng.uniform(0, 1, len(cdf)),
        "fk_metier": TRADE, "fk_projet": None}).astype({"fk_projet": "float64"}))

    # projects: address in the centre commune, drawn zone, address in a corner commune
    t["ref_metier"] = spark.createDataFrame([(TRADE, "Boulangerie")], "id_metier string, libelle_metier string")
    t["projets"] = spark.createDataFrame([
        (1, 3.0013, 46.5007, TRADE, "adresse", "nouveau"),
        (2, 3.004, 46.501, TRADE, "dessin sur une zone", "nouveau"),
        (3, 2.935, 46.45, TRADE, "adresse", "nouveau")],
        "id_projet int, longitude double, latitude double, activite string, localisation_type string, statut_etude string")
    t["projets_dessin"] = spark.createDataFrame(
        [(2, 3.003, 46.5005), (2, 3.008, 46.5005), (2, 3.0055, 46.504), (2, 3.005, 46.502)],
        "id_projet int, longitude double, latitude double")
    return t


def dictionary(spark):
    rows = [("densite", "densite_pop", "global"), ("equip", "ind_equipements_commerce", "global"),
            ("revenu", "revenu_median", "global"), ("concurrents", "nb_concurrents", "trade"),
            ("habitants", "nb_habitants_etablissement", "trade"), ("naf1", "indice_naf_1", "trade")]
    return spark.createDataFrame(rows, "feature string, varexp string, scope string")
