"""Training feature tables (C1, C2) on the location model's own schema.

Tables are passed as a dict name -> DataFrame (any source: Parquet, JDBC,
catalog); per-trade and per-milieu tables and columns are chosen by
parameter, as in the reference's templated SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoscore.functions import columns as X
from geoscore.operators.joins import bounded_broadcast

# ---------------------------------------------------------------------------
# Fixed values (feature definitions that must equal the reference's)
# ---------------------------------------------------------------------------
# Share of each socio-professional category in the population aged 15+,
# rounded to 3 decimals: (feature, numerator column of insee_csp_iris).
CSP_RATIOS = [
    ("taux_agriculteurs_exploitants", "c15_pop15p_cs1"),
    ("taux_artisans_commercants_entrepreneurs", "c15_pop15p_cs2"),
    ("taux_cadres_professions_intellectuelles_superieures", "c15_pop15p_cs3"),
    ("taux_professions_intermediaires", "c15_pop15p_cs4"),
    ("taux_employes", "c15_pop15p_cs5"),
    ("taux_ouvriers", "c15_pop15p_cs6"),
    ("taux_retraites", "c15_pop15p_cs7"),
    ("taux_autres_sans_activite_professionnelle", "c15_pop15p_cs8"),
]
CSP_TOTAL = "c15_pop15p"
# Grid census ratios: (feature, numerator, denominator), unguarded.
CENSUS_RATIOS = [
    ("taux_pauvrete", "men_pauv", "men"),
    ("taux_menages_1_individu", "men_1ind", "men"),
    ("taux_menages_plus_5_individus", "men_5ind", "men"),
    ("taux_menages_proprietaires", "men_prop", "men"),
    ("taux_menages_monoparentaux", "men_fmp", "men"),
    ("niveau_vie", "ind_snv", "ind"),
    ("surface_logement", "men_surf", "men"),
    ("taux_logements_collectifs", "men_coll", "men"),
    ("taux_maisons", "men_mais", "men"),
    ("taux_logements_avant_1945", "log_av45", "men"),
    ("taux_logements_1945_1970", "log_45_70", "men"),
    ("taux_logements_1970_1990", "log_70_90", "men"),
    ("taux_logements_apres_1990", "log_ap90", "men"),
    ("taux_logements_sociaux", "log_soc", "men"),
    ("taux_population_moins_3_ans", "ind_0_3", "ind"),
    ("taux_population_4_5_ans", "ind_4_5", "ind"),
    ("taux_population_6_10_ans", "ind_6_10", "ind"),
    ("taux_population_11_17_ans", "ind_11_17", "ind"),
    ("taux_population_18_24_ans", "ind_18_24", "ind"),
    ("taux_population_25_39_ans", "ind_25_39", "ind"),
    ("taux_population_40_54_ans", "ind_40_54", "ind"),
    ("taux_population_55_64_ans", "ind_55_64", "ind"),
    ("taux_population_65_79_ans", "ind_65_79", "ind"),
    ("taux_population_plus_80_ans", "ind_80p", "ind"),
]
# Weighted-data series used as the population index.
POPULATION_SERIES = 4
MILIEUS = ("urbain", "rural")
# Not-null requirements of the survival training rows.
SURVIVAL_REQUIRED = ["nb_concurrents_debut", "nb_habitants_etablissement_debut", "taux_motorisation"]


def _t(tables: dict, name: str) -> DataFrame:
    if name not in tables:
        raise KeyError(f"table {name!r} missing")
    return tables[name]


def survival_features(tables: dict, trade: str, target: str = "survie_3_ans", distinct: bool = True) -> DataFrame:
    """The establishment star join (J1, J2, A8, X2, P3), once for the
    establishments of both milieus.

    Trade-specific establishments come from ``etablissements_cibles_{trade}``,
    census columns are discovered (S2). Competition and craft indexes exist for
    each milieu; a row takes those of its own, by name."""
    est = _t(tables, f"etablissements_cibles_{trade}").select("siret", "code_commune", "code_iris", "idinspire")
    surv = _t(tables, "taux_survie_etablissements").select("siret", "duree_vie", target)
    uu = _t(tables, "unites_urbaines").select(
        F.col("codgeo").alias("code_commune"), F.col("type_com").alias("type_milieu_2"),
        F.col("statut_2017").alias("type_milieu_4"))
    cat = _t(tables, "categories_communes_aires_urbaines").select(
        F.col("codgeo").alias("code_commune"), "indice_densite_emplois")
    log = _t(tables, "insee_logements_iris").select(
        F.col("iris").alias("code_iris"),
        X.guarded_ratio("p16_rsecocc", "p16_log", 2).alias("taux_residences_secondaires"))
    mot = _t(tables, "datagouv_taux_motorisation").select(
        "code_iris", F.col("taux_motorisation_iris").alias("taux_motorisation"))
    csp = _t(tables, "insee_csp_iris").select(
        "code_iris", *[X.guarded_ratio(F.col(n).cast("double"), F.col(CSP_TOTAL).cast("double"), 3).alias(name)
                       for name, n in CSP_RATIOS])
    grid_raw = _t(tables, "insee_donnees_carroyees_niveau_200m")
    census_cols = [c for c in grid_raw.columns if c not in X.CENSUS_EXCLUDED]
    grid = grid_raw.select("idinspire", *census_cols)
    agg = _t(tables, "donnees_agregees_carreau").select("idinspire", "nb_transactions_immobilieres")
    pond = _t(tables, "donnees_ponderees_carreau")
    pop = (pond.where(F.col("fk_donnees_ponderees") == POPULATION_SERIES)
           .select("idinspire", F.col("valeur").cast("double").alias("indice_population")))
    prix = _t(tables, "data_immobiliere_final").select("idinspire", "prix_m2")
    sirene = _t(tables, "sirene_etablissements").select(
        "siret", F.col("caractere_employeur_etablissement").alias("caractere_employeur"),
        X.present_flag("activite_principale_registre_metiers_etablissement").alias("inscription_registre_metiers"))
    of_milieu = ["nb_concurrents_debut", "nb_habitants_etablissement_debut", "taux_etablissements_concurrents_debut"]
    conc = _t(tables, "indices_concurrence").select("siret", *(f"{c}_{m}" for c in of_milieu for m in MILIEUS))
    syn_raw = _t(tables, "indices_synergie_territoriale")
    craft = [c.removesuffix("_urbain") for c in syn_raw.columns if c.startswith("indice_artisanat_") and c.endswith("_urbain")]
    syn = syn_raw.select("siret", *((F.col(c).cast("double") if c.startswith("indice_") else F.col(c)).alias(c)
                                    for c in syn_raw.columns if c != "siret"))
    # selective keys first; commune / IRIS dimensions are small and size-checked
    j = (est.join(surv, "siret")
         .join(bounded_broadcast(uu), "code_commune")
         .join(bounded_broadcast(cat), "code_commune")
         .join(bounded_broadcast(log), "code_iris")
         .join(bounded_broadcast(mot), "code_iris")
         .join(bounded_broadcast(csp), "code_iris")
         .join(grid, "idinspire").join(agg, "idinspire").join(pop, "idinspire").join(prix, "idinspire")
         .join(sirene, "siret").join(conc, "siret").join(syn, "siret")
         .where(F.col("type_milieu_2").isin([m.upper() for m in MILIEUS])))
    own = {c: F.when(F.col("type_milieu_2") == MILIEUS[0].upper(), F.col(f"{c}_{MILIEUS[0]}")).otherwise(F.col(f"{c}_{MILIEUS[1]}"))
           for c in of_milieu + craft}
    j = j.withColumns(own).drop(*(f"{c}_{m}" for c in own for m in MILIEUS))
    return j.distinct() if distinct else j


def survival_features_milieu(tables: dict, trade: str, milieu: str, target: str = "survie_3_ans",
                             distinct: bool = True) -> DataFrame:
    """The rows of one milieu, ``urbain`` or ``rural``."""
    return survival_features(tables, trade, target, distinct).where(F.col("type_milieu_2") == milieu.upper())


def transform_census(df: DataFrame, census_cols: list[str]) -> DataFrame:
    """Census ratios, mean age, employer flag; raw
    census columns dropped."""
    extra = [X.weighted_band_mean(X.AGE_BAND_COLUMNS).alias("age_moyen")]
    extra += [X.safe_ratio(n, d).alias(name) for name, n, d in CENSUS_RATIOS]
    out = df.select("*", *extra).withColumn(
        "caractere_employeur", X.equals_flag("caractere_employeur", X.EMPLOYER_YES))
    return out.drop(*census_cols)


def survival_training_set(tables: dict, trade: str, target: str = "survie_3_ans") -> DataFrame:
    """Urban and rural rows (U2, of one join) with milieu / zone recodes (P11, P13),
    transformed census data and the not-null filter (P4)."""
    census_cols = [c for c in _t(tables, "insee_donnees_carroyees_niveau_200m").columns
                   if c not in X.CENSUS_EXCLUDED]
    both = (survival_features(tables, trade, target)
            .withColumn("milieu", (F.col("type_milieu_2") == MILIEUS[0].upper()).cast("int"))
            .withColumn("zone", X.ordinal_recode("type_milieu_4")))
    both = transform_census(both, census_cols)
    both = both.dropna(subset=SURVIVAL_REQUIRED)
    return both.drop("duree_vie", "type_milieu_2", "type_milieu_4")


def opportunity_features(tables: dict, trade: str, impute: bool = True,
                         count_column: str = "nb_etablissements_actifs_{trade}") -> DataFrame:
    """C1 + A11: IRIS indicators joined with the active-establishment count
    of the trade, milieu and zone recodes, means filled in. ``count_column``
    selects the target (L2: the legacy version counted all establishments,
    e.g. ``nb_etablissements_{trade}``).

    Rows without a target are dropped rather than imputed; the ordinal zone
    code is not averaged (it stays NULL, with ``zone_missing`` = 1)."""
    a = _t(tables, "donnees_agregees_iris")
    b = _t(tables, "nb_etablissements_iris").select(
        "code_iris", F.col(count_column.format(trade=trade)).cast("double").alias("nb_etablissements"))
    c = _t(tables, "iris_communes").select("code_iris", "code_commune")
    d = _t(tables, "unites_urbaines").select(
        F.col("codgeo").alias("code_commune"), F.col("type_com").alias("milieu_raw"),
        F.col("statut_2017").alias("zone_raw"))
    keep = [col for col in a.columns if col == "code_iris" or not col.startswith("indice_naf_niveau_1_")
            or col == f"indice_naf_niveau_1_{trade}"]
    j = (a.select(*keep).join(b, "code_iris").join(c, "code_iris")
         .join(bounded_broadcast(d), "code_commune", "left"))
    j = (j.withColumn("milieu", X.milieu_flag("milieu_raw"))
         .withColumn("zone", X.ordinal_recode("zone_raw"))
         .drop("milieu_raw", "zone_raw", "code_commune")
         .where(F.col("nb_etablissements").isNotNull()))
    if not impute:
        return j
    return mean_fill(j, exclude=["code_iris", "nb_etablissements", "milieu", "zone"])


def mean_fill(df: DataFrame, exclude: list[str]) -> DataFrame:
    """NULL (and NaN) numeric values replaced by the column mean; one
    aggregate row attached by a broadcast cross join, no driver round trip."""
    num = [f.name for f in df.schema.fields if f.name not in exclude
           and f.dataType.typeName() in ("double", "float", "integer", "long", "decimal", "short")]
    clean = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c)
                        if c in num else F.col(c) for c in df.columns])
    means = clean.agg(*[F.avg(c).alias(f"_m_{c}") for c in num])
    filled = clean.crossJoin(F.broadcast(means))
    out = [F.coalesce(F.col(c), F.col(f"_m_{c}")).alias(c) if c in num else F.col(c) for c in df.columns]
    res = filled.select(*out)
    if "zone" in df.columns:
        res = res.withColumn("zone_missing", F.col("zone").isNull().cast("int"))
    return res
