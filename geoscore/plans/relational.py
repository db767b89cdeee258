"""Relational stand-in queries: star joins, recodes, EAV, ratios, imputation,
caps, scores, residuals, metrics, run registry and table maintenance.

Stand-ins (driver tables for the location model's tables): lineitem for
the establishments of the star join; events ``(user_id, week)`` for the
attribute store of grid cells; customers for statistical areas with the
count of urgent orders as establishment count; labels for boolean targets.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from geoscore.functions import columns as X
from geoscore.operators import eav, metrics, ranking, scoring
from geoscore.operators.joins import bounded_broadcast, join_filtered, star_join
from geoscore.plans.catalog import R, register
from geoscore.sources import tables
from geoscore.sources.testdata import load

# Attribute dictionary of the events stand-in (the attribute names).
EVENT_TYPES = ["click", "view", "purchase", "signup", "error"]
# Ordinal recode used by the order-priority stand-in of the zone status.
PRIORITY_CODES = {"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2, "4-NOT SPECIFIED": 1}


# ---------------------------------------------------------------------------
# star_features: J1 J2 A8 P1 X2
# ---------------------------------------------------------------------------
def star_features(spark, d):
    li = load(spark, d, "lineitem")
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    c = load(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = load(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = load(spark, d, "region").select("r_regionkey", "r_name")
    p = load(spark, d, "part").select("p_partkey", "p_brand")
    s = load(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    fact = li.select("l_orderkey", "l_partkey", "l_suppkey", "l_tax", "l_discount")
    joined = star_join(
        join_filtered(fact, o, fact.l_orderkey == o.o_orderkey, F.col("o_orderstatus") == "F"),
        [(c, F.col("o_custkey") == F.col("c_custkey")),
         (n, F.col("c_nationkey") == F.col("n_nationkey"), True),
         (r, F.col("n_regionkey") == F.col("r_regionkey"), True),
         (p, F.col("l_partkey") == F.col("p_partkey")),
         (s, F.col("l_suppkey") == F.col("s_suppkey"))])
    return joined.select(
        "l_orderkey", "c_custkey", "n_name", "r_name", "p_brand", "s_name",
        X.guarded_ratio("l_tax", "l_discount", 2).alias("tax_disc_ratio"),
        X.guarded_ratio("c_acctbal", "s_acctbal", 2).alias("acct_ratio"),
    ).distinct()


register("star_features", oracle=f"""
SELECT DISTINCT l.l_orderkey, c.c_custkey, n.n_name, r.r_name, p.p_brand, s.s_name,
  CASE WHEN l.l_discount != 0 THEN {R('l.l_tax / l.l_discount', 2)} ELSE 0.0 END AS tax_disc_ratio,
  CASE WHEN s.s_acctbal != 0 THEN {R('c.c_acctbal / s.s_acctbal', 2)} ELSE 0.0 END AS acct_ratio
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey AND o.o_orderstatus = 'F'
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
""")(star_features)


# ---------------------------------------------------------------------------
# left_lookup_recode: J3 P8 P11 P12 P13 P14
# ---------------------------------------------------------------------------
def left_lookup_recode(spark, d):
    o = load(spark, d, "orders")
    c = load(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    n = load(spark, d, "nation").select("n_nationkey", "n_name")
    j = join_filtered(o, c, o.o_custkey == c.c_custkey, F.col("c_acctbal") > 0, "left")
    j = j.join(bounded_broadcast(n), j.c_nationkey == n.n_nationkey, "left")
    return j.select(
        "o_orderkey",
        X.equals_flag("c_mktsegment", "BUILDING").alias("seg_flag"),
        F.when(F.col("c_mktsegment") == "BUILDING", 1)
         .when(F.col("c_mktsegment") == "MACHINERY", 0).alias("seg_strict"),
        X.ordinal_recode("o_orderpriority", PRIORITY_CODES).alias("prio_code"),
        X.equals_flag("o_orderstatus", "F").alias("status_flag"),
        X.present_flag("c_custkey").alias("has_customer"),
        "n_name",
    )


register("left_lookup_recode", oracle="""
SELECT o.o_orderkey,
  CASE WHEN c.c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS seg_flag,
  CASE WHEN c.c_mktsegment = 'BUILDING' THEN 1 WHEN c.c_mktsegment = 'MACHINERY' THEN 0 END AS seg_strict,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2
       WHEN '4-NOT SPECIFIED' THEN 1 END AS prio_code,
  CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS status_flag,
  CASE WHEN c.c_custkey IS NOT NULL THEN 1 ELSE 0 END AS has_customer,
  n.n_name
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey AND c.c_acctbal > 0
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")(left_lookup_recode)


# ---------------------------------------------------------------------------
# EAV: J4 (widen + completeness), A2 (group means), P7 (missing entities)
# ---------------------------------------------------------------------------
def _events_long(spark, d):
    ev = load(spark, d, "events")
    return ev.select("user_id", F.weekofyear("ts").cast("bigint").alias("wk"),
                     F.col("event_type").alias("varexp"), F.col("value").alias("valeur"),
                     "ts", "event_id")


def eav_wide_complete(spark, d):
    # latest stored value per (entity, attribute), widened in the same aggregate
    return eav.widen(_events_long(spark, d), ["user_id", "wk"], "varexp", "valeur",
                     EVENT_TYPES, complete=True, latest_by=["ts", "event_id"])


_EAV_LATEST = """
WITH l AS (
  SELECT user_id, CAST(weekofyear(ts) AS BIGINT) AS wk, event_type, value,
         row_number() OVER (PARTITION BY user_id, weekofyear(ts), event_type
                            ORDER BY ts DESC, event_id DESC) AS rn
  FROM events),
w AS (
  SELECT user_id, wk,
    max(CASE WHEN event_type = 'click' THEN value END) AS click,
    max(CASE WHEN event_type = 'view' THEN value END) AS view,
    max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase,
    max(CASE WHEN event_type = 'signup' THEN value END) AS signup,
    max(CASE WHEN event_type = 'error' THEN value END) AS error
  FROM l WHERE rn = 1 GROUP BY user_id, wk HAVING count(DISTINCT event_type) = 5)
"""

register("eav_wide_complete", oracle=_EAV_LATEST + "SELECT * FROM w")(eav_wide_complete)


def eav_group_mean(spark, d):
    return eav.group_means(eav_wide_complete(spark, d), ["wk"], EVENT_TYPES, 3)


register("eav_group_mean", oracle=_EAV_LATEST + "SELECT wk, " + ", ".join(
    f"{R(f'avg({t})', 3)} AS {t}" for t in EVENT_TYPES) + " FROM w GROUP BY wk")(eav_group_mean)


def eav_missing_entities(spark, d):
    o = load(spark, d, "orders")
    store = (o.groupBy(F.col("o_custkey").alias("c_custkey"),
                       F.concat(F.lit("y"), F.year("o_orderdate").cast("string")).alias("varexp"))
             .agg(F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("valeur")))
    cands = load(spark, d, "customer").select("c_custkey", "c_name")
    return eav.missing_entities(cands, store, ["c_custkey"], "varexp", "y1998", "valeur")


register("eav_missing_entities", oracle="""
SELECT c.c_custkey, c.c_name FROM customer c
WHERE NOT EXISTS (
  SELECT 1 FROM (
    SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS v
    FROM orders WHERE year(o_orderdate) = 1998 GROUP BY o_custkey) e
  WHERE e.o_custkey = c.c_custkey AND e.v IS NOT NULL)
""")(eav_missing_entities)


# ---------------------------------------------------------------------------
# unpivot_percent_rank: X16 P15 W3
# ---------------------------------------------------------------------------
def unpivot_percent_rank(spark, d):
    part = load(spark, d, "part")
    long = eav.unpivot(part, ["p_partkey"], ["p_size", "p_retailprice"])
    dictionary = spark.createDataFrame([("p_size", "taille_lot")], "feature string, varexp string")
    long = eav.rename_values(long, "varexp", dictionary)
    return ranking.percent_rank_avg(long, ["varexp"], "valeur", "pct_rank")


register("unpivot_percent_rank", oracle="""
WITH l AS (
  SELECT p_partkey, 'taille_lot' AS varexp, CAST(p_size AS DOUBLE) AS valeur FROM part
  UNION ALL
  SELECT p_partkey, 'p_retailprice' AS varexp, CAST(p_retailprice AS DOUBLE) AS valeur FROM part)
SELECT p_partkey, varexp, valeur,
  ((rank() OVER (PARTITION BY varexp ORDER BY valeur) - 1)
    + (count(*) OVER (PARTITION BY varexp, valeur) + 1) / 2.0)
    / count(valeur) OVER (PARTITION BY varexp) AS pct_rank
FROM l
""")(unpivot_percent_rank)


# ---------------------------------------------------------------------------
# ratio_set: X3 X5 A20
# ---------------------------------------------------------------------------
def ratio_set(spark, d):
    li = load(spark, d, "lineitem")
    bands = [F.sum(F.when(F.col("l_linenumber") == i, F.col("l_quantity")).otherwise(F.lit(0.0)))
             .alias(f"q{i}") for i in range(1, 8)]
    ret = F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(F.lit(0.0)))
    ret1 = F.sum(F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1),
                        F.col("l_quantity")).otherwise(F.lit(0.0)))
    wide = li.groupBy("l_orderkey").agg(*bands, ret.alias("q_ret"), ret1.alias("q_ret1"))
    q = [f"q{i}" for i in range(1, 8)]
    total = sum((F.col(c) for c in q[1:]), F.col(q[0]))
    return wide.select(
        "l_orderkey",
        F.round(X.weighted_band_mean(q, X.AGE_BAND_CENTRES[:7]), 6).alias("mean_centre"),
        F.round(X.safe_ratio("q1", total), 6).alias("share_q1"),
        F.round(X.safe_ratio("q2", total), 6).alias("share_q2"),
        F.round(X.safe_ratio("q_ret1", "q_ret"), 6).alias("share_ret1"),
    )


def _ratio_sql():
    q = [f"q{i}" for i in range(1, 8)]
    centres = [2, 4.5, 8, 14, 21, 32, 47]
    num = " + ".join(f"{c} * {float(k)}" for c, k in zip(q, centres))
    tot = " + ".join(q)
    bands = ", ".join(f"sum(CASE WHEN l_linenumber = {i} THEN l_quantity ELSE 0.0 END) AS q{i}"
                      for i in range(1, 8))
    return f"""
WITH w AS (
  SELECT l_orderkey, {bands},
    sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS q_ret,
    sum(CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN l_quantity ELSE 0.0 END) AS q_ret1
  FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey,
  {R(f'({num}) / nullif({tot}, 0)', 6)} AS mean_centre,
  {R(f'q1 / nullif({tot}, 0)', 6)} AS share_q1,
  {R(f'q2 / nullif({tot}, 0)', 6)} AS share_q2,
  {R('q_ret1 / nullif(q_ret, 0)', 6)} AS share_ret1
FROM w"""


register("ratio_set", oracle=_ratio_sql())(ratio_set)


# ---------------------------------------------------------------------------
# mean_impute: A11
# ---------------------------------------------------------------------------
def mean_impute(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "n_chars")
    lab = load(spark, d, "labels")
    j = docs.join(lab, "doc_id", "left")
    means = j.agg(F.avg("quality").alias("_mq"), F.avg("toxic").alias("_mt"))
    return (j.crossJoin(F.broadcast(means))   # one-row aggregate
            .select("doc_id", "n_chars",
                    F.round(F.coalesce(F.col("quality").cast("double"), F.col("_mq")), 6).alias("quality"),
                    F.round(F.coalesce(F.col("toxic").cast("double"), F.col("_mt")), 6).alias("toxic")))


register("mean_impute", oracle=f"""
WITH j AS (SELECT d.doc_id, d.n_chars, l.quality, l.toxic
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
m AS (SELECT avg(quality) AS mq, avg(toxic) AS mt FROM j)
SELECT doc_id, n_chars,
  {R('coalesce(CAST(quality AS DOUBLE), mq)', 6)} AS quality,
  {R('coalesce(CAST(toxic AS DOUBLE), mt)', 6)} AS toxic
FROM j CROSS JOIN m
""")(mean_impute)


# ---------------------------------------------------------------------------
# null_safe_cap: X9
# ---------------------------------------------------------------------------
def null_safe_cap(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = load(spark, d, "customer").select("c_custkey", "c_acctbal")
    j = join_filtered(o, c, o.o_custkey == c.c_custkey, F.col("c_acctbal") > 0, "left")
    return j.select("o_orderkey",
                    X.null_safe_cap("c_acctbal", 5000.0).alias("acct_capped"),
                    X.null_safe_cap("o_totalprice", 300000.0).alias("price_capped"))


register("null_safe_cap", oracle="""
SELECT o.o_orderkey,
  CASE WHEN c.c_acctbal > 5000.0 THEN 5000.0 ELSE c.c_acctbal END AS acct_capped,
  CASE WHEN o.o_totalprice > 300000.0 THEN 300000.0 ELSE o.o_totalprice END AS price_capped
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey AND c.c_acctbal > 0
""")(null_safe_cap)


# ---------------------------------------------------------------------------
# Opportunity score stand-in: area = customer, actual = urgent orders,
# predicted = mean of that count over the customer's market segment.
# ---------------------------------------------------------------------------
def _areas(spark, d):
    c = load(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    o = load(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    counts = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    act = (c.join(counts, "c_custkey", "left")
           .withColumn("actual", F.coalesce(F.col("n"), F.lit(0)).cast("bigint")).drop("n"))
    seg = act.groupBy("c_mktsegment").agg(F.avg("actual").alias("predicted"))
    return act.join(bounded_broadcast(seg), "c_mktsegment")


_AREAS_SQL = """
WITH act AS (
  SELECT c.c_custkey, c.c_mktsegment, c.c_nationkey,
         CAST(count(o.o_orderkey) AS BIGINT) AS actual
  FROM customer c LEFT JOIN orders o
    ON o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT'
  GROUP BY c.c_custkey, c.c_mktsegment, c.c_nationkey),
areas AS (SELECT *, avg(actual) OVER (PARTITION BY c_mktsegment) AS predicted FROM act)
"""

_GAPS_SQL = _AREAS_SQL + """,
gaps AS (SELECT c_custkey, c_nationkey,
  CASE WHEN actual = 0 THEN predicted ELSE (predicted - actual) / actual END AS gap FROM areas),
s1 AS (SELECT min(gap) AS g_min, avg(gap) AS g_mean, max(gap) AS g_max FROM gaps),
s2 AS (SELECT avg(CASE WHEN gap >= g_mean THEN gap END) AS up_mean,
              avg(CASE WHEN gap <= g_mean THEN gap END) AS low_mean FROM gaps, s1)
"""


def _seg_sql(a, b, ya, yb):
    return (f"CASE WHEN {b} - {a} = 0 THEN {yb} ELSE "
            f"gap * 0.25 / ({b} - {a}) - 0.25 / ({b} - {a}) * {a} + {ya} END")


_SCORE_CASE = f"""CASE WHEN gap IS NULL THEN NULL ELSE {R(f'''CASE
  WHEN gap BETWEEN g_min AND low_mean THEN {_seg_sql('g_min', 'low_mean', '0.0', '0.25')}
  WHEN gap BETWEEN low_mean AND g_mean THEN {_seg_sql('low_mean', 'g_mean', '0.25', '0.5')}
  WHEN gap BETWEEN g_mean AND up_mean THEN {_seg_sql('g_mean', 'up_mean', '0.5', '0.75')}
  WHEN gap BETWEEN up_mean AND g_max THEN {_seg_sql('up_mean', 'g_max', '0.75', '1.0')}
  ELSE 1.0 END''', 2)} END"""


def gap_score(spark, d):
    areas = _areas(spark, d)
    scores = scoring.gap_scores(areas, ["c_custkey"], "predicted", "actual")
    # fan out to the "cells" (orders) of the areas of one region
    region = load(spark, d, "region").where(F.col("r_name") == "EUROPE")
    nation = load(spark, d, "nation").join(bounded_broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    cust = (load(spark, d, "customer").select("c_custkey", "c_nationkey")
            .join(bounded_broadcast(nation.select("n_nationkey")), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey"))
    cells = load(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    bridge = cells.join(cust, "c_custkey")
    return scoring.fan_out(scores, bridge, "c_custkey").select("o_orderkey", "c_custkey", "score")


register("gap_score", oracle=_GAPS_SQL + f"""
SELECT o.o_orderkey, g.c_custkey, {_SCORE_CASE} AS score
FROM gaps g CROSS JOIN s1 CROSS JOIN s2
JOIN nation n ON g.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey AND r.r_name = 'EUROPE'
JOIN orders o ON o.o_custkey = g.c_custkey
""")(gap_score)


def gap_score_fixed(spark, d):
    return scoring.legacy_gap_scores(_areas(spark, d), ["c_custkey"], "predicted", "actual")


register("gap_score_fixed", oracle=_GAPS_SQL + """
SELECT c_custkey, gap, CASE WHEN gap IS NULL THEN NULL
  WHEN gap < -0.5 THEN 0.0 WHEN gap <= 0.0 THEN gap * 1.0 + 0.5
  WHEN gap <= 1.0 THEN gap * 0.3 + 0.5 WHEN gap <= 2.0 THEN gap * 0.2 + 0.6
  ELSE 1.0 END AS score
FROM gaps""")(gap_score_fixed)


def residuals(spark, d):
    areas = _areas(spark, d)
    nation = load(spark, d, "nation")
    region = load(spark, d, "region")
    geo = (nation.join(bounded_broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", (F.col("r_name") == "EUROPE").alias("na")))
    res = scoring.residual_table(areas, ["c_custkey", "c_nationkey"], "predicted", "actual")
    return (res.join(bounded_broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
            .drop("c_nationkey", "n_nationkey"))


def residual_table(spark, d):
    return residuals(spark, d).orderBy(F.desc("nb_effectif"), "c_custkey")


_RESID_SQL = _AREAS_SQL + f"""
, res AS (
SELECT a.c_custkey, a.actual AS nb_effectif,
  {R('a.predicted', 3)} AS nb_predit,
  {R('abs(a.predicted - a.actual)', 1)} AS ecart_absolu,
  {R('pow(a.predicted - a.actual, 2)', 1)} AS ecart_quadratique,
  CASE WHEN a.actual != 0 THEN {R('(a.predicted - a.actual) / a.actual', 1)}
       ELSE {R('a.predicted', 1)} END AS ecart_relatif,
  r.r_name = 'EUROPE' AS na
FROM areas a JOIN nation n ON a.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey)
"""

register("residual_table", oracle=_RESID_SQL + "SELECT * FROM res ORDER BY nb_effectif DESC, c_custkey")(residual_table)


def residual_histogram(spark, d):
    h = scoring.histogram(residuals(spark, d), "ecart_relatif", bins=20)
    return h.select("bin", "n", F.round("lower_edge", 6).alias("lower_edge"))


register("residual_histogram", oracle=_RESID_SQL + f"""
, rng AS (SELECT min(ecart_relatif) AS h_min, max(ecart_relatif) AS h_max FROM res),
b AS (SELECT CAST(least(coalesce(floor((ecart_relatif - h_min) / nullif((h_max - h_min) / 20.0, 0)), 0), 19) AS BIGINT) AS bin,
             h_min, (h_max - h_min) / 20.0 AS h_width
      FROM res CROSS JOIN rng WHERE ecart_relatif IS NOT NULL)
SELECT bin, count(*) AS n, {R('min(h_min + bin * h_width)', 6)} AS lower_edge FROM b GROUP BY bin
""")(residual_histogram)


# ---------------------------------------------------------------------------
# Classification / regression metrics: A14 A15 A16 A17 A19, folds M2
# ---------------------------------------------------------------------------
def _truth_pred(spark, d):
    lab = load(spark, d, "labels")
    return lab.select(F.col("quality").alias("label"), (F.lit(1) - F.col("toxic")).alias("prediction"))


def confusion(spark, d):
    return metrics.confusion(_truth_pred(spark, d))


register("confusion", oracle="""
SELECT count(*) FILTER (WHERE quality = 0 AND 1 - toxic = 0) AS tn,
       count(*) FILTER (WHERE quality = 0 AND 1 - toxic = 1) AS fp,
       count(*) FILTER (WHERE quality = 1 AND 1 - toxic = 0) AS fn,
       count(*) FILTER (WHERE quality = 1 AND 1 - toxic = 1) AS tp
FROM labels""")(confusion)


def class_report(spark, d):
    rep = metrics.class_report(_truth_pred(spark, d))
    return rep.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
                      "support")


_CM_SQL = """
WITH cm AS (SELECT
  CAST(count(*) FILTER (WHERE quality = 0 AND toxic = 1) AS DOUBLE) AS tn,
  CAST(count(*) FILTER (WHERE quality = 0 AND toxic = 0) AS DOUBLE) AS fp,
  CAST(count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS DOUBLE) AS fn,
  CAST(count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS DOUBLE) AS tp FROM labels),
k AS (SELECT *,
  coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
  coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
  tn + fp + fn + tp AS n, tp + fn AS s1, tn + fp AS s0 FROM cm),
f AS (SELECT *, coalesce(2.0 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1,
               coalesce(2.0 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0,
               coalesce((tp + tn) / nullif(n, 0), 0) AS acc FROM k)
"""


def _report_rows():
    def w(a, b):
        return f"coalesce(({a} * s0 + {b} * s1) / nullif(n, 0), 0)"
    rows = [("'0'", "p0", "r0", "f0", "s0"), ("'1'", "p1", "r1", "f1", "s1"),
            ("'accuracy'", "acc", "acc", "acc", "n"),
            ("'macro avg'", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "n"),
            ("'weighted avg'", w("p0", "p1"), w("r0", "r1"), w("f0", "f1"), "n")]
    return " UNION ALL ".join(
        f"SELECT {k} AS class, {R(p, 6)} AS precision, {R(r, 6)} AS recall, {R(f, 6)} AS f1, "
        f"CAST({s} AS DOUBLE) AS support FROM f" for k, p, r, f, s in rows)


register("class_report", oracle=_CM_SQL + _report_rows())(class_report)


def kappa_f1(spark, d):
    k = metrics.kappa_f1(_truth_pred(spark, d))
    return k.select(*[F.round(c, 6).alias(c) for c in ("accuracy", "kappa", "f1")])


register("kappa_f1", oracle=_CM_SQL + f"""
, kk AS (SELECT *, coalesce((tp + tn) / nullif(n, 0), 0) AS po,
   coalesce(((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / nullif(n * n, 0), 0) AS pe FROM f)
SELECT {R('po', 6)} AS accuracy, {R('coalesce((po - pe) / nullif(1.0 - pe, 0), 0)', 6)} AS kappa,
       {R('coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0)', 6)} AS f1 FROM kk
""")(kappa_f1)


def regression_errors(spark, d):
    o = load(spark, d, "orders").select("o_custkey", (F.col("o_totalprice") / 1000.0).alias("label"))
    c = load(spark, d, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    seg = j.groupBy("c_mktsegment").agg(F.avg("label").alias("prediction"))
    scored = j.join(bounded_broadcast(seg), "c_mktsegment")
    e = metrics.regression_errors(scored)
    return e.select(F.round("mse", 4).alias("mse"), F.round("mae", 4).alias("mae"))


register("regression_errors", oracle=f"""
WITH j AS (SELECT o.o_totalprice / 1000.0 AS label, c.c_mktsegment
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
s AS (SELECT *, avg(label) OVER (PARTITION BY c_mktsegment) AS prediction FROM j)
SELECT {R('avg((prediction - label) * (prediction - label))', 4)} AS mse,
       {R('avg(abs(prediction - label))', 4)} AS mae FROM s
""")(regression_errors)


def class_weights(spark, d):
    lab = load(spark, d, "labels").select(F.col("quality").alias("label"))
    w = metrics.class_weights(lab, "label")
    return w.select("label", "n_class", F.round("weight", 6).alias("weight"))


register("class_weights", oracle=f"""
SELECT quality AS label, count(*) AS n_class,
  {R('(SELECT count(*) FROM labels) / (2.0 * count(*))', 6)} AS weight
FROM labels GROUP BY quality""")(class_weights)


def fold_assignment(spark, d, k: int = 5):
    lab = load(spark, d, "labels").select("doc_id", "quality")
    r = ranking.row_number_unique(lab, ["quality"], "doc_id", "rn")
    return r.select("doc_id", "quality", ((F.col("rn") - 1) % k).alias("fold"))


register("fold_assignment", oracle="""
SELECT doc_id, quality,
  (row_number() OVER (PARTITION BY quality ORDER BY doc_id) - 1) % 5 AS fold
FROM labels""")(fold_assignment)


# ---------------------------------------------------------------------------
# Run registry: J12 A5 A6 A7 T2 T3 X14 P6
# runs = events: id = event_id, trade = event_type, metric = props.k (JSON),
# error = value.
# ---------------------------------------------------------------------------
def run_best(spark, d):
    ev = load(spark, d, "events")
    runs = ev.select(F.col("event_id").alias("id"), F.col("event_type").alias("fk_metier"),
                     "props", F.col("value").alias("err"))
    cands = runs.where(F.col("fk_metier").isin("click", "purchase", "view")).select("id")
    acc = tables.best_runs(runs, ["fk_metier"], tables.metric_of(runs, "k", "props"),
                           True, "id", cands)
    err = tables.best_runs(runs, ["fk_metier"], "err", False, "id", cands)
    return acc.join(err.select("fk_metier", F.col("best_id").alias("best_err_id"),
                               F.col("best_metric").alias("min_err")), "fk_metier")


register("run_best", oracle="""
WITH r AS (SELECT event_id AS id, event_type AS fk_metier,
                  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS m, value AS err
           FROM events WHERE event_type IN ('click', 'purchase', 'view')),
a AS (SELECT fk_metier, id AS best_id, m AS best_metric,
        row_number() OVER (PARTITION BY fk_metier ORDER BY m DESC, id DESC) AS rn
      FROM r WHERE m IS NOT NULL),
e AS (SELECT fk_metier, id AS best_err_id, err AS min_err,
        row_number() OVER (PARTITION BY fk_metier ORDER BY err ASC, id DESC) AS rn
      FROM r WHERE err IS NOT NULL)
SELECT a.fk_metier, a.best_id, a.best_metric, e.best_err_id, e.min_err
FROM a JOIN e ON a.fk_metier = e.fk_metier WHERE a.rn = 1 AND e.rn = 1
""")(run_best)


def run_latest(spark, d):
    ev = load(spark, d, "events")
    runs = ev.select(F.col("event_id").alias("id"), "user_id", "event_type")
    latest = tables.latest_runs(runs, ["user_id"])
    return (latest.join(runs.select(F.col("id").alias("latest_id"),
                                    F.col("event_type").alias("latest_type")), "latest_id"))


register("run_latest", oracle="""
SELECT l.user_id, l.latest_id, e.event_type AS latest_type
FROM (SELECT user_id, max(event_id) AS latest_id FROM events GROUP BY user_id) l
JOIN events e ON e.event_id = l.latest_id""")(run_latest)


# ---------------------------------------------------------------------------
# Table maintenance: S7 keyed update, S8 slice replace, S13 status
# ---------------------------------------------------------------------------
def keyed_update(spark, d):
    old = load(spark, d, "orders").select("o_orderkey", "o_totalprice")
    li = load(spark, d, "lineitem").where(F.col("l_returnflag") == "R")
    # several staging rows for most keys: each key updates its row once
    staging = li.select(F.col("l_orderkey").alias("o_orderkey"),
                        F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice")).alias("o_totalprice"))
    return tables.keyed_update(old, staging, ["o_orderkey"], ["o_totalprice"])


register("keyed_update", oracle="""
WITH old AS (SELECT o_orderkey, o_totalprice FROM orders),
s AS (SELECT l_orderkey, max(CASE WHEN l_linestatus = 'O' THEN l_extendedprice END) AS v
      FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)
SELECT old.o_orderkey, CASE WHEN s.l_orderkey IS NOT NULL THEN s.v ELSE old.o_totalprice END AS o_totalprice
FROM old LEFT JOIN s ON old.o_orderkey = s.l_orderkey""")(keyed_update)


def slice_replace(spark, d):
    o = load(spark, d, "orders")
    old = o.select(F.col("o_orderkey").alias("idinspire"), F.col("o_orderpriority").alias("score"),
                   F.col("o_orderstatus").alias("fk_metier"), F.col("o_totalprice").alias("valeur"))
    sl = o.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    li = load(spark, d, "lineitem").select("l_orderkey", "l_extendedprice")
    new = (li.join(sl.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
           .groupBy(F.col("l_orderkey").alias("idinspire"))
           .agg(F.round(F.sum("l_extendedprice"), 2).alias("valeur"))
           .select("idinspire", F.lit("1-URGENT").alias("score"), F.lit("F").alias("fk_metier"), "valeur"))
    return tables.replaced_view(old, new, ["score", "fk_metier"], [("1-URGENT", "F")])


def slice_clear(spark, d):
    """A slice whose replacement has no rows ends up empty."""
    o = load(spark, d, "orders")
    old = o.select(F.col("o_orderkey").alias("idinspire"), F.col("o_orderpriority").alias("score"),
                   F.col("o_orderstatus").alias("fk_metier"), F.col("o_totalprice").alias("valeur"))
    new = old.where(F.col("valeur") < 0)
    return tables.replaced_view(old, new, ["score", "fk_metier"], [("2-HIGH", "O"), ("5-LOW", "F")])


register("slice_clear", oracle="""
SELECT o_orderkey AS idinspire, o_orderpriority AS score, o_orderstatus AS fk_metier, o_totalprice AS valeur
FROM orders
WHERE NOT (o_orderpriority = '2-HIGH' AND o_orderstatus = 'O') AND NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F')
""")(slice_clear)


register("slice_replace", oracle=f"""
SELECT o_orderkey AS idinspire, o_orderpriority AS score, o_orderstatus AS fk_metier, o_totalprice AS valeur
FROM orders WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
UNION ALL
SELECT l.l_orderkey, '1-URGENT', 'F', {R('sum(l.l_extendedprice)', 2)}
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderpriority = '1-URGENT' AND o.o_orderstatus = 'F'
GROUP BY l.l_orderkey""")(slice_replace)


def status_current(spark, d):
    ev = load(spark, d, "events")
    log = ev.select(F.col("user_id").alias("id_projet"), F.col("event_type").alias("status"),
                    "ts", "event_id")
    return tables.current_status(log, ["id_projet"], "status", "ts", "event_id")


register("status_current", oracle="""
SELECT id_projet, status, n_updates FROM (
  SELECT user_id AS id_projet, event_type AS status,
    count(*) OVER (PARTITION BY user_id) AS n_updates,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")(status_current)


# ---------------------------------------------------------------------------
# A11 within groups (one project's cells at inference)
# ---------------------------------------------------------------------------
def group_mean_fill(spark, d):
    from geoscore.plans.inference import group_mean_fill as fill
    o = load(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price"))
    return fill(o, ["o_custkey"], "price").select("o_orderkey", F.round("price", 2).alias("price"))


register("group_mean_fill", oracle=f"""
WITH o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority != '5-LOW' THEN o_totalprice END AS price FROM orders),
m AS (SELECT o_custkey, avg(price) AS mean FROM o GROUP BY 1)
SELECT o_orderkey, {R('coalesce(price, mean)', 2)} AS price FROM o JOIN m USING (o_custkey)""")(group_mean_fill)
