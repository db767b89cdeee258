"""Micro-fixtures of FIXTURES.md section 4 for the column expressions."""

import pytest

from pyspark.sql import functions as F

from geoscore.functions import columns as X


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("i").collect()]


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(1, 5.0, 0.0), (2, 5.0, None), (3, None, 2.0), (4, 2.0, 3.0)],
                               "i int, n double, d double")
    out = rows(df.select("i", X.guarded_ratio("n", "d", 2).alias("r")), "r")
    assert out == [(0.0,), (0.0,), (None,), (0.67,)]


def test_safe_ratio_zero_total_is_null(spark):
    df = spark.createDataFrame([(1, 3.0, 0.0), (2, 3.0, 4.0)], "i int, n double, d double")
    assert rows(df.select("i", X.safe_ratio("n", "d").alias("r")), "r") == [(None,), (0.75,)]


def test_weighted_band_mean(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0, 0.0), (2, 0.0, 0.0, 0.0)], "i int, a double, b double, c double")
    out = rows(df.select("i", X.weighted_band_mean(["a", "b", "c"], [2, 4.5, 8]).alias("m")), "m")
    assert out == [(3.25,), (None,)]


def test_cap_keeps_null(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 3e9)], "i int, x double")
    out = rows(df.select("i", X.null_safe_cap("x").alias("c")), "c")
    assert out == [(None,), (5.0,), (float(X.FEATURE_CAP),)]


def test_zone_recode(spark):
    df = spark.createDataFrame([(1, "C"), (2, "B"), (3, "I"), (4, "R"), (5, "X"), (6, None)], "i int, z string")
    out = rows(df.select("i", X.ordinal_recode("z").alias("c")), "c")
    assert out == [(4,), (3,), (2,), (1,), (None,), (None,)]


def test_milieu_flags(spark):
    df = spark.createDataFrame([(1, "URBAIN"), (2, "RURAL"), (3, None), (4, "autre")], "i int, m string")
    out = rows(df.select("i", X.milieu_flag("m").alias("a"), X.milieu_flag_strict("m").alias("b")), "a", "b")
    assert out == [(1, 1), (0, 0), (0, None), (0, None)]


def test_relative_gap(spark):
    df = spark.createDataFrame([(1, 3.0, 0), (2, 5.0, 4)], "i int, p double, a int")
    assert rows(df.select("i", X.relative_gap("p", "a").alias("g")), "g") == [(3.0,), (0.25,)]


def test_piecewise_score(spark):
    # gaps -1, 0, 1, 4: mean 1, lower mean 0, upper mean 2.5
    df = spark.createDataFrame([(1, -1.0), (2, 0.0), (3, 1.0), (4, 4.0)], "i int, g double")
    st = df.agg(F.min("g").alias("lo"), F.avg("g").alias("mu"), F.max("g").alias("hi"))
    st = st.crossJoin(df.crossJoin(st.select(F.col("mu").alias("m2"))).agg(
        F.avg(F.when(F.col("g") >= F.col("m2"), F.col("g"))).alias("up"),
        F.avg(F.when(F.col("g") <= F.col("m2"), F.col("g"))).alias("low")))
    out = df.crossJoin(st).select("i", X.piecewise_score("g", "lo", "low", "mu", "up", "hi").alias("s"))
    assert rows(out, "s") == [(0.0,), (0.25,), (0.5,), (1.0,)]


def test_piecewise_score_degenerate(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "i int, g double")
    c = F.lit(2.0)
    out = df.select("i", X.piecewise_score("g", c, c, c, c, c).alias("s"))
    assert rows(out, "s") == [(0.25,), (None,)]


def test_legacy_score_continuous(spark):
    df = spark.createDataFrame([(1, -1.0), (2, -0.5), (3, 0.0), (4, 1.0), (5, 2.0), (6, 3.0)], "i int, g double")
    out = [r[0] for r in rows(df.select("i", X.legacy_score("g").alias("s")), "s")]
    assert out == pytest.approx([0.0, 0.0, 0.5, 0.8, 1.0, 1.0])


def test_inhabitants_per_site(spark):
    df = spark.createDataFrame([(1, 100.0, 3)], "i int, d double, n int")
    v = df.select(X.inhabitants_per_site("d", "n").alias("v")).first()[0]
    assert abs(v - 100.0 / 4 * 3.14 * 25 / 4) < 1e-9


def test_round_half_away_on_decimal_form(spark):
    df = spark.createDataFrame([(1, 1.005), (2, -1.005), (3, 2.675)], "i int, x double")
    assert rows(df.select("i", X.round_n("x", 2).alias("r")), "r") == [(1.01,), (-1.01,), (2.68,)]
