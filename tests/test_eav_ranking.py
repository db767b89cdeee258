"""EAV widening, missing-feature filter, unpivot/rename and distributed ranks."""

import pandas as pd
from pyspark.sql import functions as F

from geoscore.operators import eav, ranking


def test_widen_completeness_and_null(spark):
    long = spark.createDataFrame(
        [(1, "a", 1.0), (1, "b", None), (2, "a", 2.0), (3, "a", 3.0), (3, "b", 4.0)],
        "k int, varexp string, valeur double")
    w = eav.widen(long, ["k"], "varexp", "valeur", ["a", "b"]).orderBy("k").collect()
    assert [(r.k, r.a, r.b) for r in w] == [(1, 1.0, None), (3, 3.0, 4.0)]


def test_widen_equals_self_joins(spark):
    long = spark.createDataFrame(
        [(k, a, float(k * 10 + i) if (k + i) % 4 else None)
         for k in range(30) for i, a in enumerate("abc") if (k * 7 + i) % 5],
        "k int, varexp string, valeur double")
    w = eav.widen(long, ["k"], "varexp", "valeur", ["a", "b", "c"])
    j = None
    for a in "abc":
        t = long.where(F.col("varexp") == a).select("k", F.col("valeur").alias(a))
        j = t if j is None else j.join(t, "k")
    assert sorted(map(tuple, w.collect())) == sorted(map(tuple, j.select("k", "a", "b", "c").collect()))


def test_latest_per_key_dedupes(spark):
    df = spark.createDataFrame([(1, "a", 1.0, 1), (1, "a", 2.0, 2)], "k int, varexp string, valeur double, t int")
    out = eav.latest_per_key(df, ["k", "varexp"], ["valeur"], ["t"]).collect()
    assert [(r.k, r.valeur) for r in out] == [(1, 2.0)]


def test_missing_entities(spark):
    cands = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    store = spark.createDataFrame([(2, "x", None), (3, "x", 5.0), (1, "y", 1.0)],
                                  "k int, varexp string, valeur double")
    out = sorted(r.k for r in eav.missing_entities(cands, store, ["k"], "varexp", "x", "valeur").collect())
    assert out == [1, 2]


def test_unpivot_and_rename(spark):
    df = spark.createDataFrame([(1, 2, 3.5)], "k int, a int, b double")
    long = eav.unpivot(df, ["k"], ["a", "b"])
    d = spark.createDataFrame([("a", "alpha")], "feature string, varexp string")
    out = sorted((r.varexp, r.valeur) for r in eav.rename_values(long, "varexp", d).collect())
    assert out == [("alpha", 2.0), ("b", 3.5)]


def test_percent_rank_ties_and_null(spark):
    df = spark.createDataFrame([(1, "g", 1.0), (2, "g", 2.0), (3, "g", 2.0), (4, "g", None)],
                               "id int, g string, v double")
    out = {r.id: r.pct for r in ranking.percent_rank_avg(df, ["g"], "v", "pct").collect()}
    assert out[1] == 1 / 3 and out[2] == 2.5 / 3 and out[3] == 2.5 / 3 and out[4] is None


def test_percent_rank_matches_pandas_on_skewed_group(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    n = 3000
    pdf = pd.DataFrame({"id": np.arange(n),
                        "g": np.where(rng.random(n) < 0.7, "hot", rng.choice(["a", "b", "c"], n)),
                        "v": rng.integers(0, 50, n).astype(float)})
    pdf.loc[::97, "v"] = np.nan
    df = spark.createDataFrame(pdf)
    got = ranking.percent_rank_avg(df, ["g"], "v", "pct").toPandas().set_index("id").sort_index()
    exp = pdf.groupby("g")["v"].rank(pct=True)
    assert np.allclose(got["pct"].to_numpy(dtype=float), exp.to_numpy(dtype=float), equal_nan=True)


def test_row_number_unique_matches_window(spark):
    from pyspark.sql import Window
    df = spark.range(2000).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("g"),
                                  F.xxhash64("id").alias("h"))
    got = ranking.row_number_unique(df, ["g"], "h", "rn").select("id", "rn")
    exp = df.select("id", F.row_number().over(Window.partitionBy("g").orderBy("h")).alias("rn"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_rank_unchanged_under_repartitioning(spark):
    df = spark.range(500).select((F.col("id") % 7).cast("double").alias("v"), F.lit("g").alias("g"), "id")
    a = ranking.percent_rank_avg(df.repartition(1), ["g"], "v", "p").orderBy("id").collect()
    b = ranking.percent_rank_avg(df.repartition(13), ["g"], "v", "p").orderBy("id").collect()
    assert [r.p for r in a] == [r.p for r in b]


def test_widen_latest_in_one_aggregate(spark):
    long = spark.createDataFrame(
        [(1, "a", 1.0, 1), (1, "a", None, 2), (1, "b", 5.0, 1), (2, "a", 3.0, 1), (2, "a", 4.0, 3),
         (2, "b", 6.0, 2), (2, "b", 7.0, 1), (3, "a", 1.0, 1)],
        "k int, varexp string, valeur double, t int")
    fused = eav.widen(long, ["k"], "varexp", "valeur", ["a", "b"], latest_by=["t"])
    two = eav.widen(eav.latest_per_key(long, ["k", "varexp"], ["valeur"], ["t"]), ["k"], "varexp",
                    "valeur", ["a", "b"])
    assert sorted(map(tuple, fused.collect())) == sorted(map(tuple, two.collect())) == [(1, None, 5.0), (2, 4.0, 6.0)]


def test_numbered_is_one_shuffle_and_gapless(spark):
    rows = [(i, (i * 37) % 11) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(7)
    got = ranking.numbered(df, [F.col("v").desc(), F.col("k")], "n")
    want = {k: n + 1 for n, (k, v) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    assert {r["k"]: r["n"] for r in got.collect()} == want
    assert ranking.numbered(df.where("k < 0"), [F.col("k")]).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_values_use_hash_aggregates(spark):
    from geoscore.plans.catalog import QUERIES
    from geoscore.plans import load_all
    load_all()
    for name in ("eav_wide_complete", "eav_group_mean", "run_best", "status_current"):
        plan = _plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert "HashAggregate" in plan and "SortAggregate" not in plan, name


def test_packed_order_is_the_struct_order(spark):
    import datetime as dt
    import itertools
    from geoscore.functions.ordering import packed_order
    times = [None, dt.datetime(1, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(2024, 2, 29, 1, 2, 3, 4), dt.datetime(9999, 12, 31)]
    ids = [None, -2 ** 63, -1, 0, 5, 2 ** 63 - 1]
    small = [None, -2 ** 31, 0, 2 ** 31 - 1]
    days = [None, dt.date(1, 1, 1), dt.date(1970, 1, 1), dt.date(9999, 12, 31)]
    for (values, kinds) in (((times, ids), "timestamp,bigint"), ((times, ids), "timestamp_ntz,bigint"), ((days, small, [None, True, False]), "date,int,boolean"), ((ids,), "bigint")):
        names = [f"c{i}" for i in range(len(values))]
        schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds.split(",")))
        df = spark.createDataFrame(list(itertools.product(*values)), schema)
        order = packed_order(df, names)
        assert "struct" not in df.select(order.alias("o")).schema["o"].dataType.simpleString()
        rows = df.select(order.alias("o"), F.struct(*names).alias("s")).withColumn("t", F.to_json("s", {"ignoreNullFields": "false"}))
        by_packed = [r.t for r in rows.orderBy("o").select("t").collect()]
        assert by_packed == [r.t for r in rows.orderBy("s").select("t").collect()]
        assert rows.select("o").distinct().count() == len(by_packed) and rows.where("o IS NULL").count() == 0
    floats = spark.createDataFrame([(1.0, 1)], "a double, b int")
    assert floats.select(packed_order(floats, ["a", "b"]).alias("o")).schema["o"].dataType.typeName() == "struct"


def test_status_of_hot_project_and_nulls(spark):
    from geoscore.sources.tables import current_status
    rows = [(1, f"s{i % 3}", i // 2, i) for i in range(3000)] + [(2, None, 5, 1), (2, "x", 4, 9), (None, "y", 1, 1)]
    log = spark.createDataFrame(rows, "p int, status string, ts long, id long").withColumn("ts", F.timestamp_seconds("ts"))
    got = {r.p: (r.status, r.n_updates) for r in current_status(log, ["p"], "status", "ts", "id").collect()}
    assert got == {1: ("s2", 3000), 2: (None, 2), None: ("y", 1)}


def test_row_numbers_take_one_shuffle_of_the_rows(spark):
    rows = [(i % 3 if i % 7 else None, (i * 7919) % 100003, i) for i in range(3000)] + [(1, None, -1), (None, None, -2)]
    df = spark.createDataFrame(rows, "g int, v int, k int").repartition(6)
    got = ranking.row_number_unique(df, ["g"], "v", "n")
    assert got.columns == ["g", "v", "k", "n"]
    assert _plan(got).count("Exchange rangepartitioning") == 0  # it is written by then
    want = {}
    for g in (0, 1, 2, None):
        mine = sorted((v, k) for h, v, k in rows if h == g and v is not None)
        want.update({k: n + 1 for n, (_, k) in enumerate(mine)})
    want.update({-1: None, -2: None})
    assert {r.k: r.n for r in got.collect()} == want
