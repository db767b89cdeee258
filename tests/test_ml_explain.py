"""Fold invariants, out-of-fold coverage and attribution additivity."""

import numpy as np
from pyspark.sql import functions as F

from geoscore.operators import boosting, explain, metrics, ml
from geoscore.plans import learning as L

from conftest import SF_CHECK


def test_stratified_folds_balanced(spark):
    df = spark.range(1000).select("id", (F.col("id") % 4 == 0).cast("double").alias("label"))
    f = ml.stratified_folds(df, "id", "label", 5)
    counts = f.groupBy("label", "fold").count().collect()
    for lab in (0.0, 1.0):
        c = [r["count"] for r in counts if r.label == lab]
        assert len(c) == 5 and max(c) - min(c) <= 1
    assert f.select("id").distinct().count() == 1000


def test_hash_split_reproducible(spark):
    df = spark.range(2000)
    a, b = ml.hash_split(df, "id")
    a2, _ = ml.hash_split(df.repartition(7), "id")
    assert a.count() + b.count() == 2000
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in a2.collect())


def test_top_features_ties_widen():
    imp = [("a", 0.4), ("b", 0.2), ("c", 0.2), ("d", 0.1)]
    assert ml.top_features(imp, 2) == ["a", "b", "c"]


def test_spark_depths_clamped():
    assert ml.spark_depths(ml.SURVIVAL_DEPTHS) == [2, 5, 10, 20, 30]


def test_out_of_fold_each_key_once(spark):
    data = metrics.with_class_weights(L.labelled_docs(spark, SF_CHECK), "label")
    oof = ml.out_of_fold(data, L.DOC_FEATURES, ml.rf_classifier(5, "label", "weight", maxDepth=4),
                         "doc_id", "label", 4)
    assert oof.count() == data.count() == oof.select("doc_id").distinct().count()


def test_attribution_additivity(spark):
    data = metrics.with_class_weights(L.labelled_docs(spark, SF_CHECK), "label")
    model = ml.fit(data, L.DOC_FEATURES, ml.rf_classifier(6, "label", "weight", maxDepth=6))
    sv = explain.shap_values(model.stages[-1], data, "doc_id", L.DOC_FEATURES)
    agg = sv.groupBy("doc_id").agg(F.first("base").alias("b"), F.first("prediction").alias("p"),
                                   F.sum("phi").alias("s"))
    sc = ml.score(model, data, "p1").select("doc_id", "p1")
    j = agg.join(sc, "doc_id").toPandas()
    assert np.allclose(j.b + j.s, j.p, atol=1e-9) and np.allclose(j.p, j.p1, atol=1e-9)


def test_attribution_chunks_equal_single_pass(spark, monkeypatch):
    data = metrics.with_class_weights(L.labelled_docs(spark, SF_CHECK), "label")
    model = ml.fit(data, L.DOC_FEATURES[:5], ml.rf_classifier(4, "label", "weight", maxDepth=4))
    one = {(r.doc_id, r.feature): r.phi for r in
           explain.shap_values(model.stages[-1], data, "doc_id", L.DOC_FEATURES[:5]).collect()}
    monkeypatch.setattr(explain, "LEAVES_PER_FILE", 5)
    monkeypatch.setattr(explain, "ROWS_PER_BLOCK", 30)
    many = {(r.doc_id, r.feature): r.phi for r in
            explain.shap_values(model.stages[-1], data, "doc_id", L.DOC_FEATURES[:5]).collect()}
    assert one.keys() == many.keys()
    assert max(abs(one[k] - many[k]) for k in one) < 1e-12


def test_regressor_attribution_additivity(spark):
    data = L.customer_counts(spark, SF_CHECK)
    model = ml.fit(data, L.CUST_FEATURES, ml.rf_regressor(5, "label", maxDepth=4))
    sv = explain.shap_values(model.stages[-1], data, "c_custkey", L.CUST_FEATURES, classifier=False)
    agg = sv.groupBy("c_custkey").agg(F.first("base").alias("b"), F.first("prediction").alias("p"),
                                      F.sum("phi").alias("s"))
    sc = ml.score(model, data, "yhat").select("c_custkey", "yhat")
    j = agg.join(sc, "c_custkey").toPandas()
    assert np.allclose(j.b + j.s, j.p, atol=1e-7) and np.allclose(j.p, j.yhat, atol=1e-7)


def test_attribution_equals_brute_force_shapley(spark):
    import itertools
    import math
    data = metrics.with_class_weights(L.labelled_docs(spark, SF_CHECK), "label")
    feats = L.DOC_FEATURES[:4]
    model = ml.fit(data, feats, ml.rf_classifier(3, "label", "weight", maxDepth=4))
    sv = explain.shap_values(model.stages[-1], data, "doc_id", feats).toPandas()
    nodes = explain._tree_nodes(spark, model.stages[-1])
    trees = {tid: t.set_index("id") for tid, t in nodes.groupby("treeID")}

    def expect(x, known):
        # path-dependent conditional expectation E[f | x_known], averaged over trees
        total = 0.0
        for t in trees.values():
            kids = set(t.leftChild) | set(t.rightChild)
            root = [i for i in t.index if i not in kids][0]

            def rec(n):
                r = t.loc[n]
                if r.leftChild < 0:
                    return r.impurityStats[1] / sum(r.impurityStats)
                if int(r.feature) in known:
                    return rec(r.leftChild if x[int(r.feature)] <= r.thr[0] else r.rightChild)
                cl = sum(t.loc[r.leftChild].impurityStats)
                cr = sum(t.loc[r.rightChild].impurityStats)
                return (cl * rec(r.leftChild) + cr * rec(r.rightChild)) / (cl + cr)
            total += rec(root)
        return total / len(trees)

    m = len(feats)
    rows = data.select("doc_id", *feats).orderBy("doc_id").limit(4).toPandas()
    for _, row in rows.iterrows():
        x = row[feats].to_numpy(float)
        for i in range(m):
            others = [j for j in range(m) if j != i]
            phi = sum(math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
                      * (expect(x, set(s) | {i}) - expect(x, set(s)))
                      for k in range(m) for s in itertools.combinations(others, k))
            got = sv[(sv.doc_id == row.doc_id) & (sv.feature == feats[i])].phi.iloc[0]
            assert abs(got - phi) < 1e-12


def test_registered_queries_have_the_library_trees_and_grids(spark, monkeypatch):
    seen = []

    class Done(Exception):
        pass

    def stop(*args, **kw):
        seen.append(args)
        raise Done

    def caught(query):
        seen.clear()
        try:
            query(spark, SF_CHECK)
        except Done:
            return seen[0]

    for name in ("tune", "fit", "out_of_fold", "stack", "fold_metrics"):
        monkeypatch.setattr(ml, name, stop)
    trees = {"rf_tune": 200, "rf_regress_tune": 200, "feature_importances": 200, "oof_predictions": 200,
             "regression_oof": 200, "stacked_score": ml.SURVIVAL_TREES_5Y, "tree_attribution": 200}
    for query, n in trees.items():
        assert caught(getattr(L, query))[2].getNumTrees() == n, query
    for query, grid in ((L.gbt_tune, ml.GBT_CLASSIFIER_GRID), (L.gbt_regress_tune, ml.GBT_REGRESSOR_GRID)):
        # one fit for each step and depth, with the most iterations; shorter ones are its first trees
        fits = caught(query)[2]
        assert {(f["stepSize"], f["maxDepth"], f["maxIter"]) for f in fits} == {
            (s, m, 200) for s in grid["stepSize"] for m in grid["maxDepth"]} and grid["maxIter"] == [100, 200]
    # the attribution and the regression's folds go by the tuned depth
    assert caught(L.tree_attribution)[3]["maxDepth"] == ml.spark_depths(ml.SURVIVAL_DEPTHS)
    assert caught(L.regression_oof)[3]["maxDepth"] == ml.OPPORTUNITY_DEPTHS


def test_attribution_has_no_node_limit(spark, monkeypatch):
    data = metrics.with_class_weights(L.labelled_docs(spark, SF_CHECK), "label")
    feats = L.DOC_FEATURES[:4]
    model = ml.fit(data, feats, ml.rf_classifier(3, "label", "weight", maxDepth=5))
    monkeypatch.setattr(explain, "MAX_NODES", 1, raising=False)
    monkeypatch.setattr(explain, "LEAVES_PER_FILE", 11)  # cuts trees too
    monkeypatch.setattr(explain, "_tree_nodes", lambda *args: 1 / 0)  # the forest doesn't go to the driver
    sv = explain.shap_values(model.stages[-1], data, "doc_id", feats)
    agg = sv.groupBy("doc_id").agg((F.first("base") + F.sum("phi") - F.first("prediction")).alias("off")).collect()
    assert len(agg) == data.count() and max(abs(r["off"]) for r in agg) < 1e-9


def test_staged_boosting_equals_separate_fits(spark):
    """The first trees of a long boosted model are the short model, so the
    staged grid is the grid of separate fits."""
    data = L.labelled_docs(spark, SF_CHECK)
    feats = L.DOC_FEATURES[:4]
    grid = {"maxIter": [2, 5], "stepSize": [0.1], "maxDepth": [2]}
    res = ml.tune_gbt(data, feats, "doc_id", "label", True, grid, folds=2)
    d = ml.stratified_folds(metrics.with_class_weights(data, "label", "weight"), "doc_id", "label", 2)
    vectors = ml.prepared(d, feats, ["label", "weight", "fold"])
    for r in res.grid.collect():
        scores = []
        for fold in (0, 1):
            est = ml.GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", seed=ml.SEED,
                                   maxIter=r.n_estimators, stepSize=0.1, maxDepth=2)
            held = vectors.where(F.col("fold") == fold)
            scores.append(ml.positive_f1().evaluate(est.fit(vectors.where(F.col("fold") != fold)).transform(held)))
        assert abs(r.f1 - np.mean(scores)) < 1e-12, r
    assert len(res.model.stages[-1].trees) == res.best_params["maxIter"] and res.grid.where("best").count() == 1
    reg = ml.tune_gbt(L.customer_counts(spark, SF_CHECK), L.CUST_FEATURES, "c_custkey", "label", False, dict(grid, maxDepth=[2, 3]), folds=2)
    assert reg.grid.count() == 4 and reg.grid.where("best").first().mse == min(r.mse for r in reg.grid.collect())
    long = reg.model.stages[-1]
    short = ml.first_trees(long, 1)
    rows = reg.model.stages[0].transform(L.customer_counts(spark, SF_CHECK))
    want = long.trees[0].transform(rows).select("c_custkey", "prediction")
    assert {tuple(r) for r in short.transform(rows).select("c_custkey", "prediction").collect()} == {tuple(r) for r in want.collect()}


def test_boosted_grid_grows_together(spark, monkeypatch):
    """Rows of one and of several partitions give the metrics of Spark's own fits, without a fit for each model."""
    rows = spark.range(400).select(F.col("id"), (F.hash("id") % 97).cast("double").alias("a"), (F.hash("id", F.lit(1)) % 13).cast("double").alias("b"),
                                   F.lit(1.0).alias("c"), (F.col("id") % 3).cast("int").alias("fold"))
    rows = rows.withColumn("y", F.col("a") + 5 * F.col("b") + F.hash("id", F.lit(3)) % 60).withColumn("weight", 1 + F.col("id") % 4 / 4)
    lengths, fits = [2, 5], [{"stepSize": 0.1, "maxDepth": 3, "maxIter": 5}, {"stepSize": 0.5, "maxDepth": 2, "maxIter": 5}]
    for classifier in (True, False):
        label = (F.col("y") > 0).cast("double") if classifier else F.col("y").cast("double")
        cls, ev = (ml.GBTClassifier, ml.positive_f1()) if classifier else (ml.GBTRegressor, ml.mse())
        est = cls(labelCol="label", featuresCol="features", weightCol="weight", seed=ml.SEED)
        for parts in (1, 3):
            data = ml.materialize(ml.assembler(["a", "b", "c"]).transform(rows.withColumn("label", label).repartition(parts, "id")))
            want = {}
            for f in fits:
                for k in range(3):
                    whole = est.copy({est.getParam(n): v for n, v in f.items()}).fit(data.where(F.col("fold") != k))
                    for n in lengths:
                        m = ev.evaluate(ml.first_trees(whole, n).transform(data.where(F.col("fold") == k)))
                        want.setdefault(tuple(sorted(dict(f, maxIter=n).items())), []).append(m)
            with monkeypatch.context() as m:
                m.setattr(cls, "_fit", lambda *args: 1 / 0)  # before: a fit for each step, depth and fold
                got = ml.fold_metrics(data, est, fits, ev, "fold", 3, lengths=lengths)
            assert got.keys() == want.keys()
            for s in want:
                assert abs(got[s] - np.mean(want[s])) < 1e-9 * max(1, abs(got[s])), (classifier, parts, s)


def test_boosted_grid_deals_out_a_large_partition(spark):
    """A task holds no more than partition_bytes of a table of one large partition."""
    rows = spark.range(600).select("id", (F.hash("id") % 97).cast("double").alias("a"), (F.col("id") % 3).cast("int").alias("fold"))
    rows = rows.withColumn("label", F.col("a") * 2 + F.hash("id", F.lit(3)) % 7).coalesce(1)
    data = ml.materialize(ml.assembler(["a"]).transform(rows))
    assert data.rdd.getNumPartitions() == 1
    args = (data, False, [{"stepSize": 0.1, "maxDepth": 2, "maxIter": 3}], [3], "fold", 3, "label", None)
    whole, jobs = boosting.staged_scores(*args), []
    for size in (4 << 20, 4000):  # bytes: 1 partition and 4
        spark.sparkContext.setJobGroup(f"boosted {size}", "")
        got = boosting.staged_scores(*args, partition_bytes=size)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"boosted {size}")))
        for m in whole:
            assert got[m]["rows"] == 200 and abs(got[m]["squares"] / whole[m]["squares"] - 1) < 1e-9
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] >= jobs[0] + 5  # a job a level: 3 trees of 2


def test_thresholds_of_boosted_trees():
    assert list(boosting.thresholds(np.array([3.0, 1.0, 3.0, 2.0]), np.ones(4), 32)) == [1.5, 2.5]
    assert not len(boosting.thresholds(np.full(5, 2.0), np.ones(5), 32))
    cuts = boosting.thresholds(np.arange(1000.0), np.ones(1000), 4)
    assert list(cuts) == [249.5, 499.5, 749.5]


def test_random_search_scores_draws_and_their_neighbourhood(spark):
    data = L.labelled_docs(spark, SF_CHECK)
    space = {"numTrees": [2, 3], "maxDepth": [2, 4], "bootstrap": [True, False]}
    res = ml.random_search(data, L.DOC_FEATURES[:4], "doc_id", space=space, draws=3, steps={"numTrees": (1, range(-1, 2), 1)},
                           values={"maxDepth": [2, 3]}, folds=2, local_folds=2)
    rows = res.grid.collect()
    drawn = [r for r in rows if r.phase == "random"]
    local = [r for r in rows if r.phase == "local"]
    assert {r.params for r in drawn} == {",".join(f"{k}={s[k]}" for k in sorted(s)) for s in ml.random_settings(space, 3)}
    best = next(r for r in drawn if r.best)
    assert best.f1 == max(r.f1 for r in drawn)
    n = best.n_estimators
    assert sorted({r.n_estimators for r in local}) == [n - 1, n, n + 1] and {r.max_depth for r in local} == {2, 3}
    assert res.model.stages[-1].getNumTrees == res.best_params["numTrees"]
    assert ml.local_grid({"maxDepth": 29, "numTrees": 1, "x": 3}, ml.LOCAL_STEPS, {}) == {"maxDepth": [9, 19, 29, 30], "numTrees": [1, 101, 201], "x": [3]}


def test_depths_of_a_forest_share_one_fit(spark, monkeypatch):
    """One fit for all depths of a fold gives the metrics, and the model, of a fit for each depth."""
    rows = spark.range(300).select(F.col("id"), (F.hash("id") % 97).cast("double").alias("a"), (F.hash("id", F.lit(1)) % 13).cast("double").alias("b"),
                                   (F.hash("id", F.lit(2)) % 7).cast("double").alias("c"))
    rows = rows.withColumn("label", (F.col("a") + 5 * F.col("b") + F.hash("id", F.lit(3)) % 60 > 0).cast("double"))
    rows = ml.materialize(rows.withColumn("weight", F.lit(1.0)).withColumn("fold", (F.col("id") % 3).cast("int")).coalesce(1))
    feats, depths = ["a", "b", "c"], [2, 4, 9]
    fits = []
    for cls in (ml.RandomForestClassifier, ml.RandomForestRegressor):
        monkeypatch.setattr(cls, "_fit", lambda self, data, whole=cls._fit: fits.append(self.getMaxDepth()) or whole(self, data))
    for est, ev in ((ml.rf_classifier(7), ml.positive_f1()), (ml.rf_regressor(7), ml.mse())):
        fits.clear()
        got = ml.tune(rows, feats, est, {"maxDepth": depths}, ev, folds=3)
        assert fits == [9] * 4  # before: a fit for each depth and fold
        data = ml.prepared(rows, feats, ["label", "weight", "fold"])
        for r in got.grid.collect():
            one = est.copy({est.maxDepth: r.max_depth})
            want = [ev.evaluate(one.fit(data.where(F.col("fold") != f)).transform(data.where(F.col("fold") == f))) for f in range(3)]
            assert abs(r["metric"] - np.mean(want)) < 1e-9, r
        best = got.best_params["maxDepth"]
        model = got.model.stages[-1]
        assert model.getOrDefault("maxDepth") == best
        for d in depths:
            short, own = ml.first_levels(est.copy({est.maxDepth: 9}).fit(data), d), est.copy({est.maxDepth: d}).fit(data)
            assert short.toDebugString.split("\n", 1)[1] == own.toDebugString.split("\n", 1)[1]
            assert d != best or model.toDebugString.split("\n", 1)[1] == own.toDebugString.split("\n", 1)[1]


def test_training_rows_are_shared_out(spark):
    rows = ml.materialize(spark.range(100_000).repartition(8).select("id", F.col("id").cast("double").alias("a"), F.lit(0.0).alias("label")))
    assert ml.prepared(rows, ["a"] * 6, ["label", "id"]).rdd.getNumPartitions() == 2  # before: 1 up to 32 MB


def test_attribution_rows_go_to_every_core(spark):
    rows = ml.materialize(spark.range(200).select("id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5 > 1).cast("double").alias("label")).coalesce(1))
    model = ml.fit(rows, ["a"], ml.rf_regressor(3, "label", maxDepth=3))
    sv = explain.shap_values(model.stages[-1], rows, "id", ["a"], classifier=False)
    assert sv.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and sv.count() == 200  # before: 1 partition


def test_leaf_attribution_equals_the_sum_over_subsets():
    """Empty branches (z = 0), padded slots, NaN, and more rows and leaves than one block."""
    from itertools import combinations
    from math import factorial
    r = np.random.default_rng(3)
    n, leaves, depth = explain.BLOCK_ROWS + 3, explain.BLOCK_LEAVES + 2, 4
    d = r.integers(0, depth + 1, leaves)
    real = np.arange(depth)[None] < d[:, None]
    feat = np.where(real, np.array([r.permutation(depth) for _ in range(leaves)]), -1)
    lo = np.where(real, r.normal(-1, 1, (leaves, depth)), -np.inf)
    hi = np.where(real, lo + 2, np.inf)
    z = np.where(real, r.random((leaves, depth)), 1.0)
    z[0] = np.where(real[0], 0.0, 1.0)
    v = r.random(leaves)
    x = r.normal(size=(n, depth))
    x[-1, 2] = np.nan
    phi, pred = explain.leaf_shap(x, {"feat": feat, "lo": lo, "hi": hi, "z": z, "v": v})
    for row in (0, n - 1):
        known = np.where(np.isnan(x[row]), np.inf, x[row])
        want, whole = np.zeros(depth), 0.0
        for k in range(leaves):
            on = {int(f): (float(lo[k, j] < known[f] <= hi[k, j]), z[k, j]) for j, f in enumerate(feat[k]) if f >= 0}
            whole += v[k] * np.prod([o for o, _ in on.values()])
            for i, (o, zi) in on.items():
                rest = [j for j in on if j != i]
                for size in range(len(rest) + 1):
                    for s in combinations(rest, size):
                        weight = factorial(size) * factorial(len(rest) - size) / factorial(len(on))
                        want[i] += v[k] * weight * (o - zi) * np.prod([on[j][j not in s] for j in rest])
        assert np.allclose(phi[row], want, atol=1e-10) and abs(pred[row] - whole) < 1e-10


def _some_leaves(rng, n, features, most):
    feat, lo, hi, z = np.full((n, most), -1), np.full((n, most), -np.inf), np.full((n, most), np.inf), np.ones((n, most))
    cuts = np.sort(rng.normal(size=(features, 9)), axis=1)
    for i in range(n):
        for j, f in enumerate(rng.choice(features, rng.integers(0, most + 1), replace=False)):
            a, b = sorted(rng.choice(11, 2, replace=False))
            feat[i, j], z[i, j] = f, rng.random()
            lo[i, j], hi[i, j] = -np.inf if a == 0 else cuts[f, a - 1], np.inf if b == 10 else cuts[f, b - 1]
    return {"feat": feat, "lo": lo, "hi": hi, "z": z, "v": rng.random(n)}, cuts


def test_leaf_patterns_are_worked_out_once_for_many_rows(monkeypatch):
    # Every row worked out its own sums for every leaf
    rng = np.random.default_rng(5)
    paths, cuts = _some_leaves(rng, 60, 4, 4)
    x = rng.normal(size=(3000, 4))
    x[:4] = [[np.nan] * 4, [np.inf] * 4, [-np.inf] * 4, cuts[:, 3]]  # thresholds themselves go left
    worked, terms = [], explain._terms

    def counted(o, z, v):
        got = terms(o, z, v)
        worked.extend(term.size for term in got)
        return got

    monkeypatch.setattr(explain, "_terms", counted)
    phi, pred = explain.leaf_shap(x, paths)
    assert sum(worked) <= 60 * 4 * 2 ** 4
    single = [explain.leaf_shap(x[i:i + 1], paths) for i in range(40)]  # fewer rows than patterns
    np.testing.assert_allclose(phi[:40], np.concatenate([s[0] for s in single]), atol=1e-12)
    np.testing.assert_allclose(pred[:40], np.concatenate([s[1] for s in single]), atol=1e-12)
    goes = np.where(np.isnan(x), np.inf, x)
    for i in range(4):
        on = [all(f < 0 or (goes[i, f] > a or a == -np.inf) and goes[i, f] <= b for f, a, b in zip(*(paths[k][leaf] for k in ("feat", "lo", "hi"))))
              for leaf in range(60)]
        assert abs(pred[i] - paths["v"][on].sum()) < 1e-12


def test_boosted_models_of_cells_equal_sparks(spark):
    """Rows of the same bins are merged; models whose cells are in one and in several blocks, and the
    models on all rows, are those of Spark's own fits."""
    rows = spark.range(500).select(F.col("id"), (F.hash("id") % 11).cast("double").alias("a"), (F.hash("id", F.lit(1)) % 53).cast("double").alias("b"),
                                   (F.col("id") % 3).cast("int").alias("fold"), (1 + F.col("id") % 4 / 4).alias("weight"))
    rows = rows.withColumn("y", F.col("a") * 3 + F.col("b") + F.hash("id", F.lit(3)) % 40)
    fits = [{"stepSize": 0.1, "maxDepth": 3, "maxIter": 3}, {"stepSize": 0.5, "maxDepth": 2, "maxIter": 3}]
    for cls, label in ((ml.GBTClassifier, (F.col("y") > 0).cast("double")), (ml.GBTRegressor, F.col("y").cast("double"))):
        est = cls(labelCol="label", featuresCol="features", weightCol="weight", seed=ml.SEED, maxIter=3, stepSize=0.1, maxDepth=3)
        data = ml.materialize(ml.assembler(["a", "b"]).transform(rows.withColumn("label", label).repartition(2, "id")))
        own = est.fit(data)
        got = {}
        for size in (4 << 20, 9000):
            got[size], trees, cuts = boosting.grow(data, cls is ml.GBTClassifier, fits, [1, 3], "fold", 3, "label", "weight", partition_bytes=size)
            model = ml.boosted_model(spark, est, trees[0], cuts)
            assert model.getNumTrees == 3 and model.numFeatures == 2 and model.getMaxDepth() == 3 and list(model.treeWeights) == [1.0, 0.1, 0.1]
            both = own.transform(data).withColumnRenamed("prediction", "p").select("id", "p").join(model.transform(data).select("id", "prediction"), "id")
            assert both.where("abs(p - prediction) > 1e-9").count() == 0
            assert np.allclose(own.featureImportances.toArray(), model.featureImportances.toArray())
        for m, sums in got[9000].items():
            assert sums.keys() == got[4 << 20][m].keys() and all(abs(x - got[4 << 20][m][n]) < 1e-9 * max(1, x) for n, x in sums.items())


def test_boosting_of_few_distinct_rows_needs_no_job_a_level(spark):
    """however many rows fall in the same bins, their cells fit in a task."""
    rows = spark.range(6000).select((F.col("id") % 7).cast("double").alias("a"), (F.hash("id") % 5).cast("double").alias("b"),
                                    (F.col("id") % 3).cast("int").alias("fold"), (F.hash("id", F.lit(2)) % 9).cast("double").alias("label"))
    data = ml.materialize(ml.assembler(["a", "b"]).transform(rows))
    spark.sparkContext.setJobGroup("few distinct rows", "")
    boosting.staged_scores(data, False, [{"stepSize": 0.1, "maxDepth": 3, "maxIter": 12}], [12], "fold", 3, "label", None, partition_bytes=40_000)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("few distinct rows"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 20  # before: 36 levels of 12 trees, a job each
