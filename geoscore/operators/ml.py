"""Model tuning, evaluation and scoring on Spark ML.

Every fit is a distributed Spark ML job over the whole training frame; the
driver only loops over a handful of parameter settings or folds. Folds and
splits come from a seeded hash of the key, so they do not depend on how
the data happens to be partitioned.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from itertools import product

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier, RandomForestClassificationModel,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoscore.operators import boosting, forest, metrics
from geoscore.operators.ranking import row_number_unique
from geoscore.session import fresh_path, materialize, work_dir  # noqa: F401

# ---------------------------------------------------------------------------
# Search grids and fold counts of the reference jobs.
# ---------------------------------------------------------------------------
SURVIVAL_DEPTHS = [2, 5, 10, 20, 50, 100]
SURVIVAL_TREES_3Y = 200
SURVIVAL_TREES_5Y = 100
OPPORTUNITY_DEPTHS = [2, 5, 10]
OPPORTUNITY_TREES = 200
GBT_CLASSIFIER_GRID = {"maxIter": [100, 200], "stepSize": [0.01, 0.1], "maxDepth": [3, 5]}
GBT_REGRESSOR_GRID = {"maxIter": [100, 200], "stepSize": [0.01, 0.1], "maxDepth": [3, 4, 5]}
TUNING_FOLDS = 5
EVALUATION_FOLDS = 10
SWEEP_STEP = 5
HOLDOUT_FRACTION = 0.2
SEED = 42
# Spark's tree learner accepts depths up to 30.
SPARK_MAX_DEPTH = 30
# Randomised search: the space the settings are drawn from, and the steps of
# the local grid around the best of them (multiples of a step, lower limit).
RANDOM_SPACE = {
    "numTrees": [200, 400, 600, 800, 1000, 1200, 1400, 1600, 1800, 2000],
    "featureSubsetStrategy": ["auto", "sqrt"],
    "maxDepth": [10, 20, 30],
    "minInstancesPerNode": [1, 2, 4],
    "bootstrap": [True, False],
}
LOCAL_STEPS = {"numTrees": (100, range(-2, 3), 1), "maxDepth": (10, range(-2, 3), 1), "minInstancesPerNode": (1, range(-1, 2), 1)}
LOCAL_VALUES = {"featureSubsetStrategy": ["2", "3"]}
RANDOM_DRAWS = 100
RANDOM_FOLDS = 3
# Independent fits submitted at once (CV settings, folds, sweep steps).
FIT_PARALLELISM = 12
# Memory for node statistics per pass of the tree learner: more nodes per
# pass means fewer passes over the cached training set (same trees).
TREE_PASS_MEMORY_MB = 1024
# Boosting iterations between two checkpoints of the residuals.
BOOSTING_CHECKPOINT = 40
# Training tables are read many times; each of their partitions is a task of
# every pass, so they follow the data's size. A task also hands on statistics
# of every node: smaller partitions than this cost more than they share out.
TRAINING_PARTITION_BYTES = 4 << 20


def spark_depths(depths) -> list[int]:
    """Clamp a depth grid to Spark's limit (50 and 100 become 30), deduplicated."""
    out = []
    for d in depths:
        d = min(int(d), SPARK_MAX_DEPTH)
        if d not in out:
            out.append(d)
    return out


def _pmap(fn, items, parallelism: int):
    """Run independent Spark fits from a few driver threads (Spark schedules
    their jobs concurrently, like CrossValidator's ``parallelism``)."""
    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        return [fn(i) for i in items]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as ex:
        return list(ex.map(fn, items))


# ---------------------------------------------------------------------------
# Folds and splits
# ---------------------------------------------------------------------------
def key_hash(key: str, seed: int = SEED):
    return F.xxhash64(F.col(key), F.lit(seed))


def stratified_folds(df: DataFrame, key: str, label: str, k: int, seed: int = SEED,
                     out: str = "fold") -> DataFrame:
    """Fold = (row number within the class, in seeded-hash order) mod k:
    classes spread evenly over folds, reproducible across partitionings.
    The row number is a distributed rank, not a per-class window."""
    h = df.withColumn("_h", key_hash(key, seed))
    r = row_number_unique(h, [label], "_h", "_rn")
    return r.withColumn(out, ((F.col("_rn") - 1) % k).cast("int")).drop("_h", "_rn")


def hash_folds(df: DataFrame, key: str, k: int, seed: int = SEED, out: str = "fold") -> DataFrame:
    """Unstratified folds for regressors: seeded hash of the key mod k."""
    return df.withColumn(out, F.pmod(key_hash(key, seed), F.lit(k)).cast("int"))


def hash_split(df: DataFrame, key: str, test_fraction: float = HOLDOUT_FRACTION,
               seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Reproducible train / test split on a seeded hash of the key."""
    u = F.pmod(key_hash(key, seed), F.lit(10_000)) / F.lit(10_000.0)
    return df.where(u >= test_fraction), df.where(u < test_fraction)


def sample_rows(df: DataFrame, key: str, n: int | None, seed: int = SEED) -> DataFrame:
    """N rows without replacement, chosen by seeded hash (a sampling
    operator - the limit is the feature). ``None`` keeps every row."""
    if n is None:
        return df
    return df.orderBy(key_hash(key, seed), F.col(key)).limit(n)


# ---------------------------------------------------------------------------
# Estimators
# ---------------------------------------------------------------------------
def assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def _used_columns(estimator) -> list[str]:
    """Label and weight columns of an estimator."""
    cols = [estimator.getLabelCol()]
    if estimator.hasParam("weightCol") and estimator.isDefined("weightCol") and estimator.getWeightCol():
        cols.append(estimator.getWeightCol())
    return cols


def prepared(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """``features`` (assembled once) and the columns ``keep``, written to the
    shared folder; partitions hold TRAINING_PARTITION_BYTES at most."""
    keep = list(dict.fromkeys(keep))
    table = materialize(assembler(features).transform(df).select("features", *keep))
    size = table.count() * 8 * (len(features) + len(keep))
    return table.coalesce(max(1, -(-size // TRAINING_PARTITION_BYTES)))


def rf_classifier(num_trees: int, label: str = "label", weight: str | None = "weight",
                  seed: int = SEED, **kw) -> RandomForestClassifier:
    # rows keep their node in every tree, instead of walking down from the root at each level (same trees)
    kw = {"maxMemoryInMB": TREE_PASS_MEMORY_MB, "cacheNodeIds": True, **kw}
    est = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees,
                                 seed=seed, **kw)
    if weight:
        est.setWeightCol(weight)
    return est


def rf_regressor(num_trees: int, label: str = "label", seed: int = SEED, **kw) -> RandomForestRegressor:
    # every feature is a split candidate at every node, as in a plain forest
    kw = {"maxMemoryInMB": TREE_PASS_MEMORY_MB, "cacheNodeIds": True, **kw}
    return RandomForestRegressor(labelCol=label, featuresCol="features", numTrees=num_trees,
                                 featureSubsetStrategy="all", seed=seed, **kw)


def positive_f1(label: str = "label") -> MulticlassClassificationEvaluator:
    """F1 of class 1 (Spark's plain ``f1`` is the weighted mean over classes)."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                             metricName="fMeasureByLabel", metricLabel=1.0)


def mse(label: str = "label") -> RegressionEvaluator:
    """Mean squared error, minimised by the search."""
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="mse")


@dataclass
class TuningResult:
    model: PipelineModel
    grid: DataFrame                 # one row per parameter setting with its CV metric
    best_params: dict = field(default_factory=dict)
    metric_name: str = ""


def _grid_frame(spark, settings: list[dict], metrics_: list[float], metric_name: str, larger_better: bool):
    best_i = (max if larger_better else min)(range(len(metrics_)), key=lambda i: metrics_[i])
    rows = []
    for i, (params, m) in enumerate(zip(settings, metrics_)):
        rows.append((i, ",".join(f"{k}={params[k]}" for k in sorted(params)),
                     int(params.get("maxDepth", -1)), int(params.get("numTrees", params.get("maxIter", -1))),
                     float(params.get("stepSize", 0.0)), float(m), i == best_i))
    schema = ("setting int, params string, max_depth int, n_estimators int, step_size double, "
              f"{metric_name} double, best boolean")
    return spark.createDataFrame(rows, schema), dict(settings[best_i])


def tune(train: DataFrame, features: list[str], estimator, grid_spec: dict, evaluator,
         fold_col: str = "fold", folds: int = TUNING_FOLDS, parallelism: int = FIT_PARALLELISM,
         metric_name: str = "metric") -> TuningResult:
    """M1 / M3: k-fold grid search with a precomputed fold column, and the fit
    on all rows with the best setting (CrossValidator does both). The features
    are assembled once, for all folds and settings.
    ``grid_spec`` maps estimator param names to value lists. A forest's depths
    are levels of one deep forest (:func:`_tune_levels`)."""
    data = prepared(train, features, [*_used_columns(estimator), fold_col])
    if isinstance(estimator, (RandomForestClassifier, RandomForestRegressor)) and len(grid_spec.get("maxDepth", ())) > 1:
        settings, found, best_model = _tune_levels(data, estimator, grid_spec, evaluator, fold_col, folds, parallelism)
    else:
        b = ParamGridBuilder()
        for name, values in grid_spec.items():
            b = b.addGrid(estimator.getParam(name), list(values))
        grid = b.build()
        cvm = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, foldCol=fold_col,
                             numFolds=folds, parallelism=parallelism, seed=SEED).fit(data)
        settings, found, best_model = [{p.name: pm[p] for p in pm} for pm in grid], list(cvm.avgMetrics), cvm.bestModel
    frame, best = _grid_frame(train.sparkSession, settings, found, metric_name, evaluator.isLargerBetter())
    return TuningResult(PipelineModel(stages=[assembler(features), best_model]), frame, best, metric_name)


def _tune_levels(data: DataFrame, estimator, grid_spec: dict, evaluator, fold_col: str, folds: int,
                 parallelism: int) -> tuple[list[dict], list[float], object]:
    """Settings, mean metrics and the best setting's model on all rows, with
    one fit for all depths of a fold: a forest grows level by level from the
    same draws, so a shallower one is its first levels (where a level's nodes
    fit in TREE_PASS_MEMORY_MB; beyond, its nodes' feature draws are others of
    the same kind)."""
    settings = [dict(zip(grid_spec, values)) for values in product(*grid_spec.values())]
    depths = sorted(grid_spec["maxDepth"])
    fits = [dict(zip(grid_spec, values)) for values in product(*(v if k != "maxDepth" else depths[-1:] for k, v in grid_spec.items()))]

    def fitted(setting, rows):
        est = estimator.copy({estimator.getParam(k): v for k, v in setting.items()})
        grown = forest.grow(est, rows)
        if grown:
            return grown
        model = est.fit(rows)
        return type(model), _saved(model)

    def one(job):
        fold, setting = job
        if fold is None:
            return fitted(setting, data)
        kind, deep = fitted(setting, data.where(F.col(fold_col) != fold))
        scored = level_predictions(kind, deep, depths, data.where(F.col(fold_col) == fold), evaluator.getLabelCol())
        return {tuple(sorted(dict(setting, maxDepth=d).items())): evaluator.copy({evaluator.predictionCol: f"depth_{d}"}).evaluate(scored)
                for d in depths}

    # a single fit on all rows goes along with the folds'; of several, only the best one is made
    jobs = [(None, fits[0])] * (len(fits) == 1) + [(fold, setting) for setting in fits for fold in range(folds)]
    done = _pmap(one, jobs, parallelism)
    scores = {}
    for got in done[len(fits) == 1:]:
        for k, m in got.items():
            scores.setdefault(k, []).append(m)
    found = [float(np.mean(scores[tuple(sorted(s.items()))])) for s in settings]
    best = settings[(max if evaluator.isLargerBetter() else min)(range(len(settings)), key=lambda i: found[i])]
    kind, path = fitted(best, data) if len(fits) > 1 else done[0]
    return settings, found, first_levels(kind.load(path), best["maxDepth"], path)


def _saved(model) -> str:
    path = fresh_path(SparkSession.active(), "models")
    model.write().save(path)
    return path


def first_levels(model, depth: int, saved: str | None = None):
    """The forest made of the first levels of a fitted one; ``saved``: where it is."""
    if depth >= model.getOrDefault("maxDepth"):
        return model
    spark = SparkSession.active()
    saved, path = saved or _saved(model), fresh_path(spark, "models")
    spark.read.text(os.path.join(saved, "metadata")).coalesce(1).write.text(os.path.join(path, "metadata"))
    spark.read.parquet(os.path.join(saved, "treesMetadata")).write.parquet(os.path.join(path, "treesMetadata"))
    (spark.read.parquet(os.path.join(saved, "data")).select("treeID", "nodeData.*").groupBy("treeID")
     .applyInPandas(lambda tree: _cut_tree(tree, depth), forest.NODES).write.parquet(os.path.join(path, "data")))
    short = type(model).load(path)
    return short.copy({short.getParam("maxDepth"): depth})


def level_predictions(kind, saved: str, depths: list[int], rows: DataFrame, label: str) -> DataFrame:
    """``label`` of every row and, in ``depth_<d>``, the prediction of the first
    ``d`` levels (:func:`first_levels`) of a saved forest of class ``kind``; rows
    stay in their partitions, tasks read the nodes from the shared folder."""
    files = sorted(rows.sparkSession.read.parquet(os.path.join(saved, "data")).inputFiles())
    classifier = kind is RandomForestClassificationModel
    names = [f"depth_{d}" for d in depths]

    def run(batches):
        nodes = None
        for pdf in batches:
            if nodes is None:
                nodes = _forest_nodes(files)
            x = np.array(pdf["features"].to_list(), dtype=float).reshape(len(pdf), -1)
            yield pd.DataFrame({label: pdf[label], **{n: _forest_predictions(nodes, x, d, classifier) for n, d in zip(names, depths)}})

    schema = f"`{label}` double, " + ", ".join(f"{n} double" for n in names)
    got = rows.select(F.col(label).cast("double").alias(label), vector_to_array("features").alias("features"))
    return materialize(got.mapInPandas(run, schema))


def _forest_nodes(files: list[str]) -> dict:
    """Node arrays of a saved forest, tree by tree; children are positions in them."""
    parts = []
    for url in files:
        fs, where = pafs.FileSystem.from_uri(url)
        parts.append(pq.read_table(where, filesystem=fs).flatten().to_pandas())
    t = pd.concat(parts).sort_values(["treeID", "nodeData.id"])
    ids, tree = t["nodeData.id"].to_numpy(), t["treeID"].to_numpy()
    first = np.arange(len(t)) - ids  # ids of a tree are gapless from 0
    out = {"roots": np.flatnonzero(ids == 0), "prediction": t["nodeData.prediction"].to_numpy(),
           "stats": np.array(t["nodeData.impurityStats"].to_list(), dtype=float)}
    for side in ("left", "right"):
        child = t[f"nodeData.{side}Child"].to_numpy()
        out[side] = np.where(child < 0, -1, child + first)
    split = t["nodeData.split"]
    out["feature"] = np.array([s["featureIndex"] for s in split])
    out["threshold"] = np.array([s["leftCategoriesOrThreshold"][0] if s["featureIndex"] >= 0 else np.nan for s in split])
    assert len(out["roots"]) == len(np.unique(tree))
    levels, at = [], out["roots"]
    while len(at):
        levels.append(at)
        at = at[out["left"][at] >= 0]
        at = np.concatenate([out["left"][at], out["right"][at]])
    out["levels"] = levels
    return out


def _forest_predictions(nodes: dict, x: np.ndarray, depth: int, classifier: bool) -> np.ndarray:
    """Predictions of the forest's first ``depth`` levels, trees added up in their order."""
    leaf, p = nodes["left"] < 0, nodes["prediction"].copy()
    for at in nodes["levels"][depth:depth + 1]:
        leaf[at] = True
    for at in nodes["levels"][:depth][::-1]:  # two leaves of the same prediction become one
        at = at[~leaf[at]]
        a, b = nodes["left"][at], nodes["right"][at]
        merged = leaf[a] & leaf[b] & (p[a] == p[b])
        p[at[merged]], leaf[at[merged]] = p[a[merged]], True
    stats = nodes["stats"]
    total = np.zeros((len(x), stats.shape[1])) if classifier else np.zeros(len(x))
    rows = np.arange(len(x))
    for root in nodes["roots"]:
        at = np.full(len(x), root)
        live = rows[~leaf[at]]
        while len(live):
            here = at[live]
            goes = x[live, nodes["feature"][here]] <= nodes["threshold"][here]  # NaN goes right
            at[live] = np.where(goes, nodes["left"][here], nodes["right"][here])
            live = live[~leaf[at[live]]]
        if classifier:
            votes = stats[at]
            whole = votes.sum(axis=1, keepdims=True)
            total += np.divide(votes, whole, out=np.zeros_like(votes), where=whole != 0)
        else:
            total += p[at]
    return total.argmax(axis=1).astype(float) if classifier else total / len(nodes["roots"])


def _cut_tree(tree: pd.DataFrame, depth: int) -> pd.DataFrame:
    """A tree's first levels: nodes at ``depth`` are leaves; two leaves of the
    same prediction become one, as at the end of a fit."""
    tree = tree.sort_values("id")  # a node comes before its children
    left, right, p = tree["leftChild"].to_numpy().copy(), tree["rightChild"].to_numpy().copy(), tree["prediction"].to_numpy().copy()
    level = np.full(len(tree), -1)
    level[0] = 0
    for i in range(len(tree)):
        if level[i] < 0 or left[i] < 0:
            continue
        if level[i] == depth:
            left[i] = right[i] = -1
        else:
            level[left[i]] = level[right[i]] = level[i] + 1
    kept = level >= 0
    for i in range(len(tree) - 1, -1, -1):
        a, b = left[i], right[i]
        if kept[i] and a >= 0 and left[a] < 0 and left[b] < 0 and p[a] == p[b]:
            p[i], left[i], right[i], kept[a], kept[b] = p[a], -1, -1, False, False
    number = np.cumsum(kept) - 1
    rows = []
    for i, r in zip(np.flatnonzero(kept), tree[kept].itertuples(index=False)):
        leaf = left[i] < 0
        rows.append({"id": int(number[i]), "prediction": float(p[i]), "impurity": r.impurity, "impurityStats": r.impurityStats,
                     "rawCount": r.rawCount, "gain": -1.0 if leaf else r.gain,
                     "leftChild": -1 if leaf else int(number[left[i]]), "rightChild": -1 if leaf else int(number[right[i]]),
                     "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1} if leaf else r.split})
    return pd.DataFrame({"treeID": tree["treeID"].iloc[0], "nodeData": rows})


def fold_metrics(data: DataFrame, estimator, settings: list[dict], evaluator, fold_col: str, folds: int,
                 parallelism: int = FIT_PARALLELISM, lengths: list[int] | None = None, grown: list | None = None) -> dict[tuple, float]:
    """Mean metric over the folds of each setting (a dict of estimator params).

    With ``lengths`` the settings are those of boosted trees, each scored after
    so many iterations; all of them grow together (:mod:`boosting`). A list
    ``grown`` gets the settings' trees on all rows, and their thresholds."""
    def one(job):
        setting, fold = job
        fitted = forest.fit(estimator.copy({estimator.getParam(k): v for k, v in setting.items()}), data.where(F.col(fold_col) != fold))
        return setting, evaluator.evaluate(fitted.transform(data.where(F.col(fold_col) == fold)))

    def boosted():
        classifier = isinstance(estimator, GBTClassifier)
        label, *weight = _used_columns(estimator)
        found, *models = boosting.grow(data, classifier, settings, lengths, fold_col, folds, label, weight[0] if weight else None,
                                       estimator.getMaxBins(), SEED, TRAINING_PARTITION_BYTES, grown is not None)
        if grown is not None:
            grown.extend(models)

        def metric(item):
            (s, _, n), sums = item
            if classifier:
                counts = data.sparkSession.createDataFrame([(*pair, n) for pair, n in sums.items()], f"`{label}` double, prediction double, n double")
                return dict(settings[s], maxIter=n), evaluator.copy({evaluator.weightCol: "n"}).evaluate(counts)
            return dict(settings[s], maxIter=n), sums["squares"] / sums["rows"]

        return _pmap(metric, sorted(found.items(), key=lambda item: item[0]), parallelism)

    total = {}
    for setting, m in boosted() if lengths else _pmap(one, list(product(settings, range(folds))), parallelism):
        total.setdefault(tuple(sorted(setting.items())), []).append(m)
    return {k: sum(v) / len(v) for k, v in total.items()}


def boosted_model(spark, estimator, trees: list, cuts: list[np.ndarray]):
    """The model of ``estimator`` made of trees that :mod:`boosting` has grown,
    with the thresholds ``cuts``."""
    path = fresh_path(spark, "models")
    weights = [1.0] + [estimator.getStepSize()] * (len(trees) - 1)
    model = forest.write_model(spark, estimator, "maxIter", len(trees), 2, len(cuts), weights, path)
    nodes = [row for i, t in enumerate(trees) for row in boosting.tree_nodes(i, t, cuts)]
    spark.createDataFrame(nodes, forest.NODES).write.parquet(os.path.join(path, "data"))
    return model.load(path)


def tune_rf_classifier(df: DataFrame, features: list[str], key: str, label: str = "label",
                       depths=SURVIVAL_DEPTHS, num_trees: int = SURVIVAL_TREES_3Y,
                       folds: int = TUNING_FOLDS, parallelism: int = FIT_PARALLELISM) -> TuningResult:
    """M1: balanced-weight random forest, depth grid, stratified folds, F1."""
    d = metrics.with_class_weights(df, label, "weight")
    d = stratified_folds(d, key, label, folds)
    est = rf_classifier(num_trees, label, "weight")
    return tune(d, features, est, {"maxDepth": spark_depths(depths)}, positive_f1(label),
                folds=folds, parallelism=parallelism, metric_name="f1")


def tune_rf_regressor(df: DataFrame, features: list[str], key: str, label: str = "label",
                      depths=OPPORTUNITY_DEPTHS, num_trees: int = OPPORTUNITY_TREES,
                      folds: int = TUNING_FOLDS, parallelism: int = FIT_PARALLELISM) -> TuningResult:
    """M3: random-forest regressor, depth grid, MSE minimised."""
    d = hash_folds(df, key, folds)
    est = rf_regressor(num_trees, label)
    return tune(d, features, est, {"maxDepth": spark_depths(depths)}, mse(label),
                folds=folds, parallelism=parallelism, metric_name="mse")


def tune_gbt(df: DataFrame, features: list[str], key: str, label: str = "label",
             classifier: bool = True, grid: dict | None = None,
             folds: int = TUNING_FOLDS, parallelism: int = FIT_PARALLELISM) -> TuningResult:
    """M4 / M5: gradient-boosted trees over (iterations, step, depth).

    The first trees of a boosted model are those of a shorter one, so each
    (step, depth, fold) is grown once, with the most iterations, and scored
    after each number of iterations of the grid (staged evaluation). The models
    grow together, along with each (step, depth) on all rows; the first trees of
    the best one of these are the model."""
    if classifier:
        grid = grid or GBT_CLASSIFIER_GRID
        d = metrics.with_class_weights(df, label, "weight")
        d = stratified_folds(d, key, label, folds)
        est = GBTClassifier(labelCol=label, featuresCol="features", weightCol="weight", seed=SEED,
                            checkpointInterval=BOOSTING_CHECKPOINT)
        ev, name = positive_f1(label), "f1"
    else:
        grid = grid or GBT_REGRESSOR_GRID
        d = hash_folds(df, key, folds)
        est = GBTRegressor(labelCol=label, featuresCol="features", seed=SEED, checkpointInterval=BOOSTING_CHECKPOINT)
        ev, name = mse(label), "mse"
    data = prepared(d, features, [*_used_columns(est), "fold"])
    rest = [k for k in grid if k != "maxIter"]
    lengths = sorted(grid["maxIter"])
    fits = [dict(zip(rest, values), maxIter=lengths[-1]) for values in product(*(grid[k] for k in rest))]
    grown = []
    found = fold_metrics(data, est, fits, ev, "fold", folds, parallelism, lengths, grown)
    trees, cuts = grown
    settings = [dict(zip(grid, values)) for values in product(*grid.values())]
    frame, best = _grid_frame(df.sparkSession, settings, [found[tuple(sorted(k.items()))] for k in settings], name, ev.isLargerBetter())
    chosen = trees[fits.index(dict({k: best[k] for k in rest}, maxIter=lengths[-1]))][:best["maxIter"]]
    final = boosted_model(df.sparkSession, est.copy({est.getParam(k): v for k, v in best.items()}), chosen, cuts)
    return TuningResult(PipelineModel(stages=[assembler(features), final]), frame, best, name)


def first_trees(model, n: int):
    """The boosted model made of the first ``n`` trees of ``model``."""
    java = model._java_obj
    trees = list(java.trees())[:n]
    context = SparkContext._active_spark_context
    jvm, gateway = context._jvm, context._gateway
    classes = jvm.org.apache.spark.ml.regression
    array = gateway.new_array(classes.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(jvm.double, len(trees))
    for i, (tree, w) in enumerate(zip(trees, model.treeWeights)):
        array[i], weights[i] = tree, w
    if isinstance(model, GBTClassificationModel):
        short = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(model.uid, array, weights))
    else:
        short = GBTRegressionModel(classes.GBTRegressionModel(model.uid, array, weights))
    return short.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


def random_settings(space: dict, n: int, seed: int = SEED) -> list[dict]:
    """``n`` settings drawn from a space (lists of values); distinct ones."""
    import random
    rnd = random.Random(seed)
    drawn = [{k: rnd.choice(v) for k, v in space.items()} for _ in range(n)]
    return list({tuple(sorted(s.items())): s for s in drawn}.values())


def local_grid(best: dict, steps: dict, values: dict, limits: dict | None = None) -> dict:
    """Value lists around ``best``: multiples of a step for the params in
    ``steps``, fixed lists for those in ``values``, the best value otherwise."""
    limits = limits or {"maxDepth": SPARK_MAX_DEPTH}
    out = {}
    for k, v in best.items():
        if k in values:
            out[k] = list(values[k])
        elif k in steps:
            step, times, low = steps[k]
            out[k] = sorted({min(max(low, v + step * t), limits.get(k, 1 << 30)) for t in times})
        else:
            out[k] = [v]
    return out


def random_search(df: DataFrame, features: list[str], key: str, label: str = "label", space: dict = RANDOM_SPACE,
                  draws: int = RANDOM_DRAWS, steps: dict = LOCAL_STEPS, values: dict = LOCAL_VALUES,
                  folds: int = RANDOM_FOLDS, local_folds: int = TUNING_FOLDS, seed: int = SEED,
                  parallelism: int = FIT_PARALLELISM) -> TuningResult:
    """Balanced forest by randomised search, then a grid around the best.

    ``draws`` settings are scored on the same written folds; the grid around
    the best of them goes through :func:`tune`, which refits on all rows.
    ``grid`` of the result holds both phases (column ``phase``)."""
    d = metrics.with_class_weights(df, label, "weight")
    est = rf_classifier(100, label, "weight")
    ev = positive_f1(label)
    data = prepared(stratified_folds(d, key, label, folds), features, [*_used_columns(est), "fold"])
    settings = random_settings(space, draws, seed)
    found = fold_metrics(data, est, settings, ev, "fold", folds, parallelism)
    drawn, best = _grid_frame(df.sparkSession, settings, [found[tuple(sorted(k.items()))] for k in settings], "f1", True)
    result = tune(stratified_folds(d, key, label, local_folds), features, est, local_grid(best, steps, values), ev,
                  folds=local_folds, parallelism=parallelism, metric_name="f1")
    result.grid = drawn.withColumn("phase", F.lit("random")).unionByName(result.grid.withColumn("phase", F.lit("local")))
    return result


def window_search(evaluate, start: dict, param: str, limits: tuple[int, int] = (1, 1 << 20)) -> tuple[dict, list, str]:
    """Widen a numeric parameter window until the best value is interior
    or stands at the parameter's legal limit.

    ``evaluate(params) -> score`` (higher is better) runs one distributed
    cross-validation; the window (v/2, v, 2v), cut to ``limits``, is shifted by
    halving or doubling while the best value sits on its edge. Returns the best
    params, the (value, score) history and how the search ended: ``interior``,
    ``lower limit`` or ``upper limit``."""
    low, high = limits
    v = min(max(int(start[param]), low), high)
    seen = {}
    while True:
        window = sorted({max(low, v // 2), v, min(high, v * 2)})
        for w in window:
            if w not in seen:
                seen[w] = evaluate(dict(start, **{param: w}))
        best = max(window, key=lambda w: (seen[w], -w))
        if best == v:
            break
        v = best
    end = "lower limit" if v == low else "upper limit" if v == high else "interior"
    return dict(start, **{param: v}), sorted(seen.items()), end


# ---------------------------------------------------------------------------
# Importances and the feature-subset sweep
# ---------------------------------------------------------------------------
def feature_importances(spark, model: PipelineModel, features: list[str]) -> DataFrame:
    """``(feature, importance, rank)`` ordered by importance, ties by name."""
    est = model.stages[-1]
    imp = est.featureImportances.toArray().tolist()
    rows = sorted(zip(features, [float(v) for v in imp]), key=lambda t: (-t[1], t[0]))
    return spark.createDataFrame([(f, v, i + 1) for i, (f, v) in enumerate(rows)],
                                 "feature string, importance double, rank int")


def top_features(importances: list[tuple[str, float]], k: int) -> list[str]:
    """Features whose importance reaches the k-th largest (ties widen)."""
    ranked = sorted(importances, key=lambda t: (-t[1], t[0]))
    if not ranked:
        return []
    threshold = ranked[min(k, len(ranked)) - 1][1]
    return [f for f, v in ranked if v >= threshold]


def prob1(col: str = "probability"):
    """P(class 1) from a probability vector."""
    return vector_to_array(F.col(col))[1]


def feature_sweep(df: DataFrame, features: list[str], importances: DataFrame, key: str,
                  label: str = "label", num_trees: int = SURVIVAL_TREES_3Y,
                  max_depth: int = 10, step: int = SWEEP_STEP, parallelism: int = FIT_PARALLELISM) -> DataFrame:
    """M7: refit on the top-k features for k = step, 2 step, ..., n; score
    accuracy, kappa and F1 on a hash hold-out; ``best`` marks the highest F1,
    ties going to the larger k."""
    spark = df.sparkSession
    imp = [(r["feature"], r["importance"]) for r in importances.collect()]  # one row per feature
    d = metrics.with_class_weights(df, label, "weight")
    size = 8 * (len(features) + 3)
    d = materialize(d.select(key, label, "weight", *features))
    d = d.coalesce(max(1, -(-d.count() * size // TRAINING_PARTITION_BYTES)))
    train, test = hash_split(d, key)
    ks = list(range(step, len(features) + 1, step)) or [len(features)]
    if ks[-1] != len(features):
        ks.append(len(features))
    def one(k):
        chosen = top_features(imp, k)
        pipe = Pipeline(stages=[assembler(chosen),
                                rf_classifier(num_trees, label, "weight",
                                              maxDepth=min(max_depth, SPARK_MAX_DEPTH))])
        pred = pipe.fit(train).transform(test)
        m = metrics.kappa_f1(pred, label, "prediction").first()
        return (k, len(chosen), ",".join(chosen), float(m["accuracy"]),
                float(m["kappa"]), float(m["f1"]))

    rows = _pmap(one, ks, parallelism)
    best_k = max(rows, key=lambda r: (r[5], r[0]))[0]
    return spark.createDataFrame(
        [r + (r[0] == best_k,) for r in rows],
        "k int, n_features int, features string, accuracy double, kappa double, f1 double, best boolean")


# ---------------------------------------------------------------------------
# Out-of-fold predictions, scoring, stacking
# ---------------------------------------------------------------------------
def out_of_fold(df: DataFrame, features: list[str], estimator, key: str, label: str = "label",
                folds: int = EVALUATION_FOLDS, stratified: bool = True,
                keep: list[str] | None = None, parallelism: int = FIT_PARALLELISM) -> DataFrame:
    """M8: every row predicted by the model fitted on the other folds.
    Output: key, label, fold, prediction (+ ``p1`` for classifiers)."""
    keep = [c for c in (keep or []) if c not in (key, label, "fold")]
    d = (stratified_folds(df, key, label, folds) if stratified else hash_folds(df, key, folds))
    d = prepared(d, features, [key, label, "fold", *keep, *_used_columns(estimator)])

    def one(f):
        pred = forest.fit(estimator.copy(), d.where(F.col("fold") != f)).transform(d.where(F.col("fold") == f))
        cols = [key, label, "fold", *keep, "prediction"]
        if "probability" in pred.columns:
            pred = pred.withColumn("p1", prob1())
            cols.append("p1")
        return pred.select(*cols)

    parts = _pmap(one, range(folds), parallelism)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return materialize(out)


def fit(df: DataFrame, features: list[str], estimator) -> PipelineModel:
    """Final fit on all rows."""
    data = prepared(df, features, _used_columns(estimator))
    return PipelineModel(stages=[assembler(features), forest.fit(estimator, data)])


def score(model: PipelineModel, df: DataFrame, out: str = "p1") -> DataFrame:
    """Batch scoring that keeps every input column (keys included)."""
    pred = model.transform(df)
    if "probability" in pred.columns:
        pred = pred.withColumn(out, prob1())
    else:
        pred = pred.withColumn(out, F.col("prediction"))
    return pred.drop("features", "rawPrediction", "probability", "prediction")


def stack(df: DataFrame, first_features: list[str], first_estimator, key: str,
          first_label: str, out: str = "p_first", out_of_fold_first: bool = True,
          folds: int = EVALUATION_FOLDS) -> DataFrame:
    """Model 1's P(1) as an input column for model 2. With
    ``out_of_fold_first`` each row gets the probability from a model that did
    not see it (no leakage); otherwise the in-sample probability."""
    if out_of_fold_first:
        oof = out_of_fold(df, first_features, first_estimator, key, first_label, folds)
        return df.join(oof.select(key, F.col("p1").alias(out)), key)
    model = fit(df, first_features, first_estimator)
    return score(model, df, out)


def evaluate_classifier(oof: DataFrame, label: str = "label") -> dict:
    """M9: confusion, report and kappa/F1 of out-of-fold predictions as a
    JSON-ready dict (three tiny aggregate results)."""
    cm = metrics.confusion(oof, label, "prediction").first().asDict()
    kf = metrics.kappa_f1(oof, label, "prediction").first().asDict()
    rep = [r.asDict() for r in metrics.class_report(oof, label, "prediction").collect()]
    return {"confusion_matrix": cm, "accuracy": kf["accuracy"], "kappa": kf["kappa"],
            "f1": kf["f1"], "rapport_classification": rep}


def evaluate_regressor(oof: DataFrame, label: str = "label") -> dict:
    """Out-of-fold MSE and MAE."""
    e = metrics.regression_errors(oof, label, "prediction").first()
    return {"mean_squared_error_cv": e["mse"], "mean_absolute_error_cv": e["mae"]}
