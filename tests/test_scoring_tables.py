"""Scores, metrics, run registry and table maintenance."""

import json
import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from geoscore.operators import metrics, scoring
from geoscore.sources import tables


def test_gap_scores_bounds_and_monotone(spark):
    areas = spark.createDataFrame([(i, float(i % 7), i % 5) for i in range(60)], "k int, p double, a int")
    s = scoring.gap_scores(areas, ["k"], "p", "a").orderBy("gap").collect()
    vals = [r.score for r in s if r.score is not None]
    assert all(0.0 <= v <= 1.0 for v in vals)
    assert all(a <= b for a, b in zip(vals, vals[1:]))


def test_histogram_counts_everything(spark):
    df = spark.range(101).select((F.col("id") / 10.0).alias("v"))
    h = scoring.histogram(df, "v", bins=10).collect()
    assert sum(r.n for r in h) == 101 and max(r.bin for r in h) == 9


def test_class_report_never_predicted(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (0, 0)], "label int, prediction int")
    rep = {r["class"]: r for r in metrics.class_report(df).collect()}
    assert rep["1"].precision == 0.0 and rep["1"].f1 == 0.0 and rep["1"].support == 2.0
    assert abs(rep["accuracy"].precision - 1 / 3) < 1e-12


def test_kappa_perfect_and_weights(spark):
    df = spark.createDataFrame([(1, 1), (0, 0), (1, 1), (0, 0)], "label int, prediction int")
    k = metrics.kappa_f1(df).first()
    assert (k.accuracy, k.kappa, k.f1) == (1.0, 1.0, 1.0)
    w = {r.label: r.weight for r in metrics.class_weights(
        spark.createDataFrame([(1,), (1,), (1,), (0,)], "label int"), "label").collect()}
    assert w == {1: 4 / 6, 0: 2.0}


def test_best_run_numeric_and_newest_tie(spark):
    runs = spark.createDataFrame(
        [(1, "t", json.dumps({"accuracy": 0.9})), (2, "t", json.dumps({"accuracy": 9e-05})),
         (3, "u", json.dumps({"accuracy": 0.5})), (4, "u", json.dumps({"accuracy": 0.5}))],
        "id long, fk_metier string, metrics string")
    best = {r.fk_metier: r.best_id for r in
            tables.best_runs(runs, ["fk_metier"], tables.metric_of(runs, "accuracy")).collect()}
    assert best == {"t": 1, "u": 4}
    cands = spark.createDataFrame([(3,)], "id long")
    best = {r.fk_metier: r.best_id for r in
            tables.best_runs(runs, ["fk_metier"], tables.metric_of(runs, "accuracy"), candidates=cands).collect()}
    assert best == {"u": 3}


def test_keyed_update(spark):
    old = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "k int, v double")
    new = spark.createDataFrame([(2, None), (3, 33.0), (9, 99.0)], "k int, v double")
    out = sorted(map(tuple, tables.keyed_update(old, new, ["k"], ["v"]).collect()))
    assert out == [(1, 10.0), (2, None), (3, 33.0)]


def test_slice_replace_on_disk(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="slices-"), "scores")
    a = spark.createDataFrame([(1, "s", "x", 1.0), (2, "s", "y", 2.0)], "id int, score string, fk_metier string, v double")
    tables.replace_slices(a, path, ["score", "fk_metier"])
    b = spark.createDataFrame([(3, "s", "x", 3.0)], "id int, score string, fk_metier string, v double")
    tables.replace_slices(b, path, ["score", "fk_metier"])
    got = sorted((r.id, r.fk_metier) for r in spark.read.parquet(path).collect())
    assert got == [(2, "y"), (3, "x")]


def test_registry_roundtrip_and_active_flag(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="reg-"), "runs")
    r1 = tables.register_run(spark, path, "boulangerie", "survie_3", {"d": 5}, {"accuracy": 0.8})
    r2 = tables.register_run(spark, path, "boulangerie", "survie_3", {"d": 10}, {"accuracy": 0.85})
    assert (r1, r2) == (1, 2)
    runs = tables.read_table(spark, path)
    best = tables.best_runs(runs, ["fk_metier"], tables.metric_of(runs, "accuracy"))
    act = {r.id: r.actif for r in tables.with_active_flag(runs, best, ["fk_metier"]).collect()}
    assert act == {1: False, 2: True}


def test_status_log(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="status-"), "log")
    p = spark.createDataFrame([(7,)], "id_projet int")
    tables.log_status(spark, path, p, "calculs en cours")
    tables.log_status(spark, path, p, "disponible")
    cur = tables.current_status(spark.read.parquet(path), ["id_projet"]).first()
    assert cur.status == "disponible" and cur.n_updates == 2


def test_ensure_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    out = tables.ensure_columns(df, {"a": "int", "b": "double"})
    assert out.columns == ["a", "b"] and out.first().b is None


def test_update_with_duplicate_staging_keys(spark):
    old = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    new = spark.createDataFrame([(1, 5.0), (1, 7.0), (1, None), (3, 9.0)], "k int, v double")
    assert sorted(map(tuple, tables.keyed_update(old, new, ["k"], ["v"]).collect())) == [(1, 7.0), (2, 2.0)]


def test_replacing_with_nothing_clears_the_slice(spark, tmp_path):
    path, cols = str(tmp_path / "scores"), ["score", "fk_metier"]
    a = spark.createDataFrame([(1, "o p", "x"), (2, "o p", "y"), (3, "q", None)], "id int, score string, fk_metier string")
    tables.replace_slices(a, path, cols)
    tables.replace_slices(a.where("id = 2"), path, cols, [("o p", "x"), ("q", None), ("o p", "y")])
    assert [r.id for r in spark.read.parquet(path).collect()] == [2]


def test_unreadable_registry_raises(spark, tmp_path):
    import pytest
    path = tmp_path / "registry"
    assert tables.next_run_id(spark, str(path)) == 1
    path.mkdir()
    (path / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        tables.next_run_id(spark, str(path))


SCORES = "id int, score string, fk_metier string"


def _ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


def test_replacement_that_fails_is_finished(spark, tmp_path, monkeypatch):
    path, cols = str(tmp_path / "scores"), ["score", "fk_metier"]
    old = spark.createDataFrame([(1, "o p", "x"), (2, "o p", "y"), (3, "q%", None), (4, "r", "z")], SCORES)
    new = spark.createDataFrame([(11, "o p", "x"), (12, "o p", "y"), (13, "q%", None)], SCORES)
    tables.replace_slices(old, path, cols)
    real, calls = tables.recover, []

    def fails_second(spark_, path_):
        calls.append(path_)
        if len(calls) == 2:
            raise KeyboardInterrupt
        return real(spark_, path_)

    # after the journal, before any move
    monkeypatch.setattr(tables, "recover", fails_second)
    with pytest.raises(KeyboardInterrupt):
        tables.replace_slices(new, path, cols, [("r", "z")])
    monkeypatch.undo()
    assert _ids(spark, path) == [1, 2, 3, 4]
    assert tables.recover(spark, path) and _ids(spark, path) == [11, 12, 13]
    assert not tables.recover(spark, path)

    # between two moves: one folder is in place, the journal is still there
    calls.clear()
    monkeypatch.setattr(tables, "recover", fails_second)
    with pytest.raises(KeyboardInterrupt):
        tables.replace_slices(old.where("id < 3"), path, cols)
    monkeypatch.undo()
    stage = next((tmp_path / "scores" / "_staged").iterdir())
    moved = next((stage / "score=o p").iterdir())
    place = tmp_path / "scores" / "score=o p" / moved.name
    shutil.rmtree(place)
    moved.rename(place)
    assert tables.recover(spark, path) and _ids(spark, path) == [1, 2, 13]

    # before the journal: the stage is dropped, the table stays
    (tmp_path / "scores" / "_staged" / "left").mkdir(parents=True)
    (tmp_path / "scores" / "_replacement.json.draft").write_text("{")
    assert not tables.recover(spark, path) and _ids(spark, path) == [1, 2, 13]
    tables.replace_slices(new.where("id = 13"), path, cols, [("o p", "x")])
    assert _ids(spark, path) == [2, 13]


def test_repeated_batch_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], SCORES)
    tables.append(df, path, batch="run 1/a")
    tables.append(df, path, batch="run 2")
    tables.append(df.where("id = 1"), path, batch="run 2")
    assert _ids(spark, path) == [1, 1, 2]
    parted = str(tmp_path / "parted")
    for _ in range(2):
        tables.append(df, parted, ["score"], batch="b")
    assert _ids(spark, parted) == [1, 2]


def test_run_ids_are_claimed_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    path = str(tmp_path / "registry")
    with ThreadPoolExecutor(4) as pool:
        ids = list(pool.map(lambda _: tables.claim_run_id(spark, path), range(8)))
    assert sorted(ids) == list(range(1, 9))
    # ids of runs that failed after their claim stay unused
    assert tables.register_run(spark, path, "boulangerie", "survie_3", {}, {"accuracy": 0.5}) == 9
    assert tables.claim_run_id(spark, path) == 10
