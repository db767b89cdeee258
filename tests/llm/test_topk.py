import numpy as np
from pyspark.sql import functions as F

from geoscore.llm import topk
from geoscore.llm.topk import top_k

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k):
    use = []
    for n, (i, v) in enumerate(rows):
        if v and all(c is not None and np.isfinite(c) for c in v):
            use.append((n, i, [int(np.floor(1024 * float(np.float32(c)))) for c in v]))
    out = []
    for n, i, v in use:
        if i is None or i % 5:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, m) for m, j, w in use if m != n)
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j, _) in enumerate(scored[:k])]
    return sorted(out, key=str)


def run(spark, rows, k):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit(1)).withColumn("score", F.lit("x"))
    return sorted(map(tuple, top_k(df, F.col("vec_id") % 5 == 0, k).collect()), key=str)


def test_against_all_products(spark, monkeypatch):
    monkeypatch.setattr(topk, "ANNULUS_ROWS", 16)
    monkeypatch.setattr(topk, "PIVOTS", 6)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8)) * 3
    rows = [(i, [float(x) for x in centres[i % 6] + rng.normal(size=8) * 0.3]) for i in range(240)]
    rows += [(300 + i, rows[0][1]) for i in range(60)]  # copies beyond an annulus
    rows += [(400, None), (401, []), (402, [1.0, None] + [0.0] * 6), (405, [float("nan")] * 8), (410, [float("inf")] * 8),
             (415, [1.0, -2.0]), (None, rows[0][1]), (420, [0.0] * 8), (421, [0.0] * 8), (425, rows[7][1]), (425, rows[7][1])]
    assert run(spark, rows, 7) == brute(rows, 7)


def test_few_rows_and_empty_table(spark):
    rows = [(0, [1.0, 2.0]), (3, [0.5, 0.5])]
    assert run(spark, rows, 10) == [(0, 1, 3, 1024 * 512 + 2048 * 512)]
    assert run(spark, [(0, [1.0])], 10) == []
    assert run(spark, [], 10) == []
    assert run(spark, [(1, [1.0])], 10) == []
