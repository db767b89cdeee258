"""Micro-batch sinks and the parameter-window search."""

import os
import tempfile

from pyspark.sql import functions as F

from geoscore.operators import ml
from geoscore.streaming import append_sink, slice_sink


def test_foreach_batch_sinks(spark):
    base = tempfile.mkdtemp(prefix="stream-")
    src = os.path.join(base, "in")
    spark.createDataFrame([(1, "s", "a", 1.0), (2, "s", "b", 2.0)],
                          "idinspire int, score string, fk_metier string, valeur double").write.parquet(src)
    stream = spark.readStream.schema("idinspire int, score string, fk_metier string, valeur double").parquet(src)
    ck = os.path.join(base, "ck")
    q1 = (stream.writeStream.foreachBatch(append_sink(os.path.join(base, "log")))
          .option("checkpointLocation", ck + "1").trigger(availableNow=True).start())
    q1.awaitTermination(120)
    q2 = (stream.writeStream.foreachBatch(slice_sink(os.path.join(base, "scores"), ["score", "fk_metier"],
                                                     lambda b: b.withColumn("valeur", F.col("valeur") * 2)))
          .option("checkpointLocation", ck + "2").trigger(availableNow=True).start())
    q2.awaitTermination(120)
    assert spark.read.parquet(os.path.join(base, "log")).count() == 2
    got = sorted((r.idinspire, r.valeur) for r in spark.read.parquet(os.path.join(base, "scores")).collect())
    assert got == [(1, 2.0), (2, 4.0)]


def test_window_search_finds_interior_peak():
    calls = []

    def score(p):
        calls.append(p["maxDepth"])
        return -abs(p["maxDepth"] - 12)

    best, hist, end = ml.window_search(score, {"maxDepth": 2}, "maxDepth")
    assert end == "interior"
    assert ml.window_search(lambda p: p["maxDepth"], {"maxDepth": 2}, "maxDepth", (1, 30))[::2] == ({"maxDepth": 30}, "upper limit")
    assert ml.window_search(lambda p: -p["maxDepth"], {"maxDepth": 9}, "maxDepth", (1, 30))[::2] == ({"maxDepth": 1}, "lower limit")
    assert best["maxDepth"] in (8, 16) or best["maxDepth"] == 12
    assert len(calls) == len(set(calls))
    assert dict(hist)[best["maxDepth"]] == max(v for _, v in hist)


def test_scale_conf_sizes_partitions(spark):
    from geoscore.session import scale_conf
    c = scale_conf(100 * 1024 ** 4)       # 100 TiB input
    assert int(c["spark.sql.shuffle.partitions"]) == 102_400
    c = scale_conf(10 * 1024 ** 3)        # 10 GiB input
    assert int(c["spark.sql.shuffle.partitions"]) == 200
    assert int(c["spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]) == 4 * (256 << 20)
