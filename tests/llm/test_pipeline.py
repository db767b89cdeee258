"""The pipeline's stages on a small folder: what each keeps and drops."""
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from geoscore.llm.decontam import normal

from .conftest import noisy_texts
from .test_lines import brute as brute_lines
from .test_shingles import brute as brute_groups


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(8)
    path = str(tmp_path_factory.mktemp("corpus"))
    items = [(i, " ".join(f"item{i}w{j}" for j in range(12))) for i in range(4)]
    texts = noisy_texts(21, 120, lines=(1, 4), words=(8, 40), edits=0.05)
    rows = [(i, t + (f"\n{items[i % 4][1].upper()} tail" if i % 17 == 3 else ""), "en", "s", len(t)) for i, t in enumerate(texts)]
    rows += [(500 + i, "!!! ### " * rnd.randint(5, 30), "en", "s", 1) for i in range(30)]
    rows += [(600, None, None, None, None), (601, "", "en", "s", 0), (None, texts[0], "en", "s", 1), (602, texts[1], "en", "s", 1), (602, texts[1], "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("quality", F.lit("x")).withColumn("kept", F.lit(1)).withColumn("leaks", F.lit(2))
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i < 500), 0) for i in [*range(120), *range(500, 530)]] + [(None, 1, 0), (3, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items + [(9, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, items


def test_stages(spark, folder):
    path, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination", "packing"]
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, path).cache()
        assert out.columns == docs.columns, name
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        after = [(r["doc_id"], r["text"]) for r in out.collect()]
        if name == "quality":
            assert set(after) <= set(before) and not any(i is not None and 500 <= i < 530 for i, _ in after)
            assert len([i for i, _ in after if i is not None and i < 120]) == 120
        elif name == "line_dedup":
            gone = brute_lines(before)
            want = [(i, None if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if j not in gone[k])) for k, (i, t) in enumerate(before)]
            assert sorted(map(str, after)) == sorted(map(str, want))
        elif name == "near_duplicates":
            groups = {c for _, n, c in brute_groups(before) if n}
            assert {i for i, t in after if t and t.split()} == groups
            kept = brute_groups([r for r in after if r[1] and r[1].split()])
            assert len({c for _, _, c in kept}) == len(kept)  # one document of each group
        else:
            leaked = {i for i, t in before if any(normal(x) in normal(t) for _, x in items)}
            assert {i for i, _ in after} == {i for i, _ in before} - leaked
        docs = out
    packed = P.STAGES[-1][1](spark, docs, path)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert packed.select("length").agg(F.sum("length")).first()[0] == P.run(spark, path).agg(F.sum("length")).first()[0]


def test_empty_documents(spark, folder, tmp_path):
    path, _ = folder
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
