"""Quality and toxicity: held-out accuracy, odd rows, determinism."""
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoscore.llm import quality, toxicity
from geoscore.llm.common import id_crc
from geoscore.llm.queries.documents import op2_toxicity, op6_quality

SF = "/root/testdata/sf0.01"
WIDE = "/root/testdata/sf0.1"
TOKEN = re.compile(b"[A-Za-z\x80-\xff]+")


def accuracy(spark, got, sf, label):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    j = got.join(labels, "doc_id").where("held_out")
    return j.agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0]


def test_quality_on_held_out_rows(spark):
    got = op6_quality(spark, SF).cache()
    assert got.count() == 1000 and got.where("score < 0 or score > 1 or score is null").count() == 0
    assert accuracy(spark, got, SF, "quality") >= 0.9
    clean = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("quality = 1")
    assert clean.agg(F.avg("predicted")).first()[0] >= 0.99
    assert got.select("doc_id", "score").exceptAll(op6_quality(spark, SF).select("doc_id", "score")).count() == 0
    assert got.where(F.col("held_out") != (id_crc(F.col("doc_id")) % 5 == 0)).count() == 0


def test_toxicity_on_held_out_rows(spark):
    got = op2_toxicity(spark, WIDE).cache()
    assert got.count() == 10000 and got.where("score < 0 or score > 1 or score is null").count() == 0
    assert accuracy(spark, got, WIDE, "toxic") >= 0.92
    plain = got.join(spark.read.parquet(f"{WIDE}/labels.parquet"), "doc_id").where("toxic = 0")
    assert plain.agg(F.avg("predicted")).first()[0] <= 0.02


@pytest.mark.parametrize("kind", ["quality", "toxicity"])
def test_odd_rows(spark, make_docs, kind):
    module = quality if kind == "quality" else toxicity
    rows = spark.createDataFrame([(i, "bad !!! " * 5 if i % 2 else f"good words here {i}", i % 2) for i in range(60)]
                                 + [(100, None, 1), (101, "", 0), (102, "x", None), (103, "y", 7), (104, "long " * 200000, 0)],
                                 "key long, text string, label int")
    docs = make_docs([(1, None), (2, ""), (3, "bad !!!"), (3, "bad !!!"), (None, "good words"), (4, "w " * 300000)]).withColumn("label", F.lit("x"))

    def scored_by(model, docs=docs):
        if kind == "toxicity":
            return toxicity.score_rows(docs, model, "s")
        return docs.withColumn("s", quality.score(F.col("text"), model, spark))

    for train in (rows, rows.limit(0), rows.where("label = 1")):
        scored = scored_by(module.train(train)).collect()
        assert len(scored) == 6 and all(0 <= r["s"] <= 1 for r in scored)
        assert len({r["s"] for r in scored if r["doc_id"] == 3}) == 1
        assert len({r["s"] for r in scored if r["doc_id"] in (1, 2)}) == 1
    assert scored_by(module.train(rows), docs.limit(0)).count() == 0


def test_toxicity_rare_words_do_not_depend_on_the_cache(spark):
    ordinary = [(i, f"plain words here number{i} again", 0) for i in range(60)]
    rows = ordinary + [(100 + i, f"plain words zqrare{i} here", 1) for i in range(60)]
    labelled = spark.createDataFrame(rows, "key long, text string, label int")
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows] + [(500, None), (501, ""), (501, "")], "doc_id long, text string")
    ratios = []
    model = toxicity.train(labelled)
    for cache in (1 << 17, 4, 0):  # with 4, the cache holds the most common words only
        got = toxicity.score_rows(docs, model, "s", cache)
        ratios.append(sorted((r["doc_id"], r["s"]) for r in got.collect()))
    assert len(ratios[0]) == len(rows) + 3
    for other in ratios[1:]:
        assert [d for d, _ in ratios[0]] == [d for d, _ in other]
        assert max(abs(a - b) for (_, a), (_, b) in zip(ratios[0], other)) < 1e-9


def test_toxicity_counts_all_labelled_rows(spark):
    own = ["own" + chr(97 + i // 9) + chr(97 + i % 9) for i in range(80)]
    rows = spark.createDataFrame([(i, f"same words {w}", i % 2) for i, w in enumerate(own)], "key long, text string, label int")
    have = {r["head"].to_bytes(8, "big").rstrip(b"\0"): (r["toxic"], r["plain"]) for r in toxicity.train(rows).counts.collect()}
    assert all(have[w.encode()] == (i % 2, 1 - i % 2) for i, w in enumerate(own)) and have[b"same"] == (40, 40)


class Plain:
    """The models over word beginnings in plain Python."""

    def __init__(self, rows):
        self.toxic, self.plain, self.types, self.steps = Counter(), Counter(), Counter(), defaultdict(set)
        words = Counter((w, y) for text, y in rows for w in self.words(text))
        for w in {w for w, _ in words}:
            for node, parent in self.path(w):
                self.toxic[node] += words[w, 1]
                self.plain[node] += words[w, 0]
                self.types[node] += 1
                self.steps[parent].add(node)

    @staticmethod
    def words(text):
        return TOKEN.findall(bytes(c + 32 if 65 <= c < 91 else c for c in (text or "").encode()))

    @staticmethod
    def path(w):
        out, parent = [], b""
        for k in range(2, min(len(w), toxicity.DEPTH) + 1):
            out.append((w[:k], parent))
            parent = w[:k]
        return out + [(w + b" ", parent)]

    def ratio(self, w):
        total = 0.0
        for node, parent in self.path(w):
            steps = self.steps[parent]
            if node not in steps:
                continue
            back = toxicity.DISCOUNT * len(steps) / sum(self.toxic[s] + self.plain[s] for s in steps)
            shared = self.types[node] / sum(self.types[s] for s in steps)
            logs = []
            for count in (self.toxic, self.plain):
                mass = sum(max(count[s] - toxicity.DISCOUNT, 0) for s in steps)
                logs.append(math.log((1 - back) * max(count[node] - toxicity.DISCOUNT, 0) / mass + back * shared if mass > 0 else shared))
            total += logs[0] - logs[1]
        return float(np.float32(total))

    def evidence(self, text):
        r = [self.ratio(w) for w in self.words(text)]
        if not r:
            return 0.0, 0.0, 0.0
        w = min(len(r), toxicity.WINDOW)
        whole = sum(r) / len(r)
        return max(sum(r[i:i + w]) / w for i in range(len(r) - w + 1)), whole, whole * math.sqrt(len(r))


def test_toxicity_against_plain_python(spark):
    rnd = random.Random(11)
    stems = ["tox", "toxi", "toxicword", "toxicwords", "plainword", "plain", "pla", "pl", "p", "é", "été", "étérnité", "interestingly", "interesting", "to", "t"]
    words = stems + [s + rnd.choice("abcdé") * rnd.randint(0, 4) for s in stems for _ in range(3)]
    rows = []
    for i in range(160):
        y = i % 3 == 0
        pick = rnd.choices(words, [5 if y == (k % 4 == 0) else 1 for k in range(len(words))], k=rnd.randint(0, 30))
        rows.append((i, rnd.choice([" ", ", ", "-"]).join(w.title() if rnd.random() < 0.2 else w for w in pick) or None, int(y)))
    fresh = ["toxicwordsx unseen tox", "zzz", "p é t", "Interestin interestinglyé plainw", "", "1 2 3", " ".join(words), "pl " * 40 + "toxicword " * 3]
    labelled = spark.createDataFrame(rows, "key long, text string, label int")
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows] + [(1000 + i, t) for i, t in enumerate(fresh)] + [(2000, None)], "doc_id long, text string")
    model = toxicity.train(labelled)
    plain = Plain([(t, y) for _, t, y in rows])
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for cache in (1 << 20, 20, 0):
        got = {r["doc_id"]: r["evidence"] for r in toxicity.evidence(docs, model.counts, cache).collect()}
        assert got.keys() == texts.keys()
        for k, t in texts.items():
            assert np.allclose([got[k][c] for c in toxicity.FEATURES], plain.evidence(t), atol=1e-5), t
    # the calibration: a quarter is set aside, evidence comes from the others
    aside = {r["key"] for r in labelled.where(toxicity.spread(F.lit("calibrate"), F.col("key").cast("string")) % 4 == 0).collect()}
    rest = Plain([(t, y) for k, t, y in rows if k not in aside])
    x = np.array([rest.evidence(t) for k, t, _ in rows if k in aside])
    y = np.array([y for k, _, y in rows if k in aside], float)
    weights = toxicity.logistic(x, y)
    assert np.allclose(model.weights, weights, rtol=1e-3, atol=1e-3)
    scores = {r["doc_id"]: r["s"] for r in toxicity.score_rows(docs, model, "s").collect()}
    for k, t in texts.items():
        want = 1 / (1 + math.exp(-max(-35, min(35, weights[0] + np.dot(weights[1:], plain.evidence(t))))))
        assert abs(scores[k] - want) < 1e-3
