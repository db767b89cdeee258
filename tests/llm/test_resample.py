import hashlib
import math
import re
import zlib

import duckdb
from pyspark.sql import functions as F

from geoscore.llm import resample
from geoscore.llm.queries import ORACLES
from geoscore.llm.queries.documents import op13_resampling

from .conftest import noisy_texts

SF_SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])], len(w)


def bucket(f):
    return zlib.crc32(f.encode()) % 10000


def brute(rows, target, percent, least, seed):
    s, t = [0] * 10000, [0] * 10000
    for _, text in rows:
        for f in features(text)[0]:
            s[bucket(f)] += 1
    for text in target:
        for f in features(text)[0]:
            t[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10000) / ((a + 1) * (sum(t) + 10000)))) for a, b in zip(s, t)]
    out = []
    for i, text in rows:
        fs, n_words = features(text)
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words >= least))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[: percent * len(able) // 100]
    res = [(*r[:4], k + 1) for k, r in enumerate(drawn)]
    rest = list(out)
    for r in drawn:
        rest.remove(r)
    return sorted(res + [(*r[:4], None) for r in rest], key=str)


def run(spark, make_docs, rows, target, **kw):
    docs = make_docs(rows).withColumn("rank", F.lit("x")).withColumn("score", F.lit(None)).withColumn("w", F.lit(1))
    t = spark.createDataFrame([(x,) for x in target], "text string")
    return sorted(map(tuple, resample.resample(docs, t, **kw).collect()), key=str)


ODD = [(5000, None), (5001, ""), (5002, "!!! --"), (None, "a b c d e f"), (5003, "É9 " * 30), (5004, "x" * 3000 + " " + "yé" * 200 + " z"),
       (5005, "A\u0000b " * 20), (7, "a b c d e"), (7, "a b c d e"), (7, "a b c d e")]


def test_against_plain_python(spark, make_docs):
    rows = list(enumerate(noisy_texts(4, 150))) + ODD
    target = ["the of w1 w2 W3", None, "", "É9 É9 and a in", "the the the"]
    for percent, least, seed in ((25, 3, 7), (100, 1, 1), (60, 5, 2), (1, 100, 3)):
        got = run(spark, make_docs, rows, target, percent=percent, least_words=least, seed=seed)
        assert got == brute(rows, target, percent, least, seed)


def test_ties_at_the_cut(spark, make_docs, monkeypatch):
    """One seed number for all and one text for most: the score ties, ids decide."""
    monkeypatch.setattr(resample, "gumbel", lambda doc_id, seed: F.lit(5).cast("long"))
    rows = [(i, "the of and") for i in (9, 3, 8, 1, 7, 2, 6, 4, 5)] + [(3, "the of and"), (None, "the of and"), (20, "w1 w2 w3")]
    got = run(spark, make_docs, rows, ["w1 w2"], percent=50, least_words=3)
    assert [(r[0], r[4]) for r in sorted(got, key=lambda r: r[4] or 99) if r[4]] == [(20, 1), (1, 2), (2, 3), (3, 4), (3, 5), (4, 6)]
    got = run(spark, make_docs, rows, ["w1 w2"], percent=34, least_words=3)
    assert [(r[0], r[4]) for r in sorted(got, key=lambda r: r[4] or 99) if r[4]] == [(20, 1), (1, 2), (2, 3), (3, 4)]


def test_long_text(spark, make_docs):
    rows = [(1, "the of and w1 w2 " * 300000), (2, "the of")]
    assert run(spark, make_docs, rows, ["w1"], percent=100, least_words=1) == brute(rows, ["w1"], 100, 1, 7)


def test_empty_tables(spark, make_docs):
    assert run(spark, make_docs, [], ["a"]) == []
    rows = [(1, "the of and " * 10), (2, None)]
    assert run(spark, make_docs, rows, [], percent=100) == brute(rows, [], 100, 20, 7)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    res = con.execute(ORACLES["op13_resampling"])
    names = [d[0] for d in res.description]
    assert sorted(map(tuple, op13_resampling(spark, SF_SMALL).select(*names).collect()), key=str) == sorted(res.fetchall(), key=str)
