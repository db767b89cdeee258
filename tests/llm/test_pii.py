import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from geoscore.llm import pii
from geoscore.llm.queries.documents import op11_pii

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def passes_luhn(digits):
    double = [int(c) * 2 for c in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d // 10 + d % 10 for d in double)) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".") if kind == "ip"),
                    "card": 16 <= len(digits) <= 19 and passes_luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def card(rnd, head="4", n=16):
    body = head + "".join(rnd.choice("0123456789") for _ in range(n - 1 - len(head)))
    return next(body + c for c in "0123456789" if passes_luhn(body + c))


def number(rnd):
    return rnd.choice([
        lambda: f"{rnd.choice(['ann', 'bo.lee', 'x_y'])}.{rnd.randrange(99):02d}@mail{rnd.randrange(9)}.example.com",
        lambda: ".".join(str(rnd.randrange(1, 256)) for _ in range(4)),
        lambda: card(rnd), lambda: " ".join(re.findall("....", card(rnd, "52"))),
        lambda: f"+1 ({rnd.randrange(200, 999)}) 555-{rnd.randrange(9999):04d}",
        lambda: f"+49 30 {rnd.randrange(10 ** 6, 10 ** 7)}"])()


def texts(seed, n):
    rnd = random.Random(seed)
    words = ["the", "of", "and", "call", "é", "中文", "order", "x1", "version", "1.2", "3"]
    return [(i, " ".join(number(rnd) if rnd.random() < 0.1 else rnd.choice(words) for _ in range(40))) for i in range(n)]


def result(spark, tmp_path, rows, name="t"):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("found", F.lit("x")).withColumn("kind", F.lit(1))
    docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    return op11_pii(spark, f"{tmp_path}/{name}").collect()


def test_base_spans_against_plain_patterns():
    rnd = random.Random(9)
    bits = ["@", ".", "a", "b-c", "1", "22", "256", "300", "0001", " ", "-", "+", "(", ")", "4111111111111111", "1.2.3.4", "é", "😀", "com", "x@y.z", "+1 555", "9" * 30]
    for _ in range(6000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25)))
        assert [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in pii.base_spans(text)] == brute(text), text


def test_query(spark, tmp_path):
    odd = [(9000, None), (9001, ""), (None, "a.b@c.de"), (9002, "a.b@c.de"), (9002, "a.b@c.de"), (9003, "😀 a.b@c.de")]
    rnd = random.Random(1)
    lost = card(rnd)
    cut = "at 71.129.171.132 " + lost + " here"
    phone = "the +1 (456) 555-2186 " + lost + " end"
    rows = texts(3, 300) + odd + [(9004, cut), (9005, phone), (9006, "call (456) 555-2186 now"), (9007, "version 1.2.3.4.5 of 12345678901234567")]
    got = {}
    for r in result(spark, tmp_path, rows):
        got.setdefault(r["doc_id"], []).append(r)
    for i, text in rows:
        r, want = got[i][0], brute(text)
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s.startswith(k) for s in want) for k in pii.KINDS]
        assert set(want) <= set(filter(None, r["spans"].split(",")))
        assert len(list(filter(None, r["spans"].split(",")))) == len(want) + r["n_added"]
    at = cut.index(lost)
    assert got[9004][0]["spans"] == f"ip:3:17,card:{at}:{at + 16}"
    at = phone.index(lost)
    assert got[9005][0]["spans"] == f"card:{at}:{at + 16},phone:4:21"
    assert len(got[9002]) == 2 and got[9007][0]["spans"] == brute(rows[-1][1])[0]


def test_no_texts_and_no_candidates(spark, tmp_path):
    assert result(spark, tmp_path, [], "none") == []
    r = result(spark, tmp_path, [(1, "no data here"), (2, None)], "clean")
    assert [x["spans"] for x in r] == ["", ""] and {x["n_added"] for x in r} == {0}


def test_reliabilities_of_known_labelers():
    """EM against labelers of known accuracy, drawn for known classes."""
    rng = np.random.default_rng(5)
    right = rng.random(20000) < 0.3
    accuracy = [0.95, 0.85, 0.75, 0.6, 0.9, 0.7]
    votes = np.stack([np.where(rng.random(20000) < 0.2, 0, np.where((rng.random(20000) < a) == right, pii.YES, pii.NO)) for a in accuracy], 1)
    patterns, back, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    p, table, share = pii.reliabilities(patterns, counts.astype(float))
    assert abs(share - 0.3) < 0.02
    for j, a in enumerate(accuracy):
        assert abs(table[1, j, pii.YES] / (table[1, j, pii.YES] + table[1, j, pii.NO]) - a) < 0.03
    odds = np.log(0.3 / 0.7) + sum(np.where(patterns[:, j] == pii.YES, 1, np.where(patterns[:, j] == pii.NO, -1, 0)) * np.log(a / (1 - a))
                                   for j, a in enumerate(accuracy))
    assert (((p > 0.5) == (odds > 0)) * counts).sum() > 0.99 * counts.sum()


def test_long_texts_take_linear_time():
    for text in ("9" * 400000, "1." * 200000, "a" * 400000 + "@", "1 " * 200000, "+1" + " " * 300000 + "(", "x@" * 150000, "1234 " * 60000, "a at b.c " * 40000 + "9"):
        pii.chosen(text, None)
