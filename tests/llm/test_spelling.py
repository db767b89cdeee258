import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from geoscore.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows):
    total = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= 2}


def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1:] == b for k in range(len(a)))


def brute(rows):
    n, forms = counted(rows), {}
    out = []
    for w in n:
        close = [v for v in n if abs(len(v) - len(w)) < 2 and near(v, w)]
        best = min(close, key=lambda v: (-n[v], v), default=None)
        forms[w] = (best if best and n[best] >= 10 * n[w] else None, len(close))
    for w, (form, n_near) in forms.items():
        root = w
        while forms[root][0]:
            root = forms[root][0]
        out.append((w, form, root, n[w], n_near, n[form] if form else None))
    return sorted(out)


def run(spark, make_docs, rows):
    docs = make_docs(rows).withColumn("word", F.lit("x")).withColumn("n", F.lit(1)).withColumn("id", F.lit(None))
    return sorted(map(tuple, spelling.variants(docs).collect()))


def edited(rnd, w, letters="abcdeé×ÿÀ"):
    k = rnd.randrange(len(w) + 1)
    return rnd.choice([w[:k] + rnd.choice(letters) + w[k:], w[:k] + w[k + 1:], w[:k] + rnd.choice(letters) + w[k + 1:]])


def corpus(seed, stems, texts=60):
    rnd = random.Random(seed)
    words = [*stems]
    for s in stems:
        for _ in range(12):
            w = edited(rnd, s)
            words += [w, edited(rnd, w)]
    weights = [400 // (k + 1) ** 2 + 1 for k in range(len(words))]
    return [(i, " ".join(rnd.choices(words, weights)[0].title() if rnd.random() < 0.2 else rnd.choices(words, weights)[0]
                         for _ in range(150)) + rnd.choice([".", "-", " 中 ", "1"])) for i in range(texts)]


ODD = [(None, "Variants variants"), (None, None), (900, None), (901, ""), (902, "中文 1234 short"), (903, "repeated Repeated"), (903, "repeated Repeated"),
       (904, "ÀÉÎõüÿ× àéîõüÿ× ÀÉÎõüÿ×")]


@pytest.mark.parametrize("hot", [20_000, 3])
def test_against_all_pairs(spark, make_docs, monkeypatch, hot):
    monkeypatch.setattr(spelling, "HOT", hot)
    rows = corpus(5, ["aaaaaaaa", "abcabcabc", "éaeaeaeae", "commonword", "commonwordes", "interesting", "aaaaaaabbbb"]) + ODD
    got = run(spark, make_docs, rows)
    assert got == brute(rows)
    assert any(r[1] for r in got) and max(r[4] for r in got) > 5


def test_chains_follow_to_the_last_form(spark, make_docs):
    sizes = {"chainworda": 4000, "chainwordab": 310, "chainwordabc": 25, "chainwordabcd": 2}
    rows = list(enumerate(w for w, n in sizes.items() for _ in range(n)))
    got = run(spark, make_docs, rows)
    assert got == brute(rows)
    assert {r[2] for r in got if r[0] in sizes} == {"chainworda"}


def test_long_words(spark, make_docs):
    """Words of many thousand letters cost labels, not levels."""
    base = "".join(random.Random(1).choice("abc") for _ in range(20000))
    other = base[:9000] + "z" + base[9001:]
    rows = [(k, t) for k, t in enumerate([base, base, base + " " + base, other, other, base[:-1], base[:-1], base[1:], base[1:]])]
    assert run(spark, make_docs, rows) == brute(rows)


def test_empty_table(spark, make_docs):
    assert run(spark, make_docs, []) == []
    assert run(spark, make_docs, [(1, None), (2, "abc"), (3, "onlyoncehere")]) == []
