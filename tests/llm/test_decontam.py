import random

import pytest
from pyspark.sql import functions as F

from geoscore.llm import decontam
from geoscore.llm.decontam import budget, clean, leaks, normal


def region_distance(item, text):
    """Least edits of the whole item against any region of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@pytest.fixture(scope="module")
def cases():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice(["th", "en", "er", "an", "é", "on"]) for _ in range(rnd.randint(1, 4)))
    say = lambda n: " ".join(word() for _ in range(n))
    items = [(i, say(rnd.randint(3, 30))) for i in range(12)] + [(12, None), (13, ""), (14, "abc"), (None, say(12)), (16, "An  Exact\nlittle")]
    items.append((17, items[0][1]))
    docs = [(0, None), (1, ""), (2, say(60)), (None, "x an exact LITTLE y"), (2, say(60))]
    for i in range(60):
        text = list(rnd.choice(items[:12])[1])
        for _ in range(rnd.randint(0, len(text) // 7)):
            p = rnd.randrange(len(text))
            text[p:p + 1] = rnd.choice([[], [text[p], "q"], ["z"], ["  "]])
        docs.append((100 + i, say(rnd.randint(0, 30)) + rnd.choice([" ", "\n", ""]) + "".join(text) + " " + say(rnd.randint(0, 30))))
    docs.append((500, say(3000) + " " + items[5][1].upper() + " " + say(3000)))
    return items, docs


def expected(items, docs):
    out = {}
    for d, t in docs:
        found = []
        for i, x in items:
            x = normal(x)
            if len(x) >= decontam.Q and len(normal(t)) < 5000:
                n = region_distance(x, normal(t))
                if n <= budget(len(x)):
                    found.append((i, n))
        out[d, t] = sorted(found, key=str)
    return out


@pytest.mark.parametrize("block_chars", [10**6, 900])
def test_leaks_against_full_alignment(spark, make_docs, cases, block_chars):
    items, docs = cases
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = leaks(make_docs(docs), bench, "found", block_chars).collect()
    want = expected(items, docs)
    assert len(got) == len(docs)
    for r in got:
        found = sorted(((h["item"], h["distance"]) for h in r["found"]), key=str)
        if r["doc_id"] == 500:
            assert (5, 0) in found
        else:
            assert found == want[r["doc_id"], r["text"]]


def test_clean_keeps_columns_and_empty_tables(spark, make_docs, cases):
    items, docs = cases
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = make_docs(docs).withColumn("leaks", F.lit("x")).withColumn("item_id", F.lit(1))
    got = clean(df, bench)
    assert got.columns == df.columns
    want = expected(items, docs)
    assert {(r["doc_id"], r["text"]) for r in got.collect()} == {k for k, v in want.items() if not v and k[0] != 500}
    assert clean(df, bench.limit(0)).count() == len(docs)
    assert clean(df.limit(0), bench).count() == 0
