import random

import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
WORDS = ["the", "of", "and", "a", "in"] + [f"w{i}" for i in range(60)]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        return spark.createDataFrame([(i, t) for i, t in rows], DOC)
    return make


def noisy_texts(seed, n, lines=(1, 5), words=(1, 14), edits=0.15, vocabulary=WORDS):
    """Random texts, many of them edited copies of earlier ones."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        if out and rnd.random() < 0.6:
            text = []
            for line in rnd.choice(out).split("\n"):
                ws = line.split(" ")
                text.append(" ".join(rnd.choice(vocabulary) if rnd.random() < edits * rnd.random() else w for w in ws))
            out.append("\n".join(text))
        else:
            out.append("\n".join(" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(*words)))
                                 for _ in range(rnd.randint(*lines))))
    return out
