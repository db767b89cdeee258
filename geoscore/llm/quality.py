"""Quality classifier: hashed word n-grams, logistic regression, FTRL.

A text is cut into words: runs of letters (ASCII letters and all non-ASCII
bytes), of digits, or of other signs between white space. Each word counts by
its lower-cased form and by its shape (kind, case, length, whether it repeats
one of the two words before). 1- and 2-grams of forms and 1- to 3-grams of
shapes are hashed to ``2**BITS`` buckets; a feature's value is its share of
the text's n-grams of that sort, times SCALE. The model is a logistic
regression whose weights come from follow-the-regularised-leader (proximal)
updates; a score is the sigmoid of a sparse dot product.

Training reads a bounded sample: about MAX_TRAIN labelled rows (those whose
id hash is smallest), dealt to SHARDS groups, each trained in one task; the
shard weights are averaged. Scoring covers every row and whole texts.

Defined results: null and empty texts score by the intercept alone; rows with
null or other labels than 0 / 1 are not trained on; repeated rows are scored
alike; without any usable label the score is 0.5; an empty table gives an empty
result; extra columns are kept and never read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoscore.llm import hashing as H
from geoscore.llm.common import spread

BITS = 18
MAX_TRAIN = 32_768
SHARDS = 8
SCALE = 10.0
U = np.uint64

_KIND = np.full(256, 3, np.uint8)  # other signs
_KIND[H.SPACE_BYTES] = 0
_KIND[48:58] = 2
for _lo, _hi in ((65, 91), (97, 123), (128, 256)):
    _KIND[_lo:_hi] = 1
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, bucket, value) of every n-gram occurrence of a batch of texts."""
    data, off = H.text_bytes(column)
    n_docs = len(column)
    kind = _KIND[data]
    new = np.ones(len(data), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[off[(off > 0) & (off < len(data))]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(data))
    word = kind[starts] != 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[word], ends[word]
    doc = np.searchsorted(off, starts, "right") - 1
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    h = H.span_hashes(H.LOWER[data], starts, ends)
    capitals = np.concatenate([[0], np.cumsum(_UPPER[data])])
    capitals = capitals[ends] - capitals[starts]
    length = ends - starts
    case = np.where(capitals == 0, 0, np.where(capitals == length, 1, np.where(capitals == 1, 2, 3)))
    repeat = np.zeros(len(h), np.int64)
    for back in (1, 2):
        same = (h[back:] == h[:-back]) & (doc[back:] == doc[:-back])
        repeat[back:] |= same.astype(np.int64)
    shape = H.mix((((kind[starts].astype(np.int64) * 4 + case) * 2 + repeat) * 16 + np.minimum(length, 15)).astype(U))
    docs, buckets, values = [], [], []
    for seq, sizes, salt in ((h, (1, 2), 11), (shape, (1, 2, 3), 29)):
        for n in sizes:
            m = len(seq) - n + 1
            if m <= 0:
                continue
            g = np.full(m, U(salt + n))
            for j in range(n):
                g = H.mix(g * U(0x9E3779B97F4A7C15) + seq[j: j + m])
            inside = doc[:m] == doc[n - 1:]
            d = doc[:m][inside]
            docs.append(d)
            buckets.append((g[inside] >> U(64 - BITS)).astype(np.int64))
            values.append(SCALE / np.bincount(d, minlength=n_docs)[d])
    return np.concatenate(docs), np.concatenate(buckets), np.concatenate(values)


def _rows(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: its distinct buckets and their values."""
    out = []
    for i in range(len(column)):
        _, b, v = features(column.slice(i, 1))
        ids, pos = np.unique(b, return_inverse=True)
        out.append((ids.astype(np.int32), np.bincount(pos, weights=v, minlength=len(ids)) if len(ids) else np.zeros(0)))
    return out


def ftrl(rows: list, labels: np.ndarray, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """Weights after FTRL-proximal passes over the rows; the last is the intercept."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    one = np.array([size - 1])

    def weights(idx):
        zi = z[idx]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[idx])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    for _ in range(epochs):
        for (ids, vals), y in zip(rows, labels):
            idx, x = np.concatenate([ids, one]), np.append(vals, 1.0)
            w = weights(idx)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            step = (np.sqrt(n[idx] + g * g) - np.sqrt(n[idx])) / alpha
            z[idx] += g - step * w
            n[idx] += g * g
    return weights(np.arange(size))


def train(labelled: DataFrame, max_train: int = MAX_TRAIN, epochs: int = 3, alpha: float = 0.3,
          beta: float = 1.0, l1: float = 0.01, l2: float = 0.1) -> np.ndarray:
    """Fit on ``labelled`` (key, text, label 0/1); returns the weight vector.

    What comes to the driver is SHARDS vectors of ``2**BITS + 1`` numbers."""
    usable = labelled.where(F.col("label").isin(0, 1))
    total = usable.count()
    if not total:
        return np.zeros((1 << BITS) + 1)
    h = F.xxhash64(F.lit("sample"), F.col("key").cast("string"))
    share = min(1.0, max_train / total)
    sample = usable if share == 1 else usable.where(h.bitwiseAND(F.lit((1 << 62) - 1)) < int(share * (1 << 62)))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "key", "text"], na_position="first")
        rows = _rows(pa.array(pdf["text"], pa.large_string(), from_pandas=True))
        w = ftrl(rows, pdf["label"].to_numpy(), epochs, alpha, beta, l1, l2)
        return pd.DataFrame({"w": [w.astype(np.float32).tobytes()], "rows": [len(pdf)]})

    shards = (sample.select("key", "text", "label", F.xxhash64("key", "text").alias("order"),
                            (spread(F.lit("shard"), F.col("key")) % SHARDS).alias("shard"))
              .groupBy("shard").applyInPandas(fit, "w binary, rows long").collect())
    parts = np.array([np.frombuffer(r["w"], np.float32) for r in shards], float)
    return np.average(parts, axis=0, weights=[r["rows"] for r in shards])


def score(text: Column, weights: np.ndarray, spark) -> Column:
    """Probability of label 1 for each text (double in 0..1)."""
    model = spark.sparkContext.broadcast(weights.astype(np.float32))

    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        w = model.value
        out = []
        for part in H.slices(pa.record_batch([column], ["t"]), "t"):
            d, b, v = features(part.column(0))
            out.append(np.bincount(d, weights=w[b] * v, minlength=len(part)) + w[-1])
        total = np.concatenate(out) if out else np.zeros(0)
        return pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))

    return run(text)
