"""Target-distribution importance resampling of documents.

Features are the runs of one and two consecutive words of a text, hashed to
BUCKETS buckets by CRC-32. One job counts the buckets of the corpus and of the
target texts (at most BUCKETS rows a task and side, summed by Spark). The
bucket gains, a fixed-size array, are broadcast, and a document's weight is
read off that array; a seeded Gumbel number drawn from its id is added, so the
highest scores are a weighted draw without replacement.

The cut between drawn and undrawn documents is found by bisecting the score
range: each round is one exact count job over the written scores, and tests
PROBES thresholds at once. Documents that tie at the cut are bisected by their
id in the same way. Only drawn rows are then range-partitioned for ranks.

Defined results: a null or empty text has no features, weight 0 and is never
drawn, nor is one with fewer than ``least_words`` words; without target texts
the target counts are 0; a null id counts as empty text in the draw and loses
ties; rows that share id and score are drawn in any order, each row once; an
empty table gives an empty result; very long texts are counted whole, one at a
time if need be; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoscore.llm import crc
from geoscore.llm import hashing as H
from geoscore.llm.common import written
from geoscore.operators.ranking import numbered

BUCKETS = 10_000
PROBES = 15  # thresholds tried by one count job: four halvings of the range
SLICE = 512 << 10

# Fixed value: the bytes of words (0-9, a-z and all of non-ASCII characters).
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_SPACE = np.array([0x20], np.uint8)
LAST_ID = (1 << 63) - 1


def feature_buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and document index of every feature of a batch of texts, and the
    number of words of each text."""
    data, off = H.text_bytes(column)
    data = H.LOWER[data]
    a, b = H._split_runs(WORD[data], off)
    doc = np.searchsorted(off, a, "right") - 1
    one = crc.span_crc(data, a, b)
    pair = doc[1:] == doc[:-1]
    space = crc.span_crc(_SPACE, np.zeros(1, np.int64), np.ones(1, np.int64))
    left = crc.joined(one[:-1][pair], space, np.ones(int(pair.sum()), np.int64))
    two = crc.joined(left, one[1:][pair], (b - a)[1:][pair])
    return (np.concatenate([one, two]) % BUCKETS, np.concatenate([doc, doc[1:][pair]]),
            np.bincount(doc, minlength=len(column)))


def bucket_counts(sides: list[DataFrame]) -> list[np.ndarray]:
    """Features in each bucket over all texts of each table (column ``text``)."""
    size = len(sides) * BUCKETS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            side = batch.column(0).to_numpy(zero_copy_only=False)
            for k in np.unique(side):
                chosen = batch.filter(pa.array(side == k))
                for part in H.slices(chosen, "text", SLICE):
                    bucket, _, _ = feature_buckets(part.column(1))
                    total[k * BUCKETS: (k + 1) * BUCKETS] += np.bincount(bucket, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[at])], ["at", "n"])

    both = None
    for k, texts in enumerate(sides):
        part = texts.select(F.lit(k).alias("side"), F.col("text").cast("string").alias("text"))
        both = part if both is None else both.unionAll(part)
    rows = both.mapInArrow(count, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(size, np.int64)
    for r in rows:
        out[r["at"]] = r["n"]
    return list(out.reshape(len(sides), BUCKETS))


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored 1000-fold log ratio of the smoothed bucket shares."""
    top, low = float(int(source.sum()) + BUCKETS), float(int(target.sum()) + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1) * top / ((s + 1) * low)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weights(text: Column, gain: np.ndarray, spark) -> Column:
    """(n_words, n_features, weight) of each text."""
    table = spark.sparkContext.broadcast(gain)
    names = ["n_words", "n_features", "weight"]

    @F.arrow_udf("struct<n_words:long,n_features:long,weight:long>")
    def run(column: pa.Array) -> pa.Array:
        out = [np.zeros((0, 3), np.int64)]
        for part in H.slices(pa.record_batch([column], ["t"]), "t", SLICE):
            bucket, doc, n_words = feature_buckets(part.column(0))
            n = np.bincount(doc, minlength=len(part))
            total = np.zeros(len(part), np.int64)
            np.add.at(total, doc, table.value[bucket])
            out.append(np.stack([n_words, n, total // np.maximum(n, 1)], 1))
        cols = np.concatenate(out)
        return pa.StructArray.from_arrays([pa.array(cols[:, k].astype(np.int64)) for k in range(3)], names)

    return run(text)


def gumbel(doc_id: Column, seed: int) -> Column:
    """Seeded floored 1000-fold Gumbel number of an id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def _least(rows: DataFrame, test, lo: int, hi: int, need: int) -> int:
    """The least v in [lo, hi] for which at least ``need`` rows pass
    ``test(v)``, a condition that only gains rows as v grows; known to hold at
    ``hi``. One exact count job for every PROBES thresholds."""
    while lo < hi:
        steps = sorted({lo + (hi - lo) * k // (PROBES + 1) for k in range(PROBES + 1)})
        counts = rows.agg(*[F.count_if(test(v)).alias(f"c{k}") for k, v in enumerate(steps)]).first()
        good = [v for k, v in enumerate(steps) if counts[k] >= need]
        bad = [v for k, v in enumerate(steps) if counts[k] < need]
        lo, hi = (bad[-1] + 1 if bad else lo), (good[0] if good else hi)
    return lo


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of each row
    of ``docs`` (doc_id, text), resampled towards ``target`` (text)."""
    spark = docs.sparkSession
    source_n, target_n = bucket_counts([docs, target])
    w = F.col("w")
    scored = written(
        docs.select("doc_id", weights(F.col("text").cast("string"), gains(source_n, target_n), spark).alias("w"))
        .select("doc_id", w["n_words"].alias("n_words"), w["n_features"].alias("n_features"), w["weight"].alias("weight"),
                (w["weight"] + gumbel(F.col("doc_id"), seed)).alias("score")), "resample")
    able = scored.where(F.col("n_words") >= least_words)
    n, low, high = able.agg(F.count(F.lit(1)), F.min("score"), F.max("score")).first()
    draw = percent * n // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if not draw:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    score, key = F.col("score"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    cut = -_least(able, lambda v: score >= -v, -high, -low, draw)
    above, first, last = able.where(score >= cut).agg(
        F.count_if(score > cut), F.min(F.when(score == cut, key)), F.max(F.when(score == cut, key))).first()
    last = _least(able.where(score == cut), lambda v: key <= v, first, last, draw - above)
    chosen = (F.col("n_words") >= least_words) & ((score > cut) | ((score == cut) & (key <= last)))
    ranked = numbered(scored.where(chosen).select(*columns), [score.desc(), key], "rank")
    # rows that repeat one id and score may pass the draw's end together
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    rest = scored.where(~chosen).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, "rank").unionAll(rest)
