"""Toxicity by class-conditional Kneser-Ney models.

Words are runs of letters in lower case. Both classes, toxic and ordinary,
write a word from left to right: its first two bytes, each further byte up to
DEPTH, then the rest as a whole. After each beginning h, the next step x has
probability

    (1 - back(h)) * max(count_class(h x) - D, 0) / mass_class(h) + back(h) * shared(x | h)

where shared(x | h) is the Kneser-Ney continuation estimate, the share of the
different words beginning with h that go on with x, counted over both classes
together, and back(h) = D * kinds of x / count(h) also comes from the pooled
counts. A rare word so falls back on what is known of its beginning, and
where nothing is known both classes give the same and the step tells nothing.

A text's evidence is the log-likelihood ratio of its words, normalised by the
length: that of the strongest WINDOW words, that of the whole text by its
number of words, and by the root of it. A logistic regression on these three,
fitted on a sample of labelled rows that a first model leaves out of its
counts, turns it into a score between 0 and 1.

How it runs:

1. All labelled training rows are counted, so what is gathered grows with the
   input: words are counted within batches, then summed by a shuffle.
2. The distinct words of the texts to score are counted in the same way.
3. A word is known by its hash and its first DEPTH bytes, one number. Counts
   are rolled up to the beginnings of 8, 6, 4 and 2 bytes. From the top down,
   the beginnings of two more bytes are dealt by the shorter one, so a group has
   at most as many rows as there are pairs of bytes, and a task rates all steps
   of its groups with numpy; the steps that end longer words need only sums
   over each 8-byte beginning. Every word asked for, seen in training or not,
   gets the sum of its steps.
4. The ratios of the most frequent words (CACHE at most) are broadcast. A pass
   over the texts adds up their words' ratios. Of the other, rare words only
   the stretches around them leave the texts: their neighbours' ratios and
   their hashes, which meet the rest of the ratios by a join and come back as
   one list a text. The cache's size doesn't change a result.

Scoring reads every row and whole texts. Calibration collects three numbers
for each of about MAX_CALIBRATION rows.

Defined results: null and empty texts have no evidence (all features 0);
null or other labels are not learnt from; with labels of one class only, every
score is that class's share; repeated rows score alike; an empty table gives
an empty result; very long texts are read whole, a rare word of theirs sends
2 * WINDOW numbers at most; other columns are kept and not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoscore.llm import hashing as H
from geoscore.llm.common import forget, lookup, shuffle_partitions, spread, written

U = np.uint64
CACHE = 1 << 21
DISCOUNT = 0.9
DEPTH = 8
WINDOW = 8
MAX_CALIBRATION = 40_000
FEATURES = ["window", "whole", "root"]
COUNTS = ["toxic", "plain", "types"]
SUMS = ["mass_t", "mass_p", "kinds", "all_counts", "all_types"]
TIER_ROWS = 1 << 18  # rows of beginnings in a task

_LETTER = np.zeros(256, bool)
for _lo, _hi in ((65, 91), (97, 123), (128, 256)):
    _LETTER[_lo:_hi] = True


def words(column: pa.Array):
    """(lower-case bytes, starts, ends, doc) of the words of a batch of texts."""
    data, off = H.text_bytes(column)
    starts, ends = H._split_runs(_LETTER[data], off)
    return H.LOWER[data], starts, ends, np.searchsorted(off, starts, "right") - 1


def packed(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first DEPTH bytes of each word as one number, padded with zeros."""
    out = np.zeros(len(a), U)
    for k in range(DEPTH):
        at = np.minimum(a + k, len(data) - 1)
        out = (out << U(8)) | np.where(a + k < b, data[at], 0).astype(U)
    return out


def word_sums(rows: DataFrame, classes: int) -> DataFrame:
    """(hash, head, long, n0, n1...): how often each word occurs in the texts of
    each class; head: its first DEPTH bytes, long: whether it has that many or
    more; rows: text, class. Added up within a batch of texts first."""
    names = [f"n{k}" for k in range(classes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for part in H.slices(batch, "text"):
                data, a, b, d = words(part.column("text"))
                h, at, which = np.unique(H.span_hashes(data, a, b), return_index=True, return_inverse=True)
                kind = part.column("class").to_numpy(zero_copy_only=False)[d].astype(np.int64)
                n = np.bincount(which * classes + kind, minlength=len(h) * classes).reshape(-1, classes)
                found.append((h, packed(data, a[at], b[at]), (b - a)[at] >= DEPTH, n))
            if not found:
                continue
            h, head, long, n = map(np.concatenate, zip(*found))
            h, one, which = np.unique(h, return_index=True, return_inverse=True)
            total = [np.bincount(which, weights=n[:, k], minlength=len(h)).astype(np.int64) for k in range(classes)]
            yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(head[one].view(np.int64)), pa.array(long[one]), *map(pa.array, total)],
                                  ["hash", "head", "long", *names])

    counted = rows.select("text", "class").mapInArrow(run, f"hash long, head long, long boolean, {', '.join(c + ' long' for c in names)}")
    return counted.groupBy("hash", "head", "long").agg(*(F.sum(c).alias(c) for c in names))


@dataclass
class Model:
    """``counts``: (hash, head, long, toxic, plain) of the training rows' words;
    ``weights``: intercept and features of the calibration."""

    counts: DataFrame
    weights: np.ndarray


def _ratio(toxic, plain, types, mass_t, mass_p, kinds, n, all_types, lib):
    """Log-likelihood ratio of a step with these counts, in a context with
    these sums over its steps: discounted counts of both classes, kinds of
    steps, counts, different words. ``lib``: where, log, maximum."""
    back = kinds * DISCOUNT / n
    shared = types / all_types

    def chance(count, mass):
        kept = (1 - back) * lib.maximum(count - DISCOUNT, 0.0) / lib.where(mass > 0, mass, 1.0)
        return lib.where(mass > 0, kept + back * shared, shared)

    return lib.log(chance(toxic, mass_t)) - lib.log(chance(plain, mass_p))


class _Columns:
    """``_ratio`` over Spark columns."""

    @staticmethod
    def where(test, yes, no):
        return F.when(test, yes).otherwise(no)

    @staticmethod
    def maximum(x, y):
        return F.greatest(x, F.lit(y))

    log = staticmethod(F.log)


def _cut(head, k: int):
    """The first ``k`` of DEPTH bytes."""
    return head & U(((1 << 8 * k) - 1) << 8 * (DEPTH - k))


def _steps(head: np.ndarray, counts: np.ndarray, base: np.ndarray, low: int, high: int) -> np.ndarray:
    """``base`` plus the ratios of the steps from ``low`` bytes to ``high``, and
    of the step that ends a word of fewer bytes than ``high``. ``head``: the
    beginnings of ``high`` bytes and shorter words, ``counts``: their (toxic,
    plain, types), all of them that share their first ``low`` bytes."""
    size = sum((_cut(head, k) != _cut(head, k - 1)).astype(np.int64) for k in range(1, high + 1))
    out = base.copy()
    seen = counts[:, 0] + counts[:, 1] > 0
    for m in range(low, high):
        if m == 1:
            continue  # words start with two bytes at once, or one
        deeper = m + 1 if m else 2
        inner = size >= deeper
        ends = (size == m) if m else (size == 1)
        node, at = np.unique(_cut(head[inner], deeper), return_inverse=True)
        sums = np.stack([np.bincount(at, weights=counts[inner, c], minlength=len(node)) for c in range(3)], 1)
        last = ends & seen
        # a context's steps: the longer beginnings, and the end of the word itself
        parent = np.concatenate([_cut(node, m), _cut(head[last], m)])
        step = np.concatenate([sums, counts[last]])
        there = step[:, 0] + step[:, 1] > 0
        parent, step = parent[there], step[there]
        context, of = np.unique(parent, return_inverse=True)
        left = np.maximum(step[:, :2] - DISCOUNT, 0)
        total = [np.bincount(of, weights=w, minlength=len(context))
                 for w in (left[:, 0], left[:, 1], np.ones(len(of)), step[:, 0] + step[:, 1], step[:, 2])]
        r = _ratio(*step.T, *(t[of] for t in total), np)
        rated = np.zeros(len(there))
        rated[there] = r
        out[inner] += rated[:len(node)][at]
        out[last] += rated[len(node):]
    return out


def _tier(rows: DataFrame, size: int, low: int, high: int) -> DataFrame:
    """(head, base): ``rows`` (head, toxic, plain, types, base, part; ``size`` of
    them at most) rated from ``low`` to ``high`` bytes; ``part``: what they are
    dealt by."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[b.column(c).to_numpy() for c in ("head", "toxic", "plain", "types", "base")] for b in batches if b.num_rows]
        if held:
            head, *counts, base = map(np.concatenate, zip(*held))
            base = _steps(head.view(U), np.stack(counts, 1).astype(float), base, low, high)
            yield pa.record_batch([pa.array(head), pa.array(base)], ["head", "base"])

    parts = max(shuffle_partitions(rows.sparkSession), -(-size // TIER_ROWS))
    return rows.repartition(parts, "part").select("head", "toxic", "plain", "types", "base").mapInArrow(run, "head long, base double")


def rated(counts: DataFrame, asked: DataFrame) -> DataFrame:
    """(hash, n, ratio) of the words ``asked`` (hash, head, long, n) by the model
    of ``counts`` (hash, head, long, toxic, plain)."""
    none = F.lit(0).cast("long")
    one = (counts.select("hash", "head", "long", "toxic", "plain", none.alias("n"))
           .unionAll(asked.select("hash", "head", "long", none.alias("toxic"), none.alias("plain"), "n"))
           .groupBy("hash", "head", "long").agg(*(F.sum(c).alias(c) for c in ("toxic", "plain", "n"))))
    one = written(one.withColumn("types", (F.col("toxic") + F.col("plain") > 0).cast("long")), "toxic-words")

    def cut(k: int) -> Column:
        return F.col("head").bitwiseAND(F.lit(int(np.array([_cut(U((1 << 64) - 1), k)]).view(np.int64)[0])))

    # counts of all beginnings of 8, 6, 4 and 2 bytes, shorter words among them
    levels, rows = {}, one
    for k in range(DEPTH, 0, -2):
        rows = written(rows.withColumn("head", cut(k)).groupBy("head").agg(*(F.sum(c).alias(c) for c in COUNTS)), "toxic-heads")
        levels[k] = rows
    base = None
    for k in range(2, DEPTH + 1, 2):
        # words that end further up are rated; the others go on from their shorter beginning
        part = cut(k - 2)
        rows = levels[k].withColumn("part", part)
        if base is None:
            rows, done = rows.withColumn("base", F.lit(0.0)), None
        else:
            ended = _ends_before(k - 2)
            rows = rows.where(~ended).join(lookup(base.withColumnRenamed("head", "part")), "part")
            done = base.where(ended)
        found = written(_tier(rows, levels[k].count(), k - 2, k), "toxic-base")
        if base is not None:
            found_all = written(found.unionAll(done), "toxic-base")
            forget(found)
            forget(base)
            found = found_all
        base = found
        forget(levels[k])
    # the end of a word of DEPTH bytes or more, in the context of these
    left = [F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) for c in ("toxic", "plain")]
    ends = (one.where("long AND types > 0").groupBy("head")
            .agg(*(F.sum(v).alias(c) for v, c in zip((*left, F.lit(1.0), F.col("toxic") + F.col("plain"), F.col("types")), SUMS))))
    last = F.when(F.col("long") & (F.col("types") > 0), _ratio(*(F.col(c).cast("double") for c in COUNTS), *(F.col(c).cast("double") for c in SUMS), _Columns))
    # single precision, so that sums of some of them are the same in any order
    ratio = (F.col("base") + F.coalesce(last, F.lit(0.0))).cast("float")
    out = written(one.where("n > 0").join(base.join(ends, "head", "left"), "head").select("hash", "n", ratio.alias("ratio")), "toxic-ratios")
    forget(one)
    forget(base)
    return out


def _ends_before(k: int) -> Column:
    """The word has fewer than ``k`` bytes."""
    return F.shiftright("head", 8 * (DEPTH - k)).bitwiseAND(F.lit(255)) == 0


def _cached(ratios: DataFrame, most: int) -> tuple[tuple[np.ndarray, np.ndarray], DataFrame | None]:
    """Hashes and ratios of the most frequent words, ``most`` at most; and the
    (hash, ratio) of the others, if there are any."""
    level = F.when(F.col("n") < 64, F.col("n")).otherwise(64 + F.floor(F.log2("n")))  # 128 levels at most
    sizes = ratios.groupBy(level.cast("int").alias("level")).count().orderBy(F.desc("level")).collect()
    cut, total = 1 << 30, 0
    for r in sizes:
        total += r["count"]
        if total > most:
            break
        cut = r["level"]
    got = ratios.where(level >= cut).select("hash", "ratio").toArrow()
    h, r = got["hash"].to_numpy().view(U), got["ratio"].to_numpy()
    order = np.argsort(h)
    return (h[order], r[order]), (ratios.where(level < cut).select("hash", "ratio") if total > most else None)


def _summed(column: pa.Array, cache: tuple[np.ndarray, np.ndarray]) -> list[pa.Array]:
    """Of each text: its number of words, the sum of the known ratios, the best
    mean of a window without rare words, and the stretches of the windows with
    some: ratios (NaN for rare words), and the rare words' places and hashes."""
    data, a, b, d = words(column)
    n_docs = len(column)
    h = H.span_hashes(data, a, b)
    known, ratios = cache
    pos = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
    hit = known[pos] == h if len(known) else np.zeros(len(h), bool)
    ratio = np.where(hit, ratios[pos], np.float32(np.nan)).astype(np.float32) if len(known) else np.full(len(h), np.nan, np.float32)
    n = np.bincount(d, minlength=n_docs)
    end = np.cumsum(n)
    start = end - n
    total = np.concatenate([[0], np.cumsum(np.where(hit, ratio, 0).astype(float))])
    lost = np.concatenate([[0], np.cumsum(~hit)])
    place = np.arange(len(h))
    stop = np.minimum(place + WINDOW, end[d])
    inside = (stop - place == WINDOW) | (place == start[d])
    bare = lost[stop] > lost[place]
    mean = np.where(inside & ~bare, (total[stop] - total[place]) / np.minimum(WINDOW, n[d]), -np.inf)
    best = np.full(n_docs, -np.inf)
    some = np.flatnonzero(n)
    if len(some):
        best[some] = np.maximum.reduceat(mean, start[some])
    open_ = inside & bare
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, place[open_], 1)
    np.add.at(cover, stop[open_], -1)
    sa, sb = H._split_runs(np.cumsum(cover[:-1]) > 0, np.append(start, len(h)))
    lens = sb - sa
    ends = np.concatenate([[0], np.cumsum(lens)])
    at = np.repeat(sa - ends[:-1], lens) + np.arange(ends[-1])
    rare = np.flatnonzero(~hit)
    of = np.searchsorted(sa, rare, "right") - 1
    gaps = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(sa)))]), pa.int32())
    stretches = pa.StructArray.from_arrays([
        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ratio[at])),
        pa.ListArray.from_arrays(gaps, pa.array((rare - sa[of]).astype(np.int32))),
        pa.ListArray.from_arrays(gaps, pa.array(h[rare].view(np.int64)))], ["ratios", "at", "hash"])
    per_doc = np.concatenate([[0], np.cumsum(np.bincount(d[sa], minlength=n_docs))]) if len(sa) else np.zeros(n_docs + 1, np.int64)
    sums = total[end] - total[start]
    return [pa.array(n), pa.array(sums), pa.array(best), pa.ListArray.from_arrays(pa.array(per_doc, pa.int32()), stretches)]


STRETCHES = "array<struct<ratios:array<float>,at:array<int>,hash:array<long>>>"


@F.arrow_udf(T.StructType([T.StructField("total", T.DoubleType()), T.StructField("best", T.DoubleType())]))
def _completed(stretches: pa.Array, rare: pa.Array) -> pa.Array:
    """Sum of the rare words' ratios and the best window of the stretches."""
    totals, bests = [], []
    for parts, found in zip(stretches.to_pylist(), rare.to_pylist()):
        total, best = 0.0, -np.inf
        values = [np.array(p["ratios"], float) for p in parts or []]
        for f in sorted(found or [], key=lambda f: (f["part"], f["at"])):
            values[f["part"]][f["at"]] = f["ratio"]
            total += f["ratio"]
        for v in values:
            sums = np.concatenate([[0], np.cumsum(v)])
            w = min(WINDOW, len(v))
            best = max(best, float(((sums[w:] - sums[:-w]) / w).max()))
        totals.append(total)
        bests.append(best)
    return pa.StructArray.from_arrays([pa.array(totals, pa.float64()), pa.array(bests, pa.float64())], ["total", "best"])


def evidence(rows: DataFrame, counts: DataFrame, cache: int | None = None) -> DataFrame:
    """``rows`` without their ``text``, with struct column ``evidence`` (window,
    whole, root) by the model of ``counts``."""
    asked = written(word_sums(rows.select("text", F.lit(0).alias("class")), 1).withColumnRenamed("n0", "n"), "toxic-asked")
    ratios = rated(counts, asked)
    forget(asked)
    table, rest = _cached(ratios, CACHE if cache is None else cache)
    shared = rows.sparkSession.sparkContext.broadcast(table)
    kept = [c for c in rows.columns if c != "text"]
    names = [f"c{i}" for i in range(len(kept))]
    kinds = [f.dataType.simpleString() for f in rows.select(*kept).schema] if kept else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in H.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *_summed(part.column("text"), shared.value)],
                                                 names=[*names, "n", "total", "best", "stretches"])

    schema = "".join(f"{c} {k}, " for c, k in zip(names, kinds)) + f"n long, total double, best double, stretches {STRETCHES}"
    known = written(rows.select(*(F.col(c).alias(a) for c, a in zip(kept, names)), F.col("text").cast("string").alias("text"))
                    .mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "toxic-known")
    if rest is not None:
        asking = (known.select("row", F.posexplode("stretches").alias("part", "s"))
                  .select("row", "part", F.explode(F.arrays_zip("s.at", "s.hash")).alias("z")).select("row", "part", "z.at", "z.hash"))
        answers = (asking.join(rest, "hash").groupBy("row")
                   .agg(F.collect_list(F.struct("part", "at", "ratio")).alias("rare")))
        known = (known.join(answers, "row", "left").withColumn("more", _completed("stretches", "rare"))
                 .withColumn("total", F.col("total") + F.col("more.total")).withColumn("best", F.greatest("best", "more.best")))
    n = F.col("n")
    whole = F.when(n > 0, F.col("total") / n).otherwise(0.0)
    found = F.struct(F.when(n > 0, F.col("best")).otherwise(0.0).alias("window"), whole.alias("whole"), (whole * F.sqrt(n)).alias("root"))
    return known.select(*(F.col(a).alias(c) for c, a in zip(kept, names)), found.alias("evidence"))


def logistic(x: np.ndarray, y: np.ndarray, turns: int = 50, ridge: float = 1e-3) -> np.ndarray:
    """Newton steps for a logistic regression with intercept."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def train(labelled: DataFrame) -> Model | float:
    """Model from rows (key, text, label 0/1). A sample of a quarter of the
    rows, about MAX_CALIBRATION at most, calibrates a model of the others; then
    all rows count. Returns the label's share if a class is missing."""
    usable = labelled.where(F.col("label").isin(0, 1)).select("key", "text", F.col("label").cast("int").alias("label"))
    part = spread(F.lit("calibrate"), F.col("key").cast("string"))
    rows = usable.where(part % 4 == 0).count()
    share = max(1, -(-rows // MAX_CALIBRATION))
    aside = (part % 4 == 0) & (F.floor(part / 4) % share == 0)
    sums = written(word_sums(usable.select("text", (F.col("label") + F.when(aside, 2).otherwise(0)).alias("class")), 4), "toxic-counts")
    n = sums.agg(*(F.coalesce(F.sum(f"n{k}"), F.lit(0)).alias(f"n{k}") for k in range(4))).first()
    every = sums.select("hash", "head", "long", (F.col("n1") + F.col("n3")).alias("toxic"), (F.col("n0") + F.col("n2")).alias("plain"))
    if not n["n1"] + n["n3"] or not n["n0"] + n["n2"]:
        return float(usable.agg(F.avg("label")).first()[0] or 0.0)
    weights = np.array([-2.0, 2.0, 0.0, 0.0])
    if n["n1"] and n["n0"]:
        others = sums.where(F.col("n0") + F.col("n1") > 0).select("hash", "head", "long", F.col("n1").alias("toxic"), F.col("n0").alias("plain"))
        got = (evidence(usable.where(aside).select("label", "text"), others).select("label", "evidence.*")
               .toArrow().to_pandas().sort_values(["label", *FEATURES]))
        y = got["label"].to_numpy(float)
        if len(y) and 0 < y.mean() < 1:
            weights = logistic(got[FEATURES].to_numpy(float), y)
    return Model(every, weights)


def score_rows(rows: DataFrame, model: Model | float, result: str, cache: int | None = None) -> DataFrame:
    """``rows`` without their ``text``, with the probability (double in 0..1)
    that the text is toxic as column ``result``."""
    if isinstance(model, float):
        return rows.drop("text").withColumn(result, F.lit(model))
    w = [F.lit(float(x)) for x in model.weights]
    found = evidence(rows, model.counts, cache)
    logit = w[0] + sum((x * F.col(f"evidence.{c}") for x, c in zip(w[1:], FEATURES)), F.lit(0.0))
    clipped = F.greatest(F.lit(-35.0), F.least(F.lit(35.0), logit))
    return found.withColumn(result, 1 / (1 + F.exp(-clipped))).drop("evidence")
