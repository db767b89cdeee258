"""Exact near-duplicate join of documents on word shingles (Jaccard).

A document's set holds its distinct k-word shingles as 64-bit hashes; two
documents link when ``den * |A n B| >= num * |A u B|`` (4/5). Tokens are
ordered by their hash.

1. Equal sets are one row (hash aggregation over any number of copies).
2. With tau = size - ceil(4/5 size) tokens to lose, the first tau + slack
   tokens of a set share at least ``slack`` with those of any partner. Sets
   with fewer tokens that a second set has there have no partner and leave.
3. The same over the whole sets that are left: tokens no other set has bound
   the overlap.
4. Token-combination prefixes. Tokens fall into classes by document frequency:
   rare ones are signatures by themselves; frequent ones (RARE and up) enter as
   pairs, very frequent ones (VERY and up) as triples of a block, the blocks
   being dealt by token hash. A prefix is extended until it has tau + 1
   credits: a rare token is one, a block of n tokens n - k + 1. Losing tau
   tokens then leaves one whole signature, so partners share one. The number
   of blocks follows the size class; each set signs for its own class and the
   next one, which joins any two sizes that can be similar.
5. The sets of a signature meet its pivot, the one with the fewest tokens of
   its own; candidates pass the length and the overlap bound and are verified
   on the whole sets. Connected components follow, and only sets that are
   still in different components form the pairs that are left; pairs inside a
   component can't change it, so families of thousands of copies are never
   expanded. In large buckets the known overlaps with the pivot bound those of
   a pair: |A n B| <= min(|A n P|, |B n P|) + min(a, b), where a and b count the
   tokens outside P that a second set has; and the buckets of one pivot meet
   once, not once for each signature.

Defined results: texts without words (null, empty) have an empty set and link
with nothing; repeated rows are copies of each other; a null doc_id never is a
component's number unless all its documents lack one; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoscore.llm import hashing as H
from geoscore.llm.common import forget, free_name, lookup, written
from geoscore.llm.components import components

RARE, VERY = 32, 512
LARGE = 48  # buckets from this size on meet by their pivot
SLACK_SHARE = 20  # slack: 1 + max(1, size / SLACK_SHARE)
NO_ID = -(1 << 63)
U = np.uint64
STEP = np.array([1.25 ** i for i in range(120)])


def needed(size, num, den):
    """Least overlap with any partner: ceil(num / den * size)."""
    return -(-num * size // den)


def blocks(tag: int) -> tuple[int, int]:
    """Numbers of pair and triple blocks for a size class."""
    size = STEP[tag]
    return max(1, int(size / 8)), max(1, int(size / 5))


def _sets(column: pa.Array, k: int):
    data, off = H.text_bytes(column)
    h, doc, _, _ = H.words(data, off)
    s, d = H.shingles(h, doc, len(column), k)
    size = np.bincount(d, minlength=len(column))
    start = np.cumsum(size) - size
    total = np.zeros(len(column), U)
    full = size > 0
    if len(s):
        total[full] = np.add.reduceat(H.mix(s ^ U(0x2545F4914F6CDD1D)), start[full])
    return s, d, size, start, H.mix(total + size.astype(U)).view(np.int64)


def _lists(values: np.ndarray, lens: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]), pa.int32()), pa.array(values if values.dtype == np.int32 else values.view(np.int64)))


def set_table(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(doc_id, doc, body, set, size, low) of each document; low: the top halves
    of the first tau + slack tokens, nothing for sets too small for an unequal
    partner. Two tokens with one top half only seem shared, which keeps a set
    in the running."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in H.slices(batch, "text"):
                s, d, size, start, key = _sets(part.column("text"), k)
                lead = np.minimum(size, size - needed(size, num, den) + 1 + np.maximum(1, size // SLACK_SHARE))
                lead[size * (den - num) < num] = 0
                keep = np.arange(len(s)) - start[d] < lead[d]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("doc"), part.column("body"), pa.array(key),
                     pa.array(size.astype(np.int64)), _lists((s[keep] >> U(32)).astype(np.uint32).view(np.int32), lead)],
                    names=["doc_id", "doc", "body", "set", "size", "low"])

    return docs.select("doc_id", "doc", "body", "text").mapInArrow(
        run, "doc_id long, doc long, body long, set long, size long, low array<int>")


def whole_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(set, size, tokens) of the wanted documents (doc, body)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in H.slices(batch, "text"):
                s, _, size, _, key = _sets(part.column(0), k)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(size.astype(np.int64)), _lists(s, size)],
                                                 names=["set", "size", "tokens"])

    return (docs.join(lookup(wanted.select("doc", "body")), ["doc", "body"])
            .select("text").mapInArrow(run, "set long, size long, tokens array<long>"))


def _alone(rows: DataFrame) -> DataFrame:
    """(set, alone): how many tokens of a set no other set has."""
    return (rows.groupBy("token").agg(F.min("set").alias("set"), F.max("set").alias("last"))
            .where(F.col("set") == F.col("last")).groupBy("set").agg(F.count("*").alias("alone")))


def signatures(tokens: np.ndarray, pairs: np.ndarray, triples: np.ndarray, num: int, den: int) -> np.ndarray:
    """Signatures of one set (tokens in order of hash, classes as flags)."""
    size = len(tokens)
    credits = size - needed(size, num, den) + 1
    own = int(np.searchsorted(STEP, size, "right")) - 1
    kind = np.where(triples, 3, np.where(pairs, 2, 1))
    if not (kind[:credits] > 1).any():
        return tokens[:credits]
    out, singles = [], 0
    for tag in (own, own + 1):
        n2, n3 = blocks(tag)
        block = np.where(kind == 3, (tokens >> U(7)) % U(n3) + U(n2), (tokens >> U(7)) % U(n2)).astype(np.int64)
        seen, credit, end = {}, 0, size
        for i in range(size):
            if kind[i] == 1:
                credit += 1
            else:
                members = seen.setdefault(block[i], [])
                members.append(i)
                credit += len(members) >= kind[i]
            if credit >= credits:
                end = i + 1
                break
        singles = max(singles, end)
        for b, members in seen.items():
            k = 3 if b >= n2 else 2
            if len(members) >= k:
                chosen = np.array(list(combinations(members, k)))
                h = np.full(len(chosen), U(tag * 8 + k))
                for j in range(k):
                    h = H.mix(h * U(0x9E3779B97F4A7C15) + tokens[chosen[:, j]])
                out.append(h)
    out.append(tokens[:singles][kind[:singles] == 1])
    return np.concatenate(out)


def _signed(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(sig, set, size, alone) rows; sets: set, size, alone, tokens, pairs, triples."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {n: batch.column(n) for n in ("tokens", "pairs", "triples")}
            out = []
            for i in range(len(batch)):
                t, p, q = (np.asarray(cols[n][i].values).view(U) if cols[n][i].is_valid else np.zeros(0, U) for n in cols)
                out.append(np.unique(signatures(t, np.isin(t, p), np.isin(t, q), num, den)))
            lens = np.array([len(x) for x in out], np.int64)
            at = pa.array(np.repeat(np.arange(len(batch)), lens))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)),
                 *(batch.column(n).take(at) for n in ("set", "size", "alone"))], names=["sig", "set", "size", "alone"])

    return (sets.select("set", "size", "alone", "tokens", "pairs", "triples")
            .mapInArrow(run, "sig long, set long, size long, alone long"))


def _possible(num: int, den: int):
    """Length filter and overlap bound of a pair x, y."""
    xs, ys = F.col("x.size"), F.col("y.size")
    best = F.least(xs - F.col("x.alone"), ys - F.col("y.alone"))
    return best * (num + den) >= (xs + ys) * num


def _overlaps(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """(a, b, common, total) of pairs of sets: sizes of intersection and sum."""
    side = {c: tokens.select(F.col("set").alias(c), F.col("tokens").alias(f"{c}_tokens")) for c in "ab"}
    return (pairs.join(side["a"], "a").join(side["b"], "b")
            .select("a", "b", F.size(F.array_intersect("a_tokens", "b_tokens")).cast("long").alias("common"),
                    (F.size("a_tokens") + F.size("b_tokens")).alias("total")))


def _similar(overlaps: DataFrame, num: int, den: int) -> DataFrame:
    return overlaps.where(F.col("common") * (num + den) >= F.col("total") * num).select("a", "b")


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """(doc_id, doc, body, n_shingles, component_id) of each row of ``docs``
    (doc_id, text); doc and body (id or lowest long, text hash) name the row."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc.alias("doc"), F.xxhash64("text").alias("body"), "text")
    table = written(set_table(docs, k, num, den), "sets")
    sets = (table.where(F.col("size") * (den - num) >= num).groupBy("set")
            .agg(F.min(F.struct("doc", "body")).alias("f"), F.max("size").alias("size")).select("set", "size", "f.*"))
    size = F.col("size")
    slack = F.greatest(F.lit(1), F.floor(size / SLACK_SHARE)) + 1
    lead = F.least(size, size - F.ceil(size * num / den) + slack)
    dead = _alone(table.select("set", F.explode("low").alias("token")))
    first = written(sets.join(dead, "set", "left").where(lead - F.coalesce("alone", F.lit(0)) >= F.least(slack, lead)), "first")
    whole = written(whole_sets(docs, first, k), "whole")
    if whole.count() > first.count():  # rows that repeat an id and its text
        whole = written(whole.dropDuplicates(["set"]), "whole")
    rows = whole.select("set", F.explode("tokens").alias("token"))
    alone = written(_alone(rows.select("set", F.shiftright("token", 32).cast("int").alias("token"))), "alone")
    left = (whole.join(lookup(alone), "set", "left").withColumn("alone", F.coalesce("alone", F.lit(0)))
            .where((size - F.col("alone")) * den >= size * num))
    left = written(left, "left")
    forget(whole)
    rows = left.select("set", F.explode("tokens").alias("token"))
    frequent = written(rows.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= RARE), "frequent")
    classes = (rows.join(lookup(frequent), "token").groupBy("set")
               .agg(F.collect_list(F.when(F.col("n") < VERY, F.col("token"))).alias("pairs"),
                    F.collect_list(F.when(F.col("n") >= VERY, F.col("token"))).alias("triples")))
    signed = _signed(left.join(classes, "set", "left"), num, den)
    me = F.struct("set", "size", "alone")
    bucket = W.partitionBy("sig").orderBy(F.col("alone") / size, "set")
    buckets = (signed.select("sig", me.alias("x"), F.first(me).over(bucket.rowsBetween(W.unboundedPreceding, 0)).alias("y"),
                             F.lead("set").over(bucket).alias("next"))
               .where(F.col("next").isNotNull() | (F.col("x.set") != F.col("y.set"))).select("sig", "x", "y"))
    buckets = written(buckets, "buckets")
    pair = (F.least("x.set", "y.set").alias("a"), F.greatest("x.set", "y.set").alias("b"))
    met = written(buckets.where((F.col("x.set") != F.col("y.set")) & _possible(num, den)).select(*pair).distinct(), "pairs")
    met = written(_overlaps(met, left), "overlaps")
    links = _similar(met, num, den)
    comp = components(links)
    placed = (buckets.select("sig", "x", F.col("x.set").alias("node"), F.col("y.set").alias("pivot")).join(comp, "node", "left")
              .withColumn("c", F.coalesce("component", "node")).select("sig", "x", "pivot", "c"))
    mixed = (placed.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n"))
             .where(F.col("lo") != F.col("hi")).select("sig", "n"))
    known = (met.select(F.col("a").alias("pivot"), F.col("b").alias("member"), "common")
             .unionByName(met.select(F.col("b").alias("pivot"), F.col("a").alias("member"), "common")))
    key = F.when(F.col("n") >= LARGE, F.xxhash64(F.lit("pivot"), "pivot")).otherwise(F.col("sig"))
    placed = (placed.join(mixed, "sig").select(key.alias("key"), "x", "pivot", "c", F.col("x.set").alias("member")).distinct()
              .join(known, ["pivot", "member"], "left")
              .withColumn("common", F.when(F.col("pivot") == F.col("member"), F.col("x.size")).otherwise(F.col("common"))))
    placed = written(placed, "mixed")
    mate = placed.select("key", F.col("x").alias("y"), F.col("c").alias("d"), F.col("common").alias("y_common"))
    loose = [F.greatest(F.col(f"{s}.size") - F.col(f"{s}.alone") - k, F.lit(0)) for s, k in (("x", F.col("common")), ("y", F.col("y_common")))]
    most = F.least("common", "y_common") + F.least(*loose)
    unknown = F.col("common").isNull() | F.col("y_common").isNull()
    bound = unknown | (most * (num + den) >= (F.col("x.size") + F.col("y.size")) * num)
    rest = (placed.join(mate, "key")
            .where((F.col("x.set") < F.col("y.set")) & (F.col("c") != F.col("d")) & _possible(num, den) & bound)
            .select(*pair).distinct())
    rest = written(_overlaps(written(rest, "pairs"), left), "overlaps")
    comp = components(links.unionByName(_similar(rest, num, den)))
    ids = table.groupBy("set").agg(F.min("doc_id").alias("id"))
    comp = ids.join(comp, ids["set"] == comp["node"]).select("set", "component", "id")
    smallest = comp.groupBy("component").agg(F.min("id").alias("least"))
    found = comp.join(smallest, "component").select("set", "least")
    out = table.select("doc_id", "doc", "body", "set", size.alias("n_shingles")).join(ids, "set").join(found, "set", "left")
    group = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("least", "id"))
    return out.select("doc_id", "doc", "body", "n_shingles", group.alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest doc_id
    (then of the smallest text hash). Rows equal in both count once. Documents
    without words all stay."""
    names = {c: free_name(docs, f"{c}_of_group") for c in ("doc", "body", "row")}
    groups = near_duplicates(docs.select("doc_id", "text"), k, num, den).where(F.col("n_shingles") > 0)
    first = groups.groupBy("component_id").agg(F.min(F.struct("doc", "body")).alias("f")).select("f.*")
    first = first.select(F.col("doc").alias(names["doc"]), F.col("body").alias(names["body"]), F.lit(True).alias(names["row"]))
    wordless = ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    keyed = docs.withColumns({names["doc"]: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
                              names["body"]: F.xxhash64("text")})
    kept = keyed.join(first, [names["doc"], names["body"]], "left").where(F.col(names["row"]) | wordless)
    again = (kept.where(~wordless).groupBy(names["doc"], names["body"]).agg(F.count("*").alias(names["row"]))
             .where(F.col(names["row"]) > 1).drop(names["row"]))
    if not again.limit(1).count():
        return kept.select(*docs.columns)
    twice = kept.join(again, [names["doc"], names["body"]], "left_semi")
    rest = kept.join(again, [names["doc"], names["body"]], "left_anti")
    empty = twice.where(wordless)
    once = twice.where(~wordless).dropDuplicates([names["doc"], names["body"]])
    return rest.unionByName(once).unionByName(empty).select(*docs.columns)
