"""Exact top-k by inner product with a pivot-distance index.

Integer vectors are lifted by one coordinate so that all have length M, the
greatest norm; a larger inner product with a query then is a smaller Euclidean
distance to it. Pivots are a bounded sample of the vectors. Every vector is
keyed by its nearest pivot and the distance r to it; the vectors of a pivot,
sorted by r, are cut into annuli of at most ANNULUS_ROWS rows. The triangle
inequality bounds the distance of a query q to anything in an annulus
[r0, r1] of pivot p from below by max(d(q,p) - r1, r0 - d(q,p), 0).

Each query walks the annuli in order of that bound, a few more in each round
(1, then 4 times as many), and stops when the bound exceeds the distance of
its k-th best score, so no row that could enter the result is left out. An
annulus meets its queries in blocks of QUERY_ROWS: bounded tasks, no cross
join. What is broadcast are the PIVOTS pivots; the table of annuli (one row for
each ANNULUS_ROWS vectors) is joined.

Defined results: vectors that are null, empty or hold a null or non-finite
component take no part; shorter vectors count as padded with zeros; scores
are exact while a component's integer stays below 2**23 in size for each 128
dimensions, as sums then stay below 2**53; equal scores go to the smaller
vec_id (null last); repeated rows are candidates each, and only the query's
own row is not; fewer than k candidates give fewer rows; empty tables give an
empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoscore.llm.common import spread, written

PIVOTS = 64
ANNULUS_ROWS = 2048
QUERY_ROWS = 512
FIRST_ANNULI = 2


def integer_vectors(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(row, vec_id, v) with v = floor(scale * x) of the usable vectors."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
            .where(F.col("x").isNotNull() & (F.size("x") > 0)).where(~bad)
            .select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))
            .withColumn("row", F.monotonically_increasing_id()))


def _matrix(column, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


class Index:
    """Annuli over the vectors of a table (row, vec_id, v)."""

    def __init__(self, vectors: DataFrame):
        self.vectors = written(vectors.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c)), "vectors")
        got = self.vectors.agg(F.max("norm2").alias("m"), F.max(F.size("v")).alias("dim"), F.count("*").alias("n")).first()
        self.count, self.dim, self.top = got["n"], got["dim"] or 0, got["m"] or 0.0
        if not self.count:
            return
        sample = self.vectors.orderBy(F.xxhash64("v", "row"), "row").limit(PIVOTS).toPandas()
        pivots = self._lift(_matrix(sample["v"], self.dim), sample["norm2"].to_numpy())
        self.pivots = self.vectors.sparkSession.sparkContext.broadcast(pivots)
        dim, top, shared, lift = self.dim, self.top, self.pivots, Index._lifted

        def place(batches):
            for pdf in batches:
                d = _distances(lift(_matrix(pdf["v"], dim), pdf["norm2"].to_numpy(), top), shared.value)
                yield pdf.assign(pivot=d.argmin(1).astype(np.int32), r=d.min(1))[["row", "vec_id", "v", "pivot", "r"]]

        placed = self.vectors.mapInPandas(place, "row long, vec_id long, v array<long>, pivot int, r double")
        self.placed = written(self._annuli(placed), "placed")
        self.rings = written(self.placed.groupBy("annulus").agg(F.first("pivot").alias("pivot"), F.min("r").alias("r0"), F.max("r").alias("r1")), "annuli")

    def _lift(self, x, norm2):
        return Index._lifted(x, norm2, self.top)

    @staticmethod
    def _lifted(x, norm2, top):
        return np.column_stack([x, np.sqrt(np.maximum(top - norm2, 0))])

    def _annuli(self, placed: DataFrame) -> DataFrame:
        """Numbers the annuli: equal-count slices of each pivot's rows by r.

        Slice borders come from approximate quantiles, so no task sorts a whole
        pivot; rows of equal r beyond ANNULUS_ROWS are dealt by hash."""
        placed = written(placed, "keyed")
        counts = placed.groupBy("pivot").agg(F.count("*").alias("n"))
        slices = F.ceil(F.col("n") / ANNULUS_ROWS).cast("int")
        most = max(r["s"] for r in counts.select(slices.alias("s")).collect())
        borders = placed.groupBy("pivot").agg(F.percentile_approx("r", [i / most for i in range(1, most)] or [1.0], 20 * most).alias("cuts"))
        cut = (placed.join(F.broadcast(borders), "pivot")
               .withColumn("slice", F.size(F.filter("cuts", lambda c: c < F.col("r"))) if most > 1 else F.lit(0)).drop("cuts"))
        sizes = cut.groupBy("pivot", "slice").agg(F.ceil(F.count("*") / ANNULUS_ROWS).cast("int").alias("parts"))
        return (cut.join(sizes, ["pivot", "slice"])
                .withColumn("annulus", F.xxhash64("pivot", "slice", spread("row") % F.col("parts"))).drop("slice", "parts"))

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, rank, vec_id, score): the k best rows for each query
        (row, vec_id, v of this index's table)."""
        dim, top, shared = self.dim, self.top, self.pivots

        def reach(batches):
            for pdf in batches:
                q = _matrix(pdf["v"], dim)
                d = _distances(np.column_stack([q, np.zeros(len(q))]), shared.value)
                yield pdf.assign(d=list(d), q2=(q * q).sum(1))[["row", "vec_id", "v", "d", "q2"]]

        asked = written(queries.select("row", "vec_id", "v").mapInPandas(reach, "row long, vec_id long, v array<long>, d array<double>, q2 double"), "queries")
        rings = self.rings.count()
        bound = F.greatest(F.element_at("d", F.col("pivot") + 1) - F.col("r1"), F.col("r0") - F.element_at("d", F.col("pivot") + 1), F.lit(0.0))
        order = W.partitionBy("row").orderBy("bound", "annulus")
        # one row for each query and annulus: a query meets an annulus by its pivot
        per_pivot = asked.select("row", "d", "q2", F.explode(F.sequence(F.lit(0), F.lit(shared.value.shape[0] - 1))).alias("pivot"))
        walk = (per_pivot.join(self.rings, "pivot").select("row", "annulus", "q2", bound.alias("bound"))
                .withColumn("place", F.row_number().over(order)))
        walk = written(walk, "walk")
        best, seen, step = None, 0, FIRST_ANNULI
        while seen < rings:
            due = walk.where((F.col("place") > seen) & (F.col("place") <= seen + step))
            if best is not None:
                kth = best.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least")).withColumnRenamed("query", "row")
                far = F.sqrt(F.greatest(F.col("q2") + top - 2 * F.col("least"), F.lit(0.0)))
                due = due.join(kth, "row", "left").where((F.coalesce("n", F.lit(0)) < k) | (F.col("bound") <= far * (1 + 1e-9) + 1e-3))
            due = written(due.select("row", "annulus"), "due")
            if best is not None and not due.limit(1).count():
                break
            found = self._meet(due, asked, k)
            best = written(self._best(found if best is None else found.unionByName(best), k), "best")
            seen, step = seen + step, step * 4
        rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "cand"))
        return best.withColumn("rank", rank).select("query_id", "rank", "vec_id", "score")

    def _meet(self, due: DataFrame, asked: DataFrame, k: int) -> DataFrame:
        """The k best of each annulus for each query that is due there."""
        dim = self.dim
        blocks = due.withColumn("block", spread("row") % F.lit(max(1, -(-asked.count() // QUERY_ROWS))))
        left = blocks.join(asked.select("row", F.col("vec_id").alias("query_id"), "v"), "row")
        left = left.select("annulus", "block", F.col("row").alias("query"), "query_id", "v")
        right = self.placed.select("annulus", "row", "vec_id", "v").join(
            blocks.select("annulus", "block").distinct().select("annulus", F.col("block").alias("part")), "annulus")

        def meet(key, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
            names = ["query", "query_id", "cand", "vec_id", "score"]
            if not len(q) or not len(c):
                return pd.DataFrame(columns=names)
            c = c.sort_values(["vec_id", "row"], na_position="last", ignore_index=True)
            score = _matrix(q["v"], dim) @ _matrix(c["v"], dim).T
            own = q["query"].to_numpy()[:, None] == c["row"].to_numpy()[None, :]
            score[own] = -np.inf
            out = np.argsort(-score, axis=1, kind="stable")[:, :k]
            at = np.repeat(np.arange(len(q)), out.shape[1])
            pick = out.ravel()
            s = score[at, pick]
            keep = np.isfinite(s)
            at, pick, s = at[keep], pick[keep], s[keep]
            return pd.DataFrame({"query": q["query"].to_numpy()[at], "query_id": q["query_id"].to_numpy()[at], "cand": c["row"].to_numpy()[pick],
                                 "vec_id": c["vec_id"].astype("Int64").to_numpy()[pick] if c["vec_id"].isna().any() else c["vec_id"].to_numpy()[pick],
                                 "score": s.astype(np.int64)})[names]

        return (left.groupBy("annulus", "block").cogroup(right.withColumnRenamed("annulus", "ring").groupBy("ring", "part"))
                .applyInPandas(meet, "query long, query_id long, cand long, vec_id long, score long"))

    @staticmethod
    def _best(found: DataFrame, k: int) -> DataFrame:
        order = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "cand")
        return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).drop("n")


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: int = 1024) -> DataFrame:
    """Exact top-k among the usable rows of ``vectors`` (vec_id, embedding)
    for those whose condition ``is_query`` (on vec_id) holds."""
    index = Index(integer_vectors(vectors, scale))
    empty = "query_id long, rank int, vec_id long, score long"
    if not index.count:
        return vectors.sparkSession.createDataFrame([], empty)
    queries = index.vectors.where(is_query)
    if not queries.limit(1).count():
        return vectors.sparkSession.createDataFrame([], empty)
    return index.search(queries, k)
