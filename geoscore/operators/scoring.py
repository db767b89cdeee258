"""Residual-based opportunity scores.

The reference computes global min / mean / max and the conditional means
with ``OVER (PARTITION BY 1)`` windows, i.e. every row through one task.
Here they are two one-row aggregates (partial aggregation on every task)
attached with a broadcast cross join of that single row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoscore.functions.columns import legacy_score, piecewise_score, relative_gap
from geoscore.session import materialize


def global_gap_stats(gaps: DataFrame, gap_col: str = "gap") -> DataFrame:
    """A3 + A4: one row with min, mean, max, the mean of gaps >= mean
    (``up_mean``) and the mean of gaps <= mean (``low_mean``)."""
    g = F.col(gap_col)
    s1 = gaps.agg(F.min(g).alias("g_min"), F.avg(g).alias("g_mean"), F.max(g).alias("g_max"))
    s2 = (gaps.select(gap_col).crossJoin(F.broadcast(s1))
          .agg(F.avg(F.when(g >= F.col("g_mean"), g)).alias("up_mean"),
               F.avg(F.when(g <= F.col("g_mean"), g)).alias("low_mean")))
    return s1.crossJoin(s2)


def with_global_stats(gaps: DataFrame, gap_col: str = "gap") -> DataFrame:
    """Each row with the global statistics attached (one-row broadcast)."""
    return gaps.crossJoin(F.broadcast(global_gap_stats(gaps, gap_col)))


def gap_scores(areas: DataFrame, key_cols: list[str], predicted: str, actual: str,
               scale: int = 2) -> DataFrame:
    """C3 (first half): relative gap per area and its 0-1 score."""
    # one row per area, read three times (stats, conditional means, scores)
    gaps = materialize(areas.select(*key_cols, relative_gap(predicted, actual).alias("gap")))
    st = with_global_stats(gaps)
    score = piecewise_score("gap", "g_min", "low_mean", "g_mean", "up_mean", "g_max", scale)
    return st.select(*key_cols, "gap", score.alias("score"))


def legacy_gap_scores(areas: DataFrame, key_cols: list[str], predicted: str,
                      actual: str) -> DataFrame:
    """L1: fixed-breakpoint score of the relative gap."""
    gaps = areas.select(*key_cols, relative_gap(predicted, actual).alias("gap"))
    return gaps.select(*key_cols, "gap", legacy_score("gap").alias("score"))


def fan_out(scores: DataFrame, bridge: DataFrame, area_key: str) -> DataFrame:
    """Area score copied to every cell of the area (bridge join)."""
    return bridge.join(scores, area_key)


def residual_table(areas: DataFrame, key_cols: list[str], predicted: str,
                   actual: str) -> DataFrame:
    """C4: actual, predicted (3), absolute (1), squared (1) and relative (1) gap."""
    p, a = F.col(predicted).cast("double"), F.col(actual).cast("double")
    rel = F.when(a != 0, F.round(F.try_divide(p - a, a), 1)).otherwise(F.round(p, 1))
    return areas.select(
        *key_cols,
        F.col(actual).alias("nb_effectif"),
        F.round(p, 3).alias("nb_predit"),
        F.round(F.abs(p - a), 1).alias("ecart_absolu"),
        F.round(F.pow(p - a, 2), 1).alias("ecart_quadratique"),
        rel.alias("ecart_relatif"),
    )


def histogram(df: DataFrame, value_col: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram between the global min and max.

    ``bin = min(floor((x - min) / ((max - min) / bins)), bins - 1)``; a
    zero-width range puts everything in bin 0. Output: bin, lower edge, count.
    """
    x = F.col(value_col)
    df = materialize(df.select(value_col))   # read twice: range, then binning
    rng = df.agg(F.min(x).alias("h_min"), F.max(x).alias("h_max"))
    width = (F.col("h_max") - F.col("h_min")) / F.lit(float(bins))
    raw = F.floor(F.try_divide(x - F.col("h_min"), width))
    b = F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1)).cast("bigint")
    binned = (df.where(x.isNotNull()).select(value_col).crossJoin(F.broadcast(rng))
              .select(b.alias("bin"), F.col("h_min"), width.alias("h_width")))
    return (binned.groupBy("bin")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.first(F.col("h_min") + F.col("bin") * F.col("h_width")).alias("lower_edge")))
