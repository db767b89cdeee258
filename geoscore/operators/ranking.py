"""Ranks within groups that stay correct when one group holds most rows.

A window ``partitionBy(g).orderBy(v)`` sends every row of a group to one
task. Percent ranks by variable (W3) and stratified fold numbers (M2) are
partitioned by a handful of keys (attribute name, class label), so a single
group can be a third of the table. Here the rank is computed as a
distributed prefix sum instead:

1. collapse to distinct ``(g, v)`` with their multiplicity (partial
   aggregation map-side, so a hot value costs one row);
2. range-partition the distinct values over all tasks and materialise the
   range id (checkpoint in the shared folder, so every branch sees the same
   assignment even after a lost executor);
3. running sums inside each range + per-range totals; the per-range totals
   (at most groups x partitions rows) give each range its offset;
4. join the ranks back to the rows on ``(g, v)`` (AQE splits a hot value).

Row numbers by a unique value need neither the collapse nor the join back: the
rows themselves are range-partitioned, once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoscore.operators.joins import bounded_broadcast
from geoscore.session import materialize, work_dir


def value_ranks(df: DataFrame, group_cols: list[str], order_col: str,
                num_ranges: int | None = None) -> DataFrame:
    """Distinct ``(group_cols, order_col)`` with
    ``rank_lt`` (rows with a smaller value in the group), ``n_eq`` (rows with
    this value) and ``n_group`` (non-NULL rows in the group). NULLs are left out.
    """
    spark = df.sparkSession
    work_dir(spark)  # make sure a reliable checkpoint folder exists
    if num_ranges is None:
        num_ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    g = list(group_cols)
    v = order_col
    counts = (df.where(F.col(v).isNotNull())
              .groupBy(*g, v).agg(F.count(F.lit(1)).alias("n_eq")))
    ranged = (counts.repartitionByRange(num_ranges, *[F.col(c) for c in g], F.col(v))
              .withColumn("_range", F.spark_partition_id()))
    ranged = ranged.checkpoint(eager=True)

    w_in = (Window.partitionBy(*g, "_range").orderBy(v)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = ranged.withColumn("_cum", F.sum("n_eq").over(w_in) - F.col("n_eq"))

    totals = ranged.groupBy(*g, "_range").agg(F.sum("n_eq").alias("_range_n"))
    w_off = (Window.partitionBy(*g).orderBy("_range")
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (totals
               .withColumn("_offset", F.coalesce(F.sum("_range_n").over(w_off), F.lit(0)))
               .withColumn("n_group", F.sum("_range_n").over(Window.partitionBy(*g)))
               .drop("_range_n"))
    return (inside.join(offsets, g + ["_range"])
            .select(*g, v, (F.col("_offset") + F.col("_cum")).alias("rank_lt"),
                    "n_eq", "n_group"))


def with_value_ranks(df: DataFrame, group_cols: list[str], order_col: str) -> DataFrame:
    """``df`` with ``rank_lt``, ``n_eq`` and ``n_group`` joined back (NULL
    order values get NULL ranks)."""
    ranks = value_ranks(df, group_cols, order_col)
    keys = list(group_cols) + [order_col]
    return df.join(ranks, keys, "left")


def percent_rank_avg(df: DataFrame, group_cols: list[str], order_col: str,
                     out: str = "pct_rank") -> DataFrame:
    """Pandas ``rank(pct=True)`` by group: average rank of ties divided by
    the number of non-NULL values; NULL stays NULL."""
    r = with_value_ranks(df, group_cols, order_col)
    pct = (F.col("rank_lt") + (F.col("n_eq") + F.lit(1)) / F.lit(2.0)) / F.col("n_group")
    return r.withColumn(out, pct).drop("rank_lt", "n_eq", "n_group")


def row_number_unique(df: DataFrame, group_cols: list[str], order_col: str,
                      out: str = "row_number") -> DataFrame:
    """``row_number() over (partition by g order by v)`` for a ``v`` that is
    unique within each group (a key), computed without a per-group task; rows
    with a NULL ``v`` get a NULL number.

    One shuffle of the rows: they are range-partitioned by (g, v), sorted and
    checkpointed with their place. As the ranges are in order, a group lies in
    consecutive ones; the rows it has in each (ranges + groups entries, counted
    before they are shuffled) give its offsets."""
    g = list(group_cols)
    place, part = "_place" + out, "_part" + out
    keys = [F.col(c) for c in [*g, order_col]]
    known = F.col(order_col).isNotNull()
    ranged = materialize(df.where(known).repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumn(place, F.monotonically_increasing_id()))
    ranged = ranged.withColumn(part, F.shiftright(F.col(place), 33))  # the id holds the partition above bit 33
    before = Window.partitionBy(*[f"_g{i}" for i in range(len(g))]).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (ranged.groupBy(F.col(part).alias("_p"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(g)])
              .agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first"))
              .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    same = F.col(part) == F.col("_p")
    for i, c in enumerate(g):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    numbers = ranged.join(bounded_broadcast(pieces), same).withColumn(
        out, F.col("_before") + F.col(place) - F.col("_first") + F.lit(1))
    rest = df.where(~known).withColumn(out, F.lit(None).cast("long"))
    return numbers.select(*df.columns, out).unionByName(rest)


def numbered(df: DataFrame, order: list[Column], out: str = "row_number") -> DataFrame:
    """``df`` with its rows numbered 1, 2, 3... in the given order.

    One shuffle: the rows are range-partitioned, sorted inside their range and
    checkpointed with their place in it; the row counts of the ranges (one row
    a partition, broadcast) give each range its offset. Rows that the order
    can't tell apart get numbers in any order."""
    place = "_place" + out
    ranged = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn(place, F.monotonically_increasing_id()))
    # the id holds the partition above bit 33 and the row's place below it
    part, within = F.shiftright(F.col(place), 33), F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    return (ranged.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(out, F.col("_offset") + within + F.lit(1)).drop("_part", "_offset", place))
