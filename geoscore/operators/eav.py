"""Entity-attribute-value operators.

The reference widens a long ``(entity, attribute, value)`` table with one
inner self-join per attribute (70 joins per feature matrix). Here that is two
hash aggregations, by (entity, attribute) and by entity, whatever the number
of attributes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoscore.functions.ordering import packed_order
from geoscore.operators.joins import bounded_broadcast


def latest_per_key(df: DataFrame, key_cols: list[str], value_cols: list[str],
                   order_cols: list[str]) -> DataFrame:
    """Keep, per key, the values of the row with the largest ``order_cols``
    (e.g. latest ``date_calcul``, then highest id). One hash aggregate: the
    ordering is packed into one number (``packed_order``), rows are combined
    before the shuffle, and no task holds a key's rows."""
    order = packed_order(df, order_cols)
    aggs = [F.max_by(F.col(c), order).alias(c) for c in value_cols]
    return df.groupBy(*key_cols).agg(*aggs)


def widen(long: DataFrame, key_cols: list[str], attr_col: str, value_col: str,
          attrs: list[str], names: list[str] | None = None,
          complete: bool = True, round_to: int | None = None,
          latest_by: list[str] | None = None) -> DataFrame:
    """One row per entity, one column per attribute.

    Two hash aggregates, each combined before its shuffle: the first leaves one
    row per (entity, attribute), the second spreads these over columns, so a
    row is compared with the attribute names once and no buffer holds more
    columns than the entity has rows. With ``latest_by`` (e.g.
    ``["date_calcul", "id"]``) the first takes, of duplicate rows, the value of
    the one with the largest ordering, NULL included; without it ``long`` must
    hold at most one row per (entity, attribute), and the first aggregate only
    counts it once.
    With ``complete=True`` only entities that have a row for *every*
    attribute survive, even when the stored value is NULL - the semantics of
    the chain of inner self-joins. ``names`` renames the output columns.
    """
    names = list(attrs) if names is None else list(names)
    keys = list(key_cols)
    v = F.col(value_col)
    known = long.where(F.col(attr_col).isin(list(attrs)))
    value = F.max_by(v, packed_order(known, latest_by)) if latest_by else F.first(v, ignorenulls=True)
    single = known.groupBy(*keys, attr_col).agg(value.alias(value_col))
    values = []
    for attr, name in zip(attrs, names):
        val = F.max(F.when(F.col(attr_col) == attr, v))
        if round_to is not None:
            val = F.round(val, round_to)
        values.append(val.alias(name))
    if not complete:
        return single.groupBy(*keys).agg(*values)
    wide = single.groupBy(*keys).agg(*values, F.count(F.lit(1)).alias("_n_present"))
    return wide.where(F.col("_n_present") == len(set(attrs))).drop("_n_present")


def group_means(wide: DataFrame, group_cols: list[str], cols: list[str],
                scale: int | None = 3) -> DataFrame:
    """A2: mean of every attribute over a set of entities, rounded."""
    aggs = []
    for c in cols:
        m = F.avg(F.col(c))
        if scale is not None:
            m = F.round(m, scale)
        aggs.append(m.alias(c))
    return wide.groupBy(*group_cols).agg(*aggs)


def missing_entities(candidates: DataFrame, eav: DataFrame, key_cols: list[str],
                     attr_col: str, attr: str, value_col: str) -> DataFrame:
    """Candidates that lack ``attr`` - no row, or only a NULL value.

    An anti join against the non-NULL rows of that attribute (the filter is
    pushed to the scan, the right side is only the keys)."""
    present = (eav.where((F.col(attr_col) == attr) & F.col(value_col).isNotNull())
               .select(*key_cols))
    return candidates.join(present, key_cols, "left_anti")


def unpivot(df: DataFrame, key_cols: list[str], value_cols: list[str],
            name_col: str = "varexp", value_col: str = "valeur") -> DataFrame:
    """Wide -> long ``(keys, name, value)``; values cast to double."""
    casted = df.select(*key_cols, *[F.col(c).cast("double").alias(c) for c in value_cols])
    return casted.unpivot(key_cols, value_cols, name_col, value_col)


def rename_values(df: DataFrame, name_col: str, dictionary: DataFrame,
                  from_col: str = "feature", to_col: str = "varexp") -> DataFrame:
    """Replace names through a dictionary table; unmapped names are kept.
    The dictionary is small and size-checked before broadcasting."""
    d = bounded_broadcast(dictionary.select(F.col(from_col).alias("_from"),
                                            F.col(to_col).alias("_to")))
    return (df.join(d, F.col(name_col) == F.col("_from"), "left")
            .withColumn(name_col, F.coalesce(F.col("_to"), F.col(name_col)))
            .drop("_from", "_to"))

