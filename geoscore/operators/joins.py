"""Join helpers: size-checked broadcast, star joins, constant-predicate joins.

Broadcast is only requested for a side whose row count has been *checked*
against a bound (``limit(n + 1).count()`` reads at most n + 1 rows, so the
check itself is bounded). Beyond the bound the join is left to the planner
(sort-merge / shuffle-hash, with AQE converting to broadcast at runtime
when the actual shuffle output turns out small).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension we hint as broadcast (rows). Dimension tables of the
# location model (communes ~35k, IRIS ~50k, dictionary 70 rows) fit well
# below this; anything larger goes through a shuffle join.
DEFAULT_BROADCAST_ROWS = 1_000_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (bounded check)."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Hint ``df`` for broadcast only if its size is proven below the bound."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df


def star_join(fact: DataFrame, dims: Iterable[tuple], how: str = "inner") -> DataFrame:
    """Chain of equi-joins of a fact table with dimensions.

    ``dims`` holds ``(dimension, keys)`` or ``(dimension, keys, small)`` tuples;
    ``keys`` is a column name, a list of names, or a join Column. Selective
    dimensions should come first so later joins see fewer fact rows.
    ``small=True`` routes the dimension through :func:`bounded_broadcast`.
    """
    out = fact
    for spec in dims:
        dim, keys = spec[0], spec[1]
        small = spec[2] if len(spec) > 2 else False
        if small:
            dim = bounded_broadcast(dim)
        out = out.join(dim, keys, how)
    return out


def join_filtered(left: DataFrame, right: DataFrame, keys, predicate, how: str = "inner") -> DataFrame:
    """A join whose ON clause carries a constant predicate on
    the right side. The predicate is applied to the right input before the
    join, which for an outer join is the only correct placement."""
    return left.join(right.where(predicate), keys, how)
