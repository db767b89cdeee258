"""Orderings that fit a hash aggregate.

``max_by(value, struct(ts, id))`` needs a struct in the aggregation buffer,
which Spark can only sort-aggregate. Whole numbers and times have an
order-preserving form as one decimal, which is a fixed-size buffer slot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Offset that makes every value positive (0 is NULL) and the digits it takes;
# timestamps are those of the years 1 to 9999.
_CODES = {
    "boolean": (1, 1), "tinyint": (129, 3), "smallint": (32769, 5), "int": (2147483649, 10),
    "bigint": (9223372036854775809, 20), "date": (719163, 7), "timestamp": (62135596800000001, 18),
    "timestamp_ntz": (62135596800000001, 18),
}
_DIGITS = 38


def packed_order(df: DataFrame, cols: list[str]) -> Column:
    """One column that orders the rows of ``df`` as ``struct(cols)`` does (NULL
    lowest): a decimal if they are whole numbers, booleans, dates or times of
    38 digits at most together, else the struct."""
    kinds = dict(df.dtypes)
    codes = [_CODES.get(kinds[c]) for c in cols]
    if None in codes or sum(n for _, n in codes) > _DIGITS:
        return F.struct(*cols)
    out = None
    for c, (offset, digits) in zip(cols, codes):
        value = F.col(c)
        if kinds[c] == "date":
            value = F.unix_date(value)
        elif kinds[c] == "timestamp":
            value = F.unix_micros(value)
        elif kinds[c] == "timestamp_ntz":  # wall-clock microseconds, free of any time zone
            minutes = F.unix_date(value.cast("date")).cast("bigint") * 1440 + F.hour(value) * 60 + F.minute(value)
            value = minutes * 60_000_000 + (F.date_part(F.lit("SECOND"), value) * 1_000_000).cast("bigint")
        elif kinds[c] == "boolean":
            value = value.cast("int")
        code = value.cast("decimal(20,0)") + F.lit(str(offset)).cast("decimal(20,0)")
        code = F.coalesce(code, F.lit(0).cast("decimal(20,0)")).cast(f"decimal({digits},0)")
        if out is None:
            out, have = code, digits
        else:
            out = (out * F.lit(str(10 ** digits)).cast(f"decimal({digits + 1},0)")).cast(f"decimal({have + digits},0)")
            have += digits
            out = (out + code).cast(f"decimal({have},0)")
    return out
