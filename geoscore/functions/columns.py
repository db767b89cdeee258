"""Column expressions: ratios, recodes, caps, rounding, gaps and scores.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``
so it stays inside whole-stage codegen; nothing runs in Python per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
# Centre of each census age band, in band order
# (0-3, 4-5, 6-10, 11-17, 18-24, 25-39, 40-54, 55-64, 65-79, 80+).
AGE_BAND_CENTRES = [2, 4.5, 8, 14, 21, 32, 47, 59, 72, 82]
# Census age-band column names, same order as the centres.
AGE_BAND_COLUMNS = ["ind_0_3", "ind_4_5", "ind_6_10", "ind_11_17", "ind_18_24",
                    "ind_25_39", "ind_40_54", "ind_55_64", "ind_65_79", "ind_80p"]
# Ordinal code of the urban-area zone status.
ZONE_CODES = {"C": 4, "B": 3, "I": 2, "R": 1}
# Milieu value that maps to 1 in the binary recode.
URBAN = "URBAIN"
RURAL = "RURAL"
# Upper bound applied to features before scoring.
FEATURE_CAP = 2_140_000_000
# Inhabitants-per-establishment factor, written as in the source formula:
# value / (competitors + 1) * 3.14 * 25 / 4
INHABITANTS_PI = 3.14
INHABITANTS_NUM = 25
INHABITANTS_DEN = 4
# Competitor radius in metres, by milieu.
COMPETITOR_RADIUS_M = {URBAN: 500.0, RURAL: 10_000.0}
# Employer flag value.
EMPLOYER_YES = "O"
# Census columns never used as features.
CENSUS_EXCLUDED = ["idinspire", "id_carr1km", "i_est_cr", "id_carr_n", "groupe", "depcom",
                   "i_pauv", "id_car2010", "i_est_1km", "log_inc", "ind_inc"]
# Piecewise score anchor values for min, lower mean, mean, upper mean, max.
SCORE_ANCHORS = [0.0, 0.25, 0.5, 0.75, 1.0]
# Legacy fixed-breakpoint score: breakpoints and segment (slope, intercept).
LEGACY_BREAKS = [-0.5, 0.0, 1.0, 2.0]
LEGACY_SEGMENTS = [(1.0, 0.5), (0.3, 0.5), (0.2, 0.6)]


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# Rounding and ratios
# ---------------------------------------------------------------------------
def round_n(c, n: int) -> Column:
    """Decimal rounding, half away from zero on the shortest decimal form
    of the double (the semantics of ``round(x::numeric, n)``)."""
    return F.round(col(c), n)


def guarded_ratio(num, den, scale: int | None = 2) -> Column:
    """``case when d != 0 then round(n/d) else 0``: zero or NULL d gives 0,
    NULL n with a non-zero d stays NULL."""
    q = F.try_divide(col(num), col(den))
    if scale is not None:
        q = F.round(q, scale)
    return F.when(col(den) != 0, q).otherwise(F.lit(0.0))


def safe_ratio(num, den) -> Column:
    """Unguarded ratio that yields NULL (not an error) on a zero total."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def weighted_band_mean(bands, centres=AGE_BAND_CENTRES) -> Column:
    """sum(band_i * centre_i) / sum(band_i); NULL on a zero total."""
    bands = [col(b) for b in bands]
    num = reduce(lambda a, b: a + b, [b * F.lit(float(c)) for b, c in zip(bands, centres)])
    den = reduce(lambda a, b: a + b, bands)
    return safe_ratio(num, den)


# ---------------------------------------------------------------------------
# Recodes and flags
# ---------------------------------------------------------------------------
def milieu_flag(c) -> Column:
    """URBAIN -> 1, anything else (NULL included) -> 0."""
    return F.when(col(c) == URBAN, 1).otherwise(0)


def milieu_flag_strict(c) -> Column:
    """URBAIN -> 1, RURAL -> 0, any other value -> NULL."""
    return F.when(col(c) == URBAN, 1).when(col(c) == RURAL, 0)


def ordinal_recode(c, codes: dict | None = None) -> Column:
    """Map codes to ordinals; an unknown or NULL code gives NULL."""
    codes = ZONE_CODES if codes is None else codes
    expr = None
    for k, v in codes.items():
        expr = (F.when(col(c) == k, F.lit(v)) if expr is None
                else expr.when(col(c) == k, F.lit(v)))
    return expr


def equals_flag(c, value) -> Column:
    """1 when the column equals ``value``, else 0 (NULL included)."""
    return F.when(col(c) == value, 1).otherwise(0)


def present_flag(c) -> Column:
    """1 when the column is not NULL, else 0."""
    return col(c).isNotNull().cast("int")


# ---------------------------------------------------------------------------
# Inhabitants per site, null-preserving cap
# ---------------------------------------------------------------------------
def null_safe_cap(c, cap=FEATURE_CAP) -> Column:
    """min(x, cap) that keeps NULL as NULL (``least`` would not)."""
    return F.when(col(c) > F.lit(cap), F.lit(cap)).otherwise(col(c))


def inhabitants_per_site(density, competitors) -> Column:
    """Density / (competitors + 1) * 3.14 * 25 / 4, evaluated left to right."""
    base = F.try_divide(col(density).cast("double"), col(competitors).cast("double") + F.lit(1.0))
    return base * F.lit(INHABITANTS_PI) * F.lit(INHABITANTS_NUM) / F.lit(INHABITANTS_DEN)


# ---------------------------------------------------------------------------
# Relative gap and piecewise scores
# ---------------------------------------------------------------------------
def relative_gap(predicted, actual) -> Column:
    """Predicted if actual = 0, else (predicted - actual) / actual."""
    p, a = col(predicted).cast("double"), col(actual).cast("double")
    return F.when(a == 0, p).otherwise(F.try_divide(p - a, a))


def piecewise_score(gap, lo, low_mean, mean, up_mean, hi, scale: int = 2) -> Column:
    """Four linear segments through (lo,0) (low_mean,.25) (mean,.5)
    (up_mean,.75) (hi,1); boundaries are inclusive and the lower segment wins.

    A NULL gap scores NULL; a zero-width segment gives its upper anchor value;
    a gap outside [lo, hi] (cannot happen with global extremes) scores 1.
    """
    g = col(gap)
    knots = [col(lo), col(low_mean), col(mean), col(up_mean), col(hi)]
    out = None
    for i in range(4):
        a, b = knots[i], knots[i + 1]
        ya, yb = SCORE_ANCHORS[i], SCORE_ANCHORS[i + 1]
        width = b - a
        rise = F.lit(yb - ya)
        # same evaluation order as the source formula: g*r/w - r/w*a + ya
        seg = F.when(width == 0, F.lit(yb)).otherwise(
            g * rise / width - rise / width * a + F.lit(ya))
        cond = g.between(a, b)
        out = F.when(cond, seg) if out is None else out.when(cond, seg)
    out = out.otherwise(F.lit(1.0))
    return F.when(g.isNull(), F.lit(None).cast("double")).otherwise(F.round(out, scale))


def legacy_score(gap) -> Column:
    """L1: fixed breakpoints; below -0.5 -> 0, above 2 -> 1, the last segment
    made continuous (0.2 g + 0.6)."""
    g = col(gap)
    b = LEGACY_BREAKS
    (s1, i1), (s2, i2), (s3, i3) = LEGACY_SEGMENTS
    return (F.when(g.isNull(), F.lit(None).cast("double"))
            .when(g < b[0], F.lit(0.0))
            .when(g <= b[1], g * s1 + i1)
            .when(g <= b[2], g * s2 + i2)
            .when(g <= b[3], g * s3 + i3)
            .otherwise(F.lit(1.0)))
