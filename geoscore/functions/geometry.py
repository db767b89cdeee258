"""Planar geometry as column expressions.

Points are two double columns; cells are axis-aligned rectangles in a
projected (metric) system; polygons are rings ``array<struct<x,y>>``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from geoscore.functions.columns import col

# ---------------------------------------------------------------------------
# Lambert-93 (EPSG:2154) projection on the GRS80 ellipsoid.
# ---------------------------------------------------------------------------
GRS80_A = 6378137.0
GRS80_F = 1 / 298.257222101
LAMBERT93 = {"lat0": 46.5, "lon0": 3.0, "lat1": 49.0, "lat2": 44.0,
             "x0": 700000.0, "y0": 6600000.0}


def tile(c, size: float) -> Column:
    """Integer tile index of a coordinate."""
    return F.floor(col(c) / F.lit(float(size))).cast("bigint")


def tile_range(lo, hi, size: float) -> Column:
    """All tile indexes covered by a closed interval [lo, hi]."""
    return F.sequence(tile(lo, size), tile(hi, size))


def sq_dist(x1, y1, x2, y2) -> Column:
    dx = col(x1) - col(x2)
    dy = col(y1) - col(y2)
    return dx * dx + dy * dy


def lambert93(lon, lat) -> tuple[Column, Column]:
    """WGS84/RGF93 longitude, latitude (degrees) -> Lambert-93 metres,
    the Lambert conformal conic (two standard parallels) formulas."""
    a, f = GRS80_A, GRS80_F
    e = math.sqrt(f * (2 - f))
    p = LAMBERT93
    rad = math.pi / 180.0

    def m_(phi):
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    def t_(phi):
        return math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)

    phi1, phi2, phi0 = p["lat1"] * rad, p["lat2"] * rad, p["lat0"] * rad
    n = (math.log(m_(phi1)) - math.log(m_(phi2))) / (math.log(t_(phi1)) - math.log(t_(phi2)))
    big_f = m_(phi1) / (n * t_(phi1) ** n)
    rho0 = a * big_f * t_(phi0) ** n

    phi = col(lat) * F.lit(rad)
    es = F.lit(e) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), F.lit(e / 2))
    rho = F.lit(a * big_f) * F.pow(t, F.lit(n))
    theta = F.lit(n) * (col(lon) - F.lit(p["lon0"])) * F.lit(rad)
    x = F.lit(p["x0"]) + rho * F.sin(theta)
    y = F.lit(p["y0"] + rho0) - rho * F.cos(theta)
    return x, y


def has_rings(df, geom: str) -> bool:
    """Whether a geometry column holds several rings (holes, parts) rather than one."""
    return isinstance(df.schema[geom].dataType.elementType, ArrayType)


def geometry_edges(df, geom: str) -> Column:
    """Edges of all rings of a geometry: one ring ``array<struct<x,y>>``, or
    ``array<array<struct<x,y>>>`` with the outer rings of all parts and their
    holes in any order and direction. A point is inside when a ray from it
    crosses an odd number of these edges, which needs no ring roles."""
    if not has_rings(df, geom):
        return ring_edges(geom)
    return F.flatten(F.transform(F.col(geom), ring_edges))


def geometry_points(df, geom: str) -> Column:
    """Vertices of all rings of a geometry."""
    return F.flatten(F.col(geom)) if has_rings(df, geom) else F.col(geom)


def segment_tiles(x1, y1, x2, y2, size: float) -> Column:
    """Tiles that a closed segment passes through, ``array<struct<tx,ty>>``:
    for each tile column only the rows between the segment's ends in it, so a
    long slanted edge takes tiles along its length, not all of its box."""
    x1, y1, x2, y2 = col(x1), col(y1), col(x2), col(y2)
    s = F.lit(float(size))
    margin = F.lit(1e-9) * (F.abs(y1) + F.abs(y2) + s)

    def rows(tx):
        def at(x):
            return F.when(x1 == x2, None).otherwise(y1 + F.try_divide((x - x1) * (y2 - y1), x2 - x1))
        left = F.greatest(tx * s, F.least(x1, x2))
        right = F.least((tx + 1) * s, F.greatest(x1, x2))
        lo = F.coalesce(F.least(at(left), at(right)) - margin, F.least(y1, y2))
        hi = F.coalesce(F.greatest(at(left), at(right)) + margin, F.greatest(y1, y2))
        lo = F.greatest(lo, F.least(y1, y2))
        hi = F.least(hi, F.greatest(y1, y2))
        return F.transform(F.sequence(tile(F.least(lo, hi), size), tile(hi, size)), lambda ty: F.struct(tx.alias("tx"), ty.alias("ty")))

    return F.flatten(F.transform(tile_range(F.least(x1, x2), F.greatest(x1, x2), size), rows))


def ring_edges(ring) -> Column:
    """Edges of a ring (implicitly closed) as ``array<struct<x1,y1,x2,y2>>``."""
    r = col(ring)
    n = F.size(r)
    return F.transform(
        F.slice(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), F.lit(1), n),
        lambda i: F.struct(
            F.element_at(r, i + 1)["x"].alias("x1"), F.element_at(r, i + 1)["y"].alias("y1"),
            F.element_at(r, ((i + 1) % n) + 1)["x"].alias("x2"),
            F.element_at(r, ((i + 1) % n) + 1)["y"].alias("y2")))


def side(e, px, py) -> Column:
    """Cross product of edge direction and (p - edge start): > 0 left of the
    edge (inside a counter-clockwise ring), < 0 right, 0 on the line."""
    return (e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"])


def rect_corners(xmin, ymin, xmax, ymax):
    return [(col(xmin), col(ymin)), (col(xmax), col(ymin)),
            (col(xmax), col(ymax)), (col(xmin), col(ymax))]


def _param_interval(p0, d, lo, hi, strict: bool):
    """Interval of t where ``p0 + t d`` lies in (lo, hi) (``strict``) or in
    [lo, hi]; the empty interval is returned as (1, 0) when d = 0."""
    t1 = F.try_divide(lo - p0, d)
    t2 = F.try_divide(hi - p0, d)
    inside = ((p0 > lo) & (p0 < hi)) if strict else p0.between(lo, hi)
    a = F.when(d == 0, F.when(inside, F.lit(float("-inf"))).otherwise(F.lit(1.0))).otherwise(F.least(t1, t2))
    b = F.when(d == 0, F.when(inside, F.lit(float("inf"))).otherwise(F.lit(0.0))).otherwise(F.greatest(t1, t2))
    return a, b


def segment_meets_rect(x1, y1, x2, y2, xmin, ymin, xmax, ymax, open_rect: bool = False) -> Column:
    """Segment (x1,y1)-(x2,y2) meets the closed rectangle, or with
    ``open_rect`` passes through its interior (parametric clipping)."""
    x1, y1, x2, y2 = col(x1), col(y1), col(x2), col(y2)
    ax, bx = _param_interval(x1, x2 - x1, col(xmin), col(xmax), open_rect)
    ay, by = _param_interval(y1, y2 - y1, col(ymin), col(ymax), open_rect)
    lo, hi = F.greatest(ax, ay, F.lit(0.0)), F.least(bx, by, F.lit(1.0))
    return (lo < hi) if open_rect else (lo <= hi)
