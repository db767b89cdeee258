"""Spatial stand-in queries.

Points are the first two embedding coordinates (about +-0.37); the grid is
0.05 wide; vectors with label < 5 play the cells with census data, label 9
the closed establishments. Oracles use plain arithmetic (no spatial
extension), with every constant cast to DOUBLE so that DuckDB does the same
floating-point operations as Spark.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from geoscore.functions import columns as X
from geoscore.operators import eav
from geoscore.operators import spatial as S
from geoscore.plans.catalog import ORACLES, R, register
from geoscore.sources.testdata import load

CELL = 0.05          # grid cell side
RADIUS = 0.05        # competitor radius
BOX_A = (-0.2, -0.2, 0.0, 0.0)     # own zone (xmin, ymin, xmax, ymax)
BOX_B = (-0.1, -0.1, 0.2, 0.2)     # neighbouring areas
# Commune shapes of the point-in-polygon stand-in (counter-clockwise rings).
POLYGONS = {
    1: [(-0.3, -0.3), (0.3, -0.3), (0.0, 0.3)],
    2: [(-0.35, 0.0), (0.0, 0.0), (0.0, 0.15), (0.15, 0.15), (0.15, 0.35), (-0.35, 0.35)],
    3: [(0.05, -0.2), (0.3, -0.2), (0.3, 0.05), (0.05, 0.05)],
}


def _points(spark, d):
    e = load(spark, d, "embeddings")
    return e.select("vec_id", "label",
                    F.col("embedding")[0].cast("double").alias("x"),
                    F.col("embedding")[1].cast("double").alias("y"))


def D(v) -> str:
    return f"CAST({v!r} AS DOUBLE)"


_P_SQL = f"""
WITH p AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y
           FROM embeddings)
"""


def _cells_sql(name: str, where: str = "TRUE") -> str:
    s = D(CELL)
    return f""", {name} AS (
  SELECT (cx + 50000) * 100000 + (cy + 50000) AS cell_id, cx, cy,
         cx * {s} AS xmin, cy * {s} AS ymin, (cx + 1) * {s} AS xmax, (cy + 1) * {s} AS ymax,
         (cx + 0.5::DOUBLE) * {s} AS xc, (cy + 0.5::DOUBLE) * {s} AS yc
  FROM (SELECT DISTINCT CAST(floor(x / {s}) AS BIGINT) AS cx, CAST(floor(y / {s}) AS BIGINT) AS cy
        FROM p WHERE {where}))
"""


# ---------------------------------------------------------------------------
# point_in_cell: J5 T4
# ---------------------------------------------------------------------------
def point_in_cell(spark, d):
    p = _points(spark, d)
    cells = S.grid_cells(p.where(F.col("label") < 5), "x", "y", CELL)
    return S.locate_points(p, cells, "vec_id", "x", "y", CELL).select("vec_id", "cell_id")


register("point_in_cell", oracle=_P_SQL + _cells_sql("cells", "label < 5") + """
SELECT p.vec_id, min(c.cell_id) AS cell_id
FROM p JOIN cells c ON p.x BETWEEN c.xmin AND c.xmax AND p.y BETWEEN c.ymin AND c.ymax
GROUP BY p.vec_id""")(point_in_cell)


# ---------------------------------------------------------------------------
# range_count: J10 A1 X22 ; inhabitants_per_site: X8 C8
# ---------------------------------------------------------------------------
def range_count(spark, d):
    p = _points(spark, d)
    cells = S.grid_cells(p, "x", "y", CELL)
    sites = p.where(F.col("label") != 9)
    return S.range_count(cells, sites, "cell_id", RADIUS)


_RANGE_SQL = _P_SQL + _cells_sql("cells") + f"""
, rc AS (
  SELECT c.cell_id, CAST(count(s.vec_id) AS BIGINT) AS n_sites
  FROM cells c LEFT JOIN (SELECT * FROM p WHERE label != 9) s
    ON (c.xc - s.x) * (c.xc - s.x) + (c.yc - s.y) * (c.yc - s.y) <= {D(RADIUS * RADIUS)}
  GROUP BY c.cell_id)
"""

register("range_count", oracle=_RANGE_SQL + "SELECT * FROM rc")(range_count)


def inhabitants_per_site(spark, d):
    p = _points(spark, d)
    rc = range_count(spark, d)
    cells = S.grid_cells(p, "x", "y", CELL).select("cell_id", "cx", "cy")
    dens = (p.where(F.col("label") < 5)
            .groupBy(S.grid_cell_id(F.floor(F.col("x") / CELL).cast("bigint"),
                                    F.floor(F.col("y") / CELL).cast("bigint")).alias("cell_id"))
            .agg(F.count(F.lit(1)).alias("density")))
    j = (cells.join(dens, "cell_id", "left").join(rc, "cell_id")
         .withColumn("density", F.coalesce("density", F.lit(0))))
    return j.select("cell_id", "density", "n_sites",
                    F.round(X.inhabitants_per_site("density", "n_sites"), 6).alias("inhabitants"))


register("inhabitants_per_site", oracle=_RANGE_SQL + f"""
, dens AS (SELECT (CAST(floor(x / {D(CELL)}) AS BIGINT) + 50000) * 100000
                  + (CAST(floor(y / {D(CELL)}) AS BIGINT) + 50000) AS cell_id, count(*) AS density
           FROM p WHERE label < 5 GROUP BY 1)
SELECT rc.cell_id, coalesce(dens.density, 0) AS density, rc.n_sites,
  {R('CAST(coalesce(dens.density, 0) AS DOUBLE) / (CAST(rc.n_sites AS DOUBLE) + 1.0) * 3.14::DOUBLE * 25.0 / 4.0', 6)} AS inhabitants
FROM rc LEFT JOIN dens ON rc.cell_id = dens.cell_id""")(inhabitants_per_site)


# ---------------------------------------------------------------------------
# cells_union: U1 T5
# ---------------------------------------------------------------------------
def cells_union(spark, d):
    p = _points(spark, d)
    cells = S.grid_cells(p, "x", "y", CELL)
    census = S.grid_cells(p.where(F.col("label") < 5), "x", "y", CELL).select("cell_id")
    ax0, ay0, ax1, ay1 = BOX_A
    bx0, by0, bx1, by1 = BOX_B
    a = (cells.join(census, "cell_id", "left_semi")
         .where((F.col("xmin") <= ax1) & (F.col("xmax") >= ax0)
                & (F.col("ymin") <= ay1) & (F.col("ymax") >= ay0)))
    b = cells.where((F.col("xmin") >= bx0) & (F.col("xmax") <= bx1)
                    & (F.col("ymin") >= by0) & (F.col("ymax") <= by1))
    return S.union_cells(a.select("cell_id"), b.select("cell_id"))


register("cells_union", oracle=_P_SQL + _cells_sql("cells") + _cells_sql("census", "label < 5") + f"""
SELECT cell_id FROM cells WHERE cell_id IN (SELECT cell_id FROM census)
  AND xmin <= {D(BOX_A[2])} AND xmax >= {D(BOX_A[0])} AND ymin <= {D(BOX_A[3])} AND ymax >= {D(BOX_A[1])}
UNION
SELECT cell_id FROM cells
WHERE xmin >= {D(BOX_B[0])} AND xmax <= {D(BOX_B[2])} AND ymin >= {D(BOX_B[1])} AND ymax <= {D(BOX_B[3])}
""")(cells_union)


# ---------------------------------------------------------------------------
# point_in_polygon: J9
# ---------------------------------------------------------------------------
def _polygons(spark):
    rows = [(k, [{"x": float(a), "y": float(b)} for a, b in ring]) for k, ring in POLYGONS.items()]
    return spark.createDataFrame(rows, "poly_id int, ring array<struct<x:double,y:double>>")


def point_in_polygon(spark, d):
    p = _points(spark, d)
    return S.points_within(p, _polygons(spark), "vec_id", "x", "y", "poly_id", "ring", CELL)


def _edges_values() -> str:
    vals = []
    for k, ring in POLYGONS.items():
        n = len(ring)
        for i in range(n):
            (x1, y1), (x2, y2) = ring[i], ring[(i + 1) % n]
            vals.append(f"({k}, {D(float(x1))}, {D(float(y1))}, {D(float(x2))}, {D(float(y2))})")
    return ", ".join(vals)


register("point_in_polygon", oracle=_P_SQL + f"""
, e(poly_id, x1, y1, x2, y2) AS (VALUES {_edges_values()})
SELECT p.vec_id, e.poly_id FROM p CROSS JOIN e
GROUP BY p.vec_id, e.poly_id
HAVING sum(CASE WHEN (e.y1 > p.y) != (e.y2 > p.y)
                 AND p.x < e.x1 + (p.y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) THEN 1 ELSE 0 END) % 2 = 1
   AND max(CASE WHEN (e.x2 - e.x1) * (p.y - e.y1) - (e.y2 - e.y1) * (p.x - e.x1) = 0
                 AND p.x BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
                 AND p.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2) THEN 1 ELSE 0 END) = 0
""")(point_in_polygon)


# ---------------------------------------------------------------------------
# neighbour_areas: J8
# ---------------------------------------------------------------------------
def neighbour_areas(spark, d):
    p = _points(spark, d)
    cells = S.grid_cells(p, "x", "y", CELL)
    areas = cells.select("cell_id", S.rect_ring("xmin", "ymin", "xmax", "ymax").alias("ring"))
    return S.touching_areas(areas, "cell_id", "ring", CELL)


register("neighbour_areas", oracle=_P_SQL + _cells_sql("cells") + """
SELECT a.cell_id AS a, b.cell_id AS b FROM cells a JOIN cells b
  ON abs(a.cx - b.cx) <= 1 AND abs(a.cy - b.cy) <= 1 AND a.cell_id != b.cell_id""")(neighbour_areas)


# ---------------------------------------------------------------------------
# neighbour_areas_mixed: J8 over areas without shared vertices
# ---------------------------------------------------------------------------
# Areas in whole grid units: a block of 2 x 2 cells stays whole where it has
# few points, is cut along its diagonal where it has some, and into cells
# where it has many; larger ones then touch the middle of others' edges.
SOME, MANY = 4, 8


def mixed_areas(points):
    """``area, ring`` of the blocks' areas; area = block id x 10 + part."""
    blocks = (points.groupBy(F.floor(F.col("x") / (2 * CELL)).alias("bx"), F.floor(F.col("y") / (2 * CELL)).alias("by"))
              .agg(F.count(F.lit(1)).alias("n"))
              .select("n", S.grid_cell_id(F.col("bx"), F.col("by")).alias("block"),
                      (2.0 * F.col("bx")).alias("x"), (2.0 * F.col("by")).alias("y")))

    def part(k, *corners):
        ring = F.array(*[F.struct((F.col("x") + a).alias("x"), (F.col("y") + b).alias("y")) for a, b in corners])
        return F.struct((F.col("block") * 10 + k).alias("area"), ring.alias("ring"))

    whole = F.array(part(0, (0, 0), (2, 0), (2, 2), (0, 2)))
    halves = F.array(part(1, (0, 0), (2, 0), (2, 2)), part(2, (0, 0), (2, 2), (0, 2)))
    cells = F.array(*[part(3 + 2 * i + j, (i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)) for i in (0, 1) for j in (0, 1)])
    return blocks.select(F.explode(F.when(F.col("n") >= MANY, cells).when(F.col("n") >= SOME, halves).otherwise(whole)).alias("a")).select("a.*")


def neighbour_areas_mixed(spark, d):
    return S.touching_areas(mixed_areas(_points(spark, d)), "area", "ring", 4.0)


def _mixed_edges_sql() -> str:
    shapes = {"n < %d" % SOME: {0: [(0, 0), (2, 0), (2, 2), (0, 2)]},
              "n >= %d AND n < %d" % (SOME, MANY): {1: [(0, 0), (2, 0), (2, 2)], 2: [(0, 0), (2, 2), (0, 2)]},
              "n >= %d" % MANY: {3 + 2 * i + j: [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)] for i in (0, 1) for j in (0, 1)}}
    out = []
    for where, parts in shapes.items():
        for k, ring in parts.items():
            for (a, b), (c, e) in zip(ring, ring[1:] + ring[:1]):
                out.append(f"SELECT block * 10 + {k} AS area, x + {a} AS x1, y + {b} AS y1, x + {c} AS x2, y + {e} AS y2 FROM blocks WHERE {where}")
    return "\nUNION ALL ".join(out)


register("neighbour_areas_mixed", oracle=_P_SQL + f"""
, blocks AS (
  SELECT (cx + 50000) * 100000 + (cy + 50000) AS block, 2 * cx AS x, 2 * cy AS y, n
  FROM (SELECT CAST(floor(x / {D(2 * CELL)}) AS BIGINT) AS cx, CAST(floor(y / {D(2 * CELL)}) AS BIGINT) AS cy, count(*) AS n
        FROM p GROUP BY 1, 2)),
e AS ({_mixed_edges_sql()}),
hit AS (
  SELECT v.area AS a, e.area AS b FROM (SELECT DISTINCT area, x1 AS x, y1 AS y FROM e) v JOIN e
    ON v.area != e.area AND (e.x2 - e.x1) * (v.y - e.y1) = (e.y2 - e.y1) * (v.x - e.x1)
   AND v.x BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) AND v.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2))
SELECT a, b FROM hit UNION SELECT b, a FROM hit""")(neighbour_areas_mixed)


# ---------------------------------------------------------------------------
# point_in_parts (J9), cells_in_parts (J7 X21): areas with holes and parts
# ---------------------------------------------------------------------------
# Rings of each area, outer ones and holes alike.
PARTS = {
    1: [[(-0.32, -0.3), (0.3, -0.31), (0.28, 0.3), (-0.3, 0.27)], [(-0.1, -0.12), (0.16, -0.1), (0.06, 0.17)]],
    2: [[(-0.35, 0.05), (-0.05, 0.32), (-0.33, 0.33)], [(0.05, 0.1), (0.3, 0.1), (0.3, 0.25), (0.05, 0.25)]],
    3: [[(-0.2, -0.2), (0.2, -0.2), (0.2, 0.2), (-0.2, 0.2)], [(-0.15, -0.15), (-0.15, 0.15), (0.15, 0.15), (0.15, -0.15)],
        [(-0.05, -0.05), (0.05, -0.05), (0.05, 0.05), (-0.05, 0.05)]],
}


def _parts(spark):
    rows = [(k, [[{"x": float(a), "y": float(b)} for a, b in ring] for ring in rings]) for k, rings in PARTS.items()]
    return spark.createDataFrame(rows, "poly_id int, rings array<array<struct<x:double,y:double>>>")


def point_in_parts(spark, d):
    return S.points_within(_points(spark, d), _parts(spark), "vec_id", "x", "y", "poly_id", "rings", CELL)


def cells_in_parts(spark, d):
    cells = S.grid_cells(_points(spark, d), "x", "y", CELL)
    return S.cells_meet_polygons(cells, _parts(spark), "poly_id", "rings", CELL)


def _part_edges() -> str:
    return ", ".join(f"({k}, {D(float(x1))}, {D(float(y1))}, {D(float(x2))}, {D(float(y2))})"
                     for k, rings in PARTS.items() for ring in rings for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]))


def _inside_sql(points: str, key: str) -> str:
    """Points strictly inside the areas of ``e``: odd crossings, on no edge."""
    return f"""SELECT q.{key}, e.poly_id FROM {points} q CROSS JOIN e
  GROUP BY q.{key}, e.poly_id
  HAVING sum(CASE WHEN (e.y1 > q.y) != (e.y2 > q.y)
                  AND q.x < e.x1 + (q.y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) THEN 1 ELSE 0 END) % 2 = 1
    AND max(CASE WHEN (e.x2 - e.x1) * (q.y - e.y1) - (e.y2 - e.y1) * (q.x - e.x1) = 0
                  AND q.x BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
                  AND q.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2) THEN 1 ELSE 0 END) = 0"""


def _param_sql(p: str, q: str, lo: str, hi: str) -> tuple[str, str]:
    """Parameters between which the line p + t (q - p) lies in (lo, hi)."""
    ends = f"({lo} - {p}) / ({q} - {p}), ({hi} - {p}) / ({q} - {p})"
    flat = f"CASE WHEN {p} > {lo} AND {p} < {hi} THEN {{}} ELSE {{}} END"
    return (f"CASE WHEN {p} = {q} THEN {flat.format('-1e300', '1.0')} ELSE least({ends}) END",
            f"CASE WHEN {p} = {q} THEN {flat.format('1e300', '0.0')} ELSE greatest({ends}) END")


_PARTS_SQL = _P_SQL + f", e(poly_id, x1, y1, x2, y2) AS (VALUES {_part_edges()})"
_AX, _BX = _param_sql("e.x1", "e.x2", "c.xmin", "c.xmax")
_AY, _BY = _param_sql("e.y1", "e.y2", "c.ymin", "c.ymax")

register("point_in_parts", oracle=_PARTS_SQL + _inside_sql("p", "vec_id"))(point_in_parts)
register("cells_in_parts", oracle=_PARTS_SQL + _cells_sql("cells") + f"""
, centres AS (SELECT cell_id, xc AS x, yc AS y FROM cells)
{_inside_sql("centres", "cell_id")}
UNION
SELECT c.cell_id, e.poly_id FROM cells c JOIN e
  ON (e.x1 > c.xmin AND e.x1 < c.xmax AND e.y1 > c.ymin AND e.y1 < c.ymax)
  OR greatest({_AX}, {_AY}, 0.0) < least({_BX}, {_BY}, 1.0)""")(cells_in_parts)


# ---------------------------------------------------------------------------
# cell_zone_intersect: X18 J6 J7 ; zone_centre_cell: X19 C5
# ---------------------------------------------------------------------------
def cell_zone_intersect(spark, d):
    p = _points(spark, d)
    hulls = S.convex_hulls(p, "label", "x", "y")
    cells = S.grid_cells(p, "x", "y", CELL)
    return S.cells_vs_hulls(cells, hulls, "label", CELL)


register("cell_zone_intersect", note="hulls per label; brute force in tests")(cell_zone_intersect)


def zone_centre_cell(spark, d):
    p = _points(spark, d)
    hulls = S.convex_hulls(p, "label", "x", "y")
    cells = S.grid_cells(p.where(F.col("label") < 5), "x", "y", CELL)
    centres = hulls.select("label", F.col("centroid_x").alias("x"), F.col("centroid_y").alias("y"),
                           "n_vertices")
    loc = S.locate_points(centres, cells, "label", "x", "y", CELL, how="left")
    return centres.join(loc.select("label", "cell_id"), "label", "left")


register("zone_centre_cell", note="centroid of hull; brute force in tests")(zone_centre_cell)


# ---------------------------------------------------------------------------
# cell_zone_flags: J6 J7 against literal convex zones (SQL-checkable twin of
# cell_zone_intersect, whose zones are data-derived hulls)
# ---------------------------------------------------------------------------
# Drawn zones of the stand-in (counter-clockwise convex rings).
ZONES = {
    1: [(-0.2, -0.15), (0.1, -0.2), (0.15, 0.05), (-0.1, 0.12)],
    2: [(0.05, 0.05), (0.3, 0.1), (0.12, 0.3)],
    3: [(-0.012, -0.012), (0.012, -0.012), (0.012, 0.012), (-0.012, 0.012)],
}


def _zones(spark):
    rows = [(k, [{"x": float(a), "y": float(b)} for a, b in ring]) for k, ring in ZONES.items()]
    return spark.createDataFrame(rows, "zone_id int, hull array<struct<x:double,y:double>>")


def cell_zone_flags(spark, d):
    p = _points(spark, d)
    cells = S.grid_cells(p, "x", "y", CELL)
    return S.cells_vs_hulls(cells, _zones(spark), "zone_id", CELL)


def _zone_edges_values() -> str:
    vals = []
    for k, ring in ZONES.items():
        n = len(ring)
        for i in range(n):
            (x1, y1), (x2, y2) = ring[i], ring[(i + 1) % n]
            vals.append(f"({k}, {D(float(x1))}, {D(float(y1))}, {D(float(x2))}, {D(float(y2))})")
    return ", ".join(vals)


def _side(cx: str, cy: str) -> str:
    return f"((e.x2 - e.x1) * ({cy} - e.y1) - (e.y2 - e.y1) * ({cx} - e.x1))"


def _all_corners(op: str) -> str:
    corners = [("c.xmin", "c.ymin"), ("c.xmax", "c.ymin"), ("c.xmax", "c.ymax"), ("c.xmin", "c.ymax")]
    return " AND ".join(f"{_side(x, y)} {op} 0" for x, y in corners)


register("cell_zone_flags", oracle=_P_SQL + _cells_sql("cells") + f"""
, e(zone_id, x1, y1, x2, y2) AS (VALUES {_zone_edges_values()}),
zb AS (SELECT zone_id, min(x1) AS hxmin, max(x1) AS hxmax, min(y1) AS hymin, max(y1) AS hymax
       FROM e GROUP BY zone_id),
pairs AS (
  SELECT c.cell_id, c.xmin, c.ymin, c.xmax, c.ymax, zb.*
  FROM cells c JOIN zb ON c.xmin <= zb.hxmax AND c.xmax >= zb.hxmin
                      AND c.ymin <= zb.hymax AND c.ymax >= zb.hymin),
f AS (
  SELECT p.cell_id, p.zone_id,
    bool_or({_all_corners('<')}) AS strict_sep,
    bool_or({_all_corners('<=')}) AS touch_sep,
    bool_and({_all_corners('>=')}) AS cell_in_zone,
    bool_and(e.x1 BETWEEN p.xmin AND p.xmax AND e.y1 BETWEEN p.ymin AND p.ymax) AS zone_in_cell,
    min(p.xmax <= p.hxmin OR p.xmin >= p.hxmax OR p.ymax <= p.hymin OR p.ymin >= p.hymax) AS bbox_touch
  FROM pairs p JOIN e ON e.zone_id = p.zone_id
  CROSS JOIN LATERAL (SELECT p.xmin, p.ymin, p.xmax, p.ymax) c
  GROUP BY p.cell_id, p.zone_id)
SELECT cell_id, zone_id, NOT strict_sep AS intersects,
  (NOT (touch_sep OR bbox_touch)) AND (NOT zone_in_cell OR cell_in_zone) AS overlaps_or_within
FROM f""")(cell_zone_flags)


# ---------------------------------------------------------------------------
# zone_mean_score: C10 / C14, mean of a stored cell score over a zone's cells
# ---------------------------------------------------------------------------
def zone_mean_score(spark, d):
    """Scores are whole grid units, whose sums are exact in any order; the
    mean is scaled to a score once."""
    cells = S.grid_cells(_points(spark, d), "x", "y", CELL)
    hit = S.cells_vs_hulls(cells, _zones(spark), "zone_id", CELL).where("intersects").select("zone_id", "cell_id")
    units = cells.select("cell_id", F.abs(F.col("cy") + F.col("cx")).cast("double").alias("valeur"))
    means = eav.group_means(hit.join(units, "cell_id"), ["zone_id"], ["valeur"], scale=None)
    return means.withColumn("valeur", F.round(F.col("valeur") * CELL, 3))


register("zone_mean_score", oracle=f"""
SELECT z.zone_id, {R(f'CAST(sum(abs(c.cy + c.cx)) AS DOUBLE) / CAST(count(*) AS DOUBLE) * {D(CELL)}', 3)} AS valeur
FROM ({ORACLES["cell_zone_flags"]}) z JOIN ({_P_SQL + _cells_sql("cells")} SELECT * FROM cells) c ON z.cell_id = c.cell_id
WHERE z.intersects GROUP BY z.zone_id""")(zone_mean_score)
