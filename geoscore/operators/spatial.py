"""Distributed spatial joins on the grid.

Spark has no spatial predicates, so every spatial join is an equi-join on
tile keys (both sides bucketed by ``floor(coord / size)``) followed by an
exact refine on the candidate pairs. No join ever compares all pairs:
candidates only meet inside their tile.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoscore.functions.geometry import (geometry_edges, geometry_points, rect_corners, ring_edges, segment_meets_rect,
                                        segment_tiles, side, sq_dist, tile, tile_range)
from geoscore.operators.joins import bounded_broadcast
from geoscore.session import materialize


# ---------------------------------------------------------------------------
# Grid cells
# ---------------------------------------------------------------------------
def grid_cell_id(cx, cy) -> F.Column:
    """Numeric id of a grid cell from its integer indexes."""
    return ((cx + F.lit(50000)) * F.lit(100000) + (cy + F.lit(50000))).cast("bigint")


def grid_cells(points: DataFrame, x: str, y: str, size: float) -> DataFrame:
    """Cells of a regular grid that hold at least one point, as rectangles:
    ``cell_id, cx, cy, xmin, ymin, xmax, ymax, xc, yc`` (centre)."""
    s = F.lit(float(size))
    idx = points.select(tile(x, size).alias("cx"), tile(y, size).alias("cy")).distinct()
    return idx.select(
        grid_cell_id(F.col("cx"), F.col("cy")).alias("cell_id"), "cx", "cy",
        (F.col("cx") * s).alias("xmin"), (F.col("cy") * s).alias("ymin"),
        ((F.col("cx") + 1) * s).alias("xmax"), ((F.col("cy") + 1) * s).alias("ymax"),
        ((F.col("cx") + F.lit(0.5)) * s).alias("xc"), ((F.col("cy") + F.lit(0.5)) * s).alias("yc"))


# ---------------------------------------------------------------------------
# Locate points in cells (closed rectangles)
# ---------------------------------------------------------------------------
def locate_points(points: DataFrame, cells: DataFrame, key: str, x: str, y: str,
                  tile_size: float, how: str = "inner") -> DataFrame:
    """Each point with the smallest ``cell_id`` whose closed rectangle
    contains it (a point on a shared edge touches two cells; the smallest id
    wins, deterministically). Cells are exploded to the tiles their rectangle
    covers (boundary tiles included), points fall in exactly one tile."""
    ct = cells.select(
        "cell_id", "xmin", "ymin", "xmax", "ymax",
        F.explode(tile_range("xmin", "xmax", tile_size)).alias("tx"),
    ).select("*", F.explode(tile_range("ymin", "ymax", tile_size)).alias("ty"))
    pt = points.select(key, x, y, tile(x, tile_size).alias("tx"), tile(y, tile_size).alias("ty"))
    cond = ((pt.tx == ct.tx) & (pt.ty == ct.ty)
            & F.col(x).between(F.col("xmin"), F.col("xmax"))
            & F.col(y).between(F.col("ymin"), F.col("ymax")))
    j = pt.join(ct, cond, "left" if how == "left" else "inner")
    return j.groupBy(key, x, y).agg(F.min("cell_id").alias("cell_id"))


# ---------------------------------------------------------------------------
# Count sites within a radius (inclusive), unmatched kept as 0
# ---------------------------------------------------------------------------
def _radius_offsets(k: int):
    """Bucket offsets (dx, dy) around a centre's bucket for buckets of side
    r / k: ``full`` buckets lie within r of every point of the centre's
    bucket ((|dx|+1)^2 + (|dy|+1)^2 <= k^2), ``partial`` ones may hold sites
    within r ((|dx|-1)+^2 + (|dy|-1)+^2 <= k^2) and need a distance test.
    Excluded offsets are farther than r by at least a few percent, and full
    ones nearer by at least a few percent, so a point bucketed one ulp off
    its true bucket cannot change the count."""
    full, partial = [], []
    for dx in range(-k - 1, k + 2):
        for dy in range(-k - 1, k + 2):
            ax, ay = abs(dx), abs(dy)
            if (ax + 1) ** 2 + (ay + 1) ** 2 <= k * k:
                full.append((dx, dy))
            elif max(ax - 1, 0) ** 2 + max(ay - 1, 0) ** 2 <= k * k:
                partial.append((dx, dy))
    return full, partial


def range_count(centres: DataFrame, sites: DataFrame, key: str, radius: float,
                cx: str = "xc", cy: str = "yc", sx: str = "x", sy: str = "y",
                out: str = "n_sites", k: int = 4) -> DataFrame:
    """For every centre, the number of sites at distance <= radius (exact).

    Two levels on a grid of side ``radius / k``; sites are counted per bucket
    first, and the work beyond that follows the centres' buckets:

    * in each grid row the buckets that lie wholly within the radius of a
      centre's bucket are neighbours, so their sites are the difference of two
      running sums along that row: two values a row are read, no bucket is
      copied;
    * only the ring of boundary buckets is tested site by site. The centre
      buckets name the ring buckets they need; a site meets each centre bucket
      that needs it and no other, and sites far from any centre leave there.
      Sites are collapsed to distinct locations first.

    Counts are attached to every centre by its key; centres with no site in
    range get 0.
    """
    r = float(radius)
    size = r / k
    full, partial = _radius_offsets(k)

    def offsets(rows, names):
        return F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows])

    sb = sites.select(F.col(sx).alias("_sx"), F.col(sy).alias("_sy"),
                      tile(sx, size).alias("_bx"), tile(sy, size).alias("_by"))
    c = centres.select(key, cx, cy, tile(cx, size).alias("_cbx"), tile(cy, size).alias("_cby"))
    cb = c.select("_cbx", "_cby").distinct()
    parts = []
    if full:
        # level 1: (row, first bucket - 1, last bucket) of the whole buckets, as signed reads of the running sum
        reach = {dy: max(dx for dx, d in full if d == dy) for dy in sorted({d for _, d in full})}
        reads = offsets([(dy, w, 1) for dy, w in reach.items()] + [(dy, -w - 1, -1) for dy, w in reach.items()], ("dy", "dx", "sign"))
        ask = (cb.withColumn("o", F.explode(reads))
               .select((F.col("_cby") + F.col("o.dy")).alias("_by"), (F.col("_cbx") + F.col("o.dx")).alias("_bx"),
                       F.lit(None).cast("long").alias("_n"), F.col("o.sign").alias("_sign"), "_cbx", "_cby"))
        per_bucket = (sb.groupBy("_by", "_bx").agg(F.count(F.lit(1)).alias("_n"))
                      .select("_by", "_bx", "_n", F.lit(None).cast("int").alias("_sign"),
                              F.lit(None).cast("long").alias("_cbx"), F.lit(None).cast("long").alias("_cby")))
        # a row holds one entry a bucket and the reads of nearby centre buckets, never single sites
        along = Window.partitionBy("_by").orderBy("_bx").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        whole = (per_bucket.unionByName(ask).withColumn("_sum", F.sum("_n").over(along)).where("_sign IS NOT NULL")
                 .groupBy("_cbx", "_cby").agg(F.sum(F.col("_sign") * F.coalesce("_sum", F.lit(0))).alias("_full")))
        parts.append(c.join(whole, ["_cbx", "_cby"]).select(key, F.col("_full").alias("_n")))
    # level 2: boundary buckets, site by site (distinct locations)
    ring = (cb.withColumn("o", F.explode(offsets(partial, ("dx", "dy"))))
            .select("_cbx", "_cby", (F.col("_cbx") + F.col("o.dx")).alias("_bx"), (F.col("_cby") + F.col("o.dy")).alias("_by")))
    loc = sb.groupBy("_sx", "_sy", "_bx", "_by").agg(F.count(F.lit(1)).alias("_w"))
    parts.append(loc.join(ring, ["_bx", "_by"]).select("_cbx", "_cby", "_sx", "_sy", "_w").join(c, ["_cbx", "_cby"])
                 .where(sq_dist(cx, cy, "_sx", "_sy") <= F.lit(r * r))
                 .select(key, F.col("_w").alias("_n")))
    hits = parts[0]
    for p in parts[1:]:
        hits = hits.unionByName(p)
    hits = hits.groupBy(key).agg(F.sum("_n").alias("_n"))
    return (centres.select(key).join(hits, key, "left")
            .select(key, F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias(out)))


# ---------------------------------------------------------------------------
# Point strictly within polygon (ring parity, boundary excluded)
# ---------------------------------------------------------------------------
def polygon_edges(polygons: DataFrame, poly_key: str, ring: str, strip: float) -> DataFrame:
    """Edges of every polygon (all its rings), each copied to the horizontal
    strips its y-range covers: ``poly_key, strip, x1, y1, x2, y2``."""
    e = polygons.select(poly_key, F.explode(geometry_edges(polygons, ring)).alias("e")).select(poly_key, "e.*")
    return e.withColumn("strip", F.explode(tile_range(F.least("y1", "y2"),
                                                      F.greatest("y1", "y2"), strip)))


def polygon_bboxes(polygons: DataFrame, poly_key: str, ring: str) -> DataFrame:
    r = geometry_points(polygons, ring)
    return polygons.select(
        poly_key,
        F.array_min(F.transform(r, lambda p: p["x"])).alias("pxmin"),
        F.array_max(F.transform(r, lambda p: p["x"])).alias("pxmax"),
        F.array_min(F.transform(r, lambda p: p["y"])).alias("pymin"),
        F.array_max(F.transform(r, lambda p: p["y"])).alias("pymax"))


def points_within(points: DataFrame, polygons: DataFrame, key: str, x: str, y: str,
                  poly_key: str, ring: str, tile_size: float) -> DataFrame:
    """Pairs ``(key, poly_key)`` with the point strictly inside the polygon,
    which may have holes and several parts (see ``geometry_edges``).

    Candidates: point tile joined with the tiles of the polygon's bounding box.
    Refine: a ray to +x crosses the ring an odd number of times (half-open
    rule on vertices), and the point lies on no edge. Only edges of the
    point's horizontal strip can cross its ray or contain it, so the pair is
    joined with those edges alone.
    """
    bb = polygon_bboxes(polygons, poly_key, ring)
    bt = (bb.withColumn("tx", F.explode(tile_range("pxmin", "pxmax", tile_size)))
          .withColumn("ty", F.explode(tile_range("pymin", "pymax", tile_size))))
    pt = points.select(key, x, y, tile(x, tile_size).alias("tx"), tile(y, tile_size).alias("ty"))
    cand = (pt.join(bt, ["tx", "ty"])
            .where(F.col(x).between(F.col("pxmin"), F.col("pxmax"))
                   & F.col(y).between(F.col("pymin"), F.col("pymax")))
            .select(key, x, y, poly_key, tile(y, tile_size).alias("strip")))
    edges = polygon_edges(polygons, poly_key, ring, tile_size)
    px, py = F.col(x), F.col(y)
    x1, y1, x2, y2 = F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")
    spans = (y1 > py) != (y2 > py)
    crosses = spans & (px < x1 + F.try_divide((py - y1) * (x2 - x1), y2 - y1))
    on_edge = (((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)) == 0) \
        & px.between(F.least(x1, x2), F.greatest(x1, x2)) \
        & py.between(F.least(y1, y2), F.greatest(y1, y2))
    j = cand.join(edges, [poly_key, "strip"])
    agg = j.groupBy(key, poly_key).agg(
        F.sum(F.when(crosses, 1).otherwise(0)).alias("_n"),
        F.max(F.when(on_edge, 1).otherwise(0)).alias("_on"))
    return agg.where((F.col("_n") % 2 == 1) & (F.col("_on") == 0)).select(key, poly_key)


# ---------------------------------------------------------------------------
# Tiles for joins of points and segments, finer where they crowd
# ---------------------------------------------------------------------------
def crowded_tiles(points: DataFrame, segments: DataFrame, x: str, y: str, size: float,
                  most: int = 4096, finer: int = 8, levels: int = 4) -> tuple[DataFrame, DataFrame]:
    """``points`` and ``segments`` (``x1, y1, x2, y2``) with ``level, tx, ty``.

    Both start on tiles of side ``size``; what lies in a tile with more than
    ``most`` rows of either goes on to tiles ``finer`` times smaller, at most
    ``levels`` times. A point and a segment through it always meet."""
    done_p, done_s = [], []
    for level in range(levels):
        pt = points.withColumn("level", F.lit(level)).withColumn("tx", tile(x, size)).withColumn("ty", tile(y, size))
        st = (segments.withColumn("t", F.explode(segment_tiles("x1", "y1", "x2", "y2", size)))
              .withColumn("level", F.lit(level)).withColumn("tx", F.col("t.tx")).withColumn("ty", F.col("t.ty")).drop("t")
              .join(pt.select("tx", "ty").distinct(), ["tx", "ty"], "left_semi"))
        if level == levels - 1:
            crowd = None
        else:
            crowd = materialize(pt.select("tx", "ty").unionAll(st.select("tx", "ty")).groupBy("tx", "ty").count()
                                .where(F.col("count") > most).select("tx", "ty"))
        if crowd is None or crowd.isEmpty():
            done_p.append(pt)
            done_s.append(st)
            break
        done_p.append(pt.join(crowd, ["tx", "ty"], "left_anti"))
        done_s.append(st.join(crowd, ["tx", "ty"], "left_anti"))
        points = pt.join(crowd, ["tx", "ty"], "left_semi").select(*points.columns)
        # a segment may pass several crowded tiles: once is enough
        segments = st.join(crowd, ["tx", "ty"], "left_semi").select(*segments.columns).distinct()
        size = size / finer
    return reduce(DataFrame.unionByName, done_p), reduce(DataFrame.unionByName, done_s)


# ---------------------------------------------------------------------------
# Neighbouring areas (boundaries in contact, different area)
# ---------------------------------------------------------------------------
def touching_areas(areas: DataFrame, area_key: str, ring: str, tile_size: float) -> DataFrame:
    """Pairs ``(a, b)``, both ways, of areas whose boundaries share a point.

    Areas are those of a planar partition (interiors apart); rings may have
    holes and parts. Where two such boundaries meet, a vertex of one lies on
    an edge of the other: at a shared vertex, at a T-junction in the middle of
    the other's edge, or at the end of a shared stretch. Vertices therefore
    meet the edges of their tile, and only exact contacts stay."""
    e = areas.select(area_key, F.explode(geometry_edges(areas, ring)).alias("e")).select(F.col(area_key).alias("b"), "e.*")
    v = e.select(F.col("b").alias("a"), F.col("x1").alias("vx"), F.col("y1").alias("vy")).distinct()
    pt, st = crowded_tiles(v, e, "vx", "vy", tile_size)
    vx, vy, x1, y1, x2, y2 = (F.col(c) for c in ("vx", "vy", "x1", "y1", "x2", "y2"))
    on_edge = (((x2 - x1) * (vy - y1) - (y2 - y1) * (vx - x1)) == 0) \
        & vx.between(F.least(x1, x2), F.greatest(x1, x2)) & vy.between(F.least(y1, y2), F.greatest(y1, y2))
    met = pt.join(st, ["level", "tx", "ty"]).where((F.col("a") != F.col("b")) & on_edge).select("a", "b").distinct()
    return met.unionByName(met.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def rect_ring(xmin, ymin, xmax, ymax):
    """Counter-clockwise ring of a rectangle."""
    return F.array(*[F.struct(cx.alias("x"), cy.alias("y"))
                     for cx, cy in rect_corners(xmin, ymin, xmax, ymax)])


# ---------------------------------------------------------------------------
# Convex hull and centroid per group (prefiltered, skew safe)
# ---------------------------------------------------------------------------
DIRECTIONS = 16                 # in which a group's extreme points are taken
MAX_BROADCAST_GROUPS = 100_000  # groups whose extreme points (32 numbers each) are broadcast
HULL_BUCKETS = 64               # buckets of partitions that merge a group's vertices first


def _hull_np(xy: np.ndarray) -> np.ndarray:
    """Monotone-chain convex hull, counter-clockwise, no repeated vertex."""
    pts = np.unique(xy, axis=0)
    if len(pts) <= 2:
        return pts
    order = np.lexsort((pts[:, 1], pts[:, 0]))
    pts = pts[order]

    def cross(o, a, b):
        return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])

    lower, upper = [], []
    for p in pts:
        while len(lower) >= 2 and cross(lower[-2], lower[-1], p) <= 0:
            lower.pop()
        lower.append(tuple(p))
    for p in pts[::-1]:
        while len(upper) >= 2 and cross(upper[-2], upper[-1], p) <= 0:
            upper.pop()
        upper.append(tuple(p))
    return np.array(lower[:-1] + upper[:-1])


def _centroid_np(h: np.ndarray) -> tuple[float, float]:
    if len(h) == 1:
        return float(h[0, 0]), float(h[0, 1])
    if len(h) == 2:
        return float(h[:, 0].mean()), float(h[:, 1].mean())
    x, y = h[:, 0], h[:, 1]
    xn, yn = np.roll(x, -1), np.roll(y, -1)
    c = x * yn - xn * y
    area = c.sum() / 2.0
    if area == 0:
        i, j = np.argmin(x + y), np.argmax(x + y)
        return float((x[i] + x[j]) / 2), float((y[i] + y[j]) / 2)
    return float(((x + xn) * c).sum() / (6 * area)), float(((y + yn) * c).sum() / (6 * area))


def maybe_hull_points(points: DataFrame, group_col: str) -> DataFrame:
    """``group, x, y`` of the points that can be vertices of their group's hull.

    A hash aggregate finds each group's extreme points in DIRECTIONS
    directions; what lies strictly inside the polygon they span (by a margin
    above rounding) is no vertex. All of it are built-in expressions: of evenly
    spread points only those near the rim are left."""
    turns = [2 * math.pi * k / DIRECTIONS for k in range(DIRECTIONS)]
    ahead = [F.col("x") * F.lit(math.cos(t)) + F.col("y") * F.lit(math.sin(t)) for t in turns]
    extremes = materialize(points.groupBy(group_col).agg(
        *[F.max_by(c, p).alias(f"_{c}{k}") for k, p in enumerate(ahead) for c in ("x", "y")]))
    x, y = F.col("x"), F.col("y")
    inside, spans = F.lit(True), F.lit(False)
    for k in range(DIRECTIONS):
        n = (k + 1) % DIRECTIONS
        x1, y1, x2, y2 = F.col(f"_x{k}"), F.col(f"_y{k}"), F.col(f"_x{n}"), F.col(f"_y{n}")
        left, right = (x2 - x1) * (y - y1), (y2 - y1) * (x - x1)
        none = (x1 == x2) & (y1 == y2)
        inside = inside & (none | (left - right > F.lit(1e-9) * (F.abs(left) + F.abs(right))))
        spans = spans | ~none
    return (points.join(bounded_broadcast(extremes, MAX_BROADCAST_GROUPS), group_col)
            .where(~(inside & spans)).select(group_col, "x", "y"))


def convex_hulls(points: DataFrame, group_col: str, x: str, y: str) -> DataFrame:
    """Convex hull and its centroid per group.

    Points well inside are left out first (``maybe_hull_points``). The others
    are reduced to hull vertices inside every input partition
    (``mapInPandas``), so a hot group is split by the scan itself; these few
    vertices are merged by (group, bucket of partitions) and then by group.
    Output: ``group, hull array<struct<x,y>> (counter-clockwise), n_vertices,
    centroid_x, centroid_y``.
    """
    gtype = points.schema[group_col].dataType.simpleString()
    part_schema = f"{group_col} {gtype}, x double, y double"

    def partial(batches):
        acc = {}
        for pdf in batches:
            for g, sub in pdf.groupby(group_col, sort=False):
                xy = sub[["x", "y"]].to_numpy(dtype=float)
                if g in acc:
                    xy = np.vstack([acc[g], xy])
                acc[g] = _hull_np(xy)
        for g, h in acc.items():
            yield pd.DataFrame({group_col: [g] * len(h), "x": h[:, 0], "y": h[:, 1]})

    pts = points.select(group_col, F.col(x).cast("double").alias("x"),
                        F.col(y).cast("double").alias("y"))
    level1 = maybe_hull_points(pts, group_col).mapInPandas(partial, part_schema)

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        h = _hull_np(pdf[["x", "y"]].to_numpy(dtype=float))
        return pd.DataFrame({group_col: [pdf[group_col].iloc[0]] * len(h), "x": h[:, 0], "y": h[:, 1]})

    level2 = (level1.withColumn("_bucket", F.spark_partition_id() % HULL_BUCKETS)
              .groupBy(group_col, "_bucket").applyInPandas(merged, part_schema))

    out_schema = (f"{group_col} {gtype}, hull array<struct<x:double,y:double>>, "
                  "n_vertices int, centroid_x double, centroid_y double")

    def final(pdf: pd.DataFrame) -> pd.DataFrame:
        h = _hull_np(pdf[["x", "y"]].to_numpy(dtype=float))
        cx, cy = _centroid_np(h)
        return pd.DataFrame({group_col: [pdf[group_col].iloc[0]],
                             "hull": [[{"x": float(a), "y": float(b)} for a, b in h]],
                             "n_vertices": [len(h)], "centroid_x": [cx], "centroid_y": [cy]})

    return level2.groupBy(group_col).applyInPandas(final, out_schema)


# ---------------------------------------------------------------------------
# Cells against convex zones
# ---------------------------------------------------------------------------
def cells_vs_hulls(cells: DataFrame, hulls: DataFrame, group_col: str,
                   tile_size: float) -> DataFrame:
    """For every (cell, zone) whose bounding boxes meet, the flags
    ``intersects`` (closed sets meet, J6) and ``overlaps_or_within``
    (interiors meet and the zone is not strictly inside the cell, J7).

    Zones are convex hulls (counter-clockwise). Separating-axis test: a
    convex zone and a rectangle are disjoint iff all four corners lie
    strictly outside one zone edge, or the bounding boxes are apart. Tiles
    carry a zone's key and box only; its edges join the candidate pairs
    afterwards, once a pair, as an array.
    """
    h = hulls.select(
        group_col, "hull", ring_edges("hull").alias("edges"),
        F.array_min(F.transform("hull", lambda p: p["x"])).alias("hxmin"),
        F.array_max(F.transform("hull", lambda p: p["x"])).alias("hxmax"),
        F.array_min(F.transform("hull", lambda p: p["y"])).alias("hymin"),
        F.array_max(F.transform("hull", lambda p: p["y"])).alias("hymax"))
    box = ["hxmin", "hxmax", "hymin", "hymax"]
    ht = (h.select(group_col, *box).withColumn("tx", F.explode(tile_range("hxmin", "hxmax", tile_size)))
          .withColumn("ty", F.explode(tile_range("hymin", "hymax", tile_size))))
    ct = (cells.withColumn("tx", F.explode(tile_range("xmin", "xmax", tile_size)))
          .withColumn("ty", F.explode(tile_range("ymin", "ymax", tile_size))))
    # no hint: the zone side is small, and AQE turns these into broadcast
    # joins from the measured size of its shuffle output
    cand = (ct.join(ht, ["tx", "ty"])
            .where((F.col("xmin") <= F.col("hxmax")) & (F.col("xmax") >= F.col("hxmin"))
                   & (F.col("ymin") <= F.col("hymax")) & (F.col("ymax") >= F.col("hymin")))
            .select("cell_id", "xmin", "ymin", "xmax", "ymax", group_col).distinct()
            .join(h, group_col))
    corners = rect_corners("xmin", "ymin", "xmax", "ymax")
    n_vert = F.size("hull")

    def all_corners(e, pred):
        out = None
        for cx, cy in corners:
            t = pred(side(e, cx, cy))
            out = t if out is None else (out & t)
        return out

    area_zone = n_vert >= 3
    # closed sets apart: a strict separating edge (zones with >= 3 vertices)
    strict_sep = F.exists("edges", lambda e: all_corners(e, lambda s: s < 0)) & area_zone
    # interiors apart: a separating edge with touching allowed, or bboxes only touch
    touch_sep = (F.exists("edges", lambda e: all_corners(e, lambda s: s <= 0)) & area_zone) \
        | (F.col("xmax") <= F.col("hxmin")) | (F.col("xmin") >= F.col("hxmax")) \
        | (F.col("ymax") <= F.col("hymin")) | (F.col("ymin") >= F.col("hymax"))
    # degenerate zone: a point (one vertex) or a segment (two vertices) meets
    # the closed cell
    degenerate_hit = F.exists("edges", lambda e: segment_meets_rect(
        e["x1"], e["y1"], e["x2"], e["y2"], F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax")))
    intersects = F.when(area_zone, ~strict_sep).otherwise(degenerate_hit)
    zone_in_cell = F.forall("hull", lambda p: p["x"].between(F.col("xmin"), F.col("xmax"))
                            & p["y"].between(F.col("ymin"), F.col("ymax")))
    cell_in_zone = area_zone & F.forall("edges", lambda e: all_corners(e, lambda s: s >= 0))
    interiors_meet = area_zone & ~touch_sep
    ow = interiors_meet & (~zone_in_cell | cell_in_zone)
    return cand.select("cell_id", group_col, intersects.alias("intersects"),
                       ow.alias("overlaps_or_within"))


def cells_meet_polygons(cells: DataFrame, polygons: DataFrame, poly_key: str, geom: str,
                        tile_size: float) -> DataFrame:
    """``(cell_id, poly_key)`` where the cell's interior meets the polygon's,
    which may have holes and several parts.

    Interiors meet iff a polygon edge passes through the open cell, a vertex
    is strictly inside the cell, or the cell's centre is strictly inside the
    polygon (a cell in a hole has none of these). The three tests are tile
    joins: edges and vertices against the cells of their tiles, centres
    against polygons."""
    centres = cells.select("cell_id", F.col("xc").alias("x"), F.col("yc").alias("y"))
    a = points_within(centres, polygons, "cell_id", "x", "y", poly_key, geom, tile_size)
    ct = (cells.withColumn("tx", F.explode(tile_range("xmin", "xmax", tile_size)))
          .withColumn("ty", F.explode(tile_range("ymin", "ymax", tile_size))))
    verts = polygons.select(poly_key, F.explode(geometry_points(polygons, geom)).alias("v")).select(
        poly_key, F.col("v.x").alias("vx"), F.col("v.y").alias("vy"),
        tile("v.x", tile_size).alias("tx"), tile("v.y", tile_size).alias("ty"))
    b = (verts.join(ct, ["tx", "ty"])
         .where((F.col("vx") > F.col("xmin")) & (F.col("vx") < F.col("xmax"))
                & (F.col("vy") > F.col("ymin")) & (F.col("vy") < F.col("ymax")))
         .select("cell_id", poly_key))
    edges = (polygons.select(poly_key, F.explode(geometry_edges(polygons, geom)).alias("e")).select(poly_key, "e.*")
             .withColumn("t", F.explode(segment_tiles("x1", "y1", "x2", "y2", tile_size)))
             .withColumn("tx", F.col("t.tx")).withColumn("ty", F.col("t.ty")).drop("t"))
    crosses = segment_meets_rect("x1", "y1", "x2", "y2", "xmin", "ymin", "xmax", "ymax", open_rect=True)
    c = edges.join(ct, ["tx", "ty"]).where(crosses).select("cell_id", poly_key)
    return a.unionByName(b).unionByName(c).distinct()


def cells_in_zones(cells: DataFrame, hulls: DataFrame, group_col: str,
                   tile_size: float, mode: str = "overlaps_or_within") -> DataFrame:
    """Cells selected by a zone: ``mode`` is ``intersects`` (J6) or
    ``overlaps_or_within`` (J7)."""
    f = cells_vs_hulls(cells, hulls, group_col, tile_size)
    return f.where(F.col(mode)).select("cell_id", group_col)


# ---------------------------------------------------------------------------
# Union of candidate cell sets
# ---------------------------------------------------------------------------
def union_cells(*sets: DataFrame, key_cols=("cell_id",), cap: int | None = None) -> DataFrame:
    """Distinct union of cell sets on the key. ``cap`` (off by default)
    keeps the first ``cap`` cells in key order, a deterministic version of
    an unordered ``LIMIT``."""
    out = sets[0]
    for s in sets[1:]:
        out = out.unionByName(s)
    out = out.dropDuplicates(list(key_cols))
    if cap is not None:
        out = out.orderBy(*key_cols).limit(cap)
    return out
