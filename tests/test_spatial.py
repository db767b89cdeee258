"""Spatial joins against brute force and the boundary cases of FIXTURES.md."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from geoscore.functions.geometry import lambert93
from geoscore.operators import spatial as S


def _pts(spark, xy, key="id"):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)],
                                 f"{key} long, x double, y double")


def test_range_count_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    c = rng.uniform(0, 1, (300, 2))
    s = np.vstack([rng.uniform(0, 1, (400, 2)), np.repeat([[0.5, 0.5]], 200, axis=0)])  # hot address
    r = 0.07
    centres = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(c)],
                                    "cid long, xc double, yc double")
    sites = _pts(spark, s)
    got = dict(S.range_count(centres, sites, "cid", r).collect())
    d2 = ((c[:, None, :] - s[None, :, :]) ** 2).sum(axis=2)
    exp = (d2 <= r * r).sum(axis=1)
    assert all(got[i] == exp[i] for i in range(len(c)))


def test_range_count_edge_cases(spark):
    centres = spark.createDataFrame([(1, 0.0, 0.0), (2, 100.0, 100.0)], "cid long, xc double, yc double")
    sites = _pts(spark, [(3.0, 4.0)])  # exactly at r = 5
    got = dict(S.range_count(centres, sites, "cid", 5.0).collect())
    assert got == {1: 1, 2: 0}


def test_locate_points_boundary_takes_smallest_cell(spark):
    pts = _pts(spark, [(0.05, 0.01), (0.02, 0.02), (5.0, 5.0)])
    cells = S.grid_cells(_pts(spark, [(0.01, 0.01), (0.06, 0.01)]), "x", "y", 0.05)
    got = {r.id: r.cell_id for r in S.locate_points(pts, cells, "id", "x", "y", 0.05, how="left").collect()}
    ids = sorted(r.cell_id for r in cells.collect())
    assert got[0] == ids[0] and got[1] == ids[0] and got[2] is None


def test_point_in_polygon_strict(spark):
    sq = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    polys = spark.createDataFrame([(1, [{"x": a, "y": b} for a, b in sq])],
                                  "pid int, ring array<struct<x:double,y:double>>")
    pts = _pts(spark, [(0.5, 0.5), (1.5, 0.5), (1.0, 0.5), (1.0, 1.0), (0.5, 0.0)])
    got = sorted(r.id for r in S.points_within(pts, polys, "id", "x", "y", "pid", "ring", 0.25).collect())
    assert got == [0]  # inside only; outside, edge, vertex, bottom edge excluded


def test_point_in_concave_polygon_matches_brute_force(spark):
    ring = [(0, 0), (4, 0), (4, 4), (2, 1.5), (0, 4)]
    polys = spark.createDataFrame([(7, [{"x": float(a), "y": float(b)} for a, b in ring])],
                                  "pid int, ring array<struct<x:double,y:double>>")
    rng = np.random.default_rng(5)
    xy = rng.uniform(-0.5, 4.5, (600, 2))
    got = {r.id for r in S.points_within(_pts(spark, xy), polys, "id", "x", "y", "pid", "ring", 0.7).collect()}

    def inside(p):
        c = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > p[1]) != (y2 > p[1]) and p[0] < x1 + (p[1] - y1) * (x2 - x1) / (y2 - y1):
                c = not c
        return c
    assert got == {i for i, p in enumerate(xy) if inside(p)}


def test_neighbours(spark):
    def ring(x0, y0, x1, y1):
        return [{"x": float(x0), "y": float(y0)}, {"x": float(x1), "y": float(y0)},
                {"x": float(x1), "y": float(y1)}, {"x": float(x0), "y": float(y1)}]
    areas = spark.createDataFrame(
        [(1, ring(0, 0, 1, 1)), (2, ring(1, 0, 2, 1)), (3, ring(2, 1, 3, 2)), (4, ring(5, 5, 6, 6))],
        "aid int, ring array<struct<x:double,y:double>>")
    got = sorted(map(tuple, S.touching_areas(areas, "aid", "ring", 1.0).collect()))
    assert got == [(1, 2), (2, 1), (2, 3), (3, 2)]  # shared edge, shared corner; far one none


def test_union_cells_once(spark):
    a = spark.createDataFrame([(1,), (2,)], "cell_id long")
    b = spark.createDataFrame([(2,), (3,)], "cell_id long")
    assert sorted(r.cell_id for r in S.union_cells(a, b).collect()) == [1, 2, 3]
    assert sorted(r.cell_id for r in S.union_cells(a, b, cap=2).collect()) == [1, 2]


def _hull_brute(pts):
    pts = np.unique(pts, axis=0)
    hull = set()
    for i, p in enumerate(pts):
        for j, q in enumerate(pts):
            if i == j:
                continue
            d = q - p
            cr = d[0] * (pts[:, 1] - p[1]) - d[1] * (pts[:, 0] - p[0])
            if (cr >= 0).all() and ((cr > 0) | (((pts - p) @ d >= 0) & ((pts - q) @ d <= 0))).all():
                hull.add(tuple(p))
                hull.add(tuple(q))
    return hull


def test_convex_hull_and_centroid(spark):
    rng = np.random.default_rng(7)
    pts = rng.uniform(0, 1, (400, 2))
    df = spark.createDataFrame(pd.DataFrame({"g": np.r_[np.zeros(300, int), np.ones(100, int)],
                                             "x": pts[:, 0], "y": pts[:, 1]}))
    hulls = {r.g: r for r in S.convex_hulls(df.repartition(7), "g", "x", "y").collect()}
    for g, sl in ((0, slice(0, 300)), (1, slice(300, 400))):
        got = {(p.x, p.y) for p in hulls[g].hull}
        assert got == _hull_brute(pts[sl])
    sq = spark.createDataFrame([(1, 0.0, 0.0), (1, 2.0, 0.0), (1, 2.0, 2.0), (1, 0.0, 2.0), (1, 1.0, 1.0)],
                               "g int, x double, y double")
    h = S.convex_hulls(sq, "g", "x", "y").first()
    assert (h.centroid_x, h.centroid_y, h.n_vertices) == (1.0, 1.0, 4)


def test_cells_vs_hulls_brute_force(spark):
    tri = spark.createDataFrame([(1, 0.12, 0.12), (1, 0.38, 0.14), (1, 0.2, 0.41)], "g int, x double, y double")
    hulls = S.convex_hulls(tri, "g", "x", "y")
    grid = spark.createDataFrame([(0, float(x), float(y)) for x in np.arange(0, 0.5, 0.05)
                                  for y in np.arange(0, 0.5, 0.05)], "id long, x double, y double")
    cells = S.grid_cells(grid, "x", "y", 0.1)
    flags = {r.cell_id: (r.intersects, r.overlaps_or_within)
             for r in S.cells_vs_hulls(cells, hulls, "g", 0.1).collect()}
    tri_pts = np.array([(0.12, 0.12), (0.38, 0.14), (0.2, 0.41)])

    def clip_area(poly, x0, y0, x1, y1):
        # Sutherland-Hodgman clip of a polygon by the rectangle; area of the result
        def clip(pts, inside, cut):
            out = []
            for a, b in zip(pts, pts[1:] + pts[:1]):
                ia, ib = inside(a), inside(b)
                if ia:
                    out.append(a)
                if ia != ib:
                    out.append(cut(a, b))
            return out

        def cx(v):
            return lambda a, b: (v, a[1] + (v - a[0]) * (b[1] - a[1]) / (b[0] - a[0]))

        def cy(v):
            return lambda a, b: (a[0] + (v - a[1]) * (b[0] - a[0]) / (b[1] - a[1]), v)
        pts = [tuple(p) for p in poly]
        for inside, cut in ((lambda q: q[0] >= x0, cx(x0)), (lambda q: q[0] <= x1, cx(x1)),
                            (lambda q: q[1] >= y0, cy(y0)), (lambda q: q[1] <= y1, cy(y1))):
            if not pts:
                return 0.0
            pts = clip(pts, inside, cut)
        if len(pts) < 3:
            return 0.0
        a = np.array(pts)
        return 0.5 * abs((a[:, 0] * np.roll(a[:, 1], -1) - np.roll(a[:, 0], -1) * a[:, 1]).sum())

    for c in cells.collect():
        meet = clip_area(tri_pts, c.xmin, c.ymin, c.xmax, c.ymax) > 1e-15
        got = flags.get(c.cell_id, (False, False))
        assert got[1] == meet, (c.cell_id, got, meet)
        if meet:
            assert got[0]


def test_lambert93_known_point(spark):
    df = spark.createDataFrame([(2.3522, 48.8566)], "lon double, lat double")
    x, y = lambert93("lon", "lat")
    r = df.select(x.alias("x"), y.alias("y")).first()
    assert abs(r.x - 652_000) < 2_000 and abs(r.y - 6_862_000) < 2_000


def test_cells_in_general_polygon_exact(spark):
    # concave ring with a thin spike that crosses cells without any vertex,
    # corner or centre inside them
    ring = [(0.0, 0.0), (1000.0, 0.0), (1000.0, 300.0), (1390.0, 305.0), (1000.0, 310.0),
            (1000.0, 410.0), (130.0, 405.0), (1000.0, 400.5), (1000.0, 600.0), (0.0, 600.0)]
    polys = spark.createDataFrame([(1, [{"x": a, "y": b} for a, b in ring])],
                                  "pid int, ring array<struct<x:double,y:double>>")
    cells = spark.createDataFrame(
        [(f"c{i}_{j}", i * 200.0 + 100, j * 200.0 + 100, i * 200.0, j * 200.0, i * 200.0 + 200, j * 200.0 + 200)
         for i in range(-1, 7) for j in range(-1, 5)],
        "cell_id string, xc double, yc double, xmin double, ymin double, xmax double, ymax double")
    got = {r.cell_id for r in S.cells_meet_polygons(cells, polys, "pid", "ring", 2000.0).collect()}

    def clip_area(poly, x0, y0, x1, y1):
        def clip(pts, inside, cut):
            out = []
            for p, q in zip(pts, pts[1:] + pts[:1]):
                ip, iq = inside(p), inside(q)
                if ip:
                    out.append(p)
                if ip != iq:
                    out.append(cut(p, q))
            return out
        cx = lambda v: (lambda p, q: (v, p[1] + (v - p[0]) * (q[1] - p[1]) / (q[0] - p[0])))
        cy = lambda v: (lambda p, q: (p[0] + (v - p[1]) * (q[0] - p[0]) / (q[1] - p[1]), v))
        pts = list(poly)
        for inside, cut in ((lambda p: p[0] >= x0, cx(x0)), (lambda p: p[0] <= x1, cx(x1)),
                            (lambda p: p[1] >= y0, cy(y0)), (lambda p: p[1] <= y1, cy(y1))):
            if not pts:
                return 0.0
            pts = clip(pts, inside, cut)
        if len(pts) < 3:
            return 0.0
        a = np.array(pts)
        return 0.5 * abs((a[:, 0] * np.roll(a[:, 1], -1) - np.roll(a[:, 0], -1) * a[:, 1]).sum())

    exp = {r.cell_id for r in cells.collect() if clip_area(ring, r.xmin, r.ymin, r.xmax, r.ymax) > 1e-9}
    assert got == exp
    assert "c5_1" in got   # crossed by the spike only: no vertex, corner or centre inside


def test_segment_zone_meets_crossed_cells(spark):
    seg = spark.createDataFrame([(1, 0.01, 0.01), (1, 0.29, 0.19)], "g int, x double, y double")
    hull = S.convex_hulls(seg, "g", "x", "y")
    grid = spark.createDataFrame([(0, float(x), float(y)) for x in np.arange(0.0, 0.3, 0.1)
                                  for y in np.arange(0.0, 0.3, 0.1)], "id long, x double, y double")
    cells = S.grid_cells(grid, "x", "y", 0.1)
    flags = {(r.cell_id): (r.intersects, r.overlaps_or_within)
             for r in S.cells_vs_hulls(cells, hull, "g", 0.1).collect()}
    ids = {(c.cx, c.cy): c.cell_id for c in cells.collect()}
    hit = {k for k, v in flags.items() if v[0]}
    # the segment y = 0.01 + (x - 0.01) * 0.18 / 0.28 crosses cells (0,0), (1,0), (1,1), (2,1)
    assert hit == {ids[(0, 0)], ids[(1, 0)], ids[(1, 1)], ids[(2, 1)]}
    assert not any(v[1] for v in flags.values())   # a segment has no interior


def test_range_count_two_level_boundaries(spark):
    rng = np.random.default_rng(11)
    r = 0.3
    # coordinates on multiples of the fine bucket side and of r, plus a dense cluster
    grid = np.round(rng.integers(-40, 40, (500, 2)) * (r / 8), 12)
    s = np.vstack([grid, rng.normal(0.2, 0.05, (300, 2)), np.repeat([[0.3, -0.3]], 50, axis=0)])
    c = np.vstack([np.round(rng.integers(-40, 40, (300, 2)) * (r / 4), 12), rng.uniform(-3, 3, (200, 2))])
    centres = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(c)],
                                    "cid long, xc double, yc double")
    sites = _pts(spark, s)
    d2 = ((c[:, None, :] - s[None, :, :]) ** 2).sum(axis=2)
    exp = (d2 <= r * r).sum(axis=1)
    for k in (1, 3, 4, 7):
        got = dict(S.range_count(centres, sites, "cid", r, k=k).collect())
        assert all(got[i] == exp[i] for i in range(len(c))), k


def _areas(spark, rings):
    return spark.createDataFrame([(k, [{"x": float(a), "y": float(b)} for a, b in r]) for k, r in rings.items()],
                                 "aid int, ring array<struct<x:double,y:double>>")


def _touch_brute(rings):
    def edges(r):
        return list(zip(r, r[1:] + r[:1]))

    def on(p, e):
        (x1, y1), (x2, y2) = e
        return ((x2 - x1) * (p[1] - y1) == (y2 - y1) * (p[0] - x1)
                and min(x1, x2) <= p[0] <= max(x1, x2) and min(y1, y2) <= p[1] <= max(y1, y2))
    out = set()
    for a in rings:
        for b in rings:
            if a != b and any(on(p, e) for p in rings[a] for e in edges(rings[b])):
                out |= {(a, b), (b, a)}
    return out


def test_neighbours_without_shared_vertices(spark):
    """Squares of several sizes in a partition, a slanted pair, a far one."""
    rnd = np.random.default_rng(4)
    rings = {}

    def split(x, y, side):
        if side > 1 and rnd.random() < 0.7:
            for i in (0, 1):
                for j in (0, 1):
                    split(x + i * side // 2, y + j * side // 2, side // 2)
        elif rnd.random() < 0.2:  # two triangles
            rings[len(rings)] = [(x, y), (x + side, y), (x + side, y + side)]
            rings[len(rings)] = [(x, y), (x + side, y + side), (x, y + side)]
        else:
            rings[len(rings)] = [(x, y), (x + side, y), (x + side, y + side), (x, y + side)]
    split(0, 0, 16)
    rings[900] = [(100, 0), (104, 8), (100, 8)]
    rings[901] = [(102, 4), (103, 6), (110, 3)]       # both vertices inside the slanted edge
    rings[902] = [(200, 200), (201, 200), (201, 201)]
    want = _touch_brute(rings)
    for size in (0.5, 3.0, 500.0):
        got = S.touching_areas(_areas(spark, rings), "aid", "ring", size).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want), size
    assert (900, 901) in want and not any(902 in p for p in want)


def test_crowded_tiles_split(spark):
    """A tile with most vertices is split; every contact is still found."""
    rnd = np.random.default_rng(8)
    pts = np.vstack([rnd.integers(0, 64, (400, 2)) / 64.0, rnd.integers(0, 64, (30, 2)) * 1.0])
    segs = np.hstack([pts[rnd.permutation(430)], pts[rnd.permutation(430)]])
    p = _pts(spark, pts)
    s = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(segs)], "sid int, x1 double, y1 double, x2 double, y2 double")
    pt, st = S.crowded_tiles(p, s, "x", "y", 16.0, most=40, finer=4, levels=3)
    assert pt.select("level").distinct().count() > 1 and pt.count() == 430
    got = pt.join(st, ["level", "tx", "ty"]).select("id", "sid")
    near = {tuple(r) for r in got.collect()}
    for i, (x, y) in enumerate(pts):
        for k, (x1, y1, x2, y2) in enumerate(segs):
            if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                assert (i, k) in near


def test_areas_with_holes_and_parts(spark):
    rings = [[(0, 0), (6, 0), (6, 6), (0, 6)], [(1, 1), (5, 1), (5, 5), (1, 5)],   # a frame
             [(2, 2), (4, 2), (4, 4), (2, 4)],                                        # an island in its hole
             [(10, 0), (14, 1), (11, 5)]]                                             # a part further off
    polys = spark.createDataFrame([(1, [[{"x": float(a), "y": float(b)} for a, b in r] for r in rings])],
                                  "pid int, rings array<array<struct<x:double,y:double>>>")
    rng = np.random.default_rng(2)
    xy = np.vstack([rng.uniform(-1, 15, (700, 2)), [[3, 3], [1.5, 1.5], [3, 1.5], [0.5, 3], [1, 3], [4, 4]]])
    got = {r.id for r in S.points_within(_pts(spark, xy), polys, "id", "x", "y", "pid", "rings", 0.9).collect()}

    def crossings(p):
        return sum((y1 > p[1]) != (y2 > p[1]) and p[0] < x1 + (p[1] - y1) * (x2 - x1) / (y2 - y1)
                   for r in rings for (x1, y1), (x2, y2) in zip(r, r[1:] + r[:1]))
    want = {i for i, p in enumerate(xy[:-2]) if crossings(p) % 2}
    assert got == want and {700, 703} <= got and not {702, 704, 705} & got

    cells = spark.createDataFrame([(i * 100 + j, i + 0.5, j + 0.5, float(i), float(j), i + 1.0, j + 1.0) for i in range(-1, 15) for j in range(-1, 8)],
                                  "cell_id long, xc double, yc double, xmin double, ymin double, xmax double, ymax double")
    met = {r.cell_id for r in S.cells_meet_polygons(cells, polys, "pid", "rings", 2.5).collect()}
    # by a dense lattice inside each cell
    step = (np.arange(40) + 0.5) / 40
    for r in cells.collect():
        inside = any(crossings((r.xmin + a, r.ymin + b)) % 2 for a in step for b in step)
        assert (r.cell_id in met) == inside or (r.cell_id in met and not inside and r.xmin >= 9), r


def test_hull_prefilter_drops_inner_points_only(spark):
    rng = np.random.default_rng(12)
    t = rng.uniform(0, 2 * np.pi, 300)
    sets = {0: rng.normal(size=(4000, 2)), 1: np.c_[np.cos(t), np.sin(t)], 2: rng.integers(0, 5, (500, 2)) * 1.0,
            3: np.c_[np.arange(50.0), 2 * np.arange(50.0)], 4: np.repeat([[3.0, 4.0]], 9, 0), 5: np.array([[0.0, 0.0], [1.0, 1.0]])}
    rows = [(g, float(x), float(y)) for g, xy in sets.items() for x, y in xy]
    pts = spark.createDataFrame(rows, "g int, x double, y double").repartition(9)
    kept = S.maybe_hull_points(pts, "g").toPandas()
    assert (kept.g == 0).sum() < 400
    hulls = {r.g: r for r in S.convex_hulls(pts, "g", "x", "y").collect()}
    assert set(hulls) == set(sets)
    for g, xy in sets.items():
        want = {tuple(p) for p in S._hull_np(xy)}
        assert {(p.x, p.y) for p in hulls[g].hull} == want, g
