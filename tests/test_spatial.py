from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from zoneday.operators import geometry, raster

# a concave hexagon of area 9.75, a square with a hole, and two separate parts
HEXAGON = [(1.0, 1.0), (5.0, 1.5), (4.5, 3.0), (5.5, 4.5), (2.0, 4.0), (2.5, 2.5)]
SQUARE, HOLE = [(0.5, 0.5), (7.5, 0.5), (7.5, 7.5), (0.5, 7.5)], [(2.2, 2.2), (5.1, 2.2), (5.1, 5.3), (2.2, 5.3)]
PARTS = [[(0.1, 5.2), (1.7, 5.2), (0.9, 7.9)], [(6.0, 0.3), (7.9, 0.2), (7.0, 3.3)]]


def ring_rows(zone, part, ring, pts, flip=False):
    closed = [*pts, pts[0]]
    return (zone, part, ring, [{"x": x, "y": y} for x, y in (reversed(closed) if flip else closed)])


RINGS = [
    ring_rows("hex", 0, 0, HEXAGON, flip=True),
    ring_rows("holed", 0, 0, SQUARE),
    ring_rows("holed", 0, 1, HOLE),
    ring_rows("parts", 0, 0, PARTS[0]),
    ring_rows("parts", 1, 0, PARTS[1], flip=True),
]
SCHEMA = f"zone_id string, part int, ring int, pts array<{geometry.POINT}>"


def shoelace(pts):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(pts, pts[1:] + pts[:1])) / 2


def inside(x, y, pts):
    hit = False
    for (x1, y1), (x2, y2) in zip(pts, pts[1:] + pts[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            hit = not hit
    return hit


def in_zone(zone, x, y):
    if zone == "hex":
        return inside(x, y, HEXAGON)
    if zone == "holed":
        return inside(x, y, SQUARE) and not inside(x, y, HOLE)
    return any(inside(x, y, p) for p in PARTS)


AREAS = {
    "hex": abs(shoelace(HEXAGON)),
    "holed": abs(shoelace(SQUARE)) - abs(shoelace(HOLE)),
    "parts": sum(abs(shoelace(p)) for p in PARTS),
}


@pytest.fixture(scope="module")
def edges(spark):
    return geometry.ring_edges(spark.createDataFrame(RINGS, SCHEMA))


def test_area_and_orientation(edges):
    got = {r.zone_id: r.area for r in geometry.polygon_metrics(edges, projected=True).collect()}
    assert got == pytest.approx(AREAS)


def test_valid_rings(spark, rows):
    bad = [
        ring_rows("flat", 0, 0, [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)]),
        ("open", 0, 0, [{"x": x, "y": y} for x, y in SQUARE]),
        ring_rows("short", 0, 0, [(0.0, 0.0), (1.0, 1.0)]),
    ]
    kept = geometry.valid_rings(spark.createDataFrame([*RINGS, *bad], SCHEMA)).select("zone_id").distinct()
    assert rows(kept, "zone_id") == [("hex",), ("holed",), ("parts",)]


def test_projected_cell_area(spark):
    """One degree cell 31-32 N, 99-98 W, cut finely enough to follow the parallels."""
    n = 400
    bottom = [(-99 + i / n, 31.0) for i in range(n + 1)]
    top = [(-98 - i / n, 32.0) for i in range(n + 1)]
    df = spark.createDataFrame([ring_rows("cell", 0, 0, bottom + top)], SCHEMA)
    got = geometry.polygon_metrics(geometry.ring_edges(df)).first()
    assert got.area_km2 == pytest.approx(10533.5427, rel=1e-6)
    assert got.centroid_lon == pytest.approx(-98.5, abs=1e-3) and got.centroid_lat == pytest.approx(31.498, abs=5e-3)


@pytest.mark.parametrize(("nrows", "ncols"), [(8, 8), (4, 3)])
def test_coverage_against_sampling(edges, nrows, ncols):
    """Every cell against 60 x 60 sample points, also on a grid that cuts the layer off."""
    cov = {(r.zone_id, r.row, r.col): r.cov for r in raster.coverage_weights(edges, nrows, ncols).collect()}
    k = 60
    for zone in AREAS:
        for row in range(nrows):
            for col in range(ncols):
                hits = sum(
                    in_zone(zone, col + (i + 0.5) / k, row + (j + 0.5) / k) for i in range(k) for j in range(k)
                )
                assert cov.get((zone, row, col), 0.0) == pytest.approx(hits / k**2, abs=0.02)
        if (nrows, ncols) == (8, 8):
            assert sum(v for (z, _, _), v in cov.items() if z == zone) == pytest.approx(AREAS[zone], abs=1e-9)
    assert all(0 < v <= 1 + 1e-9 for v in cov.values())


def test_coverage_of_layer_left_of_and_above_the_grid(spark):
    shifted = [[(x - 3.3, y - 2.6) for x, y in HEXAGON]]
    e = geometry.ring_edges(spark.createDataFrame([ring_rows("h", 0, 0, shifted[0])], SCHEMA))
    cov = {(r.row, r.col): r.cov for r in raster.coverage_weights(e, 8, 8).collect()}
    k = 60
    for row in range(3):
        for col in range(4):
            hits = sum(inside(col + (i + 0.5) / k, row + (j + 0.5) / k, shifted[0]) for i in range(k) for j in range(k))
            assert cov.get((row, col), 0.0) == pytest.approx(hits / k**2, abs=0.02)


def test_grid_orientation_from_map_coordinates(spark):
    """Map rows count downwards from the top edge."""
    grid = raster.GridSpec(x0=-100.0, y0=40.0, dx=0.5, dy=0.25, nrows=4, ncols=4)
    box = [(-99.75, 39.5), (-99.0, 39.5), (-99.0, 39.8), (-99.75, 39.8)]
    e = geometry.ring_edges(spark.createDataFrame([ring_rows("b", 0, 0, box)], SCHEMA))
    got = {(r.row, r.col): round(r.cov, 9) for r in raster.coverage_weights(raster.to_grid(e, grid), 4, 4).collect()}
    assert got == {(0, 0): 0.1, (0, 1): 0.2, (1, 0): 0.5, (1, 1): 1.0}


def test_points_in_polygons_brute_force(spark, edges):
    rng = random.Random(3)
    pts = [(i, rng.uniform(-1, 9), rng.uniform(-1, 9)) for i in range(600)]
    df = spark.createDataFrame(pts, "point_id int, x double, y double")
    want = {(i, z) for i, x, y in pts for z in AREAS if in_zone(z, x, y)}
    for size in (0.7, 3.0):
        got = {(r.point_id, r.zone_id) for r in geometry.points_in_polygons(df, edges, size).collect()}
        assert got == want


def test_interior_points_lie_inside(edges):
    got = geometry.interior_point(edges).collect()
    assert {r.zone_id for r in got} == set(AREAS)
    assert all(in_zone(r.zone_id, r.x, r.y) for r in got)


def test_overlap_exact_against_sampling(spark, edges):
    tri = [(1.0, 0.0), (7.0, 2.0), (3.0, 7.0)]
    quad = [(4.0, 4.0), (9.0, 4.5), (8.5, 9.0), (3.5, 8.0)]
    parents = geometry.ring_edges(spark.createDataFrame([ring_rows("tri", 0, 0, tri), ring_rows("quad", 0, 0, quad)], SCHEMA))
    got = {(r.zone_id, r.parent_id): r.overlap for r in geometry.overlap_area(edges, parents, 1.3).collect()}
    again = {(r.zone_id, r.parent_id): r.overlap for r in geometry.overlap_area(edges, parents, 20.0).collect()}
    assert got == pytest.approx(again)
    k = 400
    grid = [(10 * (i + 0.5) / k, 10 * (j + 0.5) / k) for i in range(k) for j in range(k)]
    sampled = {}
    for parent, pts in (("tri", tri), ("quad", quad)):
        members = [(x, y) for x, y in grid if inside(x, y, pts)]
        for zone in AREAS:
            share = sum(in_zone(zone, x, y) for x, y in members) * (10 / k) ** 2
            sampled[zone, parent] = share
            assert got.get((zone, parent), 0.0) == pytest.approx(share, abs=0.06)
    best = {r.zone_id: r.parent_id for r in geometry.assign_largest_overlap(edges, parents, 1.3).collect()}
    assert best == {z: max(("tri", "quad"), key=lambda p: sampled[z, p]) for z in AREAS}


def test_overlap_with_itself_is_its_area(edges):
    got = {(r.zone_id, r.parent_id): r.overlap for r in geometry.overlap_area(edges, edges, 2.0).collect()}
    assert {z: got[z, z] for z in AREAS} == pytest.approx(AREAS)


def test_dissolve_drops_shared_borders(spark):
    left = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    right = [(2.0, 0.0), (3.0, 0.0), (3.0, 2.0), (2.0, 2.0)]
    e = geometry.ring_edges(spark.createDataFrame([ring_rows("a", 0, 0, left), ring_rows("b", 0, 0, right)], SCHEMA))
    parents = spark.createDataFrame([("a", "p"), ("b", "p")], "zone_id string, cz_id string")
    out = geometry.dissolve(e, parents)
    assert out.count() == 6
    m = geometry.polygon_metrics(out, "cz_id", projected=True).first()
    assert (m.area, m.cx, m.cy) == pytest.approx((6.0, 1.5, 1.0))
    cover = raster.coverage_weights(out, 4, 4, zone="cz_id").agg(F.sum("cov")).first()[0]
    assert cover == pytest.approx(6.0)


def test_zonal_mean_renormalises_and_null_when_empty(spark):
    lines = spark.createDataFrame(
        [("v", "2020-01-01", 0, [1.0, None, 3.0]), ("v", "2020-01-02", 0, [None, None, 3.0])],
        "var string, date string, row int, values array<float>",
    )
    weights = spark.createDataFrame([("z", 0, 0, 1.0), ("z", 0, 1, 0.5), ("z", 0, 9, 0.5)], "zone_id string, row int, col int, cov double")
    weights = weights.unionByName(spark.createDataFrame([("y", 0, 0, 0.25), ("y", 0, 2, 0.75)], weights.schema))
    got = {(r.zone_id, r.date): r.value for r in raster.zonal_mean(lines, weights).collect()}
    assert got == {("z", "2020-01-01"): 1.0, ("z", "2020-01-02"): None, ("y", "2020-01-01"): 2.5, ("y", "2020-01-02"): 3.0}


def test_unequal_scanlines_stop_the_job(spark):
    lines = spark.createDataFrame(
        [("v", "d", 0, [1.0, 2.0]), ("v", "d", 0, [1.0])], "var string, date string, row int, values array<float>"
    ).coalesce(1)
    weights = spark.createDataFrame([("z", 0, 0, 1.0)], "zone_id string, row int, col int, cov double")
    with pytest.raises(Exception, match="differ in length"):
        raster.zonal_mean(lines, weights).collect()


def test_runs_give_the_same_mean_as_cells(spark, edges):
    cover = raster.coverage_weights(edges, 8, 8)
    runs = raster.weight_runs(cover)
    assert runs.agg(F.sum(F.col("n") * F.col("cov"))).first()[0] == pytest.approx(sum(AREAS.values()))
    assert runs.count() < cover.count() and runs.filter("n > 1").count() > 0
    rng = random.Random(5)
    cells = [("v", d, r, c, rng.uniform(-5, 5)) for d in ("a", "b") for r in range(8) for c in range(8) if rng.random() > 0.3]
    df = spark.createDataFrame(cells, "var string, date string, row int, col int, value double")
    a = {(r.zone_id, r.date): r.value for r in raster.zonal_mean(raster.cells_to_scanlines(df, 8), runs).collect()}
    b = {(r.zone_id, r.date): r.value for r in raster.zonal_mean_cells(df, cover).collect()}
    assert a == pytest.approx(b, rel=1e-5)
    holes = df.filter("col not between 2 and 4")
    got = {(r.zone_id, r.date): r.value for r in raster.zonal_mean(raster.cells_to_scanlines(holes, 8), runs).collect()}
    want = {(r.zone_id, r.date): r.value for r in raster.zonal_mean_cells(holes, cover).collect()}
    assert got == pytest.approx(want, rel=1e-5)


def test_wide_scanlines_match_narrow_ones(spark):
    cells = [("v", "d", 0, c, float(c)) for c in range(0, 70, 3)]
    df = spark.createDataFrame(cells, "var string, date string, row int, col int, value double")
    values = raster.cells_to_scanlines(df, 70).first()["values"]
    assert len(values) == 70 and values[3] == 3.0 and values[4] is None
    with pytest.raises(Exception, match="outside the grid: column"):
        raster.cells_to_scanlines(df, 10).collect()
    assert raster.cells_to_scanlines(df.filter("col < 10"), 10).first()["values"] == [0.0, None, None, 3.0, None, None, 6.0, None, None, 9.0]
    two = df.unionByName(spark.createDataFrame([("v", "d", 1, 1, 5.0), ("v", "d", 1, 0, None)], df.schema))
    got = {r.row: r["values"] for r in raster.cells_to_scanlines(two.filter("col < 4"), 4).collect()}
    assert got == {0: [0.0, None, None, 3.0], 1: [None, 5.0, None, None]}


def test_clip_and_window(spark, rows):
    grid = raster.GridSpec(x0=0.0, y0=4.0, dx=1.0, dy=1.0, nrows=4, ncols=4)
    assert raster.bbox_window(grid, (1.0, 1.0, 3.0, 3.0)) == (1, 2, 1, 2)
    lines = spark.createDataFrame([("v", "d", r, [float(10 * r + c) if c != 2 else -9999.0 for c in range(4)]) for r in range(4)], "var string, date string, row int, values array<float>")
    got = rows(raster.clip_grid(lines, 1, 2, 1, 2), "row")
    assert [(r[2], r[3]) for r in got] == [(0, [11.0, None]), (1, [21.0, None])]
    nan = spark.createDataFrame([("v", "d", 0, [math.nan, 1.0])], "var string, date string, row int, values array<float>")
    assert rows(raster.clip_grid(nan, 0, 0, 0, 2))[0][3] == [None, 1.0]


def test_weights_are_the_broadcast_side(spark, edges):
    lines = spark.createDataFrame([("v", "d", 0, [1.0])], "var string, date string, row int, values array<float>")
    plan = raster.zonal_mean(lines, raster.coverage_weights(edges, 8, 8))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def outline(cx, cy, radius, n, seed):
    """A star-shaped outline of ``n`` vertices."""
    rng = random.Random(seed)
    return [(cx + (r := radius * rng.uniform(0.8, 1.0)) * math.cos(t := 2 * math.pi * k / n), cy + r * math.sin(t)) for k in range(n)]


def test_points_in_outlines_of_many_vertices(spark):
    from zoneday.operators import covering

    shapes = {"a": outline(5.0, 5.0, 4.0, 5000, 1), "b": outline(11.0, 6.0, 3.0, 5000, 2), "c": outline(30.0, 30.0, 0.4, 7, 3), "box": [(0.0, 0.0), (16.0, 0.0), (16.0, 2.0), (0.0, 2.0)]}
    e = geometry.ring_edges(spark.createDataFrame([ring_rows(z, 0, 0, p) for z, p in shapes.items()], SCHEMA))
    rng = random.Random(8)
    pts = [(i, rng.uniform(-1, 16), rng.uniform(-1, 12)) for i in range(1500)] + [(2000 + i, rng.uniform(29.5, 30.5), rng.uniform(29.5, 30.5)) for i in range(50)]
    # points beside vertices and on the grid lines of the cells
    pts += [(3000 + k, x + rng.choice([-1, 1]) * 1e-3, y) for k, (x, y) in enumerate(shapes["a"][::25])] + [(5000 + k, float(k % 16), float(k // 16)) for k in range(160)]
    want = {(i, z) for i, x, y in pts for z, p in shapes.items() if inside(x, y, p) and z != "box"} | {(i, "box") for i, x, y in pts if 0 <= x < 16 and 0 <= y < 2}
    df = spark.createDataFrame(pts, "point_id int, x double, y double")
    got = {(r.point_id, r.zone_id) for r in geometry.points_in_polygons(df, e, 4.0).collect()}
    onto_box = {i for i, x, y in pts if (x in (0.0, 16.0) and 0 <= y <= 2) or (y in (0.0, 2.0) and 0 <= x <= 16)}  # either answer is right on the border
    drop = lambda pairs: {(i, z) for i, z in pairs if not (z == "box" and i in onto_box)}
    assert drop(got) == drop(want)
    leaves, levels = covering.cover(e, 4.0)
    held = leaves.agg(F.sum(F.size("edges")), F.max(F.size("edges")), F.max("level")).first()
    assert held[1] <= covering.MOST and held[2] >= 2 and levels == held[2] + 1 and held[0] < 8 * e.count()  # each edge lies in few leaves


def test_overlap_of_outlines_of_many_vertices(spark):
    a, b = outline(5.0, 5.0, 4.0, 3000, 4), outline(8.0, 6.0, 4.0, 3000, 5)
    edges = lambda z, p: geometry.ring_edges(spark.createDataFrame([ring_rows(z, 0, 0, p)], SCHEMA))
    got = geometry.overlap_area(edges("a", a), edges("b", b), 4.0).first()
    # the same area from the coverage of a fine grid
    cov = {z: raster.coverage_weights(raster.to_grid(edges(z, p), raster.GridSpec(0.0, 12.0, 0.02, 0.02, 600, 650)), 600, 650) for z, p in (("a", a), ("b", b))}
    met = cov["a"].join(cov["b"].withColumnRenamed("cov", "other"), ["row", "col"]).agg(F.sum(F.col("cov") * F.col("other"))).first()[0]
    assert got.overlap == pytest.approx(met * 0.02 * 0.02, rel=2e-3)
    whole = geometry.overlap_area(edges("a", a), edges("p", a), 4.0).first().overlap
    assert whole == pytest.approx(abs(shoelace(a)), rel=1e-9)
    bands = geometry._band_directory(edges("b", b), 4.0, 16, 6)
    width = bands.select((F.col("hi_b") - F.col("lo_b")).alias("w")).agg(F.min("w"), F.max("w")).first()
    assert width[0] < 0.1 and width[1] <= 4.0


def test_dissolve_cuts_borders_at_t_junctions(spark):
    square = lambda x0, y0, x1, y1: [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    shapes = {"l": square(0.0, 0.0, 2.0, 3.0), "r1": square(2.0, 0.0, 3.0, 1.0), "r2": square(2.0, 1.0, 3.0, 3.0), "far": square(9.0, 9.0, 10.0, 10.0),
              "slant": [(0.0, 3.0), (2.0, 3.0), (1.0, 5.0)], "cut": [(0.5, 4.0), (1.0, 5.0), (0.0, 5.0)]}
    e = geometry.ring_edges(spark.createDataFrame([ring_rows(z, 0, 0, p) for z, p in shapes.items()], SCHEMA))
    parents = spark.createDataFrame([(z, "q" if z == "far" else "p") for z in shapes], "zone_id string, cz_id string")
    out = geometry.dissolve(e, parents, node_size=1.0).cache()
    length = {r.cz_id: r.s for r in out.groupBy("cz_id").agg(F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("s")).collect()}
    side = math.hypot(1, 2)
    # the slant side of one triangle is half covered by the other
    assert length == pytest.approx({"q": 4.0, "p": 3 + 3 + 3 + 1 + 2 * side + 1 + math.hypot(0.5, 1.0) - math.hypot(0.5, 1.0)})
    m = {r.cz_id: r.area for r in geometry.polygon_metrics(out, "cz_id", projected=True).collect()}
    assert m == pytest.approx({"q": 1.0, "p": 9 + 2 + 0.5})
    # without noding the shared border stays
    assert geometry.dissolve(e, parents).count() > out.count() - 4


def test_crossing_rings_are_found(spark):
    bow, eight = [(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0)], [(0.0, 0.0), (1.0, 1.0), (2.0, 0.0), (2.0, 2.0), (1.0, 1.0), (0.0, 2.0)]
    good = [*RINGS, ring_rows("star", 0, 0, outline(0.0, 0.0, 3.0, 900, 6)), ring_rows("twice", 0, 0, [*HEXAGON[:2], HEXAGON[1], *HEXAGON[2:]])]
    loop = outline(0.0, 0.0, 3.0, 900, 7)
    loop[100], loop[110] = loop[110], loop[100]
    bad = [ring_rows("bow", 0, 0, bow), ring_rows("eight", 1, 2, eight), ring_rows("loop", 0, 0, loop), ring_rows("spike", 0, 0, [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 0.0), (0.0, 4.0)])]
    df = spark.createDataFrame(good + bad, SCHEMA)
    found = geometry.crossing_edges(df).collect()
    assert {(r.zone_id, r.part, r.ring) for r in found} == {("bow", 0, 0), ("eight", 1, 2), ("loop", 0, 0), ("spike", 0, 0)}
    assert [(r.i, r.j) for r in found if r.zone_id == "bow"] == [(0, 2)]
    assert geometry.simple_rings(df).count() == len(good)
    # against all pairs of sides
    closed = [*loop, loop[0]]
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    want = set()
    for i in range(900):
        for j in range(i + 2, 900 - (i == 0)):
            a, b, c, d = closed[i], closed[i + 1], closed[j], closed[j + 1]
            if turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0:
                want.add((i, j))
    assert {(r.i, r.j) for r in found if r.zone_id == "loop"} == want
