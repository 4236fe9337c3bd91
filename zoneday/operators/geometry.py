"""Polygon operators on edge tables.

A polygon layer is a table of directed edges ``(zone_id, x1, y1, x2, y2)``:
outer rings counter-clockwise, holes clockwise.  Every operator below is a sum
over edges, so it needs joins and group-bys only, and adding zones together is
adding their edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneday.functions.geodesy import albers_forward, albers_inverse
from zoneday.operators.covering import cover, points_in_cover, touched_cells
from zoneday.operators.keys import argmax_row
from zoneday.session import lookup

POINT = "struct<x:double,y:double>"


# ---- rings to edges ------------------------------------------------------


def _sides(pts: Column) -> Column:
    """Consecutive vertex pairs of a closed ring."""
    n = F.size(pts) - 1
    return F.arrays_zip(F.slice(pts, F.lit(1), n).alias("a"), F.slice(pts, F.lit(2), n).alias("b"))


def _signed_area(pts: Column) -> Column:
    """Shoelace area of a closed ring, taken relative to its first vertex."""

    def around(p0: Column) -> Column:
        cross = lambda p: (p["a"]["x"] - p0["x"]) * (p["b"]["y"] - p0["y"]) - (p["b"]["x"] - p0["x"]) * (
            p["a"]["y"] - p0["y"]
        )
        return F.aggregate(_sides(pts), F.lit(0.0), lambda s, p: s + cross(p) / 2)

    # a one-element transform binds the first vertex once, not once per side
    return F.get(F.transform(F.slice(pts, 1, 1), around), 0)


def valid_rings(rings: DataFrame) -> DataFrame:
    """Rings with at least four vertices, closed, and of non-zero area."""
    pts = F.col("pts")
    closed = F.get(pts, 0) == F.get(pts, F.size(pts) - 1)
    return rings.filter((F.size(pts) >= 4) & closed).filter(_signed_area(pts) != 0)


def crossing_edges(rings: DataFrame) -> DataFrame:
    """(zone_id, part, ring, i, j): sides of a ring, numbered along it, that meet although they aren't neighbours.

    Sides meet by cells of a grid that fits the ring: its box cut into about
    as many cells as it has sides.  Touching counts as meeting.  Sides without
    length are left out first, and numbers skip them.
    """
    key = ["zone_id", "part", "ring"]
    sides = F.filter(_sides(F.col("pts")), lambda s: (s["a"]["x"] != s["b"]["x"]) | (s["a"]["y"] != s["b"]["y"]))
    listed = rings.filter(F.size("pts") >= 4).select(*key, sides.alias("_s"))
    top = lambda axis, pick: pick(F.transform("_s", lambda s: s["a"][axis]))
    box = {f"{axis}0": top(axis, F.array_min) for axis in ("x", "y")} | {f"{axis}9": top(axis, F.array_max) for axis in ("x", "y")}
    listed = listed.filter(F.size("_s") > 0).withColumns({**box, "_n": F.size("_s")})
    width = F.greatest(F.col("x9") - F.col("x0"), F.col("y9") - F.col("y0")) / F.ceil(F.sqrt("_n"))
    e = listed.select(*key, "_n", "x0", "y0", width.alias("_w"), F.posexplode("_s").alias("i", "e"))
    cells = e
    for axis in ("x", "y"):
        ends = [F.floor((F.col(f"e.{end}.{axis}") - F.col(f"{axis}0")) / F.col("_w")).cast("int") for end in ("a", "b")]
        low, high = F.least(*ends), F.greatest(*ends)
        cells = cells.withColumn(f"c{axis}", F.explode(F.sequence(low, high)))
    one = cells.select(*key, "cx", "cy", "_n", "i", "e")
    other = cells.select(*key, "cx", "cy", F.col("i").alias("j"), F.col("e").alias("f"))
    met = lookup(one, other, [*key, "cx", "cy"], "inner").filter("i + 1 < j and not (i = 0 and j = _n - 1)")
    a, b, c, d = F.col("e.a"), F.col("e.b"), F.col("f.a"), F.col("f.b")
    turn = lambda p, q, r: F.signum((q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"]))

    def within(p: Column, q: Column, r: Column) -> Column:
        """Whether r, in line with p and q, lies between them."""
        return (F.least(p["x"], q["x"]) <= r["x"]) & (r["x"] <= F.greatest(p["x"], q["x"])) & (F.least(p["y"], q["y"]) <= r["y"]) & (r["y"] <= F.greatest(p["y"], q["y"]))

    met = met.withColumns({"_1": turn(a, b, c), "_2": turn(a, b, d), "_3": turn(c, d, a), "_4": turn(c, d, b)})
    across = (F.col("_1") * F.col("_2") < 0) & (F.col("_3") * F.col("_4") < 0)
    touch = [(F.col(t) == 0) & within(p, q, r) for t, p, q, r in (("_1", a, b, c), ("_2", a, b, d), ("_3", c, d, a), ("_4", c, d, b))]
    return met.filter(across | touch[0] | touch[1] | touch[2] | touch[3]).select(*key, "i", "j").distinct()


def simple_rings(rings: DataFrame) -> DataFrame:
    """The valid rings whose sides don't cross or touch each other."""
    good = valid_rings(rings)
    bad = crossing_edges(good).select("zone_id", "part", "ring").distinct()
    return lookup(good, bad, ["zone_id", "part", "ring"], "left_anti")


def ring_edges(rings: DataFrame) -> DataFrame:
    """Directed edges of ``rings(zone_id, part, ring, pts)``; ring 0 of a part is its outline."""
    measured = rings.select("zone_id", "ring", "pts", _signed_area(F.col("pts")).alias("_area"))
    wrong_way = F.when(F.col("ring") == 0, F.col("_area") < 0).otherwise(F.col("_area") > 0)
    sides = measured.select("zone_id", wrong_way.alias("_turn"), F.explode(_sides(F.col("pts"))).alias("e"))
    # turning a ring round is swapping the ends of its sides
    start = F.when(F.col("_turn"), F.col("e.b")).otherwise(F.col("e.a"))
    end = F.when(F.col("_turn"), F.col("e.a")).otherwise(F.col("e.b"))
    return sides.select(
        "zone_id", start["x"].alias("x1"), start["y"].alias("y1"), end["x"].alias("x2"), end["y"].alias("y2")
    )


def project_edges(edges: DataFrame) -> DataFrame:
    """Vertices from degrees to the equal-area plane; edges stay straight there."""
    (x1, y1), (x2, y2) = (albers_forward(F.col(f"x{i}"), F.col(f"y{i}")) for i in (1, 2))
    return edges.withColumns({"x1": x1, "y1": y1, "x2": x2, "y2": y2})


def bounding_boxes(edges: DataFrame, zone: str = "zone_id") -> DataFrame:
    return edges.groupBy(zone).agg(
        F.min(F.least("x1", "x2")).alias("xmin"),
        F.max(F.greatest("x1", "x2")).alias("xmax"),
        F.min(F.least("y1", "y2")).alias("ymin"),
        F.max(F.greatest("y1", "y2")).alias("ymax"),
    )


# ---- area, centroid, union -----------------------------------------------


def polygon_metrics(edges: DataFrame, zone: str = "zone_id", projected: bool = False) -> DataFrame:
    """Area in square kilometres and centroid, in the equal-area plane, centroid back in degrees.

    ``projected=True`` takes plane coordinates as they are and returns plane
    units for the area and the centroid.
    """
    plane = edges if projected else project_edges(edges)
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    sums = plane.groupBy(zone).agg(
        (F.sum(cross) / 2).alias("_area"),
        F.sum((F.col("x1") + F.col("x2")) * cross).alias("_sx"),
        F.sum((F.col("y1") + F.col("y2")) * cross).alias("_sy"),
    )
    cx, cy = F.col("_sx") / (6 * F.col("_area")), F.col("_sy") / (6 * F.col("_area"))
    if projected:
        return sums.select(zone, F.col("_area").alias("area"), cx.alias("cx"), cy.alias("cy"))
    lon, lat = albers_inverse(cx, cy)
    return sums.select(
        zone, (F.col("_area") / 1e6).alias("area_km2"), lon.alias("centroid_lon"), lat.alias("centroid_lat")
    )


def node_edges(edges: DataFrame, group: str, size: float, eps: float = 1e-9) -> DataFrame:
    """Edges cut wherever a vertex of their group lies on them.

    Edges and vertices meet by cells of width ``size``, best near a typical
    edge's length.  A vertex counts as lying on an edge up to ``eps`` of the
    edge's length; the parts end in the vertex itself, so neighbours' borders
    become equal vertex by vertex.
    """
    ends = ["x1", "y1", "x2", "y2"]
    lines = edges.select(group, *ends).distinct()
    points = edges.select(group, F.col("x1").alias("px"), F.col("y1").alias("py")).union(edges.select(group, "x2", "y2")).distinct()
    placed = points.withColumns({"cx": _cell(F.col("px"), size), "cy": _cell(F.col("py"), size)})
    met = lookup(touched_cells(lines, size, group).select(group, "cx", "cy", "e.*"), placed, [group, "cx", "cy"], "inner")
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    square = dx * dx + dy * dy
    along = ((F.col("px") - F.col("x1")) * dx + (F.col("py") - F.col("y1")) * dy) / square
    off = F.abs(dx * (F.col("py") - F.col("y1")) - dy * (F.col("px") - F.col("x1")))
    own = ((F.col("px") == F.col("x1")) & (F.col("py") == F.col("y1"))) | ((F.col("px") == F.col("x2")) & (F.col("py") == F.col("y2")))
    on = met.filter((square > 0) & ~own & (along > 0) & (along < 1) & (off <= eps * square))
    cuts = on.groupBy(group, *ends).agg(F.array_sort(F.collect_list(F.struct(along.alias("t"), F.col("px").alias("x"), F.col("py").alias("y")))).alias("_cuts"))
    none = F.array().cast("array<struct<t:double,x:double,y:double>>")
    stop = lambda t, x, y: F.array(F.struct(F.lit(t).alias("t"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")))
    met = lookup(edges, cuts, [group, *ends])
    pts = F.concat(stop(0.0, "x1", "y1"), F.coalesce("_cuts", none), stop(1.0, "x2", "y2"))
    parts = met.withColumn("_pts", pts).drop("_cuts", *ends).withColumn("_s", F.explode(_sides(F.col("_pts"))))
    return parts.select(
        *[c for c in edges.columns if c not in ends], F.col("_s.a.x").alias("x1"), F.col("_s.a.y").alias("y1"), F.col("_s.b.x").alias("x2"), F.col("_s.b.y").alias("y2")
    )


def dissolve(
    edges: DataFrame, parents: DataFrame, parent: str = "cz_id", zone: str = "zone_id", node_size: float | None = None
) -> DataFrame:
    """Union of zones that share their borders, as edges of the parent.

    A border between two members occurs once in each direction and cancels, so
    only the outline remains; no geometry is collected anywhere.  With
    ``node_size`` (a typical edge's length) edges are first cut at other
    members' vertices that lie on them; without it borders must agree vertex
    by vertex.
    """
    labelled = lookup(edges, parents.select(zone, parent).distinct(), zone, "inner")
    if node_size is not None:
        labelled = node_edges(labelled, parent, node_size)
    forward = (F.col("x1") < F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") <= F.col("y2")))
    a = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))
    b = F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    net = (
        labelled.select(
            parent,
            F.when(forward, a).otherwise(b).alias("lo"),
            F.when(forward, b).otherwise(a).alias("hi"),
            F.when(forward, 1).otherwise(-1).alias("_d"),
        )
        .groupBy(parent, "lo", "hi")
        .agg(F.sum("_d").alias("_d"))
        .filter(F.col("_d") != 0)
    )
    # a border counted k times in one direction stays k times
    net = net.withColumn("_k", F.explode(F.sequence(F.lit(1), F.abs("_d").cast("int"))))
    start = F.when(F.col("_d") > 0, F.col("lo")).otherwise(F.col("hi"))
    end = F.when(F.col("_d") > 0, F.col("hi")).otherwise(F.col("lo"))
    return net.select(
        parent, start["x"].alias("x1"), start["y"].alias("y1"), end["x"].alias("x2"), end["y"].alias("y2")
    )


def interior_point(edges: DataFrame, zone: str = "zone_id") -> DataFrame:
    """A point inside each polygon: middle of the widest run on a line across it.

    The line lies at mid-height, or, where that passes between separate parts,
    through the middle of the edge nearest to it.
    """
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    mid = edges.groupBy(zone).agg(((F.min(low) + F.max(high)) / 2).alias("_mid"))
    crosses = lambda y: (F.col("y1") > F.col(y)) != (F.col("y2") > F.col(y))
    centre = (F.col("y1") + F.col("y2")) / 2
    lines = (
        lookup(edges.filter("y1 <> y2"), mid, zone, "inner")
        .groupBy(zone)
        .agg(
            F.max(F.when(crosses("_mid"), F.col("_mid"))).alias("_at_mid"),
            F.min_by(centre, F.struct(F.abs(centre - F.col("_mid")), centre)).alias("_near"),
        )
        .select(zone, F.coalesce("_at_mid", "_near").alias("y"))
    )
    crossing = lookup(edges, lines, zone, "inner").filter(crosses("y"))
    x = F.col("x1") + (F.col("x2") - F.col("x1")) * (F.col("y") - F.col("y1")) / (F.col("y2") - F.col("y1"))
    # only the few edges that cross the line reach the window
    w = Window.partitionBy(zone).orderBy("_x")
    runs = (
        crossing.select(zone, "y", x.alias("_x"))
        .withColumns({"_r": F.row_number().over(w), "_next": F.lead("_x").over(w)})
        .filter(F.col("_r") % 2 == 1)
        .select(zone, ((F.col("_x") + F.col("_next")) / 2).alias("x"), "y", (F.col("_next") - F.col("_x")).alias("_w"))
    )
    return argmax_row(runs, zone, "_w", ["x"]).select(zone, "x", "y")


# ---- spatial joins -------------------------------------------------------


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / size)


def points_in_polygons(
    points: DataFrame, edges: DataFrame, size: float, point: str = "point_id", zone: str = "zone_id"
) -> DataFrame:
    """Pairs (point, zone) with the point inside.

    ``size`` is the width of a covering's first cells, best near a typical
    polygon's width.  Cells wholly inside decide by their number alone, and the
    others hold few edges each, so the work grows with edges and points, not
    with their product.
    """
    leaves, levels = cover(edges, size, zone)
    return points_in_cover(points, leaves, levels, size, point, zone)


def candidate_pairs(a: DataFrame, b: DataFrame, size: float) -> DataFrame:
    """Zone pairs whose bounding boxes overlap, through shared buckets."""

    def listed(boxes: DataFrame, tag: str) -> DataFrame:
        out = boxes.select(*[F.col(c).alias(f"{tag}_{c}") for c in boxes.columns])
        for axis in ("x", "y"):
            lo, hi = F.col(f"{tag}_{axis}min"), F.col(f"{tag}_{axis}max")
            out = out.withColumn(f"c{axis}", F.explode(F.sequence(_cell(lo, size), _cell(hi, size))))
        return out

    left, right = listed(bounding_boxes(a), "a"), listed(bounding_boxes(b), "b")
    lap = lambda ax: F.least(f"a_{ax}max", f"b_{ax}max") - F.greatest(f"a_{ax}min", f"b_{ax}min")
    # a pair is reported from the bucket holding the corner of its shared box only
    corner = (F.col("cx") == _cell(F.greatest("a_xmin", "b_xmin"), size)) & (
        F.col("cy") == _cell(F.greatest("a_ymin", "b_ymin"), size)
    )
    return (
        lookup(left, right, ["cx", "cy"], "inner")
        .filter((lap("x") > 0) & (lap("y") > 0) & corner)
        .select(
            F.col("a_zone_id").alias("zone_id"),
            F.col("b_zone_id").alias("parent_id"),
            F.greatest("a_xmin", "b_xmin").alias("lo"),
            F.least("a_xmax", "b_xmax").alias("hi"),
            F.least("a_ymin", "b_ymin").alias("base"),
        )
    )


def _band_directory(parents: DataFrame, size: float, most: int, depth: int) -> DataFrame:
    """(parent_id, fine, lo, hi): for each of a parent's finest bands the band that is used there.

    Bands of width ``size`` are halved up to ``depth`` times, until one holds
    at most ``most`` edges of the parent.
    """
    fine = size / (1 << depth)
    spans = _listed_bands(parents, fine).groupBy(F.col("zone_id").alias("parent_id"), "fine").agg(F.count(F.lit(1)).alias("n"))
    # the band that a finest one belongs to, at every width
    levels = spans.withColumn("halved", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    levels = levels.withColumn("part", F.floor(F.col("fine") / F.pow(F.lit(2.0), depth - F.col("halved"))).cast("bigint"))
    held = levels.groupBy("parent_id", "halved", "part").agg(F.sum("n").alias("held"), F.max("n").alias("densest"))
    # halving helps no further where one finest band alone is as full
    fits = held.filter((F.col("densest") <= most / 2) & (F.col("held") <= most * 2) | (F.col("halved") == depth))
    used = levels.join(fits, ["parent_id", "halved", "part"]).groupBy("parent_id", "fine").agg(F.min("halved").alias("halved"))
    width = F.pow(F.lit(2.0), depth - F.col("halved"))
    first = F.floor(F.col("fine") / width) * width
    return used.select("parent_id", "fine", (first * fine).alias("lo_b"), ((first + width) * fine).alias("hi_b"))


def _listed_bands(df: DataFrame, fine: float) -> DataFrame:
    lo, hi = F.least("x1", "x2"), F.greatest("x1", "x2")
    return df.filter("x1 <> x2").withColumn("fine", F.explode(F.sequence(_cell(lo, fine), _cell(hi, fine))))


def overlap_area(zones: DataFrame, parents: DataFrame, size: float, most: int = 16, depth: int = 6) -> DataFrame:
    """Exact area shared by each zone and parent, for polygons in one plane.

    A polygon is the signed sum of the strips between its edges and a base
    line, so the shared area is the signed sum over edge pairs of the area
    below both edges.  Only pairs of edges in one x-band of one candidate pair
    meet.  Bands narrow where a parent's outline is detailed, so that an edge
    meets few others however many vertices the outlines have; the work is
    spread by (parent, band).
    """
    fine = size / (1 << depth)
    pairs = candidate_pairs(zones, parents, size)
    bands = _band_directory(parents, size, most, depth)

    def banded(df: DataFrame) -> DataFrame:
        return lookup(_listed_bands(df, fine), bands, ["parent_id", "fine"], "inner").drop("fine").distinct()

    left = banded(lookup(zones, pairs, "zone_id", "inner").filter(
        (F.least("x1", "x2") < F.col("hi")) & (F.greatest("x1", "x2") > F.col("lo"))
    ).withColumn("_e", F.monotonically_increasing_id()))
    right = banded(parents.withColumn("parent_id", F.col("zone_id")).withColumn("_p", F.monotonically_increasing_id())).select(
        "parent_id", "_p", "lo_b", "hi_b", *[F.col(c).alias(f"p_{c}") for c in ("x1", "y1", "x2", "y2")]
    )
    both = lookup(left, right, ["parent_id", "lo_b", "hi_b"], "inner")
    l = F.greatest(F.least("x1", "x2"), F.least("p_x1", "p_x2"), "lo_b")
    r = F.least(F.greatest("x1", "x2"), F.greatest("p_x1", "p_x2"), "hi_b")
    met = both.withColumns({"_l": l.cast("double"), "_r": r.cast("double")}).filter("_r > _l")

    def height(prefix: str, at: str) -> Column:
        x1, y1, x2, y2 = (F.col(f"{prefix}{c}") for c in ("x1", "y1", "x2", "y2"))
        return y1 + (y2 - y1) * (F.col(at) - x1) / (x2 - x1) - F.col("base")

    met = met.withColumns(
        {"_al": height("", "_l"), "_ar": height("", "_r"), "_bl": height("p_", "_l"), "_br": height("p_", "_r")}
    )
    dl, dr = F.col("_al") - F.col("_bl"), F.col("_ar") - F.col("_br")
    w = F.col("_r") - F.col("_l")
    t = dl / (dl - dr)  # where the two edges cross, as a share of the strip
    at_cross = F.col("_al") + (F.col("_ar") - F.col("_al")) * t
    strip = (
        F.when((dl <= 0) & (dr <= 0), (F.col("_al") + F.col("_ar")) / 2 * w)
        .when((dl >= 0) & (dr >= 0), (F.col("_bl") + F.col("_br")) / 2 * w)
        .otherwise(
            (F.least("_al", "_bl") + at_cross) / 2 * t * w + (at_cross + F.least("_ar", "_br")) / 2 * (1 - t) * w
        )
    )
    sign = F.signum(F.col("x2") - F.col("x1")) * F.signum(F.col("p_x2") - F.col("p_x1"))
    return (
        met.groupBy("zone_id", "parent_id").agg(F.sum(sign * strip).alias("overlap")).filter(F.col("overlap") > 0)
    )


def assign_largest_overlap(zones: DataFrame, parents: DataFrame, size: float) -> DataFrame:
    """Parent sharing the largest area with each zone; ties to the smaller id."""
    return argmax_row(overlap_area(zones, parents, size), "zone_id", "overlap", ["parent_id"])
