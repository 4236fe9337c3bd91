"""Adaptive cell coverings of polygon layers, for point-in-polygon joins.

A polygon is covered by square cells of one global grid.  Cells that no edge
touches lie inside or outside as a whole; a cell with more than ``most`` edges
is split into 4 x 4 smaller ones, down to ``depth`` levels.  A leaf so has
either no edges and is wholly inside, or few edges and a reference point whose
state is known: a point of the leaf lies inside if the straight way to it from
the reference point crosses the leaf's edges as often as that state asks for.
Points meet leaves by cell number, and only points in leaves with edges are
compared with edges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneday.session import materialize

SPLIT = 4
MOST = 24
DEPTH = 7
# where in a cell its reference point lies: off every tidy coordinate
_FX, _FY = 0.3819660112501051, 0.4142135623730951
EDGE = "struct<x1:double,y1:double,x2:double,y2:double>"


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / size)


def _side(ax: Column, ay: Column, bx: Column, by: Column, x: Column, y: Column) -> Column:
    """Whether (x, y) lies to the left of the line from a to b."""
    return (bx - ax) * (y - ay) - (by - ay) * (x - ax) > 0


def crossings(edges: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """How many of ``edges`` the straight way from a to b crosses.

    A vertex on the way belongs to one side of it for both edges that meet
    there, so the number's parity is right wherever the way passes.
    """

    def crosses(e: Column) -> Column:
        apart = _side(ax, ay, bx, by, e["x1"], e["y1"]) != _side(ax, ay, bx, by, e["x2"], e["y2"])
        return apart & (_side(e["x1"], e["y1"], e["x2"], e["y2"], ax, ay) != _side(e["x1"], e["y1"], e["x2"], e["y2"], bx, by))

    return F.size(F.filter(edges, crosses))


def touched_cells(edges: DataFrame, size: float, zone: str) -> DataFrame:
    """(zone, cx, cy, e): each edge in every cell it touches; a cell too many does no harm."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.withColumn("cy", F.explode(F.sequence(_cell(low, size), _cell(high, size))))
    slope = F.when(F.col("y1") != F.col("y2"), (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")))
    clamp = lambda y: F.least(F.greatest(y, low), high)
    at = lambda y: F.col("x1") + (clamp(y) - F.col("y1")) * slope
    a, b = at(F.col("cy") * size), at((F.col("cy") + 1) * size)
    near = F.lit(size * 1e-9)
    left, right = F.coalesce(F.least(a, b), F.least("x1", "x2")) - near, F.coalesce(F.greatest(a, b), F.greatest("x1", "x2")) + near
    cells = rows.withColumn("cx", F.explode(F.sequence(_cell(left, size), _cell(right, size))))
    return cells.select(zone, "cx", "cy", F.struct(*(F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2"))).alias("e"))


def first_cells(edges: DataFrame, size: float, zone: str = "zone_id") -> DataFrame:
    """(zone, cx, cy, edges, inside): cells with edges, ``inside`` of the reference point, and cells wholly inside."""
    cells = touched_cells(edges, size, zone).groupBy(zone, "cx", "cy").agg(F.collect_list("e").alias("edges"))
    # along the line through a row's reference points: edges that cross it, reference points, and right borders of
    # cells behind which no edge follows at once
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    first, last = F.ceil(low / size - _FY), F.ceil(high / size - _FY) - 1
    y = (F.col("cy") + _FY) * size
    along = F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    hits = edges.filter((F.col("y1") != F.col("y2")) & (first <= last)).withColumn("cy", F.explode(F.sequence(first, last)))
    hits = hits.select(zone, "cy", along.alias("x"), F.lit(1).alias("n"), F.lit(None).cast("bigint").alias("cx"), F.lit(None).cast("bigint").alias("next"))
    follow = cells.select(zone, "cy", "cx", F.lead("cx").over(Window.partitionBy(zone, "cy").orderBy("cx")).alias("next"))
    refs = follow.select(zone, "cy", ((F.col("cx") + _FX) * size).alias("x"), F.lit(0).alias("n"), "cx", F.lit(None).cast("bigint").alias("next"))
    ends = follow.filter("next > cx + 1").select(zone, "cy", ((F.col("cx") + 1) * size).alias("x"), F.lit(0).alias("n"), "cx", "next")
    passed = F.sum("n").over(Window.partitionBy(zone, "cy").orderBy("x", "n").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marks = hits.unionByName(refs).unionByName(ends).withColumn("inside", passed % 2 == 1).filter("n = 0 and (next is null or inside)")
    # the cell itself, or the cells up to the next one
    stretch = F.when(F.col("next").isNull(), F.array("cx")).otherwise(F.sequence(F.col("cx") + 1, F.col("next") - 1))
    state = marks.select(zone, F.explode(stretch).alias("cx"), "cy", "inside")
    none = F.array().cast(f"array<{EDGE}>")
    return state.join(cells, [zone, "cx", "cy"], "left").select(zone, "cx", "cy", F.coalesce("edges", none).alias("edges"), "inside")


def _children(cells: DataFrame, size: float, zone: str) -> DataFrame:
    """Crowded cells of size ``size`` split into SPLIT x SPLIT smaller ones, each with the edges that touch it."""
    small = size / SPLIT
    k = F.explode(F.sequence(F.lit(0), F.lit(SPLIT * SPLIT - 1)))
    ref = ((F.col("cx") + _FX) * size, (F.col("cy") + _FY) * size)
    out = cells.select(zone, ref[0].alias("px"), ref[1].alias("py"), "cx", "cy", "edges", "inside", k.alias("k"))
    cx, cy = F.col("cx") * SPLIT + F.col("k") % SPLIT, F.col("cy") * SPLIT + F.floor(F.col("k") / SPLIT)
    out = out.withColumns({"cx": cx, "cy": cy})
    x0, y0 = F.col("cx") * small, F.col("cy") * small
    moved = crossings(F.col("edges"), F.col("px"), F.col("py"), x0 + _FX * small, y0 + _FY * small) % 2 == 1
    pad = small * 1e-9
    corners = [(x0 + dx, y0 + dy) for dx in (-pad, small + pad) for dy in (-pad, small + pad)]

    def touches(e: Column) -> Column:
        x = (F.least(e["x1"], e["x2"]) <= x0 + small + pad) & (F.greatest(e["x1"], e["x2"]) >= x0 - pad)
        y = (F.least(e["y1"], e["y2"]) <= y0 + small + pad) & (F.greatest(e["y1"], e["y2"]) >= y0 - pad)
        left = [_side(e["x1"], e["y1"], e["x2"], e["y2"], *c) for c in corners]
        right = [_side(e["x2"], e["y2"], e["x1"], e["y1"], *c) for c in corners]
        one_side = reduce(lambda a, b: a & b, left) | reduce(lambda a, b: a & b, right)
        return x & y & ~one_side

    return out.select(zone, "cx", "cy", F.filter("edges", touches).alias("edges"), (F.col("inside") != moved).alias("inside"))


def cover(edges: DataFrame, size: float, zone: str = "zone_id", most: int = MOST, depth: int = DEPTH) -> tuple[DataFrame, int]:
    """Leaves (zone, level, cx, cy, edges, inside) of every polygon's covering, written, and the number of levels.

    Cells of level n have the width size / SPLIT**n.  The first cells should be
    small enough for a task to hold the edges in one of them.  A cell that is
    still crowded at the last level stays as it is.
    """
    current, leaves = materialize(first_cells(edges, size, zone), "covering"), []
    for level in range(depth + 1):
        done = F.lit(level == depth) | (F.size("edges") <= most)
        kept = current.filter(done & (F.col("inside") | (F.size("edges") > 0)))
        leaves.append(kept.select(zone, F.lit(level).alias("level"), "cx", "cy", "edges", "inside"))
        crowded = current.filter(~done)
        if level == depth or crowded.isEmpty():
            break
        current = materialize(_children(crowded, size / SPLIT**level, zone), "covering")
    return reduce(DataFrame.unionByName, leaves), len(leaves)


def points_in_cover(points: DataFrame, leaves: DataFrame, levels: int, size: float, point: str = "point_id", zone: str = "zone_id") -> DataFrame:
    """Pairs (point, zone) with the point inside."""
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))
    placed = points.select(point, F.col("x").cast("double").alias("_x"), F.col("y").cast("double").alias("_y"), level.alias("level"))
    width = F.lit(float(size)) / F.pow(F.lit(float(SPLIT)), F.col("level"))
    placed = placed.withColumns({"cx": F.floor(F.col("_x") / width), "cy": F.floor(F.col("_y") / width)})
    met = placed.join(leaves, ["level", "cx", "cy"])
    moved = crossings(F.col("edges"), (F.col("cx") + _FX) * width, (F.col("cy") + _FY) * width, F.col("_x"), F.col("_y")) % 2 == 1
    return met.filter(F.col("inside") != moved).select(point, zone)
