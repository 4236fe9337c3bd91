"""Rasters and polygons derived from the tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from star_queries.registry import r, register, sql, table, view
from zoneday.functions.geodesy import PARAMETERS as P
from zoneday.operators import geometry, keys, manifest, raster, stacks
from zoneday.session import materialize, scratch_path
from zoneday.sources import grids, polygons, rasters

GRID = raster.GridSpec(x0=0.0, y0=10.0, dx=1.0, dy=1.0, nrows=10, ncols=10)


# ---- inputs --------------------------------------------------------------


def ring_of(*corners: tuple[str, str]) -> Column:
    pts = [F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")) for x, y in corners]
    return F.array(*pts, pts[0])


def rings(df: DataFrame, *corners: tuple[str, str]) -> DataFrame:
    return df.select("zone_id", F.lit(0).alias("part"), F.lit(0).alias("ring"), ring_of(*corners).alias("pts"))


BOX = (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"))
QUAD = (("ax", "ay"), ("bx", "by_"), ("cx", "cy"), ("dx", "dy"))


def box_edges(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return geometry.ring_edges(rings(view(spark, sf, name), *BOX))


def quad_edges(spark: SparkSession, sf: str) -> DataFrame:
    return geometry.ring_edges(rings(view(spark, sf, "quads"), *QUAD))


def scanlines(spark: SparkSession, sf: str) -> DataFrame:
    return raster.cells_to_scanlines(view(spark, sf, "grid"), 10)


# ---- rasters -------------------------------------------------------------


@register(
    "coverage_weights",
    sql(
        """select zone_id, cast(r as int) as row, cast(c as int) as col,
             round((least(x1,c+1)-greatest(x0,c)) * (least(y1,r+1)-greatest(y0,r)),9) as cov
           from (select *, unnest(range(cast(floor(x0) as int), cast(ceil(x1) as int))) as c from
             (select *, unnest(range(cast(floor(y0) as int), cast(ceil(y1) as int))) as r from boxes_a))
           where (least(x1,c+1)-greatest(x0,c)) * (least(y1,r+1)-greatest(y0,r)) > 1e-12""",
        "boxes_a",
    ),
)
def coverage_weights(spark, sf):
    """One rectangle per supplier, off the grid lines, against the closed form."""
    cov = raster.coverage_weights(box_edges(spark, sf, "boxes_a"), 40, 60)
    return cov.withColumn("cov", r("cov", 9))


_QUAD_AREA = "((bx-ax)*(cy-ay)-(cx-ax)*(by_-ay))/2 + ((cx-ax)*(dy-ay)-(dx-ax)*(cy-ay))/2"


@register(
    "coverage_area",
    sql(f"select zone_id, round({_QUAD_AREA}, 8) as area from quads", "quads"),
)
def coverage_area(spark, sf):
    """Irregular quadrilaterals on a map grid: covered cells add up to the polygon's own area."""
    grid = raster.GridSpec(x0=-107.0, y0=37.0, dx=0.05, dy=0.04, nrows=300, ncols=300)
    cov = raster.coverage_weights(raster.to_grid(quad_edges(spark, sf), grid), grid.nrows, grid.ncols)
    return cov.groupBy("zone_id").agg(r(F.sum("cov") * grid.dx * grid.dy, 8).alias("area"))


_ZONAL = """select zone_id, var, date, round(sum(cov*value)/sum(cov),6) as value from grid join cover using (row, col) group by 1,2,3"""


@register("zonal_mean", sql(_ZONAL.replace("cov*value", "cov*cast(cast(value as float) as double)"), "grid", "cover"))
def zonal_mean(spark, sf):
    """Whole scanlines with coverage runs computed once and kept."""
    cover = raster.coverage_weights(box_edges(spark, sf, "rect_polygons"), 10, 10)
    weights = materialize(raster.weight_runs(cover), "runs")
    out = raster.zonal_mean(scanlines(spark, sf), weights)
    # a day all of whose cells are missing in a zone is NULL here and absent from the cell join
    return out.filter(F.col("value").isNotNull()).withColumn("value", r("value"))


@register("zonal_mean_stacked", sql(_ZONAL.replace("cov*value", "cov*cast(cast(value as float) as double)"), "grid", "cover"))
def zonal_mean_stacked(spark, sf):
    """All days of a month at once, over strips of four columns; coverage kept as sparse matrices."""
    cover = raster.coverage_weights(box_edges(spark, sf, "rect_polygons"), 10, 10)
    tiles = stacks.layer_tiles(raster.weight_runs(cover), width=4)
    out = stacks.zonal_mean_stacked(stacks.stack_lines(scanlines(spark, sf), width=4), tiles)
    return out.filter(F.col("value").isNotNull()).withColumn("value", r("value"))


@register("zonal_mean_cells", sql(_ZONAL, "grid", "cover"))
def zonal_mean_cells(spark, sf):
    weights = materialize(raster.coverage_weights(box_edges(spark, sf, "rect_polygons"), 10, 10), "weights")
    return raster.zonal_mean_cells(view(spark, sf, "grid"), weights).withColumn("value", r("value"))


_CLIPPED = """select var, date, cast(row - 2 as int) as row, col - 3 as col, round(cast(cast(value as float) as double),6) as value
    from grid where row between 2 and 7 and col between 3 and 8"""


def _cells(lines: DataFrame) -> DataFrame:
    cells = lines.select("var", "date", F.col("row").cast("int").alias("row"), F.posexplode("values").alias("col", "value"))
    return cells.filter("value is not null").withColumn("value", r(F.col("value").cast("double")))


@register("clip_grid", sql(_CLIPPED, "grid"))
def clip_grid(spark, sf):
    """A window of the scanline table cut by a bounding box."""
    window = raster.bbox_window(GRID, (3.0, 2.0, 9.0, 8.0))
    return _cells(raster.clip_grid(scanlines(spark, sf), *window))


def _packer() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Value lists to raw little-endian float grids, the layout of the source files."""
        for batch in batches:
            lists = batch.column("values")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<f4")
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            content = pa.array([part.tobytes() for part in np.split(flat, ends[:-1])], pa.binary())
            keys = [batch.column(c) for c in ("var", "date")]
            yield pa.RecordBatch.from_arrays([*keys, content], names=["var", "date", "content"])

    return pack


def whole_grids(spark: SparkSession, sf: str) -> DataFrame:
    """(var, date, content): raw float grids made from the line items, one per flag and day."""
    cells = view(spark, sf, "grid")
    # a whole grid file as one line of 100 values; absent cells carry the no-data value
    line = cells.select("var", "date", F.lit(0).alias("row"), (F.col("row") * 10 + F.col("col")).alias("col"), "value")
    days = raster.cells_to_scanlines(line, 100).select(
        "var", "date", F.transform("values", lambda v: F.coalesce(v, F.lit(GRID.nodata).cast("float"))).alias("values")
    )
    return days.mapInArrow(_packer(), "var string, date date, content binary")


@register("bil_decode", sql(_CLIPPED, "grid"))
def bil_decode(spark, sf):
    """Raw float grids, cropped and decoded."""
    window = raster.bbox_window(GRID, (3.0, 2.0, 9.0, 8.0))
    return _cells(rasters.decode_bil(whole_grids(spark, sf), GRID, window))


def grid_files(spark: SparkSession, sf: str) -> str:
    """The same grids as files with headers, below a folder per variable and year."""
    root = scratch_path(spark, "grids")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root) if ":" in root else (fs.LocalFileSystem(), root)
        head = "BYTEORDER I\nNROWS 10\nNCOLS 10\nNBANDS 1\nNBITS 32\nULXMAP 0.5\nULYMAP 9.5\nXDIM 1\nYDIM 1\nNODATA -9999\n"
        for batch in batches:
            for var, day, content in zip(*(batch.column(c).to_pylist() for c in ("var", "date", "content")), strict=True):
                folder = f"{base}/{var}/{day.year}"
                store.create_dir(folder, recursive=True)
                for ext, data in (("hdr", head.encode()), ("bil", content)):
                    with store.open_output_stream(f"{folder}/grid_{var}_us_25m_{day:%Y%m%d}.{ext}") as f:
                        f.write(data)
            yield batch.select(["var"])

    whole_grids(spark, sf).mapInArrow(save, "var string").write.format("noop").mode("overwrite").save()
    return root


FLAGS = ("a", "n", "r")


@register("bil_window_read", sql(_CLIPPED.replace("select var,", "select lower(var) as var,", 1), "grid"))
def bil_window_read(spark, sf):
    """Grid files read through the data source: of each only the window's bytes."""
    window = raster.bbox_window(GRID, (3.0, 2.0, 9.0, 8.0))
    return _cells(grids.read_lines(spark, grid_files(spark, sf), FLAGS, window, gap_bytes="0"))


@register(
    "raster_catalog",
    sql("select distinct lower(var) as var, date, cast(400 as bigint) as length, 10 as nrows, 10 as ncols from grid", "grid"),
)
def raster_catalog(spark, sf):
    """The catalog over written grid files with the shapes their headers name."""
    found = rasters.shaped_catalog(spark, grid_files(spark, sf), FLAGS, date(1900, 1, 1), date(2100, 1, 1))
    return manifest.valid_files(found, 400, (10, 10)).select("var", "date", "length", "nrows", "ncols")


# ---- polygons ------------------------------------------------------------


def _albers(lon: str, lat: str) -> tuple[str, str]:
    """Forward projection as SQL text."""
    s = f"sin(radians({lat}))"
    q = f"({1 - P['e2']!r}*({s}/(1-{P['e2']!r}*{s}*{s}) - ln((1-{P['e']!r}*{s})/(1+{P['e']!r}*{s}))/{2 * P['e']!r}))"
    rho = f"({P['a']!r}*sqrt({P['c']!r}-{P['n']!r}*{q})/{P['n']!r})"
    theta = f"({P['n']!r}*radians({lon}+100.0))"
    return f"({P['fe']!r}+{rho}*sin({theta}))", f"({P['fn']!r}+{P['rho0']!r}-{rho}*cos({theta}))"


def _quad_sql() -> str:
    corners = ["a", "b", "c", "d"]
    ys = {"a": "ay", "b": "by_", "c": "cy", "d": "dy"}
    cols = []
    for c in corners:
        x, y = _albers(f"{c}x", ys[c])
        cols += [f"{x} as p{c}x", f"{y} as p{c}y"]
    pairs = list(zip(corners, corners[1:] + corners[:1]))
    cross = lambda i, j: f"(p{i}x*p{j}y - p{j}x*p{i}y)"
    area = "(" + "+".join(cross(i, j) for i, j in pairs) + ")/2"
    sx = "+".join(f"(p{i}x+p{j}x)*{cross(i, j)}" for i, j in pairs)
    sy = "+".join(f"(p{i}y+p{j}y)*{cross(i, j)}" for i, j in pairs)
    return f"(select zone_id, {area} as area, ({sx})/(3*2*({area})) as mx, ({sy})/(3*2*({area})) as my from (select zone_id, {', '.join(cols)} from quads))"


_E2 = P["e2"]
_INVERSE = f"""select zone_id, round(area/1e6,3) as area_km2,
    round(-100.0 + degrees(atan2(x, y))/{P['n']!r}, 6) as centroid_lon,
    round(degrees(beta + {_E2 / 3 + 31 * _E2**2 / 180 + 517 * _E2**3 / 5040!r}*sin(2*beta)
      + {23 * _E2**2 / 360 + 251 * _E2**3 / 3780!r}*sin(4*beta) + {761 * _E2**3 / 45360!r}*sin(6*beta)), 6) as centroid_lat
    from (select *, asin((({P['c']!r} - (x*x+y*y)*{P['n'] ** 2!r}/{P['a'] ** 2!r})/{P['n']!r})/{P['qp']!r}) as beta
      from (select *, mx - {P['fe']!r} as x, {P['rho0']!r} - (my - {P['fn']!r}) as y from {_quad_sql()}))"""


@register("polygon_metrics", sql(_INVERSE, "quads"))
def polygon_metrics(spark, sf):
    return geometry.polygon_metrics(quad_edges(spark, sf)).select(
        "zone_id", r("area_km2", 3), r("centroid_lon"), r("centroid_lat")
    )


_TILES = """select s_nationkey as cz_id, s_suppkey % 10 as x, s_suppkey // 10 as y from supplier"""
_TILE_EDGES = f"""select cz_id, x, y, 'h' as d from ({_TILES}) union all select cz_id, x, y+1, 'h' from ({_TILES})
    union all select cz_id, x, y, 'v' from ({_TILES}) union all select cz_id, x+1, y, 'v' from ({_TILES})"""


@register(
    "dissolve",
    f"""select cz_id, area, cx, cy, n_edges from
        (select cz_id, cast(count(*) as double) as area, round(avg(x+0.5),6) as cx, round(avg(y+0.5),6) as cy from ({_TILES}) group by 1)
        join (select cz_id, count(*) as n_edges from
          (select cz_id, x, y, d from ({_TILE_EDGES}) group by all having count(*) = 1) group by 1) using (cz_id)""",
)
def dissolve(spark, sf):
    """Unit tiles, one per supplier, joined by nation: area, centroid and the outline's edge count."""
    s = table(spark, sf, "supplier")
    tiles = s.select(
        F.concat(F.lit("t"), F.col("s_suppkey").cast("string")).alias("zone_id"),
        (F.col("s_suppkey") % 10).alias("x0"),
        (F.col("s_suppkey") % 10 + 1).alias("x1"),
        F.floor(F.col("s_suppkey") / 10).alias("y0"),
        (F.floor(F.col("s_suppkey") / 10) + 1).alias("y1"),
    )
    parents = s.select(
        F.concat(F.lit("t"), F.col("s_suppkey").cast("string")).alias("zone_id"), F.col("s_nationkey").alias("cz_id")
    )
    outline = geometry.dissolve(geometry.ring_edges(rings(tiles, *BOX)), parents)
    metrics = geometry.polygon_metrics(outline, "cz_id", projected=True)
    edges = outline.groupBy("cz_id").agg(F.count(F.lit(1)).alias("n_edges"))
    return metrics.select("cz_id", r("area"), r("cx"), r("cy")).join(edges, "cz_id")


_HALVES = """select s_nationkey as cz_id, s_suppkey % 10 as x, s_suppkey // 10 as y from supplier"""
# the sides of tiles in half units, left and right ones twice as many as upper and lower ones
_HALF_EDGES = f"""select cz_id, 2*(x+dx) as x, 2*y+dy as y, 'v' as d, 0.5 as len from ({_HALVES}), (select unnest([0,1]) as dx), (select unnest([0,1]) as dy)
    union all select cz_id, 2*x, 2*(y+dy), 'h', 1.0 from ({_HALVES}), (select unnest([0,1]) as dy)"""


@register(
    "dissolve_t_junctions",
    f"""select cz_id, area, perimeter from (select cz_id, cast(count(*) as double) as area from ({_HALVES}) group by 1)
        join (select cz_id, round(cast(sum(len) as double), 6) as perimeter from
          (select cz_id, x, y, d, max(len) as len from ({_HALF_EDGES}) group by 1,2,3,4 having count(*) = 1) group by 1) using (cz_id)""",
)
def dissolve_t_junctions(spark, sf):
    """The tiles of ``dissolve``, of which every second column is cut into halves: their borders meet in T-junctions."""
    s = table(spark, sf, "supplier")
    half = F.explode(F.when(F.col("s_suppkey") % 2 == 1, F.array(F.lit(0.0), F.lit(0.5))).otherwise(F.array(F.lit(0.0)))).alias("from")
    tiles = s.select("s_nationkey", "s_suppkey", half).select(
        F.concat(F.lit("t"), F.col("s_suppkey").cast("string"), F.when(F.col("from") > 0, "b").otherwise("a")).alias("zone_id"),
        F.col("s_nationkey").alias("cz_id"),
        (F.col("s_suppkey") % 10).alias("x0"),
        (F.col("s_suppkey") % 10 + 1).alias("x1"),
        (F.floor(F.col("s_suppkey") / 10) + F.col("from")).alias("y0"),
        (F.floor(F.col("s_suppkey") / 10) + F.col("from") + F.when(F.col("s_suppkey") % 2 == 1, 0.5).otherwise(1.0)).alias("y1"),
    )
    outline = geometry.dissolve(geometry.ring_edges(rings(tiles, *BOX)), tiles.select("zone_id", "cz_id"), node_size=1.0)
    area = geometry.polygon_metrics(outline, "cz_id", projected=True).select("cz_id", r("area"))
    length = F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))
    return area.join(outline.groupBy("cz_id").agg(F.round(length, 6).alias("perimeter")), "cz_id")


@register("crossing_rings", sql("select zone_id, 0 as i, 2 as j from quads where zone_id like '%3'", "quads"))
def crossing_rings(spark, sf):
    """Quadrilaterals of which those ending in 3 have two corners swapped, which makes bow-ties."""
    q = view(spark, sf, "quads")
    bow = F.col("zone_id").endswith("3")
    turned = q.withColumns({to: F.when(bow, F.col(of)).otherwise(F.col(to)) for to, of in (("bx", "cx"), ("by_", "cy"), ("cx", "bx"), ("cy", "by_"))})
    return geometry.crossing_edges(rings(turned, *QUAD)).select("zone_id", "i", "j")


# crossings of the mid-height line by the two long sides of each supplier quadrilateral
_MID = """select zone_id, round((l + rr)/2, 6) as x, round(m, 6) as y from (
    select *, case when m < dy then ax + (dx-ax)*(m-ay)/(dy-ay) else dx + (cx-dx)*(m-dy)/(cy-dy) end as l,
      case when m < by_ then ax + (bx-ax)*(m-ay)/(by_-ay) else bx + (cx-bx)*(m-by_)/(cy-by_) end as rr
    from (select *, (ay + cy)/2 as m from quads))"""


@register("interior_point", sql(_MID, "quads"))
def interior_point(spark, sf):
    return geometry.interior_point(quad_edges(spark, sf)).select("zone_id", r("x"), r("y"))


_INSIDE = """select point_id, zone_id from sites join quads
    on x between ax and cx and y between ay and cy
    and (bx-ax)*(y-ay) - (by_-ay)*(x-ax) > 0 and (cx-bx)*(y-by_) - (cy-by_)*(x-bx) > 0
    and (dx-cx)*(y-cy) - (dy-cy)*(x-cx) > 0 and (ax-dx)*(y-dy) - (ay-dy)*(x-dx) > 0"""


@register("points_in_polygons", sql(_INSIDE, "sites", "quads"))
def points_in_polygons(spark, sf):
    """Customer sites in supplier quadrilaterals, by ray crossings; the SQL tests the four half planes."""
    return geometry.points_in_polygons(view(spark, sf, "sites"), quad_edges(spark, sf), size=0.25)


_OVERLAP = """select a.zone_id, b.zone_id as parent_id,
    (least(a.x1,b.x1)-greatest(a.x0,b.x0))*(least(a.y1,b.y1)-greatest(a.y0,b.y0)) as overlap
    from boxes_a a join boxes_b b on least(a.x1,b.x1) > greatest(a.x0,b.x0) and least(a.y1,b.y1) > greatest(a.y0,b.y0)"""


@register(
    "overlap_area",
    sql(f"select zone_id, parent_id, round(overlap,6) as overlap from ({_OVERLAP}) where overlap > 1e-9", "boxes_a", "boxes_b"),
)
def overlap_area(spark, sf):
    out = geometry.overlap_area(box_edges(spark, sf, "boxes_a"), box_edges(spark, sf, "boxes_b"), size=3.0)
    return out.filter("overlap > 1e-9").withColumn("overlap", r("overlap"))


@register(
    "largest_overlap",
    sql(
        f"""select zone_id, parent_id, round(overlap,6) as overlap from (select *, row_number() over
        (partition by zone_id order by round(overlap,9) desc, parent_id) as rn from ({_OVERLAP})) where rn=1""",
        "boxes_a",
        "boxes_b",
    ),
)
def largest_overlap(spark, sf):
    out = geometry.assign_largest_overlap(
        box_edges(spark, sf, "boxes_a"), box_edges(spark, sf, "boxes_b"), size=3.0
    )
    return out.withColumn("overlap", r("overlap"))


@register(
    "valid_rings",
    sql("select zone_id from quads where substring(zone_id, 2) not like '%7'", "quads"),
)
def valid_rings(spark, sf):
    """Quadrilaterals of which those ending in 7 are folded flat and must be rejected."""
    q = view(spark, sf, "quads")
    flat = F.col("zone_id").endswith("7")
    bent = q.withColumns({c: F.when(flat, F.col("ax")).otherwise(F.col(c)) for c in ("bx", "cx", "dx")})
    return geometry.valid_rings(rings(bent, *QUAD)).select("zone_id")


@register(
    "geojson_polygons",
    sql(
        """select lpad(zone_id, greatest(5, cast(length(zone_id) as int)), '0') as zone_id, 'Zone ' || zone_id as zone_name, round(area, 6) as area from (
           select zone_id, ((bx-ax)*(cy-ay)-(cx-ax)*(by_-ay))/2 + ((cx-ax)*(dy-ay)-(dx-ax)*(cy-ay))/2 as area from quads)""",
        "quads",
    ),
)
def geojson_polygons(spark, sf):
    """Layer written as line-delimited GeoJSON, Polygon and MultiPolygon, and read back."""
    q = view(spark, sf, "quads")
    point = lambda x, y: F.array(F.col(x).cast("double"), F.col(y).cast("double"))
    ring = F.array(*[point(x, y) for x, y in (*QUAD, QUAD[0])])
    one = F.to_json(F.array(ring))
    multi = F.to_json(F.array(F.array(ring)))
    single = F.col("zone_id").endswith("1")
    names = F.array(*map(F.lit, polygons.ID_ALTERNATES["zone_id"]))
    shape = F.concat(
        # each feature has its id under one of the names in use
        F.lit('{"type":"Feature","properties":{"'), F.element_at(names, (F.pmod(F.xxhash64("zone_id"), F.lit(4)) + 1).cast("int")), F.lit('":"'), F.col("zone_id"),
        F.lit('","NAME":"Zone '), F.col("zone_id"),
        F.lit('"},"geometry":{"type":"'), F.when(single, "Polygon").otherwise("MultiPolygon"),
        F.lit('","coordinates":'), F.when(single, one).otherwise(multi), F.lit("}}"),
    )
    path = scratch_path(spark, "geojson")
    q.select(shape.alias("value")).write.text(path)
    layer = polygons.read_polygons(spark, path)
    areas = geometry.polygon_metrics(geometry.ring_edges(geometry.valid_rings(layer)), projected=True)
    names = layer.select("zone_id", "zone_name").distinct()
    return keys.attach(areas, names, "zone_id").select("zone_id", "zone_name", r("area"))
