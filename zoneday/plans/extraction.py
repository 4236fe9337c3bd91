"""Raster files to long zonal extracts, resuming where a former run stopped."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneday.operators.raster import GridSpec, bbox_window, coverage_weights, to_grid, weight_runs
from zoneday.operators.stacks import layer_tiles, zonal_mean_stacked
from zoneday.session import materialize, scratch_path
from zoneday.sources import grids, rasters, sinks


def layer_weights(
    edges: DataFrame, grid: GridSpec, bbox: tuple[float, float, float, float] | None = None
) -> DataFrame:
    """Coverage runs of a zone layer on a grid, or on the part of it inside ``bbox``; keep the result.

    Rows and columns count from the window's upper left cell, as they do in a
    grid decoded with the same window.
    """
    first_row, last_row, first_col, n_cols = window_of(grid, bbox)
    part = GridSpec(
        grid.x0 + first_col * grid.dx, grid.y0 - first_row * grid.dy, grid.dx, grid.dy, last_row - first_row + 1, n_cols
    )
    return weight_runs(coverage_weights(to_grid(edges, part), part.nrows, part.ncols))


def window_of(grid: GridSpec, bbox: tuple[float, float, float, float] | None) -> tuple[int, int, int, int]:
    return bbox_window(grid, bbox) if bbox else (0, grid.nrows - 1, 0, grid.ncols)


def extract_zones(
    spark: SparkSession,
    rasters_dir: str,
    variables: Sequence[str],
    start: date,
    end: date,
    grid: GridSpec,
    weights: DataFrame,
    out: str,
    bbox: tuple[float, float, float, float] | None = None,
    period: str = "yyyy",
    strict: bool = False,
) -> DataFrame:
    """Zonal means of all pending days, written to ``out``; returns (var, date, path, length, modified, period, status).

    Days already in ``out`` are left out before any grid is opened, unless
    their grid has been issued again since: then the day is replaced.  Pending
    files below the size of the grid, or whose header names another shape, are
    not read: they are returned as ``too short`` or ``other shape``, or fail
    the job with ``strict``, and are taken up by a later run once they are
    whole.  The others are read by month, the window's bytes only.
    """
    catalog = rasters.shaped_catalog(spark, rasters_dir, variables, start, end)
    dated = catalog.withColumn("period", F.date_format("date", period))
    dated = dated.withColumns({c: F.coalesce(c, F.lit(n)) for c, n in (("nrows", grid.nrows), ("ncols", grid.ncols))})
    size = grid.nrows * grid.ncols * 4
    same = (F.col("nrows") == grid.nrows) & (F.col("ncols") == grid.ncols) & (F.col("length") <= size)
    status = F.when(~same, "other shape").when(F.col("length") < size, "too short").otherwise("read")
    pending = materialize(sinks.pending_extracts(dated, out).withColumn("status", status).drop("nrows", "ncols"), "todo")
    if strict and (bad := pending.filter("status <> 'read'").first()):
        raise ValueError(f"{bad.status}: {bad.path}" if bad.status == "other shape" else f"grid cut short: {bad.path}")
    todo = pending.filter("status = 'read'")
    if todo.isEmpty():
        return pending
    listed = scratch_path(spark, "grid-files")
    todo.select("path", "length").write.parquet(listed)
    shape = f"{grid.nrows},{grid.ncols},{grid.nodata}"
    stacks = grids.read_stacks(spark, None, variables, window_of(grid, bbox), files=listed, shape=shape)
    means = zonal_mean_stacked(stacks, layer_tiles(weights)).withColumn("period", F.date_format("date", period))
    sinks.write_extracts(means, out, ["zone_id", "date"], todo)
    return pending
