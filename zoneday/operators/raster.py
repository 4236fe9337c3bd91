"""Zone x grid-cell coverage and zonal means over scanline tables.

A daily grid is stored one row per scanline, ``(var, date, row, values
array<float>)``; a zone layer's coverage is computed once per grid and kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zoneday import fixed_values as fv
from zoneday.operators.rollup import weighted_mean
from zoneday.session import lookup, materialize


@dataclass(frozen=True)
class GridSpec:
    """Regular grid: left and top edge, cell size, shape; row 0 is the top row."""

    x0: float
    y0: float
    dx: float
    dy: float
    nrows: int
    ncols: int
    nodata: float = fv.GRID_NODATA


def to_grid(edges: DataFrame, grid: GridSpec) -> DataFrame:
    """Edges in cell units with rows counted downwards.

    Counting down mirrors the plane, so each edge is also reversed to keep
    outlines positive.
    """
    gx = lambda c: (F.col(c) - grid.x0) / grid.dx
    gy = lambda c: (grid.y0 - F.col(c)) / grid.dy
    return edges.select(
        *[c for c in edges.columns if c not in ("x1", "y1", "x2", "y2")],
        gx("x2").alias("x1"),
        gy("y2").alias("y1"),
        gx("x1").alias("x2"),
        gy("y1").alias("y2"),
    )


def coverage_weights(
    edges: DataFrame, nrows: int, ncols: int, zone: str = "zone_id", eps: float = 1e-12
) -> DataFrame:
    """Exact share of every grid cell covered by every zone: (zone, row, col, cov).

    Signed-area accumulation: each edge is cut at row and column lines; a piece
    adds its height to all cells on its left and the part left of it to its own
    cell.  A running sum along the scanline, from the right, gives the cover.
    Edges are in cell units (see ``to_grid``).
    """
    top, bottom = F.least("y1", "y2"), F.greatest("y1", "y2")
    by_row = (
        edges.filter("y1 <> y2")
        .filter((bottom > 0) & (top < nrows))
        .withColumn(
            "row",
            F.explode(
                F.sequence(
                    F.greatest(F.floor(top), F.lit(0)), F.least(F.ceil(bottom) - 1, F.lit(nrows - 1))
                )
            ),
        )
    )
    slope = (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    limit = lambda c: F.least(F.greatest(F.col(c), F.col("row")), F.col("row") + 1)
    by_row = by_row.withColumns({"ya": limit("y1"), "yb": limit("y2")})
    at = lambda y: F.col("x1") + (F.col(y) - F.col("y1")) * slope
    cut = by_row.select(zone, "row", "ya", "yb", at("ya").alias("xa"), at("yb").alias("xb"))

    # right of the grid one column collects everything; left of it nothing counts
    left, right = F.least("xa", "xb"), F.greatest("xa", "xb")
    last = F.greatest(F.floor(left), F.ceil(right) - 1)
    by_cell = cut.withColumn(
        "col",
        F.explode(
            F.sequence(
                F.greatest(F.least(F.floor(left), F.lit(ncols)), F.lit(-1)),
                F.greatest(F.least(last, F.lit(ncols)), F.lit(-1)),
            )
        ),
    )
    lo = F.when(F.col("col") == -1, left).otherwise(F.greatest(left, F.col("col").cast("double")))
    hi = F.when(F.col("col") == ncols, right).otherwise(F.least(right, F.col("col") + 1.0))
    width = F.col("xb") - F.col("xa")
    share = F.when(width == 0, F.lit(1.0)).otherwise((hi - lo) / F.abs(width))
    dy = (F.col("yb") - F.col("ya")) * share
    pieces = by_cell.filter("col >= 0").select(
        zone, "row", "col", dy.alias("_dy"), (dy * ((lo + hi) / 2 - F.col("col"))).alias("_part")
    )
    touched = pieces.groupBy(zone, "row", "col").agg(F.sum("_dy").alias("_dy"), F.sum("_part").alias("_part"))

    w = Window.partitionBy(zone, "row").orderBy(F.col("col").desc())
    to_right = F.coalesce(F.sum("_dy").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    swept = touched.withColumns({"_right": to_right, "_next": F.coalesce(F.lead("col").over(w), F.lit(-1))})
    cells = swept.select(
        zone,
        "row",
        F.col("col").alias("_touched"),
        "_right",
        "_part",
        "_dy",
        F.explode(F.sequence(F.col("_next") + 1, F.col("col"))).alias("col"),
    )
    own = F.col("_right") + F.col("_part")
    cov = F.when(F.col("col") == F.col("_touched"), own).otherwise(F.col("_right") + F.col("_dy"))
    return (
        cells.select(zone, F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), cov.alias("cov"))
        .filter((F.col("col") < ncols) & (F.col("cov") > eps))
    )


def weight_runs(weights: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Coverage as runs (zone, row, col, n, cov): neighbouring full cells become one run.

    Only cells on a zone's edge stay single, so a run table is several times
    shorter than the cell table.  Keep it with the layer.
    """
    full = F.abs(F.col("cov") - 1) < 1e-9
    order = F.row_number().over(Window.partitionBy(zone, "row", "_full").orderBy("col"))
    marked = weights.withColumn("_full", full).withColumn("_run", F.col("col") - F.when(F.col("_full"), order).otherwise(0))
    return (
        marked.groupBy(zone, "row", "_full", "_run")
        .agg(F.min("col").alias("col"), F.count(F.lit(1)).cast("int").alias("n"), F.avg("cov").alias("cov"))
        .select(zone, "row", "col", "n", F.when(F.col("_full"), F.lit(1.0)).otherwise(F.col("cov")).alias("cov"))
    )


def _prefix_sums() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    # an inner function travels to the workers by value, so they need not have this package
    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Scanlines to running sums and counts of their given values, each starting with 0."""
        for batch in batches:
            lists = batch.column("values")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("float64")
            given = ~np.isnan(flat)
            flat = np.where(given, flat, 0.0)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            width = int(sizes[0]) if len(sizes) else 0
            if (sizes != width).any():
                raise ValueError("scanlines of one grid differ in length")
            shape = (len(sizes), width)
            sums, counts = np.zeros((len(sizes), width + 1)), np.zeros((len(sizes), width + 1), dtype="int32")
            np.cumsum(flat.reshape(shape), axis=1, out=sums[:, 1:])
            np.cumsum(given.reshape(shape), axis=1, out=counts[:, 1:])
            sums, counts = sums.ravel(), counts.ravel()
            offsets = np.arange(len(sizes) + 1, dtype="int32") * (width + 1)
            columns = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(v)) for v in (sums, counts)]
            keys = [batch.column(c) for c in ("var", "date", "row")]
            yield pa.RecordBatch.from_arrays([*keys, *columns], names=["var", "date", "row", "sums", "counts"])

    return running


def zonal_mean(grid: DataFrame, weights: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Coverage-weighted mean of each scanline table day over each zone.

    With running sums along the scanline every run, however long, costs two
    array reads.  The runs go to the scanlines and the partial sums of a map
    task leave one row per zone and day before any shuffle.  Cell weights are
    accepted too: they are turned into runs and written first, so that their
    bytes are known when the join is planned.  Runs are broadcast where these
    allow that; otherwise the scanlines are shuffled by row.
    """
    runs = weights if "n" in weights.columns else materialize(weight_runs(weights, zone), "weight-runs")
    lines = grid.select("var", "date", "row", "values").filter(F.col("values").isNotNull())
    kinds = ", ".join(f"`{c}` {dict(lines.dtypes)[c]}" for c in ("var", "date", "row"))
    summed = lines.mapInArrow(_prefix_sums(), f"{kinds}, sums array<double>, counts array<int>")
    met = lookup(summed, runs, "row", "inner")
    over = lambda a: F.get(a, F.col("col") + F.col("n")) - F.get(a, F.col("col"))
    return (
        met.select(zone, "var", "date", "cov", over("sums").alias("_sum"), over("counts").alias("_n"))
        .groupBy(zone, "var", "date")
        .agg(F.try_divide(F.sum(F.col("_sum") * F.col("cov")), F.sum(F.col("_n") * F.col("cov"))).alias("value"))
    )


def zonal_mean_cells(cells: DataFrame, weights: DataFrame, zone: str = "zone_id") -> DataFrame:
    """The same over one row per cell, ``(var, date, row, col, value)``."""
    return (
        lookup(cells, weights, ["row", "col"], "inner")
        .groupBy(zone, "var", "date")
        .agg(weighted_mean("value", "cov").alias("value"))
    )


def _cut(first_col: int, n_cols: int, nodata: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    # an inner function travels to the workers by value, so they need not have this package
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The wanted columns of each scanline, missing cells masked, a whole Arrow batch at a time."""
        for batch in batches:
            lists = batch.column("values")
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            width = np.clip(sizes - first_col, 0, n_cols)
            ends = np.cumsum(width)
            at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts + first_col - ends + width, width)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("float32")[at]
            cells = pa.array(flat, mask=np.isnan(flat) | (flat == np.float32(nodata)))
            offsets = pa.array(np.r_[0, ends].astype("int32"), mask=np.r_[np.asarray(lists.is_null()), False])
            keys = [batch.column(c) for c in ("var", "date", "row")]
            yield pa.RecordBatch.from_arrays([*keys, pa.ListArray.from_arrays(offsets, cells)], names=["var", "date", "row", "values"])

    return cut


def clip_grid(
    grid: DataFrame, first_row: int, last_row: int, first_col: int, n_cols: int, nodata: float = fv.GRID_NODATA
) -> DataFrame:
    """Window of a scanline table; no-data and NaN become NULL.  Rows are renumbered from 0."""
    rows = grid.filter(F.col("row").between(first_row, last_row)).select("var", "date", (F.col("row") - first_row).alias("row"), "values")
    kinds = ", ".join(f"`{c}` {dict(rows.dtypes)[c]}" for c in ("var", "date", "row"))
    return rows.mapInArrow(_cut(first_col, n_cols, nodata), f"{kinds}, values array<float>")


def bbox_window(grid: GridSpec, bbox: tuple[float, float, float, float]) -> tuple[int, int, int, int]:
    """Rows and columns of a grid inside (xmin, ymin, xmax, ymax), for ``clip_grid``."""
    xmin, ymin, xmax, ymax = bbox
    first_row = max(0, round((grid.y0 - ymax) / grid.dy))
    last_row = min(grid.nrows, round((grid.y0 - ymin) / grid.dy)) - 1
    first_col = max(0, round((xmin - grid.x0) / grid.dx))
    end_col = min(grid.ncols, round((xmax - grid.x0) / grid.dx))
    return first_row, last_row, first_col, end_col - first_col


def _scatter(ncols: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    # an inner function travels to the workers by value, so they need not have this package
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(cols, vals) lists to full-width scanlines, a whole Arrow batch at a time."""
        for batch in batches:
            cols = batch.column("cols")
            line = np.repeat(np.arange(len(cols)), cols.value_lengths().to_numpy(zero_copy_only=False))
            at = line * ncols + cols.flatten().to_numpy(zero_copy_only=False)
            flat = np.zeros(len(cols) * ncols, dtype="float32")
            empty = np.ones(len(flat), dtype=bool)
            flat[at], empty[at] = batch.column("vals").flatten().to_numpy(zero_copy_only=False), False
            ends = pa.array(np.arange(len(cols) + 1, dtype="int32") * ncols)
            values = pa.ListArray.from_arrays(ends, pa.array(flat, type=pa.float32(), mask=empty))
            keys = [batch.column(c) for c in ("var", "date", "row")]
            yield pa.RecordBatch.from_arrays([*keys, values], names=["var", "date", "row", "values"])

    return place


def cells_to_scanlines(cells: DataFrame, ncols: int) -> DataFrame:
    """One row per cell to one array per scanline; absent cells are NULL.

    A scanline holds at most ``ncols`` given cells, one per column, which
    bounds the group.  A cell outside the grid is an error; of several values
    of one cell the largest is taken.
    """
    column = F.when(F.col("col").between(0, ncols - 1), F.col("col")).otherwise(
        F.raise_error(F.concat(F.lit("cell outside the grid: column "), F.coalesce(F.col("col").cast("string"), F.lit("NULL"))))
    )
    given = (
        cells.filter(F.col("value").isNotNull())
        .groupBy("var", "date", "row", column.alias("col"))
        .agg(F.max("value").alias("value"))
    )
    entry = F.struct(F.col("col").cast("int").alias("c"), F.col("value").cast("float").alias("v"))
    lists = (
        given.groupBy("var", "date", "row")
        .agg(F.collect_list(entry).alias("_e"))
        .select("var", "date", "row", F.col("_e.c").alias("cols"), F.col("_e.v").alias("vals"))
    )
    kinds = ", ".join(f"`{c}` {dict(lists.dtypes)[c]}" for c in ("var", "date", "row"))
    return lists.mapInArrow(_scatter(ncols), f"{kinds}, values array<float>")
