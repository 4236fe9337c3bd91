"""Raster file catalog and raw float grids as scanline tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneday.operators.raster import GridSpec
from zoneday.session import lookup

# One file per variable and day, named
#   <source>_<var>_us_25m_<YYYYMMDD>.bil
#   <source>_<var>_stable_4kmD2_<YYYYMMDD>_bil.bil
#   <source>_<var>_tx_30s_<YYYYMMDD>.tif
RASTER_NAME = r"(?i)(?:^|/)[a-z]+_({vars})_[^/]+_(\d{{8}})(?:_bil)?\.({ext})$"


def name_parts(path: Column, variables: Sequence[str], ext: str = "bil|tif") -> tuple[Column, Column]:
    """Variable and date read from a raster path; no match gives an empty name and a NULL date."""
    pattern = RASTER_NAME.format(vars="|".join(variables), ext=ext)
    return (
        F.lower(F.regexp_extract(path, pattern, 1)),
        F.try_to_date(F.regexp_extract(path, pattern, 2), "yyyyMMdd"),
    )


def raster_catalog(
    spark: SparkSession, directory: str, variables: Sequence[str], start: date, end: date, ext: str = "bil|tif"
) -> DataFrame:
    """(var, date, path, length, modified) of the raster files in range; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory)
    files = files.select("path", "length", F.col("modificationTime").alias("modified"))
    var, day = name_parts(F.col("path"), variables, ext)
    return files.select(var.alias("var"), day.alias("date"), "path", "length", "modified").filter(
        (F.col("var") != "") & F.col("date").between(F.lit(start), F.lit(end))
    )


def read_raster_bytes(
    spark: SparkSession, paths: str | list[str], variables: Sequence[str], glob: str = "*.bil"
) -> DataFrame:
    """(var, date, content) of raw grids below folders, or of a list of files."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter=glob).load(paths)
    var, day = name_parts(F.col("path"), variables)
    return files.select(var.alias("var"), day.alias("date"), "content").filter("var <> '' and date is not null")


def read_grid_header(spark: SparkSession, path: str) -> GridSpec:
    """A raw grid's text header (about a dozen ``KEY value`` lines) as a GridSpec."""
    wanted = r"(?i)^\s*(xdim|ydim|ulxmap|ulymap|nrows|ncols|nodata)\s"
    lines = [r.value.split() for r in spark.read.text(path).filter(F.col("value").rlike(wanted)).collect()]
    h = {p[0].lower(): p[1] for p in lines if len(p) >= 2}
    dx, dy = float(h["xdim"]), float(h["ydim"])
    return GridSpec(
        x0=float(h["ulxmap"]) - dx / 2,
        y0=float(h["ulymap"]) + dy / 2,
        dx=dx,
        dy=dy,
        nrows=int(h["nrows"]),
        ncols=int(h["ncols"]),
        nodata=float(h.get("nodata", -9999)),
    )


def grid_headers(spark: SparkSession, directory: str, variables: Sequence[str]) -> DataFrame:
    """(var, date, nrows, ncols) from the text headers beside raw grids, one small file per row."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.hdr").text(directory, wholetext=True)
    var, day = name_parts(F.regexp_replace(F.input_file_name(), r"(?i)\.hdr$", ".bil"), variables)
    named = files.select(var.alias("var"), day.alias("date"), "value")
    size = lambda key: F.try_to_number(F.nullif(F.regexp_extract("value", rf"(?im)^\s*{key}\s+(\d+)", 1), F.lit("")), F.lit("999999999")).cast("int")
    return named.select("var", "date", size("nrows").alias("nrows"), size("ncols").alias("ncols")).filter("var <> '' and date is not null")


def shaped_catalog(
    spark: SparkSession, directory: str, variables: Sequence[str], start: date, end: date, ext: str = "bil"
) -> DataFrame:
    """The catalog of grids with the shape that each one's header names (NULL without a header).

    ``manifest.valid_files`` with ``min_shape`` sets implausible ones aside.
    """
    catalog = raster_catalog(spark, directory, variables, start, end, ext)
    return lookup(catalog, grid_headers(spark, directory, variables), ["var", "date"])


def _float_reader(nodata: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    # an inner function travels to the workers by value, so they need not have this package
    def floats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Little-endian float32 bytes to float lists, a whole Arrow batch at a time; no-data is masked on the way."""
        for batch in batches:
            raw = batch.column("bytes").to_pylist()
            flat = np.frombuffer(b"".join(raw), dtype="<f4")
            offsets = np.concatenate([[0], np.cumsum([len(b) // 4 for b in raw])]).astype("int32")
            missing = np.isnan(flat) | (flat == np.float32(nodata))
            values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=pa.float32(), mask=missing))
            keys = [batch.column(c) for c in ("var", "date", "row")]
            yield pa.RecordBatch.from_arrays([*keys, values], names=["var", "date", "row", "values"])

    return floats


def decode_bil(
    files: DataFrame,
    grid: GridSpec,
    window: tuple[int, int, int, int] | None = None,
) -> DataFrame:
    """Raw grids ``(var, date, content)`` to a scanline table, cropped while still bytes.

    Each file is cut into scanlines of the wanted window by Spark itself, so
    Python sees rows of a few kilobytes and only turns bytes into floats.
    A file shorter than the grid is an error: set such files aside with
    ``valid_files`` first, which names them.  No-data and NaN become NULL.
    """
    first_row, last_row, first_col, n_cols = window or (0, grid.nrows - 1, 0, grid.ncols)
    size = grid.nrows * grid.ncols * 4
    short = F.concat_ws(" ", F.lit("grid cut short:"), "var", F.col("date").cast("string"))
    whole = F.when(F.length("content") >= size, F.col("content")).otherwise(F.raise_error(short))
    rows = files.withColumn("content", whole).withColumn("row", F.explode(F.sequence(F.lit(first_row), F.lit(last_row))))
    start = (F.col("row") * grid.ncols + first_col) * 4 + 1
    lines = rows.select(
        "var",
        "date",
        (F.col("row") - first_row).alias("row"),
        F.substring(F.col("content"), start, F.lit(n_cols * 4)).alias("bytes"),
    )
    return lines.mapInArrow(_float_reader(grid.nodata), "var string, date date, row int, values array<float>")
