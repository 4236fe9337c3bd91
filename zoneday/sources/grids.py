"""Raw float grids as a Spark data source: only the wanted files, rows and columns are read.

The source plans tasks over (file, block of rows).  Variables, first and last
day and a window of rows and columns are arguments and decide at planning
which files are opened and which bytes of them are read.  They are no Spark
filters: Spark 4.1 keeps the first plan's filtered tasks of a Python source
for every later query of the same DataFrame, which then lacks rows.  A grid's
own text header names its shape, which is checked before a byte of it is used.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from zoneday.fixed_values import GRID_NODATA
from zoneday.operators.stacks import STACK, STRIP
from zoneday.sources.rasters import RASTER_NAME

LINES = "var string, date date, row int, values array<float>"
BLOCK_BYTES = 16 << 20  # of one task
GAP_BYTES = 64 << 10  # ranges closer than this are read as one


@dataclass(frozen=True)
class Header:
    nrows: int
    ncols: int
    nodata: float


def parse_header(text: str) -> Header:
    """Shape and no-data value of a raw grid's text header (``KEY value`` lines)."""
    found = {p[0].lower(): p[1] for line in text.splitlines() if len(p := line.split()) >= 2}
    if int(found.get("nbits", 32)) != 32 or int(found.get("nbands", 1)) != 1 or found.get("byteorder", "I").upper() not in ("I", "LSBFIRST"):
        raise ValueError("only single-band, little-endian 32-bit grids are read")
    return Header(int(found["nrows"]), int(found["ncols"]), float(found.get("nodata", GRID_NODATA)))


class Block(InputPartition):
    """Rows ``first`` to ``last`` of the window, of some grids (date, path) of one variable."""

    def __init__(self, var: str, grids: list[tuple[date, str]], first: int, last: int):
        super().__init__((var, grids, first, last))


class GridReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.layout = options.get("layout", "lines")
        if self.layout not in ("lines", "stacks"):
            raise ValueError(f"layout {self.layout!r}: lines or stacks")
        self.path, self.files = options.get("path"), options.get("files")
        self.variables = options["variables"].split(",")
        self.window = tuple(int(v) for v in options["window"].split(",")) if options.get("window") else None
        self.gap = int(options.get("gap_bytes", GAP_BYTES))
        self.block = int(options.get("block_bytes", BLOCK_BYTES))
        self.width = int(options.get("strip", STRIP))
        # the shape of grids without a header file: rows, columns, no-data value
        self.shape = options["shape"].split(",") if options.get("shape") else None
        self.start, self.end = (date.fromisoformat(options.get(k, v)) for k, v in (("start", "0001-01-01"), ("end", "9999-12-31")))
        self.bytes_read = 0

    # ---- planning ----

    def _listed(self) -> Iterator[tuple[str, int]]:
        """Paths and sizes: of a folder, or of a table of files."""
        from pyarrow import dataset, fs

        if self.files:
            store, path = fs.FileSystem.from_uri(self.files) if "://" in self.files or self.files.startswith("file:") else (fs.LocalFileSystem(), self.files)
            table = dataset.dataset(path, filesystem=store, format="parquet").to_table(columns=["path", "length"])
            yield from zip(table["path"].to_pylist(), table["length"].to_pylist(), strict=True)
            return
        store, path = _filesystem(self.path)
        for info in store.get_file_info(fs.FileSelector(path, recursive=True)):
            if info.is_file and info.path.endswith(".bil"):
                yield (info.path if isinstance(store, fs.LocalFileSystem) else f"{store.type_name}://{info.path}"), info.size

    def grids(self) -> list[tuple[str, date, str, int]]:
        """(var, date, path, length) of the wanted files, in order."""
        pattern = re.compile(RASTER_NAME.format(vars="|".join(map(re.escape, self.variables)), ext="bil"))
        found = []
        for path, length in self._listed():
            m = pattern.search(path)
            if not m:
                continue
            try:
                day = date(int(m[2][:4]), int(m[2][4:6]), int(m[2][6:]))
            except ValueError:
                continue
            if self.start <= day <= self.end:
                found.append((m[1].lower(), day, path, length))
        return sorted(found)

    def partitions(self) -> list[Block]:
        grids = self.grids()
        if not grids:
            return [Block("", [], 0, -1)]
        first = self._header(grids[0][2])
        top, bottom, _, n_cols = self.window or (0, first.nrows - 1, 0, first.ncols)
        rows = bottom - top + 1
        together: dict[tuple, list[tuple[date, str]]] = {}
        many = max(1, self.block // max(1, n_cols * 4 * rows))  # small grids share a task
        for k, (var, day, path, _) in enumerate(grids):
            key = (var, day.replace(day=1)) if self.layout == "stacks" else (var, k // many)
            together.setdefault(key, []).append((day, path))
        out = []
        for key, members in together.items():
            height = max(1, self.block // (n_cols * 4 * len(members)))
            out += [Block(key[0], members, a, min(a + height, rows) - 1) for a in range(0, rows, height)]
        return out

    # ---- reading ----

    def _header(self, path: str) -> Header:
        store, at = _filesystem(re.sub(r"\.bil$", ".hdr", path, flags=re.I))
        try:
            with store.open_input_stream(at) as f:
                return parse_header(f.read().decode("ascii", "replace"))
        except FileNotFoundError:
            if not self.shape:
                raise
            return Header(int(self.shape[0]), int(self.shape[1]), float(self.shape[2]))

    def _rows(self, path: str, first: int, last: int) -> np.ndarray:
        """Window rows ``first`` to ``last`` of one grid; NaN where there is no data."""
        head = self._header(path)
        top, bottom, left, n_cols = self.window or (0, head.nrows - 1, 0, head.ncols)
        if bottom >= head.nrows or left + n_cols > head.ncols:
            raise ValueError(f"grid of {head.nrows} x {head.ncols} is smaller than the window: {path}")
        store, at = _filesystem(path)
        line, wide = head.ncols * 4, n_cols * 4
        with store.open_input_file(at) as f:
            if f.size() != head.nrows * line:
                raise ValueError(f"grid cut short or not of its header's shape: {path}")
            start = (top + first) * line + left * 4
            if line - wide <= self.gap:
                span = (last - first) * line + wide
                raw = f.read_at(span, start) + bytes(line - wide)
                self.bytes_read += span
                values = np.frombuffer(raw, dtype="<f4").reshape(last - first + 1, head.ncols)[:, :n_cols]
            else:
                parts = [f.read_at(wide, start + k * line) for k in range(last - first + 1)]
                self.bytes_read += wide * len(parts)
                values = np.frombuffer(b"".join(parts), dtype="<f4").reshape(last - first + 1, n_cols)
        return np.where(values == np.float32(head.nodata), np.float32("nan"), values)

    def read(self, block: Block) -> Iterator[pa.RecordBatch]:
        var, grids, first, last = block.value
        rows = pa.array(np.arange(first, last + 1, dtype=np.int32))
        n = len(rows)
        if self.layout == "lines":
            for day, path in grids:
                values = self._rows(path, first, last)
                flat = pa.array(values.ravel(), mask=np.isnan(values).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * values.shape[1]), flat)
                yield pa.RecordBatch.from_arrays([pa.array([var] * n), pa.array([day] * n, pa.date32()), rows, lists], names=["var", "date", "row", "values"])
            return
        if not grids:
            return
        days = [day for day, _ in grids]
        cube = np.stack([self._rows(path, first, last) for _, path in grids])
        for a in range(0, cube.shape[2], self.width):
            part = np.ascontiguousarray(cube[:, :, a : a + self.width].transpose(1, 0, 2)).astype("<f4")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([var] * n),
                    pa.array([days[0].replace(day=1)] * n, pa.date32()),
                    rows,
                    pa.array(np.full(n, a // self.width, dtype=np.int32)),
                    pa.array([days] * n, pa.list_(pa.date32())),
                    pa.array([line.tobytes() for line in part], pa.binary()),
                ],
                names=["var", "month", "row", "strip", "dates", "cells"],
            )


def _filesystem(path: str):
    from pyarrow import fs

    if re.match(r"^[a-z0-9]+:", path):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class GridSource(DataSource):
    """``spark.read.format("float_grids")``; options path or files, variables, layout, start, end, window."""

    @classmethod
    def name(cls) -> str:
        return "float_grids"

    def schema(self) -> str:
        return STACK if self.options.get("layout") == "stacks" else LINES

    def reader(self, schema) -> GridReader:
        return GridReader(dict(self.options))


def _read(
    spark: SparkSession,
    layout: str,
    path: str | None,
    variables: Sequence[str],
    window: tuple[int, int, int, int] | None,
    start: date | None,
    end: date | None,
    files: str | None,
    options: dict,
) -> DataFrame:
    # workers get this module by value, so they need not have this package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(GridSource)
    given = {"start": start, "end": end, "window": ",".join(str(int(v)) for v in window) if window else None, "files": files, "path": path}
    given = {k: str(v) for k, v in given.items() if v is not None}
    return spark.read.format(GridSource.name()).options(layout=layout, variables=",".join(variables), **given, **options).load()


def read_lines(
    spark: SparkSession,
    path: str | None,
    variables: Sequence[str],
    window: tuple[int, int, int, int] | None = None,
    start: date | None = None,
    end: date | None = None,
    files: str | None = None,
    **options: str,
) -> DataFrame:
    """(var, date, row, values) of the grids below ``path``, or of the Parquet table ``files`` (path, length).

    ``window`` is (first row, last row, first column, number of columns); rows
    and columns count from its corner.  No-data and NaN become NULL.  A grid
    that is cut short, or smaller than the window, is an error that names it.
    """
    return _read(spark, "lines", path, variables, window, start, end, files, options)


def read_stacks(
    spark: SparkSession,
    path: str | None,
    variables: Sequence[str],
    window: tuple[int, int, int, int] | None = None,
    start: date | None = None,
    end: date | None = None,
    files: str | None = None,
    **options: str,
) -> DataFrame:
    """The same grids as month stacks, read as such: no shuffle brings the days together."""
    return _read(spark, "stacks", path, variables, window, start, end, files, options)
