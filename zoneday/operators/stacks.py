"""Month stacks: all days of one month over one strip of a scanline, and zonal means of them.

A stack row is ``(var, month, row, strip, dates, cells)``; ``cells`` holds the
strip's values as little-endian float32, day by day, NaN where missing.  A
layer's coverage is kept beside it as one sparse matrix per (row, strip):
zones, how many runs each has, and the runs.  The two meet
by an equality join, and one matrix step handles all days of a month at once,
so that a zone's shape is looked up once a month rather than once a day.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneday.session import lookup, materialize

STRIP = 512  # columns of a strip; a month of it is about 64 kilobytes
STACK = "var string, month date, row int, strip int, dates array<date>, cells binary"
FLUSH = 1 << 20  # partial sums that a task holds


def _packer() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    # an inner function travels to the workers by value, so they need not have this package
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lists of equally long value lists to raw float32 blocks."""
        for batch in batches:
            held = batch.column("values")
            cells = []
            for days in held:
                sizes = days.values.value_lengths().to_numpy(zero_copy_only=False)
                if (sizes != sizes[0]).any():
                    raise ValueError("scanlines of one grid differ in length")
                flat = days.values.flatten().cast(pa.float32())
                cells.append(flat.to_numpy(zero_copy_only=False).astype("<f4").tobytes())
            keys = [batch.column(c) for c in ("var", "month", "row", "strip", "dates")]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(cells, pa.binary())], names=["var", "month", "row", "strip", "dates", "cells"])

    return pack


def stack_lines(grid: DataFrame, width: int = STRIP) -> DataFrame:
    """Scanline rows ``(var, date, row, values)`` as month stacks.

    A group holds one strip of at most a month's days.  Grids still in files
    need no such shuffle: ``sources.grids.read_stacks`` reads them as stacks.
    """
    lines = grid.filter(F.col("values").isNotNull() & (F.size("values") > 0))
    strips = F.sequence(F.lit(0), F.floor((F.size("values") - 1) / width).cast("int"))
    cut = lines.select("var", F.to_date("date").alias("date"), F.col("row").cast("int").alias("row"), "values", F.explode(strips).alias("strip"))
    cut = cut.withColumn("values", F.slice("values", F.col("strip") * width + 1, F.lit(width)))
    days = F.array_sort(F.collect_list(F.struct("date", "values")))
    held = cut.groupBy("var", F.trunc("date", "month").alias("month"), "row", "strip").agg(days.alias("_d"))
    held = held.select("var", "month", "row", "strip", F.col("_d.date").alias("dates"), F.col("_d.values").alias("values"))
    return held.mapInArrow(_packer(), STACK)


def weight_tiles(runs: DataFrame, zone: str = "zone_id", width: int = STRIP) -> DataFrame:
    """Coverage runs ``(zone, row, col, n, cov)`` as one sparse matrix per (row, strip).

    ``zones`` are the zones that touch the strip, ``sizes`` how many runs each
    has; the runs follow in that order.  Columns count from the strip's first.
    Keep the result with the layer.
    """
    first, last = (F.floor(c / width).cast("int") for c in (F.col("col"), F.col("col") + F.col("n") - 1))
    cut = runs.filter("n > 0 and cov <> 0").withColumn("strip", F.explode(F.sequence(first, last)))
    left = F.col("strip") * width
    start = F.greatest(F.col("col"), left) - left
    end = F.least(F.col("col") + F.col("n"), left + width) - left
    part = F.struct(start.cast("int").alias("col"), (end - start).cast("int").alias("n"), F.col("cov").cast("double").alias("cov"))
    by_zone = cut.groupBy(F.col("row").cast("int").alias("row"), "strip", zone).agg(F.array_sort(F.collect_list(part)).alias("_r"))
    tiles = by_zone.groupBy("row", "strip").agg(F.array_sort(F.collect_list(F.struct(zone, "_r"))).alias("_z"))
    flat = tiles.select("row", "strip", F.col(f"_z.{zone}").alias("zones"), F.transform("_z", lambda z: F.size(z["_r"])).alias("sizes"), F.flatten("_z._r").alias("_f"))
    return flat.select("row", "strip", "zones", "sizes", F.col("_f.col").alias("cols"), F.col("_f.n").alias("ns"), F.col("_f.cov").alias("covs"))


def _multiply(kind: pa.DataType, flush: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    # an inner function travels to the workers by value, so they need not have this package
    def out(key: tuple, held: dict) -> pa.RecordBatch:
        var, _, dates = key
        zones, days = list(held["zones"]), len(dates)
        sums, weights = (held[k][: len(zones)].ravel() for k in ("sums", "weights"))
        zone = pa.array(zones, kind).take(pa.array(np.repeat(np.arange(len(zones)), days)))
        date = pa.array(dates, pa.date32()).take(pa.array(np.tile(np.arange(days), len(zones))))
        return pa.RecordBatch.from_arrays([zone, pa.array([var] * len(zone), pa.string()), date, pa.array(sums), pa.array(weights)], names=["zone", "var", "date", "s", "w"])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Days x columns times columns x zones, added up over the task's rows."""
        total: dict[tuple, dict] = {}
        size = 0
        for batch in batches:
            c = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            arrays = {k: (c[k].flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(c[k].value_lengths().to_numpy(zero_copy_only=False))]) for k in ("sizes", "cols", "ns", "covs")}
            part = lambda k, i: arrays[k][0][arrays[k][1][i] : arrays[k][1][i + 1]]  # noqa: B023, E731
            for i in range(batch.num_rows):
                dates = tuple(c["dates"][i].as_py())
                dense = np.frombuffer(c["cells"][i].as_buffer(), dtype="<f4").reshape(len(dates), -1)
                width = dense.shape[1]
                cov, sizes = part("covs", i), part("sizes", i)
                begin = np.cumsum(sizes) - sizes
                col = np.minimum(part("cols", i), width)
                end = np.minimum(part("cols", i) + part("ns", i), width)
                given = ~np.isnan(dense)
                every = given.all()
                run = np.zeros((len(dates), width + 1))
                np.cumsum(dense if every else np.where(given, dense, 0), axis=1, out=run[:, 1:])
                s = np.add.reduceat((run[:, end] - run[:, col]) * cov, begin, axis=1)
                if every:
                    w = np.broadcast_to(np.add.reduceat((end - col) * cov, begin), s.shape)
                else:
                    np.cumsum(given, axis=1, out=run[:, 1:])
                    w = np.add.reduceat((run[:, end] - run[:, col]) * cov, begin, axis=1)
                key = (c["var"][i].as_py(), c["month"][i].as_py(), dates)
                held = total.setdefault(key, {"zones": {}, "sums": np.zeros((64, len(dates))), "weights": np.zeros((64, len(dates)))})
                index = held["zones"]
                at = np.array([index.setdefault(z, len(index)) for z in c["zones"][i].as_py()])
                while len(index) > len(held["sums"]):
                    for k in ("sums", "weights"):
                        held[k] = np.concatenate([held[k], np.zeros_like(held[k])])
                    size += held["sums"].size // 2
                # a zone is listed once in a tile, so plain indexed addition is right
                held["sums"][at] += s.T
                held["weights"][at] += w.T
            if size > flush:
                yield from (out(k, h) for k, h in total.items())
                total, size = {}, 0
        yield from (out(k, h) for k, h in total.items())

    return multiply


def zonal_mean_stacked(stacks: DataFrame, tiles: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Coverage-weighted mean of each zone and day: (zone, var, date, value).

    Equal to ``raster.zonal_mean`` of the same grids.  ``tiles`` come from
    ``weight_tiles``; written ones are broadcast where their bytes allow that.
    Stacks and tiles kept by ``write_store`` are joined where they lie.
    """
    kind = pa.string()
    spark_kind = tiles.schema["zones"].dataType.elementType.simpleString()
    if spark_kind != "string":
        kind = {"int": pa.int32(), "bigint": pa.int64()}[spark_kind]
    met = lookup(stacks, tiles, ["row", "strip"], "inner").select("var", "month", "dates", "cells", "zones", "sizes", "cols", "ns", "covs")
    parts = met.mapInArrow(_multiply(kind, FLUSH), f"zone {spark_kind}, var string, date date, s double, w double")
    mean = F.try_divide(F.sum("s"), F.sum("w"))
    return parts.groupBy(F.col("zone").alias(zone), "var", "date").agg(mean.alias("value"))


def write_store(spark: SparkSession, df: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """Stacks or tiles as a table bucketed and sorted by (row, strip), in shared files at ``path``.

    Two stores with the same number of buckets meet without an exchange:
    neither side is dealt out again, whatever its size.
    """
    ordered = df.repartition(buckets, "row", "strip")
    ordered.write.mode("overwrite").bucketBy(buckets, "row", "strip").sortBy("row", "strip").option("path", path).saveAsTable(name)
    return spark.table(name)


def layer_tiles(runs: DataFrame, zone: str = "zone_id", width: int = STRIP) -> DataFrame:
    """Tiles written to the session's shared folder, so that their bytes decide how they are joined."""
    return materialize(weight_tiles(runs, zone, width), "tiles")
