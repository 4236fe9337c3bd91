"""Writers and the output report."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneday.session import lookup, materialize


def sorted_for_write(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Range-partitioned and sorted inside partitions: ordered files without one global sort."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_panel(df: DataFrame, path: str, zone: str, day: str = "date", mode: str = "overwrite") -> None:
    """Snappy Parquet by year, rows ordered by zone and day.

    Ranges start with the year, so a task writes to one or two year folders
    rather than to all of them.
    """
    if "year" not in df.columns:
        df = df.withColumn("year", F.year(day))
    writer = sorted_for_write(df, ["year", zone, day]).write.mode(mode).option("compression", "snappy")
    # the whole panel is replaced: a year that dropped out must not stay behind
    writer.option("partitionOverwriteMode", "static").partitionBy("year").parquet(path)


def staging_path(path: str) -> str:
    """A fresh folder beside ``path``, on the same storage."""
    return f"{path.rstrip('/')}_staged-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, found = _folder(spark, path)
    fs.delete(found, True)


def replace_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Put a written folder in the place of another by renames; readers never see half of it.

    The old folder goes aside first and comes back if the new one can't be moved.
    """
    fs, fresh = _folder(spark, staged)
    _, target = _folder(spark, path)
    _, aside = _folder(spark, f"{staged}-old")
    held = fs.exists(target)
    if held and not fs.rename(target, aside):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(fresh, target):
        if held:
            fs.rename(aside, target)
        raise OSError(f"could not move {staged} to {path}")
    if held:
        fs.delete(aside, True)


def copy_as_csv(spark: SparkSession, parquet_path: str, csv_path: str, keys: Sequence[str]) -> DataFrame:
    """CSV copy of a written panel in key order; returns the size report of both formats."""
    panel = spark.read.parquet(parquet_path)
    write_csv(panel, csv_path, keys)
    return sink_report(panel, csv_path, parquet_path)


def write_csv(df: DataFrame, path: str, keys: Sequence[str] = (), mode: str = "overwrite") -> None:
    """CSV parts with a header; parts follow each other in key order."""
    out = sorted_for_write(df, keys) if keys else df
    out.write.mode(mode).options(header="true", escape='"').csv(path)


def write_scanlines(grid: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Scanline table by variable and year, ordered by row: row statistics then skip what a window leaves out."""
    keys = ["var", "year", "row", "date"]
    dated = grid.withColumn("year", F.year("date"))
    writer = sorted_for_write(dated, keys).write.mode(mode).option("partitionOverwriteMode", "static")
    writer.partitionBy("var", "year").parquet(path)


def _paths(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup="true", pathGlobFilter=glob)
        .load(path)
        .select("path", "length")
    )


def read_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def ledger_path(path: str) -> str:
    """Beside the extracts: one row per written day with the size and time of the grid it came from."""
    return path.rstrip("/") + "_days"


def written_days(spark: SparkSession, path: str) -> DataFrame | None:
    """(var, date, length, modified) of the days that have been written, none on a first run.

    The ledger is small and says which version of a grid was read.  Extracts
    without one say which days they hold, of unknown versions.
    """
    ledger = read_if_any(spark, ledger_path(path))
    if ledger is not None:
        latest = F.max_by(F.struct("length", "modified"), "written_at").alias("_s")
        return ledger.groupBy("var", "date").agg(latest).select("var", "date", "_s.length", "_s.modified")
    done = read_if_any(spark, path)
    if done is None:
        return None
    unknown = [F.lit(None).cast("bigint").alias("length"), F.lit(None).cast("timestamp").alias("modified")]
    return done.select("var", "date").distinct().select("var", "date", *unknown)


def pending_extracts(df: DataFrame, path: str) -> DataFrame:
    """Rows whose (var, date) is not written yet, or was written from another version of its grid.

    A period that is still open, or whose damaged grid was repaired, so gets
    its missing days, and a provisional day that was issued again is due again
    where ``df`` has the grids' ``length`` and ``modified``.  Apply it to the
    job table before extracting, and read only these days' grids.
    """
    done = written_days(df.sparkSession, path)
    if done is None:
        return df
    signs = [c for c in ("length", "modified") if c in df.columns]
    if len(signs) < 2:
        return lookup(df, done.select("var", "date"), ["var", "date"], "left_anti")
    known = done.select("var", "date", F.struct("length", "modified").alias("_was"))
    met = lookup(df, known, ["var", "date"])
    same = F.col("_was.modified").isNull() | (F.struct("length", "modified") == F.col("_was"))
    return met.filter(F.col("_was").isNull() | ~same).drop("_was")


def write_extracts(df: DataFrame, path: str, keys: Sequence[str], grids: DataFrame | None = None) -> None:
    """Add the pending days below their (var, period); a repeated run changes nothing.

    Without ``grids`` days that are written stay as they are.  With ``grids``
    (var, date, length, modified), the files that ``df`` was made from, its
    days replace those written before: the (var, period) they touch are
    written anew with their other days, no other period is opened, and the
    ledger is told last.  A write is committed as a whole, so a job that broke
    off leaves no days behind and the next run does them again.  Ranges over
    period and keys spread one large period over many tasks.
    """
    order = ["var", "period", *keys]
    if grids is None:
        sorted_for_write(pending_extracts(df, path), order).write.mode("append").partitionBy("var", "period").parquet(path)
        return
    spark = df.sparkSession
    fresh = materialize(df, "fresh-days")
    old = read_if_any(spark, path)
    if old is not None:
        touched = materialize(fresh.select("var", "period").distinct(), "touched-periods")
        # period folders would otherwise be read as numbers
        old = spark.read.schema(fresh.schema).parquet(path)
        kept = lookup(lookup(old, touched, ["var", "period"], "left_semi"), grids.select("var", "date").distinct(), ["var", "date"], "left_anti")
        fresh = materialize(fresh.unionByName(kept.select(fresh.columns)), "revised-periods")
    writer = sorted_for_write(fresh, order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("var", "period").parquet(path)
    signed = grids.select("var", "date", F.col("length").cast("bigint").alias("length"), F.col("modified").cast("timestamp").alias("modified"))
    signed.withColumn("written_at", F.current_timestamp()).write.mode("append").parquet(ledger_path(path))


def append_failures(failures: DataFrame, path: str) -> None:
    failures.select("var", "date", "http_code", "message").write.mode("append").options(header="true", escape='"').csv(path)


def sink_report(df: DataFrame, csv_path: str, parquet_path: str) -> DataFrame:
    """Rows, columns, bytes per format and percent saved, from file listings."""
    spark = df.sparkSession
    size = lambda path, glob: _paths(spark, path, glob).agg(F.sum("length").alias("b")).scalar()
    one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        size(csv_path, "*.csv").alias("csv_bytes"),
        size(parquet_path, "*.parquet").alias("parquet_bytes"),
    )
    return one.withColumn(
        "pct_smaller", F.round((1 - F.try_divide(F.col("parquet_bytes"), F.col("csv_bytes"))) * 100, 0)
    )
