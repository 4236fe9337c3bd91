"""Report tables from partial sums per period, so that a new period costs a read of that period alone.

A partial is one row per (year, zone) with the counts, sums and extremes of
every variable.  Partials of different years add up, and the reports come from
the sums.  The stored table remembers the files that each year was read from:
a year whose files are still the same is not opened again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneday.operators.summaries import report_rows
from zoneday.session import materialize
from zoneday.sources import sinks

SIGNS = ("files", "bytes", "modified")


def zone_partials(df: DataFrame, zone: str, variables: Sequence[str], day: str = "date", by: Sequence[str] = ("year",)) -> DataFrame:
    """Per period and zone: rows, first and last day, and per variable the count, sum, smallest and largest value.

    Rows without a zone are a zone of their own; a variable without values
    has count 0 and no sum.  Rows are combined where they are read.
    """
    present = [v for v in variables if v in df.columns]
    return df.groupBy(*by, F.col(zone).alias("zone")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        *[f(v).alias(f"{p}_{v}") for v in present for p, f in (("n", F.count), ("s", F.sum), ("lo", F.min), ("hi", F.max))],
    )


def merge_partials(partials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Partials added up by ``by``; without it one row for all, also for no partial."""
    how = {"rows": F.sum, "first_day": F.min, "last_day": F.max}
    aggs = []
    for c in partials.columns:
        prefix = c.partition("_")[0]
        if c in how:
            aggs.append(how[c](c).alias(c))
        elif prefix in ("n", "s", "lo", "hi") and c not in by:
            aggs.append({"n": F.sum, "s": F.sum, "lo": F.min, "hi": F.max}[prefix](c).alias(c))
    return partials.groupBy(*by).agg(*aggs)


def _variables(partials: DataFrame) -> list[str]:
    return [c[2:] for c in partials.columns if c.startswith("n_")]


def coverage_merged(partials: DataFrame, floor: float) -> DataFrame:
    """``summaries.coverage_by_year`` from partials: year, variable, pct_valid, n, low."""
    by_year = merge_partials(partials, ["year"])
    cells = [
        F.struct(F.lit(v).alias("variable"), (F.col(f"n_{v}") / F.col("rows") * 100).alias("pct_valid"), F.col(f"n_{v}").alias("n"))
        for v in _variables(partials)
    ]
    return by_year.select("year", F.inline(F.array(*cells))).withColumn("low", F.col("pct_valid") < floor)


def report_merged(partials: DataFrame) -> DataFrame:
    """``summaries.panel_report`` from partials."""
    return report_rows(merge_partials(partials, ["zone"]), _variables(partials))


def inventory_merged(partials: DataFrame) -> DataFrame:
    """Per year and variable: values, share of rows, mean, smallest and largest value."""
    by_year = merge_partials(partials, ["year"])
    cells = [
        F.struct(
            F.lit(v).alias("variable"),
            F.col("rows").alias("rows"),
            F.col(f"n_{v}").alias("n"),
            F.try_divide(f"s_{v}", f"n_{v}").alias("mean"),
            F.col(f"lo_{v}").cast("double").alias("lo"),
            F.col(f"hi_{v}").cast("double").alias("hi"),
        )
        for v in _variables(partials)
    ]
    return by_year.select("year", F.inline(F.array(*cells)))


def year_files(spark: SparkSession, panel: str) -> DataFrame:
    """(year, files, bytes, modified) of a panel written by year, from its file listing alone."""
    listing = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup="true", pathGlobFilter="*.parquet")
        .load(panel)
        .select(F.regexp_extract("path", r"/year=(\d+)/", 1).try_cast("int").alias("year"), "length", "modificationTime")
    )
    return listing.groupBy("year").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("modified")
    )


def refresh_partials(spark: SparkSession, panel: str, store: str, zone: str, variables: Sequence[str], day: str = "date") -> list[int]:
    """Bring the partials in ``store`` up to the panel's files; returns the years that were read.

    Years whose files are as they were are not opened; a year that changed
    replaces its partials, by year folder, so a job that broke off is repeated
    by the next call.  Years that left the panel stay in the store until
    ``read_partials`` leaves them out.
    """
    now = materialize(year_files(spark, panel), "year-files")
    known = sinks.read_if_any(spark, store)
    stale = now if known is None else now.join(known.select("year", *SIGNS).distinct(), ["year", *SIGNS], "left_anti")
    # one number per calendar year; as literals they choose the folders that are opened
    years = sorted(r.year for r in stale.select("year").collect())
    if years:
        read = spark.read.parquet(panel).filter(F.col("year").isin(years))
        fresh = zone_partials(read, zone, variables, day).join(F.broadcast(now), "year")  # a row per calendar year
        writer = fresh.repartitionByRange("year", "zone").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("year").parquet(store)
    return years


def read_partials(spark: SparkSession, panel: str, store: str) -> DataFrame:
    """The partials that belong to the panel's files as they are now."""
    now = year_files(spark, panel)
    return spark.read.parquet(store).join(now, ["year", *SIGNS], "left_semi").drop(*SIGNS)
