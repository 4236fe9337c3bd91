"""Job-planning tables: file validity, inventories, retries, outcomes, gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneday import fixed_values as fv
from zoneday.operators.dense import Bound, _day


def valid_files(
    catalog: DataFrame,
    min_bytes: int = fv.MIN_RASTER_BYTES,
    min_shape: tuple[int, int] | None = None,
) -> DataFrame:
    """Existing is not valid: a size floor and, where decoded, a plausible shape."""
    ok = F.col("length") >= min_bytes
    if min_shape is not None:
        ok = ok & (F.col("nrows") >= min_shape[0]) & (F.col("ncols") >= min_shape[1])
    return catalog.filter(ok)


def inventory(catalog: DataFrame, start: Bound, end: Bound, digits: int = 1, clip: bool = True) -> DataFrame:
    """Days present per variable, days expected, percent.

    Only days in the window count; ``clip=False`` counts the whole archive, as
    the published inventory does, and can so pass 100 percent.
    """
    if clip:
        catalog = catalog.filter(F.col("date").between(_day(start), _day(end)))
    days = catalog.select("var", "date").distinct().groupBy("var").agg(F.count(F.lit(1)).alias("n_days"))
    expected = F.datediff(_day(end), _day(start)) + 1
    return days.select(
        "var",
        "n_days",
        expected.alias("expected"),
        F.round(F.col("n_days") * 100 / expected, digits).alias("pct"),
    )


def period_inventory(done: DataFrame, expected: int, digits: int = 1) -> DataFrame:
    """Finished periods per variable, expected number, percent.  ``done(var, period)``."""
    counts = done.select("var", "period").distinct().groupBy("var").agg(F.count(F.lit(1)).alias("n_periods"))
    pct = F.round(F.col("n_periods") * 100 / expected, digits)
    return counts.select("var", "n_periods", F.lit(expected).alias("expected"), pct.alias("pct"))


def retry_manifest(failures: DataFrame) -> DataFrame:
    return failures.select("var", "date").distinct()


def outcome_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def explain_gaps(low_years: DataFrame, failures: DataFrame) -> DataFrame:
    """Low-coverage years in which the failure log has entries."""
    logged = failures.select(F.year("date").alias("year")).distinct()
    return low_years.select("year").distinct().join(logged, "year", "left_semi")
