"""Claims to a dense zone x day rate panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneday.functions.dates import add_calendar
from zoneday.functions.weather import rate_per
from zoneday.operators.dense import bounds, densify
from zoneday.operators.rollup import claims_per_day
from zoneday.session import lookup, materialize


def count_panel(mapped_claims: DataFrame) -> DataFrame:
    """Zero-filled counts for every zone seen, from the first to the last day seen.

    Zones, bounds and counts all come from one written zone x day table, so
    the claims are scanned once.
    """
    daily = materialize(claims_per_day(mapped_claims), "daily-counts")
    first, last = bounds(daily, "bill_date")
    panel = densify(
        daily.withColumnRenamed("bill_date", "date"), daily.select("cz_id"), "cz_id", first, last, fill={"n_claims": 0}
    )
    return add_calendar(panel, "date", ("year", "month", "day")).withColumn("qtr", F.quarter("date"))


def rate_panel(mapped_claims: DataFrame, employment: DataFrame) -> DataFrame:
    """Counts with quarterly employment ``(cz_id, year, qtr, emp_cz)`` and claims per 100,000 workers."""
    panel = lookup(count_panel(mapped_claims), employment, ["cz_id", "year", "qtr"], "left")
    return panel.withColumn("claims_per_100k", rate_per("n_claims", "emp_cz"))
