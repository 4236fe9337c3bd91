"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneday.session import lookup


def bands_to_long(df: DataFrame, ids: Sequence[str], prefix: str, value: str = "value") -> DataFrame:
    """One column per day to one row per day, the date taken from the column name."""
    bands = [c for c in df.columns if c.startswith(prefix)]
    # column names hold dots (mean.2020-01-01), hence the back quotes
    return df.unpivot([F.col(i) for i in ids], [F.col(f"`{b}`") for b in bands], "_band", value).select(
        *ids, F.to_date(F.substring("_band", len(prefix) + 1, 10)).alias("date"), value
    )


def band_array_to_long(
    df: DataFrame, ids: Sequence[str], bands: DataFrame, values: str = "values", value: str = "value"
) -> DataFrame:
    """Array of band values to one row per date through a (band, date) table.

    Bands count from 1.  A row whose array length differs from the number of
    bands stops the job.
    """
    n = bands.agg(F.count(F.lit(1)).alias("n")).scalar()
    checked = F.when(F.size(values) == n, F.col(values)).otherwise(
        F.raise_error(F.lit("array length differs from the number of bands"))
    )
    long = df.select(*ids, F.posexplode(checked).alias("_pos", value)).withColumn("band", F.col("_pos") + 1)
    return lookup(long, bands.select("band", "date"), "band", "inner").select(*ids, "date", value)


def metrics_to_long(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    present = [m for m in metrics if m in df.columns]
    return df.unpivot(list(ids), present, "variable", "value")


def split_var_stat(df: DataFrame, name: str = "name", value: str = "value", stats: Sequence[str] = ()) -> DataFrame:
    """``tmax_mean`` style names split at the last underscore, statistics as columns."""
    parts = df.select(
        F.regexp_extract(name, r"^(.*)_([^_]+)$", 1).alias("variable"),
        F.regexp_extract(name, r"^(.*)_([^_]+)$", 2).alias("_stat"),
        F.col(value).alias("_v"),
    )
    return parts.groupBy("variable").agg(*[F.max(F.when(F.col("_stat") == s, F.col("_v"))).alias(s) for s in stats])
