"""Aggregations over the panel: counts, employment, weighted means, merges."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneday import fixed_values as fv
from zoneday.functions.clean import quarter_average
from zoneday.operators.keys import distinct_pairs
from zoneday.session import lookup


def claims_per_day(mapped: DataFrame) -> DataFrame:
    """Claims per zone and day; unmapped or undated claims do not count."""
    return (
        mapped.filter(F.col("cz_id").isNotNull() & F.col("bill_date").isNotNull())
        .groupBy("cz_id", "bill_date")
        .agg(F.count(F.lit(1)).alias("n_claims"))
    )


def employment_by_zone(
    employment: DataFrame,
    geo: DataFrame,
    county_source: str = "zip_winners",
    crosswalk: DataFrame | None = None,
    months: Sequence[str] = fv.MONTH_COLUMNS,
) -> DataFrame:
    """Quarterly employment per zone; a missing quarter adds nothing.

    ``zip_winners`` takes the county list from the ZIP table, so a county that
    wins no ZIP contributes no employment; ``crosswalk`` takes every county.
    """
    source = geo if county_source == "zip_winners" else crosswalk
    if source is None:
        raise ValueError("county_source='crosswalk' needs the crosswalk table")
    counties = distinct_pairs(source, ["fips", "cz_id"]).filter(F.col("cz_id").isNotNull())
    average = employment.select("fips", "year", "qtr", quarter_average("qtr", months).alias("avg_emp"))
    return (
        lookup(average, counties, "fips", "inner")
        .groupBy("cz_id", "year", "qtr")
        .agg(F.coalesce(F.sum("avg_emp"), F.lit(0.0)).alias("emp_cz"))
    )


def weighted_mean(value: Column | str, weight: Column | str) -> Column:
    """Mean over the members that have a value, weights renormalised; all missing gives NULL."""
    v = F.col(value) if isinstance(value, str) else value
    w = F.col(weight) if isinstance(weight, str) else weight
    return F.try_divide(F.sum(v * w), F.sum(F.when(v.isNotNull(), w)))


def weighted_rollup(
    df: DataFrame,
    group: Sequence[str],
    variables: Sequence[str],
    weight: str = "area_km2",
    members: str | None = "n_counties",
) -> DataFrame:
    """Weighted means per group in one aggregation; the member count includes missing values."""
    aggs = [weighted_mean(v, weight).alias(v) for v in variables if v in df.columns]
    if members:
        aggs.insert(0, F.count(F.lit(1)).alias(members))
    return df.groupBy(*group).agg(*aggs)


def merge_variables(
    long: DataFrame, keys: Sequence[str], variables: Sequence[str], var: str = "var", value: str = "value"
) -> DataFrame:
    """Long to wide in one shuffle: a full outer merge of all variables.

    Keys must be unique per variable: a second row of one key and variable is
    an error, found in the same aggregation.  ``duplicate_keys`` lists them.
    """

    def only(v: str) -> Column:
        mine = F.col(var) == v
        names = F.concat_ws(" ", F.lit(f"several rows of {v} for"), *(F.col(k).cast("string") for k in keys))
        return F.when(F.count_if(mine) > 1, F.raise_error(names)).otherwise(F.max(F.when(mine, F.col(value)))).alias(v)

    return long.filter(F.col(var).isin(list(variables))).groupBy(*keys).agg(*map(only, variables))


def duplicate_keys(long: DataFrame, keys: Sequence[str], var: str = "var") -> DataFrame:
    """Keys and variables held by several rows, with their number."""
    return long.groupBy(*keys, var).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def wide_stats(
    df: DataFrame,
    columns: Sequence[str],
    stats: Mapping[str, Callable[[Column], Column]],
    group: Sequence[str] = (),
    name: str = "variable",
) -> DataFrame:
    """Several statistics of several columns, one row per column.

    Aggregates wide in a single pass and turns the small result, instead of
    unpivoting the input and multiplying its rows.
    """
    aggs = [f(F.col(c)).alias(f"{c}__{s}") for c in columns for s, f in stats.items()]
    wide = df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(F.lit(c).alias(name), *[F.col(f"{c}__{s}").alias(s) for s in stats])
            for c in columns
        ]
    )
    return wide.select(*group, F.inline(rows))
