"""Weather column expressions: humidity, units, heat index, plausibility, region."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneday import fixed_values as fv


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp(c: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Limit to [lo, hi]; NULL stays NULL, which greatest/least would not keep."""
    c = _col(c)
    out = None
    if lo is not None:
        out = F.when(c < lo, F.lit(float(lo)))
    if hi is not None:
        out = F.when(c > hi, F.lit(float(hi))) if out is None else out.when(c > hi, F.lit(float(hi)))
    return c if out is None else out.otherwise(c)


def nan_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def saturation_pressure(t: Column | str) -> Column:
    t = _col(t)
    scale, slope, offset = fv.MAGNUS
    return scale * F.exp(slope * t / (t + offset))


def relative_humidity(dew: Column | str, mean: Column | str) -> Column:
    return clamp(100 * saturation_pressure(dew) / saturation_pressure(mean), 0, 100)


def vapour_deficit(dew: Column | str, mean: Column | str) -> Column:
    return clamp(saturation_pressure(mean) - saturation_pressure(dew), 0)


def add_humidity(df: DataFrame, dew: str = "tdmean", mean: str = "tmean") -> DataFrame:
    """Relative humidity and vapour deficit from one row's dew point and mean.

    Not linear, so this belongs before any averaging over zones.
    """
    return df.withColumns({"rh_mean": relative_humidity(dew, mean), "vpd_mean": vapour_deficit(dew, mean)})


def c_to_f(c: Column | str) -> Column:
    return _col(c) * 9 / 5 + 32


def f_to_c(c: Column | str) -> Column:
    return (_col(c) - 32) * 5 / 9


def k_to_c(c: Column | str) -> Column:
    return _col(c) - 273.15


def heat_index_f(t: Column, rh: Column) -> Column:
    """Public National Weather Service procedure, degrees Fahrenheit and percent."""
    b = fv.HEAT_INDEX_REGRESSION
    simple = 0.5 * (t + 61.0 + (t - 68.0) * 1.2 + rh * 0.094)
    full = (
        b[0]
        + b[1] * t
        + b[2] * rh
        + b[3] * t * rh
        + b[4] * t * t
        + b[5] * rh * rh
        + b[6] * t * t * rh
        + b[7] * t * rh * rh
        + b[8] * t * t * rh * rh
    )
    # abs() keeps the root real outside the branch that uses it
    dry = ((13 - rh) / 4) * F.sqrt(F.abs(17 - F.abs(t - 95)) / 17)
    humid = ((rh - 85) / 10) * ((87 - t) / 5)
    adjusted = (
        F.when((rh <= 13) & t.between(80, 112), full - dry)
        .when((rh > 85) & t.between(80, 87), full + humid)
        .otherwise(full)
    )
    return (
        F.when(t.isNull() | rh.isNull() | (rh < 0) | (rh > 100), F.lit(None).cast("double"))
        .when(t <= fv.HEAT_INDEX_COLD_F, t)
        .when(simple <= fv.HEAT_INDEX_SIMPLE_MAX_F, simple)
        .otherwise(adjusted)
    )


def heat_index(t_c: Column | str, rh: Column | str, digits: int = 2) -> Column:
    """Heat index in Celsius; NULL where humidity lies outside 0..100."""
    return F.round(f_to_c(heat_index_f(c_to_f(t_c), _col(rh))), digits)


def null_outliers(
    df: DataFrame, ranges: Mapping[str, tuple[float, float]] = fv.PLAUSIBLE_RANGES
) -> DataFrame:
    """Values outside their inclusive range become NULL; absent columns are skipped."""
    return df.withColumns(
        {v: F.when(F.col(v).between(lo, hi), F.col(v)) for v, (lo, hi) in ranges.items() if v in df.columns}
    )


def outlier_flags(columns: Sequence[str], ranges: Mapping[str, tuple[float, float]]) -> dict[str, Column]:
    """One boolean per present variable: value given but outside its range."""
    return {v: ~F.col(v).between(lo, hi) for v, (lo, hi) in ranges.items() if v in columns}


def region_of(lon: Column | str) -> Column:
    """Region by longitude; a NULL longitude falls in the last region, as all non-matches do."""
    lon = _col(lon)
    out = None
    for cut, label in fv.REGION_CUTS:
        out = F.when(lon < cut, label) if out is None else out.when(lon < cut, label)
    return out.otherwise(fv.REGION_ELSE)


def rate_per(n: Column | str, base: Column | str, scale: float = 100_000) -> Column:
    """n / base x scale where base is positive, else NULL."""
    n, base = _col(n), _col(base)
    return F.when(base > 0, n / base * scale)
