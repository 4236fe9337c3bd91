"""Quality gates.

Every gate returns rows ``(check, passed, observed, expected, severity)``.  All
value rules of one panel are evaluated in a single aggregation over it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneday import fixed_values as fv
from zoneday.functions.weather import outlier_flags
from zoneday.operators.rollup import weighted_mean, weighted_rollup
from zoneday.session import materialize


class GateFailed(RuntimeError):
    """At least one hard check did not hold."""


def _result(
    name: str | Column, passed: Column, observed: Column, expected: Column | str, severity: str = "error"
) -> Column:
    text = lambda c: F.lit(c) if isinstance(c, str) else c.cast("string")
    return F.struct(
        text(name).alias("check"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        observed.cast("double").alias("observed"),
        text(expected).alias("expected"),
        F.lit(severity).alias("severity"),
    )


def _rows(one: DataFrame, results: Sequence[Column]) -> DataFrame:
    return one.select(F.inline(F.array(*results)))


def _equals(name: str, observed: str, expected: Column | int) -> Column:
    want = expected if isinstance(expected, Column) else F.lit(expected)
    return _result(name, F.col(observed) == want, F.col(observed), want)


# ---- shape ---------------------------------------------------------------


def shape_stats(df: DataFrame, zone: str, day: str = "date", group: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct zones, distinct days, first and last day, keys held by several rows."""
    keyed = df.groupBy(*group, zone, day).agg(F.count(F.lit(1)).alias("_n"))
    none = F.lit(0).cast("bigint")
    zones = keyed.groupBy(*group, zone).agg(F.sum("_n").alias("_rows"), F.count_if(F.col("_n") > 1).alias("_twice"))
    days = keyed.select(*group, day).distinct()
    # one row per zone and one per day; distinct counts in one aggregate would write out all keys three times
    both = zones.select(
        *group, F.col(zone).isNotNull().cast("bigint").alias("_z"), none.alias("_d"), "_rows", "_twice", F.lit(None).cast(df.schema[day].dataType).alias("_day")
    ).unionByName(
        days.select(*group, none.alias("_z"), F.col(day).isNotNull().cast("bigint").alias("_d"), none.alias("_rows"), none.alias("_twice"), F.col(day).alias("_day"))
    )
    aggs = [
        F.sum("_rows").alias("n_rows"),
        F.coalesce(F.sum("_z"), none).alias("n_zones"),
        F.coalesce(F.sum("_d"), none).alias("n_days"),
        F.min("_day").alias("first_day"),
        F.max("_day").alias("last_day"),
        F.coalesce(F.sum("_twice"), none).alias("n_duplicate_keys"),
    ]
    return both.groupBy(*group).agg(*aggs) if group else both.agg(*aggs)


def check_shape(df: DataFrame, zone: str, n_zones: int, n_days: int, label: str, day: str = "date") -> DataFrame:
    return shape_results(shape_stats(df, zone, day), n_zones, n_days, label)


def shape_results(one: DataFrame, n_zones: int, n_days: int, label: str) -> DataFrame:
    """The shape gate over one row of counts."""
    return _rows(
        one,
        [
            _equals(f"{label}: zones", "n_zones", n_zones),
            _equals(f"{label}: days", "n_days", n_days),
            _equals(f"{label}: rows = zones x days", "n_rows", n_zones * n_days),
            _equals(f"{label}: no duplicate key", "n_duplicate_keys", 0),
        ],
    )


def check_era_shape(
    df: DataFrame, eras: DataFrame, zones: DataFrame, zone: str = "zone_id", day: str = "date"
) -> DataFrame:
    """Per era: date range, day count, zone count of the metadata, rows, duplicates."""
    want = (
        zones.select("era", zone).distinct().groupBy("era").agg(F.count(F.lit(1)).alias("_zones"))
    )
    days = F.datediff("end_date", "start_date") + 1
    # eras are a handful; an era without rows must still show up and fail
    one = (
        eras.select("era", "start_date", "end_date", days.alias("_days"))
        .join(want, "era", "left")
        .join(shape_stats(df, zone, day, ["era"]), "era", "left")
    )
    return era_results(one)


def era_results(one: DataFrame) -> DataFrame:
    """The era gate over one row of counts per era, with the wanted numbers in ``_days`` and ``_zones``."""
    named = lambda what: F.concat(F.col("era"), F.lit(f": {what}"))
    col = F.col
    span = (col("first_day") == col("start_date")) & (col("last_day") == col("end_date"))
    return _rows(
        one,
        [
            _result(
                named("date range"),
                span,
                F.datediff("last_day", "first_day"),
                F.concat_ws("..", col("start_date").cast("string"), col("end_date").cast("string")),
            ),
            _result(named("days"), col("n_days") == col("_days"), col("n_days"), col("_days")),
            _result(named("zones match metadata"), col("n_zones") == col("_zones"), col("n_zones"), col("_zones")),
            _result(
                named("rows = zones x days"),
                col("n_rows") == col("_zones") * col("_days"),
                col("n_rows"),
                col("_zones") * col("_days"),
            ),
            _result(named("no duplicate key"), col("n_duplicate_keys") == 0, col("n_duplicate_keys"), "0"),
        ],
    )


def check_vintage(df: DataFrame, eras: DataFrame, day: str = "date") -> DataFrame:
    """No row outside its era's dates, none of an unknown era: one result row per era named anywhere.

    An era without rows fails too.
    """
    spans = eras.select("era", "start_date", "end_date")
    held = df.groupBy("era", day).agg(F.count(F.lit(1)).alias("_n"))
    known = spans.select(F.col("era").alias("_era"), F.col("start_date").alias("_from"), F.col("end_date").alias("_to"), F.lit(True).alias("_known"))
    outside = ~F.coalesce(F.col(day).between(F.col("_from"), F.col("_to")), F.lit(False))
    bad = (
        held.join(known, F.col("era") == F.col("_era"), "full")
        .groupBy(F.coalesce("_era", "era", F.lit("no era")).alias("era"))
        .agg(
            # an era without rows has no sum, and does not pass
            F.sum(F.when(outside | F.col("_known").isNull(), F.col("_n")).otherwise(0)).alias("n_outside")
        )
    )
    return _rows(
        bad,
        [
            _result(
                F.concat(F.col("era"), F.lit(": no row outside its dates")),
                F.col("n_outside") == 0,
                F.col("n_outside"),
                "0",
            )
        ],
    )


# ---- values --------------------------------------------------------------

Rule = tuple[Column, float]  # violation (NULL where not testable), allowed share; 0 means none


def order_rule(columns: Sequence[str] = ("tmin", "tmean", "tmax"), max_share: float = fv.MAX_VIOLATION_SHARE) -> dict[str, Rule]:
    """Columns ascending on rows where all have values."""
    pairs = list(zip(columns, columns[1:]))
    bad = F.col(pairs[0][0]) > F.col(pairs[0][1])
    for a, b in pairs[1:]:
        bad = bad | (F.col(a) > F.col(b))
    complete = F.col(columns[0]).isNotNull()
    for c in columns[1:]:
        complete = complete & F.col(c).isNotNull()
    return {" <= ".join(columns): (F.when(complete, bad), max_share)}


def physical_rules(columns: Sequence[str], postal: bool = False) -> dict[str, Rule]:
    """Physical limits; the postal gate compares dew point with the mean and tolerates a few."""
    rules: dict[str, Rule] = {}
    if not postal and "ppt" in columns:
        rules["ppt >= 0"] = (F.col("ppt") < 0, 0.0)
    if "tdmean" in columns:
        top, share = ("tmean", fv.MAX_VIOLATION_SHARE) if postal else ("tmax", 0.0)
        rules[f"tdmean <= {top}"] = (F.col("tdmean") > F.col(top), share)
    if "rh_mean" in columns:
        rules["0 <= rh_mean <= 100"] = (~F.col("rh_mean").between(0, 100), 0.0)
    if "vpd_mean" in columns:
        rules["vpd_mean >= 0"] = (F.col("vpd_mean") < 0, 0.0)
    return rules


def range_rules(
    columns: Sequence[str], ranges: Mapping[str, tuple[float, float]] = fv.PLAUSIBLE_RANGES
) -> dict[str, Rule]:
    flags = outlier_flags(columns, ranges)
    return {f"{v} within [{ranges[v][0]:g}, {ranges[v][1]:g}]": (bad, 0.0) for v, bad in flags.items()}


def check_rules(df: DataFrame, rules: Mapping[str, Rule], label: str) -> DataFrame:
    """All rules in one pass.  A share of 0 allows no violation, otherwise it is a strict bound."""
    aggs = [a for i, (bad, _) in enumerate(rules.values()) for a in (F.count_if(bad).alias(f"b{i}"), F.count(bad).alias(f"n{i}"))]
    return rule_results(df.agg(*aggs), rules, label)


def rule_results(one: DataFrame, rules: Mapping[str, Rule], label: str) -> DataFrame:
    """The value rules over one row of violations ``b0`` … and testable rows ``n0`` …"""
    results = []
    for i, (name, (_, share)) in enumerate(rules.items()):
        count, n = F.col(f"b{i}"), F.col(f"n{i}")
        if share:
            passed = (n == 0) | (count / F.nullif(n, F.lit(0)) < share)
            results.append(_result(f"{label}: {name}", passed, count, f"share < {share:g}"))
        else:
            results.append(_result(f"{label}: {name}", count == 0, count, "0"))
    return _rows(one, results)


def check_rollup(
    child: DataFrame,
    parent: DataFrame,
    group: Sequence[str],
    variables: Sequence[str],
    weight: str = "area_km2",
    tolerance: float = fv.ROLLUP_TOLERANCE,
) -> DataFrame:
    """Stored roll-ups equal recomputed ones, for all rows; NULL must meet NULL."""
    redo = weighted_rollup(child, group, variables, weight, members=None)
    return compare_panels(redo, parent, group, variables, tolerance, "roll-up reproduces")


def compare_panels(
    a: DataFrame, b: DataFrame, keys: Sequence[str], variables: Sequence[str], tolerance: float, label: str
) -> DataFrame:
    left = a.select(*keys, *[F.col(v).alias(f"a_{v}") for v in variables], F.lit(True).alias("_in_a"))
    right = b.select(*keys, *[F.col(v).alias(f"b_{v}") for v in variables], F.lit(True).alias("_in_b"))
    both = left.join(right, list(keys), "full")
    aggs = [F.count_if(F.col("_in_a").isNull() | F.col("_in_b").isNull()).alias("k")]
    results = [_equals(f"{label}: same keys", "k", 0)]
    for v in variables:
        x, y = F.col(f"a_{v}"), F.col(f"b_{v}")
        differ = (x.isNull() != y.isNull()) | F.coalesce(F.abs(x - y) > tolerance, F.lit(False))
        aggs.append(F.count_if(differ).alias(f"m_{v}"))
        results.append(_equals(f"{label}: {v}", f"m_{v}", 0))
    return _rows(both.agg(*aggs), results)


# ---- geography -----------------------------------------------------------


def check_geography(
    meta: DataFrame, cz_panel: DataFrame, n_counties: int, n_zones: int, n_days: int
) -> DataFrame:
    """County and zone counts, one zone per county, complete partition."""
    per_county = meta.groupBy("fips").agg(F.count_distinct("cz_id").alias("z"))
    one = per_county.agg(
        F.count(F.lit(1)).alias("counties"), F.count_if(F.col("z") != 1).alias("not_one_zone")
    ).select(
        "*",
        meta.agg(F.count_distinct("cz_id").alias("zones")).scalar().alias("zones"),
        (cz_panel.agg(F.sum("n_counties").alias("m")).scalar() / n_days).alias("members"),
    )
    return _rows(
        one,
        [
            _equals("geography: counties", "counties", n_counties),
            _equals("geography: zones", "zones", n_zones),
            _equals("geography: every county in one zone", "not_one_zone", 0),
            _result(
                "geography: members per day",
                F.abs(F.col("members") - n_counties) < 1e-9,
                F.col("members"),
                str(n_counties),
            ),
        ],
    )


def check_meta(meta: DataFrame, key: str, n: int, not_null: Sequence[str] = ()) -> DataFrame:
    one = meta.groupBy(key).agg(*[F.count_if(F.col(c).isNull()).alias(f"x_{c}") for c in not_null], F.count(F.lit(1)).alias("_r"))
    one = one.agg(F.count(F.lit(1)).alias("keys"), *[F.sum(f"x_{c}").alias(f"x_{c}") for c in not_null])
    return _rows(
        one,
        [_equals(f"metadata: {key} count", "keys", n)]
        + [
            _result(f"metadata: {c} given", F.coalesce(F.col(f"x_{c}"), F.lit(0)) == 0, F.col(f"x_{c}"), "0")
            for c in not_null
        ],
    )


# ---- comparisons and spot checks -----------------------------------------


def cross_panel(
    fine: DataFrame, coarse: DataFrame, value: str = "tmax", weight: str = "area_km2", parent: str = "county_fips"
) -> DataFrame:
    """Finer panel rolled up to its parent zone, next to the parent's own value."""
    given = fine.filter(F.col(value).isNotNull() & F.col(weight).isNotNull() & F.col(parent).isNotNull())
    rolled = given.groupBy(F.col(parent).alias("fips"), "date").agg(weighted_mean(value, weight).alias("rolled"))
    return rolled.join(coarse.select("fips", "date", F.col(value).alias("own")), ["fips", "date"])


def check_cross_panel(
    fine: DataFrame,
    coarse: DataFrame,
    tolerance: float = fv.CROSS_PANEL_TOLERANCE_C,
    max_share: float = fv.MAX_VIOLATION_SHARE,
    **names: str,
) -> DataFrame:
    one = cross_panel(fine, coarse, **names).agg(
        F.count_if(F.abs(F.col("rolled") - F.col("own")) > tolerance).alias("far"), F.count(F.lit(1)).alias("n")
    )
    passed = (F.col("n") == 0) | (F.col("far") / F.nullif(F.col("n"), F.lit(0)) <= max_share)
    return _rows(one, [_result("cross-panel: roll-up near parent", passed, F.col("far"), f"share <= {max_share:g}")])


def check_mean_between(df: DataFrame, rows: Column, value: str, lo: float, hi: float, label: str) -> DataFrame:
    """Mean over selected rows inside a band; no such rows means nothing to check."""
    return mean_results(df.filter(rows).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n")), lo, hi, label)


def mean_results(one: DataFrame, lo: float, hi: float, label: str) -> DataFrame:
    passed = (F.col("n") == 0) | F.col("mean").between(lo, hi)
    return _rows(one, [_result(label, passed, F.col("mean"), f"{lo:g}..{hi:g}")])


def check_climatology(df: DataFrame, zone: str, month: int, lo: float, hi: float, key: str = "cz_id") -> DataFrame:
    rows = (F.col(key) == zone) & (F.month("date") == month)
    return check_mean_between(df, rows, "tmax", lo, hi, f"climatology: {zone} month {month} tmax")


def check_spot(
    df: DataFrame, zone: str, start: date, end: date, lo: float, hi: float, key: str = "zone_id"
) -> DataFrame:
    rows = (F.col(key) == zone) & F.col("date").between(F.lit(start), F.lit(end))
    return check_mean_between(df, rows, "tmax", lo, hi, f"spot: {zone} {start}..{end} tmax")


def check_band(df: DataFrame, lo: int, hi: int, label: str, severity: str = "error") -> DataFrame:
    """Row count inside a band; ``severity='warning'`` reports without failing the gate."""
    return band_results(df.agg(F.count(F.lit(1)).alias("n")), "n", lo, hi, label, severity)


def band_results(one: DataFrame, column: str, lo: int, hi: int, label: str, severity: str = "error") -> DataFrame:
    return _rows(one, [_result(label, F.col(column).between(lo, hi), F.col(column), f"{lo}..{hi}", severity)])


def check_count(one: DataFrame, column: str, label: str, severity: str = "error") -> DataFrame:
    """A count of faults that should be 0."""
    return _rows(one, [_result(label, F.col(column) == 0, F.col(column), "0", severity)])


def check_extract(df: DataFrame, zone: str, value: str, n_days: int, n_zones: int) -> DataFrame:
    """One period's extract: rows, missing dates; missing values and range are reported."""
    one = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("date").isNull()).alias("no_date"),
        F.count_if(F.col(value).isNull()).alias("no_value"),
        F.min(value).alias("lo"),
        F.max(value).alias("hi"),
    )
    report = lambda name, c: _result(name, F.lit(True), F.col(c), "reported", "info")
    return _rows(
        one,
        [
            _equals("extract: rows = days x zones", "rows", n_days * n_zones),
            _equals("extract: dates given", "no_date", 0),
            report("extract: missing values", "no_value"),
            report("extract: smallest value", "lo"),
            report("extract: largest value", "hi"),
        ],
    )


def check_coverage(coverage: DataFrame, label: str, explained: DataFrame | None = None) -> DataFrame:
    """One row per year and variable of ``coverage_by_year``: above the floor, or in a year whose gaps are explained."""
    known = F.lit(False)
    if explained is not None:
        years = explained.select(F.col("year").alias("_year")).distinct().withColumn("_known", F.lit(True))
        coverage = coverage.join(years, F.col("year") == F.col("_year"), "left")
        known = F.coalesce("_known", F.lit(False))
    name = F.concat_ws(" ", F.lit(f"{label}: coverage"), "variable", F.col("year").cast("string"))
    return coverage.select(F.inline(F.array(_result(name, ~F.col("low") | known, F.col("pct_valid"), "floor or explained"))))


def failures(results: DataFrame) -> DataFrame:
    """The hard checks that did not hold."""
    return results.filter((F.col("severity") == "error") & ~F.col("passed"))


def enforce(results: DataFrame) -> list[str]:
    """Print every result and raise if a hard check failed.  The table is a few dozen rows."""
    results = materialize(results, "gate")
    for r in results.collect():
        print(f"[{'PASS' if r.passed else 'FAIL'}] {r.check}: {r.observed} (expected {r.expected})")
    failed = [r.check for r in failures(results).collect()]
    if failed:
        raise GateFailed("; ".join(failed))
    return failed
