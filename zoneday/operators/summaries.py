"""Summary tables of claims and weather panels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneday import fixed_values as fv
from zoneday.functions import report
from zoneday.functions.dates import in_analysis_window, is_summer, month_start
from zoneday.functions.weather import c_to_f, region_of
from zoneday.operators.keys import first_label, stack
from zoneday.operators.rollup import wide_stats
from zoneday.session import lookup, materialize

# ---- claims --------------------------------------------------------------


def summarize_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-null count, mean, sample deviation, min and max per column."""
    return wide_stats(
        df,
        columns,
        {"n": F.count, "mean": F.avg, "sd": F.stddev_samp, "min": F.min, "max": F.max},
    )


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Level, count and percent of all rows."""
    counts = df.groupBy(F.col(column).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.select("level", "n", (F.col("n") / total * 100).alias("pct"))


def order_levels(freq: DataFrame) -> DataFrame:
    return freq.orderBy("level")


def individual_table(claims: DataFrame) -> DataFrame:
    """The four report blocks in fixed order, as text (``ord`` gives the row order).

    The two frequency blocks come from one joint count, so the claims are read
    once for the numbers and once for the categories, each with two columns.
    """
    numbers = summarize_numeric(claims, ["age", "charge"])
    names = {"age": ("Employee age", 1), "charge": ("Total claim cost ($)", 2)}
    blank = F.lit("")
    cont = numbers.select(
        F.when(F.col("variable") == "age", F.lit(names["age"][1])).otherwise(names["charge"][1]).alias("ord"),
        F.when(F.col("variable") == "age", F.lit(names["age"][0])).otherwise(names["charge"][0]).alias("label"),
        blank.alias("level"),
        report.fmt_int(F.col("n")).alias("n"),
        *[report.fmt_num(F.col(c)).alias(c) for c in ("mean", "sd", "min", "max")],
        blank.alias("pct"),
    )
    joint = materialize(claims.groupBy("gender", "marital").agg(F.count(F.lit(1)).alias("k")), "levels")
    blocks = [cont]
    for base, column, title in ((10, "gender", "Employee gender"), (20, "marital", "Employee marital status")):
        counts = joint.groupBy(F.col(column).alias("level")).agg(F.sum("k").alias("k"))
        total = joint.agg(F.sum("k").alias("t")).scalar()
        rows = counts.select(F.lit(title).alias("block"), "level", "k", (F.col("k") / total * 100).alias("share"))
        rank = F.row_number().over(Window.partitionBy("block").orderBy("level"))
        rows = first_label(rows.withColumn("ord", rank + base), "block", "level")
        blocks.append(
            rows.select(
                "ord",
                "label",
                "level",
                report.fmt_int(F.col("k")).alias("n"),
                *[blank.alias(c) for c in ("mean", "sd", "min", "max")],
                report.fmt_pct(F.col("share")).alias("pct"),
            )
        )
    return report_blocks(blocks)


def report_blocks(blocks: Sequence[DataFrame]) -> DataFrame:
    """Blocks stacked; each carries ``ord``, which orders the whole report."""
    return stack(blocks).orderBy("ord")


def top_codes(df: DataFrame, k: int = 10, column: str = "icd1", drop_blank_first: bool = False) -> DataFrame:
    """The k most frequent codes with their percent of all non-blank codes.

    As in the published table the k rows are taken first and a blank or NULL
    among them is dropped afterwards, so fewer may remain.  Ties go to the
    smaller code.
    """
    counts = df.groupBy(F.col(column).alias("code")).agg(F.count(F.lit(1)).alias("n"))
    given = F.col("code").isNotNull() & (F.col("code") != "")
    # a conditional sum, not a filter: both uses then share one count per code
    total = counts.agg(F.sum(F.when(given, F.col("n"))).alias("total")).scalar()
    if drop_blank_first:
        counts = counts.filter(given)
    top = counts.orderBy(F.col("n").desc(), F.col("code").asc_nulls_last()).limit(k)
    return top.filter(given).select("code", "n", (F.col("n") / total * 100).alias("pct"))


def daily_claims(claims: DataFrame, flag: Column, target: Column) -> DataFrame:
    """Per day: claims, flagged claims, claims in target zones.

    One pass over the claims; every figure of the heat table follows from this
    calendar-sized result.  Undated claims keep a NULL day.
    """
    return claims.groupBy("bill_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(flag).alias("n_flagged"),
        F.count_if(target).alias("n_target"),
    )


def heat_headline(daily: DataFrame) -> DataFrame:
    """Totals over the whole period and their shares."""
    t = daily.agg(
        F.sum("n").alias("n_total"), F.sum("n_flagged").alias("n_flagged"), F.sum("n_target").alias("n_target")
    )
    share = lambda c: F.try_divide(F.col(c) * 100.0, F.col("n_total"))
    return t.select(
        "n_total",
        "n_flagged",
        share("n_flagged").alias("pct_flagged"),
        "n_target",
        share("n_target").alias("pct_target"),
    )


def _kept_days(daily: DataFrame, skip_years: Sequence[int]) -> DataFrame:
    return daily.filter(in_analysis_window("bill_date", skip_years=skip_years))


def mean_per_day(daily: DataFrame, skip_years: Sequence[int] = fv.EXCLUDED_YEARS) -> DataFrame:
    """Mean over days with at least one claim; no zero days are added."""
    return _kept_days(daily, skip_years).agg(F.avg("n").alias("mean_per_day"))


def mean_per_month(daily: DataFrame, skip_years: Sequence[int] = fv.EXCLUDED_YEARS) -> DataFrame:
    monthly = (
        _kept_days(daily, skip_years)
        .groupBy(F.year("bill_date").alias("y"), F.month("bill_date").alias("m"))
        .agg(F.sum("n").alias("n"))
    )
    return monthly.agg(F.avg("n").alias("mean_per_month"))


def seasonal_ratio(daily: DataFrame, skip_years: Sequence[int] = fv.EXCLUDED_YEARS) -> DataFrame:
    summer = is_summer("bill_date")
    means = _kept_days(daily, skip_years).agg(
        F.avg(F.when(summer, F.col("n"))).alias("mean_summer"),
        F.avg(F.when(~summer, F.col("n"))).alias("mean_rest"),
    )
    return means.withColumn("ratio", F.try_divide("mean_summer", "mean_rest"))


def heat_table(daily: DataFrame) -> DataFrame:
    """The eight formatted rows of the heat report, from the daily table."""
    head, ratio = heat_headline(daily), seasonal_ratio(daily)
    one = head.select(
        "*",
        mean_per_day(daily).scalar().alias("per_day"),
        mean_per_month(daily).scalar().alias("per_month"),
        ratio.select("mean_summer").scalar().alias("mean_summer"),
        ratio.select("mean_rest").scalar().alias("mean_rest"),
        ratio.select("ratio").scalar().alias("ratio"),
    )
    num = lambda c, d: report.fmt_num(F.col(c), d)
    rows = [
        ("Total claims (entire period)", report.fmt_int(F.col("n_total"))),
        (
            "Heat-related claims (any diagnosis position)",
            report.fmt_count_pct(F.col("n_flagged"), F.col("pct_flagged")),
        ),
        ("Claims in target commuting zones", report.fmt_count_pct(F.col("n_target"), F.col("pct_target"))),
        ("Mean claims per day", num("per_day", 1)),
        ("Mean claims per month", num("per_month", 1)),
        ("Mean daily claims, summer (June-August)", num("mean_summer", 1)),
        ("Mean daily claims, non-summer (Sep-May)", num("mean_rest", 1)),
        ("Summer to non-summer ratio", num("ratio", 2)),
    ]
    table = F.array(
        *[F.struct(F.lit(i).alias("ord"), F.lit(s).alias("statistic"), v.alias("value")) for i, (s, v) in enumerate(rows)]
    )
    return one.select(F.inline(table))


def monthly_rate(
    panel: DataFrame, first_year: int = fv.SERIES_FIRST_YEAR, before: date = fv.SERIES_END
) -> DataFrame:
    """Monthly claims per 100k workers by zone, then averaged across zones."""
    rows = panel.filter(
        in_analysis_window("date", first_year, before) & F.col("claims_per_100k").isNotNull()
    )
    by_zone = rows.groupBy("cz_id", "year", "month").agg(
        (F.try_divide(F.sum("n_claims"), F.avg("emp_cz")) * 100_000).alias("rate")
    )
    return (
        by_zone.groupBy("year", "month")
        .agg(F.avg("rate").alias("avg_claims_per_100k"))
        .withColumn("date", month_start("year", "month"))
    )


def seasonal_rates(
    panel: DataFrame,
    before: date = fv.SERIES_END,
    skip_years: Sequence[int] = fv.EXCLUDED_YEARS,
) -> DataFrame:
    """Mean daily rate per zone, year and month, the sample behind the box plot."""
    rows = panel.filter(
        in_analysis_window("date", before=before, skip_years=skip_years) & F.col("claims_per_100k").isNotNull()
    )
    label = F.get(F.array(*[F.lit(m) for m in fv.MONTH_LABELS]), F.col("month") - 1)
    return (
        rows.groupBy("cz_id", "year", "month")
        .agg(F.avg("claims_per_100k").alias("avg_daily"))
        .withColumn("month_label", label)
    )


# ---- exact quantiles and box plots ---------------------------------------


def exact_quantiles(df: DataFrame, group: str, value: str, probs: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles of groups too large for one task.

    Equal values are counted first, and the different values of all groups are
    dealt out by range.  Counts per range tell which ranges hold the wanted
    ranks, and only these are ranked, one at a time: a range is one task's
    share of the different values, however many rows have one of them.
    Returns ``(group, total, q array<double>)`` in the order of ``probs``.
    """
    return _ranked(_value_ranges(df, group, value), probs).select(F.col("_g").alias(group), F.col("_total").alias("total"), "q")


def _value_ranges(df: DataFrame, group: str, value: str) -> DataFrame:
    """(_g, _v, _n, _bin): the different values of each group, counted and dealt out by range; written once."""
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # the range is a column of the written table, so it is the same whoever reads it
    return materialize(counts.repartitionByRange("_g", "_v").withColumn("_bin", F.spark_partition_id()), "value-ranges")


def _ranked(binned: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(_g, _total, q) of counted values."""
    # a handful of rows per group from here on
    before = Window.partitionBy("_g").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    per_bin = (
        binned.groupBy("_g", "_bin")
        .agg(F.sum("_n").alias("_in"))
        .withColumn("_before", F.coalesce(F.sum("_in").over(before), F.lit(0)))
    )
    cuts = per_bin.groupBy("_g").agg(F.sum("_in").alias("_total"))
    position = [F.lit(float(p)) * (F.col("_total") - 1) for p in probs]
    ranks = cuts.select(
        "_g",
        "_total",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("_i"), pos.alias("_pos"), side(pos).cast("long").alias("_rank"))
                    for i, pos in enumerate(position)
                    for side in (F.floor, F.ceil)
                ]
            )
        ),
    )
    in_bin = (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_in"))
    # two ranks per probability and group
    targets = ranks.join(per_bin, "_g").filter(in_bin).distinct()
    needed = targets.select("_g", "_bin", "_before").distinct()
    upto = Window.partitionBy("_g", "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = lookup(binned, needed, ["_g", "_bin"], "inner").withColumn(
        "_end", F.col("_before") + F.sum("_n").over(upto)
    )
    hits = ranked.select("_g", "_bin", "_v", (F.col("_end") - F.col("_n")).alias("_from"), "_end")
    found = targets.join(hits, ["_g", "_bin"]).filter(
        (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_end"))
    )
    lo = F.max(F.when(F.col("_rank") == F.floor("_pos"), F.col("_v")))
    hi = F.max(F.when(F.col("_rank") == F.ceil("_pos"), F.col("_v")))
    each = found.groupBy("_g", "_total", "_i").agg((lo + (hi - lo) * F.max(F.col("_pos") - F.floor("_pos"))).alias("_q"))
    return each.groupBy("_g", "_total").agg(
        F.array(*[F.max(F.when(F.col("_i") == i, F.col("_q"))) for i in range(len(probs))]).alias("q")
    )


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers, mean, outlier count.

    Whiskers end at the last value within 1.5 interquartile ranges of the box.
    The quartiles are exact ranks, found in ranges of values.  Every number
    comes from the counted values, so ``df`` is read once and equal values are
    one row from there on.
    """
    counted = _value_ranges(df, group, value)
    quart = _ranked(counted, [0.25, 0.5, 0.75]).select("_g", "q")
    n, v = F.col("_n"), F.col("_v")
    out = outlier_test(v, F.get("q", 0), F.get("q", 2))
    return (
        lookup(counted, quart, "_g", "inner")
        .groupBy(F.col("_g").alias(group))
        .agg(
            F.sum(n).alias("n"),
            F.max(F.get("q", 0)).alias("q1"),
            F.max(F.get("q", 1)).alias("median"),
            F.max(F.get("q", 2)).alias("q3"),
            F.min(F.when(~out, v)).alias("whisker_low"),
            F.max(F.when(~out, v)).alias("whisker_high"),
            (F.sum(v * n) / F.sum(n)).alias("mean"),
            F.sum(F.when(out, n).otherwise(0)).alias("n_outliers"),
        )
    )


def outlier_test(v: Column, q1: Column, q3: Column) -> Column:
    reach = 1.5 * (q3 - q1)
    return (v < q1 - reach) | (v > q3 + reach)


def box_outliers(df: DataFrame, stats: DataFrame, group: str, value: str) -> DataFrame:
    """The rows drawn as points: those outside the whiskers' reach."""
    joined = lookup(df, stats.select(group, "q1", "q3"), group, "inner")
    return joined.filter(outlier_test(F.col(value), F.col("q1"), F.col("q3"))).drop("q1", "q3")


# ---- weather -------------------------------------------------------------


def monthly_temperature(panel: DataFrame, zone: str = "cz_id") -> DataFrame:
    """Mean monthly extremes in Fahrenheit per zone, then across zones."""
    by_zone = panel.groupBy(zone, "year", "month").agg(
        c_to_f(F.avg("tmax")).alias("tmax_f"), c_to_f(F.avg("tmin")).alias("tmin_f")
    )
    return (
        by_zone.groupBy("year", "month")
        .agg(F.avg("tmax_f").alias("tmax_mean"), F.avg("tmin_f").alias("tmin_mean"))
        .withColumn("date", month_start("year", "month"))
    )


def coverage_by_year(df: DataFrame, variables: Sequence[str], floor: float, day: str = "date") -> DataFrame:
    """Percent of rows with a value per variable and year, marked where below the floor."""
    present = [v for v in variables if v in df.columns]
    share = lambda c: F.count(c) / F.count(F.lit(1)) * 100
    rows = wide_stats(
        df.withColumn("year", F.year(day)), present, {"pct_valid": share, "n": lambda c: F.count(c)}, ["year"]
    )
    return rows.withColumn("low", F.col("pct_valid") < floor)


def coverage_overall(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    present = [v for v in variables if v in df.columns]
    return wide_stats(df, present, {"pct_valid": lambda c: F.count(c) / F.count(F.lit(1)) * 100})


def low_years(coverage: DataFrame) -> DataFrame:
    return coverage.filter("low").select("year").distinct()


def missing_share(df: DataFrame, variables: Sequence[str], day: str = "date") -> DataFrame:
    """Percent missing per variable and year (the heat-map table)."""
    present = [v for v in variables if v in df.columns]
    gap = lambda c: F.count_if(c.isNull()) / F.count(F.lit(1)) * 100
    return wide_stats(df.withColumn("year", F.year(day)), present, {"pct_missing": gap}, ["year"])


def panel_report(df: DataFrame, zone: str, variables: Sequence[str], day: str = "date") -> DataFrame:
    """Coverage report as (item, detail, n, value) rows from two small aggregates.

    Rows, zones, first and last day, calendar days, then percent valid and mean
    per variable.  Zones and days are counted on a grouped key table, so no
    task holds all keys.
    """
    present = [v for v in variables if v in df.columns]
    per_zone = df.groupBy(zone).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        *[F.count(v).alias(f"n_{v}") for v in present],
        *[F.sum(v).alias(f"s_{v}") for v in present],
    )
    return report_rows(per_zone, present)


def report_rows(per_zone: DataFrame, variables: Sequence[str]) -> DataFrame:
    """The report's rows from one row per zone: rows, first_day, last_day, and n_ and s_ of every variable."""
    total = per_zone.agg(
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("zones"),
        F.min("first_day").alias("lo"),
        F.max("last_day").alias("hi"),
        *[F.sum(f"n_{v}").alias(f"n_{v}") for v in variables],
        *[F.sum(f"s_{v}").alias(f"s_{v}") for v in variables],
    )

    def row(item: str, detail: Column | str, n: Column, value: Column | None = None) -> Column:
        v = F.lit(None).cast("double") if value is None else value.cast("double")
        d = F.lit(detail) if isinstance(detail, str) else detail
        return F.struct(F.lit(item).alias("item"), d.alias("detail"), n.cast("long").alias("n"), v.alias("value"))

    rows = [
        row("rows", "", F.col("rows")),
        row("zones", "", F.col("zones")),
        row("first_day", F.col("lo").cast("string"), F.lit(None)),
        row("last_day", F.col("hi").cast("string"), F.lit(None)),
        row("calendar_days", "", F.datediff("hi", "lo") + 1),
    ]
    for v in variables:
        rows.append(row("pct_valid", v, F.col(f"n_{v}"), F.col(f"n_{v}") / F.col("rows") * 100))
        rows.append(row("mean", v, F.col(f"n_{v}"), F.try_divide(f"s_{v}", f"n_{v}")))
    return total.select(F.inline(F.array(*rows)))


def class_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per stability tier, era, state ... ordered by the class."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(column)


def region_seasonality(panel: DataFrame, value: str = "ppt", lon: str = "centroid_lon") -> DataFrame:
    """Mean, standard error and its 95 % band per region and month over given values."""
    stats = (
        panel.filter(F.col(value).isNotNull())
        .groupBy(region_of(lon).alias("region"), "month")
        .agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("_sd"), F.count(value).alias("n"))
    )
    se = F.col("_sd") / F.sqrt("n")
    return stats.select(
        "region", "month", "mean", se.alias("se"), (F.col("mean") - 1.96 * se).alias("lo"), (F.col("mean") + 1.96 * se).alias("hi")
    )


def annual_means(panel: DataFrame, zone: str = "cz_id", years: tuple[int, int] = fv.FULL_YEARS) -> DataFrame:
    """Zone means over full years; precipitation as a yearly total."""
    first, last = years
    kept = panel.filter(F.col("date").between(F.lit(date(first, 1, 1)), F.lit(date(last, 12, 31))))
    return kept.groupBy(zone).agg(
        F.avg("tmean").alias("mean_tmean"),
        F.avg("tmax").alias("mean_tmax"),
        (F.avg("ppt") * 365).alias("mean_ppt"),
    )


def describe_wide(df: DataFrame, variables: Sequence[str], digits: int = 3) -> DataFrame:
    """Mean, deviation, extremes and percent valid per present variable, rounded."""
    present = [v for v in variables if v in df.columns]
    stats: Mapping = {
        "mean": lambda c: F.round(F.avg(c), digits),
        "sd": lambda c: F.round(F.stddev_samp(c), digits),
        "min": lambda c: F.round(F.min(c), digits),
        "max": lambda c: F.round(F.max(c), digits),
        "pct_valid": lambda c: F.round(F.count(c) / F.count(F.lit(1)) * 100, digits),
    }
    return wide_stats(df, present, stats)


def map_frame(zones: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Zone attributes with their statistics; zones without one keep NULLs."""
    return lookup(zones, stats, key, "left")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def hash_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """n rows picked by the MD5 of seed and keys: the same rows in every run and engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys))
    return df.orderBy(F.md5(text), *keys).limit(n)


