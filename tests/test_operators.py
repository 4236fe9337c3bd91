from __future__ import annotations

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneday.operators import dense, keys, manifest, reshape, rollup, summaries
from zoneday.plans import claims as claim_plans
from zoneday.session import lookup, materialize


def d(n):
    return date(2024, 1, 1) + timedelta(days=n)


# ---- keys ----------------------------------------------------------------


def test_argmax_ties_and_nulls(spark, rows):
    df = spark.createDataFrame(
        [("a", "2", 0.5), ("a", "1", 0.5), ("a", "3", None), ("b", "9", None), ("b", "8", None)], "zip string, fips string, v double"
    )
    assert rows(keys.argmax_row(df, "zip", "v", ["fips"]), "zip") == [("a", "1", 0.5), ("b", "8", None)]


def test_argmax_is_limited_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 3 as k", "id as v", "id as t")
    plan = keys.argmax_row(df, "k", "v", ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_lookup_starts_no_job(spark, rows):
    facts = spark.range(1000).selectExpr("id", "if(id < 400, 0, id % 50) as k")
    table = spark.range(40).selectExpr("id as k", "id * 2 as v")
    spark.sparkContext.setJobGroup("lookup", "")
    out = lookup(facts, table, "k", "left")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lookup")
    assert [r.v for r in out.orderBy("id").collect()] == [2 * k if (k := 0 if i < 400 else i % 50) < 40 else None for i in range(1000)]


def test_flag_any_never_null(spark, rows):
    df = spark.createDataFrame(
        [(1, "T67.0", None), (2, None, " t67 "), (3, None, None), (4, "x", "T670"), (5, "", "")], "id int, c1 string, c2 string"
    )
    codes = spark.createDataFrame([("T67.0",), ("T670",), ("t67",), ("",)], "code string")
    want = [(1, True), (2, True), (3, False), (4, True), (5, False)]
    out = keys.flag_any(df, ["c1", "c2"], codes)
    assert out.columns == ["id", "c1", "c2", "is_heat"]
    assert rows(out.select("id", "is_heat"), "id") == want


def test_describe_codes_fallback_and_fan_out(spark, rows):
    top = spark.createDataFrame([("M54.5", 3), ("A1", 2)], "code string, n int")
    names = spark.createDataFrame([("A1", "x"), ("A1", "y")], "code string, description string")
    got = rows(keys.describe_codes(top, names), "code", "description")
    assert got == [("A1", 2, "x"), ("A1", 2, "y"), ("M54.5", 3, "Low back pain")]


def test_era_sets(spark, rows):
    z = spark.createDataFrame([("e1", "a"), ("e2", "a"), ("e1", "b"), ("e2", "c"), ("e3", "d")], "era string, zone_id string")
    assert rows(keys.era_sets(z, "e1", "e2"), "zone_id") == [("a", "both"), ("b", "only_first"), ("c", "only_second")]


def test_first_label(spark, rows):
    df = spark.createDataFrame([("g", "b"), ("g", "a")], "block string, level string")
    assert rows(keys.first_label(df, "block", "level").select("level", "label"), "level") == [("a", "g"), ("b", "")]


def test_attach_replaces_columns(spark, rows):
    df = spark.createDataFrame([("a", 1)], "fips string, cz int")
    meta = spark.createDataFrame([("a", 2)], "fips string, cz int")
    assert rows(keys.attach(df, meta, "fips")) == [("a", 2)]


# ---- dense ---------------------------------------------------------------


def test_densify_has_no_cross_join_and_fills(spark, rows):
    facts = spark.createDataFrame([("a", d(0), 5), ("b", d(2), 7)], "z string, date date, n int")
    first, last = dense.bounds(facts, "date")
    out = dense.densify(facts, facts.select("z"), "z", first, last, fill={"n": 0})
    assert rows(out, "z", "date") == [("a", d(0), 5), ("a", d(1), 0), ("a", d(2), 0), ("b", d(0), 0), ("b", d(1), 0), ("b", d(2), 7)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and "Join Inner" not in plan


def test_densify_uses_the_given_zone_list(spark):
    facts = spark.createDataFrame([("a", d(0), 5)], "z string, date date, n int")
    zones = spark.createDataFrame([("a",), ("never seen",)], "z string")
    out = dense.densify(facts, zones, "z", d(0), d(1))
    assert out.count() == 4 and out.filter("n is null").count() == 3


def test_eras_do_not_leak(spark, rows):
    eras = spark.createDataFrame([("e1", d(0), d(1)), ("e2", d(2), d(2))], "era string, start_date date, end_date date")
    zones = spark.createDataFrame([("e1", "a"), ("e2", "a"), ("e2", "b")], "era string, zone_id string")
    facts = spark.createDataFrame([("a", d(0), 1.0), ("b", d(0), 2.0)], "zone_id string, date date, v double")
    got = rows(dense.densify_eras(facts, zones, eras).select("era", "zone_id", "date", "v"), "zone_id", "date")
    assert got == [("e1", "a", d(0), 1.0), ("e1", "a", d(1), None), ("e2", "a", d(2), None), ("e2", "b", d(2), None)]


def test_missing_blocks_and_year_chunks(spark, rows):
    have = [("v", date(2020, 12, 28)), ("v", date(2021, 1, 3)), ("v", date(2021, 1, 4)), ("w", date(2020, 12, 29))]
    cat = spark.createDataFrame(have, "var string, date date")
    names = cat.select("var").distinct()
    blocks = dense.missing_blocks(dense.missing_dates(cat, names, date(2020, 12, 27), date(2021, 1, 5)))
    assert rows(blocks, "var", "min_date") == [
        ("v", date(2020, 12, 27), date(2020, 12, 27)),
        ("v", date(2020, 12, 29), date(2021, 1, 2)),
        ("v", date(2021, 1, 5), date(2021, 1, 5)),
        ("w", date(2020, 12, 27), date(2020, 12, 28)),
        ("w", date(2020, 12, 30), date(2021, 1, 5)),
    ]
    direct = dense.gap_blocks(cat, names, date(2020, 12, 27), date(2021, 1, 5))
    assert rows(direct, "var", "min_date") == rows(blocks, "var", "min_date")
    chunks = rows(dense.year_chunks(blocks).filter("var = 'w'"), "start_date")
    assert chunks == [
        ("w", 2020, date(2020, 12, 27), date(2020, 12, 28)),
        ("w", 2020, date(2020, 12, 30), date(2020, 12, 31)),
        ("w", 2021, date(2021, 1, 1), date(2021, 1, 5)),
    ]


def test_month_jobs_cover_partial_months(spark, rows):
    eras = spark.createDataFrame([("e", date(2019, 11, 30), date(2020, 1, 1))], "era string, start_date date, end_date date")
    assert rows(dense.month_jobs(["tmax"], eras), "year", "month") == [
        ("tmax", "e", 2019, 11), ("tmax", "e", 2019, 12), ("tmax", "e", 2020, 1),
    ]


# ---- roll-ups ------------------------------------------------------------


def test_weighted_rollup_renormalises(spark, rows):
    df = spark.createDataFrame(
        [("z", 10.0, 1.0), ("z", None, 9.0), ("z", 20.0, 3.0), ("y", None, 2.0)], "g string, v double, w double"
    )
    assert rows(rollup.weighted_rollup(df, ["g"], ["v", "absent"], "w"), "g") == [("y", 1, None), ("z", 3, 17.5)]


def test_merge_variables_is_one_shuffle_and_full_outer(spark, rows):
    long = spark.createDataFrame([("a", d(0), "tmax", 1.0), ("a", d(0), "tmin", 2.0), ("b", d(0), "tmin", 3.0)], "z string, date date, var string, value double")
    out = rollup.merge_variables(long, ["z", "date"], ["tmax", "tmin"])
    assert rows(out, "z") == [("a", d(0), 1.0, 2.0), ("b", d(0), None, 3.0)]
    joined = None
    for v in ("tmax", "tmin"):
        one = long.filter(F.col("var") == v).select("z", "date", F.col("value").alias(v))
        joined = one if joined is None else joined.join(one, ["z", "date"], "full")
    assert rows(joined, "z") == rows(out, "z")
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_employment_all_missing_is_zero_and_county_source(spark, rows):
    sheets = spark.createDataFrame([("48001", 2020, 1, None, None, None), ("48003", 2020, 1, 3.0, 3.0, 3.0)], "fips string, year int, qtr int, a double, b double, c double")
    months = ["a", "b", "c"] * 4
    geo = spark.createDataFrame([("48001", "1")], "fips string, cz_id string")
    xw = spark.createDataFrame([("48001", "1"), ("48003", "1")], "fips string, cz_id string")
    assert rows(rollup.employment_by_zone(sheets, geo, months=months)) == [("1", 2020, 1, 0.0)]
    assert rows(rollup.employment_by_zone(sheets, geo, "crosswalk", xw, months)) == [("1", 2020, 1, 3.0)]
    with pytest.raises(ValueError):
        rollup.employment_by_zone(sheets, geo, "crosswalk")


def test_rate_panel_keeps_zero_days_and_null_rates(spark, rows):
    claims = spark.createDataFrame(
        [("1", d(0)), ("1", d(0)), ("1", d(2)), (None, d(9)), ("1", None)], "cz_id string, bill_date date"
    )
    emp = spark.createDataFrame([("1", 2023, 4, 10.0)], "cz_id string, year int, qtr int, emp_cz double")
    got = rows(claim_plans.rate_panel(claims, emp).select("date", "n_claims", "qtr", "emp_cz", "claims_per_100k"), "date")
    assert got == [(d(0), 2, 1, None, None), (d(1), 0, 1, None, None), (d(2), 1, 1, None, None)]


# ---- summaries -----------------------------------------------------------


def test_top_codes_takes_then_drops(spark, rows):
    df = spark.createDataFrame([(c,) for c in ["a"] * 3 + [None] * 5 + [""] * 2 + ["b"] * 1], "icd1 string")
    assert rows(summaries.top_codes(df, 3)) == [("a", 3, 75.0)]
    assert rows(summaries.top_codes(df, 3, drop_blank_first=True), "code") == [("a", 3, 75.0), ("b", 1, 25.0)]


def test_frequency_counts_every_row(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "g string")
    assert rows(summaries.order_levels(summaries.frequency(df, "g"))) == [(None, 1, 25.0), ("a", 2, 50.0), ("b", 1, 25.0)]


def test_heat_figures_from_daily(spark):
    claims = spark.createDataFrame(
        [(date(2019, 7, 1), True, "1"), (date(2019, 7, 1), False, "2"), (date(2019, 1, 1), False, "1"), (date(2020, 7, 1), True, "1"), (None, False, None)],
        "bill_date date, h boolean, cz_id string",
    )
    daily = materialize(summaries.daily_claims(claims, F.col("h"), F.col("cz_id").isin("1")), "t")
    assert tuple(summaries.heat_headline(daily).first()) == (5, 2, 40.0, 3, 60.0)
    assert summaries.mean_per_day(daily).first()[0] == 1.5
    assert summaries.mean_per_month(daily).first()[0] == 1.5
    assert tuple(summaries.seasonal_ratio(daily).first()) == (2.0, 1.0, 2.0)
    table = [tuple(r) for r in summaries.heat_table(daily).collect()]
    assert table[1] == (1, "Heat-related claims (any diagnosis position)", "2 (40.00%)") and table[7][2] == "2.00"


def test_exact_quantiles_match_numpy_on_skewed_groups(spark):
    rng = random.Random(7)
    data = [("hot", round(rng.expovariate(1), 3)) for _ in range(4000)]
    data += [("ties", 5.0)] * 900 + [("ties", 6.0)] * 101 + [("one", 3.0)] + [("two", 1.0), ("two", 2.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r.g: (r.total, r.q) for r in summaries.exact_quantiles(df, "g", "v", probs).collect()}
    for g in ("hot", "ties", "one", "two"):
        values = [v for k, v in data if k == g]
        assert got[g][0] == len(values)
        assert got[g][1] == pytest.approx(list(np.quantile(values, probs)))
    assert "none" not in got


def test_quantile_ranges_stay_small(spark, monkeypatch):
    """Half of all rows on 500 low values: no range holds more than its share of the different values."""
    seen = []
    keep = summaries.materialize
    monkeypatch.setattr(summaries, "materialize", lambda df, label: seen.append(keep(df, label)) or seen[-1])
    df = spark.range(100_000).selectExpr("1 as g", "cast(if(id % 2 = 0, id % 500, 1000 + id) as double) as v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        q = summaries.exact_quantiles(df, "g", "v", [0.25, 0.5]).first().q
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    values = np.sort([i % 500 if i % 2 == 0 else 1000 + i for i in range(100_000)])
    assert q == pytest.approx(list(np.quantile(values, [0.25, 0.5])))
    sizes = [r["count"] for r in seen[0].groupBy("_bin").count().collect()]
    assert sum(sizes) == 50_250 and max(sizes) < 2 * 50_250 / 4


def test_merge_rejects_repeated_keys(spark, rows):
    long = spark.createDataFrame(
        [("a", d(0), "tmax", 31.0), ("a", d(0), "tmax", 33.0), ("a", d(0), "tmin", 1.0), ("b", d(0), "tmax", 2.0)],
        "fips string, date date, var string, value double",
    )
    assert rows(rollup.duplicate_keys(long, ["fips", "date"])) == [("a", d(0), "tmax", 2)]
    with pytest.raises(Exception, match="several rows of tmax for a 2024-01-01"):
        rollup.merge_variables(long, ["fips", "date"], ["tmax", "tmin"]).collect()
    once = long.filter("value <> 33")
    assert rows(rollup.merge_variables(once, ["fips", "date"], ["tmax", "tmin"]), "fips") == [("a", d(0), 31.0, 1.0), ("b", d(0), 2.0, None)]


def test_box_stats(spark, rows):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("g", v) for v in values] + [("g", None)], "k string, v double")
    assert rows(summaries.box_stats(df, "k", "v")) == [("g", 5, 2.0, 3.0, 4.0, 1.0, 4.0, 22.0, 1)]
    stats = summaries.box_stats(df, "k", "v")
    assert rows(summaries.box_outliers(df, stats, "k", "v")) == [("g", 100.0)]


def test_coverage_marks_low_years(spark, rows):
    df = spark.createDataFrame([(date(2020, 1, 1), 1.0), (date(2020, 1, 2), None), (date(2021, 1, 1), 1.0)], "date date, tmax double")
    cov = summaries.coverage_by_year(df, ["tmax", "absent"], 99.0)
    assert rows(cov, "year") == [(2020, "tmax", 50.0, 1, True), (2021, "tmax", 100.0, 1, False)]
    assert rows(summaries.low_years(cov)) == [(2020,)]
    log = spark.createDataFrame([(date(2020, 5, 5),), (date(2022, 5, 5),)], "date date")
    assert rows(manifest.explain_gaps(summaries.low_years(cov), log)) == [(2020,)]


def test_region_seasonality_counts_given_values(spark):
    df = spark.createDataFrame([(1.0, -102.0, 1), (3.0, -102.0, 1), (None, -102.0, 1)], "ppt double, centroid_lon double, month int")
    r = summaries.region_seasonality(df).first()
    assert (r.mean, round(r.se, 9)) == (2.0, round(2**0.5 / 2**0.5, 9))


def test_hash_sample_is_stable(spark, rows):
    df = spark.range(1000)
    assert rows(summaries.hash_sample(df, ["id"], 20)) == rows(summaries.hash_sample(df.repartition(7), ["id"], 20))


# ---- reshape -------------------------------------------------------------


def test_bands_named_by_date(spark, rows):
    df = spark.createDataFrame([("a", 1.0, None)], "z string, `mean.2020-01-02` double, `mean.2020-01-01` double")
    assert rows(reshape.bands_to_long(df, ["z"], "mean."), "date") == [("a", date(2020, 1, 1), None), ("a", date(2020, 1, 2), 1.0)]


def test_band_array_length_is_checked(spark, rows):
    bands = spark.createDataFrame([(1, d(5)), (2, d(3))], "band int, date date")
    good = spark.createDataFrame([("a", [1.0, 2.0])], "z string, values array<double>")
    assert rows(reshape.band_array_to_long(good, ["z"], bands), "date") == [("a", d(3), 2.0), ("a", d(5), 1.0)]
    bad = spark.createDataFrame([("a", [1.0])], "z string, values array<double>")
    with pytest.raises(Exception, match="number of bands"):
        reshape.band_array_to_long(bad, ["z"], bands).collect()


# ---- manifests -----------------------------------------------------------


def test_manifests(spark, rows):
    cat = spark.createDataFrame([("v", d(0), 10, 5, 5), ("v", d(1), 100, 5, 5), ("v", d(2), 100, 1, 5), ("v", d(2), 100, 9, 9)], "var string, date date, length long, nrows int, ncols int")
    assert manifest.valid_files(cat, 50).count() == 3
    assert manifest.valid_files(cat, 50, (5, 5)).count() == 2
    assert rows(manifest.inventory(cat, d(0), d(3))) == [("v", 3, 4, 75.0)]
    assert rows(manifest.inventory(cat, d(1), d(2))) == [("v", 2, 2, 100.0)]
    assert rows(manifest.inventory(cat, d(1), d(2), clip=False)) == [("v", 3, 2, 150.0)]
    assert manifest.retry_manifest(cat).count() == 3


def test_published_totals_format_as_printed(spark):
    """Counts of the published heat table give its printed shares and ratio."""
    days = [(date(2019, 7, 1), 38_285_609, 52_428, 9_575_702)]
    daily = spark.createDataFrame(days, "bill_date date, n long, n_flagged long, n_target long")
    text = {r.ord: r.value for r in summaries.heat_table(daily).collect()}
    assert text[0] == "38,285,609" and text[1] == "52,428 (0.14%)" and text[2] == "9,575,702 (25.01%)"
    means = spark.createDataFrame([(date(2019, 7, 1), 70293), (date(2019, 1, 1), 68900)], "bill_date date, n long")
    assert round(summaries.seasonal_ratio(means).first().ratio, 2) == 1.02
    done = spark.createDataFrame([("v", "2020"), ("v", "2020"), ("v", "2021")], "var string, period string")
    assert tuple(manifest.period_inventory(done, 17).first()) == ("v", 2, 17, 11.8)
