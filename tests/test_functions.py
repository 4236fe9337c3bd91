from __future__ import annotations

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from zoneday import fixed_values as fv
from zoneday.functions import clean, dates, report, weather
from zoneday.functions.geodesy import albers_forward, albers_inverse


def column(spark, expr, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr("v")).collect()]


def test_tidy_and_repaired_names(spark):
    assert clean.tidy_name("January\r\nEmployment  Level") == "january_employment_level"
    assert clean.repair_names(["a b", "a.b", "a b", "1st", "First ICD-9CM or ICD-10CM Diagnosis Code", "_x", "é", ".5"]) == [
        "a.b",
        "a.b.1",
        "a.b.2",
        "X1st",
        "First.ICD.9CM.or.ICD.10CM.Diagnosis.Code",
        "X_x",
        "é",
        "X.5",
    ]
    df = spark.createDataFrame([(1, 2)], "`St Name` int, `A\nB` int")
    assert clean.normalize_columns(df).columns == ["st_name", "a_b"]


def test_canonical_and_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "FIPS int, other int, NAME int")
    out = clean.canonical(df, {"fips": ["GEOID", "FIPS"], "missing": ["NOPE"]})
    assert out.columns == ["fips", "other", "NAME"]
    assert clean.order_columns(out, ["NAME", "absent", "fips"]).columns == ["NAME", "fips", "other"]


def test_pad_keeps_longer_keys(spark):
    assert column(spark, clean.pad_key, ["48", "48001", "480011", None, ""]) == ["00048", "48001", "480011", None, "00000"]


def test_parse_dates(spark):
    assert column(spark, clean.parse_mdy, ["1/2/2020", "01/02/2020 00:00:00", "13/1/2020", "2/30/2020", "x", "", None]) == [
        date(2020, 1, 2),
        date(2020, 1, 2),
        None,
        None,
        None,
        None,
        None,
    ]
    assert column(spark, clean.parse_month_year, ["7/1980", "07/1980", "13/1980", "1980", None]) == [
        date(1980, 7, 1),
        date(1980, 7, 1),
        None,
        None,
        None,
    ]


def test_parse_amount_never_raises(spark):
    assert column(spark, clean.parse_amount, ["$1,234.50", "12", "abc", "", "NaN", None]) == [1234.5, 12.0, None, None, None, None]


def test_labels(spark):
    assert column(spark, clean.marital_label, ["I", "K", "M", "S", "U", "", None, "X"]) == [
        "Single", "Unknown", "Married", "Separated", "Widowed", "Unknown", "Unknown", "X",
    ]
    assert column(spark, clean.gender_label, ["F", "M", "U", "", None]) == ["Female", "Male", "Unknown", "Unknown", "Unknown"]
    assert column(spark, lambda c: clean.blank_to(c, "U"), ["", None, "F"]) == ["U", None, "F"]


def test_codes_and_search(spark):
    assert column(spark, clean.norm_code, [" M54.5 ", "a.b.c", None]) == ["M545", "abc", None]
    found = column(
        spark,
        lambda c: clean.text_matches(c, fv.HEAT_TERMS, fv.HEAT_EXCLUSIONS),
        ["Heatstroke and sunstroke", "Tendon sheath", "Sunburn of first degree", "Contact with hot heating appliances", "Dehydration of newborn", "Fracture"],
    )
    assert found == [True, False, True, False, False, False]


def test_age_edges(spark):
    df = spark.createDataFrame([(date(2020, 1, 1), date(2006, 1, 1)), (date(2020, 1, 1), None)], "d date, b date")
    ages = [r[0] for r in df.select(clean.age_years("d", "b")).collect()]
    assert ages[0] == pytest.approx(5113 / 365.25) and ages[1] is None
    assert column(spark, clean.age_kept, [14.0, 95.0, 13.999, 95.001, None], "double") == [True, True, False, False, None]


def test_quarter_average_needs_all_three(spark):
    cols = ", ".join(f"{m} double" for m in fv.MONTH_COLUMNS)
    df = spark.createDataFrame(
        [(1, 1.0, 2.0, 3.0, *[None] * 9), (2, *[None] * 3, 4.0, None, 6.0, *[None] * 6), (4, *[None] * 9, 1.0, 1.0, 4.0), (5, *[1.0] * 12)],
        f"qtr int, {cols}",
    )
    assert [r[0] for r in df.select(clean.quarter_average("qtr")).collect()] == [2.0, None, 2.0, None]


def test_calendar_and_iso_week(spark):
    df = spark.createDataFrame([(date(2010, 1, 1),), (date(2020, 12, 31),)], "date date")
    got = [tuple(r) for r in dates.add_calendar(df).collect()]
    assert got[0] == (date(2010, 1, 1), 2010, 1, 1, 1, 53, 1)
    assert got[1] == (date(2020, 12, 31), 2020, 12, 31, 366, 53, 4)


def test_stability_limits(spark):
    days = [date(2024, 7, 15), date(2024, 7, 1), date(2024, 6, 30), date(2024, 1, 17), date(2024, 1, 16)]
    got = column(spark, lambda c: dates.stability(c, date(2024, 7, 15)), days, "date")
    assert got == ["early", "early", "provisional", "provisional", "stable"]


def test_ordinal_and_window(spark):
    df = spark.createDataFrame([(2024, 60), (2023, 60), (2023, 1)], "y int, n int")
    assert [r[0] for r in df.select(dates.ordinal_date("y", "n")).collect()] == [date(2024, 2, 29), date(2023, 3, 1), date(2023, 1, 1)]
    kept = column(
        spark,
        lambda c: dates.in_analysis_window(c, 2010, date(2024, 2, 1), (2020, 2021)),
        [date(2009, 12, 31), date(2010, 1, 1), date(2020, 5, 5), date(2024, 1, 31), date(2024, 2, 1), None],
        "date",
    )
    assert [bool(k) for k in kept] == [False, True, False, True, False, False]


def test_clamps_keep_null(spark):
    assert column(spark, lambda c: weather.clamp(c, 0, 100), [-1.0, 50.0, 101.0, None], "double") == [0.0, 50.0, 100.0, None]


def test_humidity(spark):
    df = spark.createDataFrame([(10.0, 20.0), (25.0, 20.0), (None, 20.0), (10.0, None)], "tdmean double, tmean double")
    got = [tuple(r)[2:] for r in weather.add_humidity(df).collect()]
    es = lambda t: 0.6108 * math.exp(17.27 * t / (t + 237.3))
    assert got[0][0] == pytest.approx(100 * es(10) / es(20)) and got[0][1] == pytest.approx(es(20) - es(10))
    assert got[1] == (100.0, 0.0) and got[2] == (None, None) and got[3] == (None, None)


def test_outliers_become_null(spark):
    df = spark.createDataFrame([(-0.1, 55.0), (-0.2, 55.1), (None, None)], "ppt double, tmax double")
    assert [tuple(r) for r in weather.null_outliers(df).collect()] == [(-0.1, 55.0), (None, None), (None, None)]


@pytest.mark.parametrize(
    ("t_f", "rh", "expected"),
    [(90.0, 70.0, 105.9), (100.0, 40.0, 109.3), (80.0, 40.0, 79.9), (100.0, 10.0, 93.9), (82.0, 90.0, 91.1), (35.0, 50.0, 35.0)],
)
def test_heat_index_published_points(spark, t_f, rh, expected):
    """Rounded values of the public chart and its two adjustments."""
    df = spark.createDataFrame([(t_f, rh)], "t double, rh double")
    got = df.select(weather.heat_index_f(F.col("t"), F.col("rh"))).first()[0]
    assert got == pytest.approx(expected, abs=1.0)


def test_heat_index_null_rules(spark):
    df = spark.createDataFrame([(30.0, None), (None, 50.0), (30.0, 100.1), (30.0, -0.1), (0.0, 100.0)], "t double, rh double")
    assert [r[0] for r in df.select(weather.heat_index("t", "rh")).collect()] == [None, None, None, None, 0.0]


def test_region_and_rate(spark):
    assert column(spark, weather.region_of, [-102.0, -101.0, -97.0, None], "double") == [
        "West Texas", "Central Texas", "East Texas", "East Texas",
    ]
    df = spark.createDataFrame([(5, 100.0), (5, 0.0), (5, None)], "n int, e double")
    assert [r[0] for r in df.select(weather.rate_per("n", "e")).collect()] == [5000.0, None, None]


def test_formats(spark):
    df = spark.createDataFrame([(38285609, 0.14)], "n long, p double")
    got = df.select(
        report.fmt_int(F.col("n")), report.fmt_num(F.col("p")), report.fmt_pct(F.col("p")), report.fmt_count_pct(F.col("n"), F.col("p"))
    ).first()
    assert tuple(got) == ("38,285,609", "0.14", "0.1%", "38,285,609 (0.14%)")


def test_albers_round_trip_and_origin(spark):
    pts = [(-100.0, 18.0), (-106.6, 25.9), (-93.5, 36.5), (-98.5, 31.2)]
    df = spark.createDataFrame(pts, "lon double, lat double")
    x, y = albers_forward(F.col("lon"), F.col("lat"))
    back = albers_inverse(F.col("x"), F.col("y"))
    for (lon, lat), row in zip(pts, df.select("lon", "lat", x.alias("x"), y.alias("y")).select("x", "y", *back).collect()):
        assert row[2] == pytest.approx(lon, abs=2e-8) and row[3] == pytest.approx(lat, abs=2e-8)
    first = df.select(x, y).first()
    assert tuple(first) == pytest.approx((1_500_000.0, 6_000_000.0), abs=1e-6)
