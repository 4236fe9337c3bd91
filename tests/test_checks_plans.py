from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from zoneday import fixed_values as fv
from zoneday.operators import checks, geometry
from zoneday.plans import weather as plans

START = date(2024, 1, 1)
S = plans.PanelSettings(as_of=date(2024, 7, 15), start=START, end=START + timedelta(days=3))
VALUES = (*fv.COUNTY_VARIABLES, *fv.HUMIDITY_VARIABLES)


def d(n):
    return START + timedelta(days=n)


@pytest.fixture(scope="module")
def meta(spark):
    return spark.createDataFrame(
        [("48001", "A", "1", "X", 100.0), ("48003", "B", "1", "X", 300.0), ("48005", "C", "2", "Y", 50.0)],
        "fips string, county_name string, cz_id string, cz_name string, area_km2 double",
    )


@pytest.fixture(scope="module")
def long(spark):
    data = []
    for i, fips in enumerate(("48001", "48003", "48005")):
        for n in range(4):
            if (fips, n) == ("48005", 1) or (fips, n) == ("48003", 2):
                continue
            for var, v in (("ppt", 1.0), ("tmin", 5.0 + i), ("tmean", 10.0 + i), ("tmax", 20.0 + i), ("tdmean", 4.0)):
                data.append((fips, d(n), var, v))
    data.append(("48001", d(0), "vpdmax", 1.0))
    return spark.createDataFrame(data, "fips string, date date, var string, value double")


@pytest.fixture(scope="module")
def county(spark, long, meta):
    return plans.zone_panel(long, meta, S)


@pytest.fixture(scope="module")
def zones(spark, county, meta):
    names = spark.createDataFrame([("1", "X", 400.0), ("2", "Y", 50.0)], "cz_id string, cz_name string, area_km2 double")
    return plans.parent_panel(county, meta, names, S)


def test_zone_panel_shape_and_columns(county):
    assert county.count() == 12
    assert county.columns == [
        "fips", "county_name", "date", "year", "month", "day", "doy", "week", "quarter",
        "ppt", "tmax", "tmin", "tmean", "tdmean", "rh_mean", "vpd_mean", "cz_id", "cz_name", "area_km2", "stability",
    ]
    gap = county.filter((F.col("fips") == "48005") & (F.col("date") == F.lit(d(1)))).first()
    assert gap.tmax is None and gap.rh_mean is None and gap.county_name == "C" and gap.stability == "stable"


def test_parent_panel_weights_and_gaps(zones, rows):
    got = {(r.cz_id, r.date): r for r in zones.collect()}
    assert len(got) == 8
    assert got["1", d(0)].tmax == pytest.approx((20 * 100 + 21 * 300) / 400)
    assert got["1", d(2)].tmax == 20.0 and got["1", d(2)].n_counties == 2  # the missing member still counts
    assert got["2", d(1)].tmax is None and got["2", d(1)].n_counties == 1
    assert got["1", d(0)].area_km2 == 400.0


def test_gate_passes_and_fails(county, zones, meta):
    gate = plans.county_zone_gate(county, zones, meta, S, n_counties=3, n_zones=2, climatology=("1", 7, 28.0, 38.0))
    assert checks.enforce(gate) == []
    bad_zones = zones.withColumn("tmax", F.when(F.col("cz_id") == "2", F.col("tmax") + 1e-5).otherwise(F.col("tmax")))
    with pytest.raises(checks.GateFailed, match="roll-up reproduces: tmax"):
        checks.enforce(plans.county_zone_gate(county, bad_zones, meta, S, 3, 2, ("1", 7, 28.0, 38.0)))
    with pytest.raises(checks.GateFailed, match="county: no duplicate key"):
        checks.enforce(checks.check_shape(county.union(county.limit(1)), "fips", 3, 4, "county"))


def test_rollup_gate_sees_null_against_value(county, zones):
    filled = zones.withColumn("ppt", F.coalesce("ppt", F.lit(0.0)))
    got = {r.check: r.observed for r in checks.check_rollup(county, filled, ["cz_id", "date"], VALUES).collect()}
    assert got["roll-up reproduces: ppt"] == 1.0 and got["roll-up reproduces: tmax"] == 0.0
    missing = zones.filter("cz_id = '1'")
    got = {r.check: r.observed for r in checks.check_rollup(county, missing, ["cz_id", "date"], VALUES).collect()}
    assert got["roll-up reproduces: same keys"] == 4.0


def test_rules_limits(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)] * 99 + [(3.0, 2.0, 3.0)] + [(None, 9.0, 1.0)], "tmin double, tmean double, tmax double")
    assert not checks.check_rules(df, checks.order_rule(), "x").first().passed  # exactly 1 % is too many
    assert checks.check_rules(df.union(df.limit(5)), checks.order_rule(), "x").first().passed
    empty = df.filter("tmin > 100")
    assert checks.check_rules(empty, checks.order_rule(), "x").first().passed


def test_dew_point_rules_differ(spark):
    df = spark.createDataFrame([(15.0, 10.0, 20.0)], "tdmean double, tmean double, tmax double")
    assert checks.check_rules(df, checks.physical_rules(df.columns), "c").first().passed
    assert not checks.check_rules(df, checks.physical_rules(df.columns, postal=True), "p").first().passed


def test_negative_rain_inside_range_but_not_physical(spark):
    df = spark.createDataFrame([(-0.05,)], "ppt double")
    assert checks.check_rules(df, checks.range_rules(df.columns), "c").first().passed
    assert not checks.check_rules(df, checks.physical_rules(df.columns), "c").first().passed


def test_era_panel_and_gate(spark, long, meta, county):
    eras = spark.createDataFrame([("e1", d(0), d(1)), ("e2", d(2), d(3))], "era string, start_date date, end_date date")
    zone_meta = spark.createDataFrame(
        [("e1", "48001", 1.0, "48001"), ("e1", "48003", 2.0, "48001"), ("e2", "48001", 1.0, "48001")],
        "era string, zone_id string, area_km2 double, county_fips string",
    )
    facts = long.withColumnRenamed("fips", "zone_id").withColumn("era", F.when(F.col("date") < F.lit(d(2)), "e1").otherwise("e2"))
    s = plans.PanelSettings(as_of=date(2024, 7, 15), variables=fv.POSTAL_VARIABLES)
    panel = plans.era_panel(facts, zone_meta, eras, s)
    assert panel.count() == 6 and "ppt" not in panel.columns
    gate = plans.era_gate(panel, zone_meta, eras, county, s)
    assert checks.enforce(gate) == []
    moved = panel.withColumn("date", F.date_add("date", 1))
    failed = {r.check for r in plans.era_gate(moved, zone_meta, eras, county, s).collect() if not r.passed}
    assert {"e1: date range", "e2: date range", "e1: no row outside its dates", "e2: no row outside its dates"} <= failed
    gone = checks.check_era_shape(panel.filter("era = 'e1'"), eras, zone_meta).collect()
    assert {r.check for r in gone if not r.passed} >= {"e2: days", "e2: rows = zones x days"}


def test_cross_panel_tolerance(spark):
    fine = spark.createDataFrame([("f", d(0), 10.0, 1.0), ("f", d(0), 20.0, 3.0), ("f", d(1), None, 1.0)], "county_fips string, date date, tmax double, area_km2 double")
    coarse = spark.createDataFrame([("f", d(0), 19.1), ("g", d(0), 1.0)], "fips string, date date, tmax double")
    r = checks.check_cross_panel(fine, coarse).first()
    assert not r.passed and r.observed == 1.0
    assert checks.check_cross_panel(fine, coarse.withColumn("tmax", F.lit(18.5))).first().passed


def test_bands_meta_and_extract(spark, meta):
    df = spark.range(5)
    assert [checks.check_band(df, lo, hi, "n").first().passed for lo, hi in ((5, 5), (6, 9))] == [True, False]
    warn = checks.check_band(df, 6, 9, "n", "warning")
    assert checks.enforce(warn) == []
    assert [r.passed for r in checks.check_meta(meta, "fips", 3, ["cz_id"]).collect()] == [True, True]
    assert [r.passed for r in checks.check_meta(meta.withColumn("cz_id", F.lit(None)), "fips", 3, ["cz_id"]).collect()] == [True, False]
    ex = spark.createDataFrame([("z", d(0), 1.0), ("z", None, None)], "z string, date date, v double")
    got = {r.check: (r.passed, r.observed) for r in checks.check_extract(ex, "z", "v", 2, 1).collect()}
    assert got["extract: dates given"] == (False, 1.0) and got["extract: missing values"] == (True, 1.0)


def test_geography_gate_catches_double_zone(spark, meta, zones):
    twice = meta.union(spark.createDataFrame([("48001", "A", "2", "Y", 1.0)], meta.schema))
    failed = {r.check for r in checks.check_geography(twice, zones, 3, 2, 4).collect() if not r.passed}
    assert failed == {"geography: every county in one zone"}


def test_metadata_from_polygons(spark):
    square = lambda z, x: (z, 0, 0, [{"x": a, "y": b} for a, b in ((x, 30.0), (x + 1, 30.0), (x + 1, 31.0), (x, 31.0), (x, 30.0))])
    rings = spark.createDataFrame([square("48001", -100.0), square("48003", -99.0)], f"zone_id string, part int, ring int, pts array<{geometry.POINT}>")
    edges = geometry.ring_edges(rings)
    names = spark.createDataFrame([("48001", "A"), ("48003", "B")], "zone_id string, zone_name string")
    xw = spark.createDataFrame([("48001", "7", "Z"), ("48003", "7", "Z")], "fips string, cz_id string, cz_name string")
    counties = plans.county_metadata(edges, names, xw, "cb_2024")
    zones = plans.zone_metadata(edges, counties, "czone_2020").first()
    total = counties.agg(F.sum("area_km2")).first()[0]
    assert zones.area_km2 == pytest.approx(total) and zones.centroid_lon == pytest.approx(-99.0, abs=1e-6)
    assert (zones.cz_id, zones.cz_name, zones.geo_vintage) == ("7", "Z", "czone_2020")


def test_heat_index_panel(spark, rows):
    tmax = spark.createDataFrame([("10001", d(0), 305.15), ("10001", d(1), 305.15), ("9", d(0), 305.15)], "zone_id string, date date, tmax_k double")
    rh = spark.createDataFrame([("10001", d(0), 100.4), ("9", d(0), 60.0)], "zone_id string, date date, rh double")
    states = spark.createDataFrame([("10001", "NY")], "zone_id string, state string")
    got = rows(plans.heat_index_panel(tmax, rh, states), "zone_id", "date")
    assert got[0][:6] == ("10001", "NY", d(0), 2024, pytest.approx(32.0), 100.0) and got[0][6] > 32
    assert got[1][5:] == (None, None)
    assert got[2][1] is None and got[2][6] > 32
