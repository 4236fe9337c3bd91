"""Postal layers, validation, diagnostics, heat index and job planning from files to results."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from test_jobs import square

from zoneday import fixed_values as fv
from zoneday.operators import checks
from zoneday.plans import jobs
from zoneday.plans import weather as plans

START = date(2020, 12, 30)


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """County layers and both panels, written once."""
    root = tmp_path_factory.mktemp("jobs")
    p = lambda n: str(root / n)
    (root / "counties.json").write_text("\n".join([square("48001", -100, 30, label="A"), square("48003", -99, 30, label="B")]))
    (root / "cz.csv").write_text("FIPStxt,CountyName,StateName,CZ2020,CZName\n48001,A,Texas,1,X\n48003,B,Texas,2,Y\n")
    jobs.build_layers(spark, jobs.LayerFiles(p("counties.json"), p("cz.csv"), p("county_meta"), p("zone_meta")))
    (root / "ex").mkdir()
    for var, base in (("ppt", 0), ("tmin", 1), ("tmean", 5), ("tmax", 9), ("tdmean", 0)):
        for year in (2020, 2021):
            days = [START + timedelta(days=n) for n in range(4)]
            lines = [f"{f},{d},{base + i}" for d in days if d.year == year for i, f in enumerate(("48001", "48003")) if (f, d) != ("48003", START)]
            (root / "ex" / f"{var}_{year}.csv").write_text("\n".join([f"fips,date,{var}", *lines]) + "\n")
    s = plans.PanelSettings(as_of=date(2021, 1, 10), start=START, end=START + timedelta(days=3))
    f = jobs.PanelFiles(p("ex"), p("county_meta"), p("zone_meta"), p("county"), p("zone"))
    jobs.build_county_zone(spark, f, s, n_counties=2, n_zones=2)
    return p, f, s


def test_a_misshapen_panel_is_not_written(spark, made):
    p, f, s = made
    bad = jobs.PanelFiles(f.extracts, f.county_meta, f.zone_meta, p("county_bad"), p("zone_bad"))
    with pytest.raises(checks.GateFailed):
        jobs.build_county_zone(spark, bad, s, n_counties=3, n_zones=2)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(p("county_bad"))


def test_county_without_zone_stops_the_layers(spark, made, tmp_path):
    p, _, _ = made
    (tmp_path / "cz.csv").write_text("FIPStxt,CountyName,StateName,CZ2020,CZName\n48001,A,Texas,1,X\n")
    with pytest.raises(checks.GateFailed, match="has a commuting zone"):
        jobs.build_layers(spark, jobs.LayerFiles(p("counties.json"), str(tmp_path / "cz.csv"), p("m1"), p("m2")))


def test_postal_layers(spark, made, tmp_path):
    p, f, _ = made
    (tmp_path / "a.json").write_text("\n".join([square("77001", -99.9, 30.1, 0.3), square("77002", -98.7, 30.2, 0.4), square("88001", -103.5, 30.2, 0.4)]))
    (tmp_path / "b.json").write_text(square("77001", -99.9, 30.1, 0.3))
    files = jobs.PostalLayerFiles({"zcta510": str(tmp_path / "a.json"), "zcta520": str(tmp_path / "b.json")}, p("counties.json"), f.county_meta, p("postal_meta"))
    out = jobs.build_postal_layers(spark, files, band=(1, 2))
    assert {(r.era, r.zone_id, r.county_fips, r.cz_id) for r in out["meta"].collect()} == {
        ("zcta510", "77001", "48001", "1"), ("zcta510", "77002", "48003", "2"), ("zcta520", "77001", "48001", "1")
    }
    assert {tuple(r) for r in out["era_sets"].collect()} == {("77001", "both"), ("77002", "only_first")}
    assert out["no_county"].isEmpty()
    # a vintage's own id column wins over the general names
    both = square("77001", -99.9, 30.1, 0.3).replace('"GEOID":', '"ZCTA5CE20": "77009", "GEOID":')
    assert "ZCTA5CE20" in both
    (tmp_path / "c.json").write_text(both)
    own = jobs.PostalLayerFiles({"zcta520": str(tmp_path / "c.json")}, p("counties.json"), f.county_meta, p("postal_meta_own"))
    assert [r.zone_id for r in jobs.build_postal_layers(spark, own, band=(1, 1))["meta"].collect()] == ["77009"]
    with pytest.raises(checks.GateFailed, match="zcta520: areas"):
        jobs.build_postal_layers(spark, files, band=(2, 3))


def test_validation_and_diagnostics(spark, made):
    p, f, s = made
    gate = {r.check: r.passed for r in jobs.validate_county_zone(spark, f, s, 2, 2).collect()}
    assert not gate["county: coverage tmax 2020"] and gate["county: coverage tmax 2021"]
    out = jobs.diagnostics(spark, p("county"), p("zone"), p("zone_meta"), s.variables)
    assert {r.item: r.n for r in out["county_report"].collect() if r.item in ("rows", "zones", "calendar_days")} == {"rows": 8, "zones": 2, "calendar_days": 4}
    missing = {(r.variable, r.year): r.pct_missing for r in out["missing"].collect()}
    assert missing["tmax", 2020] == 25.0 and missing["tmax", 2021] == 0.0
    assert out["map"].count() == 2 and out["monthly_temperature"].count() == 2
    assert all(df.columns and df.count() >= 0 for df in out.values())


def test_postal_validation_explains_gaps(spark, made):
    p, _, _ = made
    eras = spark.createDataFrame([("zcta520", START, START + timedelta(days=1))], "era string, start_date date, end_date date")
    meta = spark.createDataFrame([("zcta520", "77001", 1.0, -99.0, 30.0, "48001", "A", "1", "X")],
        "era string, zone_id string, area_km2 double, centroid_lon double, centroid_lat double, county_fips string, county_name string, cz_id string, cz_name string")
    s = plans.PanelSettings(as_of=date(2021, 1, 10), variables=fv.POSTAL_VARIABLES)
    rows = [("77001", START, v, 5.0, "zcta520") for v in fv.POSTAL_VARIABLES]
    long = spark.createDataFrame(rows, "zone_id string, date date, var string, value double, era string")
    plans.era_panel(long, meta, eras, s).write.parquet(p("postal_panel"))
    log = spark.createDataFrame([("tmax", START + timedelta(days=1), "429", "x")], "var string, date date, http_code string, message string")
    for failures, passed in ((log, True), (log.limit(0), False)):
        out = jobs.validate_postal(spark, p("postal_panel"), p("county"), meta, eras, failures, s)
        got = {r.check: r.passed for r in out["gate"].collect()}
        assert got["postal: coverage tmax 2020"] is passed
        assert out["explained"].count() == int(passed)


def test_heat_index_job(spark, tmp_path):
    (tmp_path / "t.csv").write_text("zone_id,date,tmax_k\n1,2020-07-01,308.15\n2,2020-07-01,300\n")
    (tmp_path / "h.csv").write_text("zone_id,date,rh\n1,2020-07-01,120\n")
    (tmp_path / "s.csv").write_text("zone_id,state\n1,Texas\n2,Texas\n")
    got = jobs.build_heat_index(spark, *(str(tmp_path / n) for n in ("t.csv", "h.csv", "s.csv")), str(tmp_path / "out"))
    by = {r.zone_id: r for r in got.collect()}
    assert by["1"].rh == 100 and by["1"].tmax_c == pytest.approx(35.0) and by["1"].heat_index_c > 35 and by["2"].heat_index_c is None
    assert spark.read.option("header", "true").csv(str(tmp_path / "out")).count() == 2


def test_plan_downloads(spark, tmp_path):
    for day in ("20201229", "20201230", "20210103"):
        (tmp_path / f"grid_tmax_us_25m_{day}.bil").write_bytes(b"x")
    log = spark.createDataFrame([("tmax", date(2021, 1, 1)), ("tmax", date(2021, 1, 1))], "var string, date date")
    out = jobs.plan_downloads(spark, str(tmp_path), ["tmax", "tmin"], date(2020, 12, 29), date(2021, 1, 4), log)
    assert [tuple(r) for r in out["inventory"].collect()] == [("tmax", 3, 7, 42.9)]
    blocks = {tuple(r) for r in out["blocks"].collect()}
    assert blocks == {("tmax", date(2020, 12, 31), date(2021, 1, 2)), ("tmax", date(2021, 1, 4), date(2021, 1, 4)), ("tmin", date(2020, 12, 29), date(2021, 1, 4))}
    assert out["requests"].filter(F.col("var") == "tmin").count() == 2 and out["retry"].count() == 1
    assert out["invalid"].isEmpty()


def test_invalid_files_are_asked_for_again(spark, tmp_path):
    shapes = {"20201229": (3, 4, 12), "20201230": (2, 4, 8), "20201231": (3, 4, 11), "20210101": (None, None, 0), "20210102": (None, None, 5)}
    for day, (nrows, ncols, cells) in shapes.items():
        (tmp_path / f"grid_tmax_us_25m_{day}.bil").write_bytes(b"abcd" * cells)
        if nrows:
            (tmp_path / f"grid_tmax_us_25m_{day}.hdr").write_text(f"NROWS {nrows}\nNCOLS {ncols}\n")
    out = jobs.plan_downloads(spark, str(tmp_path), ["tmax"], date(2020, 12, 29), date(2021, 1, 2), min_shape=(3, 4))
    assert {r.path[-12:-4] for r in out["invalid"].collect()} == {"20201230", "20201231"}  # the empty one is missing without a word
    assert [tuple(r) for r in out["blocks"].collect()] == [("tmax", date(2020, 12, 30), date(2021, 1, 1))]
