"""The workflows end to end on small files."""

from __future__ import annotations

import json
from datetime import date, timedelta

import pytest

from zoneday import fixed_values as fv
from zoneday.operators import checks, geometry
from zoneday.plans import jobs
from zoneday.plans import weather as plans
from zoneday.sources import tables

CLAIM_HEAD = ",".join(n.replace(".", " ") for n in fv.CLAIM_COLUMNS)


def claim(day, bill, zip_, dob, gender, code, second=""):
    return f'{day},{bill},{zip_},{dob},{gender},M,,"$1,000.00",{code},{second},,,,1'


def test_claims_to_tables(spark, tmp_path, rows):
    (tmp_path / "sv1.csv").write_text(
        "\n".join(
            [
                CLAIM_HEAD,
                claim("7/1/2019", "a", "770021234", "1/1980", "F", "T67.0"),
                claim("7/1/2019", "b", "77002", "1/1980", "M", "M54.5"),
                claim("7/3/2019", "c", "77003", "1/1980", "", "M54.5", "T670"),
                claim("7/3/2019", "young", "77002", "1/2010", "F", "M54.5"),
            ]
        )
        + "\n"
    )
    (tmp_path / "sv2.csv").write_text("\n".join([CLAIM_HEAD, claim("1/5/2019", "d", "99999", "1/1950", "F", "")]) + "\n")
    (tmp_path / "zips.csv").write_text("ZIP,COUNTY,RES_RATIO\n77002,48201,0.9\n77002,48001,0.1\n77003,48001,1\n")
    (tmp_path / "cz.csv").write_text("FIPStxt,CountyName,StateName,CZ2020,CZName\n48201,Harris,Texas,219,Dallas area\n48001,A,Texas,7,West\n")
    months = [m.replace("_", " ").title() for m in fv.MONTH_COLUMNS]
    q3 = ["", "", "", "", "", "", "1,000", "1,000", "1,000", "", "", ""]
    row = lambda cells: ",".join(f'"{c}"' for c in cells)
    (tmp_path / "bls").mkdir()
    (tmp_path / "bls" / "allhlcn19.csv").write_text(
        row(["St", "Cnty", "Year", "Qtr", "Ownership", "Industry", *months]) + "\n"
        + row(["48", "201", "2019", "3", "Total Covered", "10 Total, all industries", *q3]) + "\n"
    )
    (tmp_path / "icd9.csv").write_text("dgns_cd,longdesc\n9920,Heat stroke\n")
    (tmp_path / "icd10.txt").write_text("T670    Heatstroke and sunstroke\nM545    \nS610    Sheath of tendon\n")
    p = lambda n: str(tmp_path / n)
    panel = jobs.build_claims(
        spark, jobs.ClaimFiles([p("sv1.csv"), p("sv2.csv")], p("zips.csv"), p("cz.csv"), p("bls"), p("clean"), p("panel"))
    )
    got = {(r.cz_id, r.date.day): (r.n_claims, r.emp_cz, r.claims_per_100k) for r in panel.collect()}
    assert got == {
        ("219", 1): (2, 1000.0, 200.0), ("219", 2): (0, 1000.0, 0.0), ("219", 3): (0, 1000.0, 0.0),
        ("7", 1): (0, None, None), ("7", 2): (0, None, None), ("7", 3): (1, None, None),
    }
    out = jobs.claim_tables(spark, p("clean"), p("panel"), p("icd9.csv"), p("icd10.txt"))
    assert rows(out["top_codes"].select("code", "n"), "code") == [("M54.5", 2), ("T67.0", 1)]
    assert rows(out["monthly_rate"].select("year", "month", "avg_claims_per_100k")) == [(2019, 7, 200.0)]
    assert [r.level for r in out["individual"].collect()] == ["", "", "Female", "Male", "Unknown", "Married"]
    assert out["seasonal_box"].count() == 1 and out["seasonal"].first().month_label == "Jul"
    heat = {r.ord: r.value for r in jobs.heat_summary(spark, p("clean"), p("cz.csv"), p("icd9.csv"), p("icd10.txt")).collect()}
    assert heat[0] == "4" and heat[1] == "2 (50.00%)" and heat[2] == "2 (50.00%)" and heat[7] == "1.50"


def square(name, x, y, side=1.0, label="N"):
    ring = [[x, y], [x + side, y], [x + side, y + side], [x, y + side], [x, y]]
    return json.dumps({"type": "Feature", "properties": {"GEOID": name, "NAME": label}, "geometry": {"type": "Polygon", "coordinates": [ring]}})


def test_layers_panels_and_gate(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    (tmp_path / "counties.json").write_text(
        "\n".join([square("48001", -100, 30, label="A"), square("48003", -99, 30, label="B"), square("48005", -97, 30, label="C"), square("35001", -104, 30)])
    )
    (tmp_path / "cz.csv").write_text("FIPStxt,CountyName,StateName,CZ2020,CZName\n48001,A,Texas,1,X\n48003,B,Texas,1,X\n48005,C,Texas,2,Y\n")
    edges = jobs.build_layers(spark, jobs.LayerFiles(p("counties.json"), p("cz.csv"), p("county_meta"), p("zone_meta")))
    meta = {r.fips: r for r in spark.read.parquet(p("county_meta")).collect()}
    assert sorted(meta) == ["48001", "48003", "48005"] and meta["48003"].cz_name == "X" and meta["48001"].geo_vintage == "cb_2024"
    zone = {r.cz_id: r for r in spark.read.parquet(p("zone_meta")).collect()}
    assert zone["1"].area_km2 == pytest.approx(meta["48001"].area_km2 + meta["48003"].area_km2)

    start = date(2020, 12, 30)
    s = plans.PanelSettings(as_of=date(2021, 1, 10), start=start, end=start + timedelta(days=3))
    (tmp_path / "ex").mkdir()
    for var, base in (("ppt", 0), ("tmin", 1), ("tmean", 5), ("tmax", 9), ("tdmean", 0)):
        for year in (2020, 2021):
            lines = [f"fips,date,{var}"]
            for n in range(4):
                day = start + timedelta(days=n)
                if day.year == year:
                    lines += [f"{f},{day},{base + i}" for i, f in enumerate(sorted(meta)) if (f, n) != ("48003", 1)]
            (tmp_path / "ex" / f"{var}_{year}.csv").write_text("\n".join(lines) + "\n")
    gate = jobs.build_county_zone(
        spark, jobs.PanelFiles(p("ex"), p("county_meta"), p("zone_meta"), p("county"), p("zone")), s, n_counties=3, n_zones=2
    )
    assert checks.enforce(gate) == []
    panel = spark.read.parquet(p("zone"))
    gap = panel.filter("cz_id = '1' and date = date '2020-12-31'").first()
    assert gap.tmax == 9.0 and gap.n_counties == 2 and gap.stability == "early"
    with pytest.raises(checks.GateFailed):
        jobs.build_county_zone(spark, jobs.PanelFiles(p("ex"), p("county_meta"), p("zone_meta"), p("c2"), p("z2")), s)

    # postal areas: one inside A, one mostly in B, one outside the state
    (tmp_path / "areas.json").write_text("\n".join([square("77001", -99.9, 30.1, 0.3), square("77002", -99.2, 30.2, 0.6), square("88001", -103.5, 30.2, 0.4)]))
    from zoneday.sources import polygons

    areas = geometry.ring_edges(polygons.read_polygons(spark, p("areas.json")))
    made = plans.postal_metadata(areas, edges, spark.read.parquet(p("county_meta")), "zcta520")
    got = {r.zone_id: (r.county_fips, r.county_name, r.cz_id, r.era) for r in made.collect()}
    assert got == {"77001": ("48001", "A", "1", "zcta520"), "77002": ("48003", "B", "1", "zcta520")}

    (tmp_path / "px").mkdir()
    for var in fv.POSTAL_VARIABLES:
        (tmp_path / "px" / f"{var}_zcta520_202012.csv").write_text(f"zcta5,date,{var}\n77001,2020-12-30,5\n77002,2020-12-30,6\n")
    eras = spark.createDataFrame([("zcta520", start, start + timedelta(days=1))], "era string, start_date date, end_date date")
    s2 = plans.PanelSettings(as_of=date(2021, 1, 10), variables=fv.POSTAL_VARIABLES)
    postal = jobs.build_postal(spark, p("px"), made, eras, s2, p("postal"))
    assert postal.count() == 4 and postal.filter("tmax is null").count() == 2
    assert postal.filter("zone_id = '77002'").first().county_fips == "48003"

    # a panel that lacks an era is not published; the old one stays
    more = eras.unionAll(spark.createDataFrame([("zcta530", start + timedelta(days=2), start + timedelta(days=3))], eras.schema))
    with pytest.raises(checks.GateFailed, match="zcta530: days"):
        jobs.build_postal(spark, p("px"), made, more, s2, p("postal"))
    assert tables.read_panel(spark, p("postal")).count() == 4
    # the published vintages are the eras where none are given
    assert [(r.era, str(r.start_date)) for r in plans.vintage_eras(spark).collect()] == [("zcta510", "2010-01-01"), ("zcta520", "2020-01-01")]
