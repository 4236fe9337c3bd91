from __future__ import annotations

import json
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneday.functions.clean import quarter_average
from zoneday.operators import manifest, raster
from zoneday.sources import polygons, rasters, sinks, tables


def test_claims_files_with_differing_headers(spark, tmp_path, rows):
    head = (
        "Bill Selection Date,Bill ID,Employee Mailing Postal Code,Employee Date of Birth,Employee Gender Code,"
        "Employee Marital Status Code,Employee Date of Injury,Total Charge Per Bill,First ICD-9CM or ICD-10CM Diagnosis Code,"
        "Second ICD-9CM or ICD-10CM Diagnosis Code,Third ICD-9CM or ICD-10CM Diagnosis Code,Fourth ICD-9CM or ICD-10CM Diagnosis Code,"
        "Fifth ICD-9CM or ICD-10CM Diagnosis Code,Facility Postal Code"
    )
    a = head + '\n1/2/2020,b1,770021234,7/1980,F,M,,"$1,234.50",M54.5,,,,,77002\n'
    b = "Extra," + head.replace("-", "/") + "\nx,01/02/2020 00:00:00,b2,77003,13/1980,,,,10,S1,,,,,1\ny,3/4/2020,b3,7,01/1990,NA,K,,bad,,,,,,\n"
    (tmp_path / "a.csv").write_text(a)
    (tmp_path / "b.csv").write_text(b)
    raw = tables.read_claims(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert len(raw.columns) == 14 and raw.count() == 3
    geo = spark.createDataFrame([("77002", "48201", "219")], "zip string, fips string, cz_id string")
    got = rows(
        tables.clean_claims(raw, geo).select("bill_id", "zip", "bill_date", "charge", "gender", "icd1", "icd2", "cz_id"), "bill_id"
    )
    # the impossible birth month drops b2; b3 keeps an unmapped ZIP and a NULL charge and gender
    assert got == [
        ("b1", "77002", date(2020, 1, 2), 1234.5, "F", "M54.5", None, "219"),
        ("b3", "7", date(2020, 3, 4), None, None, None, None, None),
    ]


def test_employment_sheets(spark, tmp_path, rows):
    months = ["January\nEmployment", "February  Employment", "March Employment"] + [f"{m} Employment" for m in ("April", "May", "June", "July", "August", "September", "October", "November", "December")]
    head = ["St", "Cnty", "Year", "Qtr", "Ownership", "Industry", *months]
    q = lambda cells: ",".join(f'"{c}"' for c in cells)
    (tmp_path / "2020").mkdir()
    (tmp_path / "2020" / "allhlcn20.csv").write_text(
        q(head) + "\n" + q(["48", "001", "2020", "1", "Total Covered ", "10 Total, all industries", "1,000", "2,000", "3,000", *[""] * 9]) + "\n"
        + q(["48", "001", "2020", "1", "Private", "10 Total, all industries", "1", "1", "1", *[""] * 9]) + "\n"
        + q(["06", "001", "2020", "1", "Total Covered", "10 Total, all industries", "1", "1", "1", *[""] * 9]) + "\n"
    )
    (tmp_path / "allhlcn21.csv").write_text(
        q([*head, "Status Code"]) + "\n" + q(["48", "1", "2021", "4", "total covered", "Total, All Industries", *[""] * 9, "5", "", "7", "N"]) + "\n"
    )
    (tmp_path / "other.csv").write_text("x\n1\n")
    raw = tables.read_employment(spark, str(tmp_path))
    assert "january_employment" in raw.columns and "status_code" in raw.columns
    got = tables.clean_employment(raw).select("fips", "year", "qtr", quarter_average("qtr"))
    assert rows(got, "fips") == [("00481", 2021, 4, None), ("48001", 2020, 1, 2000.0)]
    with pytest.raises(FileNotFoundError):
        tables.read_employment(spark, str(tmp_path), "nothing")


def test_sheets_of_many_layouts_in_one_pass(spark, tmp_path, rows):
    for i in range(12):  # every sheet another order of columns and another column more
        names = ["a", f"x{i}", "b B"][i % 3 :] + ["a", f"x{i}", "b B"][: i % 3]
        cell = {"a": f'"{i}, ""q""\nend"', f"x{i}": "", "b B": f" v{i}"}
        (tmp_path / f"s{i}.csv").write_text("\ufeff" * (i % 2) + ",".join(names) + "\r\n\r\n" + ",".join(cell[n] for n in names) + "\r\n")
    (tmp_path / "s_head.csv").write_text("a\n")
    (tmp_path / "s_none.csv").write_text("")
    (tmp_path / "s_short.csv").write_text(f"b b,a\n{'y' * 200_000}\n")
    df = tables.read_sheets(spark, str(tmp_path), "s*.csv", ["a", "b_b", "x3", "gone"])
    want = [(f'{i}, "q"\nend', f" v{i}", None, None) for i in range(12)] + [(None, "y" * 200_000, None, None)]
    assert sorted(rows(df), key=str) == sorted(want, key=str)
    with pytest.raises(FileNotFoundError):
        tables.read_sheets(spark, str(tmp_path / "nowhere"), "s*.csv", ["a"])


def test_fixed_width_and_crosswalk(spark, tmp_path, rows):
    (tmp_path / "icd.txt").write_text("A000    Cholera due to Vibrio  \nT670XXA Heatstroke and sunstroke, initial encounter\n")
    assert rows(tables.read_icd10(spark, str(tmp_path / "icd.txt")), "code") == [
        ("A000", "Cholera due to Vibrio"),
        ("T670XXA", "Heatstroke and sunstroke, initial encounter"),
    ]
    (tmp_path / "cz.csv").write_text("FIPStxt,CountyName,StateName,CZ2020,CZName\n01001,A,Alabama,7,X\n1003,B,Alabama,08,Y\n")
    assert rows(tables.read_crosswalk(spark, str(tmp_path / "cz.csv")), "fips") == [
        ("01001", "A", "Alabama", "7", "X"),
        ("01003", "B", "Alabama", "08", "Y"),
    ]


def test_extracts_skip_stray_files(spark, tmp_path, rows):
    (tmp_path / "tmax_2023.csv").write_text("fips,date,tmax\n01001,2023-01-01,1.5\n48001,2023-01-02,NaN\n48001,bad,2\n")
    (tmp_path / "tmax_2023_test.csv").write_text("fips,date,tmax\n01001,2023-01-01,9\n")
    (tmp_path / "tmean_2023.csv").write_text("fips,date,tmean\n01001,2023-01-01,\n")
    got = rows(tables.read_extracts(spark, str(tmp_path), ["tmax", "tmean"], "fips"), "var", "date", "fips")
    assert got == [
        ("48001", None, "tmax", 2.0),
        ("01001", date(2023, 1, 1), "tmax", 1.5),
        ("48001", date(2023, 1, 2), "tmax", None),
        ("01001", date(2023, 1, 1), "tmean", None),
    ]
    (tmp_path / "tmin_zcta510_202301.csv").write_text("zcta5,date,tmin\n77002,2023-01-01,4\n")
    era = tables.read_extracts(spark, str(tmp_path), ["tmin"], "zcta5", r"[a-z0-9]+_\d{6}")
    assert rows(era) == [("77002", date(2023, 1, 1), "tmin", 4.0)]


def test_failure_log_appends(spark, tmp_path, rows):
    path = str(tmp_path / "log")
    one = spark.createDataFrame([("tmax", date(2020, 1, 1), "429", "HTTP, 429")], tables.FAILURE_SCHEMA)
    sinks.append_failures(one, path)
    sinks.append_failures(one.withColumn("http_code", F.lit("exception")), path)
    got = rows(tables.read_failures(spark, path), "http_code")
    assert got == [("tmax", date(2020, 1, 1), "429", "HTTP, 429"), ("tmax", date(2020, 1, 1), "exception", "HTTP, 429")]
    assert manifest.retry_manifest(tables.read_failures(spark, path)).count() == 1


# ---- rasters -------------------------------------------------------------


def grid_file(folder, name, values):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(np.asarray(values, "<f4").tobytes())


def test_catalog_and_decode(spark, tmp_path, rows):
    shape = (3, 4)
    day1 = np.arange(12, dtype="f4").reshape(shape)
    day1[0, 1], day1[2, 3] = -9999, np.nan
    grid_file(tmp_path / "grid_tmax_us_25m_20200101", "grid_tmax_us_25m_20200101.bil", day1)
    grid_file(tmp_path / "GRID_tmax_stable_4kmD2_20200102_bil", "GRID_tmax_stable_4kmD2_20200102_bil.bil", day1 + 100)
    grid_file(tmp_path / "grid_tmax_us_25m_20200103", "grid_tmax_us_25m_20200103.bil", day1[:2])
    grid_file(tmp_path / "grid_tmin_us_25m_20200101", "grid_tmin_us_25m_20200101.bil", day1 - 50)
    grid_file(tmp_path / "grid_tmax_us_25m_20190101", "grid_tmax_us_25m_20190101.bil", day1)
    grid_file(tmp_path / "tmax" / "2020", "grid_tmax_tx_30s_20200105.tif", day1)
    (tmp_path / "grid_tmax_us_25m_20200104").mkdir()
    (tmp_path / "grid_tmax_us_25m_20200104" / "grid_tmax_us_25m_20200104.bil").write_bytes(b"")
    (tmp_path / "grid_tmax_us_25m_20200101" / "grid_tmax_us_25m_20200101.hdr").write_text(
        "BYTEORDER I\nNROWS 3\nNCOLS 4\nNBITS 32\nULXMAP -99.75\nULYMAP 39.875\nXDIM 0.5\nYDIM 0.25\nNODATA -9999\n"
    )
    cat = rasters.raster_catalog(spark, str(tmp_path), ["tmax", "tmin"], date(2020, 1, 1), date(2020, 12, 31))
    assert rows(cat.select("var", "date", "length"), "var", "date") == [
        ("tmax", date(2020, 1, 1), 48),
        ("tmax", date(2020, 1, 2), 48),
        ("tmax", date(2020, 1, 3), 32),
        ("tmax", date(2020, 1, 5), 48),
        ("tmin", date(2020, 1, 1), 48),
    ]
    assert manifest.valid_files(cat, 48).count() == 4
    header = str(tmp_path / "grid_tmax_us_25m_20200101" / "grid_tmax_us_25m_20200101.hdr")
    grid = rasters.read_grid_header(spark, header)
    assert (grid.x0, grid.y0, grid.nrows, grid.ncols) == (-100.0, 40.0, 3, 4)
    files = rasters.read_raster_bytes(spark, str(tmp_path), ["tmax"])
    with pytest.raises(Exception, match="grid cut short: tmax 2020-01-03"):
        rasters.decode_bil(files, grid).collect()
    files = files.filter("length(content) >= 48")
    lines = rasters.decode_bil(files.filter("year(date) = 2020"), grid)
    got = {(r.date.day, r.row): r["values"] for r in lines.collect()}
    assert sorted(got) == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (2, 2)]
    assert got[1, 0] == [0.0, None, 2.0, 3.0] and got[1, 2] == [8.0, 9.0, 10.0, None] and got[2, 1] == [104.0, 105.0, 106.0, 107.0]
    cut = rasters.decode_bil(files.filter("year(date) = 2020"), grid, window=(1, 2, 1, 2))
    assert {(r.date.day, r.row): r["values"] for r in cut.collect()}[1, 1] == [9.0, 10.0]


def test_decode_feeds_the_zonal_mean(spark, tmp_path):
    values = np.array([[1, 2], [3, -9999]], "f4")
    grid_file(tmp_path, "grid_tmax_us_25m_20200101.bil", values)
    grid = raster.GridSpec(0.0, 2.0, 1.0, 1.0, 2, 2)
    lines = rasters.decode_bil(rasters.read_raster_bytes(spark, str(tmp_path), ["tmax"]), grid)
    weights = spark.createDataFrame([("z", r, c, 1.0) for r in range(2) for c in range(2)], "zone_id string, row int, col int, cov double")
    assert raster.zonal_mean(lines, weights).first().value == 2.0


# ---- polygons ------------------------------------------------------------


def test_geojson_lines_and_collections(spark, tmp_path, rows):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    features = [
        {"type": "Feature", "properties": {"GEOID": "1001", "NAME": "A"}, "geometry": {"type": "Polygon", "coordinates": [ring, ring]}},
        {"type": "Feature", "properties": {"GEOID": "48003", "NAME": "B"}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}},
        {"type": "Feature", "properties": {"GEOID": "48005", "NAME": "C"}, "geometry": {"type": "Point", "coordinates": [0, 0]}},
    ]
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(f) for f in features))
    (tmp_path / "all.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    want = [("01001", "A", 0, 0), ("01001", "A", 0, 1), ("48003", "B", 0, 0), ("48003", "B", 1, 0)]
    for name, collection in (("lines.json", False), ("all.json", True)):
        got = polygons.read_polygons(spark, str(tmp_path / name), collection)
        assert rows(got.select("zone_id", "zone_name", "part", "ring"), "zone_id", "part", "ring") == want
        assert [tuple(p) for p in got.first().pts] == [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    (tmp_path / "z.json").write_text(json.dumps({"type": "Feature", "properties": {"ZCTA5CE20": "501"}, "geometry": features[0]["geometry"]}))
    assert polygons.read_polygons(spark, str(tmp_path / "z.json")).first().zone_id == "00501"
    (tmp_path / "no.json").write_text(json.dumps({"type": "Feature", "properties": {"NAME": "x"}, "geometry": features[0]["geometry"]}))
    with pytest.raises(Exception, match="polygon without any of"):
        polygons.read_polygons(spark, str(tmp_path / "no.json")).collect()


# ---- sinks ---------------------------------------------------------------


def test_panel_files_are_ordered_and_partitioned(spark, tmp_path, rows):
    df = spark.createDataFrame([(z, date(y, 1, d), 1.0) for z in "cab" for y in (2021, 2020) for d in (2, 1)], "fips string, date date, v double")
    path = tmp_path / "panel"
    sinks.write_panel(df, str(path), "fips")
    assert sorted(p.name for p in path.iterdir() if p.is_dir()) == ["year=2020", "year=2021"]
    back = tables.read_panel(spark, str(path))
    assert back.count() == 12
    for f in path.glob("year=2020/*.parquet"):
        keys = [(r.fips, r.date) for r in spark.read.parquet(str(f)).collect()]
        assert keys == sorted(keys)
    sinks.write_panel(df.filter("date >= '2021-01-01'"), str(path), "fips")
    assert tables.read_panel(spark, str(path)).count() == 6
    sinks.write_csv(df, str(tmp_path / "csv"), ["fips", "date"])
    report = sinks.sink_report(df, str(tmp_path / "csv"), str(path)).first()
    assert (report.n_rows, report.n_columns) == (12, 3) and report.csv_bytes > 0 and report.parquet_bytes > 0


def test_extract_sink_resumes(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    make = lambda value, days: spark.createDataFrame(
        [("tmax", str(d.year), d, "z", value) for d in days], "var string, period string, date date, zone_id string, value double"
    )
    first, second, third = date(2019, 1, 1), date(2019, 1, 2), date(2020, 1, 1)
    sinks.write_extracts(make(1.0, [first]), path, ["zone_id"])
    sinks.write_extracts(make(2.0, [first, second, third]), path, ["zone_id"])
    sinks.write_extracts(make(3.0, [first, second, third]), path, ["zone_id"])
    back = spark.read.parquet(path).select("date", "value")
    assert rows(back, "date") == [(first, 1.0), (second, 2.0), (third, 2.0)]
    jobs = spark.createDataFrame([("tmax", third), ("tmax", date(2020, 1, 2))], "var string, date date")
    assert rows(sinks.pending_extracts(jobs, path)) == [("tmax", date(2020, 1, 2))]


def test_extraction_from_files_to_periods(spark, tmp_path, rows):
    from zoneday.plans.extraction import extract_zones, layer_weights

    grid = raster.GridSpec(x0=-100.0, y0=31.0, dx=0.25, dy=0.25, nrows=4, ncols=4)
    bbox = (-99.75, 30.25, -99.0, 31.0)  # the right three columns of the upper three rows
    base = np.arange(16, dtype="f4").reshape(4, 4)
    base[1, 2] = -9999
    src, out = tmp_path / "in", str(tmp_path / "out")
    for day in ("20191231", "20200101", "20200102"):
        grid_file(src, f"grid_tmax_us_25m_{day}.bil", base + (0 if day[:4] == "2019" else 100) * (base != -9999))
    grid_file(src, "grid_tmax_us_25m_20200103.bil", base[:2])
    ring = [(-99.625, 30.5), (-99.25, 30.5), (-99.25, 30.75), (-99.625, 30.75)]
    from zoneday.operators import geometry

    edges = geometry.ring_edges(
        spark.createDataFrame([("z", 0, 0, [{"x": x, "y": y} for x, y in [*ring, ring[0]]])], f"zone_id string, part int, ring int, pts array<{geometry.POINT}>")
    )
    weights = layer_weights(edges, grid, bbox)
    # half of cell (1, 1) and all of cell (1, 2), whose value is missing
    assert rows(weights, "col") == [("z", 1, 0, 1, 0.5), ("z", 1, 1, 1, 1.0)]
    run = lambda last: extract_zones(spark, str(src), ["tmax"], date(2019, 1, 1), last, grid, weights, out, bbox)
    assert run(date(2019, 12, 31)).count() == 1
    got = rows(run(date(2020, 12, 31)).select("date", "status"), "date")
    assert got == [(date(2020, 1, 1), "read"), (date(2020, 1, 2), "read"), (date(2020, 1, 3), "too short")]
    assert rows(run(date(2020, 12, 31)).select("date", "status")) == [(date(2020, 1, 3), "too short")]
    with pytest.raises(ValueError, match="20200103"):
        extract_zones(spark, str(src), ["tmax"], date(2019, 1, 1), date(2020, 12, 31), grid, weights, out, bbox, strict=True)
    back = spark.read.parquet(out).select("zone_id", "date", "value")
    want = [("z", date(2019, 12, 31), 5.0), ("z", date(2020, 1, 1), 105.0), ("z", date(2020, 1, 2), 105.0)]
    assert rows(back, "date") == want
    # the grid is repaired: its day arrives, in a period that already has days
    grid_file(src, "grid_tmax_us_25m_20200103.bil", base + 200 * (base != -9999))
    assert rows(run(date(2020, 12, 31)).select("date", "status")) == [(date(2020, 1, 3), "read")]
    assert run(date(2020, 12, 31)).isEmpty()
    back = spark.read.parquet(out).select("zone_id", "date", "value")
    assert rows(back, "date") == [*want, ("z", date(2020, 1, 3), 205.0)]
    # a provisional day is issued again: its value changes once, and its period alone is written
    import os

    old = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*2019*/*.parquet")}
    revised = next(src.rglob("grid_tmax_us_25m_20200102.bil"))
    grid_file(src, "grid_tmax_us_25m_20200102.bil", base + 300 * (base != -9999))
    os.utime(revised, (2_000_000_000, 2_000_000_000))
    spark.catalog.refreshByPath(str(src))
    assert rows(run(date(2020, 12, 31)).select("date", "status")) == [(date(2020, 1, 2), "read")]
    assert run(date(2020, 12, 31)).isEmpty()
    spark.catalog.refreshByPath(out)
    back = spark.read.parquet(out).select("zone_id", "date", "value")
    assert rows(back, "date") == [*want[:2], ("z", date(2020, 1, 2), 305.0), ("z", date(2020, 1, 3), 205.0)]
    assert old and old == {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*2019*/*.parquet")}


def test_quoted_text_and_extract_report(spark, tmp_path, rows):
    (tmp_path / "icd9.csv").write_text('dgns_cd,longdesc,more\n1,"Injury, ""crush"", of hand",x\n2,"a \\ b",y\n')
    assert rows(tables.read_icd9(spark, str(tmp_path / "icd9.csv")), "code") == [("1", 'Injury, "crush", of hand'), ("2", "a \\ b")]
    sinks.write_csv(spark.createDataFrame([('say "no", twice', 1)], "t string, n int"), str(tmp_path / "csv"))
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("part-*"))
    assert '"say ""no"", twice",1' in text
    ex = tmp_path / "ex"
    ex.mkdir()
    (ex / "tmax_2019.csv").write_text("fips,date,tmax\n1001,2019-01-01,5\n")
    (ex / "tmax_2020.csv").write_text("fips,date,tmax\n1001,2020-01-01,5\n1001,soon,5\n")
    (ex / "tmax_2021.csv").write_text("fips,date,tmax\n")
    (ex / "tmax_2020_test.csv").write_text("fips,date,tmax\n1001,2020-01-01,5\n")
    (ex / "tmin_2022.csv").write_bytes(b"fips,date,tmin\n1001,2022-01-01,3\n")
    got = rows(tables.extract_report(spark, str(ex), ["tmax", "tmin"], "fips"), "file")
    assert got == [
        ("tmax_2019.csv", 1, 0, "read"), ("tmax_2020.csv", 2, 1, "damaged"), ("tmax_2020_test.csv", 0, 0, "stray"),
        ("tmax_2021.csv", 0, 0, "skipped"), ("tmin_2022.csv", 1, 0, "read"),
    ]
    assert tables.read_extracts(spark, str(ex), ["tmax", "tmin"], "fips").count() == 4


def test_scanline_table_layout(spark, tmp_path):
    lines = spark.createDataFrame(
        [("tmax", date(y, 1, d), r, [1.0]) for y in (2020, 2021) for d in (1, 2) for r in (1, 0)],
        "var string, date date, row int, values array<float>",
    )
    sinks.write_scanlines(lines, str(tmp_path / "grid"))
    back = spark.read.parquet(str(tmp_path / "grid"))
    assert back.count() == 8
    plan = back.filter("row between 0 and 0 and year = 2020")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(row,0)" in plan and "year" in plan.split("PartitionFilters")[1]
