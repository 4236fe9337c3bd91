"""Month stacks, the grid data source and stores that are joined where they lie."""

from __future__ import annotations

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneday.operators import raster, stacks
from zoneday.sources import grids, rasters

HEAD = "BYTEORDER I\nNROWS {}\nNCOLS {}\nNBANDS 1\nNBITS 32\nULXMAP 0.5\nULYMAP 9.5\nXDIM 1\nYDIM 1\nNODATA -9999\n"


def cells_of(rng, days, nrows=6, ncols=11, drop=0.2):
    start = date(2020, 1, 20)
    return [
        (v, start + timedelta(days=d), r, c, round(rng.uniform(-5, 5), 3))
        for v in ("p", "t") for d in range(days) for r in range(nrows) for c in range(ncols) if rng.random() > drop
    ]


def runs_of(spark, rng, nrows=6, ncols=13):
    rows = []
    for z in ("a", "b", "c"):
        for r in range(nrows):
            col = rng.randrange(3)
            while col < ncols:
                n = min(rng.choice([1, 1, 2, 5]), ncols - col)
                rows.append((z, r, col, n, 1.0 if n > 1 else round(rng.random(), 3)))
                col += n + rng.randrange(4)
    return spark.createDataFrame(rows, "zone_id string, row int, col int, n int, cov double")


@pytest.mark.parametrize("width", [4, 64])
def test_stacked_means_equal_daily_ones(spark, width):
    rng = random.Random(width)
    cells = spark.createDataFrame(cells_of(rng, 25), "var string, date date, row int, col int, value double")
    lines = raster.cells_to_scanlines(cells, 11)
    runs = runs_of(spark, rng, ncols=11)
    want = {(r.zone_id, r.var, r.date): r.value for r in raster.zonal_mean(lines, runs).collect()}
    got = {(r.zone_id, r.var, r.date): r.value for r in stacks.zonal_mean_stacked(stacks.stack_lines(lines, width), stacks.weight_tiles(runs, width=width)).collect()}
    assert len(want) == 3 * 2 * 25 and got == pytest.approx(want, rel=1e-9)


def test_missing_days_outside_runs_and_repeated_grids(spark):
    lines = spark.createDataFrame(
        [("v", date(2020, 1, 1), 0, [1.0, None, 3.0]), ("v", date(2020, 1, 2), 0, [None, None, 3.0]), ("v", date(2020, 2, 1), 0, [2.0, 2.0, 2.0]), ("v", date(2020, 2, 1), 0, [4.0, 4.0, 4.0]),
         ("v", date(2020, 2, 2), 0, None), ("v", date(2020, 2, 3), 0, [])],
        "var string, date date, row int, values array<float>",
    )
    runs = spark.createDataFrame([(7, 0, 0, 1, 1.0), (7, 0, 1, 1, 0.5), (7, 0, 2, 0, 1.0), (8, 0, 0, 1, 0.25), (8, 0, 2, 9, 0.75), (9, 0, 8, 2, 1.0)], "zone_id int, row int, col int, n int, cov double")
    got = {(r.zone_id, r.date): r.value for r in stacks.zonal_mean_stacked(stacks.stack_lines(lines), stacks.weight_tiles(runs)).collect()}
    d = [date(2020, 1, 1), date(2020, 1, 2), date(2020, 2, 1)]
    assert {k: v for k, v in got.items() if k[0] != 9} == {(7, d[0]): 1.0, (7, d[1]): None, (7, d[2]): 3.0, (8, d[0]): 2.5, (8, d[1]): 3.0, (8, d[2]): 3.0}
    assert all(v is None for k, v in got.items() if k[0] == 9)
    with pytest.raises(Exception, match="differ in length"):
        bad = spark.createDataFrame([("v", d[0], 0, [1.0, 2.0]), ("v", d[1], 0, [1.0])], lines.schema)
        stacks.zonal_mean_stacked(stacks.stack_lines(bad), stacks.weight_tiles(runs)).collect()


def write_grids(folder, days, nrows=8, ncols=40, var="tmax"):
    out = {}
    for k in range(days):
        day = date(2020, 1, 30) + timedelta(days=k)
        values = (np.arange(nrows * ncols, dtype="<f4") + 1000 * k).reshape(nrows, ncols)
        values[2, 5] = -9999
        folder.mkdir(parents=True, exist_ok=True)
        name = f"grid_{var}_us_25m_{day:%Y%m%d}"
        (folder / f"{name}.bil").write_bytes(values.tobytes())
        (folder / f"{name}.hdr").write_text(HEAD.format(nrows, ncols))
        out[day] = np.where(values == -9999, np.nan, values)
    return out


def test_window_read_equals_the_files(spark, tmp_path):
    want = write_grids(tmp_path / "tmax" / "2020", 4)
    write_grids(tmp_path / "tmin", 1, var="tmin")
    (tmp_path / "tmax" / "notes.bil").write_bytes(b"")
    (tmp_path / "tmax" / "grid_tmax_us_25m_20209999.bil").write_bytes(b"")
    df = grids.read_lines(spark, str(tmp_path), ["tmax", "tmin"], (1, 4, 3, 6))
    rows = {(r.var, r.date, r.row): r["values"] for r in df.collect()}
    assert len(rows) == 4 * 5
    for (v, d, k), values in rows.items():
        np.testing.assert_array_equal(np.array(values, dtype=float), want[d][1 + k, 3:9])
    # several queries of one DataFrame see their own rows
    one, two = df.filter("var = 'tmax' and row = 1"), df.filter("row >= 2")
    assert (one.count(), two.count(), df.count(), one.union(two).count()) == (4, 10, 20, 14)
    late = grids.read_lines(spark, str(tmp_path), ["tmax"], start=date(2020, 1, 31), end=date(2020, 2, 1))
    assert sorted({r.date for r in late.collect()}) == [date(2020, 1, 31), date(2020, 2, 1)] and late.count() == 16
    assert grids.read_lines(spark, str(tmp_path), ["ppt"]).count() == 0
    assert grids.read_stacks(spark, str(tmp_path), ["ppt"]).count() == 0


def test_only_the_windows_bytes_are_read(tmp_path):
    write_grids(tmp_path / "tmax", 3)
    write_grids(tmp_path / "tmin", 3, var="tmin")
    options = {"path": str(tmp_path), "variables": "tmax", "window": "1,4,3,6", "start": "2020-01-31", "gap_bytes": "0"}

    def rows(reader):
        return [r for block in reader.partitions() for batch in reader.read(block) for r in batch.to_pylist()]

    reader = grids.GridReader(options)
    assert len(rows(reader)) == 2 * 4
    assert reader.bytes_read == 2 * 4 * 6 * 4  # two grids, four rows, six columns of four bytes
    near = grids.GridReader({**options, "gap_bytes": "65536"})
    assert rows(near) == rows(grids.GridReader(options)) and near.bytes_read == 2 * (3 * 160 + 24)
    small = grids.GridReader({**options, "block_bytes": "50"})
    assert len(small.partitions()) == 4 and sorted(map(str, rows(small))) == sorted(map(str, rows(near)))


def test_stacks_from_files_give_the_same_means(spark, tmp_path):
    write_grids(tmp_path, 5)
    rng = random.Random(2)
    runs = runs_of(spark, rng, nrows=4, ncols=20)
    window = (1, 4, 3, 20)
    lines = grids.read_lines(spark, str(tmp_path), ["tmax"], window)
    found = grids.read_stacks(spark, str(tmp_path), ["tmax"], window, strip="8", block_bytes="400")
    assert found.select("month").distinct().count() == 2 and {r.strip for r in found.collect()} == {0, 1, 2}
    assert found.filter("month = date '2020-02-01'").count() == 4 * 3
    want = {(r.zone_id, r.date): r.value for r in raster.zonal_mean(lines, runs).collect()}
    got = {(r.zone_id, r.date): r.value for r in stacks.zonal_mean_stacked(found, stacks.weight_tiles(runs, width=8)).collect()}
    assert got == pytest.approx(want, rel=1e-9) and len(want) == 15


def test_shapes_are_checked_before_use(spark, tmp_path):
    write_grids(tmp_path, 2)
    bad = tmp_path / "grid_tmax_us_25m_20200301"
    bad.with_suffix(".bil").write_bytes(b"\0" * 64)
    bad.with_suffix(".hdr").write_text(HEAD.format(8, 40))
    with pytest.raises(Exception, match="cut short.*20200301"):
        grids.read_lines(spark, str(tmp_path), ["tmax"]).collect()
    bad.with_suffix(".hdr").write_text(HEAD.format(4, 4))
    with pytest.raises(Exception, match="4 x 4 is smaller than the window.*20200301"):
        grids.read_lines(spark, str(tmp_path), ["tmax"], (0, 7, 0, 40)).collect()
    found = rasters.shaped_catalog(spark, str(tmp_path), ["tmax"], date(2020, 1, 1), date(2020, 12, 31))
    assert sorted((r.date.month, r.nrows, r.ncols) for r in found.collect()) == [(1, 8, 40), (1, 8, 40), (3, 4, 4)]
    from zoneday.operators.manifest import valid_files

    assert valid_files(found, 0, (8, 40)).count() == 2
    with pytest.raises(ValueError, match="32-bit"):
        grids.parse_header("NROWS 2\nNCOLS 2\nNBITS 16")


def test_stores_meet_without_an_exchange(spark, tmp_path):
    rng = random.Random(9)
    cells = spark.createDataFrame(cells_of(rng, 40, ncols=30), "var string, date date, row int, col int, value double")
    lines, runs = raster.cells_to_scanlines(cells, 30), runs_of(spark, rng, ncols=30)
    grid = stacks.write_store(spark, stacks.stack_lines(lines, 8), "grid_store", str(tmp_path / "grid"), 4)
    tiles = stacks.write_store(spark, stacks.weight_tiles(runs, width=8), "tile_store", str(tmp_path / "tiles"), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the tiles were above any limit
    try:
        out = stacks.zonal_mean_stacked(grid, tiles)
        got = {(r.zone_id, r.var, r.date): r.value for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = plan[plan.index("MapInArrow") :] if "MapInArrow" in plan else plan[plan.index("MapInArrow".lower()) :]
    below = below.split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in below and "Exchange" not in below and "Broadcast" not in below
    want = {(r.zone_id, r.var, r.date): r.value for r in raster.zonal_mean(lines, runs).collect()}
    assert got == pytest.approx(want, rel=1e-9)
    assert spark.table("tile_store").agg(F.sum(F.size("zones"))).first()[0] > 0
