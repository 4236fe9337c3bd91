"""Partial sums by year: equal to reports over the whole panel, and only changed years are read."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from zoneday.operators import partials, summaries
from zoneday.sources import sinks

SCHEMA = "zone_id string, date date, tmax double, ppt double"
VARIABLES = ("tmax", "ppt", "absent")


def days(year, shift=0.0):
    rows = [(z, date(year, 1, d), None if d % 3 == 0 else d + shift, None) for z in ("a", "b") for d in range(1, 8)]
    return [*rows, (None, date(year, 2, 1), 4.0, 1.0)]


@pytest.fixture
def stored(spark, tmp_path):
    path, store = str(tmp_path / "panel"), str(tmp_path / "partials")
    sinks.write_panel(spark.createDataFrame(days(2019) + days(2020), SCHEMA), path, "zone_id")
    return path, store


def refresh(spark, path, store):
    return partials.refresh_partials(spark, path, store, "zone_id", VARIABLES)


def same(spark, path, store, rows):
    kept, panel = partials.read_partials(spark, path, store), spark.read.parquet(path)
    assert rows(partials.coverage_merged(kept, 70.0), "year", "variable") == rows(
        summaries.coverage_by_year(panel, VARIABLES, 70.0).select("year", "variable", "pct_valid", "n", "low"), "year", "variable"
    )
    assert rows(partials.report_merged(kept), "item", "detail") == rows(summaries.panel_report(panel, "zone_id", VARIABLES), "item", "detail")


def test_only_changed_years_are_read(spark, stored, rows, monkeypatch):
    path, store = stored
    assert refresh(spark, path, store) == [2019, 2020]
    same(spark, path, store, rows)
    assert refresh(spark, path, store) == []
    sinks.write_panel(spark.createDataFrame(days(2021), SCHEMA), path, "zone_id", mode="append")
    opened, plain = [], partials.zone_partials

    def watched(df, *args):
        opened.extend(r.f for r in df.select(F.input_file_name().alias("f")).distinct().collect())
        return plain(df, *args)

    monkeypatch.setattr(partials, "zone_partials", watched)
    assert refresh(spark, path, store) == [2021]
    assert opened and all("/year=2021/" in f for f in opened)
    same(spark, path, store, rows)


def test_changed_and_dropped_years(spark, stored, rows):
    path, store = stored
    refresh(spark, path, store)
    spark.createDataFrame(days(2020, 0.5), SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/year=2020")
    assert refresh(spark, path, store) == [2020]
    same(spark, path, store, rows)
    sinks.write_panel(spark.createDataFrame(days(2020, 0.5), SCHEMA), path, "zone_id")  # 2019 has gone
    assert refresh(spark, path, store) == [2020]
    same(spark, path, store, rows)
    inventory = rows(partials.inventory_merged(partials.read_partials(spark, path, store)), "year", "variable")
    assert inventory == [(2020, "ppt", 15, 1, 1.0, 1.0, 1.0), (2020, "tmax", 15, 11, pytest.approx(47 / 11), 1.5, 7.5)]


def test_no_partials(spark):
    empty = partials.zone_partials(spark.createDataFrame([], SCHEMA + ", year int"), "zone_id", VARIABLES)
    assert partials.coverage_merged(empty, 99.0).count() == 0
    assert partials.report_merged(empty).filter("item = 'zones'").first().n == 0
