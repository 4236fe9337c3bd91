"""Panels judged while they are written."""

from __future__ import annotations

import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from zoneday.operators import audit, checks
from zoneday.sources import sinks

START = date(2019, 12, 30)
SCHEMA = "zone string, date date, v double"


def dense(n_zones=3, n_days=4):
    return [(f"z{z}", START + timedelta(days=d), None if z == d else float(z)) for z in range(n_zones) for d in range(n_days)]


def wanted(**more):
    return audit.Audit("p", "zone", 3, START, START + timedelta(days=3), **more)


def passed(df):
    # a sum over no rows is NULL where the gates read a table, and 0 where they count a write
    return {r.check: (r.passed, r.observed or 0.0) for r in df.collect()}


def test_counts_equal_the_gates(spark, tmp_path):
    rules = {"v < 2": (F.col("v") >= 2, 0.0), "few ones": (F.col("v") == 1, 0.5)}
    mean = audit.Mean("mean of z1", F.col("zone") == "z1", "v", 1.0, 1.0)
    bad = [*dense(), dense()[0], dense()[0], ("z9", date(2021, 1, 1), 5.0), (None, None, None)]
    for rows in (dense(), bad, []):
        df = spark.createDataFrame(rows, SCHEMA)
        s = audit.stage_panel(df, str(tmp_path / "panel"), wanted(rules=rules, means=[mean], totals=["v"]))
        back = spark.read.parquet(s.path) if rows else df
        assert back.count() == len(rows)
        got = passed(s.shape)
        outside = got.pop("p: no row outside its dates")
        assert outside == ((False, 2.0) if rows is bad else (True, 0.0))
        assert got == passed(checks.check_shape(df, "zone", 3, 4, "p"))
        assert {k: v for k, v in passed(s.values).items() if k != mean.name} == passed(checks.check_rules(df, rules, "p"))
        assert passed(s.values)[mean.name] == passed(checks.check_mean_between(df, mean.rows, "v", 1.0, 1.0, mean.name))[mean.name]
        assert s.totals["v"] == df.agg(F.sum("v")).first()[0]  # NULL over no rows


def test_counts_by_era_equal_the_gates(spark, tmp_path):
    """Eras that meet, overlap, lack rows or have a second row; judged as the gates that read the table judge."""
    day = lambda n: START + timedelta(days=n)
    eras = [audit.Era("a", 2, day(0), day(2)), audit.Era("b", 3, day(3), day(5)), audit.Era("none", 1, day(6), day(6))]
    table = spark.createDataFrame([(e.name, e.start, e.end) for e in eras], "era string, start_date date, end_date date")
    zones = spark.createDataFrame([(e.name, f"z{k}") for e in eras for k in range(e.n_zones)], "era string, zone string")
    whole = [(f"z{k}", e.start + timedelta(days=n), e.name) for e in eras for k in range(e.n_zones) for n in range((e.end - e.start).days + 1)]
    bad = [*whole[1:-1], whole[3], ("z0", day(3), "a"), ("z7", day(4), "b"), (None, day(4), "b"), ("z0", None, "b")]
    for rows in (whole, bad, whole[:6], []):
        df = spark.createDataFrame(rows, "zone string, date date, era string")
        s = audit.stage_panel(df, str(tmp_path / "eras"), audit.Audit("p", "zone", eras=eras, band=(15, 16)))
        got = passed(s.shape)
        assert got.pop("p: no row of an unknown era") == (True, 0.0)
        assert got.pop("p: rows") == (15 <= len(rows) <= 16, float(len(rows)))
        shape, vintage = passed(checks.check_era_shape(df, table, zones, "zone")), passed(checks.check_vintage(df, table))
        assert got == {**shape, **vintage}
    stray = spark.createDataFrame([*whole, ("z0", day(0), "other"), ("z0", day(0), None)], "zone string, date date, era string")
    s = audit.stage_panel(stray, str(tmp_path / "eras"), audit.Audit("p", "zone", eras=eras))
    assert passed(s.shape)["p: no row of an unknown era"] == (False, 2.0)
    with pytest.raises(checks.GateFailed, match="unknown era"):
        audit.publish(spark, [s])


def test_only_whole_panels_are_published(spark, tmp_path):
    target = str(tmp_path / "panel")
    good = audit.stage_panel(spark.createDataFrame(dense(), SCHEMA), target, wanted())
    audit.publish(spark, [good])
    assert spark.read.parquet(target).count() == 12
    for rows in (dense()[1:], [*dense(), dense()[0]], [*dense()[1:], ("z7", START, 1.0)]):
        bad = audit.stage_panel(spark.createDataFrame(rows, SCHEMA), target, wanted())
        with pytest.raises(checks.GateFailed):
            audit.publish(spark, [bad])
        assert spark.read.parquet(target).filter("zone = 'z0'").count() == 4
    better = audit.stage_panel(spark.createDataFrame(dense(), SCHEMA).withColumn("v", F.lit(7.0)), target, wanted())
    audit.publish(spark, [better])
    assert spark.read.parquet(target).filter("v = 7").count() == 12
    assert os.listdir(tmp_path) == ["panel"]  # nothing staged is left


def test_one_exchange_and_a_csv_copy(spark, tmp_path, monkeypatch):
    plans = []
    write = sinks.sorted_for_write
    monkeypatch.setattr(sinks, "sorted_for_write", lambda df, keys: plans.append(write(df, keys)) or plans[-1])
    df = spark.createDataFrame(dense(), SCHEMA).withColumn("year", F.year("date"))
    s = audit.stage_panel(df, str(tmp_path / "panel"), wanted())
    nth = audit.nth_of_key(plans[0], ["year", "zone", "date"])
    assert nth._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    report = sinks.copy_as_csv(spark, s.path, str(tmp_path / "csv"), ["zone", "date"]).first()
    assert (report.n_rows, report.n_columns) == (12, 4) and report.csv_bytes > 0 and report.parquet_bytes > 0
