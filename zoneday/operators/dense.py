"""Dense zone x day skeletons and the wanted / missing date tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zoneday.session import lookup

Bound = date | Column


def _day(b: Bound) -> Column:
    return b if isinstance(b, Column) else F.lit(b)


def bounds(df: DataFrame, day: str) -> tuple[Column, Column]:
    """First and last day as scalar subqueries (no cross join, no driver round trip)."""
    return (
        df.agg(F.min(day).alias("first_day")).scalar(),
        df.agg(F.max(day).alias("last_day")).scalar(),
    )


def skeleton(zones: DataFrame, start: Bound, end: Bound, day: str = "date") -> DataFrame:
    """Every zone on every day of [start, end]; the bounds may be columns of ``zones``.

    Grown from the zone rows, so there is no cross join.  A zone list is so
    small that it would sit in one partition and one task would write out the
    whole skeleton; zone-months are therefore spread first and become days
    after that.
    """
    first, last = _day(start), _day(end)
    months = zones.withColumn(
        "_month", F.explode(F.sequence(F.trunc(first, "MM"), last, F.expr("interval 1 month")))
    )
    tasks = int(zones.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = months.repartition(tasks, *zones.columns, "_month")
    # no bound is NULL where a month exists, so greatest/least are safe
    days = F.sequence(F.greatest(first, F.col("_month")), F.least(last, F.last_day("_month")))
    return spread.withColumn(day, F.explode(days)).drop("_month")


def densify(
    facts: DataFrame,
    zones: DataFrame,
    zone: str | Sequence[str],
    start: Bound,
    end: Bound,
    day: str = "date",
    fill: dict | None = None,
) -> DataFrame:
    """Left-join facts to the skeleton of the given zones; ``fill`` replaces NULLs of counts."""
    keys = [zone] if isinstance(zone, str) else list(zone)
    out = skeleton(zones.select(*keys).distinct(), start, end, day).join(facts, [*keys, day], "left")
    return out.fillna(fill) if fill else out


def densify_eras(
    facts: DataFrame, zones: DataFrame, eras: DataFrame, zone: str = "zone_id", day: str = "date"
) -> DataFrame:
    """Each era's zones on that era's days only, in one plan.

    ``zones(era, zone)``, ``eras(era, start_date, end_date)``.  Facts are
    matched by zone and day, and by era too where they carry one.
    """
    keys = [zone, day] + (["era"] if "era" in facts.columns else [])
    spans = zones.select("era", zone).distinct().join(eras.select("era", "start_date", "end_date"), "era")
    grid = skeleton(spans, F.col("start_date"), F.col("end_date"), day).select("era", zone, day)
    return grid.join(facts, keys, "left")


def wanted_dates(variables: DataFrame, start: Bound, end: Bound) -> DataFrame:
    """All (var, date) that should exist.  ``variables(var)``."""
    return skeleton(variables.select("var"), start, end)


def variable_table(spark: SparkSession, variables: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(v,) for v in variables], "var string")


def month_jobs(variables: Sequence[str], eras: DataFrame) -> DataFrame:
    """One row per variable, era and calendar month the era touches."""
    months = eras.select(
        "era",
        F.explode(
            F.sequence(F.trunc("start_date", "MM"), F.col("end_date"), F.expr("interval 1 month"))
        ).alias("_m"),
    )
    names = F.explode(F.array(*[F.lit(v) for v in variables]))
    return months.select(names.alias("var"), "era", F.year("_m").alias("year"), F.month("_m").alias("month"))


def missing_dates(catalog: DataFrame, variables: DataFrame, start: Bound, end: Bound) -> DataFrame:
    """Wanted (var, date) the catalog lacks."""
    return wanted_dates(variables, start, end).join(
        catalog.select("var", "date").distinct(), ["var", "date"], "left_anti"
    )


def missing_blocks(missing: DataFrame) -> DataFrame:
    """Runs of consecutive days per variable as (var, min_date, max_date).

    A variable has at most one row per calendar day, which bounds the window.
    """
    w = Window.partitionBy("var").orderBy("date")
    step = F.coalesce((F.datediff("date", F.lag("date").over(w)) > 1).cast("int"), F.lit(0))
    return (
        missing.withColumn("_step", step)
        .withColumn("_block", F.sum("_step").over(w))
        .groupBy("var", "_block")
        .agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))
        .drop("_block")
    )


def gap_blocks(catalog: DataFrame, variables: DataFrame, start: Bound, end: Bound) -> DataFrame:
    """The blocks of ``missing_blocks`` straight from the days present.

    A block lies between two neighbouring present days, or between one and the
    ends of the window, so no calendar is written out and nothing is
    anti-joined: the work follows the catalog, not the window.
    """
    first, last = _day(start), _day(end)
    present = catalog.filter(F.col("date").between(first, last)).select("var", "date").distinct()
    ends = F.array(F.date_sub(first, 1), F.date_add(last, 1))
    names = variables.select("var").distinct()
    marks = lookup(present, names, "var", "left_semi").unionByName(names.select("var", F.explode(ends).alias("date")))
    before = F.lag("date").over(Window.partitionBy("var").orderBy("date"))
    return (
        marks.withColumn("_before", before)
        .filter(F.datediff("date", "_before") > 1)
        .select("var", F.date_add("_before", 1).alias("min_date"), F.date_sub("date", 1).alias("max_date"))
    )


def year_chunks(blocks: DataFrame) -> DataFrame:
    """Cut each block at calendar-year ends."""
    years = blocks.withColumn("_y", F.explode(F.sequence(F.year("min_date"), F.year("max_date"))))
    jan1 = F.make_date(F.col("_y"), F.lit(1), F.lit(1))
    dec31 = F.make_date(F.col("_y"), F.lit(12), F.lit(31))
    # both bounds are never NULL here, so greatest/least are safe
    return years.select(
        "var",
        F.col("_y").alias("year"),
        F.greatest("min_date", jan1).alias("start_date"),
        F.least("max_date", dec31).alias("end_date"),
    )
