"""Job-planning tables over file catalogs, with suppliers as variables and ship dates as days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from star_queries.registry import register, sql, table, view
from zoneday.operators import dense, keys, manifest
from zoneday.session import materialize, scratch_path
from zoneday.sources import rasters, sinks, tables


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "catalog")


def missing(spark: SparkSession, sf: str) -> DataFrame:
    """Days each variable lacks.  The catalog is written once: bounds, names and days all use it."""
    c = materialize(catalog(spark, sf), "catalog")
    first, last = dense.bounds(c, "date")
    return dense.missing_dates(c, c.select("var").distinct(), first, last)


def failures(spark: SparkSession, sf: str) -> DataFrame:
    """A failure log: every zero-tax line as one failed request."""
    line = table(spark, sf, "lineitem").filter("l_tax = 0.0")
    return line.select(
        F.concat(F.lit("v"), F.col("l_suppkey").cast("string")).alias("var"),
        F.to_date("l_shipdate").alias("date"),
        F.when(F.col("l_linestatus") == "O", "429").otherwise("exception").alias("http_code"),
        F.concat(F.lit("attempt "), F.col("l_linenumber").cast("string"), F.lit(", gave up")).alias("message"),
    )


@register(
    "wanted_dates",
    sql(
        """select var, cast(unnest(generate_series((select min(date) from catalog), (select max(date) from catalog), interval 1 day)) as date) as date
           from (select distinct var from catalog)""",
        "catalog",
    ),
)
def wanted_dates(spark, sf):
    c = materialize(catalog(spark, sf), "catalog")
    first, last = dense.bounds(c, "date")
    return dense.wanted_dates(c.select("var").distinct(), first, last)


@register("missing_dates", sql("select var, date from missing", "missing"))
def missing_dates(spark, sf):
    return missing(spark, sf)


@register("missing_blocks", sql("select var, min_date, max_date from blocks", "blocks"))
def missing_blocks(spark, sf):
    return dense.missing_blocks(missing(spark, sf))


@register("gap_blocks", sql("select var, min_date, max_date from blocks", "blocks"))
def gap_blocks(spark, sf):
    c = materialize(catalog(spark, sf), "catalog")
    first, last = dense.bounds(c, "date")
    return dense.gap_blocks(c, c.select("var"), first, last)


@register(
    "year_chunks",
    sql(
        """select var, cast(y as int) as year, greatest(min_date, make_date(y,1,1)) as start_date, least(max_date, make_date(y,12,31)) as end_date
           from (select *, cast(unnest(range(year(min_date), year(max_date)+1)) as int) as y from blocks)""",
        "blocks",
    ),
)
def year_chunks(spark, sf):
    return dense.year_chunks(dense.missing_blocks(missing(spark, sf)))


@register(
    "month_jobs",
    """select v.var, era, cast(year(m) as int) as year, cast(month(m) as int) as month from (
         select era, unnest(generate_series(date_trunc('month', a), b, interval 1 month)) as m from (
           select o_orderstatus || o_custkey as era, min(cast(o_orderdate as date)) as a, max(cast(o_orderdate as date)) as b from orders group by 1))
       cross join (values ('tmax'),('tmin')) v(var)""",
)
def month_jobs(spark, sf):
    """Eras from the data: each customer and status spans its first to last order."""
    o = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    eras = o.groupBy(F.concat("o_orderstatus", F.col("o_custkey").cast("string")).alias("era")).agg(
        F.min("day").alias("start_date"), F.max("day").alias("end_date")
    )
    return dense.month_jobs(("tmax", "tmin"), eras)


@register(
    "inventory",
    sql(
        """select var, count(*) as n_days, cast(date '2001-12-31' - date '1995-01-01' + 1 as int) as expected,
           round(count(*)*100.0/2557, 1) as pct from catalog where date between date '1995-01-01' and date '2001-12-31' group by 1""",
        "catalog",
    ),
)
def inventory(spark, sf):
    return manifest.inventory(catalog(spark, sf), date(1995, 1, 1), date(2001, 12, 31))


@register(
    "period_inventory",
    """select 'v' || l_suppkey as var, count(distinct strftime(l_shipdate, '%Y%m')) as n_periods, 84 as expected,
       round(count(distinct strftime(l_shipdate, '%Y%m'))*100.0/84, 1) as pct from lineitem group by 1""",
)
def period_inventory(spark, sf):
    done = catalog(spark, sf).select("var", F.date_format("date", "yyyyMM").alias("period"))
    return manifest.period_inventory(done, 84)


@register("valid_files", sql("select var, date, length from catalog where length >= 2", "catalog"))
def valid_files(spark, sf):
    return manifest.valid_files(catalog(spark, sf), min_bytes=2)


@register("retry_manifest", "select distinct 'v' || l_suppkey as var, cast(l_shipdate as date) as date from lineitem where l_tax = 0.0")
def retry_manifest(spark, sf):
    return manifest.retry_manifest(failures(spark, sf))


@register(
    "failure_log",
    """select 'v' || l_suppkey as var, cast(l_shipdate as date) as date, case when l_linestatus='O' then '429' else 'exception' end as http_code,
       'attempt ' || l_linenumber || ', gave up' as message from lineitem where l_tax = 0.0""",
)
def failure_log(spark, sf):
    """Two appends to one CSV log, read back with its schema."""
    path = scratch_path(spark, "failures")
    log = failures(spark, sf)
    sinks.append_failures(log.filter("http_code = '429'"), path)
    sinks.append_failures(log.filter("http_code <> '429'"), path)
    return tables.read_failures(spark, path)


@register(
    "outcome_counts",
    sql(
        """select case when length >= 3 then 'ok' when length = 2 then 'skipped' else 'failed' end as status, count(*) as n from catalog group by 1""",
        "catalog",
    ),
)
def outcome_counts(spark, sf):
    status = F.when(F.col("length") >= 3, "ok").when(F.col("length") == 2, "skipped").otherwise("failed")
    return manifest.outcome_counts(catalog(spark, sf).select(status.alias("status")))


@register(
    "explain_gaps",
    """select cast(year(l_shipdate) as int) as year from lineitem group by 1
       having count(*) * 1.0 / (select count(*) from lineitem) < 0.15 and count(*) filter (where l_tax = 0.0) > 0""",
)
def explain_gaps(spark, sf):
    line = table(spark, sf, "lineitem")
    by_year = line.groupBy(F.year("l_shipdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    low = by_year.filter(F.col("n") / by_year.agg(F.sum("n").alias("t")).scalar() < 0.15)
    return manifest.explain_gaps(low, failures(spark, sf))


@register(
    "raster_names",
    sql(
        """select var, date, length from catalog where date between date '1996-01-01' and date '1998-12-31'""", "catalog"
    ),
)
def raster_names(spark, sf):
    """Variable and date parsed back from file paths in the three naming forms."""
    c = catalog(spark, sf)
    day = F.date_format("date", "yyyyMMdd")
    form = F.pmod(F.dayofmonth("date"), F.lit(3))
    v = F.col("var")
    path = (
        F.when(form == 0, F.concat(F.lit("file:/d/grid_"), v, F.lit("_us_25m_"), day, F.lit("/grid_"), v, F.lit("_us_25m_"), day, F.lit(".bil")))
        .when(form == 1, F.concat(F.lit("/d/GRID_"), v, F.lit("_stable_4kmD2_"), day, F.lit("_bil.bil")))
        .otherwise(F.concat(F.lit("/d/"), v, F.lit("/2020/grid_"), v, F.lit("_tx_30s_"), day, F.lit(".tif")))
    )
    var, parsed = rasters.name_parts(path, [r"v\d+"])
    return c.select(var.alias("var"), parsed.alias("date"), "length").filter(
        F.col("date").between(F.lit(date(1996, 1, 1)), F.lit(date(1998, 12, 31)))
    )


@register(
    "resume_extracts",
    """select l_returnflag as var, strftime(l_shipdate, '%Y') as period, cast(l_shipdate as date) as date, l_suppkey as zone_id, round(sum(l_quantity),6) as value
       from lineitem group by 1,2,3,4""",
)
def resume_extracts(spark, sf):
    """A first run over odd days, a second over everything and a third that finds nothing left.

    Every period is open after the first run and gets its other days in the second.
    """
    line = table(spark, sf, "lineitem")
    out = line.groupBy(
        F.col("l_returnflag").alias("var"),
        F.date_format("l_shipdate", "yyyy").alias("period"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_suppkey").alias("zone_id"),
    ).agg(F.sum("l_quantity").alias("value"))
    path = scratch_path(spark, "resume")
    sinks.write_extracts(out.filter("day(date) % 2 = 1"), path, ["zone_id", "date"])
    sinks.write_extracts(out, path, ["zone_id", "date"])
    sinks.write_extracts(out, path, ["zone_id", "date"])
    schema = "date date, zone_id bigint, value double, var string, period string"
    return spark.read.schema(schema).parquet(path).withColumn("value", F.round("value", 6))


@register(
    "revised_days",
    """select l_returnflag as var, strftime(l_shipdate, '%Y') as period, cast(l_shipdate as date) as date, l_suppkey as zone_id,
         round(sum(l_quantity) * case when day(l_shipdate) <= 2 then 10 else 1 end, 6) as value
       from lineitem group by 1,2,3,4,l_shipdate""",
)
def revised_days(spark, sf):
    """All days are extracted; then those of the first two of each month are issued again with ten times the values.

    The second run finds these days by their grids' size and time and replaces
    them within their periods; a third finds nothing to do.
    """
    line = table(spark, sf, "lineitem")
    day = F.to_date("l_shipdate")
    out = line.groupBy(
        F.col("l_returnflag").alias("var"), F.date_format("l_shipdate", "yyyy").alias("period"), day.alias("date"), F.col("l_suppkey").alias("zone_id")
    ).agg(F.sum("l_quantity").alias("value"))
    files = out.groupBy("var", "period", "date").agg(F.count(F.lit(1)).alias("length")).withColumn("modified", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    early = F.dayofmonth("date") <= 2
    again = files.withColumn("modified", F.when(early, F.lit("2024-02-01 00:00:00").cast("timestamp")).otherwise(F.col("modified")))
    path = scratch_path(spark, "revised")
    versions = ((files, out), (again, out.withColumn("value", F.col("value") * F.when(early, 10).otherwise(1))), (again, out.withColumn("value", F.lit(-1.0))))
    for grids, values in versions:
        todo = materialize(sinks.pending_extracts(grids, path), "due")
        if not todo.isEmpty():
            due = values.join(todo.select("var", "date"), ["var", "date"], "left_semi")
            sinks.write_extracts(due.select("zone_id", "date", "value", "var", "period"), path, ["zone_id", "date"], todo)
    schema = "date date, zone_id bigint, value double, var string, period string"
    return spark.read.schema(schema).parquet(path).withColumn("value", F.round("value", 6))


@register("unmatched_keys", "select c_custkey, c_name from customer where c_custkey not in (select user_id from events)")
def unmatched_keys(spark, sf):
    users = table(spark, sf, "events").select(F.col("user_id").alias("c_custkey"))
    return keys.unmatched(table(spark, sf, "customer").select("c_custkey", "c_name"), users, "c_custkey")
