"""Weather half: panels, features, roll-ups, reports, gates, heat index."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from star_queries.registry import r, register, rsql, sql, table, view
from zoneday import fixed_values as fv
from zoneday.functions import dates, weather
from zoneday.operators import checks, dense, keys, reshape, rollup, summaries
from zoneday.plans import weather as plans
from zoneday.session import materialize, scratch_path
from zoneday.sources import sinks, tables

START, END, AS_OF = date(2024, 1, 1), date(2024, 1, 30), date(2024, 7, 15)
ALL = (*fv.COUNTY_VARIABLES, *fv.HUMIDITY_VARIABLES)
SETTINGS = plans.PanelSettings(as_of=AS_OF, start=START, end=END)
POSTAL = plans.PanelSettings(as_of=AS_OF, start=START, end=END, variables=fv.POSTAL_VARIABLES)


# ---- inputs --------------------------------------------------------------


def wide(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.merge_variables(view(spark, sf, "weather_long"), ["fips", "date"], fv.COUNTY_VARIABLES)


def panel(spark: SparkSession, sf: str) -> DataFrame:
    return plans.zone_panel(view(spark, sf, "weather_long"), view(spark, sf, "zone_meta"), SETTINGS)


def cz_panel(spark: SparkSession, sf: str) -> DataFrame:
    return plans.parent_panel(panel(spark, sf), view(spark, sf, "zone_meta"), view(spark, sf, "cz_meta"), SETTINGS)


def n_zones(spark: SparkSession, sf: str) -> int:
    return view(spark, sf, "zone_meta").count()


def eras(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "eras")


def era_long(spark: SparkSession, sf: str) -> DataFrame:
    """The long extracts with the era their day lies in."""
    long = view(spark, sf, "weather_long").withColumnRenamed("fips", "zone_id")
    era = F.when(F.col("date") <= F.lit(date(2024, 1, 15)), "e1").otherwise("e2")
    return long.withColumn("era", era)


def postal(spark: SparkSession, sf: str) -> DataFrame:
    return plans.era_panel(era_long(spark, sf), view(spark, sf, "era_zones"), eras(spark, sf), POSTAL)


# ---- merge, skeleton, features -------------------------------------------


@register("merge_variables", sql(f"select fips, date, {rsql(*fv.COUNTY_VARIABLES)} from wide", "wide"))
def merge_variables(spark, sf):
    return wide(spark, sf).select("fips", "date", *[r(v) for v in fv.COUNTY_VARIABLES])


@register("densify", sql(f"select fips, date, {rsql(*fv.COUNTY_VARIABLES)} from dense", "dense"))
def densify(spark, sf):
    out = dense.densify(wide(spark, sf), view(spark, sf, "zone_meta"), "fips", START, END)
    return out.select("fips", "date", *[r(v) for v in fv.COUNTY_VARIABLES])


@register("densify_eras", sql(f"select era, zone_id, date, {rsql(*fv.POSTAL_VARIABLES)} from era_dense", "era_dense"))
def densify_eras(spark, sf):
    facts = rollup.merge_variables(era_long(spark, sf), ["era", "zone_id", "date"], fv.POSTAL_VARIABLES)
    out = dense.densify_eras(facts, view(spark, sf, "era_zones"), eras(spark, sf))
    return out.select("era", "zone_id", "date", *[r(v) for v in fv.POSTAL_VARIABLES])


@register(
    "era_sets",
    sql(
        """select zone_id, case when a and b then 'both' when a then 'only_first' else 'only_second' end as part from (
           select c_mktsegment || c_nationkey as zone_id, bool_or(o_orderdate < timestamp '1998-01-01') as a,
             bool_or(o_orderdate >= timestamp '1998-01-01') as b
           from orders join customer on o_custkey = c_custkey group by 1)"""
    ),
)
def era_sets(spark, sf):
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    era = F.when(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"), "e1").otherwise("e2")
    zones = o.select(F.concat("c_mktsegment", F.col("c_nationkey").cast("string")).alias("zone_id"), era.alias("era"))
    return keys.era_sets(zones, "e1", "e2")


_CAL = """cast(year(d) as int) as year, cast(month(d) as int) as month, cast(day(d) as int) as day,
    cast(dayofyear(d) as int) as doy, cast(weekofyear(d) as int) as week, cast(quarter(d) as int) as quarter"""


@register(
    "calendar",
    f"select o_orderkey, d as date, {_CAL}, month(d) between 6 and 8 as summer, make_date(cast(year(d) as int), cast(month(d) as int), 1) as month_start "
    "from (select o_orderkey, cast(o_orderdate as date) as d from orders)",
)
def calendar(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return dates.add_calendar(o).withColumns(
        {"summer": dates.is_summer("date"), "month_start": dates.month_start("year", "month")}
    )


@register(
    "ordinal_date",
    "select l_orderkey, l_linenumber, make_date(cast(year(l_shipdate) as int),1,1) + cast(dayofyear(l_shipdate) as int) - 1 as date from lineitem",
)
def ordinal_date(spark, sf):
    line = table(spark, sf, "lineitem")
    return line.select(
        "l_orderkey", "l_linenumber", dates.ordinal_date(F.year("l_shipdate"), F.dayofyear("l_shipdate")).alias("date")
    )


@register(
    "stability",
    """select o_orderkey, case when date '2001-08-01' - cast(o_orderdate as date) > 180 then 'stable'
       when date '2001-08-01' - cast(o_orderdate as date) > 14 then 'provisional' else 'early' end as stability from orders""",
)
def stability(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", dates.stability(F.to_date("o_orderdate"), date(2001, 8, 1)).alias("stability"))


@register(
    "analysis_window",
    """select o_orderkey, cast(o_orderdate as date) as date from orders where o_orderdate >= timestamp '1996-01-01'
       and o_orderdate < timestamp '2000-02-01' and year(o_orderdate) not in (1997, 1998)""",
)
def analysis_window(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return o.filter(dates.in_analysis_window("date", 1996, date(2000, 2, 1), (1997, 1998)))


@register(
    "saturation_pressure",
    "select event_id, round(0.6108*exp(17.27*(value/3-5)/((value/3-5)+237.3)),6) as es from events",
)
def saturation_pressure(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", r(weather.saturation_pressure(F.col("value") / 3 - 5)).alias("es"))


@register("humidity", sql(f"select fips, date, {rsql('rh_mean', 'vpd_mean')} from humid", "humid"))
def humidity(spark, sf):
    base = dense.densify(wide(spark, sf), view(spark, sf, "zone_meta"), "fips", START, END)
    return weather.add_humidity(base).select("fips", "date", r("rh_mean"), r("vpd_mean"))


@register("null_outliers", sql(f"select fips, date, {rsql(*ALL)} from panel", "panel"))
def null_outliers(spark, sf):
    base = dense.densify(wide(spark, sf), view(spark, sf, "zone_meta"), "fips", START, END)
    return weather.null_outliers(weather.add_humidity(base)).select("fips", "date", *[r(v) for v in ALL])


@register(
    "outlier_counts",
    sql(
        " union all ".join(
            f"select '{v}' as variable, count(*) filter (where {v} < {lo} or {v} > {hi}) as n_outside from humid"
            for v, (lo, hi) in fv.PLAUSIBLE_RANGES.items()
            if v in ALL
        ),
        "humid",
    ),
)
def outlier_counts(spark, sf):
    base = weather.add_humidity(dense.densify(wide(spark, sf), view(spark, sf, "zone_meta"), "fips", START, END))
    flags = weather.outlier_flags(base.columns, fv.PLAUSIBLE_RANGES)
    return rollup.wide_stats(base.select(*[f.alias(v) for v, f in flags.items()]), list(flags), {"n_outside": F.count_if})


@register(
    "zone_panel",
    sql(
        f"""select fips, county_name, date, {_CAL.replace('(d)', '(date)')}, {rsql(*ALL)}, cz_id, cz_name, area_km2, centroid_lon, centroid_lat,
        case when date '2024-07-15' - date > 180 then 'stable' when date '2024-07-15' - date > 14 then 'provisional' else 'early' end as stability
        from (select * exclude (year, month) from panel)""",
        "panel",
    ),
)
def zone_panel(spark, sf):
    return panel(spark, sf).withColumns({v: F.round(v, 6) for v in ALL})


@register(
    "parent_panel",
    sql(
        f"select cz_id, cz_name, date, year, month, {rsql(*ALL)}, n_counties, area_km2, centroid_lon, centroid_lat from cz_panel join cz_meta using (cz_id)",
        "cz_panel",
        "cz_meta",
    ),
)
def parent_panel(spark, sf):
    return cz_panel(spark, sf).withColumns({v: F.round(v, 6) for v in ALL}).drop("day", "doy", "week", "quarter", "stability")


@register(
    "era_panel",
    sql(
        """select d.era, d.zone_id, d.date, round(case when tmax between -30 and 55 then tmax end,6) as tmax,
           round(case when tmin between -35 and 40 then tmin end,6) as tmin, round(case when tmean between -30 and 50 then tmean end,6) as tmean,
           round(case when tdmean between -40 and 35 then tdmean end,6) as tdmean, z.area_km2, z.county_fips
           from era_dense d join era_zones z using (era, zone_id)""",
        "era_dense",
        "era_zones",
    ),
)
def era_panel(spark, sf):
    return postal(spark, sf).select(
        "era", "zone_id", "date", *[r(v) for v in fv.POSTAL_VARIABLES], "area_km2", "county_fips"
    )


@register(
    "weighted_rollup",
    sql(f"select cz_id, date, n_counties, {rsql(*ALL)} from cz_panel", "cz_panel"),
)
def weighted_rollup(spark, sf):
    return rollup.weighted_rollup(panel(spark, sf), ["cz_id", "date"], ALL).select(
        "cz_id", "date", "n_counties", *[r(v) for v in ALL]
    )


@register(
    "weighted_mean_prices",
    """select l_returnflag, l_shipmonth, count(*) as n_counties, round(sum(l_extendedprice*l_quantity)/sum(l_quantity), 4) as price
       from (select *, cast(date_trunc('month', l_shipdate) as date) as l_shipmonth from lineitem) group by 1,2""",
)
def weighted_mean_prices(spark, sf):
    """The weighted roll-up over every line item: three flags, each a third of all rows."""
    line = table(spark, sf, "lineitem").select(
        "l_returnflag",
        F.trunc(F.to_date("l_shipdate"), "MM").alias("l_shipmonth"),
        "l_quantity",
        F.col("l_extendedprice").alias("price"),
    )
    return rollup.weighted_rollup(line, ["l_returnflag", "l_shipmonth"], ["price"], "l_quantity").withColumn(
        "price", r("price", 4)
    )


@register(
    "region_class",
    sql(
        """select c_custkey, case when x < -101 then 'West Texas' when x < -97 then 'Central Texas' else 'East Texas' end as region
           from (select point_id as c_custkey, x from sites)""",
        "sites",
    ),
)
def region_class(spark, sf):
    return view(spark, sf, "sites").select(F.col("point_id").alias("c_custkey"), weather.region_of("x").alias("region"))


@register(
    "unit_conversion",
    """select event_id, round(value*9/5+32,6) as f, round(value-273.15,6) as c, round(case when value < 10 then 10 when value > 60 then 60 else value end,6) as clamped
       from events""",
)
def unit_conversion(spark, sf):
    e = table(spark, sf, "events")
    return e.select(
        "event_id",
        r(weather.c_to_f("value")).alias("f"),
        r(weather.k_to_c("value")).alias("c"),
        r(weather.clamp("value", 10, 60)).alias("clamped"),
    )


# ---- reshape -------------------------------------------------------------


@register("metrics_to_long", sql(
    " union all ".join(f"select fips, date, '{v}' as variable, round({v},6) as value from wide" for v in fv.COUNTY_VARIABLES),
    "wide",
))
def metrics_to_long(spark, sf):
    return reshape.metrics_to_long(wide(spark, sf), ["fips", "date"], ALL).withColumn("value", r("value"))


_DAYS = [date(2024, 1, d) for d in range(1, 31)]


def _banded(spark: SparkSession, sf: str) -> DataFrame:
    """One row per zone, one column ``mean.<date>`` per day."""
    long = view(spark, sf, "weather_long").filter("var = 'tmax'")
    return long.groupBy("fips").agg(
        *[F.max(F.when(F.col("date") == F.lit(d), F.col("value"))).alias(f"mean.{d}") for d in _DAYS]
    )


_BANDS = """select z.fips, z.date, round(value,6) as value from
    (select fips, cast(unnest(generate_series(date '2024-01-01', date '2024-01-30', interval 1 day)) as date) as date
     from (select distinct fips from weather_long where var='tmax')) z
    left join (select * from weather_long where var='tmax') w on w.fips=z.fips and w.date=z.date"""


@register("bands_to_long", sql(_BANDS, "weather_long"))
def bands_to_long(spark, sf):
    return reshape.bands_to_long(_banded(spark, sf), ["fips"], "mean.").withColumn("value", r("value"))


@register("band_array_to_long", sql(_BANDS, "weather_long"))
def band_array_to_long(spark, sf):
    arrays = _banded(spark, sf).select("fips", F.array(*[F.col(f"`mean.{d}`") for d in _DAYS]).alias("values"))
    days = (
        view(spark, sf, "weather_long").agg(F.min("date").alias("a"), F.max("date").alias("b"))
        .select(F.posexplode(F.sequence("a", "b")).alias("pos", "date"))
        .select((F.col("pos") + 1).alias("band"), "date")
    )
    return reshape.band_array_to_long(arrays, ["fips"], days).withColumn("value", r("value"))


@register(
    "split_var_stat",
    sql(
        " union all ".join(
            f"select '{v}' as variable, round(avg({v}),6) as mean, round(max({v}),6) as max from wide" for v in fv.COUNTY_VARIABLES
        ),
        "wide",
    ),
)
def split_var_stat(spark, sf):
    one = wide(spark, sf).agg(
        *[F.avg(v).alias(f"{v}_mean") for v in fv.COUNTY_VARIABLES], *[F.max(v).alias(f"{v}_max") for v in fv.COUNTY_VARIABLES]
    )
    long = one.unpivot([], one.columns, "name", "value")
    return reshape.split_var_stat(long, stats=("mean", "max")).select("variable", r("mean"), r("max"))


@register(
    "stacked_claims",
    """select o_orderkey as bill_id, 'a' as form, o_totalprice as charge from orders where o_orderstatus = 'F'
       union all select o_orderkey, 'b', null from orders where o_orderstatus <> 'F'
       union all select o_orderkey, 'a', o_totalprice from orders where o_orderstatus = 'F'""",
)
def stacked_claims(spark, sf):
    """Form types one after the other, one without a charge column; repeated rows stay."""
    o = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "bill_id")
    a = o.filter("o_orderstatus = 'F'").select("bill_id", F.lit("a").alias("form"), F.col("o_totalprice").alias("charge"))
    b = o.filter("o_orderstatus <> 'F'").select(F.lit("b").alias("form"), "bill_id")
    return keys.stack([a, b, a])


# ---- reports -------------------------------------------------------------


def _each(columns, text: str) -> str:
    return " union all ".join(text.format(v=v) for v in columns)


@register(
    "coverage_by_year",
    sql(
        "select *, pct_valid < 99.5 as low from ("
        + _each(ALL, "select year, '{v}' as variable, round(count({v})*100.0/count(*),6) as pct_valid, count({v}) as n from panel group by 1")
        + ")",
        "panel",
    ),
)
def coverage_by_year(spark, sf):
    out = summaries.coverage_by_year(panel(spark, sf), ALL, fv.COVERAGE_FLOOR_COUNTY)
    return out.withColumn("pct_valid", r("pct_valid"))


@register(
    "coverage_overall",
    sql(_each(ALL, "select '{v}' as variable, round(count({v})*100.0/count(*),6) as pct_valid from panel"), "panel"),
)
def coverage_overall(spark, sf):
    return summaries.coverage_overall(panel(spark, sf), ALL).withColumn("pct_valid", r("pct_valid"))


@register(
    "missing_share",
    sql(
        _each(ALL, "select year, '{v}' as variable, round(count(*) filter (where {v} is null)*100.0/count(*),6) as pct_missing from panel group by 1"),
        "panel",
    ),
)
def missing_share(spark, sf):
    return summaries.missing_share(panel(spark, sf), ALL).withColumn("pct_missing", r("pct_missing"))


@register(
    "panel_report",
    sql(
        """select 'rows' as item, '' as detail, count(*) as n, cast(null as double) as value from panel
           union all select 'zones', '', count(distinct fips), null from panel
           union all select 'first_day', cast(min(date) as varchar), null, null from panel
           union all select 'last_day', cast(max(date) as varchar), null, null from panel
           union all select 'calendar_days', '', max(date)-min(date)+1, null from panel union all """
        + _each(
            ALL,
            "select 'pct_valid', '{v}', count({v}), round(count({v})*100.0/count(*),6) from panel"
            " union all select 'mean', '{v}', count({v}), round(avg({v}),6) from panel",
        ),
        "panel",
    ),
)
def panel_report(spark, sf):
    return summaries.panel_report(panel(spark, sf), "fips", ALL).withColumn("value", r("value"))


@register(
    "class_counts",
    """select case when date '2001-08-01' - cast(o_orderdate as date) > 180 then 'stable'
       when date '2001-08-01' - cast(o_orderdate as date) > 14 then 'provisional' else 'early' end as stability, count(*) as n
       from orders group by 1""",
)
def class_counts(spark, sf):
    return summaries.class_counts(stability(spark, sf), "stability")


@register(
    "zones_per_state",
    sql("select state, count(*) as n from geo group by 1 union all select 'none', count(*) from (select zip from zip2cnty where zip not in (select zip from geo) group by 1)", "geo"),
)
def zones_per_state(spark, sf):
    from star_queries.claims import geo

    found = geo(spark, sf)
    rest = keys.unmatched(view(spark, sf, "zip2cnty").select("zip").distinct(), found, "zip")
    return summaries.class_counts(keys.stack([found.select("state"), rest.select(F.lit("none").alias("state"))]), "state")


@register(
    "region_seasonality",
    sql(
        """select region, month, round(mean,6) as mean, round(se,6) as se, round(mean-1.96*se,6) as lo, round(mean+1.96*se,6) as hi from (
           select case when centroid_lon < -101 then 'West Texas' when centroid_lon < -97 then 'Central Texas' else 'East Texas' end as region,
             month, avg(ppt) as mean, stddev_samp(ppt)/sqrt(count(ppt)) as se from panel where ppt is not null group by 1,2)""",
        "panel",
    ),
)
def region_seasonality(spark, sf):
    out = summaries.region_seasonality(panel(spark, sf))
    return out.select("region", "month", *[r(c) for c in ("mean", "se", "lo", "hi")])


@register(
    "annual_means",
    sql(
        """select cz_id, round(avg(tmean),6) as mean_tmean, round(avg(tmax),6) as mean_tmax, round(avg(ppt)*365,6) as mean_ppt
           from cz_panel where year between 2010 and 2024 group by 1""",
        "cz_panel",
    ),
)
def annual_means(spark, sf):
    out = summaries.annual_means(cz_panel(spark, sf))
    return out.select("cz_id", *[r(c) for c in ("mean_tmean", "mean_tmax", "mean_ppt")])


@register(
    "map_frame",
    sql(
        """select cz_id, cz_name, area_km2, round(mean_tmean,6) as mean_tmean from cz_meta left join
           (select cz_id, avg(tmean) as mean_tmean from cz_panel group by 1) using (cz_id)""",
        "cz_meta",
        "cz_panel",
    ),
)
def map_frame(spark, sf):
    stats = summaries.annual_means(cz_panel(spark, sf)).select("cz_id", r("mean_tmean"))
    return summaries.map_frame(view(spark, sf, "cz_meta").select("cz_id", "cz_name", "area_km2"), stats, "cz_id")


@register(
    "monthly_temperature",
    sql(
        """select year, month, round(avg(a),6) as tmax_mean, round(avg(b),6) as tmin_mean, make_date(year, month, 1) as date from (
           select cz_id, year, month, avg(tmax)*9/5+32 as a, avg(tmin)*9/5+32 as b from cz_panel group by 1,2,3) group by 1,2""",
        "cz_panel",
    ),
)
def monthly_temperature(spark, sf):
    out = summaries.monthly_temperature(cz_panel(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in ("tmax_mean", "tmin_mean")})


@register(
    "describe_wide",
    sql(
        _each(
            ALL,
            "select '{v}' as variable, round(avg({v}),3) as mean, round(stddev_samp({v}),3) as sd, round(min({v}),3) as min, "
            "round(max({v}),3) as max, round(count({v})*100.0/count(*),3) as pct_valid from panel",
        ),
        "panel",
    ),
)
def describe_wide(spark, sf):
    return summaries.describe_wide(panel(spark, sf), ALL)


@register("preview", sql("select distinct cz_id, n_counties from cz_panel order by cz_id, n_counties limit 5", "cz_panel"))
def preview(spark, sf):
    # in an order, as any five rows would differ between engines
    return summaries.preview(cz_panel(spark, sf).select("cz_id", "n_counties").distinct().orderBy("cz_id", "n_counties"))


# ---- heat index ----------------------------------------------------------

_HI = """case when rh is null or rh < 0 or rh > 100 then null when f <= 40 then f when s <= 79 then s
    else full_ + case when rh <= 13 and f between 80 and 112 then -((13-rh)/4)*sqrt((17-abs(f-95))/17)
      when rh > 85 and f between 80 and 87 then ((rh-85)/10)*((87-f)/5) else 0 end end"""
_HEAT_SQL = f"""
select zone_id, date, cast(year(date) as int) as year, state, round(tmax_c,6) as tmax_c, round(rh,6) as rh,
  cast(round(cast(cast(({_HI} - 32)*5/9 as varchar) as decimal(24,16)), 2) as double) as heat_index_c from (
  select *, 0.5*(f+61.0+(f-68.0)*1.2+rh*0.094) as s,
    -42.379+2.04901523*f+10.14333127*rh-0.22475541*f*rh-0.00683783*f*f-0.05481717*rh*rh+0.00122874*f*f*rh+0.00085282*f*rh*rh-0.00000199*f*f*rh*rh as full_
  from (select *, tmax_c*9/5+32 as f from (
    select t.zone_id, t.date, t.tmax_k - 273.15 as tmax_c, case when h.rh < 0 then 0 when h.rh > 100 then 100 else h.rh end as rh, t.state from
      (select l_suppkey as zone_id, cast(l_shipdate as date) as date, avg(l_quantity)*0.8 + 273.15 as tmax_k, any_value('S' || (l_suppkey % 3)) as state from lineitem group by 1,2) t
      left join (select l_suppkey as zone_id, cast(l_shipdate as date) as date, avg(l_discount)*1500 - 5 as rh from lineitem where l_tax < 0.06 group by 1,2) h
      on h.zone_id=t.zone_id and h.date=t.date)))"""


@register("heat_index", _HEAT_SQL)
def heat_index(spark, sf):
    """Temperature from quantities and humidity from discounts, per supplier and day; both reach every branch."""
    line = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("zone_id"), F.to_date("l_shipdate").alias("date"), "l_quantity", "l_discount", "l_tax"
    )
    warm = line.groupBy("zone_id", "date").agg((F.avg("l_quantity") * 0.8 + 273.15).alias("tmax_k"))
    moist = line.filter("l_tax < 0.06").groupBy("zone_id", "date").agg((F.avg("l_discount") * 1500 - 5).alias("rh"))
    states = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("zone_id"), F.concat(F.lit("S"), (F.col("s_suppkey") % 3).cast("string")).alias("state")
    )
    out = plans.heat_index_panel(warm, moist, states)
    return out.withColumns({"tmax_c": F.round("tmax_c", 6), "rh": F.round("rh", 6)})


# ---- gates ---------------------------------------------------------------


def _gate(rows: list[tuple[str, str, str, str, str]], *names: str) -> str:
    """Rows (check, passed, observed, expected, severity) as SQL; names, expected and severity are SQL text."""
    return sql(
        " union all ".join(
            f"select {c} as check, coalesce({p}, false) as passed, cast({o} as double) as observed, {e} as expected, '{s}' as severity {f}"
            for c, p, o, e, s, f in rows
        ),
        *names,
    )


@register(
    "gate_shape",
    _gate(
        [
            ("'county: zones'", "count(distinct fips)=(select count(*) from zone_meta)", "count(distinct fips)", "cast((select count(*) from zone_meta) as varchar)", "error", "from panel"),
            ("'county: days'", "count(distinct date)=30", "count(distinct date)", "'30'", "error", "from panel"),
            ("'county: rows = zones x days'", "count(*)=(select count(*) from zone_meta)*30", "count(*)", "cast((select count(*) from zone_meta)*30 as varchar)", "error", "from panel"),
            (
                "'county: no duplicate key'",
                "count(*)=0",
                "count(*)",
                "'0'",
                "error",
                "from (select 1 from panel group by fips, date having count(*)>1)",
            ),
        ],
        "panel",
    ),
)
def gate_shape(spark, sf):
    return checks.check_shape(panel(spark, sf), "fips", n_zones(spark, sf), SETTINGS.n_days, "county")


@register(
    "shape_stats",
    """select count(*) as n_rows, count(distinct l_orderkey) as n_zones, count(distinct l_linenumber) as n_days,
       cast(min(l_linenumber) as int) as first_day, cast(max(l_linenumber) as int) as last_day,
       (select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*)>1)) as n_duplicate_keys from lineitem""",
)
def shape_stats(spark, sf):
    return checks.shape_stats(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


_PER_ERA = """(select e.era, start_date, end_date, end_date-start_date+1 as nd, z, n_rows, n_days, n_zones, a, b, d from eras e
    join (select era, count(distinct zone_id) as z from era_zones group by 1) using (era)
    left join (select era, count(*) as n_rows, count(distinct date) as n_days, count(distinct zone_id) as n_zones, min(date) as a, max(date) as b from era_dense group by 1) using (era)
    left join (select era, sum(case when n>1 then 1 else 0 end) as d from (select era, zone_id, date, count(*) as n from era_dense group by 1,2,3) group by 1) using (era))"""


@register(
    "gate_era_shape",
    _gate(
        [
            ("era || ': date range'", "a=start_date and b=end_date", "b-a", "cast(start_date as varchar) || '..' || cast(end_date as varchar)", "error", f"from {_PER_ERA}"),
            ("era || ': days'", "n_days=nd", "n_days", "cast(nd as varchar)", "error", f"from {_PER_ERA}"),
            ("era || ': zones match metadata'", "n_zones=z", "n_zones", "cast(z as varchar)", "error", f"from {_PER_ERA}"),
            ("era || ': rows = zones x days'", "n_rows=z*nd", "n_rows", "cast(z*nd as varchar)", "error", f"from {_PER_ERA}"),
            ("era || ': no duplicate key'", "d=0", "d", "'0'", "error", f"from {_PER_ERA}"),
        ],
        "era_dense",
        "eras",
        "era_zones",
    ),
)
def gate_era_shape(spark, sf):
    return checks.check_era_shape(postal(spark, sf), eras(spark, sf), view(spark, sf, "era_zones"))


@register(
    "gate_vintage",
    _gate(
        [
            (
                "era || ': no row outside its dates'",
                "n=0",
                "n",
                "'0'",
                "error",
                "from (select coalesce(r.era, e.era) as era, count(*) filter (where e.era is null or date not between start_date and end_date) as n from "
                "(select case user_id % 3 when 0 then 'e1' when 1 then 'e2' else 'e9' end as era, cast(ts as date) as date from events) r "
                "full join eras e on r.era = e.era group by 1)",
            )
        ],
        "eras",
    ),
)
def gate_vintage(spark, sf):
    """Rows labelled by user, so that both eras hold rows outside their dates and fail, as does an era nobody knows."""
    third = F.col("user_id") % 3
    era = F.when(third == 0, "e1").when(third == 1, "e2").otherwise("e9")
    rows = table(spark, sf, "events").select(era.alias("era"), F.to_date("ts").alias("date"))
    return checks.check_vintage(rows, eras(spark, sf))


_ORDER = (
    "'county: tmin <= tmean <= tmax'",
    "n=0 or b*1.0/n < 0.01",
    "b",
    "'share < 0.01'",
    "error",
    "from (select count(*) filter (where tmin > tmean or tmean > tmax) as b, count(*) as n from panel where tmin is not null and tmean is not null and tmax is not null)",
)


@register(
    "gate_failures",
    sql(
        """select era || ': no row outside its dates' as "check", cast(n as double) as observed from (
             select coalesce(r.era, e.era) as era, count(*) filter (where e.era is null or date not between start_date and end_date) as n from
             (select case user_id % 3 when 0 then 'e1' when 1 then 'e2' else 'e9' end as era, cast(ts as date) as date from events) r
             full join eras e on r.era = e.era group by 1) where n > 0""",
        "eras",
    ),
)
def gate_failures(spark, sf):
    """What ``enforce`` would stop at."""
    return checks.failures(gate_vintage(spark, sf)).select("check", "observed")


@register("gate_order", _gate([_ORDER], "panel"))
def gate_order(spark, sf):
    return checks.check_rules(panel(spark, sf), checks.order_rule(), "county")


def _none(name: str, condition: str) -> tuple[str, ...]:
    count = f"count(*) filter (where {condition})"
    return (f"'{name}'", f"{count}=0", count, "'0'", "error", "from panel")


@register(
    "gate_physical",
    _gate(
        [
            _none("county: ppt >= 0", "ppt < 0"),
            _none("county: tdmean <= tmax", "tdmean > tmax"),
            _none("county: 0 <= rh_mean <= 100", "rh_mean not between 0 and 100"),
            _none("county: vpd_mean >= 0", "vpd_mean < 0"),
        ],
        "panel",
    ),
)
def gate_physical(spark, sf):
    p = panel(spark, sf)
    return checks.check_rules(p, checks.physical_rules(p.columns), "county")


@register(
    "gate_physical_postal",
    _gate(
        [
            (
                "'postal: tdmean <= tmean'",
                "n=0 or b*1.0/n < 0.01",
                "b",
                "'share < 0.01'",
                "error",
                "from (select count(*) filter (where tdmean > tmean) as b, count(*) filter (where tdmean is not null and tmean is not null) as n from panel)",
            ),
            _none("postal: 0 <= rh_mean <= 100", "rh_mean not between 0 and 100"),
            _none("postal: vpd_mean >= 0", "vpd_mean < 0"),
        ],
        "panel",
    ),
)
def gate_physical_postal(spark, sf):
    p = panel(spark, sf)
    return checks.check_rules(p, checks.physical_rules(p.columns, postal=True), "postal")


@register(
    "gate_ranges",
    _gate(
        [
            (
                f"'county: {v} within [{fv.PLAUSIBLE_RANGES[v][0]:g}, {fv.PLAUSIBLE_RANGES[v][1]:g}]'",
                f"count(*) filter (where {v} < {fv.PLAUSIBLE_RANGES[v][0]} or {v} > {fv.PLAUSIBLE_RANGES[v][1]})=0",
                f"count(*) filter (where {v} < {fv.PLAUSIBLE_RANGES[v][0]} or {v} > {fv.PLAUSIBLE_RANGES[v][1]})",
                "'0'",
                "error",
                "from wide",
            )
            for v in fv.COUNTY_VARIABLES
        ],
        "wide",
    ),
)
def gate_ranges(spark, sf):
    """On the merged values before plausibility nulling, so that the ranges have work."""
    w = wide(spark, sf)
    return checks.check_rules(w, checks.range_rules(w.columns), "county")


@register(
    "gate_rollup",
    _gate(
        [("'roll-up reproduces: same keys'", "true", "0", "'0'", "error", "")]
        + [(f"'roll-up reproduces: {v}'", "true", "0", "'0'", "error", "") for v in ALL]
    ),
)
def gate_rollup(spark, sf):
    p = panel(spark, sf)
    return checks.check_rollup(p, cz_panel(spark, sf), ["cz_id", "date"], ALL)


@register(
    "rollup_gap",
    _gate(
        [("'tampered: same keys'", "count(*)=0", "count(*)", "'0'", "error", "from cz_panel where day(date) = 20")]
        + [
            (
                f"'tampered: {v}'",
                "count(*)=0",
                "count(*)",
                "'0'",
                "error",
                f"from cz_panel where day(date) <= 10 and {v} is not null or day(date) in (11, 20) and {v} is not null or day(date) = 12 and {v} is null",
            )
            for v in ("tmax", "ppt")
        ],
        "cz_panel",
    ),
)
def rollup_gap(spark, sf):
    """A stored panel with shifted values, values lost and made up, and a day without rows must be caught on each."""
    p = rollup.weighted_rollup(panel(spark, sf), ["cz_id", "date"], ("tmax", "ppt"), members=None)
    day = F.dayofmonth("date")
    wrong = lambda v: (
        F.when(day <= 10, F.col(v) + 0.001).when(day == 11, F.lit(None)).when(day == 12, F.coalesce(v, F.lit(0.0))).otherwise(F.col(v))
    )
    bad = p.withColumns({v: wrong(v) for v in ("tmax", "ppt")}).filter(day != 20)
    return checks.compare_panels(p, bad, ["cz_id", "date"], ("tmax", "ppt"), fv.ROLLUP_TOLERANCE, "tampered")


@register(
    "gate_geography",
    _gate(
        [
            ("'geography: counties'", "true", "count(distinct fips)", "cast((select count(*) from zone_meta) as varchar)", "error", "from zone_meta"),
            ("'geography: zones'", "count(distinct cz_id)=(select count(*) from cz_meta)", "count(distinct cz_id)", "cast((select count(*) from cz_meta) as varchar)", "error", "from zone_meta"),
            ("'geography: every county in one zone'", "count(*)=0", "count(*)", "'0'", "error", "from (select fips from zone_meta group by 1 having count(distinct cz_id)<>1)"),
            ("'geography: members per day'", "abs(sum(n_counties)/30.0-(select count(*) from zone_meta))<1e-9", "sum(n_counties)/30.0", "cast((select count(*) from zone_meta) as varchar)", "error", "from cz_panel"),
        ],
        "cz_panel",
        "cz_meta",
    ),
)
def gate_geography(spark, sf):
    return checks.check_geography(view(spark, sf, "zone_meta"), cz_panel(spark, sf), n_zones(spark, sf), view(spark, sf, "cz_meta").count(), SETTINGS.n_days)


_CROSS = """select r.fips, r.date, rolled, own from
    (select county_fips as fips, date, sum(tmax*area_km2)/sum(area_km2) as rolled from
       (select zone_id, era, date, case when tmax between -30 and 55 then tmax end as tmax from era_dense) join era_zones using (era, zone_id)
     where tmax is not null group by 1,2) r join (select fips, date, tmax as own from panel) p on p.fips=r.fips and p.date=r.date"""


@register("cross_panel", sql(f"select fips, date, {rsql('rolled', 'own')} from ({_CROSS})", "era_dense", "era_zones", "panel"))
def cross_panel(spark, sf):
    return checks.cross_panel(postal(spark, sf), panel(spark, sf)).select("fips", "date", r("rolled"), r("own"))


@register(
    "gate_cross_panel",
    _gate(
        [
            (
                "'cross-panel: roll-up near parent'",
                "n=0 or far*1.0/n <= 0.01",
                "far",
                "'share <= 0.01'",
                "error",
                f"from (select count(*) filter (where abs(rolled-own)>1.5) as far, count(*) as n from ({_CROSS}))",
            )
        ],
        "era_dense",
        "era_zones",
        "panel",
    ),
)
def gate_cross_panel(spark, sf):
    return checks.check_cross_panel(postal(spark, sf), panel(spark, sf))


@register(
    "gate_climatology",
    _gate(
        [("'climatology: 2 month 1 tmax'", "count(*)=0 or round(avg(tmax),6) between 5 and 25", "round(avg(tmax),6)", "'5..25'", "error", "from cz_panel where cz_id='2' and month=1")],
        "cz_panel",
    ),
)
def gate_climatology(spark, sf):
    out = checks.check_climatology(cz_panel(spark, sf), "2", 1, 5.0, 25.0)
    return out.withColumn("observed", r("observed"))


@register(
    "gate_spot",
    _gate(
        [
            (
                "'spot: 48000000007 2024-01-02..2024-01-08 tmax'",
                "count(*)=0 or avg(tmax) between 30 and 42",
                "round(avg(tmax),6)",
                "'30..42'",
                "error",
                "from panel where fips='48000000007' and date between date '2024-01-02' and date '2024-01-08'",
            )
        ],
        "panel",
    ),
)
def gate_spot(spark, sf):
    out = checks.check_spot(panel(spark, sf), "48000000007", date(2024, 1, 2), date(2024, 1, 8), 30.0, 42.0, key="fips")
    return out.withColumn("observed", r("observed"))


@register(
    "gate_band",
    _gate([("'rows in band'", "count(*) between 8000 and 15000", "count(*)", "'8000..15000'", "warning", "from events")]),
)
def gate_band(spark, sf):
    return checks.check_band(table(spark, sf, "events"), 8000, 15000, "rows in band", "warning")


@register(
    "gate_meta",
    _gate(
        [
            ("'metadata: c_custkey count'", "count(distinct c_custkey)=1500", "count(distinct c_custkey)", "'1500'", "error", "from customer"),
            ("'metadata: c_mktsegment given'", "count(*)=0", "count(*)", "'0'", "error", "from customer where c_mktsegment is null"),
        ]
    ),
)
def gate_meta(spark, sf):
    return checks.check_meta(table(spark, sf, "customer"), "c_custkey", 1500, ["c_mktsegment"])


@register(
    "gate_extract",
    _gate(
        [
            ("'extract: rows = days x zones'", "count(*)=(select count(*) from zone_meta)*30", "count(*)", "cast((select count(*) from zone_meta)*30 as varchar)", "error", "from panel"),
            ("'extract: dates given'", "count(*)=0", "count(*)", "'0'", "error", "from panel where date is null"),
            ("'extract: missing values'", "true", "count(*)", "'reported'", "info", "from panel where tmax is null"),
            ("'extract: smallest value'", "true", "round(min(tmax),6)", "'reported'", "info", "from panel"),
            ("'extract: largest value'", "true", "round(max(tmax),6)", "'reported'", "info", "from panel"),
        ],
        "panel",
    ),
)
def gate_extract(spark, sf):
    out = checks.check_extract(panel(spark, sf), "fips", "tmax", SETTINGS.n_days, n_zones(spark, sf))
    return out.withColumn("observed", r("observed"))


# ---- files ---------------------------------------------------------------


@register("panel_parquet", sql(f"select fips, date, year, {rsql(*ALL)} from panel", "panel"))
def panel_parquet(spark, sf):
    """Panel written as ordered Parquet by year and read back."""
    path = scratch_path(spark, "panel")
    sinks.write_panel(panel(spark, sf), path, "fips")
    return tables.read_panel(spark, path).select("fips", "date", "year", *[r(v) for v in ALL])


@register(
    "extracts_csv",
    sql("select fips, date, var, round(value,6) as value from weather_long", "weather_long"),
)
def extracts_csv(spark, sf):
    """Per-variable CSV extracts, read back as one long table by name."""
    root = write_extract_files(spark, sf)
    return tables.read_extracts(spark, root, ALL_LONG, "fips").withColumn("value", r("value"))


ALL_LONG = ("tmean", "tmin", "tmax", "tdmean", "ppt")


def write_extract_files(spark, sf):
    """One extract per variable, and one under a name that does not count."""
    long = view(spark, sf, "weather_long")
    root = scratch_path(spark, "extracts")
    for var in ALL_LONG:
        sinks.write_csv(long.filter(F.col("var") == var).select("fips", "date", "value"), f"{root}/{var}_2024.csv")
    sinks.write_csv(long.filter("var = 'tmax'").select("fips", "date", "value"), f"{root}/tmax_2024_test.csv")
    return root


@register(
    "skipped_files",
    sql(
        """select var || '_2024.csv' as file, count(*) as n_rows, cast(0 as bigint) as n_bad_dates, 'read' as status from weather_long group by 1
           union all select 'tmax_2024_test.csv', 0, 0, 'stray'
           union all select 'tmin_2023.csv', 0, 0, 'skipped'
           union all select 'ppt_2022.csv', count(*), count(*), 'damaged' from weather_long where var = 'ppt'""",
        "weather_long",
    ),
)
def skipped_files(spark, sf):
    """Every extract file by name: those read, a stray one, an empty one and one whose dates cannot be read."""
    root = write_extract_files(spark, sf)
    long = view(spark, sf, "weather_long").select("fips", "date", "value", "var")
    sinks.write_csv(long.filter("var is null").drop("var"), f"{root}/tmin_2023.csv")
    bad = long.filter("var = 'ppt'").select("fips", F.concat(F.lit("day "), F.col("date").cast("string")).alias("date"), "value")
    sinks.write_csv(bad, f"{root}/ppt_2022.csv")
    return tables.extract_report(spark, root, ALL_LONG, "fips")


@register(
    "duplicate_keys",
    """select user_id as fips, cast(ts as date) as date, event_type as var, count(*) as n_rows from events group by 1,2,3 having count(*) > 1""",
)
def duplicate_keys(spark, sf):
    """Events as unmerged extract rows: users with several events of one type on one day."""
    rows = table(spark, sf, "events").select(F.col("user_id").alias("fips"), F.to_date("ts").alias("date"), F.col("event_type").alias("var"))
    return rollup.duplicate_keys(rows, ["fips", "date"])


@register(
    "sink_report",
    sql(
        f"select count(*) as n_rows, {2 + len(ALL) + 13} as n_columns, true as parquet_smaller from panel",
        "panel",
    ),
)
def sink_report(spark, sf):
    """Rows and columns of a panel's two written forms, and which is smaller (bytes depend on the writer)."""
    p = materialize(panel(spark, sf), "sink-panel")
    a, b = scratch_path(spark, "panel-csv"), scratch_path(spark, "panel-parquet")
    sinks.write_csv(p, a, ["fips", "date"])
    sinks.write_panel(p, b, "fips")
    report = sinks.sink_report(p, a, b)
    return report.select("n_rows", "n_columns", (F.col("parquet_bytes") < F.col("csv_bytes")).alias("parquet_smaller"))
