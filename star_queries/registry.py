"""Query registry, input views and the rounding shared by both sides."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# One text per input view; it runs unchanged in Spark and in DuckDB.  ``_q`` is
# the number of a line item's diagnosis position.
_code = "concat(cast(cast(floor(l_partkey/10) as bigint) as string),'.',cast(l_partkey%10 as string))"

VIEWS: dict[str, str] = {
    "claims": """
        select o_orderkey as bill_id, cast(o_orderdate as date) as bill_date, o_totalprice as charge,
          lpad(cast(o_custkey as string),5,'0') as zip,
          case o_orderstatus when 'F' then 'F' when 'O' then 'M' else '' end as gender,
          case substring(o_orderpriority,1,1) when '1' then 'M' when '2' then 'I' when '3' then 'S'
            when '4' then 'U' else '' end as marital,
          concat(lpad(cast(1 + o_custkey % 12 as string),2,'0'),'/',cast(1905 + o_custkey % 90 as string)) as dob_my
        from orders""",
    "claim_codes": "select l_orderkey as bill_id, "
    + ", ".join(f"max(case when l_linenumber={i} then {_code} end) as icd{i}" for i in range(1, 6))
    + " from lineitem group by l_orderkey",
    "dictionary": """
        select concat(cast(cast(floor(p_partkey/10) as bigint) as string),cast(p_partkey%10 as string)) as code,
          p_name as description from part""",
    "zip2cnty": """
        select lpad(cast(c_custkey as string),5,'0') as zip,
          concat('48',lpad(cast(c_nationkey as string),3,'0')) as fips,
          cast((c_custkey % 11)/10.0 as double) as res_ratio from customer
        union all
        select lpad(cast(c_custkey as string),5,'0'),
          concat('48',lpad(cast((c_nationkey+7)%25 as string),3,'0')),
          cast((c_custkey % 7)/10.0 as double) from customer""",
    "cnty2cz": """
        select concat('48',lpad(cast(n_nationkey as string),3,'0')) as fips, n_name as county_name,
          case when n_nationkey < 20 then 'Texas' else 'Other' end as state,
          cast(n_regionkey as string) as cz_id, r_name as cz_name
        from nation join region on n_regionkey = r_regionkey""",
    "employment": """
        select concat('48',lpad(cast(s_nationkey as string),3,'0')) as fips,
          cast(year(l_shipdate) as int) as yr, cast(month(l_shipdate) as int) as mon, sum(l_quantity) as emp
        from lineitem join supplier on l_suppkey = s_suppkey group by 1,2,3""",
    # one zone per user and day of events
    "weather_long": """
        select concat('48',lpad(cast(user_id as string),9,'0')) as fips, cast(ts as date) as date,
          case event_type when 'click' then 'tmean' when 'view' then 'tmin' when 'purchase' then 'tmax'
            when 'signup' then 'tdmean' else 'ppt' end as var,
          avg(case when event_type='error' then value/10 else value/3 - 5 end) as value
        from events group by 1,2,3""",
    # five zones in a row share a parent, named after a nation
    "zone_meta": """
        select concat('48',lpad(cast(u as string),9,'0')) as fips, concat('county ',cast(u as string)) as county_name,
          cast(cast(floor(u/5) as bigint) as string) as cz_id, n_name as cz_name,
          cast(500 + (u % 25)*137.0 as double) as area_km2,
          cast(-106 + (u % 25)*0.5 as double) as centroid_lon,
          cast(26 + (u % 25)*0.4 as double) as centroid_lat
        from (select distinct user_id as u from events) z join nation on n_nationkey = cast(floor(u/5) as bigint) % 25""",
    "cz_meta": """
        select cz_id, cz_name, sum(area_km2) as area_km2, avg(centroid_lon) as centroid_lon, avg(centroid_lat) as centroid_lat
        from zone_meta group by 1,2""",
    "eras": """
        select 'e1' as era, date '2024-01-01' as start_date, date '2024-01-15' as end_date, 0 as lo, 19 as hi
        union all select 'e2', date '2024-01-16', date '2024-01-30', 5, 24""",
    "era_zones": """
        select era, concat('48',lpad(cast(u as string),9,'0')) as zone_id,
          cast(500 + (u % 25)*137.0 as double) as area_km2,
          concat('48',lpad(cast(cast(floor(u/5) as bigint) as string),9,'0')) as county_fips
        from (select distinct user_id as u from events) z join eras on u % 25 between lo and hi""",
    "grid": """
        select l_returnflag as var, cast(l_shipdate as date) as date,
          cast(floor((l_suppkey % 100)/10) as int) as row, cast((l_suppkey % 100) % 10 as int) as col,
          avg(l_quantity) as value
        from lineitem group by 1,2,3,4""",
    # one zone per supplier and one row per day on which it shipped; values are missing where nothing counted
    "supply_panel": """
        select concat('s',cast(l_suppkey as string)) as zone_id, cast(l_shipdate as date) as date,
          cast(year(l_shipdate) as int) as year,
          avg(case when l_returnflag <> 'R' then cast(l_quantity as double) end) as tmax,
          avg(case when l_discount > 0.02 then cast(l_quantity as double) / 2 end) as tmin,
          sum(case when l_linestatus = 'O' then cast(l_tax as double) * 100 end) as ppt
        from lineitem group by 1,2,3""",
    "rect_polygons": """
        select concat('48',lpad(cast(n_nationkey as string),3,'0')) as zone_id,
          cast(0.13 + (n_nationkey % 5)*1.9 as double) as x0, cast(0.13 + (n_nationkey % 5)*1.9 + 1.9 as double) as x1,
          cast(0.21 + floor(n_nationkey/5)*1.9 as double) as y0,
          cast(0.21 + floor(n_nationkey/5)*1.9 + 1.9 as double) as y1 from nation""",
    # one irregular quadrilateral per supplier, in degrees: lower left, lower right, upper right, upper left
    "quads": """
        select concat('s',cast(s_suppkey as string)) as zone_id,
          -106.0 + (s_suppkey % 97)*0.13 as ax, 26.0 + (s_suppkey % 89)*0.11 as ay,
          -105.8 + (s_suppkey % 97)*0.13 as bx, 26.05 + (s_suppkey % 89)*0.11 as by_,
          -105.75 + (s_suppkey % 97)*0.13 as cx, 26.3 + (s_suppkey % 89)*0.11 as cy,
          -105.96 + (s_suppkey % 97)*0.13 as dx, 26.21 + (s_suppkey % 89)*0.11 as dy
        from supplier""",
    # one rectangle per supplier and one per nation, in one plane, for overlaps
    "boxes_a": """
        select concat('s',cast(s_suppkey as string)) as zone_id,
          cast((s_suppkey % 97)*0.37 as double) as x0, cast((s_suppkey % 97)*0.37 + 1.1 as double) as x1,
          cast((s_suppkey % 89)*0.29 as double) as y0, cast((s_suppkey % 89)*0.29 + 0.9 as double) as y1
        from supplier""",
    "boxes_b": """
        select concat('n',cast(n_nationkey as string)) as zone_id,
          cast((n_nationkey % 5)*7.3 as double) as x0, cast((n_nationkey % 5)*7.3 + 7.3 as double) as x1,
          cast(floor(n_nationkey/5)*5.3 as double) as y0, cast(floor(n_nationkey/5)*5.3 + 5.3 as double) as y1
        from nation""",
    "sites": """
        select c_custkey as point_id, cast(-106.3 + (c_custkey % 1009)*0.0131 as double) as x,
          cast(25.9 + (c_custkey % 997)*0.0109 as double) as y from customer""",
    # a file catalog: one variable per supplier, a day counts as present when it shipped anything
    "catalog": """
        select concat('v',cast(l_suppkey as string)) as var, cast(l_shipdate as date) as date,
          count(*) as length from lineitem group by 1,2""",
    "cleaned": """
        select c.*, make_date(cast(substring(dob_my,4,4) as int), cast(substring(dob_my,1,2) as int), 1) as dob
        from claims c""",
}

_NEEDS = {"cleaned": ("claims",), "era_zones": ("eras",), "cz_meta": ("zone_meta",)}

# Restatements of the engine's own intermediate results, DuckDB only.
STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    "geo": (
        ("zip2cnty", "cnty2cz"),
        """select zip, fips, county_name, state, cz_id, cz_name
           from (select *, row_number() over (partition by zip order by res_ratio desc nulls last, fips) as rn
                 from zip2cnty) z join cnty2cz using (fips) where rn = 1 and state = 'Texas'""",
    ),
    "aged": (
        ("cleaned",),
        """select * exclude (gender), case when gender='' then 'U' else gender end as gender from
           (select *, (bill_date - dob) / 365.25 as age from cleaned) where age between 14 and 95""",
    ),
    "mapped": (("aged", "geo"), "select * from aged left join geo using (zip)"),
    "labelled": (
        ("aged",),
        """select * exclude (gender, marital),
             case gender when 'F' then 'Female' when 'M' then 'Male' else 'Unknown' end as gender,
             case marital when 'I' then 'Single' when 'K' then 'Unknown' when 'M' then 'Married'
               when 'S' then 'Separated' when 'U' then 'Widowed' when '' then 'Unknown' else marital end as marital
           from aged""",
    ),
    "coded": (("claims", "claim_codes"), "select * from claims left join claim_codes using (bill_id)"),
    "heat_codes": (
        ("dictionary",),
        """select code, description from dictionary where regexp_matches(lower(description), 'hot|red')
           and not regexp_matches(lower(description), 'bolt|rod')""",
    ),
    "flagged": (
        ("coded", "heat_codes"),
        "select *, "
        + " or ".join(f"coalesce(replace(icd{i},'.','') in (select code from heat_codes), false)" for i in range(1, 6))
        + " as is_heat from coded",
    ),
    "heat_claims": (("flagged", "geo"), "select * from flagged left join geo using (zip)"),
    "heat_daily": (
        ("heat_claims",),
        """select bill_date, count(*) as n, count(*) filter (where is_heat) as n_flagged,
             count(*) filter (where cz_id in ('1','3')) as n_target from heat_claims group by 1""",
    ),
    "daily": (
        ("mapped",),
        """select cz_id, bill_date, count(*) as n_claims from mapped
           where cz_id is not null and bill_date is not null group by 1, 2""",
    ),
    "emp_cz": (
        ("employment", "geo"),
        """with q as (select fips, yr as year, cast(ceil(mon/3.0) as int) as qtr,
                 case when count(*) = 3 then sum(emp)/3 end as avg_emp from employment group by 1,2,3)
           select cz_id, year, qtr, coalesce(sum(avg_emp),0) as emp_cz
           from q join (select distinct fips, cz_id from geo) g using (fips) group by 1,2,3""",
    ),
    "rates": (
        ("daily", "emp_cz"),
        """select s.cz_id, s.date, cast(coalesce(n_claims,0) as bigint) as n_claims,
             cast(year(s.date) as int) as year, cast(month(s.date) as int) as month,
             cast(day(s.date) as int) as day, cast(quarter(s.date) as int) as qtr, emp_cz,
             case when emp_cz > 0 then coalesce(n_claims,0)/emp_cz*100000 end as claims_per_100k
           from (select cz_id, cast(unnest(generate_series((select min(bill_date) from daily),
                   (select max(bill_date) from daily), interval 1 day)) as date) as date
                 from (select distinct cz_id from daily)) s
           left join daily d on d.cz_id=s.cz_id and d.bill_date=s.date
           left join emp_cz e on e.cz_id=s.cz_id and e.year=year(s.date) and e.qtr=quarter(s.date)""",
    ),
    "seasonal": (
        ("rates",),
        """select cz_id, year, month, avg(claims_per_100k) as avg_daily from rates
           where date < date '2024-02-01' and year not in (2020,2021) and claims_per_100k is not null group by 1,2,3""",
    ),
    "wide": (
        ("weather_long",),
        "select fips, date, "
        + ", ".join(f"max(case when var='{v}' then value end) as {v}" for v in ("ppt", "tmax", "tmin", "tmean", "tdmean"))
        + " from weather_long group by 1,2",
    ),
    "dense": (
        ("wide", "zone_meta"),
        """select s.fips, s.date, ppt, tmax, tmin, tmean, tdmean from
           (select fips, cast(unnest(generate_series(date '2024-01-01', date '2024-01-30', interval 1 day)) as date) as date
            from zone_meta) s left join wide w on w.fips=s.fips and w.date=s.date""",
    ),
    "humid": (
        ("dense",),
        """select *, case when rh < 0 then 0 when rh > 100 then 100 else rh end as rh_mean,
             case when vpd < 0 then 0 else vpd end as vpd_mean
           from (select *, 100*ed/em as rh, em-ed as vpd from
             (select *, 0.6108*exp(17.27*tdmean/(tdmean+237.3)) as ed, 0.6108*exp(17.27*tmean/(tmean+237.3)) as em from dense))""",
    ),
    "panel": (
        ("humid", "zone_meta"),
        "select fips, date, county_name, cz_id, cz_name, area_km2, centroid_lon, centroid_lat, "
        "cast(year(date) as int) as year, cast(month(date) as int) as month, "
        + ", ".join(
            f"case when {v} between {lo} and {hi} then {v} end as {v}"
            for v, lo, hi in (
                ("ppt", -0.1, 800),
                ("tmax", -30, 55),
                ("tmin", -35, 40),
                ("tmean", -30, 50),
                ("tdmean", -40, 35),
                ("rh_mean", 0, 100),
                ("vpd_mean", 0, 10),
            )
        )
        + " from humid join zone_meta using (fips)",
    ),
    "cz_panel": (
        ("panel",),
        "select cz_id, date, cast(year(date) as int) as year, cast(month(date) as int) as month, count(*) as n_counties, "
        + ", ".join(
            f"sum({v}*area_km2) / nullif(sum(case when {v} is not null then area_km2 end), 0) as {v}"
            for v in ("ppt", "tmax", "tmin", "tmean", "tdmean", "rh_mean", "vpd_mean")
        )
        + " from panel group by 1,2",
    ),
    "era_dense": (
        ("wide", "eras", "era_zones"),
        """select s.era, s.zone_id, s.date, tmax, tmin, tmean, tdmean from
           (select era, zone_id, cast(unnest(generate_series(start_date, end_date, interval 1 day)) as date) as date
            from era_zones join eras using (era)) s
           left join wide w on w.fips=s.zone_id and w.date=s.date""",
    ),
    "cover": (
        ("rect_polygons",),
        """select zone_id, row, col, cov from (
             select zone_id, cast(r as int) as row, cast(c as int) as col,
               greatest(0, least(x1,c+1)-greatest(x0,c)) * greatest(0, least(y1,r+1)-greatest(y0,r)) as cov
             from rect_polygons, range(0,10) a(r), range(0,10) b(c)) where cov > 1e-12""",
    ),
    "missing": (
        ("catalog",),
        """select v.var, v.date from (select var, cast(unnest(generate_series((select min(date) from catalog),
             (select max(date) from catalog), interval 1 day)) as date) as date
             from (select distinct var from catalog)) v
           anti join catalog c on c.var=v.var and c.date=v.date""",
    ),
    "blocks": (
        ("missing",),
        """select var, min(date) as min_date, max(date) as max_date from
           (select var, date, date - cast(row_number() over (partition by var order by date) as int) as g from missing)
           group by var, g""",
    ),
}


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its footer is read for the schema once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input view over the tables of ``sf_dir``."""
    needs = _NEEDS.get(name, ())
    text = " ".join(VIEWS[n] for n in (name, *needs))
    for t in TABLES:
        if re.search(rf"\b{t}\b", text):
            table(spark, sf_dir, t).createOrReplaceTempView(t)
    for need in needs:
        spark.sql(VIEWS[need]).createOrReplaceTempView(need)
    return spark.sql(VIEWS[name])


def sql(select: str, *names: str) -> str:
    """``select`` preceded by the named steps and views, each after what it needs."""
    order: list[tuple[str, str]] = []

    def add(name: str) -> None:
        if any(n == name for n, _ in order):
            return
        needs, text = STEPS[name] if name in STEPS else (_NEEDS.get(name, ()), VIEWS[name])
        for n in needs:
            add(n)
        order.append((name, text))

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} as ({t})" for n, t in order)
    return f"with {ctes}\n{select}" if order else select


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return keep


def r(c: Column | str, digits: int = 6) -> Column:
    """Rounded under its own name."""
    if isinstance(c, str):
        return F.round(c, digits).alias(c)
    return F.round(c, digits)


def rsql(*columns: str, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) as {c}" for c in columns)
