"""Reports from partial sums by year, suppliers as zones and ship dates as days; panels judged while they are written."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from star_queries.registry import r, register, sql, table, view
from zoneday import fixed_values as fv
from zoneday.operators import audit, keys, partials
from zoneday.session import materialize, scratch_path
from zoneday.sources import sinks

VARIABLES = ("tmax", "tmin", "ppt")


def merged(spark: SparkSession, sf: str) -> DataFrame:
    """Partials of a panel that was written without its last year first, and got that year afterwards."""
    whole = materialize(view(spark, sf, "supply_panel"), "supply-panel")
    panel, store = scratch_path(spark, "panel"), scratch_path(spark, "partials")
    last = F.col("year") == whole.agg(F.max("year").alias("y")).scalar()
    sinks.write_panel(whole.filter(~last), panel, "zone_id")
    partials.refresh_partials(spark, panel, store, "zone_id", VARIABLES)
    sinks.write_panel(whole.filter(last), panel, "zone_id", mode="append")
    if len(partials.refresh_partials(spark, panel, store, "zone_id", VARIABLES)) > 1:
        raise RuntimeError("a year that had not changed was read again")
    return partials.read_partials(spark, panel, store)


def _each(text: str) -> str:
    return " union all ".join(text.format(v=v) for v in VARIABLES)


@register(
    "coverage_merged",
    sql(
        "select *, pct_valid < 99 as low from ("
        + _each("select year, '{v}' as variable, round(count({v})*100.0/count(*),6) as pct_valid, count({v}) as n from supply_panel group by 1")
        + ")",
        "supply_panel",
    ),
)
def coverage_merged(spark, sf):
    return partials.coverage_merged(merged(spark, sf), fv.COVERAGE_FLOOR_POSTAL).withColumn("pct_valid", r("pct_valid"))


@register(
    "report_merged",
    sql(
        """select 'rows' as item, '' as detail, count(*) as n, cast(null as double) as value from supply_panel
           union all select 'zones', '', count(distinct zone_id), null from supply_panel
           union all select 'first_day', cast(min(date) as varchar), null, null from supply_panel
           union all select 'last_day', cast(max(date) as varchar), null, null from supply_panel
           union all select 'calendar_days', '', max(date)-min(date)+1, null from supply_panel union all """
        + _each(
            "select 'pct_valid', '{v}', count({v}), round(count({v})*100.0/count(*),6) from supply_panel"
            " union all select 'mean', '{v}', count({v}), round(avg({v}),6) from supply_panel"
        ),
        "supply_panel",
    ),
)
def report_merged(spark, sf):
    return partials.report_merged(merged(spark, sf)).withColumn("value", r("value"))


@register(
    "inventory_merged",
    sql(
        _each(
            "select year, '{v}' as variable, count(*) as rows, count({v}) as n, round(avg({v}),6) as mean,"
            " round(min({v}),6) as lo, round(max({v}),6) as hi from supply_panel group by 1"
        ),
        "supply_panel",
    ),
)
def inventory_merged(spark, sf):
    out = partials.inventory_merged(merged(spark, sf))
    return out.select("year", "variable", "rows", "n", r("mean"), r("lo"), r("hi"))


# ---- panels judged while they are written --------------------------------

FIRST, LAST = date(1995, 1, 1), date(2001, 7, 31)
MIDDLE = date(1998, 1, 1)
# rows of open orders claim the first era whatever their day, so both eras hold faults; those in part delivered know no era
_ORDERS = f"""with o as (select o_orderpriority as zone, cast(o_orderdate as date) as day, o_totalprice as price,
    case when o_orderstatus = 'O' then 'early' when o_orderstatus = 'P' then 'other' when o_orderdate < timestamp '{MIDDLE}' then 'early' else 'late' end as era
    from orders)"""


def order_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as rows of (priority, day): several per key, so the gates have something to find."""
    day, status = F.to_date("o_orderdate"), F.col("o_orderstatus")
    era = F.when(status == "O", "early").when(status == "P", "other").when(day < F.lit(MIDDLE), "early").otherwise("late")
    return table(spark, sf, "orders").select(F.col("o_orderpriority").alias("zone"), day.alias("date"), F.col("o_totalprice").alias("price"), era.alias("era"))


def judged(spark: SparkSession, panel: DataFrame, a: audit.Audit) -> DataFrame:
    """What the write counted; the staged panel itself isn't read."""
    s = audit.stage_panel(panel, scratch_path(spark, "audited"), a)
    audit.discard(spark, [s])
    results = keys.stack([s.shape, s.values]) if s.values else s.shape
    return results.select("check", "passed", F.round("observed", 4).alias("observed"), "severity")


@register(
    "audited_write",
    f"""{_ORDERS},
    k as (select zone, day, count(*) as n from o group by all),
    one as (select count(*) as n, count(distinct zone) as z, count(distinct day) as d, count_if(day not between date '{FIRST}' and date '{LAST}') as outside,
        count_if(price >= 100000) as dear, count_if(price < 0) as below, avg(price) filter (where zone = '1-URGENT') as urgent,
        (select count_if(n > 1) from k) as twice from o),
    days as (select date '{LAST}' - date '{FIRST}' + 1 as nd)
    select "check", passed, round(cast(observed as double), 4) as observed, 'error' as severity from (
        select unnest([
            {{'check': 'orders: zones', 'passed': z = 5, 'observed': cast(z as double)}},
            {{'check': 'orders: days', 'passed': d = nd, 'observed': d}},
            {{'check': 'orders: rows = zones x days', 'passed': n = 5 * nd, 'observed': n}},
            {{'check': 'orders: no duplicate key', 'passed': twice = 0, 'observed': twice}},
            {{'check': 'orders: no row outside its dates', 'passed': outside = 0, 'observed': outside}},
            {{'check': 'orders: few dear ones', 'passed': dear < 0.9 * n, 'observed': dear}},
            {{'check': 'orders: price >= 0', 'passed': below = 0, 'observed': below}},
            {{'check': 'urgent price', 'passed': urgent between 1000 and 1000000, 'observed': urgent}}], recursive := true)
        from one, days)""",
)
def audited_write(spark, sf):
    rules = {"few dear ones": (F.col("price") >= 100000, 0.9), "price >= 0": (F.col("price") < 0, 0.0)}
    mean = audit.Mean("urgent price", F.col("zone") == "1-URGENT", "price", 1000.0, 1000000.0)
    return judged(spark, order_panel(spark, sf), audit.Audit("orders", "zone", 5, FIRST, LAST, rules=rules, means=[mean]))


@register(
    "audited_eras",
    f"""{_ORDERS},
    eras as (select * from (values ('early', date '{FIRST}', date '{MIDDLE}' - 1), ('late', date '{MIDDLE}', date '{LAST}')) as t(era, head, tail)),
    k as (select era, zone, day, count(*) as n from o group by all),
    one as (select era, any_value(head) as head, any_value(tail) as tail, any_value(tail) - any_value(head) + 1 as nd, count(*) as n,
        count(distinct zone) as z, count(distinct day) as d, min(day) as a, max(day) as b, count_if(day not between head and tail) as outside
        from o join eras using (era) group by 1),
    twice as (select era, count_if(n > 1) as twice from k group by 1)
    select unnest([
        {{'check': era || ': date range', 'passed': a = head and b = tail, 'observed': cast(b - a as double)}},
        {{'check': era || ': days', 'passed': d = nd, 'observed': d}},
        {{'check': era || ': zones match metadata', 'passed': z = 5, 'observed': z}},
        {{'check': era || ': rows = zones x days', 'passed': n = 5 * nd, 'observed': n}},
        {{'check': era || ': no duplicate key', 'passed': twice = 0, 'observed': twice}},
        {{'check': era || ': no row outside its dates', 'passed': outside = 0, 'observed': outside}}], recursive := true), 'error' as severity
    from one join twice using (era)
    union all select 'orders: no row of an unknown era', count(*) = 0, count(*), 'error' from o where era = 'other'
    union all select 'orders: rows', count(*) between 1 and 1000, count(*), 'warning' from o""",
)
def audited_eras(spark, sf):
    eras = [audit.Era("early", 5, FIRST, MIDDLE - timedelta(days=1)), audit.Era("late", 5, MIDDLE, LAST)]
    return judged(spark, order_panel(spark, sf), audit.Audit("orders", "zone", eras=eras, band=(1, 1000)))
