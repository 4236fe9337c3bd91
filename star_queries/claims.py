"""Claims half: crosswalk, cleaning, counts, employment, rates, tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from star_queries.registry import r, register, rsql, sql, table, view
from zoneday import fixed_values as fv
from zoneday.functions import clean, report
from zoneday.functions.weather import rate_per
from zoneday.operators import dense, keys, rollup, summaries
from zoneday.plans import claims as plans
from zoneday.session import materialize, scratch_path
from zoneday.sources import sinks, tables

INCLUDE, EXCLUDE = ("hot", "red"), ("bolt", "rod")


# ---- inputs --------------------------------------------------------------


def geo(spark: SparkSession, sf: str) -> DataFrame:
    return keys.build_geo(view(spark, sf, "zip2cnty"), view(spark, sf, "cnty2cz"))


def raw_claims(spark: SparkSession, sf: str) -> DataFrame:
    """The claims view with dates and money as the text the source files hold."""
    return view(spark, sf, "claims").withColumns(
        {
            "bill_date": F.date_format("bill_date", "M/d/yyyy"),
            "charge": F.concat(F.lit("$"), F.format_number("charge", 2)),
        }
    )


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return tables.clean_claims(raw_claims(spark, sf))


def mapped(spark: SparkSession, sf: str, table: DataFrame | None = None) -> DataFrame:
    return tables.clean_claims(raw_claims(spark, sf), geo(spark, sf) if table is None else table)


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned(spark, sf).withColumns(
        {"gender": clean.gender_label("gender"), "marital": clean.marital_label("marital")}
    )


def sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly employment as quarterly rows with twelve month columns."""
    e = view(spark, sf, "employment")
    return e.groupBy("fips", F.col("yr").alias("year"), F.ceil(F.col("mon") / 3).cast("int").alias("qtr")).agg(
        *[F.max(F.when(F.col("mon") == i + 1, F.col("emp"))).alias(m) for i, m in enumerate(fv.MONTH_COLUMNS)]
    )


def zone_employment(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.employment_by_zone(sheets(spark, sf), geo(spark, sf))


def rates(spark: SparkSession, sf: str) -> DataFrame:
    # the crosswalk serves the claims and the employment, each with its size check
    g = materialize(geo(spark, sf), "geo")
    return plans.rate_panel(mapped(spark, sf, g), rollup.employment_by_zone(sheets(spark, sf), g))


def coded(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "claims").join(view(spark, sf, "claim_codes"), "bill_id", "left")


def heat_codes(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "dictionary").filter(clean.text_matches("description", INCLUDE, EXCLUDE))


def heat_daily(spark: SparkSession, sf: str) -> DataFrame:
    flagged = keys.flag_any(coded(spark, sf), fv.CODE_COLUMNS, heat_codes(spark, sf))
    located = keys.map_claims(flagged, geo(spark, sf))
    return summaries.daily_claims(located, F.col("is_heat"), F.col("cz_id").isin("1", "3"))


# ---- crosswalk and cleaning ----------------------------------------------

_GEO = "zip, fips, county_name, state, cz_id, cz_name"


@register(
    "argmax_county",
    sql(
        """select zip, fips, res_ratio from (select *, row_number() over
           (partition by zip order by res_ratio desc nulls last, fips) as rn from zip2cnty) where rn=1""",
        "zip2cnty",
    ),
)
def argmax_county(spark, sf):
    return keys.argmax_row(view(spark, sf, "zip2cnty"), "zip", "res_ratio", ["fips"])


@register("build_geo", sql(f"select {_GEO} from geo", "geo"))
def build_geo(spark, sf):
    return geo(spark, sf)


@register(
    "distinct_pairs", sql("select distinct fips, cz_id from geo", "geo")
)
def distinct_pairs(spark, sf):
    return keys.distinct_pairs(geo(spark, sf), ["fips", "cz_id"])


_CLEAN = ["bill_id", "zip", "bill_date", "dob", "charge", "age", "gender", "marital"]


@register("clean_claims", sql(f"select bill_id, zip, bill_date, dob, charge, {rsql('age')}, gender, marital from aged", "aged"))
def clean_claims(spark, sf):
    return cleaned(spark, sf).select(*_CLEAN).withColumn("age", r("age"))


@register(
    "claims_from_csv",
    sql(f"select bill_id, zip, bill_date, dob, charge, {rsql('age')}, gender, marital from aged", "aged"),
)
def claims_from_csv(spark, sf):
    """Text files with the published headers, one set per form type, read back and cleaned."""
    raw = raw_claims(spark, sf).withColumns(
        {"injury_date": F.lit(None).cast("string"), "facility_zip": F.col("zip")}
        | {c: F.lit(None).cast("string") for c in fv.CODE_COLUMNS}
    )
    headed = raw.select(
        *[F.col(new).cast("string").alias(old.replace(".", " ")) for old, new in fv.CLAIM_COLUMNS.items()],
        F.lit("x").alias("Other Column"),
    )
    root = scratch_path(spark, "claims-csv")
    blank = F.col("Employee Gender Code") == ""
    # an empty gender must stay empty text in one form type and be given in the other
    for part, rows in (("sv1", headed.filter(~blank)), ("sv2", headed.filter(blank))):
        sinks.write_csv(rows, f"{root}/{part}")
    read = tables.read_claims(spark, [f"{root}/sv1", f"{root}/sv2"], na=("NA",))
    read = read.withColumns({"gender": F.coalesce("gender", F.lit("")), "marital": F.coalesce("marital", F.lit(""))})
    return (
        tables.clean_claims(read)
        .select(*_CLEAN)
        .withColumns({"age": r("age"), "bill_id": F.col("bill_id").cast("bigint")})
    )


@register(
    "state_rows", sql("select zip, fips, res_ratio from zip2cnty where starts_with(fips, '4800')", "zip2cnty")
)
def state_rows(spark, sf):
    return view(spark, sf, "zip2cnty").filter(clean.in_state("fips", "4800"))


@register("map_claims", sql(f"select bill_id, bill_date, {_GEO} from mapped", "mapped"))
def map_claims(spark, sf):
    return mapped(spark, sf).select("bill_id", "bill_date", *_GEO.split(", "))


@register(
    "recode_labels",
    sql("select gender, marital, count(*) as n, round(sum(charge),2) as charge from labelled group by 1,2", "labelled"),
)
def recode_labels(spark, sf):
    return labelled(spark, sf).groupBy("gender", "marital").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("charge"), 2).alias("charge")
    )


@register(
    "normalized_codes",
    sql(
        """select bill_id, icd1, replace(trim(icd1),'.','') as code, lpad(replace(trim(icd1),'.',''), cast(greatest(5, length(replace(trim(icd1),'.',''))) as int), '0') as padded
           from claim_codes where icd1 is not null""",
        "claim_codes",
    ),
)
def normalized_codes(spark, sf):
    codes = view(spark, sf, "claim_codes").filter("icd1 is not null")
    return codes.select(
        "bill_id", "icd1", clean.norm_code("icd1").alias("code"), clean.pad_key(clean.norm_code("icd1")).alias("padded")
    )


@register(
    "unmatched_claims",
    sql("select bill_id, zip from claims where zip not in (select zip from geo)", "claims", "geo"),
)
def unmatched_claims(spark, sf):
    return keys.unmatched(view(spark, sf, "claims"), geo(spark, sf), "zip").select("bill_id", "zip")


# ---- counts, employment, rates -------------------------------------------


@register("claims_per_day", sql("select cz_id, bill_date, n_claims from daily", "daily"))
def claims_per_day(spark, sf):
    return rollup.claims_per_day(mapped(spark, sf))


@register(
    "panel_bounds",
    sql("select distinct cz_id, (select min(bill_date) from daily) as first_day, (select max(bill_date) from daily) as last_day from daily", "daily"),
)
def panel_bounds(spark, sf):
    daily = rollup.claims_per_day(mapped(spark, sf))
    first, last = dense.bounds(daily, "bill_date")
    return daily.select("cz_id").distinct().select("cz_id", first.alias("first_day"), last.alias("last_day"))


@register(
    "count_panel", sql("select cz_id, date, n_claims, year, month, day, qtr from rates", "rates")
)
def count_panel(spark, sf):
    return plans.count_panel(mapped(spark, sf))


@register(
    "quarter_average",
    sql(
        """select fips, yr as year, cast(ceil(mon/3.0) as int) as qtr,
           round(case when count(*)=3 then sum(emp)/3 end, 6) as avg_emp from employment group by 1,2,3""",
        "employment",
    ),
)
def quarter_average(spark, sf):
    return sheets(spark, sf).select("fips", "year", "qtr", r(clean.quarter_average("qtr")).alias("avg_emp"))


@register("employment_by_zone", sql(f"select cz_id, year, qtr, {rsql('emp_cz')} from emp_cz", "emp_cz"))
def employment_by_zone(spark, sf):
    return zone_employment(spark, sf).withColumn("emp_cz", r("emp_cz"))


@register(
    "employment_by_crosswalk",
    sql(
        """with q as (select fips, yr as year, cast(ceil(mon/3.0) as int) as qtr,
             case when count(*) = 3 then sum(emp)/3 end as avg_emp from employment group by 1,2,3)
           select cz_id, year, qtr, round(coalesce(sum(avg_emp),0),6) as emp_cz from q join cnty2cz using (fips) group by 1,2,3""",
        "employment",
        "cnty2cz",
    ).replace(")\nwith q as", "),\nq as"),
)
def employment_by_crosswalk(spark, sf):
    out = rollup.employment_by_zone(
        sheets(spark, sf), geo(spark, sf), "crosswalk", view(spark, sf, "cnty2cz")
    )
    return out.withColumn("emp_cz", r("emp_cz"))


@register(
    "employment_from_csv",
    sql(
        """select fips, yr as year, cast(ceil(mon/3.0) as int) as qtr,
           round(case when count(*)=3 then sum(emp)/3 end, 6) as avg_emp from employment group by 1,2,3""",
        "employment",
    ),
)
def employment_from_csv(spark, sf):
    """Sheets as text with thousands commas, two layouts and rows that do not count, read back."""
    s = sheets(spark, sf).select(
        F.substring("fips", 1, 2).alias("St"),
        F.substring("fips", 3, 3).alias("Cnty"),
        F.col("year").alias("Year"),
        F.col("qtr").alias("Qtr"),
        F.lit(" Total Covered ").alias("Ownership"),
        F.lit("10 Total, all industries").alias("Industry"),
        *[F.format_number(m, 0).alias(m.title().replace("_", " ")) for m in fv.MONTH_COLUMNS],
    )
    noise = s.withColumn("Ownership", F.lit("Private"))
    root = scratch_path(spark, "employment-csv")
    sinks.write_csv(s.filter("Qtr <= 2"), f"{root}/a")
    sinks.write_csv(s.filter("Qtr > 2").withColumn("Status Code", F.lit("N")), f"{root}/b")
    sinks.write_csv(noise, f"{root}/c")
    raw = tables.read_employment(spark, root, prefix="part-")
    typed = tables.clean_employment(raw)
    return typed.select("fips", "year", "qtr", r(clean.quarter_average("qtr")).alias("avg_emp"))


_RATE = "cz_id, date, n_claims, year, month, day, qtr, round(emp_cz,6) as emp_cz, round(claims_per_100k,6) as claims_per_100k"


@register("rate_panel", sql(f"select {_RATE} from rates", "rates"))
def rate_panel(spark, sf):
    return rates(spark, sf).select(
        "cz_id", "date", "n_claims", "year", "month", "day", "qtr", r("emp_cz"), r("claims_per_100k")
    )


@register(
    "rate_per",
    sql("select cz_id, year, qtr, round(case when emp_cz>0 then 1000/emp_cz*100000 end,6) as rate from emp_cz", "emp_cz"),
)
def rate_per_query(spark, sf):
    return zone_employment(spark, sf).select("cz_id", "year", "qtr", r(rate_per(F.lit(1000), "emp_cz")).alias("rate"))


# ---- tables --------------------------------------------------------------


@register(
    "summary_numeric",
    sql(
        """select variable, n, round(mean,5) as mean, round(sd,5) as sd, round(min,6) as min, round(max,6) as max from (
           select 'age' as variable, count(age) as n, avg(age) as mean, stddev_samp(age) as sd, min(age) as min, max(age) as max from aged
           union all select 'charge', count(charge), avg(charge), stddev_samp(charge), min(charge), max(charge) from aged)""",
        "aged",
    ),
)
def summary_numeric(spark, sf):
    return summaries.summarize_numeric(cleaned(spark, sf), ["age", "charge"]).select(
        "variable", "n", r("mean", 5), r("sd", 5), r("min"), r("max")
    )


for _column in ("gender", "marital"):

    @register(
        f"frequency_{_column}",
        sql(
            f"select {_column} as level, count(*) as n, round(count(*)*100.0/(select count(*) from labelled),6) as pct from labelled group by 1",
            "labelled",
        ),
    )
    def frequency(spark, sf, column=_column):
        return summaries.order_levels(summaries.frequency(labelled(spark, sf), column)).withColumn("pct", r("pct"))


_LEVELS = """select {o} + row_number() over (order by {c}) as ord,
    case when row_number() over (order by {c}) = 1 then '{t}' else '' end as label, {c} as level,
    format('{{:,}}', count(*)) as n, '' as mean, '' as sd, '' as min, '' as max,
    printf('%.1f%%', count(*)*100.0/(select count(*) from labelled)) as pct from labelled group by {c}"""
_CONT = """select {o} as ord, '{t}' as label, '' as level, format('{{:,}}', count({c})) as n, printf('%.2f', avg({c})) as mean,
    printf('%.2f', stddev_samp({c})) as sd, printf('%.2f', min({c})) as min, printf('%.2f', max({c})) as max, '' as pct from labelled"""


@register(
    "individual_table",
    sql(
        "select cast(ord as int) as ord, label, level, n, mean, sd, min, max, pct from ("
        + " union all ".join(
            [
                _CONT.format(o=1, t="Employee age", c="age"),
                _CONT.format(o=2, t="Total claim cost ($)", c="charge"),
                _LEVELS.format(o=10, t="Employee gender", c="gender"),
                _LEVELS.format(o=20, t="Employee marital status", c="marital"),
            ]
        )
        + ")",
        "labelled",
    ),
)
def individual_table(spark, sf):
    return summaries.individual_table(labelled(spark, sf))


_TOP = "select icd1 as code, count(*) as n from coded group by 1 order by n desc, code asc nulls last limit 10"
_TOTAL = "(select count(*) from coded where icd1 is not null and icd1 <> '')"


@register(
    "top_codes",
    sql(f"select code, n, round(n*100.0/{_TOTAL},6) as pct from ({_TOP}) where code is not null and code <> ''", "coded"),
)
def top_codes(spark, sf):
    return summaries.top_codes(coded(spark, sf)).withColumn("pct", r("pct"))


@register(
    "top_codes_given",
    sql(
        f"""select icd1 as code, count(*) as n, round(count(*)*100.0/{_TOTAL},6) as pct from coded
        where icd1 is not null and icd1 <> '' group by 1 order by n desc, code limit 10""",
        "coded",
    ),
)
def top_codes_given(spark, sf):
    return summaries.top_codes(coded(spark, sf), drop_blank_first=True).withColumn("pct", r("pct"))


@register(
    "top_codes_described",
    sql(
        f"""select t.code, description, n, round(n*100.0/{_TOTAL},6) as pct from
        (select * from ({_TOP}) where code is not null and code <> '') t
        left join dictionary d on d.code = replace(t.code,'.','')""",
        "coded",
        "dictionary",
    ),
)
def top_codes_described(spark, sf):
    top = summaries.top_codes(coded(spark, sf))
    return keys.describe_codes(top, view(spark, sf, "dictionary")).select("code", "description", "n", r("pct"))


@register("heat_codes", sql("select code, description from heat_codes", "heat_codes"))
def heat_codes_query(spark, sf):
    return heat_codes(spark, sf)


@register("heat_flag", sql("select bill_id, icd1, icd2, icd3, icd4, icd5, is_heat from flagged", "flagged"))
def heat_flag(spark, sf):
    return keys.flag_any(coded(spark, sf), fv.CODE_COLUMNS, heat_codes(spark, sf)).select(
        "bill_id", *fv.CODE_COLUMNS, "is_heat"
    )


@register(
    "target_zones",
    sql(
        """select distinct cz_id, cz_name, count(*) over (partition by cz_id) as n_zips from geo
           where regexp_matches(lower(cz_name), 'america|europe')""",
        "geo",
    ),
)
def target_zones(spark, sf):
    g = geo(spark, sf)
    zones = keys.find_zones(g, ("America", "Europe"))
    per_zone = keys.filter_zones(g, zones).groupBy("cz_id").agg(F.count(F.lit(1)).alias("n_zips"))
    return zones.join(per_zone, "cz_id")


@register(
    "heat_headline",
    sql(
        """select cast(sum(n) as bigint) as n_total, cast(sum(n_flagged) as bigint) as n_flagged,
           round(sum(n_flagged)*100.0/sum(n),6) as pct_flagged, cast(sum(n_target) as bigint) as n_target,
           round(sum(n_target)*100.0/sum(n),6) as pct_target from heat_daily""",
        "heat_daily",
    ),
)
def heat_headline(spark, sf):
    return summaries.heat_headline(heat_daily(spark, sf)).withColumns(
        {"pct_flagged": r("pct_flagged"), "pct_target": r("pct_target")}
    )


_SKIP = "year(bill_date) not in (1996, 1997)"


@register(
    "mean_per_day",
    sql(f"select round(avg(n),6) as mean_per_day from heat_daily where {_SKIP}", "heat_daily"),
)
def mean_per_day(spark, sf):
    return summaries.mean_per_day(heat_daily(spark, sf), (1996, 1997)).select(r("mean_per_day"))


@register(
    "mean_per_month",
    sql(
        f"""select round(avg(n),6) as mean_per_month from (select sum(n) as n from heat_daily where {_SKIP}
        group by year(bill_date), month(bill_date))""",
        "heat_daily",
    ),
)
def mean_per_month(spark, sf):
    return summaries.mean_per_month(heat_daily(spark, sf), (1996, 1997)).select(r("mean_per_month"))


_RATIO = f"""select avg(n) filter (where month(bill_date) between 6 and 8) as mean_summer,
    avg(n) filter (where month(bill_date) not between 6 and 8) as mean_rest from heat_daily where {_SKIP}"""


@register(
    "seasonal_ratio",
    sql(f"select {rsql('mean_summer', 'mean_rest')}, round(mean_summer/mean_rest,6) as ratio from ({_RATIO})", "heat_daily"),
)
def seasonal_ratio(spark, sf):
    return summaries.seasonal_ratio(heat_daily(spark, sf), (1996, 1997)).select(
        r("mean_summer"), r("mean_rest"), r("ratio")
    )


_HEAD = """select sum(n) as t, sum(n_flagged) as f, sum(n_target) as g from heat_daily"""
_KEPT = "year(bill_date) not in (2020, 2021)"


@register(
    "heat_table",
    sql(
        f"""select 0 as ord, 'Total claims (entire period)' as statistic, format('{{:,}}', cast(t as bigint)) as value from ({_HEAD})
        union all select 1, 'Heat-related claims (any diagnosis position)', format('{{:,}}', cast(f as bigint)) || printf(' (%.2f%%)', f*100.0/t) from ({_HEAD})
        union all select 2, 'Claims in target commuting zones', format('{{:,}}', cast(g as bigint)) || printf(' (%.2f%%)', g*100.0/t) from ({_HEAD})
        union all select 3, 'Mean claims per day', printf('%.1f', avg(n)) from heat_daily where {_KEPT}
        union all select 4, 'Mean claims per month', printf('%.1f', avg(n)) from (select sum(n) as n from heat_daily where {_KEPT} group by year(bill_date), month(bill_date))
        union all select 5, 'Mean daily claims, summer (June-August)', printf('%.1f', avg(n)) from heat_daily where {_KEPT} and month(bill_date) between 6 and 8
        union all select 6, 'Mean daily claims, non-summer (Sep-May)', printf('%.1f', avg(n)) from heat_daily where {_KEPT} and month(bill_date) not between 6 and 8
        union all select 7, 'Summer to non-summer ratio', printf('%.2f', avg(n) filter (where month(bill_date) between 6 and 8) / avg(n) filter (where month(bill_date) not between 6 and 8)) from heat_daily where {_KEPT}""",
        "heat_daily",
    ),
)
def heat_table(spark, sf):
    return summaries.heat_table(materialize(heat_daily(spark, sf), "heat-daily"))


@register(
    "monthly_rate",
    sql(
        """select year, month, round(avg(rate),6) as avg_claims_per_100k, make_date(year, month, 1) as date from (
           select cz_id, year, month, sum(n_claims)/nullif(avg(emp_cz),0)*100000 as rate from rates
           where date >= date '1996-01-01' and date < date '2001-02-01' and claims_per_100k is not null group by 1,2,3)
           group by 1,2""",
        "rates",
    ),
)
def monthly_rate(spark, sf):
    out = summaries.monthly_rate(rates(spark, sf), 1996, date(2001, 2, 1))
    return out.withColumn("avg_claims_per_100k", r("avg_claims_per_100k"))


@register(
    "seasonal_rates",
    sql(f"select cz_id, year, month, {rsql('avg_daily')}, strftime(make_date(2000, month, 1), '%b') as month_label from seasonal", "seasonal"),
)
def seasonal_rates(spark, sf):
    return summaries.seasonal_rates(rates(spark, sf)).withColumn("avg_daily", r("avg_daily"))


_BOX = """select month, quantile_cont(avg_daily, 0.25) as q1, quantile_cont(avg_daily, 0.5) as median,
    quantile_cont(avg_daily, 0.75) as q3 from seasonal group by 1"""
_FENCE = "avg_daily < q1-1.5*(q3-q1) or avg_daily > q3+1.5*(q3-q1)"


@register(
    "box_stats",
    sql(
        f"""select month, count(*) as n, round(max(q1),6) as q1, round(max(median),6) as median, round(max(q3),6) as q3,
        round(min(avg_daily) filter (where not ({_FENCE})),6) as whisker_low,
        round(max(avg_daily) filter (where not ({_FENCE})),6) as whisker_high, round(avg(avg_daily),6) as mean,
        count(*) filter (where {_FENCE}) as n_outliers from seasonal join ({_BOX}) using (month) group by 1""",
        "seasonal",
    ),
)
def box_stats(spark, sf):
    out = summaries.box_stats(summaries.seasonal_rates(rates(spark, sf)), "month", "avg_daily")
    return out.select(
        "month", "n", *[r(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high", "mean")], "n_outliers"
    )


@register(
    "box_outliers",
    sql(
        f"select cz_id, year, month, round(avg_daily,6) as avg_daily from seasonal join ({_BOX}) using (month) where {_FENCE}",
        "seasonal",
    ),
)
def box_outliers(spark, sf):
    rows = materialize(summaries.seasonal_rates(rates(spark, sf)), "seasonal")
    stats = summaries.box_stats(rows, "month", "avg_daily")
    return summaries.box_outliers(rows, stats, "month", "avg_daily").select("cz_id", "year", "month", r("avg_daily"))


@register(
    "exact_quantiles",
    """select l_returnflag, count(*) as total, round(quantile_cont(l_extendedprice,0.25),4) as q1,
       round(quantile_cont(l_extendedprice,0.5),4) as median, round(quantile_cont(l_extendedprice,0.75),4) as q3
       from lineitem group by 1""",
)
def exact_quantiles(spark, sf):
    """The distributed ranks over every line item; three groups, so each holds a third of all rows."""
    lines = table(spark, sf, "lineitem")
    q = summaries.exact_quantiles(lines, "l_returnflag", "l_extendedprice", [0.25, 0.5, 0.75])
    parts = [r(F.get("q", i), 4).alias(n) for i, n in enumerate(("q1", "median", "q3"))]
    return q.select("l_returnflag", "total", *parts)


@register(
    "quantiles_hot_values",
    """select l_linestatus, count(*) as total, round(quantile_cont(v,0.25),4) as q1, round(quantile_cont(v,0.5),4) as median,
       round(quantile_cont(v,0.9),4) as q9 from (select l_linestatus, case when l_orderkey % 2 = 0 then l_linenumber else l_extendedprice end as v from lineitem)
       group by 1""",
)
def quantiles_hot_values(spark, sf):
    """Half of all rows on seven values."""
    value = F.when(F.col("l_orderkey") % 2 == 0, F.col("l_linenumber").cast("double")).otherwise(F.col("l_extendedprice"))
    q = summaries.exact_quantiles(table(spark, sf, "lineitem").withColumn("v", value), "l_linestatus", "v", [0.25, 0.5, 0.9])
    return q.select("l_linestatus", "total", *[r(F.get("q", i), 4).alias(n) for i, n in enumerate(("q1", "median", "q9"))])


@register(
    "quoted_csv",
    """select p_partkey as code, 'say "' || p_name || '", ' || chr(92) || ' or "not"' as description from part""",
)
def quoted_csv(spark, sf):
    """Doubled quotes, commas and backslashes in text written by hand, not by the CSV sink."""
    p = table(spark, sf, "part")
    line = F.concat(F.col("p_partkey").cast("string"), F.lit(',"say ""'), "p_name", F.lit('"", \\ or ""not""",x'))
    path = scratch_path(spark, "quoted")
    p.select(line.alias("value")).write.text(path)
    return tables.read_text_csv(spark, path, ["code", "description", "more"]).select(F.col("code").cast("bigint"), "description")


@register(
    "formatted_counts",
    sql(
        """select cz_id, format('{:,}', cast(sum(n_claims) as bigint)) as n, printf('%.2f', sum(n_claims)/1000.0) as thousands from daily group by 1""",
        "daily",
    ),
)
def formatted_counts(spark, sf):
    daily = rollup.claims_per_day(mapped(spark, sf)).groupBy("cz_id").agg(F.sum("n_claims").alias("n"))
    return daily.select("cz_id", report.fmt_int(F.col("n")).alias("n"), report.fmt_num(F.col("n") / 1000).alias("thousands"))


# ---- dictionaries --------------------------------------------------------


@register(
    "dictionary_union",
    sql("select code, description from dictionary union all select code, upper(description) from dictionary", "dictionary"),
)
def dictionary_union(spark, sf):
    d = view(spark, sf, "dictionary")
    return keys.build_dictionary(d, d.withColumn("description", F.upper("description")))


@register("fixed_width_dictionary", sql("select code, description from dictionary", "dictionary"))
def fixed_width_dictionary(spark, sf):
    """The dictionary as fixed-width text (code in 1-7, text from 9), written and read back."""
    path = scratch_path(spark, "icd10")
    line = F.concat(F.rpad("code", 7, " "), F.lit(" "), F.col("description"), F.lit("  "))
    view(spark, sf, "dictionary").select(line.alias("value")).write.text(path)
    return tables.read_icd10(spark, path)


@register("icd9_csv", sql("select code, description from dictionary", "dictionary"))
def icd9_csv(spark, sf):
    path = scratch_path(spark, "icd9")
    d = view(spark, sf, "dictionary")
    sinks.write_csv(d.select(F.col("code").alias("dgns_cd"), F.col("description").alias("longdesc"), F.lit(1).alias("v")), path)
    return tables.read_icd9(spark, path)


@register(
    "crosswalk_csv", sql("select zip, g.fips, county_name, g.cz_id from geo g", "geo")
)
def crosswalk_csv(spark, sf):
    """Both crosswalk files written as CSV, read with text keys and joined."""
    a, b = scratch_path(spark, "crosswalk"), scratch_path(spark, "zips")
    c = view(spark, sf, "cnty2cz")
    sinks.write_csv(
        c.select(
            F.col("fips").alias("FIPStxt"),
            F.col("county_name").alias("CountyName"),
            F.col("state").alias("StateName"),
            F.col("cz_id").alias("CZ2020"),
            F.col("cz_name").alias("CZName"),
        ),
        a,
    )
    z = view(spark, sf, "zip2cnty")
    sinks.write_csv(z.select(F.col("zip").alias("ZIP"), F.col("fips").alias("COUNTY"), F.col("res_ratio").alias("RES_RATIO")), b)
    return keys.build_geo(tables.read_zip_to_county(spark, b), tables.read_crosswalk(spark, a)).select(
        "zip", "fips", "county_name", "cz_id"
    )


@register(
    "hash_sample",
    sql("select cz_id, bill_date, n_claims from daily order by md5('42|' || cz_id || '|' || cast(bill_date as varchar)), 1, 2 limit 20", "daily"),
)
def hash_sample(spark, sf):
    """Twenty reproducible rows by key hash (a sampling operator)."""
    return summaries.hash_sample(rollup.claims_per_day(mapped(spark, sf)), ["cz_id", "bill_date"], 20)
