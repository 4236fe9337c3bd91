"""The published workflows end to end: files in, checked panels and tables out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneday import fixed_values as fv
from zoneday.functions import clean
from zoneday.operators import audit, checks, dense, geometry, keys, manifest, rollup, summaries
from zoneday.plans import claims as claim_plans
from zoneday.plans import weather as weather_plans
from zoneday.session import materialize
from zoneday.sources import polygons, rasters, sinks, tables


@dataclass(frozen=True)
class ClaimFiles:
    claims: Sequence[str]
    zip_to_county: str
    crosswalk: str
    employment: str
    clean_out: str
    panel_out: str


def build_claims(spark: SparkSession, f: ClaimFiles) -> DataFrame:
    """Cleaned claims and the rate panel; returns the written panel.

    The cleaned claims are kept because both table jobs read them.
    """
    crosswalk = tables.read_crosswalk(spark, f.crosswalk)
    geo = materialize(keys.build_geo(tables.read_zip_to_county(spark, f.zip_to_county), crosswalk), "geo")
    tables.clean_claims(tables.read_claims(spark, f.claims), geo).write.mode("overwrite").parquet(f.clean_out)
    employment = tables.clean_employment(tables.read_employment(spark, f.employment))
    panel = claim_plans.rate_panel(
        tables.read_panel(spark, f.clean_out), rollup.employment_by_zone(employment, geo)
    )
    sinks.write_panel(panel, f.panel_out, "cz_id")
    return tables.read_panel(spark, f.panel_out)


def claim_tables(spark: SparkSession, clean_path: str, panel_path: str, icd9: str, icd10: str) -> dict[str, DataFrame]:
    """Individual summary, top codes, monthly series and the seasonal sample with its box numbers."""
    claims = tables.read_panel(spark, clean_path)
    labelled = claims.withColumns(
        {"gender": clean.gender_label("gender"), "marital": clean.marital_label("marital")}
    )
    dictionary = keys.build_dictionary(tables.read_icd9(spark, icd9), tables.read_icd10(spark, icd10))
    panel = tables.read_panel(spark, panel_path)
    seasonal = summaries.seasonal_rates(panel)
    return {
        "individual": summaries.individual_table(labelled),
        "top_codes": keys.describe_codes(summaries.top_codes(claims), dictionary),
        "monthly_rate": summaries.monthly_rate(panel),
        "seasonal": seasonal,
        "seasonal_box": summaries.box_stats(seasonal, "month", "avg_daily"),
    }


def heat_summary(spark: SparkSession, clean_path: str, crosswalk: str, icd9: str, icd10: str) -> DataFrame:
    """The heat table from one pass over the cleaned claims."""
    claims = tables.read_panel(spark, clean_path).select("bill_date", "cz_id", *fv.CODE_COLUMNS)
    dictionary = keys.build_dictionary(tables.read_icd9(spark, icd9), tables.read_icd10(spark, icd10))
    codes = dictionary.filter(clean.text_matches("description", fv.HEAT_TERMS, fv.HEAT_EXCLUSIONS))
    table = tables.read_crosswalk(spark, crosswalk).filter(F.col("state") == fv.STATE_NAME)
    # the named zones are two or three; the list becomes part of the plan
    targets = [r.cz_id for r in keys.find_zones(table).select("cz_id").distinct().collect()]
    flagged = keys.flag_any(claims, fv.CODE_COLUMNS, codes)
    daily = summaries.daily_claims(flagged, F.col("is_heat"), F.coalesce(F.col("cz_id").isin(targets), F.lit(False)))
    return summaries.heat_table(materialize(daily, "heat-daily"))


@dataclass(frozen=True)
class LayerFiles:
    """Zone layers as line-delimited GeoJSON, and where their metadata goes."""

    counties: str
    crosswalk: str
    county_meta_out: str
    zone_meta_out: str


def build_layers(spark: SparkSession, f: LayerFiles, vintages: tuple[str, str] = ("cb_2024", "czone_2020")) -> DataFrame:
    """County and commuting-zone metadata; returns the state's county edges."""
    rings = polygons.read_polygons(spark, f.counties).filter(clean.in_state("zone_id"))
    edges = geometry.ring_edges(geometry.valid_rings(rings))
    names = rings.select("zone_id", "zone_name").distinct()
    counties = materialize(
        weather_plans.county_metadata(edges, names, tables.read_crosswalk(spark, f.crosswalk), vintages[0]), "county-meta"
    )
    # a county without a commuting zone stops the job before anything is written
    checks.enforce(checks.check_rules(counties, {"has a commuting zone": (F.col("cz_id").isNull(), 0.0)}, "county"))
    counties.write.mode("overwrite").parquet(f.county_meta_out)
    weather_plans.zone_metadata(edges, counties, vintages[1]).write.mode("overwrite").parquet(f.zone_meta_out)
    return edges


@dataclass(frozen=True)
class PanelFiles:
    extracts: str
    county_meta: str
    zone_meta: str
    county_out: str
    zone_out: str
    # where CSV copies go, if they are wanted
    county_csv: str | None = None
    zone_csv: str | None = None


def build_county_zone(
    spark: SparkSession,
    f: PanelFiles,
    s: weather_plans.PanelSettings,
    n_counties: int = fv.N_COUNTIES,
    n_zones: int = fv.N_COMMUTING_ZONES,
) -> DataFrame:
    """Both weather panels from the periodic extracts; a misshapen one is never published.

    Each panel is judged while it is written beside its place, and both take
    their places by rename once both pass.  Returns the gate's results: those
    of the write, and the roll-up, which reads the panels when it is asked for.
    """
    meta, zone_meta = tables.read_panel(spark, f.county_meta), tables.read_panel(spark, f.zone_meta)
    checks.enforce(checks.check_meta(meta, "fips", n_counties, ["cz_id"]))
    long = tables.read_extracts(spark, f.extracts, s.variables, "fips")
    county = weather_plans.zone_panel(long, meta, s)
    _, rules = weather_plans.county_rules(county, s)
    staged = [audit.stage_panel(county, f.county_out, audit.Audit("county", "fips", n_counties, s.start, s.end, rules=rules))]
    try:
        written = tables.read_panel(spark, staged[0].path)
        zones = weather_plans.parent_panel(written, meta, zone_meta, s)
        zone, month, lo, hi = fv.CLIMATOLOGY_ZONE
        usual = audit.Mean(
            f"climatology: {zone} month {month} tmax", (F.col("cz_id") == zone) & (F.month("date") == month), "tmax", lo, hi
        )
        wanted = audit.Audit("zone", "cz_id", n_zones, s.start, s.end, means=[usual], totals=["n_counties"])
        staged.append(audit.stage_panel(zones, f.zone_out, wanted))
    except Exception:
        audit.discard(spark, staged)
        raise
    audit.publish(spark, staged)
    reports = []
    for panel, copy, key in ((f.county_out, f.county_csv, "fips"), (f.zone_out, f.zone_csv, "cz_id")):
        if copy:
            reports.append(sinks.copy_as_csv(spark, panel, copy, [key, "date"]).withColumn("panel", F.lit(panel)))
    if reports:
        keys.stack(reports).show(truncate=False)
    county, zones = tables.read_panel(spark, f.county_out), tables.read_panel(spark, f.zone_out)
    # the one number that the geography gate needs of the zone panel was added up while it was written
    members = spark.range(1).select(F.lit(staged[1].totals["n_counties"]).alias("n_counties"))
    return keys.stack(
        [
            *(s.shape for s in staged),
            *(s.values for s in staged),
            checks.check_geography(meta, members, n_counties, n_zones, s.n_days),
            weather_plans.rollup_gate(county, zones, meta, s),
        ]
    )


def build_postal(
    spark: SparkSession,
    extracts: str,
    meta: DataFrame,
    eras: DataFrame | None,
    s: weather_plans.PanelSettings,
    out: str,
    csv: str | None = None,
) -> DataFrame:
    """The postal-area panel over all eras from files ``{var}_{era}_{YYYYMM}.csv``; returns the written panel.

    Without ``eras`` the published vintages are taken.  The panel is judged
    while it is written beside its place, era by era, and takes its place by
    rename if every era has its zones on its days; a number of rows outside
    the usual band is shown as a warning.  With ``csv`` a CSV copy goes there,
    and the sizes of both are shown.
    """
    eras = weather_plans.vintage_eras(spark) if eras is None else eras
    long = tables.read_extracts(spark, extracts, s.variables, "zcta5", r"[a-z0-9]+_\d{6}", with_period=True)
    long = long.withColumn("era", F.substring_index("period", "_", 1)).withColumnRenamed("zcta5", "zone_id")
    panel = weather_plans.era_panel(long.drop("period"), meta, eras, s)
    areas = meta.select("era", "zone_id").distinct().groupBy("era").agg(F.count(F.lit(1)).alias("n"))
    # the eras are a handful; one without areas must still show up and fail
    spans = eras.join(areas, "era", "left").select("era", F.coalesce("n", F.lit(0)).alias("n"), "start_date", "end_date")
    wanted = [audit.Era(*r) for r in spans.orderBy("start_date", "era").collect()]
    audit.publish(spark, [audit.stage_panel(panel, out, audit.Audit("postal", "zone_id", eras=wanted, band=fv.ROW_COUNT_BAND))])
    if csv:
        sinks.copy_as_csv(spark, out, csv, ["zone_id", "date"]).show(truncate=False)
    return tables.read_panel(spark, out)


@dataclass(frozen=True)
class PostalLayerFiles:
    """Postal-area layers by era as line-delimited GeoJSON, the state's counties, and where the metadata goes."""

    areas: Mapping[str, str]
    counties: str
    county_meta: str
    meta_out: str


def build_postal_layers(
    spark: SparkSession, f: PostalLayerFiles, band: tuple[int, int] = fv.ZONE_COUNT_BAND
) -> dict[str, DataFrame]:
    """Metadata of the state's postal areas in every era; stops before writing if an era's number of areas is off.

    Returns the gate's results, the written metadata, the areas without a
    county, and for two eras which areas are in one or both.
    """
    county_meta = tables.read_panel(spark, f.county_meta)
    counties = polygons.read_polygons(spark, f.counties).filter(clean.in_state("zone_id"))
    county_edges = geometry.ring_edges(geometry.valid_rings(counties))
    made = []
    for era, path in f.areas.items():
        # a vintage's layer names its areas in a column of its own
        own = [v[3] for v in fv.VINTAGES if v[0] == era]
        names = {**polygons.ID_ALTERNATES, "zone_id": (*own, *polygons.ID_ALTERNATES["zone_id"])}
        edges = geometry.ring_edges(geometry.valid_rings(polygons.read_polygons(spark, path, alternates=names)))
        made.append(weather_plans.postal_metadata(edges, county_edges, county_meta, era))
    meta = materialize(keys.stack(made), "postal-meta")
    results = [checks.check_band(meta.filter(F.col("era") == era), *band, f"{era}: areas") for era in f.areas]
    no_county = F.col("county_fips").isNull()
    lost = meta.agg(F.count_if(no_county).alias("n"))
    results.append(checks.check_count(lost, "n", "areas without a county", "warning"))
    gate = keys.stack(results)
    checks.enforce(gate)
    meta.write.mode("overwrite").parquet(f.meta_out)
    out = {"gate": gate, "meta": tables.read_panel(spark, f.meta_out), "no_county": meta.filter(no_county)}
    if len(f.areas) == 2:
        out["era_sets"] = keys.era_sets(meta, *f.areas)
    return out


def validate_county_zone(
    spark: SparkSession,
    f: PanelFiles,
    s: weather_plans.PanelSettings,
    n_counties: int = fv.N_COUNTIES,
    n_zones: int = fv.N_COMMUTING_ZONES,
    floor: float = fv.COVERAGE_FLOOR_COUNTY,
) -> DataFrame:
    """All gate results of the written county and zone panels, with coverage by year and variable."""
    county, zones = tables.read_panel(spark, f.county_out), tables.read_panel(spark, f.zone_out)
    gate = weather_plans.county_zone_gate(county, zones, tables.read_panel(spark, f.county_meta), s, n_counties, n_zones)
    covered = [
        checks.check_coverage(summaries.coverage_by_year(df, s.variables, floor), label)
        for df, label in ((county, "county"), (zones, "zone"))
    ]
    return keys.stack([gate, *covered])


def validate_postal(
    spark: SparkSession,
    panel_path: str,
    county_path: str,
    meta: DataFrame,
    eras: DataFrame,
    failures: DataFrame,
    s: weather_plans.PanelSettings,
    floor: float = fv.COVERAGE_FLOOR_POSTAL,
) -> dict[str, DataFrame]:
    """Gate results of the written postal panel, and the low years that the failure log explains."""
    panel, county = tables.read_panel(spark, panel_path), tables.read_panel(spark, county_path)
    coverage = summaries.coverage_by_year(panel, s.variables, floor)
    explained = manifest.explain_gaps(summaries.low_years(coverage), failures)
    gate = weather_plans.era_gate(panel, meta, eras, county, s)
    return {"gate": keys.stack([gate, checks.check_coverage(coverage, "postal", explained)]), "explained": explained}


def diagnostics(spark: SparkSession, county_path: str, zone_path: str, zone_meta: str, variables: Sequence[str]) -> dict[str, DataFrame]:
    """The tables behind the diagnostic figures and the monthly-temperature report."""
    county, zones = tables.read_panel(spark, county_path), tables.read_panel(spark, zone_path)
    meta = tables.read_panel(spark, zone_meta)
    return {
        "county_report": summaries.panel_report(county, "fips", variables),
        "zone_report": summaries.panel_report(zones, "cz_id", variables),
        "missing": summaries.missing_share(county, variables),
        "coverage": summaries.coverage_overall(zones, variables),
        "stability": summaries.class_counts(county, "stability"),
        "seasonality": summaries.region_seasonality(zones),
        "map": summaries.map_frame(meta, summaries.annual_means(zones), "cz_id"),
        "describe": summaries.describe_wide(zones, variables),
        "monthly_temperature": summaries.monthly_temperature(zones),
    }


def build_heat_index(spark: SparkSession, tmax_csv: str, humidity_csv: str, states_csv: str, out: str) -> DataFrame:
    """Daily heat index per zone from three CSV files; written as CSV and returned.

    Files: (zone_id, date, tmax_k), (zone_id, date, rh) and (zone_id, state).
    """
    typed = lambda path, value: tables.read_header_csv(spark, path).select(
        "zone_id", F.col("date").try_cast("date").alias("date"), F.col(value).try_cast("double").alias(value)
    )
    states = tables.read_header_csv(spark, states_csv).select("zone_id", "state")
    panel = materialize(weather_plans.heat_index_panel(typed(tmax_csv, "tmax_k"), typed(humidity_csv, "rh"), states), "heat-index")
    sinks.write_csv(panel, out, ["zone_id", "date"])
    return panel


def plan_downloads(
    spark: SparkSession,
    rasters_dir: str,
    variables: Sequence[str],
    start: date,
    end: date,
    failures: DataFrame | None = None,
    min_shape: tuple[int, int] = fv.MIN_RASTER_SHAPE,
) -> dict[str, DataFrame]:
    """What the archive holds and lacks: inventory, missing blocks, requests by calendar year, and days to retry.

    A raw grid shorter than its header says, or one with fewer rows or columns
    than ``min_shape``, counts as missing and is returned as ``invalid``.
    Empty files count as missing too; the reader passes over them, so they are
    not returned.  A file without a header counts as whole.
    """
    found = materialize(rasters.shaped_catalog(spark, rasters_dir, variables, start, end, "bil|tif"), "catalog")
    whole = F.coalesce(F.col("length") >= F.col("nrows") * F.col("ncols") * 4, F.lit(True))
    shape = {c: F.coalesce(c, F.lit(n)) for c, n in zip(("nrows", "ncols"), min_shape, strict=True)}
    catalog = materialize(manifest.valid_files(found.filter(whole).withColumns(shape), 1, min_shape), "valid-files")
    blocks = dense.gap_blocks(catalog, dense.variable_table(spark, variables), start, end)
    out = {"inventory": manifest.inventory(catalog, start, end), "blocks": blocks, "requests": dense.year_chunks(blocks)}
    out["invalid"] = keys.unmatched(found, catalog, "path")
    if failures is not None:
        out["retry"] = manifest.retry_manifest(failures)
    return out
