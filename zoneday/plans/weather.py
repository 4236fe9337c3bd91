"""Weather panels: county, commuting zone, postal area by era, and heat index."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneday import fixed_values as fv
from zoneday.functions.clean import order_columns
from zoneday.functions.dates import add_calendar, stability
from zoneday.functions.weather import add_humidity, clamp, heat_index, k_to_c, null_outliers
from zoneday.operators import checks
from zoneday.operators.dense import densify, densify_eras
from zoneday.operators.geometry import (
    assign_largest_overlap,
    dissolve,
    interior_point,
    points_in_polygons,
    polygon_metrics,
    project_edges,
)
from zoneday.operators.keys import attach, join_pairs, stack
from zoneday.operators.rollup import merge_variables, weighted_rollup
from zoneday.session import lookup

CALENDAR = ("year", "month", "day", "doy", "week", "quarter")
META = ("cz_id", "cz_name", "area_km2", "centroid_lon", "centroid_lat", "geo_vintage")


@dataclass(frozen=True)
class PanelSettings:
    """Window, variables and the day values are judged from; no clock is read."""

    as_of: date
    start: date = fv.WINDOW_START
    end: date = fv.WINDOW_END
    variables: tuple[str, ...] = fv.COUNTY_VARIABLES
    ranges: Mapping[str, tuple[float, float]] | None = None

    @property
    def n_days(self) -> int:
        return (self.end - self.start).days + 1


def _enrich(panel: DataFrame, s: PanelSettings) -> DataFrame:
    """Calendar, stability tier, humidity, then plausibility, all narrow."""
    panel = add_calendar(panel, "date", CALENDAR).withColumn("stability", stability("date", s.as_of))
    if {"tdmean", "tmean"} <= set(panel.columns):
        panel = add_humidity(panel)
    return null_outliers(panel, s.ranges or fv.PLAUSIBLE_RANGES)


def zone_panel(long: DataFrame, meta: DataFrame, s: PanelSettings, zone: str = "fips") -> DataFrame:
    """Long extracts ``(zone, date, var, value)`` to the dense wide panel of ``meta``'s zones.

    Extract and skeleton meet on (zone, date), the key the merge has already
    partitioned by, and the metadata is a checked broadcast.
    """
    wide = merge_variables(long, [zone, "date"], s.variables)
    panel = densify(wide, meta, zone, s.start, s.end)
    panel = _enrich(attach(panel, meta, zone), s)
    return order_columns(
        panel, [zone, "county_name", "date", *CALENDAR, *s.variables, *fv.HUMIDITY_VARIABLES, *META, "stability"]
    )


def parent_panel(
    county: DataFrame, county_meta: DataFrame, zone_meta: DataFrame, s: PanelSettings
) -> DataFrame:
    """County panel rolled up to commuting zones by area.

    Zone and weight come from the county metadata, not from the panel's own
    copy.  Humidity is averaged, never recomputed from averages.
    """
    values = [*s.variables, *fv.HUMIDITY_VARIABLES]
    keyed = attach(
        county.select("fips", "date", *[v for v in values if v in county.columns]),
        county_meta.select("fips", "cz_id", "area_km2"),
        "fips",
    )
    rolled = weighted_rollup(keyed, ["cz_id", "date"], values)
    panel = add_calendar(rolled, "date", CALENDAR).withColumn("stability", stability("date", s.as_of))
    panel = attach(panel, zone_meta, "cz_id")
    return order_columns(
        panel, ["cz_id", "cz_name", "date", *CALENDAR, *values, "n_counties", *META[2:], "stability"]
    )


def vintage_eras(spark: SparkSession, vintages: Sequence[tuple[str, date, date, str]] = fv.VINTAGES) -> DataFrame:
    """(era, start_date, end_date) of the published postal vintages."""
    return spark.createDataFrame([v[:3] for v in vintages], "era string, start_date date, end_date date")


def era_panel(
    long: DataFrame, meta: DataFrame, eras: DataFrame, s: PanelSettings, zone: str = "zone_id"
) -> DataFrame:
    """Postal-area panel over all eras in one plan; ``meta`` and ``long`` carry ``era``."""
    wide = merge_variables(long, ["era", zone, "date"], s.variables)
    panel = densify_eras(wide, meta.select("era", zone), eras, zone)
    panel = _enrich(attach(panel, meta, [zone, "era"]), s)
    return order_columns(
        panel,
        [zone, "date", *CALENDAR, *s.variables, *fv.HUMIDITY_VARIABLES, "era", "county_fips", "county_name", *META, "stability"],
    )


# ---- zone metadata -------------------------------------------------------


def county_metadata(edges: DataFrame, names: DataFrame, crosswalk: DataFrame, vintage: str) -> DataFrame:
    """(fips, county_name, cz_id, cz_name, area_km2, centroid_lon, centroid_lat, geo_vintage)."""
    metrics = polygon_metrics(edges).withColumnRenamed("zone_id", "fips")
    out = attach(metrics, names.select(F.col("zone_id").alias("fips"), F.col("zone_name").alias("county_name")).distinct(), "fips")
    out = attach(out, crosswalk.select("fips", "cz_id", "cz_name"), "fips")
    return out.withColumn("geo_vintage", F.lit(vintage))


def zone_metadata(county_edges: DataFrame, county_meta: DataFrame, vintage: str) -> DataFrame:
    """Commuting-zone metadata from the dissolved county layer."""
    members = county_meta.filter(F.col("cz_id").isNotNull()).select(F.col("fips").alias("zone_id"), "cz_id")
    metrics = polygon_metrics(dissolve(county_edges, members), "cz_id")
    names = county_meta.groupBy("cz_id").agg(F.min("cz_name").alias("cz_name"))
    return attach(metrics, names, "cz_id").withColumn("geo_vintage", F.lit(vintage))


def postal_metadata(
    edges: DataFrame,
    county_edges: DataFrame,
    county_meta: DataFrame,
    era: str,
    point_bucket: float = 0.25,
    overlap_bucket: float = 25_000.0,
) -> DataFrame:
    """One era's postal areas of the state: metrics plus the county and zone they mostly lie in.

    An area belongs to the state when its interior point lies in one of the
    counties; its county is the one sharing most area, measured in the
    equal-area plane.  Buckets are in degrees and metres.
    """
    points = interior_point(edges).withColumnRenamed("zone_id", "point_id")
    county_of = county_edges.withColumnRenamed("zone_id", "county")
    inside = points_in_polygons(points, county_of, point_bucket, zone="county").select(F.col("point_id").alias("zone_id"))
    kept = lookup(edges, inside.distinct(), "zone_id", "left_semi")
    best = assign_largest_overlap(project_edges(kept), project_edges(county_edges), overlap_bucket)
    out = polygon_metrics(kept).withColumn("era", F.lit(era))
    out = lookup(out, best.select("zone_id", F.col("parent_id").alias("county_fips")), "zone_id")
    names = county_meta.select(F.col("fips").alias("county_fips"), "county_name", "cz_id", "cz_name")
    return attach(out, names, "county_fips")


# ---- gates ---------------------------------------------------------------


def county_rules(county: DataFrame, s: PanelSettings) -> tuple[list[str], dict[str, checks.Rule]]:
    """The panel's value columns and the rules they must keep."""
    values = [v for v in (*s.variables, *fv.HUMIDITY_VARIABLES) if v in county.columns]
    ranges = {v: r for v, r in (s.ranges or fv.PLAUSIBLE_RANGES).items() if v in values}
    return values, {**checks.order_rule(), **checks.physical_rules(county.columns), **checks.range_rules(values, ranges)}


def rollup_gate(county: DataFrame, zones: DataFrame, county_meta: DataFrame, s: PanelSettings) -> DataFrame:
    """The stored zone panel equals the county panel rolled up, by the metadata's zones and areas."""
    values, _ = county_rules(county, s)
    keyed = attach(county, county_meta.select("fips", "cz_id", "area_km2"), "fips")
    return checks.check_rollup(keyed, zones, ["cz_id", "date"], values)


def county_zone_gate(
    county: DataFrame,
    zones: DataFrame,
    county_meta: DataFrame,
    s: PanelSettings,
    n_counties: int = fv.N_COUNTIES,
    n_zones: int = fv.N_COMMUTING_ZONES,
    climatology: tuple[str, int, float, float] = fv.CLIMATOLOGY_ZONE,
) -> DataFrame:
    """All results for the county and commuting-zone panels."""
    _, rules = county_rules(county, s)
    return stack(
        [
            checks.check_shape(county, "fips", n_counties, s.n_days, "county"),
            checks.check_shape(zones, "cz_id", n_zones, s.n_days, "zone"),
            rollup_gate(county, zones, county_meta, s),
            checks.check_rules(county, rules, "county"),
            checks.check_geography(county_meta, zones, n_counties, n_zones, s.n_days),
            checks.check_climatology(zones, *climatology),
        ]
    )


def era_gate(
    panel: DataFrame,
    meta: DataFrame,
    eras: DataFrame,
    county: DataFrame,
    s: PanelSettings,
    spot: tuple[str, date, date, float, float] = fv.SPOT_ZONE,
    zone: str = "zone_id",
) -> DataFrame:
    """All results for the postal-area panel."""
    values = [v for v in (*s.variables, *fv.HUMIDITY_VARIABLES) if v in panel.columns]
    rules = {
        **checks.order_rule(),
        **checks.physical_rules(panel.columns, postal=True),
        **checks.range_rules(values, s.ranges or fv.PLAUSIBLE_RANGES),
    }
    return stack(
        [
            checks.check_era_shape(panel, eras, meta, zone),
            checks.check_vintage(panel, eras),
            checks.check_rules(panel, rules, "postal"),
            checks.check_cross_panel(panel, county),
            checks.check_spot(panel, *spot, key=zone),
        ]
    )


# ---- heat index ----------------------------------------------------------


def heat_index_panel(
    tmax: DataFrame, humidity: DataFrame, states: DataFrame, zone: str = "zone_id"
) -> DataFrame:
    """Daily maximum heat index per zone.

    ``tmax(zone, date, tmax_k)`` in Kelvin, ``humidity(zone, date, rh)``,
    ``states(zone, state)``.  Humidity is limited to 0..100 first, because area
    means of a modelled layer can lie slightly above it.
    """
    both = join_pairs(tmax, humidity, [zone, "date"]).withColumns(
        {"tmax_c": k_to_c("tmax_k"), "rh": clamp("rh", 0, 100), "year": F.year("date")}
    )
    return attach(both.withColumn("heat_index_c", heat_index("tmax_c", "rh")), states, zone).select(
        zone, "state", "date", "year", "tmax_c", "rh", "heat_index_c"
    )
