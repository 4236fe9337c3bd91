"""Polygon layers from GeoJSON text, one feature per line or one collection per file."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneday.functions.clean import pad_key

_FEATURE = "struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>"
_MULTI = "array<array<array<array<double>>>>"
_SINGLE = "array<array<array<double>>>"

# Names under which the id and label columns occur.
ID_ALTERNATES = {"zone_id": ("GEOID", "FIPS", "ZCTA5CE10", "ZCTA5CE20"), "zone_name": ("NAME",)}


def read_features(spark: SparkSession, path: str, collection: bool = False) -> DataFrame:
    """(properties, geometry) per feature.

    Line-delimited features split over tasks and are the form for large
    layers; ``collection=True`` reads ordinary FeatureCollection files, each of
    which one task must parse.
    """
    if collection:
        whole = spark.read.schema(f"features array<{_FEATURE}>").option("multiLine", "true").json(path)
        return whole.select(F.inline("features"))
    return spark.read.schema("properties map<string,string>, geometry struct<type:string,coordinates:string>").json(path)


def read_polygons(
    spark: SparkSession,
    path: str,
    collection: bool = False,
    alternates: Mapping[str, Sequence[str]] = ID_ALTERNATES,
) -> DataFrame:
    """Ring table ``(zone_id, zone_name, part, ring, pts)``; only polygon types are kept.

    Each column takes the first of its alternate names that a feature has.  A
    polygon without any id is an error.
    """
    kind, text = F.col("geometry.type"), F.col("geometry.coordinates")
    parts = F.when(kind == "MultiPolygon", F.from_json(text, _MULTI)).when(
        kind == "Polygon", F.array(F.from_json(text, _SINGLE))
    )
    features = read_features(spark, path, collection)
    given = {name: F.coalesce(*(F.col("properties")[p] for p in found)) for name, found in alternates.items()}
    missing = F.raise_error(F.lit(f"polygon without any of {', '.join(alternates['zone_id'])}"))
    given["zone_id"] = F.coalesce(given["zone_id"], missing)
    polygons = features.filter(kind.isin("Polygon", "MultiPolygon"))
    named = polygons.select(*[c.alias(name) for name, c in given.items()], parts.alias("_parts")).filter(F.col("_parts").isNotNull())
    ids = [c for c in named.columns if c != "_parts"]
    point = lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y"))
    return (
        named.select(*ids, F.posexplode("_parts").alias("part", "_rings"))
        .select(*ids, "part", F.posexplode("_rings").alias("ring", "_pts"))
        .withColumn("pts", F.transform("_pts", point))
        .withColumn("zone_id", pad_key("zone_id"))
        .drop("_pts")
    )
