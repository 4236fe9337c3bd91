"""Operators on keys: arg-max rows, crosswalks, unmatched keys, sets, code membership."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneday import fixed_values as fv
from zoneday.functions.clean import norm_code
from zoneday.session import lookup


def argmax_row(
    df: DataFrame, key: str | Sequence[str], value: str, tiebreak: Sequence[str]
) -> DataFrame:
    """The row with the largest value per key, ties settled by ``tiebreak`` ascending.

    The filter on the first row lets Spark keep one row per key and map task
    before the shuffle, so a key holding a third of all rows costs nothing more.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(value).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tiebreak]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def build_geo(
    zip_to_county: DataFrame, county_to_zone: DataFrame, state: str = fv.STATE_NAME
) -> DataFrame:
    """One county and zone per ZIP: largest residential share, then the crosswalk, one state."""
    best = argmax_row(zip_to_county, "zip", "res_ratio", ["fips"])
    in_state = county_to_zone.filter(F.col("state") == state)
    # a left join followed by a filter on the right side keeps matches only
    return lookup(best.select("zip", "fips"), in_state, "fips", "inner").select(
        "zip", "fips", "county_name", "state", "cz_id", "cz_name"
    )


def map_claims(claims: DataFrame, geo: DataFrame) -> DataFrame:
    """Attach county and zone by ZIP; claims without a match stay, with NULLs."""
    return lookup(claims, geo, "zip", "left")


def attach(df: DataFrame, table: DataFrame, on: str | list[str], replace: bool = True) -> DataFrame:
    """Left-join zone attributes; columns the table brings replace those of ``df``."""
    keys = [on] if isinstance(on, str) else list(on)
    if replace:
        df = df.drop(*[c for c in table.columns if c not in keys and c in df.columns])
    return lookup(df, table, keys, "left")


def unmatched(left: DataFrame, right: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``left`` whose key ``right`` lacks."""
    return left.join(right, key, "left_anti")


def filter_zones(df: DataFrame, zones: DataFrame, key: str = "cz_id") -> DataFrame:
    return lookup(df, zones.select(key), key, "left_semi")


def find_zones(crosswalk: DataFrame, names: Sequence[str] = fv.TARGET_ZONE_NAMES) -> DataFrame:
    pattern = "(?i)" + "|".join(names)
    return crosswalk.filter(F.col("cz_name").rlike(pattern)).select("cz_id", "cz_name").distinct()


def distinct_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def stack(frames: Sequence[DataFrame], fill_missing: bool = True) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), frames)


def build_dictionary(icd9: DataFrame, icd10: DataFrame) -> DataFrame:
    """Both code lists one after the other; a code in both stays twice."""
    return stack([icd9.select("code", "description"), icd10.select("code", "description")])


def era_sets(zones: DataFrame, first: str, second: str, zone: str = "zone_id") -> DataFrame:
    """Each zone once, marked ``both``, or as only in the first or second era."""
    has = zones.groupBy(zone).agg(
        F.coalesce(F.bool_or(F.col("era") == first), F.lit(False)).alias("_a"),
        F.coalesce(F.bool_or(F.col("era") == second), F.lit(False)).alias("_b"),
    )
    part = (
        F.when(F.col("_a") & F.col("_b"), "both")
        .when(F.col("_a"), "only_first")
        .when(F.col("_b"), "only_second")
    )
    return has.select(zone, part.alias("part")).filter(F.col("part").isNotNull())


def flag_any(
    df: DataFrame,
    columns: Sequence[str],
    codes: DataFrame,
    out: str = "is_heat",
) -> DataFrame:
    """Mark rows where any of several code columns holds a code of the set.

    Both sides are compared without dots and outer blanks.  The flag is never
    NULL.  It depends on the codes alone, so the different sets of codes are
    taken apart and matched once, and the rows meet the sets that matched in
    one join; a hot set is split by adaptive execution.
    """
    wanted = codes.select(norm_code("code").alias("_code")).filter("_code <> ''").distinct()
    held = F.array_sort(F.array_distinct(F.array_compact(F.array(*(norm_code(c) for c in columns)))))
    keyed = df.withColumn("_codes", F.array_join(held, "\x1f"))
    each = keyed.select("_codes").distinct().withColumn("_code", F.explode(F.split("_codes", "\x1f")))
    hits = lookup(each, wanted, "_code", "left_semi").select("_codes").distinct().withColumn("_hit", F.lit(True))
    return lookup(keyed, hits, "_codes").withColumn(out, F.coalesce("_hit", F.lit(False))).drop("_hit", "_codes")


def describe_codes(
    top: DataFrame, dictionary: DataFrame, fallback: dict[str, str] = fv.FALLBACK_DESCRIPTIONS
) -> DataFrame:
    """Attach descriptions by dot-free code; a code listed twice gives two rows."""
    names = dictionary.select(F.col("code").alias("_key"), "description")
    out = lookup(top.withColumn("_key", norm_code("code")), names, "_key").drop("_key")
    for code, text in fallback.items():
        out = out.withColumn(
            "description", F.coalesce("description", F.when(F.col("code") == code, F.lit(text)))
        )
    return out


def join_pairs(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Two measurements of the same zone-days side by side (left rows kept)."""
    return left.join(right, list(on), "left")


def first_label(df: DataFrame, block: str, order: str, out: str = "label") -> DataFrame:
    """Show a block's name on its first row only, blank on the others."""
    rank = F.row_number().over(Window.partitionBy(block).orderBy(order))
    return df.withColumn(out, F.when(rank == 1, F.col(block)).otherwise(F.lit("")))
