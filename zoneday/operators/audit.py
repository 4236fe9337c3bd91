"""Panels judged while they are written, and published only if they pass.

The counts behind the gates are taken as metrics of the write itself, so no
check reads the panel again.  They are observed after the write's one
exchange: rows there are ranged and sorted by (year, zone, day), rows of one
key lie in one task, and counting them needs no exchange of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from zoneday.operators import checks
from zoneday.operators.keys import stack
from zoneday.sources import sinks


@dataclass(frozen=True)
class Mean:
    """The mean of ``value`` over ``rows`` lies between ``lo`` and ``hi``, as in ``checks.check_mean_between``."""

    name: str
    rows: Column
    value: str
    lo: float
    hi: float


@dataclass(frozen=True)
class Era:
    """One era of a panel: its zones, each on every day from ``start`` to ``end`` once."""

    name: str
    n_zones: int
    start: date
    end: date


@dataclass(frozen=True)
class Audit:
    """What a panel must hold: every zone on every day from ``start`` to ``end`` once, the value rules, the means.

    ``totals`` are columns whose sums are wanted beside the results.  A panel
    with ``eras`` names its era in column ``era``: then each era has zones and
    days of its own, and ``n_zones``, ``start`` and ``end`` are not asked for.
    ``band`` is the number of rows to expect; outside it is a warning.
    """

    label: str
    zone: str
    n_zones: int = 0
    start: date | None = None
    end: date | None = None
    day: str = "date"
    eras: Sequence[Era] = ()
    band: tuple[int, int] | None = None
    rules: Mapping[str, checks.Rule] = field(default_factory=dict)
    means: Sequence[Mean] = ()
    totals: Sequence[str] = ()

    @property
    def n_days(self) -> int:
        return (self.end - self.start).days + 1


@dataclass(frozen=True)
class Staged:
    """A panel that lies beside its target, with what was counted while it was written."""

    path: str
    target: str
    shape: DataFrame
    values: DataFrame | None
    totals: Mapping[str, float]


def _metrics(a: Audit) -> list[Column]:
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    outside = lambda start, end: ~F.coalesce(F.col(a.day).between(F.lit(start), F.lit(end)), F.lit(False))
    # one entry per polygon of the layer and one per calendar day, however many rows there are
    different = lambda c: F.array_size(F.collect_set(c))
    out = [F.count(F.lit(1)).alias("n_rows")]
    if a.eras:
        out.append(one(~F.coalesce(F.col("era").isin([e.name for e in a.eras]), F.lit(False))).alias("n_no_era"))
    else:
        # a key held by several rows counts once
        out += [one(F.col("_nth") == 2).alias("n_twice"), different(a.zone).alias("n_zones"), different(a.day).alias("n_days")]
        out.append(one(outside(a.start, a.end)).alias("n_outside"))
    for i, e in enumerate(a.eras):
        own = F.col("era") == e.name
        day = F.when(own, F.col(a.day))
        out += [
            one(own).alias(f"e{i}_rows"),
            one(own & (F.col("_nth") == 2)).alias(f"e{i}_twice"),
            different(F.when(own, F.col(a.zone))).alias(f"e{i}_zones"),
            different(day).alias(f"e{i}_days"),
            F.min(day).alias(f"e{i}_first"),
            F.max(day).alias(f"e{i}_last"),
            one(own & outside(e.start, e.end)).alias(f"e{i}_outside"),
        ]
    for i, (bad, _) in enumerate(a.rules.values()):
        out += [one(bad).alias(f"b{i}"), F.count(bad).alias(f"n{i}")]
    for i, m in enumerate(a.means):
        out += [F.avg(F.when(m.rows, F.col(m.value))).alias(f"m{i}"), one(m.rows).alias(f"k{i}")]
    return out + [F.sum(c).cast("double").alias(f"t{i}") for i, c in enumerate(a.totals)]


def _results(spark: SparkSession, a: Audit, got: Mapping[str, float]) -> tuple[DataFrame, DataFrame | None]:
    whole = lambda k: k[0] not in "mt"
    by_era = [{k.split("_")[1]: v for k, v in got.items() if k.startswith(f"e{i}_")} for i in range(len(a.eras))]
    got = {k: v for k, v in got.items() if k[0] != "e"}
    # a panel without rows has no sums
    values = {k: (v if not whole(k) else int(v or 0)) for k, v in got.items()}
    schema = StructType([StructField(k, LongType() if whole(k) else DoubleType()) for k in values])
    one = spark.createDataFrame([tuple(values.values())], schema)
    if a.eras:
        shape = [_era_results(spark, a, by_era), checks.check_count(one, "n_no_era", f"{a.label}: no row of an unknown era")]
    else:
        shape = [
            checks.shape_results(one.withColumnRenamed("n_twice", "n_duplicate_keys"), a.n_zones, a.n_days, a.label),
            checks.check_count(one, "n_outside", f"{a.label}: no row outside its dates"),
        ]
    if a.band:
        shape.append(checks.band_results(one, "n_rows", *a.band, f"{a.label}: rows", "warning"))
    values = [checks.rule_results(one, a.rules, a.label)] if a.rules else []
    values += [checks.mean_results(one.select(F.col(f"m{i}").alias("mean"), F.col(f"k{i}").alias("n")), m.lo, m.hi, m.name) for i, m in enumerate(a.means)]
    return stack(shape), stack(values) if values else None


def _era_results(spark: SparkSession, a: Audit, by_era: Sequence[Mapping[str, object]]) -> DataFrame:
    """The gates of ``checks.check_era_shape`` and ``checks.check_vintage`` over the counts of a write."""
    counts = ("rows", "zones", "days", "twice", "outside")
    # an era without rows has no counts, and passes nothing
    rows = [
        (e.name, e.start, e.end, (e.end - e.start).days + 1, e.n_zones, m["first"], m["last"], *(int(m[c]) if m["rows"] else None for c in counts))
        for e, m in zip(a.eras, by_era, strict=True)
    ]
    schema = "era string, start_date date, end_date date, _days long, _zones long, first_day date, last_day date, "
    one = spark.createDataFrame(rows, schema + ", ".join(f"n_{c} long" for c in counts))
    outside = [checks.check_count(one.filter(F.col("era") == e.name), "n_outside", f"{e.name}: no row outside its dates") for e in a.eras]
    return stack([checks.era_results(one.withColumnRenamed("n_twice", "n_duplicate_keys")), *outside])


def nth_of_key(ranged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Numbers the rows of one key; rows ranged by the key stay where they are."""
    return ranged.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(1))))


def stage_panel(panel: DataFrame, target: str, a: Audit) -> Staged:
    """Write the panel beside ``target`` and judge it on the way."""
    if "year" not in panel.columns:
        panel = panel.withColumn("year", F.year(a.day))
    keys = ["year", a.zone, a.day, *(["era"] if a.eras else [])]
    seen = Observation(f"audit-{a.label}")
    counted = nth_of_key(sinks.sorted_for_write(panel, keys), keys).observe(seen, *_metrics(a)).drop("_nth")
    path = sinks.staging_path(target)
    # a run that breaks off leaves a staged folder that nothing reads
    counted.write.option("compression", "snappy").partitionBy("year").parquet(path)
    got = seen.get
    shape, values = _results(panel.sparkSession, a, got)
    return Staged(path, target, shape, values, {c: got[f"t{i}"] for i, c in enumerate(a.totals)})


def publish(spark: SparkSession, staged: Sequence[Staged]) -> None:
    """Put every staged panel in its place if all have their shape; otherwise remove them and raise.

    ``values`` are the caller's to judge, before or after.
    """
    try:
        checks.enforce(stack([s.shape for s in staged]))
    except checks.GateFailed:
        discard(spark, staged)
        raise
    for s in staged:
        sinks.replace_folder(spark, s.path, s.target)


def discard(spark: SparkSession, staged: Sequence[Staged]) -> None:
    for s in staged:
        sinks.remove_folder(spark, s.path)
