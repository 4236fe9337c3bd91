"""Session settings, the shared scratch folder and written intermediates."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_test_root: str | None = None


def build_session(app: str = "zoneday", master: str | None = None, **extra: str) -> SparkSession:
    """A session with adaptive execution, skew splitting and UTC dates."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    if not master and "spark__sql__shuffle__partitions" not in extra:
        # start from plenty of shuffle partitions; adaptive execution merges small ones
        wanted = max(200, 3 * spark.sparkContext.defaultParallelism)
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` or by ``setCheckpointDir``.

    Only a session whose master is this machine alone may go without: it gets
    a temporary folder that is removed at exit.  On a cluster a folder of one
    machine would lose data, so there its absence is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    global _test_root
    if _test_root is None:
        _test_root = tempfile.mkdtemp(prefix="zoneday-")
        atexit.register(shutil.rmtree, _test_root, ignore_errors=True)
    return _test_root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the session's scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/zoneday/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared storage and continue from the written table.

    Used where a small aggregate over a very large scan is needed several
    times.  The written table survives lost executors, cuts the lineage and
    gives Catalyst true sizes for its join choice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lookup(facts: DataFrame, table: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Join a lookup table to facts that may be arbitrarily large and skewed.

    No size is counted here and no job starts: adaptive execution broadcasts
    the table where the bytes it has measured allow that, and otherwise splits
    the fact side of an oversized key, so one hot key still spreads over many
    tasks and no row is lost.
    """
    return facts.join(table, on, how)
