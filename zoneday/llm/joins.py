"""A join whose hot keys adaptive execution can split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_join(facts: DataFrame, table: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """``facts`` joined to a table that was just grouped by ``on``.

    Spark would reuse the grouping's exchange for the join, and an exchange
    with an aggregate above it is never split, so all facts of a hot key would
    meet in one task.  Joining on the key's hash as well asks for an exchange
    of its own on both sides; the grouped side is small next to the facts.
    """
    mark = lambda d: d.withColumn("_mark", F.xxhash64(on))
    return mark(facts).join(mark(table), [on, "_mark"], how).drop("_mark")
