"""Text formats of the report tables.  Format last; compare numbers, not text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fmt_int(c: Column) -> Column:
    return F.format_number(c.cast("bigint"), 0)


def fmt_num(c: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f", c.cast("double"))


def fmt_pct(c: Column, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", c.cast("double"))


def fmt_count_pct(n: Column, share: Column, digits: int = 2) -> Column:
    return F.format_string(f"%s (%.{digits}f%%)", fmt_int(n), share.cast("double"))
