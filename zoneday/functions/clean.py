"""Column expressions that turn raw text fields into typed, tidy columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneday import fixed_values as fv


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- names ---------------------------------------------------------------


def tidy_name(name: str) -> str:
    """Line breaks and blanks become single underscores, letters lower case."""
    return re.sub(r"_+", "_", re.sub(r"[\r\n ]", "_", name)).lower()


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[tidy_name(c) for c in df.columns])


def repair_names(names: Sequence[str]) -> list[str]:
    """Syntactic, unique names: odd characters become dots, repeats get .1, .2 ..."""
    base = []
    for raw in names:
        name = re.sub(r"[^\w.]", ".", raw)
        if not re.match(r"[^\W\d_]|\.(?!\d)", name):
            name = "X" + name
        base.append(name)
    taken, out, count = set(base), [], {}
    for name in base:
        if name not in count:
            count[name] = 0
            out.append(name)
            continue
        fresh = name
        while fresh in taken:
            count[name] += 1
            fresh = f"{name}.{count[name]}"
        taken.add(fresh)
        out.append(fresh)
    return out


def canonical(df: DataFrame, alternates: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename the first present alternate of each canonical column."""
    for target, names in alternates.items():
        if target in df.columns:
            continue
        found = next((n for n in names if n in df.columns), None)
        if found is not None:
            df = df.withColumnRenamed(found, target)
    return df


def order_columns(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Wanted columns that exist, in that order, then every other column."""
    first = [c for c in wanted if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


# ---- keys ----------------------------------------------------------------


def pad_key(c: Column | str, width: int = 5) -> Column:
    """Zero-pad on the left; longer keys stay as they are (lpad would cut them)."""
    c = _col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def zip5(c: Column | str) -> Column:
    return F.substring(_col(c), 1, 5)


def in_state(c: Column | str, prefix: str = fv.STATE_PREFIX) -> Column:
    return _col(c).startswith(prefix)


def norm_code(c: Column | str) -> Column:
    return F.replace(F.trim(_col(c)), F.lit("."), F.lit(""))


# ---- text to values ------------------------------------------------------


def parse_mdy(c: Column | str) -> Column:
    """``1/2/2020`` with one- or two-digit parts; trailing text is ignored, bad text is NULL."""
    head = F.regexp_extract(_col(c), r"^\s*(\d{1,2}/\d{1,2}/\d{4})", 1)
    return F.try_to_date(head, "M/d/yyyy")


def parse_month_year(c: Column | str) -> Column:
    """``7/1980`` as the first day of that month; bad text is NULL."""
    head = F.regexp_extract(_col(c), r"^\s*(\d{1,2}/\d{4})", 1)
    return F.try_to_date(F.concat(F.lit("1/"), head), "d/M/yyyy")


def parse_amount(c: Column | str) -> Column:
    """Money or thousands text to double; anything unreadable, or NaN, is NULL."""
    number = F.translate(_col(c), "$,", "").try_cast("double")
    return F.nullif(number, F.lit(float("nan")))


def blank_to(c: Column | str, value: str) -> Column:
    """Empty text becomes ``value``; NULL stays NULL."""
    c = _col(c)
    return F.when(c == "", F.lit(value)).otherwise(c)


def recode(c: Column | str, labels: Mapping[str, str], blank: str | None, other: str | None = None) -> Column:
    """Replace known codes; blanks and NULL give ``blank``; the rest ``other`` or itself."""
    c = _col(c)
    out = F.when(c.isNull() | (c == ""), F.lit(blank))
    for code, label in labels.items():
        out = out.when(c == code, F.lit(label))
    return out.otherwise(F.lit(other) if other is not None else c)


def marital_label(c: Column | str) -> Column:
    return recode(c, fv.MARITAL_LABELS, blank=fv.UNKNOWN)


def gender_label(c: Column | str) -> Column:
    return recode(c, fv.GENDER_LABELS, blank=fv.UNKNOWN, other=fv.UNKNOWN)


# ---- ages ----------------------------------------------------------------


def age_years(day: Column | str, born: Column | str) -> Column:
    return F.datediff(_col(day), _col(born)) / F.lit(fv.DAYS_PER_YEAR)


def age_kept(age: Column | str, band: tuple[float, float] = fv.AGE_BAND) -> Column:
    """Inclusive age band; a NULL age is not kept by a filter on this."""
    return _col(age).between(*band)


# ---- employment ----------------------------------------------------------


def total_covered(ownership: Column | str, industry: Column | str) -> Column:
    return (F.trim(F.lower(_col(ownership))) == fv.OWNERSHIP_TOTAL) & F.lower(_col(industry)).contains(
        fv.INDUSTRY_TOTAL
    )


def quarter_average(quarter: Column | str, months: Sequence[str] = fv.MONTH_COLUMNS) -> Column:
    """Mean of the quarter's three monthly columns, NULL if any of them is NULL."""
    q, out = _col(quarter), None
    for i in range(4):
        a, b, c = (F.col(m) for m in months[3 * i : 3 * i + 3])
        mean = (a + b + c) / 3
        out = F.when(q == i + 1, mean) if out is None else out.when(q == i + 1, mean)
    return out


# ---- dictionary search ---------------------------------------------------


def text_matches(c: Column | str, include: Sequence[str], exclude: Sequence[str] = ()) -> Column:
    """Lower-cased text holds any include pattern and none of the exclude patterns."""
    low = F.lower(_col(c))
    hit = low.rlike("|".join(include))
    return hit & ~low.rlike("|".join(exclude)) if exclude else hit
