"""Table readers.  Key columns are always text; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneday import fixed_values as fv
from zoneday.functions import clean
from zoneday.functions.weather import nan_to_null
from zoneday.operators.keys import map_claims, stack


def _text_csv(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """CSV with header, every column text; quotes inside quoted text are doubled."""
    return spark.read.options(**({"header": "true", "inferSchema": "false", "escape": '"'} | options)).csv(path)


def read_text_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """CSV without a header, every column text, under the names given."""
    return _text_csv(spark, path, header="false").toDF(*columns)


def read_header_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with a header, every column text."""
    return _text_csv(spark, path)


def _blank_to_null(df: DataFrame, na: Sequence[str]) -> DataFrame:
    return df.select(
        *[F.when(~F.col(f"`{c}`").isin(list(na)), F.col(f"`{c}`")).alias(c) for c in df.columns]
    )


def read_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """County to commuting-zone table: (fips, county_name, state, cz_id, cz_name), all text."""
    return _text_csv(spark, path).select(
        clean.pad_key("FIPStxt").alias("fips"),
        F.col("CountyName").alias("county_name"),
        F.col("StateName").alias("state"),
        F.col("CZ2020").alias("cz_id"),
        F.col("CZName").alias("cz_name"),
    )


def read_zip_to_county(spark: SparkSession, path: str) -> DataFrame:
    return _text_csv(spark, path).select(
        F.col("ZIP").alias("zip"),
        F.col("COUNTY").alias("fips"),
        F.col("RES_RATIO").try_cast("double").alias("res_ratio"),
    )


def read_claims(spark: SparkSession, paths: Sequence[str], na: Sequence[str] = ("", "NA")) -> DataFrame:
    """Claim files of all form types and periods as one text table of 14 columns.

    Headers differ in punctuation between files, so names are repaired before
    the needed ones are picked; the CSV reader parses only those.
    """
    parts = []
    for path in paths:
        raw = _text_csv(spark, path)
        named = raw.toDF(*clean.repair_names(raw.columns))
        kept = named.select(*[F.col(f"`{old}`").alias(new) for old, new in fv.CLAIM_COLUMNS.items()])
        parts.append(_blank_to_null(kept, na))
    return stack(parts, fill_missing=False)


# one CSV record, or one field with the comma before it; quoted text may hold line breaks, commas and doubled quotes
_RECORD = r'((?:[^"\r\n]++|"(?:[^"]++|"")*+")++)'
_FIELD = r',("(?:[^"]++|"")*+"|[^,"]*+)'


def _fields(record: Column) -> Column:
    """The texts of a record's fields, without their quotes."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_FIELD), F.lit(1))
    bare = lambda f: F.replace(F.call_function("substring", f, F.lit(2), F.char_length(f) - 2), F.lit('""'), F.lit('"'))
    return F.transform(raw, lambda f: F.when(f.startswith('"'), bare(f)).otherwise(f))


def _tidy(name: Column) -> Column:
    """``clean.tidy_name`` as an expression."""
    return F.lower(F.regexp_replace(F.regexp_replace(name, "[\r\n ]", "_"), "_+", "_"))


def read_sheets(spark: SparkSession, directory: str, glob: str, columns: Sequence[str]) -> DataFrame:
    """Wanted columns of all CSV sheets below a folder, all text, in one pass, whatever their layouts.

    Every sheet's first record names its fields, so the layout travels with
    the sheet's rows and the plan is the same for any number of layouts; a
    column that a sheet lacks is NULL, as is a blank field.  Headers and
    fields may hold line breaks; a sheet is one small unit and is not split.
    Blank lines and a byte order mark are no part of it.  A folder without
    such sheets is an error.
    """
    files = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter=glob)
    try:
        listing = files.load(directory)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no folder {directory}") from e
    if listing.select("path").isEmpty():  # from the listing, no sheet is opened
        raise FileNotFoundError(f"no {glob} below {directory}")
    text = F.regexp_replace(F.decode("content", "utf-8"), "^\ufeff", "")
    records = listing.select(F.regexp_extract_all(text, F.lit(_RECORD), F.lit(1)).alias("records")).filter(F.size("records") > 0)
    named = records.select(
        F.transform(_fields(F.col("records")[0]), _tidy).alias("names"),
        F.explode(F.slice("records", 2, F.greatest(F.size("records") - 1, F.lit(0)))).alias("record"),
    )
    split = named.select("names", _fields(F.col("record")).alias("values"))
    at = lambda c: F.array_position("names", c).cast("int")
    value = lambda c: F.when(at(c) > 0, F.try_element_at("values", F.nullif(at(c), F.lit(0))))
    return split.select(*[F.nullif(value(c), F.lit("")).alias(c) for c in columns])


def read_employment(spark: SparkSession, directory: str, prefix: str = "allhlcn", columns: Sequence[str] = fv.EMPLOYMENT_COLUMNS) -> DataFrame:
    """Employment sheets below a folder: the wanted columns as text."""
    return read_sheets(spark, directory, f"{prefix}*.csv", columns)


def clean_employment(raw: DataFrame, prefix: str = fv.STATE_PREFIX) -> DataFrame:
    """State totals with typed keys and monthly numbers: (fips, year, qtr, 12 months)."""
    kept = raw.filter((F.col("st") == prefix) & clean.total_covered("ownership", "industry"))
    return kept.select(
        clean.pad_key(F.concat("st", "cnty")).alias("fips"),
        F.col("year").try_cast("int").alias("year"),
        F.col("qtr").try_cast("int").alias("qtr"),
        *[clean.parse_amount(m).alias(m) for m in fv.MONTH_COLUMNS],
    )


def read_fixed_width(
    spark: SparkSession, path: str, fields: Sequence[tuple[str, int, int | None]]
) -> DataFrame:
    """Fixed-width text; fields are (name, first character, last character or None for the rest)."""
    cols = [
        F.trim(F.expr(f"substring(value, {a}{'' if b is None else f', {b - a + 1}'})")).alias(name)
        for name, a, b in fields
    ]
    return spark.read.text(path).select(*cols)


def read_icd10(spark: SparkSession, path: str) -> DataFrame:
    return read_fixed_width(spark, path, [("code", 1, 7), ("description", 9, None)])


def read_icd9(spark: SparkSession, path: str) -> DataFrame:
    return _text_csv(spark, path).select(
        F.col("dgns_cd").alias("code"), F.col("longdesc").alias("description")
    )


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_extracts(
    spark: SparkSession,
    directory: str,
    variables: Sequence[str],
    key: str,
    period: str = r"\d{4}",
    with_period: bool = False,
    skip_unreadable: bool = False,
) -> DataFrame:
    """Periodic extracts ``{var}_{period}.csv`` as one long table (key, date, var, value).

    The variable comes from the file name under a strict pattern, so stray
    files such as a smoke test's are not mixed in.  An unreadable file is an
    error; with ``skip_unreadable`` it is passed over and ``extract_report``
    names it.  ``period`` may be e.g. ``[a-z0-9]+_\\d{6}`` for era and month.
    """
    raw, file, pattern = _extract_lines(spark, directory, variables, key, period, skip_unreadable)
    return raw.select(
        clean.pad_key(key).alias(key),
        F.col("date").try_cast("date").alias("date"),
        F.regexp_extract(file, pattern, 1).alias("var"),
        nan_to_null(F.col("value").try_cast("double")).alias("value"),
        *([F.regexp_extract(file, pattern, 2).alias("period")] if with_period else []),
    )


def _extract_lines(
    spark: SparkSession, directory: str, variables: Sequence[str], key: str, period: str, skip_unreadable: bool
) -> tuple[DataFrame, Column, str]:
    pattern = rf"^({'|'.join(variables)})_({period})\.csv$"
    raw = (
        spark.read.schema(f"`{key}` string, `date` string, `value` string")
        .options(header="true", mode="PERMISSIVE", escape='"', enforceSchema="true")
        .option("ignoreCorruptFiles", str(skip_unreadable).lower())
        .csv(f"{directory}/{_extract_glob(variables)}")
    )
    file = _extract_name(F.col("_metadata.file_path"))
    return raw.filter(file.rlike(pattern)), file, pattern


def _extract_glob(variables: Sequence[str]) -> str:
    return "{" + ",".join(f"{v}_*.csv" for v in variables) + "}"


def _extract_name(path: Column) -> Column:
    """The name of an extract, which is one file or a folder of parts."""
    return F.regexp_extract(path, r"([^/]+\.csv)(?:/part-[^/]*)?$", 1)


def extract_report(
    spark: SparkSession, directory: str, variables: Sequence[str], key: str, period: str = r"\d{4}"
) -> DataFrame:
    """(file, n_rows, n_bad_dates, status) of every extract file listed, also those that give nothing.

    ``skipped`` files could not be read or hold no row, ``damaged`` ones have
    rows whose date cannot be read, ``stray`` ones have another name.
    """
    listed = (
        spark.read.format("binaryFile")
        .load(f"{directory}/{_extract_glob(variables)}")
        .select(_extract_name(F.col("path")).alias("file"))
        .filter("file <> ''")
        .distinct()
    )
    raw, file, pattern = _extract_lines(spark, directory, variables, key, period, True)
    lines = raw.select(file.alias("file"), F.col("date").try_cast("date").isNull().alias("bad"))
    read = lines.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("bad").alias("n_bad_dates"))
    none = F.lit(0).cast("bigint")
    status = (
        F.when(~F.col("file").rlike(pattern), "stray")
        .when(F.col("n_rows") == 0, "skipped")
        .when(F.col("n_bad_dates") > 0, "damaged")
        .otherwise("read")
    )
    return (
        listed.join(read, "file", "left")
        .select("file", F.coalesce("n_rows", none).alias("n_rows"), F.coalesce("n_bad_dates", none).alias("n_bad_dates"))
        .withColumn("status", status)
    )


FAILURE_SCHEMA = "var string, date date, http_code string, message string"


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FAILURE_SCHEMA).options(header="true", escape='"').csv(path)


def clean_claims(raw: DataFrame, geo: DataFrame | None = None) -> DataFrame:
    """Typed claims with an age in the kept band, mapped to a zone where ``geo`` is given.

    The parsed fields pass through ``inline`` so that the optimizer does not
    copy the parsing into the age filter: every field is parsed once per row.
    """
    parsed = F.struct(
        clean.parse_mdy("bill_date").alias("bill_date"), clean.parse_month_year("dob_my").alias("dob")
    )
    rest = [c for c in raw.columns if c != "bill_date"]
    aged = (
        raw.select(*rest, F.inline(F.array(parsed)))
        .withColumn("age", clean.age_years("bill_date", "dob"))
        .filter(clean.age_kept("age"))
        .withColumns(
            {
                "zip": clean.zip5("zip"),
                "charge": clean.parse_amount("charge"),
                "gender": clean.blank_to("gender", "U"),
            }
        )
    )
    return aged if geo is None else map_claims(aged, geo)
