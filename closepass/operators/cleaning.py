"""From raw text rows to the typed approaches table."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closepass.functions.numeric import to_number
from closepass.schema import NUMERIC_COLUMNS, TEXT_COLUMNS, present

# Date layout of the raw text, and text that stands for "missing".
RAW_DATE = r"(?i)^(\d{4})-(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)-(\d{1,2}) (\d{1,2}):(\d{1,2})$"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MISSING_TEXT = ("nan", "None", "")


def normalize_names(df: DataFrame) -> DataFrame:
    """Strip blanks around column names."""
    return df.toDF(*[name.strip() for name in df.columns])


def parse_date(c: Column | str) -> Column:
    """``2024-Apr-13 12:00`` to a timestamp without time zone; other text to NULL.

    It is made of its parts, so no session time zone can shift it.
    """
    text = F.col(c) if isinstance(c, str) else c
    year, month, day, hour, minute = (F.regexp_extract(text, RAW_DATE, k) for k in range(1, 6))
    number = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(month)).cast("int")
    parts = [year.try_cast("int"), number, *(p.try_cast("int") for p in (day, hour, minute))]
    return F.try_make_timestamp_ntz(*parts, F.lit(0).cast("decimal(16,6)"))


def clean_text(c: Column | str) -> Column:
    """Trimmed text; NULL for text that stands for a missing value."""
    text = F.trim(F.col(c) if isinstance(c, str) else c)
    return F.when(~text.isin(*MISSING_TEXT), text)


def clean(df: DataFrame, strict: bool = False) -> DataFrame:
    """Type, validate and deduplicate raw rows.

    Dates and numbers that do not parse become NULL, rows without a positive
    distance are dropped, text is trimmed, ``approach_year`` is derived and
    repeated rows are removed.  ``strict`` raises ValueError for an empty input or
    result; each check starts a job, so it is off by default.
    """
    if strict and df.isEmpty():
        raise ValueError("Cannot clean empty DataFrame")
    rows = normalize_names(df)
    typed = {}
    if "cd" in rows.columns:
        typed["cd"] = parse_date("cd")
    typed.update({c: to_number(c) for c in present(rows, *NUMERIC_COLUMNS)})
    typed.update({c: clean_text(c) for c in present(rows, *TEXT_COLUMNS)})
    rows = rows.withColumns(typed)
    if "dist" in rows.columns:
        rows = rows.filter(F.col("dist") > 0)
    # The year follows from the date, so rows are compared without it.
    year = F.year("cd").cast("bigint") if "cd" in rows.columns else F.lit(None).cast("bigint")
    result = rows.dropDuplicates().withColumn("approach_year", year)
    if strict and result.isEmpty():
        raise ValueError("All data was filtered out during cleaning")
    return result


def dedupe_by_key(
    df: DataFrame, order: Sequence[Column | str], keys: Sequence[str] = ("des", "cd")
) -> DataFrame:
    """Keep the first row per key in the given source order.

    ``order`` must be total, else the kept row depends on the partitioning.  Only
    one row per key and task leaves the map side.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def with_date_text(df: DataFrame, column: str = "cd") -> DataFrame:
    """The date as ``yyyy-MM-dd HH:mm:ss`` text."""
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd HH:mm:ss"))
