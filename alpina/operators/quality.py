"""Row filters (F1, F2, F3) and column-contract checks.

Filters are narrow and keep every column, so Catalyst pushes what it can
into the scan and fuses the rest into one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import column_type, to_double, to_int_exact

# Defaults of the filters and of the year extraction.
DEFAULT_ACCURACY_M = 100.0
ACCURACY_COL = "positional_accuracy"
ELEVATION_COL = "elevation_m"
GRADE_COL = "quality_grade"
# Accepted date parts of ``observed_on``: year first, else day or month first; a time of any layout may follow.
YEAR_FIRST = r"^(\d{4}[-/]\d{1,2}[-/]\d{1,2})(?:[T ].*)?$"
YEAR_LAST = r"^(\d{1,2}/\d{1,2}/\d{4})(?: .*)?$"


def require_columns(df: DataFrame, *names: str) -> None:
    """Raise naming the first missing column."""
    have = set(df.columns)
    for n in names:
        if n not in have:
            raise ValueError(f"input must contain a '{n}' column")


def resolve_lon_lat(df: DataFrame, lon_field: str | None = None, lat_field: str | None = None) -> tuple[str, str]:
    """Explicit pair if both given, else longitude/latitude, else lon/lat (any case)."""
    if lon_field and lat_field:
        return lon_field, lat_field
    lower = {c.lower(): c for c in reversed(df.columns)}
    for a, b in (("longitude", "latitude"), ("lon", "lat")):
        if a in lower and b in lower:
            return lower[a], lower[b]
    raise ValueError("longitude/latitude columns not found")


def numeric(df: DataFrame, name: str) -> Column:
    return to_double(F.col(name), column_type(df, name))


def filter_position(df: DataFrame, max_accuracy: float = DEFAULT_ACCURACY_M) -> DataFrame:
    """keep rows whose numeric accuracy is ``<= max_accuracy`` (inclusive, no lower bound)."""
    require_columns(df, ACCURACY_COL)
    return df.where(numeric(df, ACCURACY_COL) <= F.lit(float(max_accuracy)))


def filter_elevation(df: DataFrame) -> DataFrame:
    """keep rows with a numeric elevation."""
    require_columns(df, ELEVATION_COL)
    return df.where(numeric(df, ELEVATION_COL).isNotNull())


def filter_grade(df: DataFrame, grades) -> DataFrame:
    """keep rows whose grade is in ``grades`` (case-sensitive; null dropped)."""
    grades = [g for g in (grades or [])]
    if not grades:
        raise ValueError("at least one quality grade is required")
    require_columns(df, GRADE_COL)
    return df.where(F.col(GRADE_COL).isin(grades))


def year_column(df: DataFrame, year_field: str = "year", date_field: str = "observed_on") -> Column:
    """The numeric year column, else the year of ``observed_on``; nullable int.

    The year is that of the date as written: an offset or zone behind it does
    not move it. Non-integral years and unparseable dates give null (rows then
    stay out of the clustering but are kept in the output).
    """
    if year_field in df.columns:
        return to_int_exact(F.col(year_field), column_type(df, year_field))
    if date_field in df.columns:
        s = F.trim(F.col(date_field).cast("string"))
        first = F.replace(F.regexp_extract(s, YEAR_FIRST, 1), F.lit("/"), F.lit("-"))
        last = F.regexp_extract(s, YEAR_LAST, 1)
        tries = [(first, "yyyy-M-d"), (last, "d/M/yyyy"), (last, "M/d/yyyy")]
        return F.year(F.coalesce(*[F.try_to_timestamp(F.nullif(c, F.lit("")), F.lit(f)) for c, f in tries])).cast("int")
    raise ValueError(f"cannot derive the year: no '{year_field}' and no '{date_field}' column")


def with_year(df: DataFrame, out: str = "cluster_year", **kw) -> DataFrame:
    return df.withColumn(out, year_column(df, **kw))


def row_counts(df: DataFrame, year_col: str = "cluster_year") -> DataFrame:
    """A5: total rows and rows without a usable year (these stay out of the clustering)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(F.col(year_col).isNull()).alias("n_without_year"))
