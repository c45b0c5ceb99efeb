"""Dirty-value coercion as native column expressions (P3, S1 NA tokens).

Spark 4 runs with ANSI casts, so plain ``cast`` raises on dirty strings; every
coercion here is a guarded ``try_cast``. ``try_cast('1d' as double)`` gives 1.0
where a strict numeric parser rejects it, so strings are matched against a
numeric pattern first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The tokens a pandas CSV reader turns into missing values by default.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Decimal or scientific literal, optional sign and surrounding blanks; or inf/infinity.
NUMERIC_PATTERN = r"^\s*[+-]?((\d+(\.\d*)?)|(\.\d+))([eE][+-]?\d+)?\s*$"
INFINITY_PATTERN = r"^\s*[+-]?(?i)(inf|infinity)\s*$"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def na_to_null(c, tokens=NA_TOKENS) -> Column:
    """String column with the NA tokens mapped to null (S1 normaliser)."""
    c = _as_col(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def to_double(c, dtype: T.DataType | None = None) -> Column:
    """Numeric coercion: unparseable or NaN -> null, infinities kept.

    ``dtype`` is the column's Spark type when known; numeric columns skip the
    string guard.
    """
    c = _as_col(c)
    if dtype is not None and isinstance(dtype, T.NumericType):
        d = c.cast("double")
        return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)
    s = c.cast("string")
    parsed = F.when(s.rlike(NUMERIC_PATTERN) | s.rlike(INFINITY_PATTERN),
                    F.trim(s).try_cast("double"))
    return F.when(F.isnan(parsed), F.lit(None).cast("double")).otherwise(parsed)


def to_long(c, dtype: T.DataType | None = None) -> Column:
    """Integer coercion through double: truncates toward zero, non-finite -> null."""
    d = to_double(c, dtype)
    finite = d.isNotNull() & (F.abs(d) < F.lit(9.0e18))
    return F.when(finite, d.try_cast("long"))


def to_int_exact(c, dtype: T.DataType | None = None) -> Column:
    """Integer coercion that rejects fractional values (year columns)."""
    d = to_double(c, dtype)
    ok = d.isNotNull() & (F.abs(d) < F.lit(2.0e9)) & (d == F.floor(d))
    return F.when(ok, d.try_cast("int"))


def column_type(df, name: str) -> T.DataType:
    return df.schema[name].dataType
