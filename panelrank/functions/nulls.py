"""Missing values are null: not-a-number and infinities become null at the edge, and comparisons with null are false."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(x: Column | str) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def clean_numeric(df: DataFrame) -> DataFrame:
    """Infinities and not-a-number to null in all floating columns."""
    return df.withColumns({c: finite(c) for c, kind in df.dtypes if kind in ("double", "float")})


def safe_divide(a: Column | str, b: Column | str, fill: float | None = None) -> Column:
    """A / b, null (or `fill`) where that is not a finite number."""
    q = finite(F.try_divide(F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b))
    return q if fill is None else F.coalesce(q, F.lit(fill))


def number(x: Column | str) -> Column:
    """Text to double, null where that fails."""
    return finite((F.col(x) if isinstance(x, str) else x).try_cast("double"))


def true(condition: Column) -> Column:
    """A comparison that is false where it is unknown."""
    return F.coalesce(condition, F.lit(False))


def truthy(x: Column | str) -> Column:
    """Text such as 'true', '1' or 'yes' to a boolean."""
    return true(F.lower(F.trim((F.col(x) if isinstance(x, str) else x).cast("string"))).isin("1", "true", "t", "yes", "y"))


def rounded(x: Column | str, digits: int) -> Column:
    """`x` rounded half up as a binary number: scaled, rounded to a whole number and scaled back, as DuckDB's `round` does.

    `F.round` rounds the shortest decimal text instead, which differs where an already rounded number ends in a 5 that its binary
    value does not reach: -0.1284415 times 10^6 is above -128441.5.
    """
    x = F.col(x) if isinstance(x, str) else x
    return F.round(x * F.lit(10.0**digits)) / F.lit(10.0**digits)
