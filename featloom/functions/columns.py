"""Numeric, date and selection expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_YEAR = 1890  # fixed value: earliest accepted release year

# Season bins over the day of the year, right-closed.
SEASON_EDGES = (0, 90, 180, 270, 366)
SEASONS = ("winter", "spring", "summer", "autumn")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    """Double, or NULL for anything that is not a number (NaN included)."""
    return F.nanvl(_col(c).try_cast("double"), F.lit(None).cast("double"))


def to_long(c: Column | str) -> Column:
    """Nullable integer; integral decimals such as ``'12.0'`` are accepted."""
    c = _col(c)
    return F.coalesce(c.try_cast("bigint"), to_double(c).try_cast("bigint"))


def nan_to_null(c: Column | str) -> Column:
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def null_safe_not_equal(a: Column | str, b: Column | str) -> Column:
    """True where the values differ or either one is missing."""
    a, b = _col(a), _col(b)
    return (a != b) | a.isNull() | b.isNull()


def first_column(df: DataFrame, names: Sequence[str]) -> str | None:
    """The first of ``names`` that the table has."""
    return next((n for n in names if n in df.columns), None)


def clamp_year(c: Column | str, as_of_year: int, min_year: int = MIN_YEAR) -> Column:
    """A year outside [min_year, as_of_year] becomes ``as_of_year``; NULL stays."""
    c = _col(c)
    return F.when(~c.between(min_year, as_of_year), F.lit(as_of_year)).otherwise(c)


def season(day_of_year: Column | str, edges: Sequence[int] = SEASON_EDGES, names: Sequence[str] = SEASONS) -> Column:
    """Right-closed bins: day 90 is still the first season."""
    day = _col(day_of_year)
    out = F.when((day > edges[0]) & (day <= edges[1]), F.lit(names[0]))
    for low, high, name in zip(edges[1:], edges[2:], names[1:]):
        out = out.when((day > low) & (day <= high), F.lit(name))
    return out


def numeric_columns(df: DataFrame, exclude: Sequence[str] = (), booleans: bool = True) -> list[str]:
    """Names of numeric (and boolean) columns in table order, without ``exclude``."""
    kinds = (T.NumericType, T.BooleanType) if booleans else (T.NumericType,)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in set(exclude)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
