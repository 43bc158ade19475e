"""Release-date features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.functions import columns as fc
from featloom.session import materialize


def add_age(df: DataFrame, as_of_year: int, year: str = "releaseYear", out: str = "movie_age") -> DataFrame:
    return df.withColumn(out, F.lit(as_of_year) - F.col(year))


def add_season(df: DataFrame, date: str | None = None, year: str = "releaseYear") -> DataFrame:
    """Day of year, season and one indicator per season.

    With a ``date`` column the real day is used; with a year only, the day is 1
    January. A missing date gives a missing day and zero indicators.
    """
    if date and date in df.columns:
        day = F.dayofyear(date)
    else:
        day = F.when(F.col(year).isNotNull(), F.lit(1))
    flags = {f"season_{s}": F.coalesce((F.col("season") == s).cast("int"), F.lit(0)) for s in fc.SEASONS}
    return df.withColumn("day_of_year", day).withColumn("season", fc.season("day_of_year")).withColumns(flags)


def add_year_count(df: DataFrame, year: str = "releaseYear", out: str = "movies_in_year", counts: DataFrame | None = None) -> DataFrame:
    """Rows per year, joined back.

    A count and a join rather than a window: one year may hold a third of all
    rows, and a window would put them in one task.
    """
    counts = fit_year_count(df, year, out) if counts is None else counts
    return df.join(counts, year, "left").select(*df.columns, out)


def fit_year_count(df: DataFrame, year: str = "releaseYear", out: str = "movies_in_year") -> DataFrame:
    """Rows per year. The missing year keeps its row; no join key equals it."""
    return materialize(df.groupBy(year).agg(F.count("*").alias(out)))


def add_temporal_features(
    df: DataFrame, as_of_year: int, year: str = "releaseYear", date: str | None = None, counts: DataFrame | None = None
) -> DataFrame:
    out = add_season(add_age(df, as_of_year, year), date, year)
    return add_year_count(out.drop("season"), year, counts=counts)
