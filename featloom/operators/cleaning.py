"""Row cleaning: missing tokens, coercion, fills, de-duplication, schema alignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.functions import columns as fc
from featloom.functions import text as ft
from featloom.operators.order_stats import long_values, quantiles


def unify_missing(df: DataFrame, columns: Sequence[str] | None = None, rule: str = "tokens") -> DataFrame:
    """Turn text spellings of "missing" into NULL in the given (default: all) string columns."""
    fix = {"tokens": ft.null_if_missing_token, "pattern": ft.null_if_missing_pattern}[rule]
    chosen = [c for c in (columns or fc.string_columns(df)) if c in df.columns]
    return df.withColumns({c: fix(c) for c in chosen})


def coerce_numeric(df: DataFrame, columns: Sequence[str], integer: bool = False, fill: float | None = None) -> DataFrame:
    """Numbers where the text is one, NULL (or ``fill``) where it is not. Absent columns are skipped."""
    cast = fc.to_long if integer else fc.to_double
    exprs = {c: cast(c) for c in columns if c in df.columns}
    if fill is not None:
        exprs = {c: F.coalesce(e, F.lit(fill)) for c, e in exprs.items()}
    return df.withColumns(exprs) if exprs else df


def normalize_text(df: DataFrame, columns: Sequence[str], lower: bool = True) -> DataFrame:
    exprs = {c: ft.normalize_text(c, lower) for c in columns if c in df.columns}
    return df.withColumns(exprs) if exprs else df


def clean_titles(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, ft.normalize_text(column))


def clean_whitespace(df: DataFrame, column: str) -> DataFrame:
    """Strip; a blank cell becomes the empty text."""
    return df.withColumn(column, ft.strip(column))


def split_attached_words(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, ft.split_camel(column))


def normalize_characters(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, ft.ascii_fold(column))


def clean_records(
    df: DataFrame,
    numeric: Sequence[str] = ("startYear", "endYear", "runtimeMinutes", "numVotes"),
    text: Sequence[str] = ("primaryTitle", "originalTitle", "genres"),
    rule: str = "tokens",
    integer: bool = False,
    lower: bool = True,
) -> DataFrame:
    """Missing tokens, then numeric coercion, then text normalisation, in one projection chain."""
    out = unify_missing(df, rule=rule)
    out = coerce_numeric(out, numeric, integer=integer)
    return normalize_text(out, text, lower=lower)


def unify_release_year(
    df: DataFrame,
    as_of_year: int,
    start: str = "startYear",
    end: str = "endYear",
    date: str = "release_date",
    out: str = "releaseYear",
    date_format: str = "yyyy-MM-dd",
) -> DataFrame:
    """One release year from start/end year, else from a date; implausible years become ``as_of_year``."""
    if start in df.columns and end in df.columns:
        year = F.coalesce(F.col(start), F.col(end))
    elif date in df.columns:
        year = F.year(F.try_to_timestamp(F.col(date).cast("string"), F.lit(date_format)))
    elif out in df.columns:
        year = F.col(out)
    else:
        return df
    clamped = fc.clamp_year(year.try_cast("bigint"), as_of_year)
    return df.withColumn(out, clamped).drop(*[c for c in (start, end, date) if c != out])


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def only_missing(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def where_equal(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def where_mismatch(df: DataFrame, left: str, right: str) -> DataFrame:
    """Rows whose two columns differ; a missing value counts as a difference."""
    return df.where(fc.null_safe_not_equal(left, right))


def semi_join(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(other.select(*keys), list(keys), "left_semi")


# --- fills -----------------------------------------------------------------


@dataclass(frozen=True)
class FillModel:
    """Fitted fill values, one per column; NULL values leave the column as it is."""

    values: Mapping[str, float | None]

    def transform(self, df: DataFrame) -> DataFrame:
        exprs = {
            c: F.coalesce(fc.nan_to_null(F.col(c).cast("double")), F.lit(float(v)))
            for c, v in self.values.items()
            if v is not None and c in df.columns
        }
        return df.withColumns(exprs) if exprs else df


def fit_mean_fill(df: DataFrame, columns: Sequence[str]) -> FillModel:
    """Column means of the training rows.

    Nearest-neighbour imputation on a single column has no other coordinate to
    measure distance with and falls back to exactly this value.
    """
    chosen = [c for c in columns if c in df.columns]
    row = df.agg(*[F.avg(fc.to_double(c)).alias(c) for c in chosen]).first()
    return FillModel(row.asDict())


def fit_median_fill(df: DataFrame, columns: Sequence[str]) -> FillModel:
    """Exact column medians of the training rows (distributed selection, see ``order_stats``)."""
    chosen = [c for c in columns if c in df.columns]
    found = {r["column"]: r["p50"] for r in quantiles(long_values(df, chosen), ["column"], {"p50": 0.5}).collect()}
    return FillModel({c: found.get(c) for c in chosen})


def fill_constant(df: DataFrame, columns: Sequence[str], value) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in columns})


# --- de-duplication --------------------------------------------------------


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in ascending order of the ``order`` expressions, missing values first.

    An aggregate, not a window: each task keeps one candidate per key before the
    shuffle, so a key with a third of all rows sends one row per task. Remaining
    columns break ties, which makes the result independent of the input order.
    """
    rest = [c for c in df.columns if c not in set(keys)]
    ranked = [F.col(o) if isinstance(o, str) else o for o in order]
    packed = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(ranked)], *[F.col(c).alias(f"_c_{c}") for c in rest])
    best = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return best.select(*[
        F.col(c) if c in set(keys) else F.col("_first").getField(f"_c_{c}").alias(c) for c in df.columns
    ])


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once (missing keys count as equal)."""
    repeated = (
        df.groupBy(*keys).count().where("count > 1").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    )
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(repeated, same, "left_semi")


def duplicate_count(df: DataFrame, keys: Sequence[str] | None = None, alias: str = "duplicates") -> DataFrame:
    """Rows beyond the first of each key (default: of each whole row)."""
    per_key = df.groupBy(*(keys or df.columns)).count()
    return per_key.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias(alias))


# --- schema ----------------------------------------------------------------


def align_schema(df: DataFrame, columns: Sequence[str], fill: float = 0) -> DataFrame:
    """Exactly ``columns``, in order: missing ones added, extra ones dropped, NULL filled."""
    have = set(df.columns)
    return df.select(*[
        F.coalesce(F.col(c).cast("double"), F.lit(float(fill))).alias(c) if c in have else F.lit(float(fill)).alias(c)
        for c in columns
    ])
