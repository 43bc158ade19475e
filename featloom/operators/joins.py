"""Joins on descriptive keys: titles and metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.functions import text as ft
from featloom.operators.cleaning import first_per_key
from featloom.session import materialize


def join_by_title(
    df: DataFrame,
    catalogue: DataFrame,
    left_title: str,
    right_title: str,
    columns: Sequence[str],
    dedupe_right: bool = False,
    order: Sequence[str] = (),
) -> DataFrame:
    """Left join on a normalised title (year suffix removed, stripped, lower-cased).

    Repeated titles on the right multiply rows; ``dedupe_right`` keeps the first
    per title in ``order`` instead. These are written first: while they are few, the
    rows of ``df`` stay where they are.
    """
    right = catalogue.select(
        ft.normalize_text(ft.strip_year_suffix(right_title)).alias("_title"),
        *[F.col(c).alias(f"_r_{c}") for c in dict.fromkeys([*columns, *order])],
    )
    if dedupe_right:
        right = materialize(first_per_key(right, ["_title"], [f"_r_{o}" for o in order]), "title-catalogue")
    left = df.withColumn("_title", ft.normalize_text(ft.strip_year_suffix(left_title)))
    return left.join(right, "_title", "left").select(*df.columns, *[F.col(f"_r_{c}").alias(c) for c in columns])


def merge_metadata(
    df: DataFrame,
    metadata: DataFrame | None,
    left_title: str = "originalTitle",
    right_title: str = "original_title",
    dedupe_right: bool = False,
    order: Sequence[str] = (),
) -> DataFrame:
    """Left join of metadata on title; columns in both tables are coalesced, own value first. The rows of ``dedupe_right`` are written first."""
    if metadata is None:
        return df
    right = metadata.withColumn(right_title, ft.normalize_text(right_title))
    if dedupe_right:
        right = materialize(first_per_key(right, [right_title], order or [c for c in right.columns if c != right_title]), "title-metadata")
    right = right.select(F.col(right_title).alias("_title"), *[F.col(c).alias(f"_m_{c}") for c in right.columns])
    left = df.withColumn(left_title, ft.normalize_text(left_title))
    joined = left.join(right, F.col(left_title) == F.col("_title"), "left")
    shared = set(df.columns) & set(metadata.columns)
    return joined.select(
        *[F.coalesce(F.col(c), F.col(f"_m_{c}")).alias(c) if c in shared else F.col(c) for c in df.columns],
        *[F.col(f"_m_{c}").alias(c) for c in metadata.columns if c not in shared],
    )
