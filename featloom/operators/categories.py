"""Multi-valued categories: explode, popularity, weighted multi-hot, interactions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.operators import sparse
from featloom.session import materialize


def explode_list(df: DataFrame, column: str, alias: str, position: bool = False) -> DataFrame:
    """One row per list element; empty and missing lists drop out."""
    rest = [c for c in df.columns if c != column]
    if position:
        return df.select(*rest, F.posexplode(column).alias("position", alias))
    return df.select(*rest, F.explode(column).alias(alias))


def popularity(df: DataFrame, categories: str, measure: str | None = None) -> DataFrame:
    """Mean measure of the rows that carry each category; 1.0 without a measure.

    A category that occurs only with missing measures gets NULL, as a mean does.
    """
    value = F.avg(measure) if measure else F.lit(1.0)
    each = df.select(F.explode(F.array_distinct(categories)).alias("category"), *([measure] if measure else []))
    return each.groupBy("category").agg(value.cast("double").alias("popularity"))


def weighted_categories(df: DataFrame, key: str, categories: str, weights: DataFrame) -> DataFrame:
    """(key, category, weight): occurrences in the row times the category's popularity.

    Occurrences are counted inside the row's own list, so the only join is with
    the written weights table: broadcast while small, a shuffle join beyond. Categories without a fitted weight count with 1.0.
    """
    counted = df.select(
        key,
        F.explode(
            F.transform(
                F.array_distinct(categories),
                lambda g: F.struct(g.alias("category"), F.size(F.filter(categories, lambda x: x == g)).alias("n")),
            )
        ).alias("_c"),
    ).select(key, "_c.category", "_c.n")
    known = weights.select("category", "popularity", F.lit(True).alias("_known"))
    factor = F.when(F.col("_known"), F.col("popularity")).otherwise(F.lit(1.0))
    return counted.join(known, "category", "left").select(key, "category", (F.col("n") * factor).alias("weight"))


def multi_hot(weighted: DataFrame, keys: DataFrame, key: str, names: Sequence[str], prefix: str = "genre_") -> DataFrame:
    """Wide form for all ``keys``: one column per category, 0 where absent."""
    wide = weighted.groupBy(key).pivot("category", list(names)).agg(F.first("weight"))
    return keys.select(key).join(wide, key, "left").select(
        key, *[F.coalesce(F.col(f"`{n}`"), F.lit(0.0)).alias(prefix + n) for n in names]
    )


def interactions(df: DataFrame, key: str, categories: str, weights: DataFrame) -> DataFrame:
    """(key, left, right, product) for the category pairs of each row, left < right.

    Pairs are formed inside the row's own short list, without a self-join.
    """
    unit = F.array_sort(F.array_distinct(categories))
    counted = F.transform(
        unit, lambda g: F.struct(g.alias("g"), F.size(F.filter(categories, lambda x: x == g)).alias("n"))
    )
    pairs = df.select(key, counted.alias("_u")).select(
        key,
        F.explode(
            F.flatten(
                F.transform(
                    F.col("_u"),
                    lambda a, i: F.transform(
                        F.slice(F.col("_u"), i + 2, F.size("_u")), lambda b: F.struct(a.alias("a"), b.alias("b"))
                    ),
                )
            )
        ).alias("_p"),
    ).select(key, F.col("_p.a.g").alias("left"), F.col("_p.b.g").alias("right"),
             (F.col("_p.a.n") * F.col("_p.b.n")).alias("n"))
    for side in ("left", "right"):
        known = weights.select(
            F.col("category").alias(side), F.col("popularity").alias(f"_w_{side}"), F.lit(True).alias(f"_known_{side}")
        )
        pairs = pairs.join(known, side, "left")

    def factor(side: str):
        return F.when(F.col(f"_known_{side}"), F.col(f"_w_{side}")).otherwise(F.lit(1.0))

    return pairs.select(key, "left", "right", (F.col("n") * factor("left") * factor("right")).alias("product"))


def fit_popularity(df: DataFrame, categories: str, measure: str | None = None) -> DataFrame:
    """Popularity of the training rows, written for reuse on other splits."""
    return materialize(popularity(df, categories, measure))


def list_rows(df: DataFrame, categories: str) -> DataFrame:
    """(row, list, weight): each distinct list once, with the number of its rows; rows without a list are not there."""
    key = F.sha2(F.to_json(F.array_sort(F.col(categories))), 256)
    return df.select(key.alias("row"), F.array_sort(F.col(categories)).alias("list")).where("list IS NOT NULL").groupBy("row").agg(
        F.first("list").alias("list"), F.count(F.lit(1)).alias("weight")
    )


def _counted(lists: DataFrame) -> DataFrame:
    """(row, category, n, weight): how often each category stands in a list."""
    each = lists.select("row", "weight", F.explode("list").alias("category")).where("category IS NOT NULL")
    return each.groupBy("row", "weight", "category").agg(F.count("*").alias("n"))


def _pairs(known: DataFrame) -> DataFrame:
    """(row, pair, value, weight): products of the weights of every two categories of a list; a list's own categories bound its pairs."""
    held = F.array_sort(F.collect_list(F.struct("category", "value")))
    joined = F.transform("_u", lambda a, i: F.transform(
        F.slice("_u", i + 2, F.size("_u")),
        lambda b: F.struct(F.concat_ws("\x00", a.category, b.category).alias("pair"), (a.value * b.value).alias("value")),
    ))
    each = known.groupBy("row", "weight").agg(held.alias("_u")).select("row", "weight", F.explode(F.flatten(joined)).alias("_p"))
    return each.select("row", "_p.pair", "_p.value", "weight")


@dataclass(frozen=True)
class CategoryVectors:
    """Weighted counts by category, then products by pair, each at a position of its own.

    ``singles`` is (category, w, position, hot), ``pairs`` (pair, position, hot), both
    written; pairs follow the categories. What the fit has not seen is left out,
    a category without a popularity counts 0.
    """

    categories: str
    size: int
    singles: DataFrame
    pairs: DataFrame

    def cells(self, lists: DataFrame) -> DataFrame:
        """(row, position, value, weight) of ``list_rows``."""
        known = _weighed(lists, self.singles)
        pairs = sparse.join_known(_pairs(known), self.pairs, "pair", "row")
        columns = ["row", "position", "value", "weight"]
        return known.select(*columns).unionByName(pairs.select(*columns)).where("value <> 0")

    def transform(self, df: DataFrame, out: str) -> DataFrame:
        """``df`` with a sparse vector, written."""
        held = materialize(sparse.packed(self.cells(list_rows(df, self.categories)), "row", self.size, out), "category-rows")
        return sparse.as_vectors(join_lists(df, self.categories, held, out, sparse.no_cells(self.size)), [out])


def _weighed(lists: DataFrame, singles: DataFrame) -> DataFrame:
    return sparse.join_known(_counted(lists), singles, "category", "row").withColumn("value", F.col("n") * F.col("w"))


def join_lists(df: DataFrame, categories: str, found: DataFrame, out: str, absent: Column) -> DataFrame:
    """``df`` with ``out`` of its category lists from (row, out); ``absent`` where there is none. While ``found`` is written and small, no row of ``df`` is moved."""
    key = F.sha2(F.to_json(F.array_sort(F.col(categories))), 256)
    held = df.drop(out).withColumn("_row", key).join(found.select(F.col("row").alias("_row"), out), "_row", "left").drop("_row")
    return held.withColumn(out, F.coalesce(out, absent))


def fit_category_vectors(df: DataFrame, categories: str, weights: DataFrame) -> CategoryVectors:
    """Positions for the categories of ``weights`` (category, popularity) and for every pair that a row of ``df`` holds."""
    lists = materialize(list_rows(df, categories), "category-lists")
    used = _counted(lists).groupBy("category").agg(F.sum("weight").alias("_n"))
    singles = weights.select("category", F.coalesce("popularity", F.lit(0.0)).alias("w")).join(used, "category", "left").fillna(0, ["_n"])
    singles = sparse.mark_hot(materialize(singles, "categories"), "_n").select("category", "w", "hot")
    singles = materialize(sparse.dictionary(singles, ["category"]), "category-positions")
    n = singles.count()
    seen = _pairs(_weighed(lists, singles)).groupBy("pair").agg(F.sum("weight").alias("_n"))
    pairs = sparse.dictionary(sparse.mark_hot(materialize(seen, "category-pairs"), "_n").select("pair", "hot"), ["pair"])
    pairs = materialize(pairs.withColumn("position", F.col("position") + n), "pair-positions")
    return CategoryVectors(categories, max(n + pairs.count(), 1), singles, pairs)


@dataclass(frozen=True)
class CategoryComponents:
    vectors: CategoryVectors
    out: str
    components: sparse.Components

    def transform(self, df: DataFrame) -> DataFrame:
        found = self.components.project(self.vectors.cells(list_rows(df, self.vectors.categories)), "row")
        found = materialize(found.select("row", array_to_vector("components").alias(self.out)), "category-numbers")
        return join_lists(df, self.vectors.categories, found, self.out, array_to_vector(self.components.at_zero()))


def fit_category_components(df: DataFrame, vectors: CategoryVectors, k: int, out: str) -> CategoryComponents:
    cells = materialize(vectors.cells(list_rows(df, vectors.categories)), "category-cells")
    return CategoryComponents(vectors, out, sparse.fit_components(cells, df.count(), k))
