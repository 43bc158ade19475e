"""Aggregates over many-to-many link tables (title, person).

A title or a person may hold a large share of all links, so nothing here
multiplies the links of one title with each other: shared-person flags and
fan-out counts are computed from per-key counts instead of joined pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.operators import sparse
from featloom.session import materialize


def distinct_per_key(links: DataFrame, key: str, person: str, alias: str) -> DataFrame:
    """Distinct persons per title (missing persons are not counted)."""
    return links.groupBy(key).agg(F.count_distinct(person).alias(alias))


def distinct_overall(links: DataFrame, columns: Sequence[str], relative_error: float | None = None) -> DataFrame:
    """Distinct values per column; with a ``relative_error`` by sketch, without shuffling the values."""
    if relative_error is None:
        return links.agg(*[F.count_distinct(c).alias(c) for c in columns])
    return links.agg(*[F.approx_count_distinct(c, relative_error).alias(c) for c in columns])


def role_links(directors: DataFrame, writers: DataFrame, key: str, director: str, writer: str) -> DataFrame:
    """One row per (title, person) with both role flags.

    Replaces the director x writer join of a title: the flags meet in the
    aggregate, whose map side already folds repeated links.
    """

    def marked(links: DataFrame, person: str, is_director: int) -> DataFrame:
        return links.select(
            F.col(key), F.col(person).alias("person"),
            F.lit(is_director).alias("is_director"), F.lit(1 - is_director).alias("is_writer"),
        )

    both = marked(directors, director, 1).unionByName(marked(writers, writer, 0))
    return both.groupBy(key, "person").agg(
        F.max("is_director").alias("is_director"), F.max("is_writer").alias("is_writer")
    )


def _both_roles() -> Column:
    return F.when(F.col("person").isNotNull(), F.least("is_director", "is_writer")).otherwise(0)


def any_shared_person(directors: DataFrame, writers: DataFrame, key: str, director: str, writer: str) -> DataFrame:
    """1 where some director of the title also writes it; titles present in both tables only."""
    return (
        role_links(directors, writers, key, director, writer)
        .groupBy(key)
        .agg(
            F.max(_both_roles()).alias("is_any_dir_writer"),
            F.max("is_director").alias("_d"), F.max("is_writer").alias("_w"),
        )
        .where("_d = 1 AND _w = 1")
        .select(key, "is_any_dir_writer")
    )


def same_person_credits(directors: DataFrame, writers: DataFrame, key: str, director: str, writer: str) -> DataFrame:
    """(title, person) with both roles, and how many joined rows the pair stands for."""
    d = directors.where(F.col(director).isNotNull()).groupBy(key, F.col(director).alias("person")).agg(F.count("*").alias("_d"))
    w = writers.where(F.col(writer).isNotNull()).groupBy(key, F.col(writer).alias("person")).agg(F.count("*").alias("_w"))
    return d.join(w, [key, "person"]).select(key, "person", (F.col("_d") * F.col("_w")).alias("n_rows"))


def mean_measure_per_person(links: DataFrame, facts: DataFrame, key: str, person: str, measure: str, alias: str) -> DataFrame:
    return links.select(key, person).join(facts.select(key, measure), key).groupBy(person).agg(F.avg(measure).alias(alias))


def top_people_by_mean(
    links: DataFrame, facts: DataFrame, key: str, person: str, measure: str, alias: str, k: int = 10
) -> DataFrame:
    """Top ``k`` persons by mean measure; the person id breaks ties."""
    means = mean_measure_per_person(links, facts, key, person, measure, alias)
    return means.orderBy(F.col(alias).desc_nulls_last(), F.col(person).asc()).limit(k)


def top_k_flags(links: DataFrame, top: DataFrame, key: str, person: str, alias: str) -> DataFrame:
    """1 for titles with at least one link to a person of ``top`` (a limited top-k table)."""
    return links.join(top.select(person), person, "left_semi").groupBy(key).agg((F.count("*") > 0).cast("int").alias(alias))


def top_people_flags(
    facts: DataFrame, directors: DataFrame, writers: DataFrame, key: str, director: str, writer: str, measure: str, k: int = 10
) -> DataFrame:
    """(person, _top_d, _top_w) for the top ``k`` directors and writers: at most 2k rows."""
    top_d = top_people_by_mean(directors, facts, key, director, measure, "_mean", k)
    top_w = top_people_by_mean(writers, facts, key, writer, measure, "_mean", k)
    return (
        top_d.select(F.col(director).alias("person"), F.lit(1).alias("_top_d"), F.lit(0).alias("_top_w"))
        .unionByName(top_w.select(F.col(writer).alias("person"), F.lit(0).alias("_top_d"), F.lit(1).alias("_top_w")))
        .groupBy("person")
        .agg(F.max("_top_d").alias("_top_d"), F.max("_top_w").alias("_top_w"))
    )


def credit_features(
    facts: DataFrame,
    directors: DataFrame,
    writers: DataFrame,
    key: str = "tconst",
    director: str = "director",
    writer: str = "writer",
    measure: str = "numVotes",
    k: int = 10,
    top: DataFrame | None = None,
) -> DataFrame:
    """Facts with director/writer counts, shared-person flag and top-k flags.

    One aggregation chain and one join instead of five: counts, flags and top-k
    membership all come from the (title, person) table. ``top`` is a fitted
    ``top_people_flags`` table, by default fitted on ``facts``.
    """
    if top is None:
        top = top_people_flags(facts, directors, writers, key, director, writer, measure, k)
    known = F.col("person").isNotNull().cast("int")
    per_title = (
        role_links(directors, writers, key, director, writer)
        .join(top, "person", "left")
        .groupBy(key)
        .agg(
            F.sum(F.col("is_director") * known).alias("director_count"),
            F.sum(F.col("is_writer") * known).alias("writer_count"),
            F.max(_both_roles()).alias("is_any_dir_writer"),
            F.max(F.coalesce(F.col("_top_d") * F.col("is_director"), F.lit(0))).alias("is_top_10_director"),
            F.max(F.coalesce(F.col("_top_w") * F.col("is_writer"), F.lit(0))).alias("is_top_10_writer"),
        )
    )
    added = [c for c in per_title.columns if c != key]
    joined = facts.join(per_title, key, "left")
    return joined.select(*facts.columns, *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in added])


def person_stats(links: DataFrame, key: str, person: str, rating: str | None = None, prefix: str = "dir") -> DataFrame:
    """Distinct titles and, where the link table carries one, mean rating per person."""
    aggs = [F.count_distinct(key).alias(f"{prefix}_movie_count")]
    if rating and rating in links.columns:
        aggs.append(F.avg(rating).alias(f"{prefix}_avg_rating"))
    return links.where(F.col(person).isNotNull()).groupBy(person).agg(*aggs)


def title_person_stats(links: DataFrame, stats: DataFrame, key: str, person: str) -> DataFrame:
    """(key, statistics...): means of the statistics of ``person_stats`` over a title's distinct persons."""
    numbers = [c for c in stats.columns if c != person]
    held = links.select(key, person).distinct().join(stats, person)
    return held.groupBy(key).agg(*[F.avg(c).alias(c) for c in numbers])


# --- fan-out counts --------------------------------------------------------


def fanout_counts(facts: DataFrame, directors: DataFrame, writers: DataFrame, key: str) -> DataFrame:
    """Rows per title after the two left joins fact -> directors -> writers, without joining them.

    A title with d director rows and w writer rows yields max(d,1) * max(w,1)
    rows; with no director row the second join finds nothing either.
    """
    f = facts.groupBy(key).agg(F.count("*").alias("_f"))
    d = directors.groupBy(key).agg(F.count("*").alias("n_directors"))
    w = writers.groupBy(key).agg(F.count("*").alias("n_writers"))
    n_d = F.coalesce(F.col("n_directors"), F.lit(0))
    n_w = F.when(n_d > 0, F.coalesce(F.col("n_writers"), F.lit(0))).otherwise(F.lit(0))
    return f.join(d, key, "left").join(w, key, "left").select(
        key, n_d.alias("n_directors"), n_w.alias("n_writers"),
        (F.col("_f") * F.greatest(n_d, F.lit(1)) * F.greatest(n_w, F.lit(1))).alias("n_rows"),
    )


def fanout_people(
    directors: DataFrame,
    writers: DataFrame,
    key: str,
    director: str,
    writer: str,
    facts: DataFrame | None = None,
) -> DataFrame:
    """(role, person, n): how often each person occurs in the joined credits, without the joined rows.

    A director link occurs once per writer row of its title (at least once), a
    writer link once per director row; ``facts`` restricts and weights titles.
    """
    per_d = directors.groupBy(key, F.col(director).alias("person")).agg(F.count("*").alias("links"))
    per_w = writers.groupBy(key, F.col(writer).alias("person")).agg(F.count("*").alias("links"))
    titles_d = per_d.groupBy(key).agg(F.sum("links").alias("other"))
    titles_w = per_w.groupBy(key).agg(F.sum("links").alias("other"))
    weighted_d = per_d.join(titles_w, key, "left").withColumn("times", F.col("links") * F.coalesce("other", F.lit(1)))
    weighted_w = per_w.join(titles_d, key).withColumn("times", F.col("links") * F.col("other"))
    rows = weighted_d.select(key, F.lit("director").alias("role"), "person", "times").unionByName(
        weighted_w.select(key, F.lit("writer").alias("role"), "person", "times")
    )
    if facts is not None:
        rows = rows.join(facts.groupBy(key).agg(F.count("*").alias("_f")), key).withColumn("times", F.col("times") * F.col("_f"))
    return rows.where(F.col("person").isNotNull()).groupBy("role", "person").agg(F.sum("times").alias("n"))


def top_people(counts: DataFrame, role: str, k: int = 10) -> DataFrame:
    return counts.where(F.col("role") == role).orderBy(F.col("n").desc(), F.col("person").asc()).limit(k)


# --- category expertise ----------------------------------------------------


def category_expertise(links: DataFrame, titles: DataFrame, key: str, person: str, categories: str) -> DataFrame:
    """Share of each category in a person's credits: (person, category, n, total, expertise).

    ``titles`` has one array of categories per title. The total comes from a
    second small aggregate, joined back on the person.
    """
    counts = (
        links.select(key, person)
        .where(F.col(person).isNotNull())
        .join(titles.select(key, F.explode(categories).alias("category")), key)
        .groupBy(person, "category")
        .agg(F.count("*").alias("genre_count"))
    )
    totals = counts.groupBy(person).agg(F.sum("genre_count").alias("total_count"))
    return counts.join(totals, person).select(
        person, "category", "genre_count", "total_count",
        (F.col("genre_count") / F.col("total_count")).alias("genre_expertise"),
    )


def expertise_matrix(expertise: DataFrame, person: str, categories: Sequence[str]) -> DataFrame:
    """Wide form, one column per category, absent ones 0."""
    wide = expertise.groupBy(person).pivot("category", list(categories)).agg(F.first("genre_expertise"))
    return wide.select(person, *[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(c) for c in categories])


def join_expertise(facts: DataFrame, matrix: DataFrame, person: str, suffix: str) -> DataFrame:
    """Left join of an expertise matrix; clashing names get ``suffix``, persons without credits get 0."""
    renamed = {c: (c + suffix if c in facts.columns else c) for c in matrix.columns if c != person}
    right = matrix.withColumnsRenamed(renamed)
    return facts.join(right, person, "left").select(
        *facts.columns, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in renamed.values()]
    )


#: Categories whose numbers stand side by side in one row.
TILE = 16
#: Slices of the titles. A person's numbers are moved once for each slice they have a title in, not once for each title.
BLOCKS = 32


def category_positions(shares: Sequence[DataFrame]) -> DataFrame:
    """(category, hot, position) of the categories of tables of ``category_expertise``, written."""
    held = reduce(DataFrame.unionByName, [s.select("category", "genre_count") for s in shares])
    counts = materialize(held.groupBy("category").agg(F.sum("genre_count").alias("n")), "expertise-categories")
    return materialize(sparse.dictionary(sparse.mark_hot(counts, "n").select("category", "hot"), ["category"]), "expertise-positions")


def _profiles(shares: DataFrame, person: str, positions: DataFrame) -> DataFrame:
    """(person, _tiles): a person's shares, ``TILE`` positions to an entry, null where there is none; their own categories bound the row."""
    at = positions.select(F.col("category").alias("_c"), "position")
    placed = shares.join(at, F.col("category").eqNullSafe(F.col("_c")))
    slot = F.pmod("position", F.lit(TILE))
    numbers = [F.sum(F.when(slot == i, F.col("genre_expertise"))).alias(f"z{i}") for i in range(TILE)]
    tiles = placed.groupBy(person, F.floor(F.col("position") / TILE).alias("tile")).agg(*numbers)
    return tiles.groupBy(person).agg(F.collect_list(F.struct("tile", *[f"z{i}" for i in range(TILE)])).alias("_tiles"))


def title_expertise(links: DataFrame, shares: DataFrame, key: str, person: str, positions: DataFrame | None = None) -> DataFrame:
    """(key, category, expertise): mean over a title's persons that have any credit, absent categories counting 0.

    ``shares`` is the long table of ``category_expertise``, ``positions`` that of its
    ``category_positions``. A person's titles are listed by slice of the titles; the
    lists meet the person's numbers and are moved by slice, where most of the adding
    up is done before titles are moved. A list is never longer than a slice, and a
    row of numbers never holds more than a person's own categories.
    """
    positions = category_positions([shares]) if positions is None else positions
    block = F.pmod(F.xxhash64(key), F.lit(BLOCKS)).alias("_block")
    titles = links.where(F.col(person).isNotNull()).groupBy(person, block).agg(F.collect_set(key).alias("_keys"))
    met = titles.join(_profiles(shares, person, positions), person).select("_block", "_keys", "_tiles").hint("rebalance", "_block")
    each = met.select(F.explode("_keys").alias(key), "_tiles").select(key, F.posexplode("_tiles").alias("_i", "_t"))
    numbers = [f"z{i}" for i in range(TILE)]
    first = F.sum((F.col("_i") == 0).cast("long")).alias("_n")  # a person counts once, in the first of their tiles
    sums = each.groupBy(key, F.col("_t.tile").alias("tile")).agg(first, *[F.sum(f"_t.{z}").alias(z) for z in numbers])
    cells = F.array(*[F.struct((F.col("tile") * TILE + i).alias("position"), F.col(z).alias("s")) for i, z in enumerate(numbers)])
    held = sums.select(key, "_n", F.filter(cells, lambda c: c.s.isNotNull()).alias("_c")).groupBy(key)
    each = held.agg(F.sum("_n").alias("_n"), F.flatten(F.collect_list("_c")).alias("_c")).select(key, "_n", F.explode("_c").alias("_c"))
    means = each.select(key, "_c.position", (F.col("_c.s") / F.col("_n")).alias("expertise"))
    return sparse.join_known(means, positions, "position", key).select(key, "category", "expertise")


def expertise_columns(long: DataFrame, key: str, names: Sequence[str], suffix: str) -> DataFrame:
    """One column per name, absent ones 0. The names are the caller's choice; the long table has no such list."""
    wide = long.groupBy(key).pivot("category", list(names)).agg(F.first("expertise"))
    return wide.select(key, *[F.coalesce(F.col(f"`{n}`"), F.lit(0.0)).alias(n + suffix) for n in names])


def expertise_vector(long: DataFrame, key: str, out: str, positions: DataFrame, size: int) -> DataFrame:
    """One sparse vector per title in storage form; ``positions`` is (category, position, hot), one for each category."""
    cells = sparse.join_known(long, positions, "category", key)
    return sparse.packed(cells, key, size, out, value="expertise")


def category_names(df: DataFrame, categories: str) -> list[str]:
    """The distinct categories, sorted, for callers that want them as columns."""
    found = df.select(F.explode(categories).alias("c")).where("c IS NOT NULL").distinct()
    return sorted(r["c"] for r in found.collect())
