"""The batch feature build: scan, clean, impute, credits, metadata, text, dates, categories, reduction.

Everything that is learned (fill values, top lists, popularity, vocabularies,
components) is fitted on the training split and applied unchanged to the others,
so all splits have the same columns.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.functions import text as ft
from featloom.operators import categories as cat
from featloom.operators import cleaning, credits, joins, model, sparse, temporal
from featloom.operators import text_features as text
from featloom.session import materialize
from featloom.sources import readers

KEY = "tconst"
METHODS = ("tfidf", "embedding", "combined")


@dataclass(frozen=True)
class MovieInputs:
    """Raw inputs of one split. Links, catalogue, metadata and lexicon may be absent; their steps are skipped."""

    titles: DataFrame
    directors: DataFrame | None = None
    writers: DataFrame | None = None
    catalogue: DataFrame | None = None  # (title, genres)
    metadata: DataFrame | None = None
    lexicon: DataFrame | None = None  # (word, polarity, subjectivity)


def load_inputs(
    spark: SparkSession,
    titles: str,
    directing_json: str | None = None,
    writing_json: str | None = None,
    movies_csv: str | None = None,
    metadata_csv: str | None = None,
    lexicon: DataFrame | None = None,
    links_layout: str = "records",
) -> MovieInputs:
    """Inputs from files: CSV shards, two JSON link tables in one of ``readers.LAYOUTS``, catalogue and metadata CSV."""
    return MovieInputs(
        readers.read_csv_shards(spark, titles, infer=False),
        readers.read_links(spark, directing_json, "director", links_layout) if directing_json else None,
        readers.read_links(spark, writing_json, "writer", links_layout) if writing_json else None,
        readers.read_catalogue(spark, movies_csv) if movies_csv else None,
        readers.read_metadata(spark, metadata_csv) if metadata_csv else None,
        lexicon,
    )


@dataclass(frozen=True)
class FeatureBuild:
    as_of_year: int
    feature_method: str = "combined"
    embedding: str = "cooccurrence"
    embedding_size: int = 100
    text_components: int = 50
    final_components: int = 10
    genre_components: int = 20
    expertise: str = "vector"  # a position for each category; or "columns", one for each, for few categories
    keep_wide: bool = False  # keep the unreduced category vectors too
    genre_columns: tuple[str, ...] = ("genres", "genre_names")
    title_columns: tuple[str, ...] = ("title", "primaryTitle")

    def fit(self, inputs: MovieInputs) -> FeatureModel:
        return self.fit_transform(inputs)[0]

    def fit_transform(self, inputs: MovieInputs) -> tuple[FeatureModel, DataFrame]:
        if self.feature_method not in METHODS:
            raise ValueError(f"unknown feature method: {self.feature_method}")
        facts = clean_titles(inputs.titles, self.as_of_year)
        fills = cleaning.fit_mean_fill(facts, ["runtimeMinutes", "numVotes"])
        facts = fills.transform(facts)
        top = None
        if inputs.directors is not None and inputs.writers is not None and "numVotes" in facts.columns:
            top = materialize(
                credits.top_people_flags(facts, inputs.directors, inputs.writers, KEY, "director", "writer", "numVotes")
            )
        expertise = _fit_expertise(inputs, facts, self)
        people = _fit_people(inputs)
        joined = _join(inputs, facts, top, expertise, people, self)
        # Titles without a rated director get the median title's rating.
        ratings = cleaning.fit_median_fill(joined, ["dir_avg_rating"]) if people is not None else cleaning.FillModel({})

        measure = next((c for c in ("numVotes", "vote_average") if c in joined.columns), None)
        popularity = None
        if "genres" in joined.columns:
            popularity = cat.fit_popularity(joined, "genres", measure).where("category <> ''")
        years = temporal.fit_year_count(joined) if "releaseYear" in joined.columns else None

        title = next((c for c in self.title_columns if c in joined.columns), None)
        fitted = []
        featured = _row_features(joined, self, years)
        wanted = [c for c in (title, "genres") if c and c in featured.columns]
        base = materialize(featured.select(KEY, *wanted), "fit-input")  # every fit below reads this, not the joins
        if title and self.feature_method in ("tfidf", "combined"):
            fitted.append(text.fit_tfidf_vectors(base, title, stop_words=text.english_stop_words()))
        if title and self.feature_method in ("embedding", "combined"):
            fitted.append(text.fit_embedding(base, title, method=self.embedding, size=self.embedding_size))
        if title and self.feature_method == "combined":
            fitted = [text.fit_text_components(base, *fitted, self.text_components, "text_pca_wide")]
            wide = materialize(fitted[-1].transform(base).select("text_pca_wide"), "text-components")
            fitted.append(model.fit_pca(wide, "text_pca_wide", "text_pca", self.final_components))
        if popularity is not None:
            vectors = cat.fit_category_vectors(base, "genres", popularity)
            fitted.append(cat.fit_category_components(base, vectors, self.genre_components, "genre_pca"))
        result = FeatureModel(self, fills, top, expertise, people, ratings, years, tuple(fitted))
        return result, result.apply(joined)


@dataclass(frozen=True)
class Expertise:
    """Category shares of each person, counted once on the training titles: (person, category, share), written.

    ``positions`` (category, position, hot) are those of the vectors, ``names`` the columns, where columns are wanted.
    """

    shares: Mapping[str, DataFrame]
    positions: DataFrame
    size: int
    names: tuple[str, ...] = ()


@dataclass(frozen=True)
class FeatureModel:
    build: FeatureBuild
    fills: cleaning.FillModel
    top: DataFrame | None
    expertise: Expertise | None
    people: DataFrame | None
    ratings: cleaning.FillModel
    years: DataFrame | None
    stages: tuple = field(default=())

    def transform(self, inputs: MovieInputs) -> DataFrame:
        facts = self.fills.transform(clean_titles(inputs.titles, self.build.as_of_year))
        return self.apply(_join(inputs, facts, self.top, self.expertise, self.people, self.build))

    def apply(self, joined: DataFrame) -> DataFrame:
        out = _row_features(self.ratings.transform(joined), self.build, self.years)
        for stage in self.stages:
            out = stage.transform(out)
            if self.build.keep_wide and isinstance(stage, cat.CategoryComponents):
                out = stage.vectors.transform(out, "genre_vec")
        # Reduced families replace their inputs.
        return out.drop("genres", "text_pca_wide")


def clean_titles(titles: DataFrame, as_of_year: int) -> DataFrame:
    return cleaning.unify_release_year(cleaning.clean_records(titles), as_of_year)


def _with_genres(df: DataFrame, build: FeatureBuild) -> DataFrame:
    """Category text, in any spelling and under the first of the names present, as the list ``genres``; missing text stays missing."""
    name = next((c for c in build.genre_columns if c in df.columns), None)
    if name is None:
        return df
    if dict(df.dtypes)[name] != "string":
        return df.withColumnRenamed(name, "genres")
    return df.withColumn(name, F.when(F.col(name).isNotNull(), ft.parse_categories(name))).withColumnRenamed(name, "genres")


def _titles_with_genres(inputs: MovieInputs, facts: DataFrame, build: FeatureBuild) -> DataFrame:
    out = _with_genres(facts, build)
    if inputs.catalogue is not None and "originalTitle" in out.columns and "genres" not in out.columns:
        out = joins.join_by_title(out, _with_genres(inputs.catalogue, build), "originalTitle", "title", ["genres"], dedupe_right=True, order=["genres"])
    return out


ROLES = (("director", "dir"), ("writer", "wri"))


def _fit_expertise(inputs: MovieInputs, facts: DataFrame, build: FeatureBuild) -> Expertise | None:
    """Counted on the training titles only, so that a title's features never depend on the rows it is scored with."""
    if inputs.catalogue is None:
        return None
    titles = _titles_with_genres(inputs, facts, build)
    if "genres" not in titles.columns:
        return None
    titles = materialize(titles.select(KEY, "genres"), "title-genres")
    shares = {}
    for person, _ in ROLES:
        links = getattr(inputs, f"{person}s")
        if links is not None:
            # A person's expertise counts the genres of their titles, matched by id.
            shares[person] = materialize(credits.category_expertise(links, titles, KEY, person, "genres"), f"{person}-expertise")
    if not shares:
        return None
    positions = credits.category_positions(list(shares.values()))
    names = credits.category_names(_with_genres(inputs.catalogue, build), "genres") if build.expertise == "columns" else ()
    return Expertise(shares, positions, max(positions.count(), 1), tuple(names))


RATING = "averageRating"


def _fit_people(inputs: MovieInputs) -> DataFrame | None:
    """Titles per director and their mean rating in the training links, where these carry one."""
    if inputs.directors is None or RATING not in inputs.directors.columns:
        return None
    return materialize(credits.person_stats(inputs.directors, KEY, "director", RATING), "director-stats")


def _join(inputs: MovieInputs, facts: DataFrame, top: DataFrame | None, expertise: Expertise | None, people: DataFrame | None, build: FeatureBuild) -> DataFrame:
    """Credits, genres, expertise, metadata and sentiment: all steps that shuffle, written once."""
    out = _with_genres(facts, build)
    if inputs.directors is not None and inputs.writers is not None and top is not None:
        out = credits.credit_features(out, inputs.directors, inputs.writers, top=top)
    out = _titles_with_genres(inputs, out, build)
    if people is not None and inputs.directors is not None:
        out = out.join(credits.title_person_stats(inputs.directors, people, KEY, "director"), KEY, "left")
    for person, prefix in ROLES:
        links = getattr(inputs, f"{person}s")
        if expertise is None or links is None or person not in expertise.shares:
            continue
        long = credits.title_expertise(links, expertise.shares[person], KEY, person, expertise.positions)
        if build.expertise == "columns":
            added = credits.expertise_columns(long, KEY, expertise.names, f"_{prefix}_expertise")
            out = out.join(added, KEY, "left").fillna(0.0, [f"{n}_{prefix}_expertise" for n in expertise.names])
        else:
            name = f"{prefix}_expertise_vec"
            added = credits.expertise_vector(long, KEY, name, expertise.positions, expertise.size)
            out = out.join(added, KEY, "left").withColumn(name, F.coalesce(name, sparse.no_cells(expertise.size)))
    if inputs.metadata is not None and "originalTitle" in out.columns:
        out = joins.merge_metadata(out, _with_genres(inputs.metadata, build), dedupe_right=True)
    out = sparse.as_vectors(out, [f"{prefix}_expertise_vec" for _, prefix in ROLES])
    worded = text.combined_text(out)
    if inputs.lexicon is not None and worded is not None:
        # Reads the written table twice instead of running the joins twice.
        scored = text.lexicon_sentiment(out, KEY, worded, materialize(inputs.lexicon))
        out = materialize(out.join(scored, KEY, "left"), "scored")
    return out


def _row_features(joined: DataFrame, build: FeatureBuild, years: DataFrame | None) -> DataFrame:
    """Features computed inside each row; the only join is with the year counts."""
    out = text.add_title_length(joined, build.title_columns)
    out = text.add_title_patterns(out, build.title_columns)
    if years is not None:
        out = temporal.add_temporal_features(out, build.as_of_year, counts=years)
    return out


def movie_inputs(part: DataFrame, lineitem: DataFrame) -> MovieInputs:
    """Inputs in the expected shape from the test tables: titles are parts, credits are line items."""
    k = F.col("p_partkey")
    year = (F.lit(1960) + k % 70).cast("string")
    titles = part.select(
        k.alias(KEY), F.initcap("p_name").alias("primaryTitle"), F.concat(F.lit(" "), "p_name").alias("originalTitle"),
        F.when(k % 10 == 0, "\\N").otherwise(year).alias("startYear"), F.when(k % 10 == 0, year).otherwise("\\N").alias("endYear"),
        F.when(k % 50 == 0, "?").otherwise((F.lit(60) + k % 120).cast("string")).alias("runtimeMinutes"),
        F.when(k % 10 == 3, " NaN ").otherwise(F.round(F.col("p_retailprice") * 10).cast("bigint").cast("string")).alias("numVotes"),
        (F.col("p_size") >= 26).alias("label"),
    )
    names = part.groupBy("p_name").agg(
        F.max("p_retailprice").alias("price"), F.min("p_brand").alias("brand"), F.min("p_type").alias("type"),
        F.count("*").alias("n"), F.avg((F.col("p_size") >= 26).cast("int")).alias("rate"),
    )
    catalogue = names.select(
        F.col("p_name").alias("title"), F.replace("p_name", F.lit(" "), F.lit("|")).alias("genres")
    )
    metadata = names.select(
        F.upper("p_name").alias("original_title"), F.col("price").alias("budget"), F.col("n").alias("vote_count"),
        F.col("p_name").alias("overview"), F.col("type").alias("tagline"),
    )
    lexicon = (
        names.select(F.explode(F.split("p_name", " ")).alias("word"), "rate").groupBy("word")
        .agg((2 * F.avg("rate") - 1).alias("polarity"), F.avg("rate").alias("subjectivity"))
    )
    split = lambda status, person: lineitem.where(F.col("l_linestatus") == status).select(
        F.col("l_partkey").alias(KEY), F.col("l_suppkey").alias(person)
    )
    return MovieInputs(titles, split("F", "director"), split("O", "writer"), catalogue, metadata, lexicon)
