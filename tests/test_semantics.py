"""Missing values, rounding and ordering rules, with the expected value written out."""

import datetime
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from featloom.functions import columns as fc
from featloom.functions import text as ft
from featloom.operators import categories, cleaning, credits, joins, model, profile, temporal
from featloom.operators import text_features as tf


def one(spark, column, *values, schema="v string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], schema).select(column).collect()]


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_junk_numbers_become_null(spark):
    assert one(spark, fc.to_double("v"), "1.5", "x", "", "NaN", None) == [1.5, None, None, None, None]
    assert one(spark, fc.to_long("v"), "12", "12.0", "12 min", None) == [12, 12, None, None]


def test_strip_removes_all_whitespace(spark):
    assert one(spark, ft.strip("v"), "\t a b 　\n", " ", "\x1fx") == ["a b", "", "x"]


def test_value_counts_drop_null_keys(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "v string")
    assert rows(profile.value_counts(df, ["v"])) == [("a", 2)]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert cleaning.fit_mean_fill(df, ["v"]).transform(df).agg(F.sum("v")).first()[0] == 3.0


def test_null_keys_do_not_join(spark):
    left = spark.createDataFrame([(1, None), (2, "a")], "tconst int, originalTitle string")
    right = spark.createDataFrame([(None, 5), ("A ", 7)], "original_title string, budget int")
    out = joins.merge_metadata(left, right)
    assert rows(out.select("tconst", "budget"), "tconst") == [(1, None), (2, 7)]


def test_mismatch_counts_null_as_different(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "a"), (None, None)], "p string, o string")
    assert cleaning.where_mismatch(df, "p", "o").count() == 3


def test_percent_rounds_half_even(spark):
    df = spark.range(1000).select(F.when(F.col("id") >= 1, 1).alias("v"))
    assert profile.null_profile(df).first()["percent"] == 0.1
    assert one(spark, F.bround(F.col("v").cast("double"), 2), "0.125", "0.375") == [0.12, 0.38]


def test_season_bins_are_right_closed(spark):
    days = (1, 90, 91, 180, 181, 270, 271, 366, None)
    expected = ["winter", "winter", "spring", "spring", "summer", "summer", "autumn", "autumn", None]
    assert one(spark, fc.season("v"), *days, schema="v int") == expected


def test_release_year_limits(spark):
    df = spark.createDataFrame(
        [(1, 1889, None), (2, 1890, None), (3, 2024, None), (4, 2025, None), (5, None, 1950), (6, None, None)],
        "tconst int, startYear int, endYear int",
    )
    out = cleaning.unify_release_year(df, 2024)
    assert out.columns == ["tconst", "releaseYear"]
    assert rows(out, "tconst") == [(1, 2024), (2, 1890), (3, 2024), (4, 2024), (5, 1950), (6, None)]


def test_release_year_from_bad_dates(spark):
    df = spark.createDataFrame([("1999-05-01",), ("not a date",), (None,)], "release_date string")
    assert [r[0] for r in cleaning.unify_release_year(df, 2024).collect()] == [1999, None, None]


def test_first_per_key_has_a_stated_order(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "z"), ("b", 1, None)], "k string, o int, v string")
    assert rows(cleaning.first_per_key(df, ["k"], ["o"]), "k") == [("a", 1, "z"), ("b", 1, None)]
    assert cleaning.first_per_key(df, ["k"], [-F.col("o")]).where("k = 'a'").first()["v"] == "y"


def test_first_per_key_keeps_vectors(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(1, 2, Vectors.dense([1.0])), (1, 1, Vectors.dense([2.0]))], ["k", "o", "vec"])
    assert cleaning.first_per_key(df, ["k"], ["o"]).first()["vec"] == Vectors.dense([2.0])


def test_top_people_ties_use_the_id(spark):
    facts = spark.createDataFrame([(i, 10) for i in range(12)], "tconst int, numVotes int")
    links = spark.createDataFrame([(i, 11 - i) for i in range(12)], "tconst int, director int")
    top = credits.top_people_by_mean(links, facts, "tconst", "director", "numVotes", "m")
    assert [r["director"] for r in top.collect()] == list(range(10))


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, c double")
    values = np.array([1.0, 2.0, 3.0, 0.0])
    expected = sorted((values - values.mean()) / values.std())
    scaled = model.fit_column_scaler(df, ["a", "c"]).transform(df).collect()
    assert sorted(r["a"] for r in scaled) == pytest.approx(expected)
    assert [r["c"] for r in scaled] == [0.0] * 4
    vectors = model.assemble(df, ["a", "c"], "raw")
    parts = model.fit_vector_scaler(vectors, "raw", "s").transform(vectors).collect()
    assert sorted(r["s"][0] for r in parts) == pytest.approx(expected)


def test_pca_centres_and_lowers_k(spark):
    data = np.random.default_rng(1).normal(5, 2, (50, 3))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(data)], "id int, emb_0 double, emb_1 double, emb_2 double")
    out = model.apply_pca_columns(df, "emb_", 10)
    assert out.columns == ["id", "emb_pca_0", "emb_pca_1", "emb_pca_2"]
    got = np.array(sorted(tuple(r) for r in out.collect()))[:, 1:]
    centred = data - data.mean(axis=0)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(centred @ axes.T), atol=1e-8)
    assert model.apply_pca_columns(df, "none_", 2) is df


def test_smoothed_idf_and_unit_rows(spark):
    df = spark.createDataFrame([(1, "red apple apple"), (2, "red car"), (3, None)], "id int, text string")
    got = {(r["id"], r["term"]): r["tfidf"] for r in tf.tfidf_long(df, "id", "text").collect()}
    red, apple = np.log(4 / 3) + 1, np.log(4 / 2) + 1
    norm = np.hypot(red, 2 * apple)
    assert got[1, "red"] == pytest.approx(red / norm) and got[1, "apple"] == pytest.approx(2 * apple / norm)
    fitted = tf.fit_tfidf_vectors(df, "text")
    vec = fitted.transform(df).where("id = 1").first()["tfidf_vec"]
    place = {r.term: r.position for r in fitted.terms.collect()}
    assert sorted(place.values()) == [0, 1, 2] and vec[place["apple"]] == pytest.approx(2 * apple / norm)
    assert fitted.transform(df).where("id = 3").first()["tfidf_vec"].numNonzeros() == 0
    quoted = spark.createDataFrame([(1, "I'll say don't go")], "id int, text string")
    found = tf.fit_tfidf_vectors(quoted, "text", stop_words=["don't", "i'll", "i"])
    assert {r.term for r in found.terms.collect()} == {"say", "go"}


def test_null_text_stays_null(spark):
    assert one(spark, ft.embedding_clean("v"), None, " É\x00 ") == [None, "e"]
    assert one(spark, ft.embedding_clean("v", null_as_empty=True), None) == [""]
    assert one(spark, ft.fingerprint("v"), None, "b  A, b!") == [None, "a b"]
    assert one(spark, ft.fingerprint("v", sort=False), "b  A, b!") == ["b a b"]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=20))
def test_fold_equals_compatibility_decomposition(spark, texts):
    expected = [unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in texts]
    assert one(spark, ft.ascii_fold("v"), *texts) == expected


def test_missing_tokens(spark):
    cells = ["\\N", "\\n", " NaN ", "None", "NULL", "na", "-", "?", "", " \t", "nana", "a-b"]
    assert one(spark, ft.null_if_missing_token("v"), *cells) == [None] * 10 + ["nana", "a-b"]
    assert one(spark, ft.null_if_missing_token("v", ["x.y"]), "", " X.Y ", "xzy") == ["", None, "xzy"]
    got = one(spark, ft.null_if_missing_pattern("v"), *cells)
    assert got == [None, None, " NaN ", None, None, None, None, None, None, None, "nana", "a-b"]


def test_year_suffix_only_at_the_end(spark):
    assert one(spark, ft.strip_year_suffix("v"), "A (1999) B", "A (1999)", "A(1999)", "A (19999)") == [
        "A (1999) B", "A", "A(1999)", "A (19999)",
    ]


def test_split_attached_words(spark):
    assert one(spark, ft.split_camel("v"), "lostRedCar", "nocapital", None, "ABC") == ["Red Car", "", None, "A B C"]


def test_title_length_counts_code_points(spark):
    df = spark.createDataFrame([("a b",), ("😀 é",), (None,)], "primaryTitle string")
    assert [r[1] for r in tf.add_title_length(df).collect()] == [2, 2, 0]
    assert tf.add_title_length(df.withColumnRenamed("primaryTitle", "x")).columns == ["x"]


def test_title_flags_are_case_sensitive(spark):
    df = spark.createDataFrame([("part two",), ("Part",), (None,)], "primaryTitle string")
    assert [r["title_contains_part"] for r in tf.add_title_patterns(df).collect()] == [1, 0, 0]


def test_parse_categories_row_by_row(spark):
    cells = ["Drama|Action", "['Drama', 'Action']", "[{'id': 1, 'name': 'Drama'}]", None, "[]"]
    assert one(spark, ft.parse_categories("v"), *cells) == [["drama", "action"], ["drama", "action"], ["drama"], [], []]


def test_combined_text_choices(spark):
    df = spark.createDataFrame([("a", None)], "overview string, tagline string")
    assert df.select(tf.combined_text(df)).first()[0] == "a "
    only = df.drop("overview").withColumn("tagline", F.lit("t"))
    assert only.select(tf.combined_text(only)).first()[0] == "t"
    assert tf.combined_text(df.select(F.lit(1).alias("x"))) is None


def test_sentiment_of_unknown_words_is_neutral(spark):
    df = spark.createDataFrame([(1, "Good good bad"), (2, "zzz"), (3, None)], "id int, text string")
    lex = spark.createDataFrame([("good", 0.6, 0.2), ("bad", -0.6, 0.8)], "word string, polarity double, subjectivity double")
    got = {r["id"]: (round(r[1], 6), round(r[2], 6)) for r in tf.lexicon_sentiment(df, "id", "text", lex).collect()}
    assert got == {1: (0.2, 0.4), 2: (0.0, 0.0), 3: (0.0, 0.0)}


def test_repeated_category_counts_twice(spark):
    df = spark.createDataFrame(
        [(1, ["a", "a", "b"], 10), (2, ["a"], 30), (3, [], 5), (4, None, 5)], "k int, g array<string>, v int"
    )
    weights = categories.fit_popularity(df, "g", "v")
    assert {r[0]: r[1] for r in weights.collect()} == {"a": 20.0, "b": 10.0}
    out = categories.weighted_categories(df, "k", "g", weights)
    assert rows(out, "k", "category") == [(1, "a", 40.0), (1, "b", 10.0), (2, "a", 20.0)]
    assert rows(categories.interactions(df, "k", "g", weights)) == [(1, "a", "b", 400.0)]
    held = categories.fit_category_vectors(df, "g", weights).transform(df, "vec")
    vectors = {r["k"]: sorted(x for x in r["vec"].toArray() if x) for r in held.collect()}
    assert vectors == {1: [10.0, 40.0, 400.0], 2: [20.0], 3: [], 4: []}
    hot = categories.multi_hot(out, df, "k", ["a", "b"])
    assert rows(hot, "k") == [(1, 40.0, 10.0), (2, 20.0, 0.0), (3, 0.0, 0.0), (4, 0.0, 0.0)]
    assert {r[1] for r in categories.popularity(df, "g").collect()} == {1.0}


def test_unknown_category_counts_with_one(spark):
    df = spark.createDataFrame([(1, ["new", "a"])], "k int, g array<string>")
    weights = spark.createDataFrame([("a", 3.0)], "category string, popularity double")
    assert rows(categories.weighted_categories(df, "k", "g", weights), "category") == [(1, "a", 3.0), (1, "new", 1.0)]
    assert rows(categories.interactions(df, "k", "g", weights)) == [(1, "a", "new", 3.0)]


def test_year_counts_leave_missing_years(spark):
    df = spark.createDataFrame([(1, 2000), (2, 2000), (3, None)], "k int, releaseYear int")
    out = temporal.add_temporal_features(df, 2024)
    got = {r["k"]: (r["movie_age"], r["day_of_year"], r["season_winter"], r["movies_in_year"]) for r in out.collect()}
    assert got == {1: (24, 1, 1, 2), 2: (24, 1, 1, 2), 3: (None, None, 0, None)}


def test_season_of_a_real_date(spark):
    df = spark.createDataFrame([(datetime.date(2000, 7, 1),)], "d date")
    assert temporal.add_season(df, "d").first()["season"] == "summer"


def test_external_encoder_gets_whole_texts(spark):
    df = spark.createDataFrame([(1, "a bee"), (2, None), (3, "")], "id int, text string")
    load = lambda: lambda texts: [(len(x), x.count(" "), x.count("e")) for x in texts]
    out = tf.encode_text(df, "text", "v", load)
    assert {r["id"]: r["v"] for r in out.collect()} == {1: [5.0, 1.0, 2.0], 2: [0.0] * 3, 3: [0.0] * 3}
