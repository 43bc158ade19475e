"""Link-table operators against the joined form on small, skewed fixtures."""

import itertools
import random
from collections import Counter

import pytest

from featloom.operators import cleaning, credits, joins
from featloom.functions import text as ft


@pytest.fixture(scope="module")
def links(spark):
    rng = random.Random(3)
    titles = [1] * 60 + list(range(2, 30)) * 3  # title 1 holds a good part of all links
    d = [(rng.choice(titles), rng.choice([None, *range(12)])) for _ in range(120)]
    w = [(rng.choice(titles), rng.choice([None, *range(12)])) for _ in range(110)] + [(99, 1)]
    return d, w, spark.createDataFrame(d, "tconst int, director int"), spark.createDataFrame(w, "tconst int, writer int")


def test_shared_person_flag(links):
    d, w, dd, wd = links
    joined = [(a, x == y and x is not None) for (a, x), (b, y) in itertools.product(d, w) if a == b]
    expected = {a: int(any(f for k, f in joined if k == a)) for a, _ in joined}
    got = {r[0]: r[1] for r in credits.any_shared_person(dd, wd, "tconst", "director", "writer").collect()}
    assert got == expected


def test_same_person_rows(links):
    d, w, dd, wd = links
    expected = Counter((a, x) for (a, x), (b, y) in itertools.product(d, w) if a == b and x == y and x is not None)
    got = {(r[0], r[1]): r[2] for r in credits.same_person_credits(dd, wd, "tconst", "director", "writer").collect()}
    assert got == dict(expected)


def test_fanout_without_the_join(spark, links):
    d, w, dd, wd = links
    facts = [(k,) for k in [*range(1, 32), 5]]
    rows = []
    for (k,) in facts:
        left = [x for a, x in d if a == k]
        right = [y for b, y in w if b == k] if left else []
        rows += [(k, x, y) for x in (left or [None]) for y in (right or [None])]
    df = spark.createDataFrame(facts, "tconst int")
    got = {r["tconst"]: r["n_rows"] for r in credits.fanout_counts(df, dd, wd, "tconst").collect()}
    assert got == dict(Counter(k for k, _, _ in rows))
    people = {(r["role"], r["person"]): r["n"] for r in credits.fanout_people(dd, wd, "tconst", "director", "writer", df).collect()}
    expected = Counter(("director", x) for _, x, _ in rows if x is not None) + Counter(("writer", y) for _, _, y in rows if y is not None)
    assert people == dict(expected)


def test_credit_features_keep_all_facts(spark, links):
    d, w, dd, wd = links
    facts = spark.createDataFrame([(k, k * 10) for k in range(1, 40)], "tconst int, numVotes int")
    out = {r["tconst"]: r for r in credits.credit_features(facts, dd, wd, k=3).collect()}
    assert len(out) == 39
    for k, r in out.items():
        assert r["director_count"] == len({x for a, x in d if a == k and x is not None})
        assert r["writer_count"] == len({y for b, y in w if b == k and y is not None})
    top = credits.top_people_by_mean(dd, facts, "tconst", "director", "numVotes", "m", 3)
    flagged = {r["tconst"] for r in credits.top_k_flags(dd, top, "tconst", "director", "f").collect()}
    assert flagged & set(out) == {k for k, r in out.items() if r["is_top_10_director"]}


def test_expertise_sums_to_one(spark, links):
    _, _, dd, _ = links
    titles = spark.createDataFrame([(k, ["a", "b"] if k % 2 else ["c"]) for k in range(1, 40)], "tconst int, genres array<string>")
    shares = credits.category_expertise(dd, titles, "tconst", "director", "genres")
    total = {r[0]: r[1] for r in shares.groupBy("director").sum("genre_expertise").collect()}
    assert total and all(abs(v - 1) < 1e-12 for v in total.values())
    matrix = credits.expertise_matrix(shares, "director", ["a", "b", "c"])
    facts = spark.createDataFrame([(1, 3, 0.5), (2, 777, 0.5)], "tconst int, director int, a double")
    joined = {r["tconst"]: r for r in credits.join_expertise(facts, matrix, "director", "_x").collect()}
    assert joined[2]["a_x"] == 0.0 and joined[2]["a"] == 0.5 and joined[1]["a_x"] > 0


def test_person_stats_with_and_without_rating(spark):
    df = spark.createDataFrame([(1, 7, 2.0), (1, 7, 4.0), (2, 7, 6.0), (3, None, 1.0)], "tconst int, director int, averageRating double")
    out = credits.person_stats(df, "tconst", "director", "averageRating").collect()
    assert [tuple(r) for r in out] == [(7, 2, 4.0)]
    assert credits.person_stats(df, "tconst", "director").columns == ["director", "dir_movie_count"]


def test_title_join_multiplies_unless_deduplicated(spark):
    facts = spark.createDataFrame([(1, "Red "), (2, None)], "tconst int, originalTitle string")
    catalogue = spark.createDataFrame([("red (1999)", "x"), ("Red (2001)", "w")], "title string, genres string")
    many = joins.join_by_title(facts, catalogue, "originalTitle", "title", ["genres"])
    assert sorted(r["genres"] for r in many.where("tconst = 1").collect()) == ["w", "x"]
    single = joins.join_by_title(facts, catalogue, "originalTitle", "title", ["genres"], dedupe_right=True, order=["genres"])
    assert {r["tconst"]: r["genres"] for r in single.collect()} == {1: "w", 2: None}


def test_metadata_coalesce_prefers_own_value(spark):
    facts = spark.createDataFrame([(1, "a", None), (2, "a", 5)], "tconst int, originalTitle string, runtime int")
    meta = spark.createDataFrame([("A", 9, "t")], "original_title string, runtime int, tagline string")
    out = joins.merge_metadata(facts, meta)
    assert {r["tconst"]: (r["runtime"], r["tagline"]) for r in out.collect()} == {1: (9, "t"), 2: (5, "t")}
    assert joins.merge_metadata(facts, None) is facts


def test_repeated_and_duplicate_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3), (None, 4)], "k string, v int")
    assert sorted(r["v"] for r in cleaning.repeated_keys(df, ["k"]).collect()) == [1, 1, 3, 4]
    assert cleaning.duplicate_count(df).first()[0] == 1
    assert cleaning.duplicate_count(df, ["k"]).first()[0] == 2
    assert cleaning.drop_duplicate_rows(df).count() == 4


def test_parse_then_explode(spark):
    from featloom.operators.categories import explode_list

    df = spark.createDataFrame([(1, "a|b"), (2, None)], "k int, g string").withColumn("g", ft.parse_categories("g"))
    assert [tuple(r) for r in explode_list(df, "g", "c", position=True).orderBy("position").collect()] == [(1, 0, "a"), (1, 1, "b")]
