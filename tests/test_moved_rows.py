"""Rows stay where they are: frequent words, terms of a text."""

from pyspark.sql import functions as F

from featloom.operators import categories, credits, joins, sparse
from featloom.operators import text_features as op


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_terms_of_a_text_are_counted_in_its_row(spark):
    once = spark.createDataFrame([(1, "red blue red"), (2, "blue"), (3, None), (4, "x")], "id long, text string")
    counts = op.term_counts(once, "id", "text")
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString() and "Aggregate" not in plan(counts)
    assert sorted(map(tuple, counts.collect())) == [(1, "blue", 1), (1, "red", 2), (2, "blue", 1)]
    again = once.unionByName(spark.createDataFrame([(1, "red"), (None, "blue"), (None, "blue green")], once.schema))
    want = [(1, "blue", 1), (1, "red", 3), (2, "blue", 1), (None, "blue", 2), (None, "green", 1)]
    assert sorted(map(tuple, op.term_counts(again, "id", "text").collect()), key=str) == sorted(want, key=str)


def test_only_rare_values_are_moved(spark, monkeypatch):
    monkeypatch.setattr(sparse, "HOT", 2)
    known = sparse.mark_hot(spark.createDataFrame([("a", 9, 1.0), ("b", 8, 2.0), ("c", 1, 3.0), ("d", 1, 4.0)], "w string, n long, x double"), "n")
    assert {r.w for r in known.where("hot").collect()} == {"a", "b"}
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "e"), (5, None), (6, "a")], "id long, w string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = sparse.join_known(rows, known.drop("n"), "w", "id")
        assert plan(met).count("SortMergeJoin") == 1 and "BroadcastHashJoin" in plan(met) and "Union" in plan(met)
        assert sorted(map(tuple, met.collect())) == [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (6, "a", 1.0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


LEXICON = [("good", 0.5, 0.4, None, 9), ("bad", -0.7, 0.6, None, 8), ("very", 0.1, 0.2, 1.5, 7), ("odd", 0.2, 0.1, None, 1), ("so", 0.3, 0.3, 1.3, 1), ("not", -0.1, 0.1, None, 1)]
TEXTS = [(1, "not very good, so odd. bad bad"), (2, "so good; never odd"), (3, None), (4, ""), (5, "odd"), (6, "no good"), (6, "so very bad"), (None, "good")]


def test_sentiments_do_not_depend_on_where_words_are_met(spark, monkeypatch):
    lexicon = spark.createDataFrame(LEXICON, "word string, polarity double, subjectivity double, intensity double, uses long")
    texts = spark.createDataFrame(TEXTS, "id long, text string")
    both = lambda words: [op.lexicon_sentiment(texts, "id", "text", words), op.modified_sentiment(texts, "id", "text", words)]
    shown = lambda dfs: [sorted([(r.id, round(r[1], 9), round(r[2], 9)) for r in df.collect()], key=str) for df in dfs]
    want = shown(both(lexicon))
    assert want[0][0] == (1, round((-0.1 + 0.1 + 0.5 + 0.3 + 0.2 - 1.4) / 7, 9), round((0.1 + 0.2 + 0.4 + 0.3 + 0.1 + 1.2) / 7, 9))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(sparse, "HOT", 3)
    try:
        split = both(lexicon)
        assert all("BroadcastHashJoin" in plan(df) for df in split)
        assert shown(split) == want
        assert shown(both(lexicon.drop("uses"))) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_numbers_of_a_person_are_moved_by_slice_of_the_titles(spark, monkeypatch):
    """Repeated links, null keys and persons, persons without credits, a missing category; several rows of numbers a person."""
    links = [(k, p) for k in range(12) for p in range(k % 5 + 1)] * 2 + [(None, 1), (3, None), (77, 99), (77, 2)]
    titles = [(k, [f"c{k % 7}", f"c{k % 3}", None if k % 4 == 0 else "c0"]) for k in range(12)]
    held = {p: [c for k, q in links if q == p for t, cs in titles if t == k for c in cs] for p in range(5)}
    want = {}
    for k in {k for k, _ in links if k is not None}:
        persons = [p for p in {p for t, p in links if t == k} if held.get(p)]
        for c in {c for p in persons for c in held[p]}:
            want[k, c] = round(sum(held[p].count(c) / len(held[p]) for p in persons) / len(persons), 9)
    df = spark.createDataFrame(links, "tconst long, director long")
    shares = credits.category_expertise(df, spark.createDataFrame(titles, "tconst long, genres array<string>"), "tconst", "director", "genres")
    for tile, blocks in ((16, 32), (2, 3), (1, 1)):
        monkeypatch.setattr(credits, "TILE", tile)
        monkeypatch.setattr(credits, "BLOCKS", blocks)
        long = credits.title_expertise(df, shares, "tconst", "director")
        found = [((r.tconst, r.category), round(r.expertise, 9)) for r in long.collect()]
        assert len(found) == len(want) and dict(found) == want
    text = long._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in text and "collect_set" in text  # titles meet a person's numbers as lists, one for each slice


def test_rows_stay_where_few_titles_or_lists_are_joined(spark):
    """What is joined is written first, so that its size is known; its sources have none."""
    facts = spark.createDataFrame([(1, " Red", ["b", "a"]), (2, "blue (1999)", ["a"]), (3, None, None), (4, "red", ["a", "b"])], "k long, originalTitle string, genres array<string>")
    known = spark.createDataFrame([("RED", "y"), ("red", "x"), ("Blue", "z")], "title string, tag string")
    titled = joins.join_by_title(facts, known, "originalTitle", "title", ["tag"], dedupe_right=True, order=["tag"])
    assert "BroadcastHashJoin" in plan(titled) and "SortMergeJoin" not in plan(titled)
    assert {r.k: r.tag for r in titled.collect()} == {1: "x", 2: "z", 3: None, 4: "x"}
    merged = joins.merge_metadata(facts, known.withColumnRenamed("title", "original_title"), dedupe_right=True)
    assert "BroadcastHashJoin" in plan(merged) and "SortMergeJoin" not in plan(merged)
    assert {r.k: r.tag for r in merged.collect()} == {1: "x", 2: None, 3: None, 4: "x"}
    vectors = categories.fit_category_vectors(facts, "genres", spark.createDataFrame([("a", 2.0), ("b", 3.0)], "category string, popularity double"))
    axis = sparse.Components(vectors.singles.select("position", F.lit(1.0).alias("z0")), (0.0,), (1.0,), 1.0)
    out = categories.CategoryComponents(vectors, "pca", axis).transform(facts)
    assert "BroadcastHashJoin" in plan(out) and "SortMergeJoin" not in plan(out)
    assert {r.k: list(r.pca) for r in out.collect()} == {1: [5.0], 2: [2.0], 3: [0.0], 4: [5.0]}
