"""End-to-end plans from files, and the shape of the physical plans."""

import csv
import json
import random
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from featloom import session
from featloom.operators import categories, cleaning, credits, model, profile, sparse, text_features
from featloom.plans import saved
from featloom.plans.feature_build import FeatureBuild, MovieInputs, movie_inputs
from featloom.plans.train_score import run, train
from featloom.queries import REGISTRY
from tests.oracle import plan_of
from featloom.sources import readers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    """A small data set in the layout of the original inputs."""
    base = tmp_path_factory.mktemp("inputs")
    rng = random.Random(1)
    nouns = ["car", "river", "return", "part", "night", "day"]
    titles = []
    for i in range(160):
        good = rng.random() < 0.5
        votes = rng.randint(500, 900) if good else rng.randint(10, 300)
        name = f"{rng.choice(nouns).title()} {rng.choice(nouns)}"
        titles.append({
            "": i, "tconst": f"tt{i}", "primaryTitle": name, "originalTitle": rng.choice(["\\N", name]),
            "startYear": rng.choice(["\\N", 1999, 2005]), "endYear": rng.choice(["\\N", 2001]),
            "runtimeMinutes": rng.choice(["\\N", 90, 120]), "numVotes": rng.choice([votes, votes, votes, ""]), "label": good,
        })

    def write(name, rows, drop=()):
        with open(base / name, "w", newline="") as out:
            fields = [f for f in rows[0] if f not in drop]
            writer = csv.DictWriter(out, fields, extrasaction="ignore")
            writer.writeheader()
            writer.writerows(rows)

    write("train-1.csv", titles[:60])
    write("train-2.csv", titles[60:120])
    write("validation_1.csv", titles[120:])
    write("validation_hidden.csv", titles[120:], drop=("label",))
    links = lambda p: [{"movie": f"tt{i}", p: f"nm{rng.randint(0, 9)}"} for i in range(160) for _ in range(2)]
    (base / "directing.json").write_text("\n".join(map(json.dumps, links("director"))))
    (base / "writing.json").write_text("\n".join(map(json.dumps, links("writer"))))
    # Some titles are missing from the catalogue; their categories come from the metadata.
    write("movies.csv", [
        {"title": f"{a.title()} {b} (1999)", "genres": f"{a}|{b}"} for a in nouns for b in nouns if b != "night"
    ])
    write("movies_metadata.csv", [
        {"original_title": f"{a.title()} {b}", "budget": 5, "overview": f"good {a}", "tagline": "bad" if b == "car" else "",
         "genres": "[{'id': 1, 'name': 'Drama'}]"}
        for a in nouns for b in nouns
    ])
    return base


def test_files_to_predictions(spark, files, tmp_path):
    lexicon = spark.createDataFrame([("good", 0.7, 0.6), ("bad", -0.7, 0.7)], "word string, polarity double, subjectivity double")
    plan = run(
        spark, f"{files}/train-*.csv",
        {"validation": f"{files}/validation_1.csv", "validation_hidden": f"{files}/validation_hidden.csv"},
        str(tmp_path), 2024, model_type="rf",
        links={k: f"{files}/{v}" for k, v in (
            ("directing_json", "directing.json"), ("writing_json", "writing.json"), ("movies_csv", "movies.csv"),
            ("metadata_csv", "movies_metadata.csv"))},
        lexicon=lexicon,
        build=FeatureBuild(2024, "combined", embedding_size=8, text_components=4, genre_components=4),
        trials=2, folds=2, ranges={"n_trees": (5, 10), "depth": (3, 6)},
    )
    assert max(plan.search.scores) > 0.55  # about half the labels are true
    names = plan.search.model.features
    for expected in (
        "numVotes", "releaseYear", "director_count", "is_top_10_writer", "budget", "text_sentiment_polarity", "title_length",
        "title_contains_part", "movie_age", "movies_in_year", "season_winter", "text_pca", "genre_pca",
        "dir_expertise_vec", "wri_expertise_vec",
    ):
        assert expected in names, expected
    assert {"drama", "car"} <= {r["category"] for r in plan.features.stages[-1].vectors.singles.collect()}
    for split in ("validation", "validation_hidden"):
        back = readers.read_csv(spark, f"{tmp_path}/{split}_predictions")
        assert back.columns == ["tconst", "prediction"] and back.count() == 40


@pytest.mark.parametrize("method", ["tfidf", "embedding", "combined"])
def test_splits_share_their_columns(spark, method):
    inputs = movie_inputs(*(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("part", "lineitem")))
    train = MovieInputs(inputs.titles.where("tconst < 150"), *(getattr(inputs, f) for f in ("directors", "writers", "catalogue", "metadata", "lexicon")))
    other = MovieInputs(inputs.titles.where("tconst >= 150").drop("label"), *(getattr(inputs, f) for f in ("directors", "writers", "catalogue", "metadata", "lexicon")))
    fitted, table = FeatureBuild(2024, method, embedding_size=8, text_components=4, genre_components=4).fit_transform(train)
    scored = fitted.transform(other)
    assert [c for c in table.columns if c != "label"] == scored.columns
    assert table.count() == 150 and scored.count() == 50


def test_missing_inputs_skip_their_steps(spark):
    inputs = movie_inputs(*(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("part", "lineitem")))
    _, table = FeatureBuild(2024, "embedding", embedding="hashing", embedding_size=16).fit_transform(MovieInputs(inputs.titles))
    assert table.count() == 200 and "director_count" not in table.columns and "emb_vec" in table.columns
    with pytest.raises(ValueError):
        FeatureBuild(2024, "other").fit(inputs)


# --- physical plans --------------------------------------------------------


@pytest.mark.parametrize("method, model_type, ranges", [
    ("combined", "nn", {"max_iter": (5, 5)}), ("combined", "xgb", {"n_trees": (2, 2), "depth": (2, 2)}), ("tfidf", "nn", {"max_iter": (3, 3)}),
])
def test_every_model_takes_every_family(spark, method, model_type, ranges):
    tables = {n: spark.read.parquet(f"{SF}/{n}.parquet") for n in ("part", "lineitem")}
    inputs = movie_inputs(tables["part"], tables["lineitem"])
    build = FeatureBuild(2024, method, embedding="hashing", embedding_size=8, text_components=4, final_components=3, genre_components=2)
    plan = train(inputs, build, model_type, trials=1, folds=2, ranges=ranges)
    assert plan.score(inputs).count() == inputs.titles.count()


def test_filters_and_columns_reach_the_scan(spark):
    numbers = spark.read.parquet(f"{SF}/orders.parquet")
    plan = plan_of(profile.remove_outliers(numbers, ["o_totalprice"]).select("o_orderkey"))
    assert "GreaterThanOrEqual(o_totalprice" in plan and "LessThanOrEqual(o_totalprice" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert "EqualTo(o_orderstatus,F)" in plan_of(cleaning.where_equal(numbers, "o_orderstatus", "F"))


def test_shared_person_flag_needs_no_join(spark):
    plan = plan_of(REGISTRY["any_dir_writer"].run(spark, SF))
    assert "Join" not in plan


def test_first_per_key_folds_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")
    plan = plan_of(cleaning.first_per_key(df, ["l_orderkey"], ["l_linenumber"]))
    assert "partial_min" in plan and "Window" not in plan


def test_fitted_tables_are_written(spark):
    df = spark.createDataFrame([(i, [f"g{i % 50}", "x"], i) for i in range(200)], "k int, g array<string>, v int")
    weights = categories.fit_popularity(df, "g", "v")
    assert "parquet" in plan_of(weights)
    assert categories.weighted_categories(df, "k", "g", weights).count() == 400


def test_any_number_of_categories(spark):
    """20,000 categories and as many pairs: each has a position of its own."""
    df = spark.range(20_000).selectExpr("id AS k", "array(concat('g', id), concat('g', (id * 7 + 1) % 20000)) AS genres", "id + 1 AS v")
    weights = categories.fit_popularity(df, "genres", "v")
    vectors = categories.fit_category_vectors(df, "genres", weights)
    assert vectors.size == 20_000 + vectors.pairs.count() and vectors.pairs.agg(F.min("position")).first()[0] == 20_000
    out = vectors.transform(df, "vec")
    assert out.count() == 20_000 and {r.vec.numNonzeros() for r in out.where("k <> 3333").limit(50).collect()} == {3}
    found = categories.fit_category_components(df, vectors, 3, "pca").transform(df)
    assert found.count() == 20_000 and len(found.first()["pca"]) == 3
    links = df.selectExpr("k AS tconst", "k % 100 AS director")
    shares = credits.category_expertise(links, df.selectExpr("k AS tconst", "genres"), "tconst", "director", "genres")
    long = credits.title_expertise(links, shares, "tconst", "director")
    assert abs(long.agg(F.sum("expertise")).first()[0] - 20_000) < 1e-6
    places = vectors.singles.select("category", "position", "hot")
    held = credits.expertise_vector(long.where("tconst < 50"), "tconst", "vec", places, 20_000)
    assert all(abs(sum(r.vec.toArray()) - 1) < 1e-9 for r in sparse.as_vectors(held, ["vec"]).collect())


def test_every_term_has_a_position(spark):
    df = spark.range(2000).selectExpr("id", "concat_ws(' ', transform(sequence(0, 600), i -> concat('t', id * 601 + i))) AS text")
    fitted = text_features.fit_tfidf_vectors(df, "text")
    row = fitted.transform(df).select("tfidf_vec").first()[0]
    assert row.size == fitted.size == 2000 * 601 and row.numNonzeros() == 601 and abs(row.norm(2) - 1) < 1e-9


def test_person_statistics_enter_the_build(spark):
    inputs = movie_inputs(*(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("part", "lineitem")))
    rated = inputs.directors.withColumn("averageRating", F.pmod("tconst", F.lit(10)).cast("double")).where("tconst % 5 <> 0")
    rated = rated.unionByName(inputs.directors.where("tconst % 5 = 1").withColumn("averageRating", F.lit(None).cast("double")))
    build = FeatureBuild(2024, "embedding", embedding="hashing", embedding_size=8, genre_components=2)
    fitted, table = build.fit_transform(replace(inputs, directors=rated, writers=None))
    rows = {r.tconst: r for r in table.select("tconst", "dir_movie_count", "dir_avg_rating").collect()}
    assert table.count() == 200 and all(r.dir_avg_rating is not None for r in rows.values())
    fill = fitted.ratings.values["dir_avg_rating"]
    assert all(rows[k].dir_movie_count is None and rows[k].dir_avg_rating == fill for k in (5, 10, 15))


def test_category_column_by_its_other_name(spark):
    inputs = movie_inputs(*(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("part", "lineitem")))
    titles = inputs.titles.withColumn("genre_names", F.lit("['Drama', 'War']"))
    _, table = FeatureBuild(2024, "embedding", embedding="hashing", embedding_size=8, genre_components=2, keep_wide=True).fit_transform(MovieInputs(titles))
    row = table.first()
    assert row.genre_vec.size == 3 and row.genre_vec.numNonzeros() == 3 and "genres" not in table.columns


def test_a_title_has_the_same_features_alone_and_among_others(spark):
    tables = {n: spark.read.parquet(f"{SF}/{n}.parquet") for n in ("part", "lineitem")}
    inputs = movie_inputs(tables["part"], tables["lineitem"])
    build = FeatureBuild(2024, "embedding", embedding="hashing", embedding_size=8, genre_components=2)
    fitted = build.fit(inputs)
    one = inputs.titles.where("tconst = 7")
    alone, among = (fitted.transform(replace(inputs, titles=t)).where("tconst = 7").drop("movies_in_year").first().asDict() for t in (one, inputs.titles))
    # Sums of shares may differ in their last place by the order of the rows.
    plain = lambda row: {k: [round(x, 9) for x in v.toArray()] if hasattr(v, "toArray") else round(v, 9) if isinstance(v, float) else v for k, v in row.items()}
    assert plain(alone) == plain(among) and alone["dir_expertise_vec"].size == fitted.expertise.size


@pytest.mark.parametrize("method", ["combined", "tfidf"])
def test_a_saved_plan_scores_alike_in_another_session(spark, tmp_path, method):
    tables = {n: spark.read.parquet(f"{SF}/{n}.parquet") for n in ("part", "lineitem")}
    inputs = movie_inputs(tables["part"], tables["lineitem"])
    build = FeatureBuild(2024, method, embedding_size=8, text_components=4, final_components=3, genre_components=2)
    plan = train(inputs, build, "rf", trials=1, folds=2, ranges={"n_trees": (3, 3), "depth": (3, 3)})
    saved.save(plan, f"{tmp_path}/plan")
    other = spark.newSession()
    again = saved.load(other, f"{tmp_path}/plan")
    fresh = movie_inputs(*(other.read.parquet(f"{SF}/{n}.parquet") for n in ("part", "lineitem")))
    scores = [sorted(map(tuple, p.score(i).collect())) for p, i in ((plan, inputs), (again, fresh))]
    assert scores[0] == scores[1] and again.search.scores == plan.search.scores and again.features.build == build


def test_owned_stages_are_deleted(spark):
    with session.owned_stages(spark):
        path = session.materialize(spark.range(3), "owned").inputFiles()[0]
    assert not Path(path.removeprefix("file://")).exists()


def test_credit_counts_survive_a_hot_title(spark):
    """One title with a third of all links: counts come from per-key sums, never from joined pairs."""
    d = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS tconst", "id % 700 AS director")
    w = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS tconst", "id % 900 AS writer")
    facts = spark.range(3000).withColumnRenamed("id", "tconst")
    hot = credits.fanout_counts(facts, d, w, "tconst").where("tconst = 0").first()
    assert hot["n_rows"] == 1000 * 1000
    assert "Generate" not in plan_of(credits.fanout_people(d, w, "tconst", "director", "writer"))


def test_folds_use_many_slices(spark):
    df = spark.range(1000).selectExpr("id AS tconst", "id % 2 = 0 AS label")
    assert "_slice" in plan_of(model.stratified_folds(df, "tconst", "label", slices=20))


# --- scratch space ---------------------------------------------------------


class FakeSession:
    """Only what ``shared_dir`` asks of a session."""

    def __init__(self, setting, master, checkpoint=None):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext = self
        self.master, self.checkpoint = master, checkpoint

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, path):
        self.checkpoint = path


def test_shared_folder_comes_from_the_session(spark, tmp_path):
    assert session.shared_dir(FakeSession("hdfs:///shared/", "yarn")) == "hdfs:///shared"
    assert "featloom-" in session.shared_dir(FakeSession(None, "local[8]"))
    with pytest.raises(RuntimeError):
        session.shared_dir(FakeSession(None, "yarn"))
    kept = session.materialize(spark.range(10), "t")
    assert kept.count() == 10 and session.shared_dir(spark).split(":")[-1] in kept.inputFiles()[0]


