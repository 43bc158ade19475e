"""Folds, training, tuning and scoring."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from featloom.operators import boosting, model, network, search, vectors


@pytest.fixture(scope="module")
def rows(spark):
    k = F.col("id")
    return spark.range(600).select(
        k.alias("tconst"), (k % 7).cast("double").alias("a"), F.when(k % 5 != 0, (k * 37 % 101).cast("double")).alias("b"),
        ((k * 37 % 101) > 40).alias("label"), F.lit("x").alias("title"), F.lit(3).alias("id"),
    )


def test_features_are_numeric_and_not_excluded(rows):
    assert model.select_features(rows) == ["a", "b"]


def test_folds_differ_by_one_row(rows):
    for slices in (1, 40):
        out = model.stratified_folds(rows, "tconst", "label", slices=slices).collect()
        sizes = Counter((r["label"], r["fold"]) for r in out)
        for label in (True, False):
            per = [sizes[label, f] for f in range(5)]
            assert max(per) - min(per) <= 1 and min(per) > 0
    plain = {r["tconst"]: r["fold"] for r in model.stratified_folds(rows, "tconst", "label").collect()}
    assert plain == {r["tconst"]: r["fold"] for r in out}


def test_label_is_required_and_cleaned(spark):
    df = spark.createDataFrame([(1, 1), (2, None), (3, 0)], "tconst int, label int")
    assert sorted((r["tconst"], r["label"]) for r in model.clean_label(df).collect()) == [(1, True), (3, False)]
    with pytest.raises(ValueError):
        model.clean_label(df, "absent")


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(0.5,), (0.51,)], "p double")
    assert [r[0] for r in df.select(model.threshold(F.col("p"))).collect()] == [False, True]


def test_training_and_scoring(rows):
    fitted = model.train(rows, ["a", "b"], model.random_forest(n_trees=10, depth=5))
    twice = rows.unionByName(rows.withColumn("a", F.lit(0.0)))
    scored = fitted.score(twice, "tconst", "label", order=["a"])
    assert scored.count() == 600
    assert model.accuracy(scored, "label", "prediction").first()[0] > 0.8
    without = fitted.score(rows.drop("a", "label"), "tconst")
    assert without.columns == ["tconst", "probability", "prediction"] and without.count() == 600
    unkeyed = fitted.score(rows.drop("tconst"), "tconst")
    assert unkeyed.count() == 600


@pytest.mark.parametrize("kind", ["gbt", "mlp", "xgb"])
def test_other_classifiers(rows, kind):
    classifier = {
        "gbt": lambda: model.boosted_trees(n_trees=5, depth=3, subsample=0.9, columns=0.8),
        "mlp": lambda: model.NeuralNetwork(2, (8,), rate=0.05, max_iter=30),
        "xgb": lambda: model.SecondOrderBooster(n_trees=12, depth=2, subsample=0.9, columns=0.9, reg_alpha=0.1),
    }[kind]()
    scored = model.train(rows, ["a", "b"], classifier).score(rows, "tconst", "label")
    majority = 0.59
    assert model.accuracy(scored, "label", "prediction").first()[0] >= majority


def test_tuning_refits_the_best(rows):
    found = model.tune(rows, ["a", "b"], "rf", trials=3, folds=2, ranges={"n_trees": (3, 6), "depth": (2, 5)})
    assert len(found.scores) == 3 and max(found.scores) > 0.7
    assert found.best["n_trees"] == found.model.classifier.getNumTrees
    scored = found.model.score(rows, "tconst", "label")
    assert scored.count() == 600
    with pytest.raises(ValueError):
        model.tune(rows, ["a", "b"], "svm")


def test_every_declared_range_makes_a_classifier():
    for kind, ranges in (("rf", model.FOREST_RANGES), ("xgb", model.SECOND_ORDER_RANGES), ("gb", model.BOOST_RANGES), ("nn", model.NETWORK_RANGES)):
        params = search.draw(search.space_of(ranges), random.Random(1))
        assert model.classifier_of(kind, 4, params) is not None and set(params) == set(ranges)
    assert model.random_forest(min_leaf=2, min_split=9).getMinInstancesPerNode() == 5


# Search


def test_draws_stay_in_their_ranges():
    space = search.space_of({"n": (2, 5), "x": (0.5, 1.0), "s": (1e-5, 1e-2, "log"), "kind": ("a", "b", "c"), "layout": ((64,), (64, 32))})
    drawn = [search.draw(space, random.Random(k)) for k in range(400)]
    assert {d["n"] for d in drawn} == {2, 3, 4, 5} and all(0.5 <= d["x"] <= 1 and 1e-5 <= d["s"] <= 1e-2 for d in drawn)
    assert {d["kind"] for d in drawn} == {"a", "b", "c"} and {d["layout"] for d in drawn} == {(64,), (64, 32)}
    assert 0.35 < sum(d["s"] < 10**-3.5 for d in drawn) / 400 < 0.65


def test_search_is_seeded_and_beats_random_draws():
    space = search.space_of({"x": (0.0, 1.0), "y": (0, 100), "s": (1e-4, 1.0, "log"), "kind": ("a", "b", "c", "d")})

    def surface(p):
        return -((p["x"] - 0.3) ** 2) - ((p["y"] - 70) / 100) ** 2 - ((math.log10(p["s"]) + 3) / 4) ** 2 - (p["kind"] != "c") * 0.3

    found = [search.search(space, surface, 30, seed) for seed in range(40)]
    assert found[3] == search.search(space, surface, 30, 3)
    best = [max(s for _, s in f) for f in found]
    rng = random.Random(5)
    blind = [max(surface(search.draw(space, rng)) for _ in range(30)) for _ in range(40)]
    assert sum(best) > 0.7 * sum(blind)  # both are below 0
    assert sum(b > r for b, r in zip(best, blind)) >= 26


# Second-order trees


def plain_tree(x, y, b):
    """The first tree by plain loops."""
    edges = []
    for f in range(x.shape[1]):
        v = np.sort(x[x[:, f] != 0, f])
        grid = [v[math.ceil(k / b.bins * len(v)) - 1] for k in range(1, b.bins)] if len(v) else []
        edges.append(sorted({0.0, *grid}) if len(v) else [])
    shrunk = lambda g: math.copysign(max(abs(g) - b.reg_alpha, 0.0), g)
    score = lambda g, h: shrunk(g) ** 2 / (h + b.reg_lambda)
    splits, weights, queue = {}, {}, [(1, np.arange(len(y)))]
    while queue:
        node, rows = queue.pop()
        g, h = 0.5 - y[rows], np.full(len(rows), 0.25)
        options = []
        for f, cuts in enumerate(edges):
            for e in cuts:
                left = x[rows, f] <= e
                gl, hl = g[left].sum(), h[left].sum()
                if hl >= b.min_weight and h.sum() - hl >= b.min_weight:
                    options.append(((score(gl, hl) + score(g.sum() - gl, h.sum() - hl) - score(g.sum(), h.sum())) / 2, -f, -e))
        best = max(options, default=(0, 0, 0))
        if best[0] > 1e-12 and node < 2 ** b.depth:
            f, e = -best[1], -best[2]
            splits[node] = (f, e, best[0])
            queue += [(2 * node, rows[x[rows, f] <= e]), (2 * node + 1, rows[x[rows, f] > e])]
        else:
            weights[node] = -b.step * shrunk(g.sum()) / (h.sum() + b.reg_lambda)
    return splits, weights


@pytest.mark.parametrize("sparse", [False, True])
def test_first_tree_equals_plain_sums(spark, sparse):
    rng = np.random.default_rng(3)
    x = np.round(rng.standard_normal((300, 4)), 1)
    x[rng.random(x.shape) < 0.6] = 0
    x[:, 3] = 0
    y = ((x[:, 0] + x[:, 1] ** 2 + rng.standard_normal(300) * 0.3) > 0.3).astype(float)
    made = [Vectors.sparse(4, {int(j): float(row[j]) for j in np.nonzero(row)[0]}) if sparse or i % 2 else Vectors.dense(row) for i, row in enumerate(x)]
    df = spark.createDataFrame([(v, float(t)) for v, t in zip(made, y)], ["features", "_y"]).repartition(3)
    b = boosting.SecondOrderBooster(n_trees=1, depth=4, reg_alpha=0.7, reg_lambda=0.5, bins=8, min_weight=2.0)
    [tree] = b.fit(df).trees
    splits, weights = plain_tree(x, y, b)
    got = {s.node: (s.feature, s.threshold, s.gain) for s in tree.splits}
    assert set(got) == set(splits) and all(got[n] == pytest.approx(splits[n]) for n in got) and len(got) > 3
    assert dict(tree.weights) == pytest.approx(weights)
    model_ = boosting.SecondOrderTrees((tree,))
    p = {tuple(r.features.toArray()): r.probability[1] for r in model_.transform(df).collect()}
    node = lambda v: next(n for n in iter_nodes(v, splits))
    assert all(p[tuple(row)] == pytest.approx(1 / (1 + math.exp(-weights[node(row)]))) for row in x)


def iter_nodes(v, splits):
    node = 1
    while node in splits:
        node = 2 * node + (v[splits[node][0]] > splits[node][1])
    yield node


def test_margins_go_on_over_many_trees(spark, monkeypatch):
    """The same trees whether margins are written after every second tree or not at all."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((200, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    df = spark.createDataFrame([(Vectors.dense(v), float(t)) for v, t in zip(x, y)], ["features", "_y"])
    b = boosting.SecondOrderBooster(n_trees=5, depth=3, step=0.5, bins=16)
    whole = b.fit(df)
    monkeypatch.setattr(boosting, "KEEP", 2)
    again = b.fit(df)
    assert [[(s.node, s.feature, s.bin) for s in t.splits] for t in whole.trees] == [[(s.node, s.feature, s.bin) for s in t.splits] for t in again.trees]
    right = whole.transform(df).where("(prediction = 1) = (_y = 1)").count()
    assert right > 180
    assert boosting.SecondOrderBooster(n_trees=2).fit(df.where("false")).transform(df).select("probability").first()[0][1] == 0.5


# Network


@pytest.mark.parametrize("activation", ["relu", "tanh", "logistic"])
@pytest.mark.parametrize("hidden", [(5,), (6, 4)])
def test_gradient_against_finite_differences(activation, hidden):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((20, 4)) * (rng.random((20, 4)) > 0.4)
    y = (rng.random(20) > 0.5).astype(float)
    starts = np.concatenate(([0], np.cumsum((x != 0).sum(1))))
    rows = vectors.Rows(starts, np.nonzero(x)[1], x[np.nonzero(x)])
    sizes = (4, *hidden, 1)
    numbers = network.start(sizes, activation, 1)
    total, found = network.gradient(rows, y, network.shaped(numbers, sizes), activation)
    at = lambda n: network.loss(network.forward(rows, network.shaped(n, sizes), activation)[-1][:, 0], y)
    assert total == pytest.approx(at(numbers))
    for k, slope in enumerate(network.flat(found)):
        step = np.zeros_like(numbers)
        step[k] = 1e-6
        assert slope == pytest.approx((at(numbers + step) - at(numbers - step)) / 2e-6, abs=1e-5)


@pytest.mark.parametrize("hidden, activation", [((64,), "relu"), ((128,), "tanh"), ((64, 32), "logistic"), ((128, 64), "relu")])
def test_network_learns_and_stops_early(spark, hidden, activation):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((400, 3))
    y = (x[:, 0] + x[:, 1] > 0).astype(float)
    df = spark.createDataFrame([(Vectors.dense(v), float(t)) for v, t in zip(x, y)], ["features", "_y"])
    found = network.NeuralNetwork(3, hidden, activation=activation, rate=0.02, max_iter=60, batches=2, patience=4).fit(df)
    assert 0 < found.rounds <= 60 and len(found.scores) >= found.rounds
    scored = found.transform(df)
    assert scored.where("(prediction = 1) = (_y = 1)").count() > 360
    assert all(0 <= r.probability[1] <= 1 for r in scored.collect())


def test_network_of_nothing(spark):
    df = spark.createDataFrame([(Vectors.dense([1.0]), 1.0)], ["features", "_y"])
    found = network.NeuralNetwork(1, (2,), max_iter=2).fit(df.where("false"))
    assert found.scores == () and found.transform(df).count() == 1
    with pytest.raises(ValueError):
        network.NeuralNetwork(1, (2,), activation="none").fit(df)
