"""Exact positions, sparse rows and components of wide families."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from featloom.operators import sparse


def test_dictionary_numbers_every_value_once(spark):
    words = spark.createDataFrame([(f"w{i}", i) for i in range(2000)], "term string, n long")
    a = sparse.dictionary(words.repartition(7), ["term"]).collect()
    b = sparse.dictionary(words.repartition(2), ["term"]).collect()
    assert sorted(r.position for r in a) == list(range(2000)) and {(r.term, r.n, r.position) for r in a} == {(r.term, r.n, r.position) for r in b}
    assert sparse.dictionary(words.where("false"), ["term"]).collect() == []


def test_hot_values_meet_like_all_others(spark):
    rows = [(i, "hot" if i % 3 else f"w{i % 50}") for i in range(3000)] + [(5000, "unknown"), (5001, None)]
    known = sparse.mark_hot(spark.createDataFrame([("hot", 2000, 1.0)] + [(f"w{i}", 20, float(i)) for i in range(50)], "term string, n long, x double"), "n")
    assert known.where("hot").count() > 0
    got = sparse.join_known(spark.createDataFrame(rows, "id long, term string"), known.drop("n"), "term", "id").collect()
    want = {(i, t, 1.0 if t == "hot" else float(t[1:])) for i, t in rows if i < 5000}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_packed_rows_become_vectors(spark):
    cells = spark.createDataFrame([(1, 5, 2.0), (1, 0, 1.0), (2, 3, -1.0)], "row long, position long, value double")
    held = sparse.packed(cells, "row", 7, "v")
    rows = spark.createDataFrame([(1,), (2,), (3,)], "row long").join(held, "row", "left").withColumn("v", F.coalesce("v", sparse.no_cells(7)))
    got = {r.row: r.v for r in sparse.as_vectors(rows, ["v"]).collect()}
    assert got[1].toArray().tolist() == [1, 0, 0, 0, 0, 2, 0] and got[2].indices.tolist() == [3] and got[3].numNonzeros() == 0 and got[3].size == 7


def cells_of(spark, a):
    rows = [(int(i), int(j), float(a[i, j])) for i, j in zip(*np.nonzero(a))]
    return spark.createDataFrame(rows, "row long, position long, value double").repartition(5)


@pytest.mark.parametrize("centre", [True, False])
def test_components_equal_the_decomposition(spark, centre):
    rng = np.random.default_rng(1)
    a = rng.standard_normal((60, 3)) @ rng.standard_normal((3, 25)) * 3 + rng.standard_normal((60, 25)) * 0.05
    a[rng.random(a.shape) < 0.5] = 0
    a[7] = 0
    found = sparse.fit_components(cells_of(spark, a), 60, 6, centre=centre, extra=25)
    mean = a.mean(0) if centre else np.zeros(25)
    u, s, vt = np.linalg.svd(a - mean, full_matrices=False)
    over = 59 if centre else 1
    assert found.variances == pytest.approx(tuple(s[:6] ** 2 / over), rel=1e-6) and found.total == pytest.approx((s**2).sum() / over)
    got = {r.row: r.components for r in found.project(cells_of(spark, a), "row").collect()}
    got[7] = spark.range(1).select(found.at_zero().alias("c")).first().c
    points = np.array([got[i] for i in range(60)])
    assert np.allclose(points @ points.T, (u[:, :6] * s[:6]) @ (u[:, :6] * s[:6]).T, atol=1e-5)


def test_components_of_small_rank_and_of_nothing(spark):
    a = np.outer([1.0, 2, 3, 0, 1], [1.0, 0, 2, 1])
    found = sparse.fit_components(cells_of(spark, a), 5, 3)
    assert len(found.variances) == 1 and found.variances[0] == pytest.approx(found.total)
    none = sparse.fit_components(cells_of(spark, a).where("false"), 0, 3)
    assert none.variances == () and none.project(cells_of(spark, a), "row").first().components == []


def test_wide_family(spark):
    """50,000 positions: no matrix of positions x positions, and the variance of 10 components to 1%."""
    rows = spark.range(3000).withColumnRenamed("id", "row")
    noise = rows.select("row", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k")).select(
        "row", F.pmod(F.xxhash64("row", "k"), F.lit(50_000)).alias("position"), F.lit(0.3).alias("value")
    )
    strong = rows.select("row", F.pmod("row", F.lit(12)).alias("g"), F.explode(F.sequence(F.lit(0), F.lit(39))).alias("k")).select(
        "row", (F.lit(50_000) + F.col("g") * 40 + F.col("k")).alias("position"), (1 + F.col("g") / 6).alias("value")
    )
    cells = noise.unionByName(strong).groupBy("row", "position").agg(F.sum("value").alias("value")).cache()
    found = sparse.fit_components(cells, 3000, 10)
    # Twelve groups of 250 rows, each with 40 positions of its own: the leading directions are known.
    scale = np.array([40 * (1 + g / 6) ** 2 for g in range(12)])
    share = np.full(12, 1 / 12)
    want = np.sort(np.linalg.eigvalsh((np.diag(share) - np.outer(share, share)) * np.sqrt(np.outer(scale, scale))))[::-1][:10] * 3000 / 2999
    assert sum(found.variances) == pytest.approx(want.sum(), rel=0.01)
    stats = cells.groupBy("position").agg(F.sum("value").alias("s"), F.sum(F.pow("value", F.lit(2))).alias("q"))
    assert found.total == pytest.approx(stats.agg((F.sum("q") - F.sum(F.pow("s", F.lit(2))) / 3000) / 2999).first()[0])
