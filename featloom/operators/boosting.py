"""Boosted trees of second order: leaves and splits from sums of gradients and curvatures over bins."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from featloom.operators import vectors
from featloom.session import materialize

KEEP = 10  # trees whose margins are worked out anew before the margins are written


@dataclass(frozen=True)
class Split:
    """Rows of ``node`` whose number at ``feature`` is at most ``threshold`` go to ``2 * node``, the others to ``2 * node + 1``."""

    node: int
    feature: int
    bin: int
    threshold: float
    gain: float
    zero_left: bool


@dataclass(frozen=True)
class Tree:
    """Node 1 is the root; every node that is not split has a weight."""

    splits: tuple[Split, ...] = ()
    weights: tuple[tuple[int, float], ...] = ()

    def nodes(self, columns: vectors.Columns, binned: bool) -> np.ndarray:
        """The node every row ends in; ``binned`` rows hold bins in place of numbers."""
        out = np.ones(columns.rows, np.int64)
        for s in self.splits:  # parents stand before their children
            left = np.full(columns.rows, s.zero_left)
            row, value = columns.column(s.feature)
            left[row] = value <= (s.bin if binned else s.threshold)
            out = np.where(out == s.node, 2 * s.node + ~left, out)
        return out

    def values(self, columns: vectors.Columns, binned: bool) -> np.ndarray:
        nodes = self.nodes(columns, binned)
        table = np.zeros(max(node for node, _ in self.weights) + 1)
        for node, w in self.weights:
            table[node] = w
        return table[nodes]


@dataclass(frozen=True)
class SecondOrderTrees:
    """Fitted trees; ``transform`` adds ``probability`` (a vector of two) to rows with a vector ``features``."""

    trees: tuple[Tree, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        trees = self.trees

        @F.arrow_udf("double")
        def score(features: pa.Array) -> pa.Array:
            columns = vectors.read(features).by_place()
            margin = sum((t.values(columns, False) for t in trees), np.zeros(columns.rows))
            return pa.array(_sigmoid(margin))

        p = F.col("_p")
        scored = df.withColumn("_p", score("features"))
        return scored.withColumn("probability", array_to_vector(F.array(1 - p, p))).withColumn("prediction", (p > 0.5).cast("double")).drop("_p")


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -700, 700)))


def _shrunk(gradient: Column, alpha: float) -> Column:
    return F.signum(gradient) * F.greatest(F.abs(gradient) - alpha, F.lit(0.0))


def leaf_weight(gradient: float, curvature: float, alpha: float, penalty: float) -> float:
    """Soft threshold of the gradient over the curvature, both penalties taken in."""
    over = curvature + penalty
    return -np.sign(gradient) * max(abs(gradient) - alpha, 0.0) / over if over > 0 else 0.0


def _unit(seed: int, *parts: np.ndarray | int) -> np.ndarray:
    """Numbers in [0, 1) from a hash of whole numbers: the same on every run and partitioning."""
    x = np.uint64(seed)
    for part in parts:
        x = (np.asarray(part).astype(np.uint64) ^ x) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(29))
    return (x >> np.uint64(11)).astype(float) / 2.0**53


@dataclass(frozen=True)
class SecondOrderBooster:
    """Boosted trees for a label ``_y`` of 0 and 1 and a vector ``features``.

    Each tree is grown level by level: tasks add up gradients and curvatures of
    the logistic loss for every node, feature and bin, the sums meet by an
    aggregate, and the best split of every node comes back, one row a node. A split
    gains ``(s(left) + s(right) - s(node)) / 2`` with ``s = t(G)^2 / (H + reg_lambda)``
    and ``t`` the soft threshold by ``reg_alpha``; a leaf weighs ``-t(G) / (H +
    reg_lambda)`` times ``step``. Bins are quantiles of a feature's numbers other
    than 0, and 0 itself; rows hold only these numbers, so features may be
    any number of sparse positions. Rows and features of a tree are drawn by a hash.
    Ties go to the smaller feature, then the smaller threshold.
    """

    n_trees: int = 100
    step: float = 0.3
    depth: int = 6
    subsample: float = 1.0
    columns: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    min_weight: float = 1.0
    bins: int = 64
    seed: int = 42

    def fit(self, df: DataFrame) -> SecondOrderTrees:
        rows = materialize(df.select(F.monotonically_increasing_id().alias("row"), "features", F.col("_y").cast("double").alias("y")), "boost-rows")
        cells = materialize(_cells(rows), "boost-cells")
        grid = [k / self.bins for k in range(1, self.bins)]
        edges = cells.groupBy("feature").agg(F.percentile_approx("value", grid, 10_000).alias("e"))
        edges = materialize(edges.select("feature", F.array_sort(F.array_distinct(F.concat("e", F.array(F.lit(0.0))))).alias("edges")), "boost-edges")
        below = lambda v: F.size(F.filter("edges", lambda e: e < v))
        held = cells.join(edges, "feature").select("row", F.struct("feature", below(F.col("value")).alias("bin")).alias("c"))
        held = held.groupBy("row").agg(F.array_sort(F.collect_list("c")).alias("c"))
        state = rows.select("row", "y", F.lit(0.0).alias("margin")).join(held, "row", "left")
        state = materialize(state.select("row", "y", "margin", F.col("c.feature").alias("places"), F.col("c.bin").alias("bins")), "boost-state")
        edges = edges.withColumn("zero", below(F.lit(0.0)))
        trees: list[Tree] = []
        since = 0
        for k in range(self.n_trees):
            trees.append(self._grow(state, edges, trees[since:], k))
            if len(trees) - since == KEEP and k + 1 < self.n_trees:
                state = materialize(_with_margins(state, trees[since:]), "boost-state")
                since = len(trees)
        return SecondOrderTrees(tuple(trees))

    def _grow(self, state: DataFrame, edges: DataFrame, recent: Sequence[Tree], number: int) -> Tree:
        tree = Tree()
        totals: dict[int, tuple[float, float]] = {}
        active = [1]
        for level in range(self.depth):
            sums = self._sums(state, recent, tree, active, number)
            sums = sums.repartition("node", "feature").groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            if not level:
                sums = materialize(sums, "boost-sums")
                root = sums.where("feature = -1").first()
                if root is None:
                    return Tree((), ((1, 0.0),))
                totals[1] = (root["g"], root["h"])
            found = {r["node"]: r for r in self._best(sums, edges, {n: totals[n] for n in active}).collect()}
            splits = [found[n] for n in sorted(found)]
            if not splits:
                break
            made = tuple(Split(r["node"], r["feature"], r["bin"], r["threshold"], r["gain"], r["threshold"] >= 0.0) for r in splits)
            tree = Tree(tree.splits + made)
            active = []
            for r in splits:
                g, h = totals[r["node"]]
                totals[2 * r["node"]], totals[2 * r["node"] + 1] = (r["gl"], r["hl"]), (g - r["gl"], h - r["hl"])
                active += [2 * r["node"], 2 * r["node"] + 1]
        if not totals:
            return Tree((), ((1, 0.0),))
        inner = {s.node for s in tree.splits}
        weigh = lambda g, h: float(self.step * leaf_weight(g, h, self.reg_alpha, self.reg_lambda))
        return Tree(tree.splits, tuple((n, weigh(*gh)) for n, gh in sorted(totals.items()) if n not in inner))

    def _sums(self, state: DataFrame, recent: Sequence[Tree], tree: Tree, active: Sequence[int], number: int) -> DataFrame:
        """(node, feature, bin, g, h): sums of a task's rows; feature -1 holds those of all its rows."""
        subsample, columns, seed = self.subsample, self.columns, self.seed
        order = np.array(sorted(active))

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                held = _held(batch)
                by_place = held.by_place()
                margin = batch.column("margin").to_numpy() + sum((t.values(by_place, True) for t in recent), np.zeros(len(held)))
                p = _sigmoid(margin)
                node = tree.nodes(by_place, True)
                used = np.isin(node, order)
                if subsample < 1:
                    used &= _unit(seed, 1, number, batch.column("row").to_numpy()) < subsample
                g = np.where(used, p - batch.column("y").to_numpy(), 0.0)
                h = np.where(used, p * (1 - p), 0.0)
                at = np.searchsorted(order, np.where(used, node, order[0]))
                row, place, bin_ = held.row, held.places, held.values.astype(np.int64)
                keep = used[row]
                if columns < 1:
                    keep &= _unit(seed, 2, number, place) < columns
                row, place, bin_ = row[keep], place[keep], bin_[keep]
                width, depth = place.max(initial=0) + 1, bin_.max(initial=0) + 1
                keys, back = np.unique((at[row] * width + place) * depth + bin_, return_inverse=True)
                keys = np.stack([keys // depth // width, keys // depth % width, keys % depth], axis=1)
                n = len(order)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate((order[keys[:, 0]], order)), pa.int64()),
                    pa.array(np.concatenate((keys[:, 1], np.full(n, -1))), pa.int64()), pa.array(np.concatenate((keys[:, 2], np.zeros(n, np.int64))), pa.int64()),
                    pa.array(np.concatenate((np.bincount(back, g[row], len(keys)), np.bincount(at, g, n)))),
                    pa.array(np.concatenate((np.bincount(back, h[row], len(keys)), np.bincount(at, h, n)))),
                ], names=["node", "feature", "bin", "g", "h"])

        return state.mapInArrow(add, "node long, feature long, bin long, g double, h double")

    def _best(self, sums: DataFrame, edges: DataFrame, totals: dict[int, tuple[float, float]]) -> DataFrame:
        """(node, feature, bin, threshold, gain, gl, hl): the best split of every node that has one."""
        known = F.from_json(F.lit(_json(totals)), "map<string, struct<g: double, h: double>>")[F.col("node").cast("string")]
        at = sums.where("feature >= 0").join(edges.select("feature", "edges", "zero"), "feature")
        # What a feature's numbers leave of the node stands at 0.
        rest = at.groupBy("node", "feature").agg(F.sum("g").alias("sg"), F.sum("h").alias("sh"), F.first("zero").alias("bin"), F.first("edges").alias("edges"))
        rest = rest.select("node", "feature", F.col("bin").cast("long").alias("bin"), (known.g - F.col("sg")).alias("g"), (known.h - F.col("sh")).alias("h"), "edges")
        all_bins = at.select("node", "feature", "bin", "g", "h", "edges").unionByName(rest)
        all_bins = all_bins.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.first("edges").alias("edges"))
        upto = Window.partitionBy("node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        cut = all_bins.withColumns({"gl": F.sum("g").over(upto), "hl": F.sum("h").over(upto), "G": known.g, "H": known.h})
        score = lambda g, h: _shrunk(g, self.reg_alpha) * _shrunk(g, self.reg_alpha) / (h + self.reg_lambda)
        gl, hl, g, h = (F.col(c) for c in ("gl", "hl", "G", "H"))
        cut = cut.where((hl >= self.min_weight) & (h - hl >= self.min_weight) & (hl + self.reg_lambda > 0) & (h - hl + self.reg_lambda > 0))
        cut = cut.withColumn("gain", (score(gl, hl) + score(g - gl, h - hl) - score(g, h)) / 2).where("gain > 1e-12")
        threshold = F.get("edges", F.col("bin").cast("int"))
        best = F.max_by(F.struct("feature", "bin", threshold.alias("threshold"), "gain", "gl", "hl"), F.struct(F.col("gain"), -F.col("feature"), -F.col("bin")))
        return cut.where(threshold.isNotNull()).groupBy("node").agg(best.alias("s")).select("node", "s.*")


def _json(totals: dict[int, tuple[float, float]]) -> str:
    return json.dumps({str(n): {"g": g, "h": h} for n, (g, h) in totals.items()})


def _cells(rows: DataFrame) -> DataFrame:
    """(row, feature, value): the numbers other than 0 of every row."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = vectors.read(batch.column("features"))
            row = batch.column("row").to_numpy()[held.row]
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(held.places), pa.array(held.values)], names=["row", "feature", "value"])

    return rows.mapInArrow(unpack, "row long, feature long, value double")


def _held(batch: pa.RecordBatch) -> vectors.Rows:
    n, places = vectors.lists(batch.column("places"), np.int64)
    return vectors.Rows(np.concatenate(([0], np.cumsum(n))), places, vectors.lists(batch.column("bins"), np.int64)[1])


def _with_margins(state: DataFrame, trees: Sequence[Tree]) -> DataFrame:
    trees = list(trees)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_place = _held(batch).by_place()
            margin = batch.column("margin").to_numpy() + sum((t.values(by_place, True) for t in trees), np.zeros(by_place.rows))
            yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(margin))

    return state.mapInArrow(add, state.schema)
