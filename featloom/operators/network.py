"""Neural network classifier, trained by mini-batches whose gradients are summed over all tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.operators import vectors
from featloom.operators.boosting import _sigmoid, _unit
from featloom.session import materialize

#: Value and slope (from the value) of an activation.
ACTIVATIONS = {
    "relu": (lambda z: np.maximum(z, 0.0), lambda a: (a > 0).astype(float)),
    "tanh": (np.tanh, lambda a: 1.0 - a * a),
    "logistic": (_sigmoid, lambda a: a * (1.0 - a)),
}
SLICE = 4096  # rows worked out at a time

Layers = tuple[tuple[np.ndarray, np.ndarray], ...]


def _times(rows: vectors.Rows, weights: np.ndarray) -> np.ndarray:
    """Sparse rows times a matrix, row sums by prefix sums of the products."""
    products = rows.values[:, None] * weights[rows.places]
    sums = np.concatenate((np.zeros((1, weights.shape[1])), np.cumsum(products, axis=0)))
    return sums[rows.starts[1:]] - sums[rows.starts[:-1]]


def forward(rows: vectors.Rows, layers: Layers, activation: str) -> list[np.ndarray]:
    """The values of every layer; the last one is the probability of the label 1."""
    value = ACTIVATIONS[activation][0]
    out = []
    for k, (w, b) in enumerate(layers):
        z = (_times(rows, w) if k == 0 else out[-1] @ w) + b
        out.append(_sigmoid(z) if k == len(layers) - 1 else value(z))
    return out


def loss(p: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(p, 1e-15, 1 - 1e-15)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum())


def gradient(rows: vectors.Rows, y: np.ndarray, layers: Layers, activation: str) -> tuple[float, list[tuple[np.ndarray, np.ndarray]]]:
    """Summed logistic loss and its gradient over the rows, without the penalty."""
    slope = ACTIVATIONS[activation][1]
    values = forward(rows, layers, activation)
    delta = values[-1] - y[:, None]
    out = []
    for k in reversed(range(len(layers))):
        if k:
            out.append((values[k - 1].T @ delta, delta.sum(axis=0)))
            delta = (delta @ layers[k][0].T) * slope(values[k - 1])
        else:
            first = np.zeros_like(layers[0][0])
            np.add.at(first, rows.places, rows.values[:, None] * delta[rows.row])
            out.append((first, delta.sum(axis=0)))
    return loss(values[-1][:, 0], y), out[::-1]


def flat(layers: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    return np.concatenate([part.ravel() for layer in layers for part in layer])


def shaped(numbers: np.ndarray, sizes: Sequence[int]) -> Layers:
    out, at = [], 0
    for n, m in zip(sizes, sizes[1:]):
        out.append((numbers[at : at + n * m].reshape(n, m), numbers[at + n * m : at + n * m + m]))
        at += n * m + m
    return tuple(out)


def start(sizes: Sequence[int], activation: str, seed: int) -> np.ndarray:
    """Uniform weights whose bound falls with the layer's width."""
    rng = np.random.default_rng(seed)
    factor = 2.0 if activation == "logistic" else 6.0
    bound = [np.sqrt(factor / (n + m)) for n, m in zip(sizes, sizes[1:])]
    return flat([(rng.uniform(-b, b, (n, m)), rng.uniform(-b, b, m)) for (n, m), b in zip(zip(sizes, sizes[1:]), bound)])


@dataclass(frozen=True)
class Network:
    """Fitted network; ``transform`` adds ``probability`` (a vector of two) to rows with a vector ``features``.

    ``rounds`` is the number of passes over the rows, ``scores`` the accuracy on the held-out rows before each of them.
    """

    sizes: tuple[int, ...]
    numbers: np.ndarray
    activation: str
    rounds: int
    scores: tuple[float, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        layers, activation = shaped(self.numbers, self.sizes), self.activation

        @F.arrow_udf("double")
        def score(features: pa.Array) -> pa.Array:
            return pa.array(forward(vectors.read(features), layers, activation)[-1][:, 0])

        p = F.col("_p")
        scored = df.withColumn("_p", score("features"))
        return scored.withColumn("probability", array_to_vector(F.array(1 - p, p))).withColumn("prediction", (p > 0.5).cast("double")).drop("_p")


@dataclass(frozen=True)
class NeuralNetwork:
    """Network for a label ``_y`` of 0 and 1 and a vector ``features`` of ``inputs`` numbers.

    A share of ``validation`` of the rows, drawn by a hash, is held out. The others
    are dealt anew into ``batches`` in every round; for each batch tasks add up the
    gradient of the logistic loss over their rows, the sums meet by an aggregate,
    and the driver takes one Adam step with rate ``rate`` and penalty ``alpha`` on the
    weights. After ``patience`` rounds in which the accuracy on the held-out rows
    has not risen by more than ``tolerance``, or after ``max_iter`` rounds, training ends
    with the weights of the best round. The driver holds the weights, tasks and
    the shuffle as many numbers a partition.
    """

    inputs: int
    hidden: tuple[int, ...] = (64,)
    activation: str = "relu"
    alpha: float = 1e-4
    rate: float = 1e-3
    max_iter: int = 200
    batches: int = 4
    validation: float = 0.2
    patience: int = 10
    tolerance: float = 1e-4
    seed: int = 42

    def fit(self, df: DataFrame) -> Network:
        if self.activation not in ACTIVATIONS:
            raise ValueError(f"unknown activation: {self.activation}")
        rows = materialize(df.select(F.monotonically_increasing_id().alias("row"), "features", F.col("_y").cast("double").alias("y")), "network-rows")
        sizes = self.sizes
        numbers = start(sizes, self.activation, self.seed)
        best, scores = numbers, []
        mean, square, steps, waited, rounds = np.zeros_like(numbers), np.zeros_like(numbers), 0, 0, 0
        for epoch in range(self.max_iter):
            for batch in range(self.batches):
                slope, seen, right, held = self.summed(rows, numbers, epoch, batch)
                if batch == 0 and held:
                    scores.append(right / held)
                    if scores[-1] > max(scores[:-1], default=-1.0) + self.tolerance:
                        best, waited = numbers, 0
                    else:
                        waited += 1
                if waited > self.patience:
                    return Network(sizes, best, self.activation, rounds, tuple(scores))
                if not seen:
                    continue
                slope = (slope + self.alpha * self._penalty(numbers, sizes)) / seen
                steps += 1
                mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope * slope
                rate = self.rate * np.sqrt(1 - 0.999**steps) / (1 - 0.9**steps)
                numbers = numbers - rate * mean / (np.sqrt(square) + 1e-8)
            rounds += 1
        if scores:
            _, _, right, held = self.summed(rows, numbers, self.max_iter, 0)
            scores.append(right / held)
        last = not scores or scores[-1] > max(scores[:-1], default=-1.0) + self.tolerance
        return Network(sizes, numbers if last else best, self.activation, rounds, tuple(scores))

    @property
    def sizes(self) -> tuple[int, ...]:
        return (self.inputs, *self.hidden, 1)

    def _penalty(self, numbers: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
        return flat([(w, np.zeros_like(b)) for w, b in shaped(numbers, sizes)])

    def summed(self, rows: DataFrame, numbers: np.ndarray, epoch: int, batch: int) -> tuple[np.ndarray, int, int, int]:
        """Summed gradient and number of the rows of a batch; in the first of a round also the held-out rows and how many are right."""
        layers, activation, seed, validation, batches = shaped(numbers, self.sizes), self.activation, self.seed, self.validation, self.batches

        def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(numbers) + 3)
            for part in parts:
                for lo in range(0, part.num_rows, SLICE):
                    piece = part.slice(lo, SLICE)
                    row, y = piece.column("row").to_numpy(), piece.column("y").to_numpy()
                    held = _unit(seed, 3, row) < validation
                    mine = ~held & (np.floor(_unit(seed, 4, epoch, row) * batches) == batch)
                    features = piece.column("features")
                    if mine.any():
                        total[:-3] += flat(gradient(vectors.read(features.filter(pa.array(mine))), y[mine], layers, activation)[1])
                        total[-3] += mine.sum()
                    if batch == 0 and held.any():
                        p = forward(vectors.read(features.filter(pa.array(held))), layers, activation)[-1][:, 0]
                        total[-2:] += ((p > 0.5) == (y[held] > 0.5)).sum(), held.sum()
            at = np.nonzero(total)[0]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "v"])

        found = rows.mapInArrow(add, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
        total = np.zeros(len(numbers) + 3)
        total[found["at"].to_numpy()] = found["v"].to_numpy()
        return total[:-3], int(total[-3]), int(total[-2]), int(total[-1])
