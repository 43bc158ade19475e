"""Language of texts by a small byte convolutional network, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16


def windows_of(text: str) -> np.ndarray:
    """The whole text as rows of ``WINDOW`` UTF-8 bytes, A-Z in lower case, the last row filled with zeros."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    out = np.zeros((max(1, -(-len(raw) // WINDOW)), WINDOW), np.uint8)
    out.reshape(-1)[: len(raw)] = raw
    return out


@dataclass(frozen=True)
class ByteNet:
    """Filters of several widths over one-hot bytes, maximum over the window, one dense layer, softmax.

    ``tables[width]`` has shape (width, 256, filters): a filter over one-hot bytes is a sum of table rows.
    """

    labels: list[str]
    tables: dict[int, np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def pooled(self, x: np.ndarray, positions: bool = False):
        tops, at = [], {}
        for width, table in self.tables.items():
            n = x.shape[1] - width + 1
            total = np.take(table[0], x[:, :n], axis=0)
            for k in range(1, width):
                total += np.take(table[k], x[:, k : k + n], axis=0)
            if positions:
                at[width] = total.argmax(axis=1)
            tops.append(total.max(axis=1))
        top = np.concatenate(tops, axis=1) + self.bias
        return (top, at) if positions else top

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """One row for each window."""
        out = np.empty((len(x), len(self.labels)))
        for k in range(0, len(x), 128):
            out[k : k + 128] = _softmax(np.maximum(self.pooled(x[k : k + 128]), 0) @ self.dense + self.offset)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Label and score of each text: window probabilities averaged by their number of bytes."""
        names, scores, held, counts, at = [UNKNOWN] * len(texts), [0.0] * len(texts), [], [], []

        def flush() -> None:
            probs = self.probabilities(np.concatenate(held))
            begin = 0
            for row, (n, size) in zip(at, counts):
                weight = np.full(n, float(WINDOW))
                weight[-1] = size - (n - 1) * WINDOW
                mean = weight @ probs[begin : begin + n] / weight.sum()
                begin += n
                names[row], scores[row] = self.labels[int(mean.argmax())], min(1.0, float(mean.max()))
            held.clear(), counts.clear(), at.clear()

        for row, text in enumerate(texts):
            if text is None or not self.labels or not any(map(str.isalpha, text)):
                continue
            x = windows_of(text)
            held.append(x), at.append(row), counts.append((len(x), len(text.encode("utf-8", "surrogatepass"))))
            if sum(len(h) for h in held) >= 1024:
                flush()
        if held:
            flush()
        return names, scores


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(x: np.ndarray, labels: list[str], epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 5) -> ByteNet:
    """Adam on cross-entropy. ``x`` has a window in each row; the same input gives the same net."""
    names = sorted(set(labels))
    y = np.array([names.index(v) for v in labels], np.int64)
    rng = np.random.default_rng(seed)
    params = {w: rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    params |= {"bias": np.zeros(FILTERS * len(WIDTHS), np.float32), "dense": rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(names))), "offset": np.zeros(len(names))}
    net = ByteNet(names, {w: params[w] for w in WIDTHS}, params["bias"], params["dense"], params["offset"])
    first, second = ({k: np.zeros_like(v) for k, v in params.items()} for _ in range(2))
    step, cols = 0, np.arange(FILTERS)
    for _ in range(epochs if len(names) > 1 else 0):
        order = rng.permutation(len(x))
        for k in range(0, len(order), batch):
            rows = order[k : k + batch]
            top, at = net.pooled(x[rows], positions=True)
            live = np.maximum(top, 0)
            error = _softmax(live @ net.dense + net.offset)
            error[np.arange(len(rows)), y[rows]] -= 1
            error /= len(rows)
            back = (error @ net.dense.T) * (top > 0)
            grads = {"dense": live.T @ error, "offset": error.sum(axis=0), "bias": back.sum(axis=0)}
            for i, width in enumerate(WIDTHS):
                grads[width] = np.zeros_like(params[width])
                part = back[:, i * FILTERS : (i + 1) * FILTERS]
                for j in range(width):
                    byte = x[rows[:, None], at[width] + j]
                    np.add.at(grads[width][j], (byte, np.broadcast_to(cols, byte.shape)), part)
            step += 1
            for key, value in params.items():
                first[key] += 0.1 * (grads[key] - first[key])
                second[key] += 0.01 * (grads[key] ** 2 - second[key])
                value -= (rate * (first[key] / (1 - 0.9**step)) / (np.sqrt(second[key] / (1 - 0.99**step)) + 1e-6)).astype(value.dtype)
    return net


def learnable(key: Column) -> Column:
    """Whether a document may be learnt from: crc32 of its key as text, modulo 3, is not 1. Null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % 3 != 1


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_class: int = 500, limit: int = 4000,
        per_text: int = 6) -> ByteNet:
    """Train on a bounded sample: about ``per_class`` documents of each language, ``limit`` in all, ``per_text`` windows spread over each whole text.

    The driver gets at most ``limit * per_text`` windows of ``WINDOW`` bytes. The
    sample is drawn by a hash of the key: the same on every run, of every input size.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("body"), F.col(lang).cast("string").alias("name"))
    rows = rows.where(learnable(F.col("key")) & F.col("name").isNotNull() & F.col("body").isNotNull())
    counts = rows.groupBy("name").count()
    place = (F.pmod(F.xxhash64("key", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)) * F.col("count") / per_class
    drawn = rows.join(F.broadcast(counts.orderBy(F.desc("count"), "name").limit(limit)), "name").withColumn("place", place)
    drawn = drawn.where("place < 1").select("name", "place", "key", "body")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for name, place, body in zip(frame.name, frame.place, frame.body):
                if any(map(str.isalpha, body)):
                    x = windows_of(body)
                    pick = np.unique(np.linspace(0, len(x) - 1, min(per_text, len(x))).round().astype(int))
                    out.append((name, place, x[pick].tobytes()))
            yield pd.DataFrame(out, columns=["name", "place", "windows"])

    sample = drawn.withColumnRenamed("name", "lang_name").select(F.col("lang_name").alias("name"), "place", "body").mapInPandas(
        cut, "name string, place double, windows binary"
    )
    table = sample.orderBy("place", "name", "windows").limit(limit).toArrow()
    names, x = [], [np.zeros((0, WINDOW), np.uint8)]
    for name, windows in zip(table["name"].to_pylist(), table["windows"].to_pylist()):
        x.append(np.frombuffer(windows, np.uint8).reshape(-1, WINDOW))
        names += [name] * len(x[-1])
    return train(np.concatenate(x), names)


def predict(docs: DataFrame, net: ByteNet, text: str = "text", into: tuple[str, str] = ("lang_pred", "score"), keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) with the predicted language and its score, from the whole text alone.

    Null texts and texts without a letter are ``und`` with score 0, and so is
    every text where no language was learnt. One row for each input row; columns
    of the two names are replaced. Kept columns pass through as they are, a few
    hundred rows at a time.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in into]
    rows = docs.select(*keep, F.col(text).alias("_body"))
    fields = [f for f in rows.schema.fields if f.name != "_body"]
    schema = StructType([*fields, StructField(into[0], StringType()), StructField(into[1], DoubleType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                names, scores = net.predict(part.column("_body").to_pylist())
                columns = [part.column(c) for c in keep] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *into])

    return rows.mapInArrow(judge, schema)
