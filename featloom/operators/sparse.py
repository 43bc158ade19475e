"""Sparse rows over exact positions, and their principal components.

A family of any width (terms, categories, pairs) is kept as cells ``(row,
position, value)``. Positions come from a dictionary, a written table with one
dense number for each distinct value, so nothing is hashed together and no list of
values reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featloom.operators import tiles
from featloom.operators.tiles import Tiles
from featloom.session import materialize, scratch_path

SLICES = 256
#: So many values at most are hot: those of the greatest counts, which make up most cells of natural texts.
HOT = 50_000


def dictionary(values: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``values``, one row for each of ``columns``, with ``position``: 0, 1, 2, ... in the order of a hash, then of the values.

    Rows are numbered inside slices of the hash range; the offset of a slice is a
    prefix sum over ``SLICES`` counts. The numbers depend on the values alone.
    """
    cut = values.withColumn("_slice", F.pmod(F.xxhash64(*columns), F.lit(SLICES)).cast("int"))
    counts = cut.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # at most SLICES rows
    offsets = materialize(counts.select("_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")), "slice-offsets")
    rank = F.row_number().over(Window.partitionBy("_slice").orderBy(*columns)) - 1
    numbered = cut.withColumn("_rank", rank).join(offsets, "_slice")
    return numbered.select(*values.columns, (F.col("_offset") + F.col("_rank")).alias("position"))


def mark_hot(values: DataFrame, count: str) -> DataFrame:
    """``values`` with ``hot``: whether ``count`` is among the ``HOT`` greatest (ties at the end are left out), so at most ``HOT`` rows are."""
    top = values.select(F.col(count).alias("_n")).orderBy(F.col("_n").desc()).limit(HOT + 1)
    bar, n = top.agg(F.min("_n"), F.count(F.lit(1))).first()
    return values.withColumn("hot", F.lit(True) if n <= HOT else F.col(count) > bar)


def join_known(rows: DataFrame, known: DataFrame, on: str, spread: str | None = None) -> DataFrame:
    """Inner join on ``on`` with a table of ``mark_hot``; ``known`` has one row for each value.

    Rows with a hot value meet the at most ``HOT`` hot ones by broadcast and stay where
    they are, so no value gathers in one task (``spread`` is not needed any more); only
    the others are moved by value. Both parts read ``rows``: write first what is dear to make.
    """
    added = [c for c in known.columns if c not in (on, "hot")]
    hot = F.broadcast(known.where("hot").select(on, *added))
    rest = known.where("NOT hot").select(on, *added)
    return rows.join(hot, on).unionByName(rows.join(hot.select(on), on, "left_anti").join(rest, on)).select(*rows.columns, *added)


def packed(cells: DataFrame, row: str, size: int, out: str, position: str = "position", value: str = "value") -> DataFrame:
    """(row, out): the cells of each row as one sparse vector in storage form; a row's own cells bound its size."""
    held = F.array_sort(F.collect_list(F.struct(F.col(position).cast("int").alias("p"), F.col(value).cast("double").alias("v"))))
    form = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), F.col("_c.p").alias("indices"), F.col("_c.v").alias("values"))
    return cells.groupBy(row).agg(held.alias("_c")).select(row, form.alias(out))


def no_cells(size: int) -> Column:
    """The vector of zeros in storage form."""
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), F.array().cast("array<int>").alias("indices"), F.array().cast("array<double>").alias("values")
    )


def beside(vector: str, numbers: Column) -> Column:
    """A vector in storage form with an array of numbers after it."""
    size = F.col(f"{vector}.size")
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"), (size + F.size(numbers)).alias("size"),
        F.concat(f"{vector}.indices", F.sequence(size, size + F.size(numbers) - 1)).alias("indices"), F.concat(f"{vector}.values", numbers).alias("values"),
    )


def unpacked(df: DataFrame, row: str, vector: str) -> DataFrame:
    """(row, position, value) of vectors in storage form."""
    cells = F.arrays_zip(F.col(f"{vector}.indices").alias("position"), F.col(f"{vector}.values").alias("value"))
    return df.select(row, F.explode(cells).alias("_c")).select(row, "_c.position", "_c.value")


def as_vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` written, and read back with the storage form of ``columns`` as vectors; no Python runs."""
    path = scratch_path(df.sparkSession, "vectors")
    df.write.parquet(path)
    fields = [T.StructField(f.name, VectorUDT(), True) if f.name in columns else f for f in df.schema.fields]
    return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)


# --- components ------------------------------------------------------------


def _names(n: int, prefix: str = "z") -> list[str]:
    return [f"{prefix}{i}" for i in range(n)]


def _products(table: DataFrame) -> np.ndarray:
    """Sums over positions of the products of every two columns: their number squared reaches the driver."""
    names = [c for c in table.columns if c != "position"]
    width = len(names)

    def outer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for frame in batches:
            held = frame.to_numpy(float)
            total += held.T @ held
        yield pd.DataFrame({"at": np.arange(width * width), "v": total.ravel()})

    found = table.select(names).mapInPandas(outer, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(width * width)
    out[found["at"].to_numpy()] = found["v"].to_numpy()
    return out.reshape(width, width)


def _times(table: DataFrame, names: Sequence[str], matrix: np.ndarray) -> DataFrame:
    """(position, z0, z1, ...): the named columns of ``table`` multiplied by a small matrix."""
    names, new = list(names), _names(matrix.shape[1])

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = pd.DataFrame(frame[names].to_numpy(float) @ matrix, columns=new)
            out.insert(0, "position", frame["position"].to_numpy())
            yield out

    return table.select("position", *names).mapInPandas(multiply, "position long, " + ", ".join(f"{z} double" for z in new))


def _whitening(gram: np.ndarray) -> np.ndarray:
    """Columns that make what has these inner products orthonormal; directions that hold nothing are left out."""
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    keep = values > max(values.max(initial=0.0), 0.0) * 1e-12
    return vectors[:, keep] / np.sqrt(values[keep])


def _sums(width: int, weight: str | None = None) -> list[Column]:
    value = F.col("value") * F.col(weight) if weight else F.col("value")
    return [F.sum(value * F.col(z)).alias(z) for z in _names(width)]


@dataclass(frozen=True)
class Components:
    """Fitted principal components: ``basis`` is (position, z0, z1, ...), ``centre`` their numbers for the mean row."""

    basis: DataFrame
    centre: tuple[float, ...]
    variances: tuple[float, ...]
    total: float

    def project(self, cells: DataFrame, row: str) -> DataFrame:
        """(row, components): array of the row's components; rows without cells are not there, see ``at_zero``."""
        k = len(self.centre)
        if not k:
            return cells.select(row, F.array().cast("array<double>").alias("components")).distinct()
        summed = cells.select(row, "position", "value").join(self.basis, "position", "left").groupBy(row).agg(*_sums(k))
        return summed.select(row, F.array(*[F.coalesce(z, F.lit(0.0)) - c for z, c in zip(_names(k), self.centre)]).alias("components"))

    def at_zero(self) -> Column:
        """The components of a row without cells."""
        return F.array(*[F.lit(-c) for c in self.centre]).cast("array<double>")


def fit_components(cells: DataFrame, rows: int, k: int, centre: bool = True, extra: int = 10, passes: int = 3, seed: int = 42) -> Components:
    """The ``k`` leading principal components of sparse rows (row, position, value) of any width.

    Randomised subspace iteration: a block of ``k + extra`` random directions is
    multiplied ``passes`` times by the covariance, made orthonormal in between, and
    turned into components by the small matrix of the last pass. The covariance is
    never formed: a pass sums the cells' products by row, then by position; the mean
    is taken off afterwards, so rows stay sparse. Tables hold positions x block
    numbers; the driver gets the inner products of a block's columns, and the mean
    and the norms follow from these. ``rows`` counts rows without cells too; a
    column ``weight``, where there is one, tells how many equal rows a row stands for.
    Random directions come from a hash, so a fit repeats; the numbers of a
    component sum up to at least 0. Fewer components come back where the cells
    have a smaller rank, none for an empty table.
    """
    times = F.col("weight").cast("double") if "weight" in cells.columns else F.lit(1.0)
    cells = cells.select("row", "position", "value", times.alias("weight"))
    held = F.col("weight") * F.col("value")
    mean = F.sum(held) / F.lit(float(max(rows, 1))) if centre else F.lit(0.0)
    stats = cells.groupBy("position").agg(F.sum(held).alias("sum"), F.sum(held * F.col("value")).alias("squares"), mean.alias("mean"))
    stats = materialize(stats, "positions")

    def squared(basis: DataFrame, width: int) -> DataFrame:
        by_row = cells.join(basis, "position").groupBy("row").agg(*_sums(width))
        return cells.join(by_row, "row").groupBy("position").agg(*_sums(width, "weight"))

    return _iterated(stats, squared, rows, k, float(max(rows - 1, 1)) if centre else 1.0, extra, passes, seed)


def _iterated(stats: DataFrame, times: Callable[[DataFrame, int], DataFrame], rows: int, k: int, over: float, extra: int, passes: int, seed: int) -> Components:
    """``fit_components`` from (position, sum, squares, mean) and the product of the raw rows' covariance with columns z0, z1, ... by position."""
    total, positions = stats.agg(F.sum(F.col("squares") - F.col("mean") * F.col("sum")), F.count(F.lit(1))).first()
    total = float(total or 0.0) / over
    width = min(k + extra, positions, max(rows, 1))
    if not width:
        return Components(stats.select("position"), (), (), total)
    number = lambda j: F.xxhash64("position", F.lit(seed), F.lit(j)) / F.lit(2.0**63)
    basis = stats.select("position", *[number(j).alias(f"z{j}") for j in range(width)])
    # A block as wide as the family spans it: one pass then tells all.
    for left in reversed(range(1 if width == positions else passes)):
        image = times(basis, width).withColumnsRenamed({f"z{i}": f"w{i}" for i in range(width)})
        known = stats.select("position", "mean", F.lit(1.0).alias("one"))
        image = materialize(image.join(basis, "position").join(known, "position"), "image")
        z, w = _names(width), _names(width, "w")
        table = image.select("position", *z, *w, "mean", "one")
        inner = _products(table)
        zz, zw, ww = inner[:width, :width], inner[:width, width : 2 * width], inner[width : 2 * width, width : 2 * width]
        mz, mw, mm, oz = inner[-2, :width], inner[-2, width : 2 * width], inner[-2, -2], inner[-1, :width]
        # What the products of the raw rows hold too much: the mean row, as often as there are rows.
        off = rows * mz
        if left:
            ww = ww - np.outer(off, mw) - np.outer(mw, off) + mm * np.outer(off, off)
            step = _whitening(ww)
            if not step.shape[1]:
                return Components(stats.select("position"), (), (), total)
            basis, width = _times(table, [*w, "mean"], np.vstack((step, -(off @ step)[None, :]))), step.shape[1]
            continue
        white = _whitening(zz)
        small = white.T @ (zw - np.outer(mz, off)) @ white
        values, vectors = np.linalg.eigh((small + small.T) / 2)
        order = [i for i in np.argsort(-values)[:k] if values[i] > max(values.max(), 0.0) * 1e-12]
        axes = white @ vectors[:, order]
        axes = axes * np.where(oz @ axes < 0, -1.0, 1.0)
        found = materialize(_times(table, z, axes), "components") if order else stats.select("position")
        return Components(found, tuple((mz @ axes).tolist()), tuple(float(values[i]) / over for i in order), total)


def fit_symmetric_components(matrix: Tiles, k: int, extra: int = 10, passes: int = 3, seed: int = 42) -> tuple[Components, DataFrame]:
    """``fit_components``, not centred, of a symmetric matrix in tiles, and (position, z0, z1, ...) of its rows.

    Its rows are its columns, so a pass multiplies by the matrix twice; tiles are moved, not cells.
    """
    of = matrix.shape
    stats = materialize(matrix.sums().withColumn("mean", F.lit(0.0)), "positions")

    def squared(basis: DataFrame, width: int) -> DataFrame:
        once = matrix.times(tiles.strips(basis, _names(width), of), width)
        return tiles.unpacked(matrix.times(once, width), _names(width), of)

    found = _iterated(stats, squared, of.size, k, 1.0, extra, passes, seed)
    held = stats.select("position")
    if width := len(found.variances):
        held = tiles.unpacked(matrix.times(tiles.strips(found.basis, _names(width), of), width), _names(width), of).join(held, "position")
    return found, held
