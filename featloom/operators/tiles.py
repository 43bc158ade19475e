"""Symmetric matrices of any width in square tiles: pair counts and their products with a few columns.

Positions are cut into ``grid`` strips of ``edge``; a tile holds the cells of two
strips, the first of them not after the second, so each pair is held once, as a place
and a count; its value is worked out where it is used. Numbers by position (columns of
a product) are strips too. Strips next to each other form ``bands``: tiles of two bands
are multiplied together, and a strip goes to as many places as there are bands. Tiles
are moved whole, and no row is made for a cell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pairs of a tile, repeats included, and of two bands; they bound what a task holds.
PAIRS = 1 << 25
BAND_PAIRS = 1 << 29
#: Positions of a band at most, and bands at least.
BAND = 1 << 18
BANDS = 5
BITS = 16  # of a place inside a strip


@dataclass(frozen=True)
class Shape:
    """``size`` positions in ``grid`` strips of ``edge``, these in ``bands``."""

    size: int
    grid: int
    edge: int
    bands: int

    @property
    def deep(self) -> int:
        """Strips of a band."""
        return self.grid // self.bands

    def tile(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """A number for two positions that sorts by tile, then by row and column in it."""
        return ((low // self.edge * self.grid + high // self.edge) << (2 * BITS)) | (low % self.edge << BITS) | high % self.edge


def shape(size: int, pairs: int) -> Shape:
    bands = max(BANDS, ceil(sqrt(2 * pairs / BAND_PAIRS)), ceil(size / BAND))
    deep = max(ceil(sqrt(2 * pairs / PAIRS) / bands), ceil(size / bands / (1 << BITS)), 1)
    return Shape(size, bands * deep, max(1, ceil(size / (bands * deep))), bands)


def _least(values: np.ndarray) -> bytes:
    """Whole numbers as bytes of the least width; the width is told by the length."""
    return values.astype(np.min_scalar_type(int(values.max()))).tobytes()


def _whole(held: bytes, n: int) -> np.ndarray:
    return np.frombuffer(held, f"u{len(held) // n}").astype(np.int64)


PIECE = "tile long, cells binary, counts binary"


def pieces(keys: np.ndarray, weights: np.ndarray | None) -> Iterator[tuple[int, bytes, bytes]]:
    """(tile, cells, counts) of numbers made by ``Shape.tile``: equal ones are added up, ``weights`` tell how often each counts."""
    if not len(keys):
        return
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, weights = keys[order], weights[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    counts = np.diff(starts, append=len(keys)) if weights is None else np.add.reduceat(weights, starts)
    keys = keys[starts]
    tiles = keys >> (2 * BITS)
    cells = (keys & ((1 << (2 * BITS)) - 1)).astype(np.uint32)
    cuts = np.flatnonzero(np.concatenate(([True], tiles[1:] != tiles[:-1], [True])))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(tiles[a]), cells[a:b].tobytes(), _least(counts[a:b])


def added(found: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(cells, counts) of a tile from its pieces."""
    cells = [np.frombuffer(x.as_py(), np.uint32) for x in found.column("cells")]
    counts = [_whole(x.as_py(), len(c)) for x, c in zip(found.column("counts"), cells)]
    cells, counts = np.concatenate(cells), np.concatenate(counts)
    order = np.argsort(cells, kind="stable")
    cells, counts = cells[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
    return cells[starts], np.add.reduceat(counts, starts)


STRIP = "strip long, numbers binary"


def strips(table: DataFrame, names: list[str], of: Shape) -> DataFrame:
    """(strip, numbers) of a table (position, names...): a block of columns x places, 0 where there is no row."""

    def pack(found: pa.Table) -> pa.Table:
        position = found.column("position").to_numpy()
        out = np.zeros((len(names), of.edge))
        for k, name in enumerate(names):
            out[k, position % of.edge] = found.column(name).to_numpy()
        return pa.table({"strip": pa.array([int(position[0]) // of.edge], pa.int64()), "numbers": pa.array([out.tobytes()], pa.binary())})

    strip = F.floor(F.col("position") / F.lit(of.edge)).cast("long")
    held = table.select(F.col("position").cast("long").alias("position"), *[F.col(c).cast("double").alias(c) for c in names])
    return held.groupBy(strip.alias("strip")).applyInArrow(lambda found: pack(found), STRIP)


def unpacked(held: DataFrame, names: list[str], of: Shape) -> DataFrame:
    """(position, names...) of strips, a row for every position."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for strip, block in zip(batch.column("strip").to_pylist(), batch.column("numbers")):
                first = strip * of.edge
                n = max(0, min(of.edge, of.size - first))
                block = np.frombuffer(block.as_py()).reshape(len(names), of.edge)[:, :n]
                yield pa.RecordBatch.from_pydict({"position": pa.array(np.arange(first, first + n), pa.int64())} | {c: pa.array(block[k]) for k, c in enumerate(names)})

    return held.mapInArrow(rows, "position long, " + ", ".join(f"{c} double" for c in names))


def by_place(held: DataFrame, of: Shape, parts: int) -> DataFrame:
    """(place, strip, numbers): each strip beside the pairs of its part with all others, where strips are put into so many parts."""
    part, other = F.floor(F.col("strip") / F.lit(of.grid // parts)).cast("long"), F.col("_other")
    spread = held.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    return spread.select((F.least(part, other) * parts + F.greatest(part, other)).alias("place"), "strip", "numbers")


def _of_strips(found: pa.Table, width: int, edge: int) -> dict[int, np.ndarray]:
    return {s: np.frombuffer(x.as_py()).reshape(width, edge) for s, x in zip(found.column("strip").to_pylist(), found.column("numbers"))}


def _summed(parts: DataFrame) -> DataFrame:
    """(strip, numbers): the parts of each strip added up, in a fixed order."""

    def add(found: pa.Table) -> pa.Table:
        found = found.sort_by("place")
        total = sum(np.frombuffer(x.as_py()) for x in found.column("numbers"))
        return pa.table({"strip": found.column("strip").slice(0, 1), "numbers": pa.array([total.tobytes()], pa.binary())})

    return parts.groupBy("strip").applyInArrow(lambda found: add(found), STRIP)


TILE = "tile long, place long, cells binary, counts binary, own binary, other binary"
PART = "place long, strip long, numbers binary"
Value = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _part(place: int, found: dict[int, np.ndarray]) -> dict[str, pa.Array]:
    return {
        "place": pa.array([place] * len(found), pa.int64()), "strip": pa.array(found.keys(), pa.int64()),
        "numbers": pa.array([x.tobytes() for x in found.values()], pa.binary()),
    }


@dataclass(frozen=True)
class Cells:
    """Reads tiles: a cell's value is ``value(count, number of its row, number of its column)``."""

    shape: Shape
    value: Value

    def halves(self, tile: dict) -> list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(strip, other strip, places, other places, values) both ways round; a cell of the diagonal counts once."""
        i, j = divmod(tile["tile"], self.shape.grid)
        cells = np.frombuffer(tile["cells"], np.uint32).astype(np.int64)
        if not len(cells):
            return []
        row, column = cells >> BITS, cells & ((1 << BITS) - 1)
        values = self.value(_whole(tile["counts"], len(cells)).astype(float), np.frombuffer(tile["own"])[row], np.frombuffer(tile["other"])[column])
        off = row != column if i == j else slice(None)
        return [(i, j, row, column, values), (j, i, column[off], row[off], values[off])]


@dataclass(frozen=True)
class Tiles:
    """A symmetric matrix: ``table`` is (tile, place, cells, counts, own, other), written; see ``Cells`` for its values."""

    table: DataFrame
    cells: Cells

    @property
    def shape(self) -> Shape:
        return self.cells.shape

    def times(self, held: DataFrame, width: int) -> DataFrame:
        """Strips of the product with the ``width`` columns of the strips ``held``."""
        edge, read = self.shape.edge, self.cells.halves

        def multiply(left: pa.Table, right: pa.Table) -> pa.Table:
            block, out = _of_strips(right, width, edge), {}
            for at in range(left.num_rows):
                for strip, other, to, of, value in read(left.slice(at, 1).to_pylist()[0]):
                    if other in block:
                        part = out.setdefault(strip, np.zeros((width, edge)))
                        for k, x in enumerate(block[other]):
                            part[k] += np.bincount(to, value * x[of], edge)
            return pa.table(_part(left.column("place")[0].as_py() if left.num_rows else 0, out))

        met = self.table.groupBy("place").cogroup(by_place(held, self.shape, self.shape.bands).groupBy("place"))
        return _summed(met.applyInArrow(lambda a, b: multiply(a, b), PART))

    def sums(self) -> DataFrame:
        """(position, sum, squares) of the positions with cells."""
        edge, read = self.shape.edge, self.cells.halves

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    tile = batch.slice(at, 1).to_pylist()[0]
                    out = {}
                    for strip, _, to, _, value in read(tile):
                        part = out.setdefault(strip, np.zeros((3, edge)))
                        part += np.stack([np.bincount(to, x, edge) for x in (value, value * value, np.ones(len(value)))])
                    yield pa.RecordBatch.from_pydict(_part(tile["tile"], out))

        found = unpacked(_summed(self.table.mapInArrow(add, PART)), ["sum", "squares", "_n"], self.shape)
        return found.where("_n > 0").drop("_n")


def from_pieces(counted: DataFrame, numbers: DataFrame, cells: Cells) -> DataFrame:
    """The table of ``Tiles`` with the cells of a positive value; ``numbers`` are strips of one column.

    A pair of a position with itself counts both ways round.
    """
    of = cells.shape

    def weigh(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows:
            tile = left.column("tile")[0].as_py()
            i, j = divmod(tile, of.grid)
            held, counts = added(left)
            row, column = held.astype(np.int64) >> BITS, held.astype(np.int64) & ((1 << BITS) - 1)
            if i == j:
                counts = np.where(row == column, 2 * counts, counts)
            block = _of_strips(right, 1, of.edge)
            keep = cells.value(counts.astype(float), block[i][0][row], block[j][0][column]) > 0
            if keep.any():
                place = i // of.deep * of.bands + j // of.deep
                out = [{"tile": tile, "place": place, "cells": held[keep].tobytes(), "counts": _least(counts[keep]), "own": block[i].tobytes(), "other": block[j].tobytes()}]
        kinds = [("tile", pa.int64()), ("place", pa.int64()), ("cells", pa.binary()), ("counts", pa.binary()), ("own", pa.binary()), ("other", pa.binary())]
        return pa.Table.from_pylist(out, pa.schema(kinds))

    return counted.groupBy("tile").cogroup(by_place(numbers, of, of.grid).groupBy("place")).applyInArrow(lambda a, b: weigh(a, b), TILE)
