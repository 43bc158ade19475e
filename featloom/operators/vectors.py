"""Feature vectors inside tasks: rows of a vector column as compressed sparse rows, through Arrow."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401


@dataclass(frozen=True)
class Rows:
    """``values[starts[i]:starts[i + 1]]`` stand at ``places[...]`` of row ``i``; all other numbers are 0."""

    starts: np.ndarray
    places: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.starts))

    def by_place(self) -> Columns:
        order = np.argsort(self.places, kind="stable")
        return Columns(len(self), self.places[order], self.row[order], self.values[order])

    def dense(self, width: int) -> np.ndarray:
        out = np.zeros((len(self), width))
        out[self.row, self.places] = self.values
        return out


@dataclass(frozen=True)
class Columns:
    """The same numbers in the order of their places."""

    rows: int
    places: np.ndarray
    row: np.ndarray
    values: np.ndarray

    def column(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows with a number at ``place``, and the numbers."""
        lo, hi = np.searchsorted(self.places, [place, place + 1])
        return self.row[lo:hi], self.values[lo:hi]


def lists(array: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and flat values of a list array; null counts as empty."""
    lengths = pa.compute.fill_null(pa.compute.list_value_length(array), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return lengths, array.flatten().to_numpy(zero_copy_only=False).astype(kind)


def read(array: pa.Array) -> Rows:
    """Rows of a vector column as it arrives in a task, dense and sparse ones mixed; zeros are left out."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    n, values = lists(array.field("values"), float)
    held, places = lists(array.field("indices"), np.int64)
    starts = np.concatenate(([0], np.cumsum(n)))
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(values)) - starts[row]
    sparse = np.repeat(held == n, n) & np.repeat(array.field("type").to_numpy(zero_copy_only=False) == 0, n)
    at[sparse] = places
    keep = values != 0
    return Rows(np.concatenate(([0], np.cumsum(np.bincount(row[keep], minlength=len(n))))), at[keep], values[keep])
