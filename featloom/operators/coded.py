"""Texts in blocks: their words as codes of the block's own dictionary.

A block holds texts of one task, ``WORDS`` words or little more. Its distinct words
meet a table of words once, however often the texts use them: what is moved by word
are dictionaries, and a text's words stay together in their order. A table of the
whole vocabulary is never read by one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.operators.vectors import lists

#: A block is closed once it holds so many words; a text is never divided.
WORDS = 1 << 20


@dataclass(frozen=True)
class Block:
    """Texts of a block: ``codes`` of all their words in order, ``lengths`` by text, the columns kept, places where they are given."""

    lengths: np.ndarray
    codes: np.ndarray
    terms: pa.Array | range
    kept: dict[str, pa.Array]
    places: np.ndarray | None

    @property
    def text(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.lengths)), self.lengths)

    @property
    def place(self) -> np.ndarray:
        """The place of each word in its text, from 0."""
        if self.places is not None:
            return self.places
        ends = np.cumsum(self.lengths)
        return np.arange(len(self.codes)) - np.repeat(ends - self.lengths, self.lengths)


def _pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The rows of a task in pieces of ``most`` words or little more."""
    held, n = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("_words")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = min(int(np.searchsorted(ends, before + most - n)) + 1, batch.num_rows)
            held.append(batch.slice(at, to - at))
            n, at = n + int(ends[to - 1] - before), to
            if n >= most:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def blocks(
    df: DataFrame, words: Column, keep: Sequence[str] = (), count: Callable[[Block], np.ndarray] | None = None, places: Column | None = None
) -> DataFrame:
    """(block, lengths, codes, terms, keep as lists...) of texts with lists of ``words``; null counts as an empty list.

    ``count`` adds ``counts``, a number for each of the ``terms``; ``places`` tells the
    words' places where these are not 0, 1, 2, .... Write it before it is used twice:
    the numbers of the blocks are those of this run's tasks.
    """
    kept = [f"_k{i}" for i in range(len(keep))]
    located, most = places is not None, WORDS
    rows = df.select(words.alias("_words"), *([places.alias("_places")] if located else []), *[F.col(c).alias(k) for k, c in zip(kept, keep)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for i, piece in enumerate(_pieces(batches, most)):
            piece = piece.combine_chunks()
            held = piece.column("_words").combine_chunks()
            lengths = pc.fill_null(pc.list_value_length(held), 0).to_numpy(zero_copy_only=False).astype(np.int32)
            coded = held.flatten().dictionary_encode()
            terms, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
            codes = codes.astype(np.uint16 if len(terms) <= 1 << 16 else np.int32)
            columns = {"block": pa.array([(task << 32) + i], pa.int64()), "lengths": pa.array([lengths.tobytes()], pa.binary()), "codes": pa.array([codes.tobytes()], pa.binary())}
            columns["terms"] = pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms)
            at = lists(piece.column("_places").combine_chunks(), np.int32)[1] if located else None
            if located:
                columns["places"] = pa.array([at.tobytes()], pa.binary())
            if count:
                numbers = count(Block(lengths, codes.astype(np.int64), terms, {}, at))
                columns["counts"] = pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), pa.array(numbers, pa.int64()))
            for k in kept:
                column = piece.column(k)
                column = column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()
                columns[k] = pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
            yield pa.RecordBatch.from_pydict(columns)

    types = [f"{k} array<{df.schema[c].dataType.simpleString()}>" for k, c in zip(kept, keep)]
    schema = ["block long", "lengths binary", "codes binary", "terms array<string>", *["places binary"] * located, *["counts array<long>"] * bool(count)]
    return rows.mapInArrow(cut, ", ".join([*schema, *types]))


def dictionaries(held: DataFrame) -> DataFrame:
    """(block, code, term): the distinct words of each block."""
    return held.select("block", F.posexplode("terms").alias("code", "term"))


def term_numbers(held: DataFrame) -> DataFrame:
    """(term, n): the ``counts`` of each block's terms."""
    return held.select(F.explode(F.arrays_zip(F.col("terms").alias("term"), F.col("counts").alias("n"))).alias("_t")).select("_t.term", "_t.n")


def meet(held: DataFrame, known: DataFrame, run: Callable[[Block, pa.Table], pa.Table], schema: str, spelled: bool = False) -> DataFrame:
    """``run`` of each block and its rows of ``known`` (block, code, ...), in no order; ``Block.kept`` has the columns in the order kept.

    Only their number is moved with a block, not the terms, unless ``run`` reads them ``spelled``.
    """
    names = [c for c in held.columns if c.startswith("_k")]
    held = held.drop("counts").withColumnRenamed("block", "_block")  # ``known`` comes from ``held``
    held = held if spelled else held.withColumn("terms", F.size("terms"))

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        one = {c: left.column(c)[0] for c in left.column_names}
        raw = {c: one[c].as_py() for c in ("lengths", "codes")}
        lengths = np.frombuffer(raw["lengths"], np.int32)
        n = int(lengths.sum())
        codes = np.frombuffer(raw["codes"], np.uint16 if len(raw["codes"]) == 2 * n else np.int32).astype(np.int64)
        places = np.frombuffer(one["places"].as_py(), np.int32) if "places" in one else None
        terms = one["terms"].values if spelled else range(one["terms"].as_py())
        return run(Block(lengths, codes, terms, {c: one[c].values for c in names}, places), right)

    return held.groupBy("_block").cogroup(known.groupBy("block")).applyInArrow(both, schema)


def numbers(known: pa.Table, *columns: str) -> tuple[np.ndarray, ...]:
    """Columns of a block's rows of a table as arrays."""
    return tuple(known.column(c).to_numpy() for c in columns)


def index_of(codes: np.ndarray, size: int) -> np.ndarray:
    """Where each code of 0, 1, ... ``size`` - 1 stands in ``codes``; -1 where it does not."""
    out = np.full(size, -1, np.int64)
    out[codes] = np.arange(len(codes))
    return out
