"""Passages of benchmark items in documents, found by a prefix-filtered set join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featloom.llm.common import materialize

_DELIMITERS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_FOLD = bytes.maketrans(_DELIMITERS, b"".join(bytes([c]).lower() if bytes([c]).isalpha() else b" " for c in _DELIMITERS))
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
HITS = pa.list_(pa.struct([("token", pa.int64()), ("at", pa.int32()), ("first", pa.int32()), ("around", pa.string())]))
BITS = 24  # a map of 2 MB, whatever the benchmark's size


def words_of(text: str | None) -> list[bytes]:
    """Runs of a-z (A-Z lower-cased), 0-9 and characters beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def shingles_of(words: list[bytes], width: int) -> np.ndarray:
    """64-bit hashes of the shingles of ``width`` words, as signed numbers; ``width`` is part of the hash."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(w) for w in words], np.uint64)
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = (out ^ h[k : k + n]) * _MIX[k]
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def windows(items: DataFrame, key: str, text: str, size: int, width: int) -> DataFrame:
    """``(window, item, words, length, offset, token)``: every shingle of every window of every item.

    A window is ``size`` consecutive words; an item of fewer words, but not none, is one window.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for item, body in zip(frame["item"], frame["body"]):
                words = words_of(body)
                n = min(size, len(words))
                w = min(width, n)
                tokens = shingles_of(words, w) if n else []
                for start in range(len(words) - n + 1 if n else 0):
                    inside = [x.decode("utf-8", "surrogatepass") for x in words[start : start + n]]
                    rows += [(item, inside, n, o, int(tokens[start + o])) for o in range(n - w + 1)]
            yield pd.DataFrame(rows, columns=["item", "words", "length", "offset", "token"])

    cast = items.select(F.col(key).cast("string").alias("item"), F.coalesce(text, F.lit("")).alias("body"))
    out = cast.mapInPandas(cut, "item string, words array<string>, length int, offset int, token long")
    return materialize(out, "windows")


def _map_of(tokens: DataFrame) -> np.ndarray:
    """A bit for each token's lowest ``BITS`` bits, of a fixed size; at most 2^18 numbers reach the driver."""
    at = F.col("token").bitwiseAND(F.lit((1 << BITS) - 1))
    cells = tokens.select(F.shiftright(at, 6).alias("cell"), F.expr(f"shiftleft(1L, cast(token & 63 AS int))").alias("bit"))
    table = cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[table["cell"].to_numpy()] = table["bits"].to_numpy()
    return out.view(np.uint64)


def _in_map(tokens: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = tokens.view(np.uint64) & np.uint64((1 << BITS) - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", size: int = 10, width: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each document: ``key``, ``n_words``, ``n_hit``, ``items`` (sorted strings), ``n_items``.

    A document word inside any occurrence of a window of any item is hit. The
    shingles of every window are ordered by how often the documents have them,
    rarest first. Whole containment needs a prefix of one, so documents are joined
    on each window's rarest shingle alone, kept where its offset and length fit
    the document, and the window's words are compared one by one. A bit map of
    fixed size drops most document shingles before the shuffle.

    Null texts have no words. Items with a null id hit words but are not listed;
    equal ids are one item. Repeated documents and null keys are judged each by
    itself. ``keep`` names (small) columns of ``docs`` to carry along instead of
    ``key``; others are not read. Without items nothing is hit.
    """
    cut = windows(items, item, item_text, size, width)
    widths = sorted(r[0] for r in cut.select(F.least("length", F.lit(width)).alias("w")).distinct().collect())
    body = F.coalesce(text, F.lit("")).alias("body")
    rows = docs.select(F.struct(*(keep or (key,))).alias("kept"), body).withColumn("uid", F.monotonically_increasing_id())
    seen = _map_of(cut.select("token").distinct())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            kept = [np.empty(0, np.int64)]
            for body in frame["body"]:
                words = words_of(body)
                for w in widths:
                    tokens = shingles_of(words, w)
                    kept.append(tokens[_in_map(tokens, seen)])
            token, n = np.unique(np.concatenate(kept), return_counts=True)
            yield pd.DataFrame({"token": token, "n": n})

    counts = rows.select("body").mapInPandas(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    ranked = cut.select("item", "words", "length", "offset", "token").join(counts, "token", "left")
    prefix = ranked.groupBy("item", "words", "length").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("token"), F.col("offset"))).alias("p")
    )
    prefix = materialize(prefix.where("p.n > 0").select("item", "words", "length", "p.token", "p.offset"), "prefixes")
    wanted = _map_of(prefix.select("token").distinct())

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, hits = [], []
            for body in batch.column("body").to_pylist():
                words = words_of(body)
                n_words.append(len(words))
                mine = []
                for w in widths:
                    tokens = shingles_of(words, w)
                    for at in np.nonzero(_in_map(tokens, wanted))[0].tolist():
                        first = max(0, at - size + w)
                        around = b" ".join(words[first : at + size]).decode("utf-8", "surrogatepass")
                        mine.append({"token": int(tokens[at]), "at": at, "first": first, "around": around})
                hits.append(mine)
            columns = [batch.column("uid"), batch.column("kept"), pa.array(n_words, pa.int64()), pa.array(hits, HITS)]
            yield pa.RecordBatch.from_arrays(columns, names=["uid", "kept", "n_words", "hits"])

    shape = f"uid long, kept {dict(rows.dtypes)['kept']}, n_words long, hits array<struct<token:long,at:int,first:int,around:string>>"
    found = materialize(rows.select("uid", "kept", "body").mapInArrow(look, shape), "shingle-hits")
    begin = F.col("at") - F.col("offset")
    met = (
        found.select("uid", "n_words", F.explode("hits").alias("h")).select("uid", "n_words", "h.*").join(prefix, "token")
        .where((begin >= 0) & (begin + F.col("length") <= F.col("n_words")))
        .where(F.slice(F.split("around", " "), begin - F.col("first") + 1, F.col("length")) == F.col("words"))
        .select("uid", "item", begin.alias("begin"), "length").distinct()
    )
    met = materialize(met, "occurrences")
    order = Window.partitionBy("uid").orderBy("begin", "length")
    reach = F.max(F.col("begin") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    covered = met.select("uid", "begin", "length").distinct().select(
        "uid", F.greatest(F.lit(0), F.col("begin") + F.col("length") - F.greatest("begin", F.coalesce(reach, F.lit(0)))).alias("new")
    ).groupBy("uid").agg(F.sum("new").cast("long").alias("n_hit"))
    listed = met.groupBy("uid").agg(F.sort_array(F.collect_set("item")).alias("items"))
    out = found.select("uid", "kept", "n_words").join(covered.join(listed, "uid", "left"), "uid", "left")
    return out.select(
        *[F.col(f"kept.`{c}`").alias(c) for c in keep or (key,)], "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
    )
