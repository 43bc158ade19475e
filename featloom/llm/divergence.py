"""How far the sources of a language are apart in their words, from sorted pointers to word starts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featloom.llm.common import materialize

_LETTERS = [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
#: Each byte of a word in lower case, every other byte zero.
FOLD = np.zeros(256, np.uint8)
FOLD[_LETTERS] = [c | 0x20 if c < 0x5B else c for c in _LETTERS]
SHARD = 8 << 20  # bytes of text sorted at a time
SLICES = 8  # slices of 8 bytes compared as numbers; what is equal beyond is compared as bytes
UNIT = 1_000_000_000
TERMS, SOURCES = 2048, 256  # terms and sources of a tile, about


def pointers(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every word in ``data``, folded bytes of texts that end at ``ends``."""
    inside = data != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    # A word ends with its text, whatever the next one begins with.
    cuts = ends[(ends > 0) & (ends < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.nonzero(first)[0]
    return starts, np.nonzero(last)[0] + 1 - starts


def _slice(view: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    """Bytes ``8 * depth`` to ``8 * depth + 7`` of each word as a number that sorts like them, zeros after its end."""
    left = np.clip(lengths - 8 * depth, 0, 8)
    at = np.minimum(starts + 8 * depth, len(view) - 1)
    keep = np.where(left > 0, ~np.uint64(0) << ((8 - np.maximum(left, 1)) * 8).astype(np.uint64), np.uint64(0))
    return view[at].astype(np.uint64) & keep


def sort_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pointers by their words, stable, and where in it a new word begins.

    Multikey sort by slices: all pointers by the first 8 bytes, and every run of
    equal slices whose words go on by the next 8, until runs are equal words.
    """
    n = len(starts)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    view = np.ndarray(shape=(len(data) + 1,), dtype=">u8", buffer=padded, strides=(1,))
    key = _slice(view, starts, lengths, 0)
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    depth = 1
    active = np.arange(n)
    while True:
        # Of the runs sorted last, those of more than one pointer whose slice is full go on.
        run = np.cumsum(new[active]) if len(active) else active
        size = np.bincount(run, minlength=1)[run] if len(active) else active
        active = active[(size > 1) & ((key & np.uint64(0xFF)) != 0)]
        if not len(active):
            return order, new
        run = np.cumsum(new[active])
        if depth == SLICES:
            body = data.tobytes()
            rest = [body[s + 8 * depth : s + l] for s, l in zip(starts[order[active]].tolist(), lengths[order[active]].tolist())]
            by = sorted(range(len(active)), key=lambda i: (run[i], rest[i]))
            order[active] = order[active][by]
            new[active[1:]] |= np.array([rest[a] != rest[b] for a, b in zip(by, by[1:])], bool)
            return order, new
        key = _slice(view, starts[order[active]], lengths[order[active]], depth)
        by = np.lexsort((key, run))
        order[active], key = order[active][by], key[by]
        # Runs stay where they are, so the first pointer of each keeps its mark.
        new[active[1:]] |= key[1:] != key[:-1]
        depth += 1


def count_words(texts: pa.Array, groups: np.ndarray) -> pa.RecordBatch:
    """``(group, term, df, count)`` of a shard of texts: runs of equal words, cut by the group of their texts."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    body = FOLD[body]
    starts, lengths = pointers(body, offsets[1:])
    doc = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, offsets)))
    by = np.argsort(groups[doc], kind="stable")
    starts, lengths, doc = starts[by], lengths[by], doc[by]
    order, new = sort_words(body, starts, lengths)
    doc = doc[order]
    group = groups[doc]
    if len(order):
        new[1:] |= group[1:] != group[:-1]
    at = np.nonzero(new)[0]
    fresh = new.copy()
    if len(order):
        fresh[1:] |= doc[1:] != doc[:-1]
    count = np.diff(np.append(at, len(order)))
    df = np.add.reduceat(fresh.astype(np.int64), at) if len(at) else at
    begin, size = starts[order[at]], lengths[order[at]]
    ends = np.concatenate(([0], np.cumsum(size)))
    letters = body[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])]
    term = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(letters)).cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.array(group[at], pa.int64()), term, pa.array(df, pa.int64()), pa.array(count, pa.int64())], names=["group", "term", "df", "count"])


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(lang, source, term, df, count)``: documents with the term and its occurrences, written to the shared folder.

    Terms are runs of letters, A-Z in lower case, and of characters beyond ASCII.
    Every group also has a row with a null term and its number of documents in ``df``.
    """

    columns = ["lang", "source", "term", "df", "count"]

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pa.compute.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64)
            shard = np.cumsum(size) // SHARD
            cuts = [0, *(np.nonzero(np.diff(shard))[0] + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                part = batch.slice(lo, hi - lo)
                langs, sources = part["lang"].dictionary_encode(), part["source"].dictionary_encode()
                both = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
                codes, group, docs_of = np.unique(both, return_inverse=True, return_counts=True)
                lang_of = langs.dictionary.take(pa.array(codes // max(1, len(sources.dictionary))))
                source_of = sources.dictionary.take(pa.array(codes % max(1, len(sources.dictionary))))
                found = count_words(part["text"], group)
                yield pa.RecordBatch.from_arrays([lang_of.take(found["group"]), source_of.take(found["group"]), *found.columns[1:]], names=columns)
                docs_of = pa.array(docs_of, pa.int64())
                yield pa.RecordBatch.from_arrays([lang_of, source_of, pa.nulls(len(codes), pa.string()), docs_of, docs_of], names=columns)

    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(plain(text).alias("text"), plain(lang).alias("lang"), plain(source).alias("source"))
    found = rows.mapInArrow(shards, "lang string, source string, term string, df long, count long")
    return materialize(found.groupBy("lang", "source", "term").agg(F.sum("df").alias("df"), F.sum("count").alias("count")), "term-counts")


def share(count: str, total: str, kept: str) -> Column:
    """Smoothed share of a term in billionths, floored, exactly: ``1 + UNIT * (count + 5) // (total + 5 * kept)``."""
    over = f"cast(greatest({total} + 5 * {kept}, 1) AS decimal(20, 0))"
    return F.expr(f"1L + (cast({UNIT} AS decimal(10, 0)) * cast({count} + 5 AS decimal(20, 0))) div {over}")


def _distances(frame: pd.DataFrame) -> pd.DataFrame:
    """Sums over the terms of a tile of the absolute differences between its sources; of two blocks only the pairs across."""
    marks = frame[frame["term"].isna()].drop_duplicates("source").sort_values("source")
    names, block = marks["source"].to_numpy(), marks["block"].to_numpy()
    present = frame[frame["term"].notna()]
    at, terms = pd.factorize(present["term"])
    table = np.repeat(marks["p"].to_numpy(np.int64)[:, None], len(terms), axis=1)
    table[pd.Index(names).get_indexer(present["source"]), at] = present["p"].to_numpy(np.int64)
    left = np.nonzero(block == frame["i"].iloc[0])[0]
    right = np.nonzero(block == frame["j"].iloc[0])[0]
    same = frame["i"].iloc[0] == frame["j"].iloc[0]
    out = []
    for k, a in enumerate(left):
        others = right[k + 1 :] if same else right
        out.append(pd.DataFrame({"a": names[a], "b": names[others], "value": np.abs(table[others] - table[a]).sum(axis=1)}))
    found = pd.concat(out, ignore_index=True) if out else pd.DataFrame({"a": [], "b": [], "value": []})
    return found.assign(lang=frame["lang"].iloc[0])[["lang", "a", "b", "value"]]


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = 30, top: int = 50) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how the sources of each language differ in the shares of its terms.

    A language keeps the terms of at least ``least`` of its documents. Part
    ``pair`` gives for each group (lang, source) every other source of the
    language with the sum of the absolute differences of their shares; part
    ``term`` the ``top`` terms whose share in the group lies most above that in
    the language. Shares are whole billionths (``share``); ranks begin with 1,
    larger values first, ties by item.

    Terms are counted per shard by sorting pointers to their starts and added up
    by term. Sources are compared in tiles of about ``TERMS`` terms by twice
    ``SOURCES`` sources, each tile a task's matrix; a term that a source lacks
    has its share for none. Null text, lang and source count as ''. Repeated rows
    count each; groups without terms are there, with the shares for none. In a
    language without kept terms every distance is 0. An empty table gives no rows.
    """
    counts = term_counts(docs, text, lang, source)
    terms = counts.where("term IS NOT NULL")
    kept = terms.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("count").alias("total")).where(F.col("df") >= least)
    kept = materialize(kept.select("lang", "term", "total"), "kept-terms")
    cells = materialize(terms.join(kept, ["lang", "term"]).select("lang", "source", "term", "count", "total"), "kept-cells")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("all"))
    groups = counts.where("term IS NULL").select("lang", "source").join(
        cells.groupBy("lang", "source").agg(F.sum("count").alias("n")), ["lang", "source"], "left"
    ).join(langs, "lang", "left")
    zero = F.lit(0).cast("long")
    groups = groups.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("n", "v", "all")])
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    groups = groups.join(sizes, "lang").select(
        "lang", "source", "n", "v", "all",
        F.greatest(F.ceil(F.col("v") / TERMS), F.lit(1)).cast("int").alias("tiles"), F.ceil(F.col("sources") / SOURCES).cast("int").alias("blocks"),
    )
    groups = materialize(groups, "groups").withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
    shares = cells.join(groups, ["lang", "source"]).withColumn("p", share("count", "n", "v"))

    tile = F.pmod(F.xxhash64("term"), F.col("tiles")).cast("int")
    present = shares.select("lang", "source", "term", "p", "block", "blocks", tile.alias("tile"))
    absent = groups.select(
        "lang", "source", F.lit(None).cast("string").alias("term"), share("0", "n", "v").alias("p"), "block", "blocks",
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"),
    )
    dealt = present.unionByName(absent).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("lang", "source", "term", "p", "block", "tile", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    sums = dealt.groupBy("lang", "tile", "i", "j").applyInPandas(_distances, "lang string, a string, b string, value long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pairs = sums.select("lang", F.explode(both).alias("s"), "value").select("lang", "s.source", "s.item", "value")
    ranked = lambda rows: rows.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    )
    above = shares.withColumn("q", share("total", "`all`", "v")).where("p > q")
    above = ranked(above.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))).where(F.col("rank") <= top)
    parts = ranked(pairs).withColumn("part", F.lit("pair")).unionByName(above.withColumn("part", F.lit("term")))
    return parts.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
