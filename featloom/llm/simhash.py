"""SimHash near-duplicates with bit-sliced comparison of fingerprints."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import materialize
from featloom.llm.graph import components

BITS = 64
_PART = 65_536  # shingle hashes unpacked at a time
_WORDS = 65_536  # words of candidates compared at a time


def shingle_hashes(text: str | None, width: int = 3, seed: int = 42) -> np.ndarray:
    """Unsigned 64-bit hashes of the shingles of ``width`` words, repeats included; none for a text without words.

    Words are runs of characters other than ASCII white space, A-Z in lower case.
    Texts of fewer words have one shingle, the whole sequence.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, "<u8")
    width = min(width, len(words))
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(flat[s:e], seed) for s, e in zip(starts, ends[width - 1 :].tolist())], "<u8")


def fingerprint_of(text: str | None, width: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of ``shingle_hashes``; 0 for a text without words."""
    hashes = shingle_hashes(text, width, seed)
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), _PART):
        ones += np.unpackbits(hashes[k : k + _PART].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: Column | str, width: int = 3, seed: int = 42) -> Column:
    """SimHash of a text column as a signed long with the same 64 bits."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, width, seed) for t in texts], np.uint64).view(np.int64))

    return of(text)


def linked(prints: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``(i, j)`` with ``starts[i] <= j < i`` whose prints differ in at most ``radius`` bits.

    Bit planes are stored vertically: word ``w`` of plane ``b`` has bit ``b`` of
    64 neighbouring prints. For each print and each word of 64 candidates, the
    planes that differ are added to 64 distances at once by carry-save counters.
    A word is abandoned as soon as all its distances exceed the radius.
    """
    n = len(prints)
    padded = np.zeros(-(-n // 64) * 64, "<u8")
    padded[:n] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")
    levels = max(1, radius.bit_length())
    found_i, found_j = [], []
    per = np.maximum((np.arange(n) + 63) // 64 - starts // 64, 0)  # words of candidates before each print
    total = np.cumsum(per)
    bounds = np.unique(np.append(np.searchsorted(total, np.arange(0, total[-1], _WORDS)), n)) if n else []
    for lo, hi in zip([0, *bounds[:-1]], bounds):
        rows = np.arange(lo, hi)
        q = np.repeat(rows, per[rows])
        if not len(q):
            continue
        first = np.cumsum(per[rows]) - per[rows]
        w = np.arange(len(q)) - np.repeat(first, per[rows]) + np.repeat(starts[rows] // 64, per[rows])
        # candidates of the word that lie in [starts, q)
        low, high = np.maximum(starts[q] - w * 64, 0), np.minimum(q - w * 64, 64)
        ok = _below(high) & ~_below(low)
        mine = prints[q]
        over, count = ~ok, [np.zeros(len(q), "<u8") for _ in range(levels)]
        for b in range(BITS):
            carry = planes[b][w] ^ (np.uint64(0) - ((mine >> np.uint64(b)) & np.uint64(1)))
            for k in range(levels):
                count[k], carry = count[k] ^ carry, count[k] & carry
            over |= carry
            if radius + 1 < 1 << levels:
                over |= _exceeds(count, radius)
            if b % 8 == 7:
                alive = over != np.uint64(0xFFFFFFFFFFFFFFFF)
                if not alive.all():
                    q, w, mine, over, count = q[alive], w[alive], mine[alive], over[alive], [c[alive] for c in count]
        hit = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at, bit = np.nonzero(hit)
        found_i.append(q[at])
        found_j.append(w[at] * 64 + bit)
    empty = np.empty(0, np.int64)
    return (np.concatenate(found_i), np.concatenate(found_j)) if found_i else (empty, empty)


def _below(k: np.ndarray) -> np.ndarray:
    """A mask of the ``k`` lowest bits, ``k`` from 0 to 64."""
    k = np.asarray(k, np.int64)
    return np.where(k >= 64, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << np.clip(k, 0, 63).astype(np.uint64)) - np.uint64(1)).astype("<u8")


def _exceeds(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Where the bit-sliced numbers are greater than ``radius``."""
    more, same = np.zeros_like(count[0]), np.full_like(count[0], 0xFFFFFFFFFFFFFFFF)
    for k in reversed(range(len(count))):
        if radius >> k & 1:
            same &= count[k]
        else:
            more |= same & count[k]
            same &= ~count[k]
    return more


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For the numbers below ``n`` the smallest number that the pairs reach."""
    root = np.arange(n)
    while len(i):
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], least)
        np.minimum.at(new, root[j], least)
        new = new[new]
        while not np.array_equal(new, hop := new[new]):
            new = hop
        root = new[root]
        keep = root[i] != root[j]
        i, j = i[keep], j[keep]
    return root


def near_links(prints: DataFrame, column: str, radius: int = 3, parts: int = 5, block: int = 2048) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct prints which differ in at most ``radius`` bits.

    The 64 bits are cut into ``parts``; two prints within the radius agree in at
    least ``parts - radius`` of them, so every choice of so many parts is a table
    of buckets and no pair is missed. A bucket of more than ``block`` prints is
    dealt into hashed slices, and each pair of slices becomes a bucket of its own.
    What leaves a bucket are the branches of its spanning forest, never its pairs.
    """
    if not 0 <= radius < parts:
        raise ValueError("parts must exceed radius")
    cuts = [round(k * BITS / parts) for k in range(parts + 1)]
    masks = []
    for chosen in combinations(range(parts), parts - radius):
        mask = sum(((1 << cuts[k + 1]) - (1 << cuts[k])) for k in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keyed = prints.select(F.col(column).alias("print")).where("print is not null").distinct()
    keyed = materialize(keyed, "prints")
    tables = F.array(*[F.struct(F.lit(k).alias("choice"), F.col("print").bitwiseAND(F.lit(m)).alias("bits")) for k, m in enumerate(masks)])
    entries = keyed.select("print", F.explode(tables).alias("t")).select("print", "t.choice", "t.bits")
    large = entries.groupBy("choice", "bits").count().where(F.col("count") > block)
    large = materialize(large.select("choice", "bits", F.ceil(F.col("count") / (block // 2)).cast("int").alias("slices")), "large-buckets")
    entries = entries.join(large, ["choice", "bits"], "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    mine = F.pmod(F.xxhash64("print", "choice"), F.col("slices")).cast("int")
    entries = entries.select(
        "print", "choice", "bits", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("other")
    ).select("print", "choice", "bits", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    key = ["choice", "bits", "i", "j"]
    dealt = entries.repartition(*key).sortWithinPartitions(*key)

    def search(batches):
        kept = None
        for frame in batches:
            frame = frame if kept is None else pd.concat([kept, frame], ignore_index=True)
            new = (frame[key].to_numpy()[1:] != frame[key].to_numpy()[:-1]).any(axis=1).nonzero()[0] + 1
            if not len(new):
                kept = frame
                continue
            kept = frame.iloc[new[-1] :]
            yield _links(frame.iloc[: new[-1]], np.concatenate(([0], new[:-1])), radius)
        if kept is not None and len(kept):
            new = (kept[key].to_numpy()[1:] != kept[key].to_numpy()[:-1]).any(axis=1).nonzero()[0] + 1
            yield _links(kept, np.concatenate(([0], new)), radius)

    return dealt.mapInPandas(search, "a long, b long").distinct()


def _links(frame: pd.DataFrame, begins: np.ndarray, radius: int) -> pd.DataFrame:
    signed = frame["print"].to_numpy(np.int64)
    starts = np.repeat(begins, np.diff(np.append(begins, len(signed))))
    i, j = linked(signed.view(np.uint64), starts, radius)
    root = forest(len(signed), i, j)
    at = np.nonzero(root != np.arange(len(signed)))[0]
    return pd.DataFrame({"a": signed[at], "b": signed[root[at]]})


def groups(found: DataFrame, column: str = "print", radius: int = 3) -> DataFrame:
    """``(column, root)`` for every distinct print: prints that links connect share their root."""
    roots = components(near_links(found, column, radius))
    return found.select(column).where(F.col(column).isNotNull()).distinct().join(
        roots.select(F.col("node").alias(column), "root"), column, "left"
    ).select(column, F.coalesce("root", column).alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = 3, width: int = 3) -> DataFrame:
    """``docs`` columns ``key`` with ``print`` (long) and ``component``: the smallest key reached by links.

    One row for each input row. Null text counts as empty; texts without words
    have print 0 and link like any other. Repeated rows share print and component;
    rows with a null key keep a null key and do not name a component unless no
    other row is there (then it is null). Other columns are not read.
    """
    found = materialize(docs.select(F.col(key).alias("key"), fingerprint(F.col(text), width).alias("print")), "fingerprints")
    least = found.groupBy("print").agg(F.min("key").alias("least"))
    named = materialize(least.join(groups(found, "print", radius), "print"), "groups")
    component = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(component, "root").select("print", "component")
    return found.join(named, "print").select(F.col("key").alias(key), "print", "component")
