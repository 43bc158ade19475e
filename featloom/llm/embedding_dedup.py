"""Near-duplicate embeddings by sorted projection passes."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import materialize
from featloom.llm.graph import components
from featloom.llm.simhash import forest


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


DIRECTIONS = 32  # random directions of one hash; it tells the nearest of these and their opposites
HASHES = 10  # hashes in a key, 6 bits each
DEPTHS = 6  # hashes over which crowds are counted
MOST = 32  # turns that are always worth it
NUMBERS = 16_384  # numbers in a block of vectors that is compared as a whole


def residuals(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Unit vectors less the mean of their label: what tells vectors apart that share a direction."""
    return _unit(vectors) - centre


def sort_keys(rest: np.ndarray, turn: int, seed: int = 11) -> np.ndarray:
    """Concatenated random hashes as a number that sorts like their sequence; every turn draws its own.

    A hash is the nearest of random directions and their opposites.
    """
    planes = np.random.default_rng([seed, turn, rest.shape[1]]).standard_normal((HASHES, rest.shape[1], DIRECTIONS))
    out = np.zeros(len(rest), np.int64)
    for k in range(HASHES):
        along = rest @ planes[k]
        near = np.abs(along).argmax(axis=1)
        out = out << 6 | near << 1 | (along[np.arange(len(rest)), near] < 0)
    return out


@functools.lru_cache(maxsize=2048)
def agreement(cosine: float, draws: int = 20_000) -> float:
    """How often one hash agrees for two residuals of that cosine: a simulation with a fixed seed."""
    rng = np.random.default_rng(5)
    cosine = min(max(cosine, 0.0), 1.0)
    a = rng.standard_normal((draws, DIRECTIONS))
    b = cosine * a + np.sqrt(1 - cosine * cosine) * rng.standard_normal((draws, DIRECTIONS))
    i, j = np.abs(a).argmax(axis=1), np.abs(b).argmax(axis=1)
    at = np.arange(draws)
    return float(((i == j) & (a[at, i] * b[at, j] > 0)).mean())


def turns_needed(spread: float, depth: int, least: float, miss: float) -> int:
    """Turns after which a lone pair of cosine ``least`` is missed with probability ``miss`` at most.

    ``spread`` is the mean cosine of a label's vectors to each other, ``depth`` the
    number of hashes that thin a crowd out to the window: a pair is within the
    window of an order if it agrees in so many.
    """
    if not depth:
        return 1
    rest = (least - spread) / max(1 - spread, 1e-9)
    hit = agreement(round(min(max(rest, 0.0), 1.0), 3)) ** depth
    return 1 if hit >= 1 - miss else int(np.ceil(np.log(miss) / np.log1p(-max(hit, 1e-6))))


def plans(vectors: DataFrame, least: float, slack: float, window: int, miss: float) -> DataFrame:
    """``(label, size, centre, loose, turns)`` of every label and vector length, from all its vectors.

    The centre is the mean of the unit vectors, its square length their mean
    cosine. Crowds are counted over the keys of a first order: ``depth`` is the
    first number of hashes after which at least half of the vectors share them with
    no more than ``window``. ``loose`` is the cosine that groups are looked for at.
    """

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for (label, size), same in frame.groupby(["label", "size"], sort=False):
                total = _unit(np.stack(same["vec"].to_numpy())).sum(axis=0)
                yield pd.DataFrame({"label": label, "size": size, "at": np.arange(size), "v": total})

    rows = vectors.select("label", F.size("vec").alias("size"), "vec")
    counts = rows.groupBy("label", "size").agg(F.count("*").alias("n"))
    means = rows.mapInPandas(sums, "label string, size int, at int, v double").groupBy("label", "size", "at").agg(F.sum("v").alias("v"))
    means = means.join(counts, ["label", "size"]).groupBy("label", "size", "n").agg(F.array_sort(F.collect_list(F.struct("at", (F.col("v") / F.col("n")).alias("v")))).alias("c"))
    means = materialize(means.select("label", "size", "n", F.col("c.v").alias("centre")), "centres")
    keyed = rows.join(means.select("label", "size", "centre"), ["label", "size"]).mapInPandas(_first_keys, "label string, size int, bits long")
    prefixes = F.explode(F.array(*[F.struct(F.lit(k).alias("depth"), F.shiftright("bits", 6 * (HASHES - k)).alias("bits")) for k in range(1, DEPTHS + 1)]))
    crowds = keyed.select("label", "size", prefixes.alias("p")).groupBy("label", "size", "p.depth", "p.bits").agg(F.count("*").alias("c"))
    thin = crowds.groupBy("label", "size", "depth").agg(F.sum(F.when(F.col("c") <= window, F.col("c")).otherwise(0)).alias("thin"), F.sum("c").alias("n"))
    depth = thin.where(F.col("thin") * 2 >= F.col("n")).groupBy("label", "size").agg(F.min("depth").alias("depth"))
    spread = F.aggregate("centre", F.lit(0.0), lambda s, x: s + x * x)
    found = means.join(depth, ["label", "size"], "left").withColumn("spread", F.least(spread, F.lit(1.0)))
    found = found.withColumn("depth", F.when(F.col("n") <= window, 0).otherwise(F.coalesce("depth", F.lit(DEPTHS))))

    def turns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            needed = [turns_needed(s, d, least, miss) for s, d in zip(frame["spread"], frame["depth"])]
            yield frame.assign(turns=needed)[["label", "size", "n", "spread", "turns"]]

    planned = found.select("label", "size", "n", "spread", "depth").mapInPandas(turns, "label string, size int, n long, spread double, turns int")
    # Where the windows of so many orders hold more than all pairs of a label, these are compared: no window is needed.
    many = F.col("turns") > F.greatest(F.lit(MOST), F.col("n") / (2 * window))
    planned = planned.select("label", "size", (F.lit(least) - slack * (1 - F.col("spread"))).alias("loose"), F.when(many, 0).otherwise(F.col("turns")).alias("turns"))
    return materialize(planned.join(means.select("label", "size", "centre"), ["label", "size"]), "plans")


def _first_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        for (label, size), same in frame.groupby(["label", "size"], sort=False):
            rest = residuals(np.stack(same["vec"].to_numpy()), same["centre"].iloc[0])
            yield pd.DataFrame({"label": label, "size": size, "bits": sort_keys(rest, 0)})


def _pairs(a: np.ndarray, b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    return np.nonzero(a @ b.T >= least)


def _branches(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> pd.DataFrame:
    root = forest(len(ids), i, j)
    at = np.nonzero(root != np.arange(len(ids)))[0]
    return pd.DataFrame({"a": ids[at], "b": ids[root[at]]})


def window_links(vectors: DataFrame, turns: range, window: int) -> DataFrame:
    """Links that connect vectors of at least cosine ``loose`` at most ``window`` places apart in one of the sorted orders.

    ``vectors`` has ``(id, label, vec, centre, loose, turns)`` and distinct ids; a label
    takes part in its first ``turns`` orders. Every turn sorts by (size, label, key,
    id) across partitions; each task reads its sorted range in blocks of
    ``window``, compares a block with itself and the one before and emits a
    spanning forest. The first and last block of every range are written with it
    and compared across the border by a second, small job.
    """
    turns = list(turns)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for (_, size), same in frame.groupby(["label", frame["vec"].map(len)], sort=False):
                rest = residuals(np.stack(same["vec"].to_numpy()), same["centre"].iloc[0])
                for turn in turns:
                    if turn < same["turns"].iloc[0]:
                        yield same[["id", "label", "vec", "loose"]].assign(turn=np.int32(turn), size=np.int32(size), bits=sort_keys(rest, turn))

    kind = dict(vectors.dtypes)["vec"]
    dealt = vectors.where(F.col("turns") > turns[0]).select("id", "label", "vec", "centre", "loose", "turns")
    dealt = dealt.mapInPandas(spread, f"id long, label string, vec {kind}, loose double, turn int, size int, bits long")
    order = ["turn", "size", "label", "bits", "id"]
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    shape = f"a long, b long, part int, place int, id long, label string, vec {kind}, loose double, turn int"

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, waiting, first = None, None, True
        for frame in batches:
            waiting = frame if waiting is None else pd.concat([waiting, frame], ignore_index=True)
            while len(waiting) >= 2 * window:
                block, waiting = waiting.iloc[:window], waiting.iloc[window:]
                yield from _compare(last, block)
                if first:
                    yield _border(block, 0)
                last, first = block, False
        for block in ([waiting.iloc[:window], waiting.iloc[window:]] if waiting is not None else []):
            if len(block):
                yield from _compare(last, block)
                if first:
                    yield _border(block, 0)
                first, before, last = False, last, block
        if last is not None:
            tail = last if before is None else pd.concat([before, last]).iloc[-window:]
            yield _border(tail, 1)

    out = materialize(dealt.mapInPandas(compare, shape), "windows")
    seam = out.where("place is not null").withColumn("seam", F.col("part") + F.col("place") - 1)

    def across(frame: pd.DataFrame) -> pd.DataFrame:
        left, right = frame[frame.place == 1], frame[frame.place == 0]
        found = list(_compare(left, right)) if len(left) and len(right) else []
        return pd.concat([f[["a", "b"]] for f in found]) if found else pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})

    seams = seam.select("seam", "place", "id", "label", "vec", "loose", "turn").groupBy("seam").applyInPandas(across, "a long, b long")
    return out.where("a is not null").select("a", "b").unionByName(seams).distinct()


def _border(block: pd.DataFrame, place: int) -> pd.DataFrame:
    none = pd.Series(pd.array([None] * len(block), "Int64"), index=block.index)
    return pd.DataFrame({"a": none, "b": none, "part": block.part, "place": place, "id": block.id, "label": block.label, "vec": block.vec, "loose": block.loose, "turn": block.turn})


def _compare(last: pd.DataFrame | None, block: pd.DataFrame) -> Iterator[pd.DataFrame]:
    both = block if last is None else pd.concat([last, block], ignore_index=True)
    for _, same in both.groupby(["turn", "label", both["vec"].map(len)], sort=False):
        if len(same) < 2:
            continue
        unit, ids = _unit(np.stack(same["vec"].to_numpy())), same["id"].to_numpy(np.int64)
        i, j = _pairs(unit, unit, same["loose"].iloc[0])
        links = _branches(ids, i, j)
        if len(links):
            empty = pd.array([None] * len(links), "Int64")
            yield links.assign(part=empty, place=empty, id=empty, label=None, vec=None, loose=np.nan, turn=empty)


def exact_links(grouped: DataFrame, least: float, numbers: int = NUMBERS) -> DataFrame:
    """``(a, b, n)`` inside groups: ``n`` links of vector ``a`` (copies counted) in one pair of blocks, ``b`` a branch of its forest or null.

    ``grouped`` has ``(group, id, copies, vec)``. A group is dealt by hash into
    blocks of about ``numbers`` numbers (256 vectors of 64), each packed into one
    row; every pair of blocks is one row of two packed sides, compared by a matrix
    product. A group of n such vectors so moves n * n / 256 of them. Only counts and
    spanning forests come out, whatever the size of the group.
    """
    sizes = grouped.groupBy("group").agg(F.ceil(F.sum(F.size("vec")) / numbers).cast("int").alias("blocks"))
    sizes = materialize(sizes, "group-sizes")
    mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    # Dealt by block, not by group: a group of any size is spread over as many tasks as it has blocks.
    dealt = grouped.join(sizes, "group").withColumn("mine", mine).repartition("group", "mine")
    packed = dealt.groupBy("group", "blocks", "mine").agg(
        F.collect_list(F.struct("id", "copies", "vec")).alias("rows")
    )
    packed = materialize(packed, "packed-vectors")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    sides = packed.select("group", "mine", other.alias("other"), "rows").select(
        "group", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "rows"
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        rows = [[(r["id"], r["copies"], r["vec"]) for r in side] for side in frame.sort_values("mine")["rows"]]
        own = rows[0] if len(rows) == 1 else rows[0] + rows[1]
        ids, copies = np.array([r[0] for r in own], np.int64), np.array([r[1] for r in own], np.int64)
        unit = _unit(np.stack([r[2] for r in own]))
        near = unit @ unit.T >= least
        if len(rows) == 2:  # pairs inside one block are counted with that block alone
            k = len(rows[0])
            near[:k, :k] = near[k:, k:] = False
        np.fill_diagonal(near, False)
        i, j = np.nonzero(near)
        root = forest(len(ids), i, j)
        n = near @ copies + (copies - 1 if len(rows) == 1 else 0)
        return pd.DataFrame({"a": ids, "b": ids[root], "n": n})

    return sides.groupBy("group", "i", "j").applyInPandas(compare, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.98,
                    slack: float = 0.02, miss: float = 1e-3, window: int = 256, turns_at_once: int = 4) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` for every row.

    Two vectors link when their labels are equal and not null and their cosine in
    double precision is at least ``least``. Equal vectors of a label are one
    vector with copies. Sorted passes with bounded windows find groups at a
    looser cosine, where a vector near a dense group meets many of its members;
    inside the groups every pair is then compared, so that counts and components
    rest on all pairs of a group and no window bounds them. Every label has as many
    passes as its size and spread ask for (``plans``), so that a pair of exactly
    ``least`` that shares no group with others is missed with probability ``miss``.

    Vectors that are null, empty, zero, or hold a null or a non-finite component,
    and rows without a label, link with nothing. Rows with a null key take part
    in no link and keep a null component; repeated keys count as several rows and
    share the smallest component. Vectors of different length never link.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vec"), F.col(label).cast("string").alias("label"))
    clean = F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0) & F.exists("vec", lambda x: x != 0) & F.forall(
        "vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    rows = rows.withColumn("ok", F.coalesce(clean, F.lit(False)))
    distinct = rows.where("ok").groupBy("label", "vec").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    distinct = materialize(distinct.withColumn("first", F.col("id")).withColumn("id", F.monotonically_increasing_id()), "distinct-vectors")
    planned = plans(distinct, least, slack, window, miss)
    ready = materialize(distinct.withColumn("size", F.size("vec")).join(planned, ["label", "size"]), "planned-vectors")
    last = planned.agg(F.max("turns")).head()[0] or 0
    loose = [materialize(window_links(ready, range(b, min(last, b + turns_at_once)), window), "loose-links") for b in range(0, last, turns_at_once)]
    links = reduce(DataFrame.unionByName, loose) if loose else ready.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    found = components(links).select(F.col("node").alias("id"), F.concat(F.lit("g"), "root").alias("group"))
    whole = ready.where("turns = 0").select("id", F.concat(F.lit("l"), F.sha2(F.concat_ws(":", F.col("size").cast("string"), "label"), 256)).alias("group"))
    members = distinct.join(found.unionByName(whole), "id")
    exact = materialize(exact_links(members.select("group", "id", "copies", "vec"), least), "exact-links")
    counts = exact.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    roots = components(exact.where("a <> b").select("a", "b"))
    joined = distinct.join(counts, "id", "left").join(roots.select(F.col("node").alias("id"), "root"), "id", "left").select(
        "id", "label", "vec", "first", F.coalesce("n", F.col("copies") - 1).alias("n"), F.coalesce("root", "id").alias("root")
    )
    joined = materialize(joined, "vector-groups")
    named = joined.groupBy("root").agg(F.min("first").alias("component"))
    joined = joined.join(named, "root").select("label", "vec", "n", "component")
    whole = rows.where("ok").join(joined, ["label", "vec"]).select("id", "n", "component")
    alone = rows.where("not ok").select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("component"))
    return whole.unionByName(alone).select(
        F.col("id").alias(key), F.col("n").alias("n_links"), F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept")
    )
