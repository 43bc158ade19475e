"""Exact order statistics of any size of column.

Medians, quartiles, median deviations and trimmed means all need the k-th
smallest value. The built-in exact percentile keeps every distinct value of a
group in one aggregation buffer, and a ranking window sorts a whole group in one
task; with a handful of groups (columns, labels) neither holds on a large table.

So the pass that takes counts and moments also takes a quantile sketch: cuts of
equal depth whose ranks are off by a known share at most. Each rank is bracketed
between two cuts, and the next pass counts what lies below each bracket and the
values inside it. Every value falls into one cell, so no row is multiplied, and the counts fix the exact value. Where a bracket may still hold
more than ``rank_rows`` values, that pass takes a sketch of the bracket instead
and the step repeats, so no group is ever held in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from featloom.functions.columns import to_double
from featloom.session import materialize

CUTS = 512
ACCURACY = 8192  # a cut's rank is off by at most 1/ACCURACY of its group, a small part of a step between cuts
MARGIN = 2  # steps between cuts on either side of a rank
RANK_ROWS = 5_000_000
GRID = [i / CUTS for i in range(CUTS + 1)]


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value) rows of all non-missing numbers, one scan for all columns."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), to_double(c).alias("value")) for c in columns])
    out = df.select(*by, F.explode(cells).alias("_cell")).select(*by, "_cell.column", "_cell.value")
    return out.dropna(subset=[*by, "value"])


def _cuts(value: Column | str) -> Column:
    return F.percentile_approx(value, GRID, ACCURACY)


def summarize(values: DataFrame, keys: Sequence[str], extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Row count, bounds, moments and sketch (``cuts``) per group in one pass."""
    v = F.col("value")
    return values.groupBy(*keys).agg(
        F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), _cuts(v).alias("cuts"),
        *[e.alias(name) for name, e in (extra or {}).items()],
    )


def _bracket(rank: Column, size: Column, cuts: Column) -> Column:
    """Two values between which the value of 0-based ``rank`` among ``size`` lies."""
    step = rank / F.greatest(size, F.lit(1)) * CUTS
    low = F.greatest(F.floor(step) - MARGIN, F.lit(0)).cast("int")
    high = F.least(F.ceil(step) + MARGIN, F.lit(CUTS)).cast("int")
    return F.struct(
        rank.cast("bigint").alias("rank"), cuts[low].alias("lo"), cuts[high].alias("hi"),
        F.ceil(size * (2 * MARGIN + 2) / CUTS).cast("bigint").alias("most"),
    )


def brackets(summary: DataFrame, keys: Sequence[str], ranks: Sequence[Column]) -> DataFrame:
    """(keys..., rank, lo, hi, most) for rank expressions over ``n``; ``most`` bounds the values in between."""
    ends = {"n": F.col("n"), "cuts": F.col("cuts")}
    made = F.transform(F.array_distinct(F.array(*[r.cast("bigint") for r in ranks])), lambda r: _bracket(r, ends["n"], ends["cuts"]))
    out = summary.select(*keys, "min", "max", F.explode(made).alias("_b")).select(*keys, "min", "max", "_b.*")
    # The ends of a sketch are the bounds of the group.
    lo = F.when(F.col("lo") <= F.col("min"), F.col("min")).otherwise(F.col("lo"))
    return out.select(*keys, "rank", lo.alias("lo"), F.col("hi"), "most")


def _wide(state: DataFrame, keys: Sequence[str], ranks: int) -> DataFrame:
    """(keys..., _lo0, _hi0, _lo1, ...): the brackets of a group in the order of their ranks, one row per group."""
    packed = state.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("rank", "lo", "hi"))).alias("_t"))
    ends = [F.get("_t", F.lit(k))[end].alias(f"_{end}{k}") for k in range(ranks) for end in ("lo", "hi")]
    return packed.select(*keys, *ends)


def _cell(value: Column, ranks: int) -> tuple[Column, Column]:
    """Number of the first bracket the value is not above, and the value where it lies inside; null where it lies below.

    A greater rank has a value no smaller, so the brackets in the order of their
    ranks put all values in order: by cell number, those below the bracket first.
    """
    number, place = F.lit(ranks), F.lit(None).cast("double")
    for k in reversed(range(ranks)):
        number = F.when(value <= F.col(f"_hi{k}"), k).otherwise(number)
        place = F.when(value < F.col(f"_lo{k}"), F.lit(None)).when(value <= F.col(f"_hi{k}"), value).otherwise(place)
    return number.cast("int"), place


def _met(values: DataFrame, keys: Sequence[str], state: DataFrame, ranks: int) -> DataFrame:
    """(keys..., cell, place): each value once."""
    cell, place = _cell(F.col("value"), ranks)
    return values.join(_wide(state, keys, ranks), list(keys)).select(*keys, cell.alias("cell"), place.alias("place"))


def order_statistics(values: DataFrame, keys: Sequence[str], state: DataFrame, ranks: int, rank_rows: int = RANK_ROWS) -> DataFrame:
    """(keys..., rank, value): the values at the ranks of ``brackets``, at most ``ranks`` in a group."""
    keys = list(keys)
    state = materialize(state, "brackets")
    before = None
    while True:
        most = state.where("lo < hi").agg(F.max("most")).first()[0] or 0
        if most <= rank_rows or most == before:
            break  # few enough values, or a bracket of few but very frequent ones, which are counted anyway
        before = most
        sketched = _met(values, keys, state, ranks).groupBy(*keys, "cell").agg(
            F.count_if(F.col("place").isNull()).alias("gap"), F.count("place").alias("inside"), _cuts("place").alias("cuts")
        )
        earlier = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        below = F.coalesce(F.sum(F.col("gap") + F.col("inside")).over(earlier), F.lit(0)) + F.col("gap")
        inner = _ranks_of(sketched.withColumn("below", below), keys, state, F.col("below"), F.col("below") + F.col("inside"))
        inner = inner.withColumn("_b", _bracket(F.col("rank") - F.col("below"), F.col("inside"), F.col("cuts")))
        inner = state.select(*keys, "rank", "lo", "hi").join(inner.select(*keys, "rank", "_b"), [*keys, "rank"])
        state = materialize(inner.select(*keys, "rank", F.greatest("lo", "_b.lo").alias("lo"), F.least("hi", "_b.hi").alias("hi"), "_b.most"), "brackets")
    counts = _met(values, keys, state, ranks).groupBy(*keys, "cell", "place").agg(F.count("*").alias("n"))
    return _picked(materialize(counts, "bracket-counts"), keys, state)


def _ranks_of(rows: DataFrame, keys: Sequence[str], state: DataFrame, first: Column, end: Column) -> DataFrame:
    """``rows`` once for each rank of their group from ``first`` to before ``end``."""
    packed = state.groupBy(*keys).agg(F.collect_set("rank").alias("_ranks"))
    held = F.filter("_ranks", lambda r: (r >= first) & (r < end))
    return rows.join(packed, list(keys)).select(*rows.columns, F.explode(held).alias("rank"))


def _picked(counts: DataFrame, keys: Sequence[str], state: DataFrame) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy("cell", F.col("place").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    counted = counts.withColumn("upto", F.sum("n").over(order))
    found = _ranks_of(counted, keys, state, F.col("upto") - F.col("n"), F.col("upto"))
    return found.select(*keys, "rank", F.col("place").alias("value"))


def _quantile_ranks(p: float):
    position = F.lit(float(p)) * (F.col("n") - 1)
    return F.floor(position), F.ceil(position), position - F.floor(position)


def _rank_map(picked: DataFrame, keys: Sequence[str]) -> DataFrame:
    return picked.groupBy(*keys).agg(F.map_from_entries(F.collect_set(F.struct("rank", "value"))).alias("_at"))


def _quantile(p: float):
    low, high, part = _quantile_ranks(p)
    at = F.col("_at")
    below, above = at[low.cast("bigint")], at[high.cast("bigint")]
    return below + (above - below) * part


def quantiles(
    values: DataFrame,
    keys: Sequence[str],
    probs: Mapping[str, float],
    rank_rows: int = RANK_ROWS,
    summary: DataFrame | None = None,
) -> DataFrame:
    """Linearly interpolated exact quantiles: the group summary plus one column per entry of ``probs``. Two reads."""
    keys = list(keys)
    summary = materialize(summarize(values, keys), "summary") if summary is None else summary
    ranks = [r for p in probs.values() for r in _quantile_ranks(p)[:2]]
    picked = order_statistics(values, keys, brackets(summary, keys, ranks), len(ranks), rank_rows)
    found = summary.join(_rank_map(picked, keys), keys).withColumns({name: _quantile(p) for name, p in probs.items()})
    return found.drop("_at", "cuts")


def fences() -> tuple[Column, Column]:
    reach = 1.5 * (F.col("p75") - F.col("p25"))
    return F.col("p25") - reach, F.col("p75") + reach


def robust_summary(
    values: DataFrame,
    keys: Sequence[str],
    trim: float = 0.1,
    rank_rows: int = RANK_ROWS,
    deviations: bool = True,
) -> DataFrame:
    """Count, bounds, mean, deviation, quartiles, trimmed mean, fence counts and, with ``deviations``, median deviation per group.

    Columns: n, min, max, mean, std, p25, median, p75, trimmed_mean,
    iqr_outliers, whisker_low, whisker_high; with deviations also mad and
    mad_outliers. Three reads of the values, four with deviations.
    """
    keys = list(keys)
    summary = materialize(summarize(values, keys), "summary")
    cut = F.floor(F.lit(trim) * F.col("n")).cast("bigint")
    ranks = [r for p in (0.25, 0.5, 0.75) for r in _quantile_ranks(p)[:2]] + [cut, F.col("n") - cut - 1]
    picked = order_statistics(values, keys, brackets(summary, keys, ranks), len(ranks), rank_rows)
    names = {"p25": _quantile(0.25), "median": _quantile(0.5), "p75": _quantile(0.75)}
    cuts = {"cut_lo": F.col("_at")[cut], "cut_hi": F.col("_at")[F.col("n") - cut - 1]}
    quartiles = summary.drop("cuts").join(_rank_map(picked, keys), keys).withColumns({**names, **cuts, "cut": cut}).drop("_at")
    quartiles = materialize(quartiles, "quartiles")

    # One more pass: trimmed sums, fences, and the sketch of the deviations.
    v = F.col("value")
    deviation = F.abs(v - F.col("median"))
    low, high = fences()
    centre = quartiles.select(*keys, "median", "p25", "p75", "cut_lo", "cut_hi")
    spread = [F.min(deviation).alias("dev_min"), F.max(deviation).alias("dev_max"), _cuts(deviation).alias("dev_cuts")] if deviations else []
    passed = (
        values.join(centre, keys)
        .groupBy(*keys)
        .agg(
            F.sum(F.when((v > F.col("cut_lo")) & (v < F.col("cut_hi")), v)).alias("inner_sum"),
            F.count_if(v <= F.col("cut_lo")).alias("n_low"),
            F.count_if(v >= F.col("cut_hi")).alias("n_high"),
            F.count_if((v < low) | (v > high)).alias("iqr_outliers"),
            F.min(F.when(v >= low, v)).alias("whisker_low"),
            F.max(F.when(v <= high, v)).alias("whisker_high"),
            *spread,
        )
    )
    # Ties with a cut value count as often as they remain after trimming.
    middle = (
        F.coalesce(F.col("inner_sum"), F.lit(0.0))
        + (F.col("n_low") - F.col("cut")) * F.col("cut_lo")
        + (F.col("n_high") - F.col("cut")) * F.col("cut_hi")
    ) / (F.col("n") - 2 * F.col("cut"))
    trimmed = F.when(F.col("cut_lo") == F.col("cut_hi"), F.col("cut_lo")).otherwise(middle)
    fenced = materialize(quartiles.join(passed, keys).withColumn("trimmed_mean", trimmed), "fences")
    shown = ["n", "min", "max", "mean", "std", "p25", "median", "p75", "trimmed_mean", "iqr_outliers", "whisker_low", "whisker_high"]
    if not deviations:
        return fenced.select(*keys, *shown)
    return _with_deviations(values, keys, fenced, rank_rows).select(*keys, *shown, "mad", "mad_outliers")


def _with_deviations(values: DataFrame, keys: list[str], fenced: DataFrame, rank_rows: int) -> DataFrame:
    """``fenced`` with the median deviation and the number of values more than three of it away: one read.

    The pass that counts the deviations inside the brackets also counts the values
    that lie beyond for every possible median deviation, and lists those few for
    which it matters.
    """
    deviation = F.abs(F.col("value") - F.col("median"))
    away = values.join(fenced.select(*keys, "median"), keys).select(*keys, F.col("value").alias("raw"), deviation.alias("value"))
    bounds = fenced.select(*keys, "n", F.col("dev_min").alias("min"), F.col("dev_max").alias("max"), F.col("dev_cuts").alias("cuts"))
    state = materialize(brackets(bounds, keys, _quantile_ranks(0.5)[:2]), "brackets")
    if (state.where("lo < hi").agg(F.max("most")).first()[0] or 0) > rank_rows:
        # Further narrowing takes passes of its own; the brackets then are the exact values.
        exact = order_statistics(away.drop("raw"), keys, state, 2, rank_rows)
        state = materialize(exact.select(*keys, "rank", F.col("value").alias("lo"), F.col("value").alias("hi"), F.lit(1).cast("bigint").alias("most")), "brackets")
    margin = 1e-9
    reach = state.groupBy(*keys).agg((3 * F.min("lo") * (1 - margin)).alias("_sure_in"), (3 * F.max("hi") * (1 + margin)).alias("_sure_out"))
    v = F.col("value")
    cell, place = _cell(v, 2)
    far = v >= F.col("_sure_in")
    # Written, so that its size is known: the values stay where they are if there are few groups.
    ends = materialize(_wide(state, keys, 2).join(reach, keys), "deviation-ends")
    counts = (
        away.join(ends, keys)
        .select(*keys, cell.alias("cell"), place.alias("place"), far.alias("far"), F.when(far & (v <= F.col("_sure_out")), F.col("raw")).alias("raw"))
        .groupBy(*keys, "cell", "place", "far", "raw").agg(F.count("*").alias("n"))
    )
    counts = materialize(counts, "deviation-counts")
    placed = counts.groupBy(*keys, "cell", "place").agg(F.sum("n").alias("n"))
    at = _rank_map(_picked(placed, keys, state), keys)
    mads = materialize(fenced.select(*keys, "n", "median").join(at, keys).select(*keys, "median", _quantile(0.5).alias("mad")), "deviations")
    raw = F.col("raw")
    beyond = raw.isNull() | (raw < F.col("median") - 3 * F.col("mad")) | (raw > F.col("median") + 3 * F.col("mad"))
    outside = counts.where("far").join(mads, keys).groupBy(*keys).agg(F.sum(F.when(beyond, F.col("n"))).alias("mad_outliers"))
    return fenced.join(mads.select(*keys, "mad"), keys).join(outside, keys, "left").withColumn(
        "mad_outliers", F.coalesce("mad_outliers", F.lit(0).cast("bigint"))
    )
