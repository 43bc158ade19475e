"""Column profiles, outliers, counts and the data behind the usual charts."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from featloom.functions import columns as fc
from featloom.functions import text as ft
from featloom.operators.order_stats import long_values, quantiles, robust_summary, summarize
from featloom.session import materialize

# Labels of the metrics.
METRICS = {"Mean": "mean", "Standard Deviation": "std", "Median": "median", "MAD": "mad", "Trimmed Mean": "trimmed_mean"}
HISTOGRAM_BINS = 30  # fixed value


# --- counts ----------------------------------------------------------------


def value_counts(df: DataFrame, columns: Sequence[str], alias: str = "n") -> DataFrame:
    """Rows per value; missing values are not counted."""
    return df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias(alias))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    return value_counts(df, [label]).orderBy(F.col("n").desc(), F.col(label).asc())


def mean_by(df: DataFrame, key: str, measure: str, alias: str) -> DataFrame:
    """Mean measure per key, missing keys dropped."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(F.col(measure).cast("double")).alias(alias))


def binned_counts(df: DataFrame, column: str, width: int) -> DataFrame:
    """Counts in left-closed bins of ``width`` starting at the minimum, labelled ``low-high``.

    When the range is a multiple of the width, the greatest value lies on the
    open end of the last bin and is not counted; all bins are listed.
    """
    value = F.col(column).cast("bigint")
    present = df.where(F.col(column).isNotNull()).select(value.alias("v"))
    bounds = materialize(
        present.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where("lo IS NOT NULL"), "bounds"
    ).first()
    if bounds is None:
        return present.select(F.lit("").alias("bin"), F.lit(0).cast("bigint").alias("n")).limit(0)
    lo, hi = bounds["lo"], bounds["hi"]
    bins = -(-(hi - lo) // width)
    index = F.floor((F.col("v") - lo) / width)
    counted = present.groupBy(index.alias("i")).agg(F.count("*").alias("n"))
    spine = df.sparkSession.range(bins).withColumnRenamed("id", "i")
    low = F.lit(lo) + F.col("i") * width
    return spine.join(counted, "i", "left").select(
        F.concat_ws("-", low, low + width - 1).alias("bin"), F.coalesce("n", F.lit(0)).alias("n")
    )


def label_value_pairs(df: DataFrame, label: str, value: str) -> DataFrame:
    """(label, value, log10 value) of complete rows, for a scatter chart."""
    pairs = df.dropna(subset=[label, value]).select(label, value)
    return pairs.withColumn("log_value", F.when(F.col(value) > 0, F.log10(value)))


# --- completeness ----------------------------------------------------------


def null_profile(df: DataFrame) -> DataFrame:
    """(column, missing, percent) for all columns in one pass."""
    row = df.agg(F.count("*").alias("total"), *[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in df.columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{c}").alias("missing")) for c in df.columns])
    return row.select("total", F.explode(cells).alias("_r")).select(
        "_r.column", "_r.missing", F.bround(F.col("_r.missing") / F.col("total") * 100, 2).alias("percent")
    )


def profile_table(df: DataFrame, samples: int = 5) -> DataFrame:
    """One row per column: type, counts, uniqueness, outliers, trimmed mean and sample values.

    String columns are first stripped, lower-cased and freed of missing tokens.
    All columns share the passes: (column, value) counts give uniqueness and
    samples, the long numeric form gives the statistics.
    """
    strings = fc.string_columns(df)
    cleaned = df.withColumns({c: ft.null_if_missing_token(ft.normalize_text(c)) for c in strings}) if strings else df

    def as_text(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = fc.nan_to_null(c) + F.lit(0.0)  # -0.0 and 0.0 are one value
        return c.cast("string")

    cells = F.array(*[
        F.struct(F.lit(i).alias("i"), as_text(f).alias("value")) for i, f in enumerate(cleaned.schema.fields)
    ])
    counted = cleaned.select(F.explode(cells).alias("_c")).select("_c.i", "_c.value").groupBy("i", "value").agg(
        F.count("*").alias("n")
    )
    counted = materialize(counted, "value-counts")  # read for the counts and for the samples
    present = F.col("value").isNotNull()
    counts = counted.groupBy("i").agg(
        F.sum("n").alias("total"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("missing"),
        F.count_if(present).alias("unique_values"),
        F.coalesce(F.sum(F.when(present, F.col("n") - 1)), F.lit(0)).alias("duplicates"),
    )
    # The rank limit is applied before the shuffle as well, so each task sends `samples` rows per column.
    smallest = Window.partitionBy("i").orderBy("value")
    sampled = (
        counted.where(present).withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= samples)
        .groupBy("i").agg(F.array_sort(F.collect_list("value")).alias("sample_values"))
    )
    names = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(cleaned.schema.fields)],
        "i int, column string, data_type string",
    )
    out = names.join(counts, "i", "left").join(sampled, "i", "left")
    numeric = fc.numeric_columns(cleaned, booleans=False)
    if numeric:
        stats = robust_summary(long_values(cleaned, numeric), ["column"])
        out = out.join(stats.select("column", "iqr_outliers", "mad_outliers", "trimmed_mean"), "column", "left")
    else:
        out = out.select(
            "*", F.lit(None).cast("bigint").alias("iqr_outliers"), F.lit(None).cast("bigint").alias("mad_outliers"),
            F.lit(None).cast("double").alias("trimmed_mean"),
        )
    percent = F.bround(F.col("missing") / F.col("total") * 100, 2)
    return out.select(
        "column", "data_type", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("missing", F.lit(0)).alias("missing"),
        percent.alias("missing_percent"), F.coalesce("unique_values", F.lit(0)).alias("unique_values"),
        F.coalesce("duplicates", F.lit(0)).alias("duplicates"), "iqr_outliers", "mad_outliers", "trimmed_mean",
        "sample_values",
    ).orderBy(F.col("missing_percent").desc(), F.col("column"))


# --- statistics ------------------------------------------------------------


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per column."""
    found = quantiles(long_values(df, columns), ["column"], {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return found.select("column", F.col("n").alias("count"), "mean", "std", "min", "p25", "p50", "p75", "max")


def robust_stats(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Long (by..., metric, value): mean, standard deviation, median, MAD, 10% trimmed mean."""
    wide = robust_summary(long_values(df, [column], by), [*by, "column"])
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).alias("value")) for m, c in METRICS.items()])
    return wide.select(*by, F.explode(cells).alias("_m")).select(*by, "_m.metric", "_m.value")


def outlier_counts(df: DataFrame, columns: Sequence[str], deviations: bool = True) -> DataFrame:
    """Quartile-fence and, with ``deviations``, median-deviation outlier counts with their bounds, per column."""
    s = robust_summary(long_values(df, columns), ["column"], deviations=deviations)
    reach = 1.5 * (F.col("p75") - F.col("p25"))
    fenced = ["column", "p25", "p75", (F.col("p25") - reach).alias("iqr_low"), (F.col("p75") + reach).alias("iqr_high"), "iqr_outliers"]
    if not deviations:
        return s.select(*fenced)
    return s.select(
        *fenced, "median", "mad", (F.col("median") - 3 * F.col("mad")).alias("mad_low"),
        (F.col("median") + 3 * F.col("mad")).alias("mad_high"), "mad_outliers",
    )


def box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    s = robust_summary(long_values(df, columns), ["column"], deviations=False)
    return s.select("column", "whisker_low", "p25", "median", "p75", "whisker_high", F.col("iqr_outliers").alias("outliers"))


def box_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The single points outside the quartile fences."""
    values = long_values(df, columns)
    q = materialize(quantiles(values, ["column"], {"p25": 0.25, "p75": 0.75}).select("column", "p25", "p75"))
    reach = 1.5 * (F.col("p75") - F.col("p25"))
    outside = (F.col("value") < F.col("p25") - reach) | (F.col("value") > F.col("p75") + reach)
    return values.join(q, "column").where(outside).select("column", "value")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x, y, r) for all pairs, each over the rows where both values are present; one pass."""
    pairs = list(itertools.combinations_with_replacement(columns, 2))
    doubles = df.select(*[fc.to_double(c).alias(c) for c in columns])
    row = doubles.agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"_{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
        for x, y in ({(a, b), (b, a)})
    ]
    return row.select(F.explode(F.array(*cells)).alias("_c")).select("_c.x", "_c.y", "_c.r")


def complete_correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x, y, r) for all pairs over the rows where every value is present.

    The vector form for wide tables: one pass with sums per pair of positions
    instead of an expression per pair. The driver gets d x d numbers.
    """
    doubles = df.select(*[fc.to_double(c).alias(c) for c in columns]).dropna()
    vectors = VectorAssembler(inputCols=list(columns), outputCol="_v").transform(doubles)
    matrix = Correlation.corr(vectors, "_v").first()[0]
    cells = [(x, y, float(matrix[i, j])) for i, x in enumerate(columns) for j, y in enumerate(columns)]
    return df.sparkSession.createDataFrame(cells, "x string, y string, r double")


def k2_statistic(n: Column, skew: Column, kurt: Column) -> Column:
    """D'Agostino-Pearson omnibus statistic from population skewness and excess kurtosis."""
    n = n.cast("double")
    y = skew * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta2 - 1)) - 1
    scaled = y / F.sqrt(2 / (w2 - 1))
    z_skew = F.ln(scaled + F.sqrt(scaled * scaled + 1)) / F.sqrt(0.5 * F.ln(w2))

    expected = 3 * (n - 1) / (n + 1)
    variance = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (kurt + 3 - expected) / F.sqrt(variance)
    root = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / root * (2 / root + F.sqrt(1 + 4 / (root * root)))
    spread = 1 + x * F.sqrt(2 / (a - 4))
    cube = F.signum(spread) * F.pow((1 - 2 / a) / F.abs(spread), F.lit(1.0 / 3.0))
    z_kurt = (1 - 2 / (9 * a) - cube) / F.sqrt(2 / (9 * a))
    return z_skew * z_skew + z_kurt * z_kurt


# Published rational approximation of the normal quantile (near the middle, and towards the ends).
MIDDLE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4, 4.5921953931549871457e4,
     6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4, 3.9307895800092710610e4,
     2.8729085735721942674e4, 5.2264952788528545610e3),
)
ENDS = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0, 1.27045825245236838258e0,
     2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1, 1.48103976427480074590e-1, 1.51986665636164571966e-2,
     5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
# Published coefficients of the W test: weights of the two outer ranks, then location and scale of its transform.
OUTER = ((0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056), (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633))
SMALL = ((-2.273, 0.459), (0.544, -0.39978, 0.025054, -6.714e-4), (1.3822, -0.77857, 0.062767, -0.0020322))
LARGE = ((-1.5861, -0.31082, -0.083751, 0.0038915), (-0.4803, -0.082676, 0.0030302))
# Published approximation of the normal tail.
TAIL = (0.2316419, (0.0, 0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429))
#: The W test serves columns of fewer values, the moments beyond.
W_ROWS = 5000


def polynomial(coefficients: Sequence[float], x: Column) -> Column:
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(c)
    return out


def normal_quantile(p: Column) -> Column:
    """The value below which a share ``p`` of the normal distribution lies, for shares no nearer to 0 or 1 than 1e-10."""
    q = p - 0.5
    near = 0.180625 - q * q
    far = F.sqrt(-F.ln(F.least(p, 1 - p))) - 1.6
    ratio = lambda parts, x: polynomial(parts[0], x) / polynomial(parts[1], x)
    return F.when(F.abs(q) <= 0.425, q * ratio(MIDDLE, near)).otherwise(F.signum(q) * ratio(ENDS, far))


def normal_tail(z: Column) -> Column:
    """The share of the normal distribution above ``z``, to seven places."""
    t = 1 / (1 + TAIL[0] * F.abs(z))
    above = polynomial(TAIL[1], t) * F.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    return F.when(z >= 0, above).otherwise(1 - above)


def w_statistics(values: DataFrame, keys: Sequence[str] = ("column",)) -> DataFrame:
    """(keys..., n, w, p_value) of the Shapiro-Wilk test, for every group of 3 to ``W_ROWS`` values at a time.

    Expected normal order statistics come from the rank, the weights from their
    squares summed over the group; ranks and sums are of fewer than ``W_ROWS`` rows a
    group, and the groups are spread over the tasks. Equal values have w = 1 and p = 1.
    """
    keys = list(keys)
    sizes = values.groupBy(*keys).agg(F.count("*").alias("n"), F.avg("value").alias("mean")).where(F.col("n").between(3, W_ROWS - 1))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("value"))
    ranked = values.join(materialize(sizes, "w-sizes"), keys).withColumn("i", rank.cast("double"))
    n, i = F.col("n").cast("double"), F.col("i")
    m = lambda at: normal_quantile((at - 0.375) / (n + 0.25))
    group = Window.partitionBy(*keys)
    ranked = ranked.withColumn("m", m(i)).withColumns({"squares": F.sum(F.col("m") * F.col("m")).over(group), "m1": m(F.lit(1.0)), "m2": m(F.lit(2.0))})
    s, m1, m2 = (F.col(c) for c in ("squares", "m1", "m2"))
    root = 1 / F.sqrt(n)
    a1 = polynomial(OUTER[0], root) - m1 / F.sqrt(s)
    a2 = polynomial(OUTER[1], root) - m2 / F.sqrt(s)
    wide = F.sqrt((s - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2))
    narrow = F.sqrt((s - 2 * m1 * m1) / (1 - 2 * a1 * a1))
    outer = F.least(i, n + 1 - i)
    size = F.when(n == 3, F.when(outer == 1, math.sqrt(0.5)).otherwise(0.0)).when(outer == 1, a1).when((outer == 2) & (n > 5), a2).otherwise(
        F.abs(F.col("m")) / F.when(n > 5, wide).otherwise(narrow)
    )
    weight = F.signum(F.col("m")) * size
    away = F.col("value") - F.col("mean")
    sums = ranked.groupBy(*keys, "n").agg(F.sum(weight * F.col("value")).alias("b"), F.sum(away * away).alias("ss"))
    w = F.when(F.col("ss") > 0, F.least(F.col("b") * F.col("b") / F.col("ss"), F.lit(1.0))).otherwise(F.lit(1.0))
    y = F.ln(1 - F.col("w"))
    gamma = polynomial(SMALL[0], n)
    few = F.when(y >= gamma, 0.0).otherwise(normal_tail((-F.ln(gamma - y) - polynomial(SMALL[1], n)) / F.exp(polynomial(SMALL[2], n))))
    many = normal_tail((y - polynomial(LARGE[0], F.ln(n))) / F.exp(polynomial(LARGE[1], F.ln(n))))
    three = F.greatest(F.lit(0.0), 6 / math.pi * (F.asin(F.sqrt(F.col("w"))) - math.asin(math.sqrt(0.75))))
    p = F.when(F.col("w") >= 1, 1.0).when(n == 3, three).when(n <= 11, few).otherwise(many)
    return sums.withColumn("w", w).select(*keys, "n", "w", p.alias("p_value"))


def _with_normality(summary: DataFrame, values: DataFrame, keys: Sequence[str] = ("column",)) -> DataFrame:
    """``summary`` with ``k2``, ``w`` and the ``p_value`` of the W test for fewer than ``W_ROWS`` values, of the moments beyond."""
    out = summary.withColumn("k2", k2_statistic(F.col("n"), F.col("skew"), F.col("kurt")))
    tested = w_statistics(values, keys).select(*keys, "w", F.col("p_value").alias("_p"))
    out = out.join(tested, list(keys), "left")
    out = out.withColumn("p_value", F.when(F.col("n") < W_ROWS, F.col("_p")).otherwise(F.exp(-F.col("k2") / 2))).drop("_p")
    return out.withColumn("is_normal", F.col("p_value") > 0.05)


def normality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n, skew, kurt, k2, w, p_value, is_normal) of all columns: Shapiro-Wilk below ``W_ROWS`` values, else by skewness and kurtosis."""
    values = long_values(df, columns)
    s = values.groupBy("column").agg(
        F.count("*").alias("n"), F.skewness("value").alias("skew"), F.kurtosis("value").alias("kurt")
    )
    return _with_normality(s, values)


def outlier_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Per column: mean +- 3 deviations where the values look normal, else median +- 3 MAD."""
    values = long_values(df, columns)
    keys = ["column"]
    moments = {"skew": F.skewness("value"), "kurt": F.kurtosis("value")}
    summary = materialize(summarize(values, keys, moments))
    tested = materialize(_with_normality(quantiles(values, keys, {"median": 0.5}, summary=summary), values))
    centre = tested.select("column", "median")
    deviations = values.join(centre, keys).select("column", F.abs(F.col("value") - F.col("median")).alias("value"))
    mads = quantiles(deviations, keys, {"mad": 0.5}).select("column", "mad")
    normal = F.coalesce(F.col("is_normal"), F.lit(False))
    middle = F.when(normal, F.col("mean")).otherwise(F.col("median"))
    reach = 3 * F.when(normal, F.col("std")).otherwise(F.col("mad"))
    rows = tested.join(mads, keys).select("column", (middle - reach).alias("lo"), (middle + reach).alias("hi")).collect()
    return {r["column"]: (r["lo"], r["hi"]) for r in rows}


def remove_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose values lie within the bounds of every given column (missing values are dropped).

    The bounds are a handful of numbers, so the filter is a plain range
    predicate that reaches the scan; several columns intersect without a join.
    """
    bounds = outlier_bounds(df, columns)
    keep = F.lit(True)
    for c in columns:
        keep = keep & (F.col(c).between(*bounds[c]) if c in bounds else F.lit(False))
    return df.where(keep)


# --- chart data ------------------------------------------------------------


def histogram(df: DataFrame, columns: Sequence[str], bins: int = HISTOGRAM_BINS) -> DataFrame:
    """(column, bin, low, high, n): equal-width bins over the value range, the last one closed."""
    values = long_values(df, columns)
    bounds = materialize(values.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi")))
    width = (F.col("hi") - F.col("lo")) / bins
    index = F.when(
        F.col("hi") > F.col("lo"), F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1))
    ).otherwise(F.lit(0))
    counted = values.join(bounds, "column").groupBy("column", index.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    spine = bounds.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return spine.join(counted, ["column", "bin"], "left").select(
        "column", "bin", (F.col("lo") + F.col("bin") * width).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("high"), F.coalesce("n", F.lit(0)).alias("n"),
    )


def density_curve(df: DataFrame, columns: Sequence[str], bins: int = HISTOGRAM_BINS, points: int = 200) -> DataFrame:
    """(column, x, density): Gaussian kernel over the histogram bins, Scott's bandwidth.

    The kernel sums ``bins`` weights per grid point, whatever the table size.
    """
    values = long_values(df, columns)
    spread = materialize(summarize(values, ["column"]).select("column", F.col("n").alias("total"), "std"))
    per_bin = histogram(df, columns, bins)
    packed = per_bin.groupBy("column").agg(
        F.min("low").alias("lo"), F.max("high").alias("hi"),
        F.array_sort(F.collect_list(F.struct(((F.col("low") + F.col("high")) / 2).alias("c"), F.col("n")))).alias("b"),
    ).join(spread, "column").where("std > 0")
    h = F.col("std") * F.pow(F.col("total").cast("double"), F.lit(-0.2))
    grid = packed.select(
        "*", h.alias("h"), F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")
    ).withColumn("x", F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("i") / (points - 1))
    z = lambda e: (F.col("x") - e["c"]) / F.col("h")
    total = F.aggregate("b", F.lit(0.0), lambda acc, e: acc + e["n"] * F.exp(-0.5 * z(e) * z(e)))
    return grid.select("column", "x", (total / (F.col("total") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"))
