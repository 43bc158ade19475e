"""Profiles, statistics and chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from featloom.operators import profile as op
from featloom.operators.order_stats import long_values
from featloom.operators.temporal import add_year_count
from featloom.queries.cleaning import RELEASE, release_years
from featloom.queries.registry import MOVIES, NUMBERS, Tables, query, r, rounded

STATS = ("numVotes", "runtimeMinutes", "startYear")
LONG = "(" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v, label FROM {NUMBERS}" for c in STATS) + ")"
LONG = f"(SELECT * FROM {LONG} WHERE v IS NOT NULL)"


@query("movies_in_year", f"""SELECT tconst, releaseYear, CASE WHEN releaseYear IS NOT NULL THEN
          count(*) OVER (PARTITION BY releaseYear) END AS movies_in_year FROM {RELEASE}""")
def movies_in_year(t: Tables):
    return add_year_count(release_years(t))


@query("label_rate_by_title", f"SELECT primaryTitle AS title, round(avg(label::INTEGER), 6) AS label_rate FROM {MOVIES} GROUP BY 1")
def label_rate_by_title(t: Tables):
    return op.mean_by(t.movies, "primaryTitle", "label", "label_rate").select(
        F.col("primaryTitle").alias("title"), r("label_rate").alias("label_rate")
    )


@query("value_counts", f"SELECT startYear, count(*) AS n FROM {NUMBERS} WHERE startYear IS NOT NULL GROUP BY 1 ORDER BY 1")
def value_counts(t: Tables):
    return op.value_counts(t.numbers, ["startYear"]).orderBy("startYear")


@query("value_counts_text", "SELECT role, count(*) AS n FROM conversations GROUP BY 1 ORDER BY n DESC, role")
def value_counts_text(t: Tables):
    return op.value_counts(t.conversations, ["role"]).orderBy(F.col("n").desc(), "role")


@query(
    "binned_counts",
    f"""WITH v AS (SELECT numVotes AS v FROM {NUMBERS} WHERE numVotes IS NOT NULL),
          b AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
          s AS (SELECT unnest(range(CAST(ceil((hi - lo) / 25000) AS BIGINT))) AS i, lo FROM b)
        SELECT concat(lo + i * 25000, '-', lo + i * 25000 + 24999) AS bin,
          (SELECT count(*) FROM v WHERE v.v >= lo + i * 25000 AND v.v < lo + (i + 1) * 25000) AS n FROM s""",
)
def binned_counts(t: Tables):
    return op.binned_counts(t.numbers, "numVotes", 25000)


@query("null_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing,
        round((count(*) - count({c})) * 100.0 / count(*), 2)::DOUBLE AS percent FROM {NUMBERS}"""
    for c in ("tconst", *STATS, "label")
))
def null_profile(t: Tables):
    return op.null_profile(t.numbers)


@query("class_balance", f"SELECT label, count(*) AS n FROM {NUMBERS} GROUP BY 1 ORDER BY n DESC, label")
def class_balance(t: Tables):
    return op.class_balance(t.numbers, "label")


@query("label_value_pairs", f"""SELECT label, numVotes, round(log10(numVotes), 6) AS log_value FROM {NUMBERS}
        WHERE numVotes IS NOT NULL AND label IS NOT NULL""")
def label_value_pairs(t: Tables):
    return rounded(op.label_value_pairs(t.numbers, "label", "numVotes"), "log_value")


# --- robust statistics -----------------------------------------------------


def _robust_sql(source: str, by: str) -> str:
    """One wide row of statistics per group of ``by`` over rows (by, v)."""
    return f"""(SELECT {by}, count(*) AS n, min(v) AS lo, max(v) AS hi, avg(v) AS mean, stddev_samp(v) AS std,
        quantile_cont(v, 0.25) AS p25, median(v) AS median, quantile_cont(v, 0.75) AS p75, mad(v) AS mad,
        avg(v) FILTER (WHERE rn > cut AND rn <= cnt - cut) AS trimmed
      FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY v) AS rn, count(*) OVER (PARTITION BY {by}) AS cnt,
              CAST(floor(0.1 * count(*) OVER (PARTITION BY {by})) AS BIGINT) AS cut FROM {source}) GROUP BY {by})"""


ROBUST = _robust_sql(LONG, '"column"')
METRIC_SQL = (("Mean", "mean"), ("Standard Deviation", "std"), ("Median", "median"), ("MAD", "mad"), ("Trimmed Mean", "trimmed"))


@query("robust_stats", " UNION ALL ".join(
    f"SELECT '{m}' AS metric, round({c}, 4) AS value FROM {ROBUST} WHERE \"column\" = 'numVotes'" for m, c in METRIC_SQL
))
def robust_stats(t: Tables):
    return rounded(op.robust_stats(t.numbers, "numVotes"), "value", digits=4)


BY_LABEL = _robust_sql(f"(SELECT * FROM {LONG} WHERE \"column\" = 'runtimeMinutes' AND label IS NOT NULL)", "label")


@query("robust_stats_by_label", " UNION ALL ".join(
    f"SELECT label, '{m}' AS metric, round({c}, 4) AS value FROM {BY_LABEL}" for m, c in METRIC_SQL
))
def robust_stats_by_label(t: Tables):
    return rounded(op.robust_stats(t.numbers, "runtimeMinutes", ["label"]), "value", digits=4)


@query("iqr_outliers", f"""SELECT s."column", any_value(p25) AS p25, any_value(p75) AS p75,
          any_value(p25 - 1.5 * (p75 - p25)) AS iqr_low, any_value(p75 + 1.5 * (p75 - p25)) AS iqr_high,
          count(*) FILTER (WHERE v < p25 - 1.5 * (p75 - p25) OR v > p75 + 1.5 * (p75 - p25)) AS iqr_outliers
        FROM {ROBUST} s JOIN {LONG} l ON s."column" = l."column" GROUP BY 1""")
def iqr_outliers(t: Tables):
    return op.outlier_counts(t.numbers, STATS, deviations=False).select("column", "p25", "p75", "iqr_low", "iqr_high", "iqr_outliers")


LINES = """(SELECT 'l_extendedprice' AS "column", l_extendedprice AS v FROM lineitem
            UNION ALL SELECT 'l_discount', l_discount FROM lineitem)"""


@query("mad_outliers", f"""SELECT s."column", round(any_value(median), 4) AS median, round(any_value(mad), 4) AS mad,
          count(*) FILTER (WHERE v < median - 3 * mad OR v > median + 3 * mad) AS mad_outliers
        FROM {_robust_sql(LINES, '"column"')} s JOIN {LINES} l ON s."column" = l."column" GROUP BY 1""")
def mad_outliers(t: Tables):
    out = op.outlier_counts(t.lineitem, ["l_extendedprice", "l_discount"]).select("column", "median", "mad", "mad_outliers")
    return rounded(out, "median", "mad", digits=4)


@query("describe", f"""SELECT "column", n AS "count", round(mean, 4) AS mean, round(std, 4) AS std, lo AS "min", p25,
          median AS p50, p75, hi AS "max" FROM {ROBUST}""")
def describe(t: Tables):
    return rounded(op.describe(t.numbers, STATS), "mean", "std", digits=4)


CORR = ("numVotes", "runtimeMinutes", "startYear", "label")


@query("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}::DOUBLE, {b}::DOUBLE), 6) AS r FROM {NUMBERS}".replace("label::DOUBLE", "label::INT::DOUBLE")
    for a in CORR for b in CORR
))
def corr_matrix(t: Tables):
    return rounded(op.correlation_matrix(t.numbers, CORR), "r")


COMPLETE = f"(SELECT * FROM {NUMBERS} WHERE {' AND '.join(f'{c} IS NOT NULL' for c in CORR)})"


@query("corr_matrix_complete", " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}::DOUBLE, {b}::DOUBLE), 6) AS r FROM {COMPLETE}".replace("label::DOUBLE", "label::INT::DOUBLE")
    for a in CORR for b in CORR
))
def corr_matrix_complete(t: Tables):
    return rounded(op.complete_correlation_matrix(t.numbers, CORR), "r")


def _profile_sql() -> str:
    parts = []
    kinds = {"tconst": "bigint", "numVotes": "bigint", "runtimeMinutes": "bigint", "startYear": "bigint", "label": "boolean"}
    for c, kind in kinds.items():
        src = f"(SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM {NUMBERS} WHERE {c} IS NOT NULL)"
        numeric = kind != "boolean"
        stat = lambda e: e if numeric else "NULL"
        parts.append(f"""SELECT '{c}' AS "column", '{kind}' AS data_type, count(*) AS total, count(*) - count({c}) AS missing,
            round((count(*) - count({c})) * 100.0 / count(*), 2)::DOUBLE AS missing_percent,
            count(DISTINCT {c}) AS unique_values, count({c}) - count(DISTINCT {c}) AS duplicates,
            {stat(f'''(SELECT count(*) FILTER (WHERE v < p25 - 1.5 * (p75 - p25) OR v > p75 + 1.5 * (p75 - p25))
               FROM {src} a, (SELECT quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.75) AS p75 FROM {src}) q)''')}::BIGINT AS iqr_outliers,
            {stat(f'''(SELECT count(*) FILTER (WHERE v < md - 3 * ma OR v > md + 3 * ma)
               FROM {src} a, (SELECT median(v) AS md, mad(v) AS ma FROM {src}) q)''')}::BIGINT AS mad_outliers,
            {stat(f'(SELECT round(trimmed, 4) FROM {_robust_sql(src, chr(34) + "column" + chr(34))})')}::DOUBLE AS trimmed_mean,
            (SELECT string_agg(s, ',' ORDER BY s) FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS s FROM {NUMBERS}
               WHERE {c} IS NOT NULL ORDER BY s LIMIT 5)) AS sample_values FROM {NUMBERS}""")
    return " UNION ALL ".join(parts)


@query("profile_table", _profile_sql())
def profile_table(t: Tables):
    out = op.profile_table(t.numbers)
    return rounded(out, "trimmed_mean", digits=4).withColumn("sample_values", F.array_join("sample_values", ","))


K2_SQL = f"""(WITH m AS (SELECT "column", count(*)::DOUBLE AS n, avg(v) AS mu FROM {LONG} GROUP BY 1),
    c AS (SELECT l."column", any_value(n) AS n, avg((v - mu) ** 2) AS m2, avg((v - mu) ** 3) AS m3, avg((v - mu) ** 4) AS m4
          FROM {LONG} l JOIN m ON l."column" = m."column" GROUP BY 1),
    s AS (SELECT "column", n, m3 / m2 ** 1.5 AS g1, m4 / m2 ** 2 AS b2 FROM c),
    e AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
            3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS beta2,
            (b2 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))) AS x,
            6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb FROM s),
    f AS (SELECT *, sqrt(2 * (beta2 - 1)) - 1 AS w2, 6 + 8 / sb * (2 / sb + sqrt(1 + 4 / sb ** 2)) AS a FROM e),
    z AS (SELECT *, 1 / sqrt(0.5 * ln(w2)) * asinh(y / sqrt(2 / (w2 - 1))) AS z1,
            (1 - 2 / (9 * a) - sign(1 + x * sqrt(2 / (a - 4))) * (((1 - 2 / a) / abs(1 + x * sqrt(2 / (a - 4)))) ** (1.0 / 3.0)))
              / sqrt(2 / (9 * a)) AS z2 FROM f)
    SELECT "column", n::BIGINT AS n, g1, b2 - 3 AS g2, z1 * z1 + z2 * z2 AS k2 FROM z)"""


@query("normality_k2", f"""SELECT "column", n, round(g1, 6) AS skew, round(g2, 6) AS kurt, round(k2, 2) AS k2,
          round(exp(-k2 / 2), 6) AS p_value, exp(-k2 / 2) > 0.05 AS is_normal FROM {K2_SQL}""")
def normality_k2(t: Tables):
    """The test by moments, whatever the number of values."""
    out = op.normality(t.numbers, STATS).withColumn("p_value", F.exp(-F.col("k2") / 2))
    return out.select("column", "n", r("skew").alias("skew"), r("kurt").alias("kurt"), r("k2", 2).alias("k2"),
                      r("p_value").alias("p_value"), (F.col("p_value") > 0.05).alias("is_normal"))


def _horner(coefficients, x: str) -> str:
    out = repr(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = f"({out} * {x} + {c!r})"
    return out


def _quantile_sql(p: str) -> str:
    near, far = f"(0.180625 - ({p} - 0.5) * ({p} - 0.5))", f"(sqrt(-ln(least({p}, 1 - {p}))) - 1.6)"
    ratio = lambda parts, x: f"{_horner(parts[0], x)} / {_horner(parts[1], x)}"
    return f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * {ratio(op.MIDDLE, near)} ELSE sign({p} - 0.5) * {ratio(op.ENDS, far)} END"


def _tail_sql(z: str) -> str:
    above = f"{_horner(op.TAIL[1], f'(1 / (1 + {op.TAIL[0]} * abs({z})))')} * exp(-({z}) * ({z}) / 2) / sqrt(2 * pi())"
    return f"CASE WHEN {z} >= 0 THEN {above} ELSE 1 - {above} END"


W_SQL = f"""WITH v AS (SELECT 'p_size' AS "column", p_size::DOUBLE AS v FROM part UNION ALL SELECT 'p_retailprice', p_retailprice FROM part
      UNION ALL SELECT 's_acctbal', s_acctbal FROM supplier),
    s AS (SELECT "column", count(*)::DOUBLE AS n, avg(v) AS mean FROM v GROUP BY 1 HAVING count(*) BETWEEN 3 AND {op.W_ROWS - 1}),
    r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY v)::DOUBLE AS i FROM v JOIN s USING ("column")),
    p AS (SELECT *, (i - 0.375) / (n + 0.25) AS p, 0.625 / (n + 0.25) AS p1, 1.625 / (n + 0.25) AS p2 FROM r),
    m AS (SELECT *, {_quantile_sql('p')} AS m, {_quantile_sql('p1')} AS m1, {_quantile_sql('p2')} AS m2 FROM p),
    q AS (SELECT *, sum(m * m) OVER (PARTITION BY "column") AS s FROM m),
    a AS (SELECT *, {_horner(op.OUTER[0], '(1 / sqrt(n))')} - m1 / sqrt(s) AS a1, {_horner(op.OUTER[1], '(1 / sqrt(n))')} - m2 / sqrt(s) AS a2 FROM q),
    w AS (SELECT "column", n, sum(v * sign(m) * CASE WHEN least(i, n + 1 - i) = 1 THEN a1 WHEN least(i, n + 1 - i) = 2 AND n > 5 THEN a2
            ELSE abs(m) / CASE WHEN n > 5 THEN sqrt((s - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2))
                               ELSE sqrt((s - 2 * m1 * m1) / (1 - 2 * a1 * a1)) END END) AS b, sum((v - mean) * (v - mean)) AS ss FROM a GROUP BY ALL),
    t AS (SELECT "column", n, b * b / ss AS w, ln(1 - b * b / ss) AS y FROM w),
    z AS (SELECT *, CASE WHEN n <= 11 THEN (-ln({_horner(op.SMALL[0], 'n')} - y) - {_horner(op.SMALL[1], 'n')}) / exp({_horner(op.SMALL[2], 'n')})
            ELSE (y - {_horner(op.LARGE[0], 'ln(n)')}) / exp({_horner(op.LARGE[1], 'ln(n)')}) END AS z FROM t)
    SELECT "column", n::BIGINT AS n, round(w, 8) AS w, round({_tail_sql('z')}, 6) AS p_value FROM z"""


@query("shapiro_wilk", W_SQL)
def shapiro_wilk(t: Tables):
    values = long_values(t.part, ["p_size", "p_retailprice"]).unionByName(long_values(t.supplier, ["s_acctbal"]))
    out = op.w_statistics(values)
    return out.select("column", "n", r("w", 8).alias("w"), r("p_value").alias("p_value"))


def _bounds_sql(c: str) -> str:
    return f"""(SELECT CASE WHEN exp(-k2 / 2) > 0.05 THEN mean - 3 * std ELSE median - 3 * mad END AS lo,
        CASE WHEN exp(-k2 / 2) > 0.05 THEN mean + 3 * std ELSE median + 3 * mad END AS hi
        FROM {ROBUST} s JOIN {K2_SQL} k ON s."column" = k."column" WHERE s."column" = '{c}')"""


@query("clean_outliers", f"SELECT tconst, numVotes FROM {NUMBERS}, {_bounds_sql('numVotes')} WHERE numVotes BETWEEN lo AND hi")
def clean_outliers(t: Tables):
    return op.remove_outliers(t.numbers, ["numVotes"]).select("tconst", "numVotes")


@query("outlier_intersection", f"""SELECT tconst, numVotes, runtimeMinutes FROM {NUMBERS},
          {_bounds_sql('numVotes')} a, {_bounds_sql('runtimeMinutes')} b
        WHERE numVotes BETWEEN a.lo AND a.hi AND runtimeMinutes BETWEEN b.lo AND b.hi""")
def outlier_intersection(t: Tables):
    return op.remove_outliers(t.numbers, ["numVotes", "runtimeMinutes"]).select("tconst", "numVotes", "runtimeMinutes")


# --- charts ----------------------------------------------------------------

HISTOGRAM = """(WITH b AS (SELECT "column", min(v) AS lo, max(v) AS hi FROM {src} GROUP BY 1),
    c AS (SELECT l."column", CAST(least(floor((v - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin, count(*) AS n
          FROM {src} l JOIN b ON l."column" = b."column" GROUP BY ALL),
    s AS (SELECT *, CAST(unnest(range(30)) AS INTEGER) AS bin FROM b)
    SELECT s."column", s.bin, lo + s.bin * ((hi - lo) / 30) AS low, lo + (s.bin + 1) * ((hi - lo) / 30) AS high, coalesce(n, 0) AS n
    FROM s LEFT JOIN c ON s."column" = c."column" AND s.bin = c.bin)"""


@query("histogram", f"""SELECT "column", bin, round(low, 4) AS low, round(high, 4) AS high, n FROM {HISTOGRAM.format(src=LONG)}""")
def histogram(t: Tables):
    return rounded(op.histogram(t.numbers, STATS), "low", "high", digits=4)


@query("box_stats", f"""SELECT s."column", min(v) FILTER (WHERE v >= p25 - 1.5 * (p75 - p25)) AS whisker_low, any_value(p25) AS p25,
          any_value(median) AS median, any_value(p75) AS p75, max(v) FILTER (WHERE v <= p75 + 1.5 * (p75 - p25)) AS whisker_high,
          count(*) FILTER (WHERE v < p25 - 1.5 * (p75 - p25) OR v > p75 + 1.5 * (p75 - p25)) AS outliers
        FROM {ROBUST} s JOIN {LONG} l ON s."column" = l."column" GROUP BY 1""")
def box_stats(t: Tables):
    return op.box_stats(t.numbers, STATS)


PRICES = """(SELECT 'value' AS "column", value AS v FROM events)"""


@query("box_outliers", f"""SELECT l."column", v AS value FROM {PRICES} l,
          (SELECT quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.75) AS p75 FROM {PRICES})
        WHERE v < p25 - 1.5 * (p75 - p25) OR v > p75 + 1.5 * (p75 - p25)""")
def box_outliers(t: Tables):
    return op.box_outliers(t.events, ["value"])


@query("density_curve", f"""WITH h AS {HISTOGRAM.format(src=LONG)},
      t AS (SELECT "column", count(*) AS total, stddev_samp(v) * pow(count(*), -0.2) AS bw FROM {LONG} GROUP BY 1),
      g AS (SELECT "column", min(low) AS lo, max(high) AS hi FROM h GROUP BY 1),
      x AS (SELECT "column", lo + (hi - lo) * i / 199 AS x FROM g, range(200) r(i))
    SELECT x."column", round(x, 4) AS x,
      round(sum(n * exp(-0.5 * ((x - (low + high) / 2) / bw) ** 2)) / (any_value(total) * any_value(bw) * sqrt(2 * pi())), 8) AS density
    FROM x JOIN h ON x."column" = h."column" JOIN t ON x."column" = t."column" GROUP BY x."column", x""")
def density_curve(t: Tables):
    out = op.density_curve(t.numbers, STATS)
    return out.select("column", r("x", 4).alias("x"), r("density", 8).alias("density"))
