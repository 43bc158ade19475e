"""Projections, filters, fills, de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from featloom.functions import columns as fc
from featloom.functions import text as ft
from featloom.operators import cleaning as op
from featloom.operators import model
from featloom.queries.registry import (
    AS_OF_YEAR, MISSING, MOVIES, NUMBERS, RAW_TITLES, Tables, query, r, sql_fold, sql_strip,
)

RAW_TEXT = ("startYear", "endYear", "numVotes", "runtimeMinutes", "primaryTitle", "originalTitle")


def _sql_token(c: str) -> str:
    return f"CASE WHEN lower({sql_strip(c)}) IN {MISSING} THEN NULL ELSE {c} END AS {c}"


@query("null_tokens_set", f"SELECT tconst, {', '.join(map(_sql_token, RAW_TEXT))} FROM {RAW_TITLES}")
def null_tokens_set(t: Tables):
    return op.unify_missing(t.raw_titles)


@query(
    "null_tokens_regex",
    "SELECT tconst, " + ", ".join(
        rf"CASE WHEN regexp_full_match({c}, '(?i)(\s*|\\N|\\n|nan|none|null|na|-|\?)') THEN NULL ELSE {c} END AS {c}"
        for c in RAW_TEXT
    ) + f" FROM {RAW_TITLES}",
)
def null_tokens_regex(t: Tables):
    return op.unify_missing(t.raw_titles, rule="pattern")


@query(
    "coerce_numeric",
    f"""SELECT tconst, TRY_CAST(startYear AS BIGINT) AS start_year,
          CASE WHEN lower(trim(numVotes)) = 'nan' THEN NULL ELSE TRY_CAST(numVotes AS DOUBLE) END AS votes,
          TRY_CAST(runtimeMinutes AS BIGINT) AS runtime FROM {RAW_TITLES}""",
)
def coerce_numeric(t: Tables):
    out = op.coerce_numeric(t.raw_titles, ["startYear", "runtimeMinutes"], integer=True)
    out = op.coerce_numeric(out, ["numVotes"])
    return out.select("tconst", F.col("startYear").alias("start_year"), F.col("numVotes").alias("votes"),
                      F.col("runtimeMinutes").alias("runtime"))


@query("normalize_titles", f"SELECT tconst, lower({sql_strip('primaryTitle')}) AS title FROM {RAW_TITLES}")
def normalize_titles(t: Tables):
    return op.clean_titles(t.raw_titles, "primaryTitle").select("tconst", F.col("primaryTitle").alias("title"))


@query("whitespace_clean", f"SELECT tconst, {sql_strip('primaryTitle')} AS title FROM {RAW_TITLES}")
def whitespace_clean(t: Tables):
    return op.clean_whitespace(t.raw_titles, "primaryTitle").select("tconst", F.col("primaryTitle").alias("title"))


@query(
    "clean_records",
    f"""SELECT tconst, CAST(TRY_CAST(startYear AS DOUBLE) AS DOUBLE) AS startYear, TRY_CAST(endYear AS DOUBLE) AS endYear,
          CASE WHEN lower(trim(numVotes)) = 'nan' THEN NULL ELSE TRY_CAST(numVotes AS DOUBLE) END AS numVotes,
          TRY_CAST(runtimeMinutes AS DOUBLE) AS runtimeMinutes, lower({sql_strip('primaryTitle')}) AS primaryTitle,
          CASE WHEN lower({sql_strip('originalTitle')}) IN {MISSING} THEN NULL ELSE lower({sql_strip('originalTitle')}) END
            AS originalTitle
        FROM {RAW_TITLES}""",
)
def clean_records(t: Tables):
    return op.clean_records(t.raw_titles)


@query(
    "split_camel",
    """SELECT p_partkey, upper(p_name[1]) || substr(string_split(p_name, ' ')[1], 2) || ' '
         || upper(string_split(p_name, ' ')[2][1]) || substr(string_split(p_name, ' ')[2], 2) AS words FROM part""",
)
def split_camel(t: Tables):
    attached = F.concat(F.lit("lost"), F.replace(F.initcap("p_name"), F.lit(" "), F.lit("")))
    return op.split_attached_words(t.part.select("p_partkey", attached.alias("words")), "words")


@query("transliterate", f"SELECT doc_id, {sql_fold("replace(text, 'ß', 'ss')")} AS text FROM documents")
def transliterate(t: Tables):
    """Whole documents in ASCII, every letter kept."""
    return t.texts.select("doc_id", ft.transliterate("text").alias("text"))


@query("ascii_fold", f"SELECT doc_id, {sql_fold('text')} AS text FROM documents")
def ascii_fold(t: Tables):
    return op.normalize_characters(t.documents.select("doc_id", "text"), "text")


YEAR = "coalesce(TRY_CAST(startYear AS BIGINT), TRY_CAST(endYear AS BIGINT))"
RELEASE = (
    f"(SELECT tconst, CASE WHEN {YEAR} NOT BETWEEN 1890 AND {AS_OF_YEAR} THEN {AS_OF_YEAR} ELSE {YEAR} END AS releaseYear"
    f" FROM {RAW_TITLES})"
)


def release_years(t: Tables):
    cleaned = op.clean_records(t.raw_titles.select("tconst", "startYear", "endYear"))
    return op.unify_release_year(cleaned, AS_OF_YEAR)


@query("release_year", f"SELECT tconst, releaseYear FROM {RELEASE}")
def release_year(t: Tables):
    return release_years(t)


@query(
    "release_year_from_date",
    f"""SELECT o_orderkey AS tconst, CASE WHEN year(o_orderdate) > 1999 THEN 1999 ELSE year(o_orderdate) END::BIGINT AS releaseYear
        FROM orders""",
)
def release_year_from_date(t: Tables):
    dated = t.orders.select(F.col("o_orderkey").alias("tconst"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("release_date"))
    return op.unify_release_year(dated, 1999)


@query("filter_nulls", f"SELECT tconst, numVotes FROM {NUMBERS} WHERE numVotes IS NOT NULL")
def filter_nulls(t: Tables):
    return op.drop_missing(t.numbers, ["numVotes"]).select("tconst", "numVotes")


@query("filter_missing", f"SELECT tconst, runtimeMinutes FROM {NUMBERS} WHERE numVotes IS NULL")
def filter_missing(t: Tables):
    return op.only_missing(t.numbers, "numVotes").select("tconst", "runtimeMinutes")


@query("filter_label", f"SELECT tconst, numVotes FROM {MOVIES} WHERE label")
def filter_label(t: Tables):
    return op.where_equal(t.movies, "label", True).select("tconst", "numVotes")


@query(
    "title_mismatch",
    f"""SELECT tconst FROM (SELECT tconst, {sql_strip('primaryTitle')} AS p,
          CASE WHEN lower({sql_strip('originalTitle')}) IN {MISSING} THEN NULL ELSE originalTitle END AS o FROM {RAW_TITLES})
        WHERE p <> o OR p IS NULL OR o IS NULL""",
)
def title_mismatch(t: Tables):
    cleaned = op.clean_records(t.raw_titles, lower=False)
    return op.where_mismatch(cleaned, "primaryTitle", "originalTitle").select("tconst")


@query("fill_zero", f"SELECT tconst, coalesce(numVotes, 0) AS numVotes FROM {NUMBERS}")
def fill_zero(t: Tables):
    return op.fill_constant(t.numbers.select("tconst", "numVotes"), ["numVotes"], 0)


@query(
    "fill_median",
    f"SELECT tconst, CAST(coalesce(numVotes, (SELECT median(numVotes) FROM {NUMBERS})) AS DOUBLE) AS numVotes FROM {NUMBERS}",
)
def fill_median(t: Tables):
    numbers = t.numbers.select("tconst", "numVotes")
    return op.fit_median_fill(numbers, ["numVotes"]).transform(numbers)


@query(
    "impute_mean",
    f"""SELECT tconst, round(CAST(coalesce(numVotes, (SELECT avg(numVotes) FROM {NUMBERS})) AS DOUBLE), 4) AS numVotes
        FROM {NUMBERS}""",
)
def impute_mean(t: Tables):
    numbers = t.numbers.select("tconst", "numVotes")
    return op.fit_mean_fill(numbers, ["numVotes"]).transform(numbers).withColumn("numVotes", r("numVotes", 4))


@query(
    "feature_select",
    f"""SELECT 'numVotes' AS feature, CAST(count(numVotes) AS BIGINT) AS present FROM {NUMBERS}
        UNION ALL SELECT 'runtimeMinutes', count(runtimeMinutes) FROM {NUMBERS}
        UNION ALL SELECT 'startYear', count(startYear) FROM {NUMBERS}""",
)
def feature_select(t: Tables):
    names = model.select_features(t.numbers)
    present = t.numbers.agg(*[F.count(n).alias(n) for n in names])
    return present.unpivot([], names, "feature", "present")


@query(
    "align_schema",
    f"""SELECT CAST(coalesce(numVotes, 0) AS DOUBLE) AS numVotes, CAST(0 AS DOUBLE) AS genre_pca_0,
          CAST(runtimeMinutes AS DOUBLE) AS runtimeMinutes, CAST(label AS DOUBLE) AS label FROM {NUMBERS}""",
)
def align_schema(t: Tables):
    return op.align_schema(t.numbers, ["numVotes", "genre_pca_0", "runtimeMinutes", "label"])


@query(
    "semi_missing_runtime",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def semi_missing_runtime(t: Tables):
    keys = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return op.semi_join(t.orders, keys, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


# --- duplicates ------------------------------------------------------------


@query(
    "duplicate_count",
    """SELECT (SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem) AS key_duplicates,
              (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS row_duplicates""",
)
def duplicate_count(t: Tables):
    by_key = op.duplicate_count(t.lineitem, ["l_orderkey", "l_linenumber"], "n").withColumn("kind", F.lit("key_duplicates"))
    by_row = op.duplicate_count(t.lineitem, None, "n").withColumn("kind", F.lit("row_duplicates"))
    kinds = ["key_duplicates", "row_duplicates"]
    both = by_key.unionByName(by_row)
    return both.agg(*[F.max(F.when(F.col("kind") == k, F.col("n"))).alias(k) for k in kinds])


@query(
    "repeated_keys",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
       QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""",
)
def repeated_keys(t: Tables):
    line = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return op.repeated_keys(line, ["l_orderkey", "l_linenumber"])


@query("dedupe_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_linestatus FROM lineitem")
def dedupe_rows(t: Tables):
    return op.drop_duplicate_rows(t.lineitem.select("l_partkey", "l_suppkey", "l_linestatus"))


@query(
    "dedupe_first",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) = 1""",
)
def dedupe_first(t: Tables):
    line = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    return op.first_per_key(line, ["l_orderkey"], ["l_linenumber"])


@query("limit_n", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def limit_n(t: Tables):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").limit(5)
