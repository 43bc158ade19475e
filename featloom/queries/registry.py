"""Query registry and the bindings of reference columns to the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF_YEAR = 2024


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its SQL check."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        REGISTRY[name] = Query(name, lambda spark, sf_dir: fn(Tables(spark, sf_dir)), sql)
        return fn

    return wrap


def r(c: Column | str, digits: int = 6) -> Column:
    """Rounded double, so that engines with another order of summation agree."""
    return F.round(F.col(c).cast("double") if isinstance(c, str) else c.cast("double"), digits)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: r(c, digits) for c in columns})


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    sf_dir: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def texts(self) -> DataFrame:
        """Documents for CPU-heavy text work, dealt by key: the test tables are single files of few row groups."""
        return self.documents.select("doc_id", "text").repartition("doc_id")

    # The link table holds both roles; the line status tells them apart.
    @property
    def directors(self) -> DataFrame:
        return self.lineitem.where("l_linestatus = 'F'").selectExpr("l_partkey AS tconst", "l_suppkey AS director")

    @property
    def writers(self) -> DataFrame:
        return self.lineitem.where("l_linestatus = 'O'").selectExpr("l_partkey AS tconst", "l_suppkey AS writer")

    @property
    def movies(self) -> DataFrame:
        """Facts with one row per title; the vote count is an integer, as in a vote table."""
        return self.part.selectExpr(
            "p_partkey AS tconst", "p_name AS primaryTitle", "p_type AS originalTitle",
            "CAST(round(p_retailprice * 10) AS BIGINT) AS numVotes", "p_size >= 26 AS label",
            "split(p_name, ' ') AS genres",
        )

    @property
    def raw_titles(self) -> DataFrame:
        """Untyped records with missing tokens, padding and implausible years."""
        year = F.year("o_orderdate").cast("string")
        k = F.col("o_orderkey")
        votes = F.floor("o_totalprice").cast("bigint")
        return self.orders.select(
            k.alias("tconst"),
            F.when(k % 10 == 0, "\\N").when(k % 97 == 0, "1500").when(k % 97 == 1, "3000").otherwise(year).alias("startYear"),
            F.when(k % 10 == 0, year).otherwise("\\N").alias("endYear"),
            F.when(k % 7 == 0, "\\N").when(k % 7 == 1, " NaN ").when(k % 7 == 2, "?")
            .otherwise(votes.cast("string")).alias("numVotes"),
            F.when(k % 11 == 0, "none").when(k % 11 == 1, "12 min").otherwise((votes % 240).cast("string")).alias("runtimeMinutes"),
            F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit("\t")).alias("primaryTitle"),
            F.when(k % 2 == 0, " - ").otherwise(F.col("o_orderpriority")).alias("originalTitle"),
        )

    @property
    def numbers(self) -> DataFrame:
        """Typed statistics input: a tenth of the votes missing."""
        k = F.col("o_orderkey")
        votes = F.floor("o_totalprice").cast("bigint")
        return self.orders.select(
            k.alias("tconst"),
            F.when(k % 10 == 0, F.lit(None)).otherwise(votes).alias("numVotes"),
            (votes % 240).alias("runtimeMinutes"),
            F.year("o_orderdate").cast("bigint").alias("startYear"),
            (F.col("o_orderstatus") == "F").alias("label"),
        )


# The same bindings as SQL, for the checks.
DIRECTORS = "(SELECT l_partkey AS tconst, l_suppkey AS director FROM lineitem WHERE l_linestatus = 'F')"
WRITERS = "(SELECT l_partkey AS tconst, l_suppkey AS writer FROM lineitem WHERE l_linestatus = 'O')"
MOVIES = (
    "(SELECT p_partkey AS tconst, p_name AS primaryTitle, p_type AS originalTitle,"
    " CAST(round(p_retailprice * 10) AS BIGINT) AS numVotes, p_size >= 26 AS label, string_split(p_name, ' ') AS genres FROM part)"
)
RAW_TITLES = r"""(SELECT o_orderkey AS tconst,
 CASE WHEN o_orderkey % 10 = 0 THEN '\N' WHEN o_orderkey % 97 = 0 THEN '1500' WHEN o_orderkey % 97 = 1 THEN '3000'
      ELSE CAST(year(o_orderdate) AS VARCHAR) END AS startYear,
 CASE WHEN o_orderkey % 10 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) ELSE '\N' END AS endYear,
 CASE o_orderkey % 7 WHEN 0 THEN '\N' WHEN 1 THEN ' NaN ' WHEN 2 THEN '?'
      ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS numVotes,
 CASE o_orderkey % 11 WHEN 0 THEN 'none' WHEN 1 THEN '12 min'
      ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 240 AS VARCHAR) END AS runtimeMinutes,
 '  ' || o_orderpriority || chr(9) AS primaryTitle,
 CASE WHEN o_orderkey % 2 = 0 THEN ' - ' ELSE o_orderpriority END AS originalTitle
 FROM orders)"""
NUMBERS = """(SELECT o_orderkey AS tconst,
 CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END AS numVotes,
 CAST(floor(o_totalprice) AS BIGINT) % 240 AS runtimeMinutes, CAST(year(o_orderdate) AS BIGINT) AS startYear,
 o_orderstatus = 'F' AS label FROM orders)"""

# The words of the test titles, which are their categories.
WORDS = ("anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new", "old", "plate", "red", "ring", "rod", "small", "widget")

# Text normalisation as SQL.
BLANKS = "' ' || chr(9) || chr(10) || chr(13)"
MISSING = r"('\n', 'nan', 'none', 'null', 'na', '-', '?', '')"


def sql_strip(c: str) -> str:
    return f"trim({c}, {BLANKS})"


def sql_fold(c: str) -> str:
    return rf"regexp_replace(strip_accents({c}), '[^\x00-\x7F]', '', 'g')"


def sql_no_control(c: str) -> str:
    return rf"regexp_replace({c}, '\p{{C}}', '', 'g')"


PUNCTUATION = r"[!-/:-@\[-`{-~]"


def sql_no_punctuation(c: str) -> str:
    return f"regexp_replace({c}, '{PUNCTUATION}', '', 'g')"


def sql_embedding_clean(c: str) -> str:
    return sql_fold(f"lower({sql_no_control(sql_strip(c))})")


def sql_fingerprint_tokens(c: str) -> str:
    folded = sql_fold(sql_no_control(sql_no_punctuation(f"lower({sql_strip(c)})")))
    return f"list_filter(regexp_split_to_array({folded}, '\\s+'), lambda t: t <> '')"
