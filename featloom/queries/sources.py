"""Sources and sinks. CSV and JSON files are written from the tables to the shared folder, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from featloom.queries.registry import MOVIES, Tables, query, r, sql_strip
from featloom.session import scratch_path
from featloom.sources import readers
from featloom.sources.sniff import read_csv_sniffed


@query(
    "scan_all",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
       FROM orders""",
)
def scan_all(t: Tables):
    path = scratch_path(t.spark, "orders-csv")
    t.orders.withColumn("o_orderdate", F.to_date("o_orderdate")).write.csv(path, header=True)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"
    return readers.read_csv(t.spark, f"{path}/*.csv", schema)


@query(
    "union_by_name",
    """SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_linestatus = 'O' THEN l_tax END AS l_tax FROM lineitem""",
)
def union_by_name(t: Tables):
    line = t.lineitem
    left = line.where("l_linestatus = 'O'").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    right = line.where("l_linestatus <> 'O'").select("l_quantity", "l_linenumber", "l_orderkey")
    return readers.union_by_name([left, right])


@query(
    "scan_sniffed",
    """SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus = 'F' AS done,
         'order; "' || o_orderkey || '", ' || o_orderpriority AS note, CASE WHEN o_orderkey % 3 = 0 THEN (o_custkey % 10)::DOUBLE ELSE o_custkey % 10 + 0.5 END AS mixed
       FROM orders""",
)
def scan_sniffed(t: Tables):
    """Three folders of files: commas, semicolons without a header, tabs with single quotes."""
    path = scratch_path(t.spark, "orders-sniffed")
    k = F.col("o_orderkey")
    rows = t.orders.select(
        k, F.round("o_totalprice", 2).cast("decimal(20,2)").alias("o_totalprice"), F.to_date("o_orderdate").alias("o_orderdate"),
        (F.col("o_orderstatus") == "F").alias("done"), F.concat(F.lit('order; "'), k, F.lit('", '), "o_orderpriority").alias("note"),
        F.when(k % 3 == 0, (F.col("o_custkey") % 10).cast("string")).otherwise((F.col("o_custkey") % 10 + 0.5).cast("string")).alias("mixed"),
    )
    forms = ({"sep": ",", "header": True, "escape": '"'}, {"sep": ";", "header": False, "escape": '"'}, {"sep": "\t", "header": True, "quote": "'", "escape": "'"})
    for i, form in enumerate(forms):
        rows.where(k % 3 == i).write.csv(f"{path}/part{i}", emptyValue="", **form)
    return read_csv_sniffed(t.spark, f"{path}/part*/*.csv")


@query("scan_drop_index", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def scan_drop_index(t: Tables):
    path = scratch_path(t.spark, "customer-csv")
    rows = t.customer.select(F.monotonically_increasing_id().alias("Unnamed: 0"), "c_custkey", "c_name", "c_acctbal")
    odd = F.col("c_custkey") % 2 == 1
    rows.where(odd).write.csv(path, header=True, compression="gzip")
    rows.where(~odd).select("c_acctbal", "Unnamed: 0", "c_custkey", "c_name").write.mode("append").csv(path, header=True, compression="gzip")
    schema = T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()), T.StructField("c_acctbal", T.DoubleType())
    ])
    return readers.read_csv_shards(t.spark, f"{path}/*.csv.gz", schema)


@query(
    "metadata_coerce",
    f"""SELECT o_orderkey AS id,
          round(CASE WHEN o_orderkey % 7 IN (0, 1) THEN 0 ELSE o_totalprice END, 2) AS budget,
          CAST(o_custkey AS DOUBLE) AS vote_count, lower({sql_strip("' ' || o_orderpriority || chr(10)")}) AS title
        FROM orders""",
)
def metadata_coerce(t: Tables):
    k = F.col("o_orderkey")
    raw = t.orders.select(
        k.alias("id"),
        F.when(k % 7 == 0, "n/a").when(k % 7 == 1, F.lit(None)).otherwise(F.col("o_totalprice").cast("string")).alias("budget"),
        F.col("o_custkey").cast("string").alias("vote_count"),
        F.concat(F.lit(" "), "o_orderpriority", F.lit("\n")).alias("title"),
    )
    out = readers.clean_metadata(raw)
    return out.select("id", r("budget", 2).alias("budget"), "vote_count", "title")


@query(
    "json_links",
    "SELECT CAST(event_id AS VARCHAR) AS tconst, CAST(json_extract(props, '$.k') AS VARCHAR) AS director FROM events",
)
def json_links(t: Tables):
    k = F.from_json("props", "k bigint")["k"].cast("string")
    path = scratch_path(t.spark, "links-json")
    t.events.select(F.col("event_id").cast("string").alias("movie"), k.alias("director")).write.json(path)
    return readers.read_links(t.spark, path, "director")


@query(
    "json_links_by_column",
    "SELECT CAST(user_id AS VARCHAR) || ':' || event_type AS tconst, CAST(count(*) AS VARCHAR) AS director FROM events GROUP BY ALL",
)
def json_links_by_column(t: Tables):
    """Column-oriented documents, one per user, each mapping a few row labels to values."""
    counts = t.events.groupBy("user_id", "event_type").count()
    title = F.concat_ws(":", F.col("user_id").cast("string"), "event_type")
    documents = counts.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("event_type", title))).alias("movie"),
        F.map_from_entries(F.collect_list(F.struct("event_type", F.col("count").cast("string")))).alias("director"),
    )
    path = scratch_path(t.spark, "links-by-column")
    documents.drop("user_id").write.json(path)
    # Each line is one document, and one document a file is what the reader expects; lines are handled alike.
    raw = t.spark.read.schema("movie map<string,string>, director map<string,string>").json(path)
    return readers.explode_columns(raw, "movie", "director").withColumnRenamed("movie", "tconst")


@query(
    "strip_year_suffix",
    """SELECT p_partkey AS id, lower(p_name) || CASE WHEN p_partkey % 3 = 0 THEN ' (1999) again' ELSE '' END AS title,
         lower(p_type) AS genres FROM part""",
)
def strip_year_suffix(t: Tables):
    year = (F.lit(1990) + F.col("p_partkey") % 30).cast("string")
    raw = t.part.select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit(" (1999) again"))).otherwise(F.concat("p_name", F.lit(" ("), year, F.lit(")"))).alias("title"),
        F.concat(F.lit(" "), "p_type").alias("genres"),
    )
    return readers.clean_catalogue(raw)


@query("sql_view", f"SELECT label, count(*) AS n, sum(numVotes)::BIGINT AS votes FROM {MOVIES} GROUP BY label")
def sql_view(t: Tables):
    readers.register_views({"featloom_movies": t.movies})
    return readers.run_sql(
        t.spark, "SELECT label, count(*) AS n, sum(numVotes) AS votes FROM featloom_movies GROUP BY label"
    )
