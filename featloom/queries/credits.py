"""Link-table aggregates and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from featloom.operators import credits as op
from featloom.operators import joins
from featloom.queries.registry import DIRECTORS, MOVIES, WORDS, WRITERS, Tables, query

# The category vocabulary of the test titles, in alphabetical order, read from the data by the queries.
GENRES_SQL = f"(SELECT tconst, unnest(genres) AS category FROM {MOVIES})"


@query("director_count", f"SELECT tconst, count(DISTINCT director) AS director_count FROM {DIRECTORS} GROUP BY tconst")
def director_count(t: Tables):
    return op.distinct_per_key(t.directors, "tconst", "director", "director_count")


@query("writer_count", f"SELECT tconst, count(DISTINCT writer) AS writer_count FROM {WRITERS} GROUP BY tconst")
def writer_count(t: Tables):
    return op.distinct_per_key(t.writers, "tconst", "writer", "writer_count")


@query(
    "any_dir_writer",
    f"""WITH shared AS (SELECT tconst, director AS person FROM {DIRECTORS} INTERSECT SELECT tconst, writer FROM {WRITERS}),
          credited AS (SELECT tconst FROM {DIRECTORS} INTERSECT SELECT tconst FROM {WRITERS})
        SELECT tconst, CAST(tconst IN (SELECT tconst FROM shared) AS INTEGER) AS is_any_dir_writer FROM credited""",
)
def any_dir_writer(t: Tables):
    return op.any_shared_person(t.directors, t.writers, "tconst", "director", "writer")


def _mean_votes_sql(person: str, links: str, alias: str) -> str:
    """Votes of a person's titles, each as often as it is credited, over the number of credits."""
    return f"""WITH credit AS (SELECT {person}, tconst, count(*) AS times FROM {links} GROUP BY ALL),
          weighed AS (SELECT {person}, times, times * numVotes AS votes FROM credit INNER JOIN {MOVIES} USING (tconst))
        SELECT {person}, sum(votes) / sum(times) AS {alias} FROM weighed GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""


@query("top_directors_by_votes", _mean_votes_sql("director", DIRECTORS, "dir_avg_votes"))
def top_directors_by_votes(t: Tables):
    return op.top_people_by_mean(t.directors, t.movies, "tconst", "director", "numVotes", "dir_avg_votes")


@query("top_writers_by_votes", _mean_votes_sql("writer", WRITERS, "wri_avg_votes"))
def top_writers_by_votes(t: Tables):
    return op.top_people_by_mean(t.writers, t.movies, "tconst", "writer", "numVotes", "wri_avg_votes")


TOP = """(SELECT {p} FROM {links} l JOIN {movies} m ON l.tconst = m.tconst GROUP BY {p} ORDER BY avg(m.numVotes) DESC, {p} LIMIT 10)"""
TOP_D = TOP.format(p="director", links=DIRECTORS, movies=MOVIES)
TOP_W = TOP.format(p="writer", links=WRITERS, movies=MOVIES)


@query(
    "top10_flags",
    f"SELECT tconst, 1::INTEGER AS is_top_10_director FROM {DIRECTORS} WHERE director IN {TOP_D} GROUP BY tconst",
)
def top10_flags(t: Tables):
    top = op.top_people_by_mean(t.directors, t.movies, "tconst", "director", "numVotes", "mean")
    return op.top_k_flags(t.directors, top, "tconst", "director", "is_top_10_director")


@query(
    "credit_features",
    f"""SELECT m.tconst, m.numVotes, coalesce(dc, 0)::BIGINT AS director_count, coalesce(wc, 0)::BIGINT AS writer_count,
          coalesce(a, 0)::BIGINT AS is_any_dir_writer, coalesce(td, 0)::BIGINT AS is_top_10_director,
          coalesce(tw, 0)::BIGINT AS is_top_10_writer
        FROM {MOVIES} m
        LEFT JOIN (SELECT tconst, count(DISTINCT director) AS dc, max(CASE WHEN director IN {TOP_D} THEN 1 ELSE 0 END) AS td
                   FROM {DIRECTORS} GROUP BY tconst) d ON m.tconst = d.tconst
        LEFT JOIN (SELECT tconst, count(DISTINCT writer) AS wc, max(CASE WHEN writer IN {TOP_W} THEN 1 ELSE 0 END) AS tw
                   FROM {WRITERS} GROUP BY tconst) w ON m.tconst = w.tconst
        LEFT JOIN (SELECT tconst, 1 AS a FROM (SELECT tconst, director FROM {DIRECTORS} INTERSECT SELECT tconst, writer FROM {WRITERS})
                   GROUP BY tconst) x ON m.tconst = x.tconst""",
)
def credit_features(t: Tables):
    return op.credit_features(t.movies.select("tconst", "numVotes"), t.directors, t.writers)


@query(
    "director_stats",
    f"""SELECT d.director, count(DISTINCT d.tconst) AS dir_movie_count, avg(m.numVotes) AS dir_avg_rating
        FROM {DIRECTORS} d LEFT JOIN {MOVIES} m ON d.tconst = m.tconst GROUP BY d.director""",
)
def director_stats(t: Tables):
    rated = t.directors.join(t.movies.select("tconst", "numVotes"), "tconst", "left")
    return op.person_stats(rated, "tconst", "director", "numVotes")


@query(
    "same_person_credits",
    f"""SELECT d.tconst, d.director AS person, count(*) AS n_rows FROM {DIRECTORS} d
        JOIN {WRITERS} w ON d.tconst = w.tconst AND d.director = w.writer GROUP BY ALL""",
)
def same_person_credits(t: Tables):
    return op.same_person_credits(t.directors, t.writers, "tconst", "director", "writer")


FANOUT = f"{MOVIES} m LEFT JOIN {DIRECTORS} d ON m.tconst = d.tconst LEFT JOIN {WRITERS} w ON d.tconst = w.tconst"


@query(
    "credit_fanout",
    f"""SELECT m.tconst, count(*) AS n_rows, max(coalesce(dn, 0)) AS n_directors, max(coalesce(wn, 0)) AS n_writers FROM {FANOUT}
        LEFT JOIN (SELECT tconst, count(*) AS dn FROM {DIRECTORS} GROUP BY tconst) a ON m.tconst = a.tconst
        LEFT JOIN (SELECT tconst, count(*) AS wn FROM {WRITERS} GROUP BY tconst) b ON a.tconst = b.tconst GROUP BY m.tconst""",
)
def credit_fanout(t: Tables):
    return op.fanout_counts(t.movies, t.directors, t.writers, "tconst")


def _top_people_sql(source: str, where: str) -> str:
    parts = [
        f"""(SELECT '{role}' AS role, {alias}.{role} AS person, count(*) AS n FROM {source}
             WHERE {where} AND {alias}.{role} IS NOT NULL GROUP BY ALL ORDER BY n DESC, person LIMIT 10)"""
        for role, alias in (("director", "d"), ("writer", "w"))
    ]
    return f"SELECT role, person, CAST(n AS BIGINT) AS n FROM ({' UNION ALL '.join(parts)})"


def _top_people(counts):
    return op.top_people(counts, "director").unionByName(op.top_people(counts, "writer"))


@query(
    "top_people_overall",
    _top_people_sql(f"{DIRECTORS} d LEFT JOIN {WRITERS} w ON d.tconst = w.tconst", "true"),
)
def top_people_overall(t: Tables):
    return _top_people(op.fanout_people(t.directors, t.writers, "tconst", "director", "writer"))


@query("top_people_high", _top_people_sql(FANOUT, "m.label"))
def top_people_high(t: Tables):
    facts = t.movies.where("label")
    return _top_people(op.fanout_people(t.directors, t.writers, "tconst", "director", "writer", facts))


@query("top_people_low", _top_people_sql(FANOUT, "NOT m.label"))
def top_people_low(t: Tables):
    facts = t.movies.where("NOT label")
    return _top_people(op.fanout_people(t.directors, t.writers, "tconst", "director", "writer", facts))


@query(
    "distinct_people",
    f"""SELECT (SELECT count(DISTINCT director) FROM {DIRECTORS}) AS directors,
               (SELECT count(DISTINCT writer) FROM {WRITERS}) AS writers""",
)
def distinct_people(t: Tables):
    names = t.directors.select(F.col("director").alias("directors")).unionByName(
        t.writers.select(F.col("writer").alias("writers")), allowMissingColumns=True
    )
    return op.distinct_overall(names, ["directors", "writers"])


@query(
    "distinct_per_movie",
    f"""SELECT d.tconst, count(DISTINCT d.director) AS directors, count(DISTINCT w.writer) AS writers
        FROM {DIRECTORS} d LEFT JOIN {WRITERS} w ON d.tconst = w.tconst GROUP BY d.tconst""",
)
def distinct_per_movie(t: Tables):
    """Distinct counts are the same before and after the fan-out join, so each side is counted on its own."""
    d = op.distinct_per_key(t.directors, "tconst", "director", "directors")
    w = op.distinct_per_key(t.writers, "tconst", "writer", "writers")
    return d.join(w, "tconst", "left").select("tconst", "directors", F.coalesce("writers", F.lit(0)).alias("writers"))


# --- expertise -------------------------------------------------------------

EXPERTISE = f"""(SELECT director, category, genre_count, sum(genre_count) OVER (PARTITION BY director)::BIGINT AS total_count
  FROM (SELECT director, category, count(*) AS genre_count FROM {DIRECTORS} d JOIN {GENRES_SQL} g ON d.tconst = g.tconst GROUP BY ALL))"""


def expertise(t: Tables):
    return op.category_expertise(t.directors, t.movies, "tconst", "director", "genres")


@query(
    "genre_expertise",
    f"SELECT director, category, genre_count, total_count, genre_count / total_count AS genre_expertise FROM {EXPERTISE}",
)
def genre_expertise(t: Tables):
    return expertise(t)


def wide(suffix: str = "") -> str:
    """One column for each category, absent ones 0."""
    return ", ".join(f"coalesce(max(CASE WHEN category = '{w}' THEN genre_count / total_count END), 0) AS {w}{suffix}" for w in WORDS)


@query("genre_pivot", f"SELECT director, {wide()} FROM {EXPERTISE} GROUP BY director")
def genre_pivot(t: Tables):
    return op.expertise_matrix(expertise(t), "director", op.category_names(t.movies, "genres"))


@query(
    "expertise_join",
    f"""SELECT tconst, director, {wide("_dir_expertise")}
        FROM (SELECT DISTINCT tconst, director FROM {DIRECTORS}) LEFT JOIN {EXPERTISE} USING (director) GROUP BY tconst, director""",
)
def expertise_join(t: Tables):
    names = op.category_names(t.movies, "genres")
    facts = t.directors.distinct().withColumns({w: F.lit(0) for w in names})
    matrix = op.expertise_matrix(expertise(t), "director", names)
    return op.join_expertise(facts, matrix, "director", "_dir_expertise").drop(*names)


# --- title joins -----------------------------------------------------------


@query(
    "join_title_genres",
    """WITH c AS (SELECT lower(p_name) AS title, min(p_brand) AS brand FROM part GROUP BY 1)
       SELECT p.p_partkey AS tconst, c.brand AS genres FROM part p LEFT JOIN c ON lower(p.p_name) = c.title""",
)
def join_title_genres(t: Tables):
    year = (F.lit(1990) + F.col("p_partkey") % 30).cast("string")
    titled = t.part.withColumn("title", F.concat(F.initcap("p_name"), F.lit(" ("), year, F.lit(")")))
    catalogue = titled.select("title", F.col("p_brand").alias("genres"))
    facts = titled.select(F.col("p_partkey").alias("tconst"), F.concat(F.lit(" "), "p_name").alias("originalTitle"))
    out = joins.join_by_title(facts, catalogue, "originalTitle", "title", ["genres"], dedupe_right=True, order=["genres"])
    return out.select("tconst", "genres")


@query(
    "merge_coalesce",
    """WITH meta AS (SELECT p_name AS title, max(p_retailprice) AS price, min(p_size)::BIGINT AS runtime FROM part GROUP BY 1)
       SELECT p_partkey AS tconst, lower(p_name) AS "originalTitle",
         coalesce(CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_retailprice END, meta.price) AS price, meta.runtime
       FROM part LEFT JOIN meta ON lower(part.p_name) = meta.title""",
)
def merge_coalesce(t: Tables):
    meta = t.part.groupBy(F.upper("p_name").alias("original_title")).agg(
        F.max("p_retailprice").alias("price"), F.min("p_size").cast("bigint").alias("runtime")
    )
    k = F.col("p_partkey")
    facts = t.part.select(
        k.alias("tconst"), F.concat(F.lit(" "), "p_name").alias("originalTitle"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.col("p_retailprice")).alias("price"),
    )
    return joins.merge_metadata(facts, meta).drop("original_title")
