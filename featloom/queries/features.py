"""Temporal, categorical and vector features."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from featloom.functions import text as ft
from featloom.operators import categories as cat
from featloom.operators import model, sparse, temporal
from featloom.operators.credits import category_names
from featloom.operators import text_features as text_op
from featloom.plans.feature_build import FeatureBuild, movie_inputs
from featloom.queries.cleaning import RELEASE, release_years
from featloom.queries.registry import AS_OF_YEAR, DIRECTORS, MOVIES, NUMBERS, WORDS, WRITERS, Tables, query, r


@query("movie_age", f"SELECT tconst, {AS_OF_YEAR} - releaseYear AS movie_age FROM {RELEASE}")
def movie_age(t: Tables):
    return temporal.add_age(release_years(t), AS_OF_YEAR).select("tconst", "movie_age")


SEASON = """CASE WHEN d <= 90 THEN 'winter' WHEN d <= 180 THEN 'spring' WHEN d <= 270 THEN 'summer' ELSE 'autumn' END"""


@query(
    "season_onehot",
    f"""SELECT o_orderkey, CAST(d AS INTEGER) AS day_of_year, {SEASON} AS season,
          {', '.join(f"CAST({SEASON} = '{s}' AS INTEGER) AS season_{s}" for s in ('winter', 'spring', 'summer', 'autumn'))}
        FROM (SELECT o_orderkey, dayofyear(o_orderdate) AS d FROM orders)""",
)
def season_onehot(t: Tables):
    return temporal.add_season(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


@query(
    "parse_genres",
    """SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 5 = 0 THEN replace(p_name, ' ', '|') || '|' || replace(p_name, ' ', '|')
           ELSE replace(p_name, ' ', '|') END AS genres,
         CAST(CASE WHEN p_partkey % 7 = 0 THEN 0 WHEN p_partkey % 5 = 0 THEN 4 ELSE 2 END AS INTEGER) AS n FROM part""",
)
def parse_genres(t: Tables):
    """A third of the titles in each spelling (pipe text, list text, list of dicts), some empty or with repeats."""
    k = F.col("p_partkey")
    named = F.when(k % 5 == 0, F.concat_ws(" ", "p_name", "p_name")).otherwise(F.col("p_name"))
    words = F.split(named, " ")
    quoted = F.concat(F.lit("['"), F.array_join(words, "', '"), F.lit("']"))
    dicts = F.concat(F.lit("[{'id': None, 'name': '"), F.array_join(F.transform(words, F.initcap), "'}, {'id': 2, 'main': True, 'name': '"), F.lit("'}]"))
    spelled = F.when(k % 3 == 0, quoted).when(k % 3 == 1, dicts).otherwise(F.array_join(words, "|"))
    spelled = F.when(k % 7 == 0, F.when(k % 2 == 0, "[]")).otherwise(spelled)
    parsed = t.part.select("p_partkey", ft.parse_categories(spelled).alias("parsed"))
    return parsed.select("p_partkey", F.array_join("parsed", "|").alias("genres"), F.size("parsed").alias("n"))


POPULARITY = f"(SELECT g AS category, avg(numVotes) AS popularity FROM (SELECT unnest(list_distinct(genres)) AS g, numVotes FROM {MOVIES}) GROUP BY g)"
COUNTED = f"(SELECT tconst, g AS category, count(*) AS n FROM (SELECT tconst, unnest(genres) AS g FROM {MOVIES}) GROUP BY ALL)"
WEIGHTED = f"(SELECT c.tconst, c.category, n * popularity AS weight FROM {COUNTED} c JOIN {POPULARITY} p ON c.category = p.category)"


@query("genre_popularity", f"SELECT category, popularity FROM {POPULARITY}")
def genre_popularity(t: Tables):
    return cat.popularity(t.movies, "genres", "numVotes")


@query("genre_weighted_onehot", f"SELECT tconst, category, round(weight, 6) AS weight FROM {WEIGHTED}")
def genre_weighted_onehot(t: Tables):
    movies = t.movies
    out = cat.weighted_categories(movies, "tconst", "genres", cat.fit_popularity(movies, "genres", "numVotes"))
    return out.withColumn("weight", r("weight"))


@query(
    "genre_multi_hot",
    f"""SELECT tconst, {', '.join(f"round(coalesce(max(CASE WHEN category = '{w}' THEN weight END), 0), 6) AS genre_{w}" for w in WORDS)}
        FROM (SELECT tconst FROM {MOVIES}) LEFT JOIN {WEIGHTED} USING (tconst) GROUP BY tconst""",
)
def genre_multi_hot(t: Tables):
    movies = t.movies
    weights = cat.fit_popularity(movies, "genres", "numVotes")
    names = category_names(movies, "genres")
    wide = cat.multi_hot(cat.weighted_categories(movies, "tconst", "genres", weights), movies, "tconst", names)
    return wide.select("tconst", *[r(f"genre_{w}").alias(f"genre_{w}") for w in names])


@query(
    "genre_interactions",
    f"""SELECT a.tconst, a.category AS "left", b.category AS "right", round(a.weight * b.weight, 2) AS product
        FROM {WEIGHTED} a JOIN {WEIGHTED} b ON a.tconst = b.tconst AND a.category < b.category""",
)
def genre_interactions(t: Tables):
    movies = t.movies
    out = cat.interactions(movies, "tconst", "genres", cat.fit_popularity(movies, "genres", "numVotes"))
    return out.withColumn("product", r("product", 2))


@query(
    "standard_scale",
    f"""SELECT tconst, {', '.join(f'''round((coalesce({c}, 0) - avg(coalesce({c}, 0)) OVER ())
          / stddev_pop(coalesce({c}, 0)) OVER (), 6) AS {c}''' for c in ('numVotes', 'runtimeMinutes'))} FROM {NUMBERS}""",
)
def standard_scale(t: Tables):
    numbers = t.numbers.select("tconst", "numVotes", "runtimeMinutes")
    scaled = model.fit_column_scaler(numbers, ["numVotes", "runtimeMinutes"]).transform(numbers)
    return scaled.select("tconst", r("numVotes").alias("numVotes"), r("runtimeMinutes").alias("runtimeMinutes"))


@query(
    "standard_scale_vector",
    f"""SELECT tconst, {', '.join(f'''round((coalesce({c}, 0) - avg(coalesce({c}, 0)) OVER ())
          / stddev_pop(coalesce({c}, 0)) OVER (), 6) AS {c}''' for c in ('numVotes', 'runtimeMinutes'))} FROM {NUMBERS}""",
)
def standard_scale_vector(t: Tables):
    vectors = model.assemble(t.numbers, ["numVotes", "runtimeMinutes"], "raw").select("tconst", "raw")
    scaled = model.fit_vector_scaler(vectors, "raw", "features").transform(vectors)
    v = vector_to_array("features")
    return scaled.select("tconst", r(v[0]).alias("numVotes"), r(v[1]).alias("runtimeMinutes"))


def _embedding_vectors(t: Tables):
    from pyspark.ml.functions import array_to_vector

    return t.embeddings.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("emb_vec"))


def _squares(parts):
    return r(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x * x), 4)


@query(
    "pca_family",
    """WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
          c AS (SELECT vec_id, i, x - avg(x) OVER (PARTITION BY i) AS x FROM e)
        SELECT vec_id, round(sum(x * x), 4) AS squares, CAST(count(*) AS INTEGER) AS components FROM c GROUP BY vec_id""",
)
def pca_family(t: Tables):
    """All components: a rotation of the centred vectors, so each keeps its squared length."""
    vectors = _embedding_vectors(t)
    parts = vector_to_array("pca_vec")
    out = model.fit_pca(vectors, "emb_vec", "pca_vec", 1 << 10).transform(vectors)
    return out.select("vec_id", _squares(parts).alias("squares"), F.size(parts).alias("components"))


LINE = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "pca_columns",
    f"""SELECT l_orderkey, l_linenumber, round(({' + '.join(f'power({c} - avg({c}) OVER (), 2)' for c in LINE)}) / 1e6, 4) AS squares
        FROM lineitem""",
)
def pca_columns(t: Tables):
    line = t.lineitem.select("l_orderkey", "l_linenumber", *[(F.col(c) / 1e3).alias(f"num_{c}") for c in LINE])
    out = model.apply_pca_columns(line, "num_", len(LINE))
    return out.select("l_orderkey", "l_linenumber", _squares(F.array(*[f"num_pca_{i}" for i in range(len(LINE))])).alias("squares"))


@query(
    "combine_text_features",
    """WITH w AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS term FROM part),
          c AS (SELECT p_partkey, term, count(*) AS tf FROM w GROUP BY ALL),
          i AS (SELECT term, ln((1.0 + (SELECT count(*) FROM part)) / (1 + count(*))) + 1 AS idf FROM c GROUP BY term),
          x AS (SELECT p_partkey, c.term, tf * idf AS v FROM c JOIN i ON c.term = i.term)
        SELECT p_partkey, term, round(v / sqrt(sum(v * v) OVER (PARTITION BY p_partkey)), 6) AS tfidf, CAST(10 AS INTEGER) AS reduced FROM x""",
)
def combine_text_features(t: Tables):
    """TF-IDF and the reduced embedding in one sparse row; its terms are shown one by one."""
    titles = t.part.select("p_partkey", "p_name")
    fitted = text_op.fit_tfidf_vectors(titles, "p_name")
    out = text_op.fit_embedding(titles, "p_name", size=16).transform(fitted.rows(titles))
    out = model.fit_pca(out, "emb_vec", "emb_pca", 10).transform(out)
    both = out.select("p_partkey", sparse.beside("tfidf_vec", vector_to_array("emb_pca")).alias("text_vec"))
    cells = sparse.unpacked(both, "p_partkey", "text_vec").join(fitted.terms.select("position", "term"), "position")
    sizes = both.select("p_partkey", (F.col("text_vec.size") - fitted.size).alias("reduced"))
    return cells.join(sizes, "p_partkey").select("p_partkey", "term", r("value").alias("tfidf"), "reduced")


# The same build as SQL, for the columns that do not come from a fitted vocabulary or decomposition.
TITLES = """(SELECT p_partkey AS tconst, p_name, p_size >= 26 AS label,
    CASE WHEN 1960 + p_partkey % 70 > {now} THEN {now} ELSE 1960 + p_partkey % 70 END AS year,
    CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE 60 + p_partkey % 120 END AS runtime,
    CASE WHEN p_partkey % 10 = 3 THEN NULL ELSE CAST(round(p_retailprice * 10) AS BIGINT) END AS votes FROM part)""".format(now=AS_OF_YEAR)


def expertise_sql(person: str, links: str, fitted: str = "true", shown: str = "true") -> str:
    """(tconst, category, mean): mean share over a title's persons, counted on the ``fitted`` titles for the ``shown`` ones."""
    return f"""(WITH g AS (SELECT p_partkey AS tconst, unnest(string_split(p_name, ' ')) AS category FROM part),
        s AS (SELECT {person} AS p, category, count(*) / sum(count(*)) OVER (PARTITION BY {person}) AS share
              FROM {links} JOIN g USING (tconst) WHERE {fitted.format('tconst')} GROUP BY {person}, category),
        x AS (SELECT DISTINCT tconst, {person} AS p FROM {links} WHERE {shown.format('tconst')} AND {person} IN (SELECT p FROM s)),
        n AS (SELECT tconst, count(*) AS n FROM x GROUP BY 1)
      SELECT tconst, category, sum(share) / any_value(n) AS mean
      FROM x JOIN n USING (tconst) JOIN s USING (p) GROUP BY tconst, category)"""


EXPERTISE_SQL = {"dir": expertise_sql("director", DIRECTORS), "wri": expertise_sql("writer", WRITERS)}


def expertise_columns_sql(suffix: str) -> str:
    columns = ", ".join(f"max(CASE WHEN category = '{w}' THEN mean END) AS {w}_{suffix}_expertise" for w in WORDS)
    return f"(SELECT tconst, {columns} FROM {EXPERTISE_SQL[suffix]} GROUP BY tconst)"


def expertise_length_sql(suffix: str) -> str:
    return f"(SELECT tconst, sum(mean * mean) AS {suffix}_squares FROM {EXPERTISE_SQL[suffix]} GROUP BY tconst)"


def plain_sql(more: str, joins: str) -> str:
    return PLAIN_SQL.replace("<more>", more).replace("<joins>", joins)


PLAIN_SQL = f"""WITH t AS {TITLES},
          rate AS (SELECT p_name, avg((p_size >= 26)::INTEGER) AS rate, max(p_retailprice) AS budget, min(p_type) AS tagline FROM part GROUP BY 1),
          lex AS (SELECT word, 2 * avg(rate) - 1 AS polarity FROM
                  (SELECT rate.p_name, rate, unnest(string_split(rate.p_name, ' ')) AS word FROM rate) GROUP BY word),
          pol AS (SELECT p_name, avg(polarity) AS polarity FROM
                  (SELECT p_name, unnest(regexp_extract_all(lower(p_name || ' ' || tagline), '[a-z]+')) AS word FROM rate) w
                  JOIN lex ON w.word = lex.word GROUP BY p_name),
          d AS (SELECT tconst, count(DISTINCT director) AS n FROM {DIRECTORS} GROUP BY 1),
          w AS (SELECT tconst, count(DISTINCT writer) AS n FROM {WRITERS} GROUP BY 1)
        SELECT t.tconst, label, CAST(year AS BIGINT) AS "releaseYear",
          round(coalesce(runtime, (SELECT avg(runtime) FROM t)), 4) AS "runtimeMinutes",
          round(coalesce(votes, (SELECT avg(votes) FROM t)), 4) AS "numVotes",
          coalesce(d.n, 0) AS director_count, coalesce(w.n, 0) AS writer_count,
          <more>, budget, round(coalesce(polarity, 0), 6) AS text_sentiment_polarity,
          CAST(length(replace(t.p_name, ' ', '')) AS INTEGER) AS title_length, {AS_OF_YEAR} - CAST(year AS BIGINT) AS movie_age,
          count(*) OVER (PARTITION BY year) AS movies_in_year
        FROM t LEFT JOIN d ON t.tconst = d.tconst LEFT JOIN w ON t.tconst = w.tconst <joins> LEFT JOIN rate ON t.p_name = rate.p_name LEFT JOIN pol ON t.p_name = pol.p_name"""


@query("feature_build_columns", plain_sql(
    ", ".join(f"round(coalesce({w}_{suffix}_expertise, 0), 6) AS {w}_{suffix}_expertise" for suffix in EXPERTISE_SQL for w in WORDS),
    " ".join(f"LEFT JOIN {expertise_columns_sql(suffix)} {suffix} ON t.tconst = {suffix}.tconst" for suffix in EXPERTISE_SQL),
))
def feature_build_columns(t: Tables):
    """The plain columns of the feature build and a column for each category of expertise."""
    inputs = movie_inputs(t.part, t.lineitem)
    build = FeatureBuild(AS_OF_YEAR, "embedding", embedding="hashing", embedding_size=16, genre_components=2, expertise="columns")
    table = build.fit_transform(inputs)[1]
    return _plain(table, *[r(c).alias(c) for c in table.columns if c.endswith("_expertise")])


GENRE_SQL = """(WITH v AS (SELECT tconst, coalesce(votes, avg(votes) OVER ()) AS votes, string_split(p_name, ' ') AS g FROM t),
    p AS (SELECT c, avg(votes) AS p FROM (SELECT votes, unnest(list_distinct(g)) AS c FROM v) GROUP BY c),
    w AS (SELECT tconst, c, any_value(p) * count(*) AS w FROM (SELECT tconst, unnest(g) AS c FROM v) JOIN p USING (c) GROUP BY ALL),
    q AS (SELECT tconst, w * w AS q FROM w UNION ALL SELECT l.tconst, pow(l.w * r.w, 2) FROM w l JOIN w r ON l.tconst = r.tconst AND l.c < r.c)
  SELECT tconst, sqrt(sum(q)) AS genre_length FROM q GROUP BY tconst)"""


@query("feature_build", plain_sql(
    "CAST(10 AS INTEGER) AS text_components, CAST(20 AS INTEGER) AS genre_components, round(coalesce(dir_squares, 0), 6) AS dir_squares,"
    " round(coalesce(wri_squares, 0), 6) AS wri_squares, round(genre_length / 1e6, 4) AS genre_length",
    " ".join(f"LEFT JOIN {expertise_length_sql(suffix)} {suffix} ON t.tconst = {suffix}.tconst" for suffix in EXPERTISE_SQL)
    + f" LEFT JOIN {GENRE_SQL} gl ON t.tconst = gl.tconst",
))
def feature_build(t: Tables):
    """The whole feature build, with its default sizes, on titles made from the part and line item tables."""
    table = FeatureBuild(AS_OF_YEAR, "combined", keep_wide=True).fit_transform(movie_inputs(t.part, t.lineitem))[1]
    sizes = [F.size(vector_to_array(f"{family}_pca")).alias(f"{family}_components") for family in ("text", "genre")]
    squares = lambda c: F.aggregate(vector_to_array(c), F.lit(0.0), lambda s, x: s + x * x)
    expertise = [r(squares(f"{suffix}_expertise_vec")).alias(f"{suffix}_squares") for suffix in EXPERTISE_SQL]
    return _plain(table, *sizes, *expertise, r(F.sqrt(squares("genre_vec")) / 1e6, 4).alias("genre_length"))


def _plain(table, *more):
    return table.select(
        *more, "tconst", "label", "releaseYear", r("runtimeMinutes", 4).alias("runtimeMinutes"), r("numVotes", 4).alias("numVotes"),
        "director_count", "writer_count", F.col("budget").cast("double").alias("budget"),
        r("text_sentiment_polarity").alias("text_sentiment_polarity"), "title_length", "movie_age", "movies_in_year",
    )


@query("feature_build_scored", " UNION ALL ".join(
    f"SELECT tconst, '{person}' AS role, category, round(mean, 6) AS expertise FROM {expertise_sql(person, links, '{} % 5 <> 0', '{} % 5 = 0')}"
    for person, links in (("director", DIRECTORS), ("writer", WRITERS))
))
def feature_build_scored(t: Tables):
    """Titles that were not in the fit: expertise comes from the training titles alone."""
    inputs = movie_inputs(t.part, t.lineitem)
    build = FeatureBuild(AS_OF_YEAR, "embedding", embedding="hashing", embedding_size=16, genre_components=2)
    fitted = build.fit(replace(inputs, titles=inputs.titles.where("tconst % 5 <> 0")))
    table = fitted.transform(replace(inputs, titles=inputs.titles.where("tconst % 5 = 0")))
    names = fitted.expertise.positions.select("position", "category")
    shown = []
    for role, suffix in (("director", "dir"), ("writer", "wri")):
        cells = table.select("tconst", F.posexplode(vector_to_array(f"{suffix}_expertise_vec")).alias("position", "value")).where("value <> 0")
        shown.append(cells.join(names, "position").select("tconst", F.lit(role).alias("role"), "category", r("value").alias("expertise")))
    return shown[0].unionByName(shown[1])
