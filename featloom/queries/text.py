"""Text operators over whole documents and titles."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from featloom.functions import text as ft
from featloom.operators import text_features as op
from featloom.operators.categories import explode_list
from featloom.operators.sparse import join_known, unpacked
from featloom.queries.registry import (
    Tables, query, r, rounded, sql_embedding_clean, sql_fingerprint_tokens, sql_fold, sql_no_punctuation, sql_strip,
)

from featloom.session import materialize


@query("title_length", "SELECT doc_id, CAST(length(replace(text, ' ', '')) AS INTEGER) AS title_length FROM documents")
def title_length(t: Tables):
    titled = t.documents.select("doc_id", F.col("text").alias("title"))
    return op.add_title_length(titled).drop("title")


@query("str_len", "SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents")
def str_len(t: Tables):
    return t.documents.select("doc_id", F.length("text").alias("n"))


@query("strip_punct", f"SELECT doc_id, {sql_no_punctuation(sql_strip('text'))} AS text FROM documents")
def strip_punct(t: Tables):
    return t.documents.select("doc_id", ft.tfidf_clean("text").alias("text"))


@query("embedding_clean", f"SELECT doc_id, {sql_embedding_clean('text')} AS text_embedding FROM documents")
def embedding_clean(t: Tables):
    return op.apply_embedding_clean(t.texts, "text").drop("text")


@query(
    "fingerprint_sorted",
    f"SELECT doc_id, array_to_string(list_sort(list_distinct({sql_fingerprint_tokens('text')})), ' ') AS text_fingerprint FROM documents",
)
def fingerprint_sorted(t: Tables):
    return op.apply_fingerprint(t.texts, "text", sort=True).drop("text")


@query(
    "fingerprint_ordered",
    f"SELECT doc_id, array_to_string({sql_fingerprint_tokens('text')}, ' ') AS text_fingerprint FROM documents",
)
def fingerprint_ordered(t: Tables):
    return op.apply_fingerprint(t.texts, "text", sort=False).drop("text")


@query(
    "title_patterns",
    """SELECT doc_id, CAST(contains(text, 'part') AS INTEGER) AS title_contains_part,
         CAST(contains(text, 'return') AS INTEGER) AS title_contains_return FROM documents""",
)
def title_patterns(t: Tables):
    return op.add_title_patterns(t.documents.select("doc_id", F.col("text").alias("title"))).drop("title")


STOP_WORDS = ("the", "of", "and", "in", "to", "is", "for", "on", "with", "la", "le", "der", "die", "und", "el", "de")
STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)


TFIDF_SQL = rf"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower({sql_no_punctuation(sql_strip('text'))}), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term
                FROM documents),
         c AS (SELECT doc_id, term, count(*) AS tf FROM w WHERE term NOT IN ({STOP}) GROUP BY ALL),
         i AS (SELECT term, ln((1.0 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf FROM c GROUP BY term),
         x AS (SELECT doc_id, c.term, tf * idf AS v FROM c JOIN i ON c.term = i.term)
       SELECT doc_id, term, round(v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM x"""


@query("tfidf_long", TFIDF_SQL)
def tfidf_long(t: Tables):
    return rounded(op.tfidf_long(t.texts, "doc_id", "text", STOP_WORDS), "tfidf")


@query("tfidf_vector", TFIDF_SQL)
def tfidf_vector(t: Tables):
    """TF-IDF vectors with a position for every term, shown as terms again."""
    texts = t.texts
    fitted = op.fit_tfidf_vectors(texts, "text", stop_words=STOP_WORDS)
    cells = unpacked(materialize(fitted.rows(texts, keep=["doc_id"]), "vectors"), "doc_id", "tfidf_vec")
    return join_known(cells, fitted.terms.select("position", "term", "hot"), "position").select("doc_id", "term", r("value").alias("tfidf"))


# Titles of few words: with as many numbers as words, products of word vectors are those of their rows of weights.
WORD_WEIGHTS = """w AS (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part),
  o AS (SELECT w, unnest(range(1, len(w))) AS i FROM w),
  s AS (SELECT w, i, unnest(range(i + 1, least(i + 5, len(w)) + 1)) AS j FROM o),
  p AS (SELECT w[i] AS a, w[j] AS b FROM s UNION ALL SELECT w[j], w[i] FROM s),
  n AS (SELECT a, b, count(*) AS n FROM p GROUP BY ALL),
  m AS (SELECT a, sum(n) AS m FROM n GROUP BY a),
  x AS (SELECT n.a, n.b, ln(n.n::DOUBLE * (SELECT sum(n) FROM n) / (l.m::DOUBLE * r.m)) AS x FROM n JOIN m l ON n.a = l.a JOIN m r ON n.b = r.a),
  g AS (SELECT l.a, r.a AS c, sum(l.x * r.x) AS g FROM x l JOIN x r ON l.b = r.b WHERE l.x > 0 AND r.x > 0 GROUP BY ALL)"""


@query(
    "embed_text",
    f"""WITH {WORD_WEIGHTS}, t AS (SELECT p_partkey, len(w) AS k, unnest(w) AS a FROM w)
        SELECT l.p_partkey, round(sum(coalesce(g, 0)) / any_value(l.k * l.k), 6) AS squares
        FROM t l JOIN t r ON l.p_partkey = r.p_partkey LEFT JOIN g ON g.a = l.a AND g.c = r.a GROUP BY 1""",
)
def embed_text(t: Tables):
    """Averaged word vectors of the titles, by the company of their words: squared lengths."""
    titles = t.part.select("p_partkey", "p_name")
    out = op.fit_embedding(titles, "p_name", size=1 << 8).transform(titles)
    squares = F.aggregate(vector_to_array("emb_vec"), F.lit(0.0), lambda s, x: s + x * x)
    return out.select("p_partkey", r(squares).alias("squares"))


@query("embed_documents")
def embed_documents(t: Tables):
    """Averaged word vectors of whole documents."""
    texts = t.texts
    return op.fit_embedding(texts, "text", size=16, min_count=50).transform(texts).select("doc_id", vector_to_array("emb_vec").alias("vector"))


@query(
    "embed_text_hashed",
    f"""SELECT doc_id, CASE WHEN regexp_matches({sql_embedding_clean('text')}, '[A-Za-z0-9_]') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS norm
        FROM documents""",
)
def embed_text_hashed(t: Tables):
    texts = t.texts
    norm = F.sqrt(F.aggregate(vector_to_array("emb_vec"), F.lit(0.0), lambda s, x: s + x * x))
    return op.fit_embedding(texts, "text", method="hashing").transform(texts).select("doc_id", r(norm).alias("norm"))


@query(
    "combined_text",
    """SELECT p_partkey, coalesce(CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name END, '') || ' '
         || coalesce(CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_type END, '') AS text FROM part""",
)
def combined_text(t: Tables):
    k = F.col("p_partkey")
    rows = t.part.select(
        k, F.when(k % 4 != 0, F.col("p_name")).alias("overview"), F.when(k % 5 != 0, F.col("p_type")).alias("tagline")
    )
    return rows.select("p_partkey", op.combined_text(rows).alias("text"))


TOKENS = f"(SELECT doc_id, unnest(regexp_extract_all({sql_fold('lower(text)')}, '[a-z]+')) AS word FROM documents)"


@query(
    "sentiment_lexicon",
    f"""WITH tok AS (SELECT * FROM {TOKENS}),
         lex AS (SELECT word, 2 * avg(quality) - 1 AS polarity, avg(toxic) AS subjectivity
                 FROM (SELECT DISTINCT doc_id, word FROM tok) d JOIN labels l ON d.doc_id = l.doc_id GROUP BY word),
         s AS (SELECT doc_id, avg(polarity) AS p, avg(subjectivity) AS s FROM tok JOIN lex ON tok.word = lex.word GROUP BY doc_id)
       SELECT documents.doc_id, round(coalesce(p, 0), 6) AS text_sentiment_polarity,
         round(coalesce(s, 0), 6) AS text_sentiment_subjectivity
       FROM documents LEFT JOIN s ON documents.doc_id = s.doc_id""",
)
def sentiment_lexicon(t: Tables):
    out = op.lexicon_sentiment(t.texts, "doc_id", "text", materialize(label_lexicon(t), "lexicon"))
    return rounded(out, "text_sentiment_polarity", "text_sentiment_subjectivity")


# Common words of the test texts stand in for negations; short words scale.
TURNS = ("not", "in", "la", "las", "und", "mit")
MODIFIED_SQL = f"""WITH tok AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i
      FROM (SELECT doc_id, regexp_extract_all({sql_fold('lower(text)')}, '[a-z]+') AS w FROM documents)),
    lex AS (SELECT word, 2 * avg(quality) - 1 AS p, avg(toxic) AS s, CASE WHEN length(word) <= 2 THEN 1.25 ELSE 1 END AS k
            FROM (SELECT DISTINCT doc_id, word FROM tok) d JOIN labels l ON d.doc_id = l.doc_id GROUP BY word),
    t AS (SELECT doc_id, i, word IN {TURNS} AS turns, p, s, coalesce(k, 1) AS k FROM tok LEFT JOIN lex USING (word) WHERE p IS NOT NULL OR word IN {TURNS}),
    m AS (SELECT *, NOT turns AND k <> 1 AS modifier FROM t),
    o AS (SELECT *, lag(i) OVER w AS before, lag(modifier) OVER w AS after_modifier, lead(i) OVER w AS next, lead(turns) OVER w AS next_turns,
            max(CASE WHEN turns THEN i END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_turn,
            max(CASE WHEN NOT turns AND NOT modifier THEN i END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_plain
          FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
    c AS (SELECT *, sum(CASE WHEN after_modifier AND before = i - 1 AND NOT turns THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS chain FROM o),
    x AS (SELECT *, coalesce(product(k) OVER (PARTITION BY doc_id, chain ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS scale FROM c),
    v AS (SELECT doc_id, greatest(-1, least(1, p * scale)) * CASE WHEN last_turn IS NOT NULL AND i - last_turn <= 3 AND coalesce(last_plain < last_turn, true)
              THEN -0.5 ELSE 1 END AS p, greatest(-1, least(1, s * scale)) AS s
          FROM x WHERE NOT turns AND NOT (modifier AND coalesce(next = i + 1 AND NOT next_turns, false))),
    a AS (SELECT doc_id, avg(p) AS p, avg(s) AS s FROM v GROUP BY 1)
  SELECT doc_id, round(coalesce(p, 0), 6) AS text_sentiment_polarity, round(coalesce(s, 0), 6) AS text_sentiment_subjectivity
  FROM documents LEFT JOIN a USING (doc_id)"""


@query("sentiment_modified", MODIFIED_SQL)
def sentiment_modified(t: Tables):
    """Polarity of whole documents with modifiers and negations."""
    lexicon = label_lexicon(t).withColumn("intensity", F.when(F.length("word") <= 2, 1.25))
    out = op.modified_sentiment(t.texts, "doc_id", "text", materialize(lexicon, "lexicon"), TURNS, word_pattern="[a-z]+")
    return rounded(out, "text_sentiment_polarity", "text_sentiment_subjectivity")


def label_lexicon(t: Tables):
    """A lexicon from the labelled texts: mean quality and toxicity of the texts a word occurs in."""
    words = F.array_distinct(ft.words(ft.ascii_fold(F.lower("text")), "[a-z]+"))
    labelled = t.texts.join(t.labels, "doc_id")
    return labelled.select(F.explode(words).alias("word"), "quality", "toxic").groupBy("word").agg(
        (2 * F.avg("quality") - 1).alias("polarity"), F.avg("toxic").alias("subjectivity"), F.count(F.lit(1)).alias("uses")
    )


@query(
    "explode_list",
    "SELECT page_id, unnest(string_split(url, '/')) AS segment FROM pages",
)
def explode_list_query(t: Tables):
    return explode_list(t.pages.select("page_id", F.split("url", "/").alias("segments")), "segments", "segment")
