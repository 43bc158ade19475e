"""The operators bound to the test tables, with SQL checks where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.llm import decontaminate, divergence, embedding_dedup, filter_audit, html_text, language_id, licenses, mixing, pii, secrets, simhash, url_filter, warc
from featloom.llm.common import digest_of, listed
from featloom.queries.registry import Query

REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``."""

    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[name] = Query(name, fn, sql)
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SITE_RULES = (
    url_filter.site_rule("allow", "org/"), url_filter.site_rule("block", "example.org/es/"), url_filter.site_rule("block", "example.org/en/1"),
    url_filter.site_rule("allow", "com/fr/"), url_filter.site_rule("block", "com/de/"),
)


@query("op1_url_filter", r"""
WITH p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS h, rest FROM p),
u AS (SELECT page_id, translate(coalesce(h, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(substr(rest, length(h) + 1), '^[^?#]*'), '') AS path FROM q),
r AS (SELECT *, '.' || host AS d, '.' || host || path AS c FROM u),
m AS (SELECT *, CASE WHEN ends_with(d, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                     WHEN ends_with(d, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                     WHEN ends_with(d, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                     WHEN ends_with(d, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
                     WHEN ends_with(d, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM r)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL OR host = ''
         OR regexp_matches(c, '^[^/]*[.](ads|adserver|doubleclick|tracker)[.][^/]*/')
         OR contains(c, '/wp-login') OR contains(c, '/ads/') OR ends_with(c, '.exe') OR ends_with(c, '.apk') THEN 'block'
       ELSE 'allow' END AS verdict FROM m""")
def op1(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"), SITE_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op3_warc", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first, count(*) AS n FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, d.payload_digest,
  CASE WHEN f.first IS NULL OR f.first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f.first <> page_id THEN f.first END AS refers_to FROM d LEFT JOIN f USING (payload_digest)""")
def op3(spark, sf_dir):
    index = warc.write(table(spark, sf_dir, "pages"))
    return warc.read(index, payload=False).selectExpr("id AS page_id", "payload_bytes", "digest AS payload_digest", "type AS record_type", "refers_to")


@query("op4_simhash")
def op4(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


@query("op5_secrets")
def op5(spark, sf_dir):
    found = secrets.find(table(spark, sf_dir, "documents"))
    count = lambda c: F.size(c).cast("long").alias(f"n_{c}")
    base = secrets.base_spans()
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), digest_of(base).alias("base_sha256"), listed(F.concat(base, "linked")).alias("spans")
    )


@query("op7_pii")
def op7(spark, sf_dir):
    found = pii.find(table(spark, sf_dir, "documents"))
    count = lambda c: F.size(c).cast("long").alias(f"n_{c}")
    base = pii.base_spans()
    return found.select("doc_id", *map(count, pii.BASE), digest_of(base).alias("base_sha256"), listed(F.concat(base, "added")).alias("spans"))


@query("op9_mixing", mixing.mixing_sql())
def op9(spark, sf_dir):
    out = mixing.sample(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_tokens", "topic", F.round("weight", 5).alias("weight"), F.round("probability", 5).alias("probability"), "sampled")


@query("op10_decontamination", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS g FROM bs),
ds AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM bw)),
dw AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g FROM ds),
h AS (SELECT DISTINCT doc_id, item_id, s, n FROM dw JOIN bw USING (n, g)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY 1),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM h) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)""")
def op10(spark, sf_dir):
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


@query("op2_embedding_dedup", """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)""")
def op2(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op6_language_id")
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = language_id.predict(docs, language_id.fit(docs), keep=["doc_id"])
    held_out = F.coalesce(~language_id.learnable(F.col("doc_id")), F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op8_html_text")
def op8(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op11_source_divergence", r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
u AS (SELECT id, lang, source, unnest(w) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS total FROM u GROUP BY ALL HAVING count(DISTINCT id) >= 30),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (total + 5)) // (sum(total) OVER l + 5 * count(*) OVER l)::HUGEINT AS q
      FROM k WINDOW l AS (PARTITION BY lang)),
n AS (SELECT lang, source, term, count(*) AS n FROM u JOIN k USING (lang, term) GROUP BY ALL),
c AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN n USING (lang, source, term)),
p AS MATERIALIZED (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER s + 5 * count(*) OVER s)::HUGEINT AS p
      FROM c WINDOW s AS (PARTITION BY lang, source)),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM x)
SELECT * FROM r WHERE part = 'pair' OR rank <= 50""")
def op11(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


@query("op12_license_scan", licenses.scan_sql())
def op12(spark, sf_dir):
    out = licenses.scan(table(spark, sf_dir, "documents"))
    spot = lambda at: F.when(F.size("places") > 0, F.element_at("places", at).word)
    return out.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), spot(1).alias("first_word"), spot(-1).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


@query("op13_filter_audit", r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY x) AS least FROM d),
b AS (SELECT doc_id, part, (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
        + 4 * (100 * len(regexp_extract_all(x, '[A-Z]')) > 2 * length(x))::INT + 8 * regexp_matches(x, '[#$%&*|]')::INT
        + 16 * coalesce(least < doc_id, false)::INT AS bits FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
c AS MATERIALIZED (SELECT part, bits, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM b LEFT JOIN l USING (doc_id) GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT v.f || w.f || x.f || y.f || z.f AS filter_order, [v.bit, w.bit, x.bit, y.bit, z.bit] AS bits FROM f v, f w, f x, f y, f z
      WHERE v.bit + w.bit + x.bit + y.bit + z.bit = 31 AND v.bit | w.bit | x.bit | y.bit | z.bit = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
      FROM o, (SELECT unnest(range(1, 6))::INT AS step)),
t AS (SELECT part, filter_order, step, bit,
        sum(CASE WHEN bits & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN bits & before = 0 AND bits & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN bits & before <> 0 AND bits & bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN bits = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN bits & before = 0 AND bits & bit <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN bits & before = 0 AND bits & bit <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost FROM c, s GROUP BY ALL)
SELECT * EXCLUDE (bit), sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM t""")
def op13(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
