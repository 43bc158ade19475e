"""Sampling a mixture whose token shares meet given marginals, in DataFrame functions only."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featloom.llm.common import fresh, materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Exponent on the shares of each dimension where no target is given: below 1 small classes gain weight.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.9}


def topic_of(text: Column) -> Column:
    """A plain class of content: table, markup, capitals, or prose by length. Null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    n = F.length(text)
    without = lambda pattern: n - F.length(F.regexp_replace(text, pattern, ""))
    return (
        F.when(n == 0, "empty").when(without("[|]") * 20 > n, "table").when(without("[#$%&*<>{}]") * 20 > n, "markup")
        .when(without("[A-Z]") * 4 > n, "capitals").when(n < 500, "short prose").when(n < 5000, "prose").otherwise("long prose")
    )


def rake(cells: DataFrame, dims: list[str], mass: str, targets: dict[str, DataFrame], rounds: int = 20, tolerance: float = 1e-9,
         chunk: int = 4) -> tuple[DataFrame, float]:
    """``cells`` with ``weight``, and the largest gap left: proportional fitting of ``mass`` to the target shares of every dimension.

    ``cells`` has one row for each combination of values; ``targets[dim]`` has
    ``(dim, share)``, met once. In each round the weights are scaled to the shares
    of one dimension after the other by a sum over the combinations of each value
    (which spills, and never sees a document). Every ``chunk`` rounds are one job,
    written to the shared folder. It ends when no marginal is off by more than
    ``tolerance``, or after ``rounds``; the gap then tells how far off the worst
    is. Cells without mass or without a target get 0.
    """
    now = cells.withColumn("weight", F.col(mass).cast("double"))
    for k, dim in enumerate(dims):
        now = now.join(targets[dim].select(dim, F.col("share").alias(f"share{k}")), dim, "left").fillna(0.0, [f"share{k}"])
    now = materialize(now, "cells")
    gap, done = None, 0
    while done < rounds and (gap is None or gap > tolerance):
        for _ in range(min(chunk, rounds - done)):
            for k, dim in enumerate(dims):
                total, share = F.sum("weight").over(Window.partitionBy(dim)), F.col(f"share{k}")
                scaled = F.when(total > 0, F.col("weight") * (share / total)).otherwise(0.0)
                now = now.withColumns({"weight": scaled, f"gap{k}": F.abs(share - total)})
            done += 1
        now = materialize(now, "cells")
        gap = now.agg(F.max(F.greatest(*[f"gap{k}" for k in range(len(dims))]))).head()[0] or 0.0
    return now.select(*cells.columns, "weight"), gap or 0.0


def sample(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", topic: Column | None = None,
           shares: dict[str, dict[str, float]] | None = None, temper: dict[str, float] | None = None, seed: int = 7) -> DataFrame:
    """``docs`` with ``n_tokens``, ``topic``, ``weight``, ``probability`` and ``sampled``.

    Token weights are raked to target shares of source, language and topic:
    ``shares[dim]`` where given (values it does not name get 0), else the share of
    tokens to the power ``temper[dim]``. ``weight`` is how many times its present
    share of tokens a document should have; documents are taken with probability
    ``weight / largest weight``, so that the expected shares of the sample are the
    targets. Targets that no weights meet together (a log line gives the gap left)
    are met as far as the rounds bring them. The draw is a hash of key and ``seed``: the same on every run, and
    the same for rows of equal key. A document without tokens has weight 0 and is
    never taken. Null source and language are classes of their own. One row for
    each input row; columns of the five names are replaced.
    """
    temper = {**TEMPER, **(temper or {})}
    dims = {name: fresh(name) for name in ("source", "lang", "topic")}
    tagged = lambda c: F.when(c.isNull(), "0").otherwise(F.concat(F.lit("1"), c.cast("string")))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.drop("topic") if topic is None else docs
    rows = rows.withColumn("topic", topic_of(F.col(text)) if topic is None else topic)
    rows = rows.withColumn("n_tokens", F.regexp_count(body, F.lit(WORD)).cast("long"))
    rows = rows.withColumns({dims["source"]: tagged(F.col(source)), dims["lang"]: tagged(F.col(lang)), dims["topic"]: tagged(F.col("topic"))})
    cells = rows.where("n_tokens > 0").groupBy(*dims.values()).agg(F.sum("n_tokens").alias("tokens"))
    cells = materialize(cells, "token-cells")
    total = cells.agg(F.sum("tokens")).head()[0] or 0
    targets = {}
    for name, column in dims.items():
        if shares and name in shares:
            given = [("0" if k is None else f"1{k}", float(v) / sum(shares[name].values())) for k, v in shares[name].items()]
            targets[column] = docs.sparkSession.createDataFrame(given, f"{column} string, share double")
            continue
        powers = cells.groupBy(column).agg(F.pow(F.sum("tokens") / F.lit(float(total or 1)), F.lit(temper[name])).alias("power"))
        norm = powers.agg(F.sum("power")).head()[0] or 1.0
        targets[column] = materialize(powers.select(column, (F.col("power") / norm).alias("share")), "targets")
    fitted, gap = rake(cells, list(dims.values()), "tokens", targets)
    if gap > 1e-6:
        logging.getLogger(__name__).warning("the targets are not met together: a marginal is off by a share of %.3g", gap)
    fitted = fitted.withColumn("ratio", F.col("weight") / F.col("tokens") * float(total))
    top = fitted.agg(F.max("ratio")).head()[0] or 1.0
    fitted = fitted.select(*dims.values(), F.col("ratio").alias("weight"))
    draw = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("double") / 2.0**32
    has = F.col("n_tokens") > 0
    out = rows.drop("weight").join(fitted, list(dims.values()), "left").withColumn("weight", F.when(has, F.coalesce("weight", F.lit(0.0))).otherwise(0.0))
    out = out.withColumn("probability", F.col("weight") / top)
    return out.withColumn("sampled", draw < F.col("probability")).drop(*dims.values())


def mixing_sql(rounds: int = 20, seed: int = 7) -> str:
    """The same over ``documents`` as one statement, with the rounds written out."""
    share = lambda dim: (
        f"t_{dim} AS (SELECT {dim}, pow(sum(tokens) / (SELECT sum(tokens) FROM c0), {TEMPER[dim]}) AS p FROM c0 GROUP BY 1),"
        f" s_{dim} AS (SELECT {dim}, p / sum(p) OVER () AS share FROM t_{dim})"
    )
    steps, last = [], "c1"
    for r in range(rounds):
        for dim in TEMPER:
            name = f"r{r}_{dim}"
            steps.append(
                f"{name} AS MATERIALIZED (SELECT c.* REPLACE (weight * s.share / sum(weight) OVER (PARTITION BY c.{dim}) AS weight)"
                f" FROM {last} c JOIN s_{dim} s ON c.{dim} IS NOT DISTINCT FROM s.{dim})"
            )
            last = name
    less = lambda pattern: f"length(x) - length(regexp_replace(x, '{pattern}', '', 'g'))"
    return rf"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS x FROM documents),
k AS (SELECT doc_id, source, lang, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n_tokens,
  CASE WHEN x = '' THEN 'empty' WHEN ({less('[|]')}) * 20 > length(x) THEN 'table' WHEN ({less('[#$%&*<>{}]')}) * 20 > length(x) THEN 'markup'
       WHEN ({less('[A-Z]')}) * 4 > length(x) THEN 'capitals' WHEN length(x) < 500 THEN 'short prose' WHEN length(x) < 5000 THEN 'prose'
       ELSE 'long prose' END AS topic FROM d),
c0 AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM k WHERE n_tokens > 0 GROUP BY ALL),
{', '.join(share(dim) for dim in TEMPER)},
c1 AS (SELECT *, tokens AS weight FROM c0),
{', '.join(steps)},
f AS (SELECT source, lang, topic, weight / tokens * (SELECT sum(tokens) FROM c0) AS ratio FROM {last}),
o AS (SELECT doc_id, n_tokens, k.topic, CASE WHEN n_tokens > 0 THEN coalesce(ratio, 0) ELSE 0 END AS weight,
        (SELECT max(ratio) FROM f) AS top FROM k LEFT JOIN f
      ON k.source IS NOT DISTINCT FROM f.source AND k.lang IS NOT DISTINCT FROM f.lang AND k.topic = f.topic)
SELECT doc_id, n_tokens, topic, round(weight, 5) AS weight, round(weight / coalesce(top, 1), 5) AS probability,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{seed}'), 1, 8))::BIGINT / 4294967296.0 < weight / coalesce(top, 1) AS sampled FROM o"""
