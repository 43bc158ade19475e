"""License notices in documents: fixed phrases, and blocks of text that hold the words of a notice."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import materialize
from featloom.llm.decontaminate import words_of

#: Phrases that name a license by themselves.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Public notices, one for each passage of its own; labels may repeat.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
            " files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,"
            " publish, distribute, sublicense, and/or sell copies of the Software."),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License."
                 " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"
            " as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
            " conditions are met."),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("reserved", "Copyright. All rights reserved."),
]
THRESHOLD = 0.9  # of the distinct words of a template; below, "released under the ... license" fits the notice of any license
BLOCKS = pa.list_(pa.struct([("width", pa.int32()), ("first", pa.int32()), ("length", pa.int32()), ("tokens", pa.list_(pa.string()))]))


def places(words: list[bytes], phrases: dict[bytes, str]) -> list[tuple[int, str]]:
    """First word and label of every place where the words of a phrase stand one after the other, overlapping ones too."""
    flat = b" " + b" ".join(words) + b" "
    out = []
    for phrase, label in phrases.items():
        at, seen, word = flat.find(phrase), 0, 0
        while at >= 0:
            word += flat.count(b" ", seen, at)
            seen = at
            out.append((word, label))
            at = flat.find(phrase, at + 1)
    return out


def template_tokens(templates: list[tuple[str, str]]) -> list[tuple[str, list[str], int]]:
    """Label, distinct words and number of words of each template that has words."""
    found = []
    for label, text in templates:
        words = [w.decode("utf-8", "surrogatepass") for w in words_of(text)]
        if words:
            found.append((label, sorted(set(words)), len(words)))
    return found


def widths_of(templates: list[tuple[str, list[str], int]]) -> list[int]:
    """Widths of blocks: powers of two that reach every template's number of words."""
    return sorted({1 << max(3, (n - 1).bit_length()) for _, _, n in templates})


def token_counts(rows: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each word of the templates stands; as many numbers as these words."""
    known = {w.encode("utf-8", "surrogatepass"): k for k, w in enumerate(vocabulary)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(known), np.int64)
        for frame in batches:
            for body in frame["body"]:
                total[[known[w] for w in known.keys() & set(words_of(body))]] += 1
        yield pd.DataFrame({"k": np.arange(len(known)), "n": total})

    counts = rows.select("body").mapInPandas(count, "k int, n long").groupBy("k").agg(F.sum("n").alias("n"))
    found = {r.k: r.n for r in counts.collect()}
    return {w: found.get(k, 0) for k, w in enumerate(vocabulary)}


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] | None = None,
         phrases: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document: ``key``, ``n_words``, ``places``, ``blocks``, ``labels``, ``base_labels``, ``score``.

    ``places``: ``array<struct<word, label>>``, every place of a phrase in order.
    ``blocks``: ``array<struct<label, first, length, score>>``, every block of text
    that holds at least ``threshold`` of the distinct words of a template.
    ``labels`` and ``base_labels``: distinct labels of both, and of the places;
    ``score``: 1 with a place, else the highest share held by a block, else 0.

    A text is cut into blocks of ``2 * width`` words that begin every ``width``
    words, for every width of ``widths_of``, so that each passage of up to
    ``width`` words lies whole in a block; a template is sought in the blocks of
    its own width. The join is exact: the words of the templates are ordered by
    the number of documents that have them, rarest first. A block that holds
    enough of a template has one of its first ``n - ceil(threshold * n) + 1``
    words; only blocks with such a word leave the scan, with their words that any
    template has, in that order. They meet the prefixes by word, where number and
    position of the words leave room for the threshold, and the shared words are
    then counted. Templates are a parameter: their words and prefixes are sent to
    all tasks, and one number a word reaches the driver.

    Null and empty texts have no words. Repeated documents, null keys and ties
    are judged each by itself; other columns are not read. An empty table gives
    an empty one, no templates no blocks.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    known = template_tokens(TEMPLATES if templates is None else templates)
    sought = {b" " + b" ".join(words_of(p)) + b" ": label for p, label in (PHRASES if phrases is None else phrases).items() if words_of(p)}
    rows = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("body"))
    vocabulary = sorted({w for _, words, _ in known for w in words})
    counts = token_counts(rows, vocabulary) if vocabulary else {}
    rank = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (counts[w], w)))}
    widths = widths_of(known)
    prefixes, wanted = [], {w: set() for w in widths}
    for k, (label, words, n) in enumerate(known):
        width = next(w for w in widths if w >= n)
        words = sorted(words, key=rank.get)
        need = ceil(threshold * len(words) - 1e-9)
        for at, word in enumerate(words[: len(words) - need + 1]):
            prefixes.append((k, label, width, word, at, len(words), need, words))
            wanted[width].add(word.encode("utf-8", "surrogatepass"))
    order = {w.encode("utf-8", "surrogatepass"): k for w, k in rank.items()}
    names = sorted(rank, key=rank.get)

    def blocks_of(words: list[bytes]) -> list[dict]:
        at = [(i, order[w]) for i, w in enumerate(words) if w in order]
        out = []
        for width in widths:
            firsts = {order[w] for w in wanted[width]}
            starts = sorted({s for i, t in at if t in firsts for s in (i // width * width, i // width * width - width) if s >= 0 and (s == 0 or s + width < len(words))})
            if not starts:
                continue
            index = [i for i, _ in at]
            for start in starts:
                lo, hi = np.searchsorted(index, [start, start + 2 * width])
                tokens = [names[t] for t in sorted({t for _, t in at[lo:hi]})]
                out.append({"width": width, "first": start, "length": min(2 * width, len(words) - start), "tokens": tokens})
        return out

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, found, blocks = [], [], []
            for body in batch.column("body").to_pylist():
                words = words_of(body)
                n_words.append(len(words))
                found.append([{"word": w, "label": label} for w, label in sorted(places(words, sought))])
                blocks.append(blocks_of(words))
            spots = pa.array(found, pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("key"), pa.array(n_words, pa.int64()), spots, pa.array(blocks, BLOCKS)],
                names=["uid", "key", "n_words", "places", "candidates"],
            )

    kind = dict(rows.dtypes)["key"]
    shape = f"uid long, key {kind}, n_words long, places array<struct<word:long,label:string>>, candidates array<struct<width:int,first:int,length:int,tokens:array<string>>>"
    seen = materialize(rows.withColumn("uid", F.monotonically_increasing_id()).select("uid", "key", "body").mapInArrow(look, shape), "license-blocks")
    fields = "template int, label string, width int, token string, at int, size int, need int, words array<string>"
    prefix = docs.sparkSession.createDataFrame(prefixes, fields)
    block = seen.select("uid", F.explode("candidates").alias("b")).select("uid", "b.*")
    # As many rows as the prefixes of the templates have words, whatever the corpus.
    prefix = F.broadcast(prefix)
    token = block.select("*", F.posexplode("tokens").alias("position", "token"))
    room = F.least(F.col("size") - F.col("at"), F.size("tokens") - F.col("position"))
    met = (
        token.join(prefix, ["width", "token"]).where((F.size("tokens") >= F.col("need")) & (room >= F.col("need")))
        .withColumn("shared", F.size(F.array_intersect("tokens", "words"))).where("shared >= need")
        .select("uid", "label", "first", "length", (F.col("shared") / F.col("size")).alias("score"), "template").distinct()
    )
    hits = met.groupBy("uid").agg(F.sort_array(F.collect_set(F.struct("first", "length", "label", "score"))).alias("blocks"))
    out = seen.select("uid", "key", "n_words", "places").join(materialize(hits, "license-hits"), "uid", "left")
    none = F.array().cast("array<struct<first:int,length:int,label:string,score:double>>")
    out = out.withColumn("blocks", F.coalesce("blocks", none))
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p.label)))
    best = F.coalesce(F.array_max(F.transform("blocks", lambda b: b.score)), F.lit(0.0))
    return out.select(
        F.col("key").alias(key), "n_words", "places", "blocks", base.alias("base_labels"),
        F.array_sort(F.array_union(base, F.transform("blocks", lambda b: b.label))).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )


def scan_sql() -> str:
    """The columns of the query over ``documents`` as one statement: every block against every template."""
    known = template_tokens(TEMPLATES)
    widths = widths_of(known)
    quote = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    rows = ", ".join(
        f"('{label}', {next(w for w in widths if w >= n)}, {ceil(THRESHOLD * len(words) - 1e-9)}, {quote(words)})" for label, words, n in known
    )
    spots = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(len(w)), lambda i: w[i + 1:i + {len(p.split())}] = {quote(p.split())})) AS word FROM d"
        for p, label in PHRASES.items()
    )
    return rf"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT * FROM (VALUES {rows}) AS t(label, width, need, words)),
b AS (SELECT doc_id, width, list_distinct(w[first + 1:first + 2 * width]) AS x
      FROM (SELECT doc_id, w, width, unnest(range(0, greatest(len(w) - width, 1), width)) AS first FROM d, (SELECT DISTINCT width FROM t))),
m AS (SELECT doc_id, label, len(list_intersect(x, words)) AS shared, len(words) AS size FROM b JOIN t USING (width)
      WHERE len(list_intersect(x, words)) >= need),
p AS ({spots}),
n AS (SELECT doc_id, count(*) AS n_base, min(word) AS first_word, max(word) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
      FROM p GROUP BY 1),
a AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM m UNION ALL SELECT doc_id, label FROM p) GROUP BY 1),
s AS (SELECT doc_id, max(shared / size) AS score FROM m GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN a USING (doc_id) LEFT JOIN s USING (doc_id)"""
