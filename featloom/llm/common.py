"""Expressions and helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.session import materialize, scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLOCK = 64


def ascii_lower(text: Column | str) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(F.col(text) if isinstance(text, str) else text, UPPER, LOWER)


def keyed(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` with a row number ``key``, written to the shared folder so that the numbers stay the same on every read."""
    return materialize(df.withColumn(key, F.monotonically_increasing_id()), name)


BUCKETS = 1 << 20


def parted(rows: DataFrame, table: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` that ``table`` may hold by the columns ``on``, and those that it surely does not.

    Keys fall into ``BUCKETS`` hash buckets; the list of those that ``table`` uses, at
    most 2^20 numbers, is broadcast. So rows without a partner need not be moved to
    find that out, however large the table; where it uses most buckets, most are.
    """
    bucket = F.pmod(F.xxhash64(*on), F.lit(BUCKETS))
    name = fresh("bucket")
    used = F.broadcast(table.select(bucket.alias(name)).distinct())
    marked = rows.withColumn(name, bucket)
    return marked.join(used, name, "left_semi").drop(name), marked.join(used, name, "left_anti").drop(name)


def fresh(prefix: str) -> str:
    """A column name that no input has."""
    return f"_{prefix}_{uuid.uuid4().hex[:12]}"


def with_spans(df: DataFrame, text: str, patterns: dict[str, tuple[str, Column | None]], before: int = 0, after: int = 0) -> DataFrame:
    """Add, for each name, ``array<struct<start, end, hit, before, after>>``: the matches of a Java pattern, leftmost, not overlapping.

    Offsets are code points, the end exclusive; ``before`` and ``after`` hold so
    many characters of context, up to the neighbouring match. A pattern comes
    with a cheap test (or None) that a text must meet to be searched at all. The
    pieces between the matches give the offsets as a running sum, taken in blocks,
    so that a text with very many matches costs little more than its length.
    """
    hits, pieces, steps, sums, spans = {}, {}, {}, {}, {}
    for name, (pattern, test) in patterns.items():
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        hits[f"{name}__hits"] = found if test is None else F.when(test, found).otherwise(F.array().cast("array<string>"))
        cut = F.transform(
            F.split(F.col(text), pattern, -1),
            lambda g: F.struct(
                F.length(g).alias("n"),
                F.substring(g, -before, before).alias("tail") if before else F.lit("").alias("tail"),
                F.substring(g, 1, after).alias("head") if after else F.lit("").alias("head"),
            ),
        )
        pieces[f"{name}__pieces"] = F.when(F.size(f"{name}__hits") > 0, cut)
        steps[f"{name}__steps"] = F.zip_with(
            F.slice(f"{name}__pieces", 1, F.size(f"{name}__hits")), f"{name}__hits", lambda g, h: g.n + F.length(h)
        )
        k = f"{name}__steps"
        sums[f"{name}__sums"] = F.expr(
            f"aggregate(transform(sequence(0, greatest(size({k}) - 1, 0) div {_BLOCK}),"
            f" b -> aggregate(slice({k}, b * {_BLOCK} + 1, {_BLOCK}), 0, (a, x) -> a + x)),"
            " array(0), (a, x) -> array_append(a, element_at(a, -1) + x))"
        )
        end = (
            f"({name}__sums[i div {_BLOCK}]"
            f" + aggregate(slice({k}, (i div {_BLOCK}) * {_BLOCK} + 1, i % {_BLOCK} + 1), 0, (a, x) -> a + x))"
        )
        spans[name] = F.expr(
            f"transform({name}__hits, (h, i) -> named_struct('start', {end} - length(h), 'end', {end}, 'hit', h,"
            f" 'before', {name}__pieces[i].tail, 'after', {name}__pieces[i + 1].head))"
        )
    return df.withColumns(hits).withColumns(pieces).withColumns(steps).withColumns(sums).withColumns(spans).drop(*hits, *pieces, *steps, *sums)


def digest_of(spans: Column) -> Column:
    """Lower-case hex SHA-256 of ``kind:start:end`` items joined by commas, from ``array<struct<start, order, end, kind>>``."""
    return F.sha2(listed(spans), 256)


def listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ","
    )


def labelled(spans: Column, kind: str, order: int) -> Column:
    return F.transform(
        spans, lambda s: F.struct(s.start.alias("start"), F.lit(order).alias("order"), s.end.alias("end"), F.lit(kind).alias("kind"))
    )


__all__ = ["ascii_lower", "digest_of", "fresh", "keyed", "labelled", "listed", "materialize", "parted", "scratch_path", "with_spans"]
