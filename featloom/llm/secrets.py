"""Secrets in texts: single patterns, and weak parts that only count together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import keyed, labelled, with_spans

VALUE = "[A-Za-z0-9+/_.=-]"
# Fixed values of the contract.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{16,}"  # the same matches as runs of any length of which the short ones are dropped
BASE = ("assign", "access", "hex")
# Weak parts: each alone is common in clean text.
USER = r"""(?i:user(?:_?name)?|login|client_?id|account_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
OPAQUE = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
ENDPOINT = r"""(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|redis|amqp)://[^\x20\x09-\x0D"'<>]+"""
LINKED = ("linked_id", "linked_secret", "linked_endpoint")


def _weak_value(hit: Column) -> Column:
    """Mixed letters and digits, as random keys have them."""
    return hit.rlike("[0-9]") & hit.rlike("[a-z]") & hit.rlike("[A-Z]")


def scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row for each document: ``uid``, ``key``, the base spans and the weak parts of its whole text."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("body"))
    body = F.col("body")
    named = body.contains(":") | body.contains("=")
    rows = with_spans(rows, "body", {
        "assign": (ASSIGN, named), "access": (ACCESS, body.contains("AKIA")), "hex": (HEX, None),
        "user": (USER, named), "opaque": (OPAQUE, None), "endpoint": (ENDPOINT, body.contains("://")),
    })
    value = lambda s: F.regexp_extract(s.hit, ASSIGN, 1)
    return rows.select(
        "key",
        F.filter("assign", lambda s: F.length(value(s)) >= 12).alias("assign"),
        F.filter("access", lambda s: F.length(s.hit) >= 18).alias("access"),
        "hex", "user", F.filter("opaque", lambda s: _weak_value(s.hit)).alias("opaque"), "endpoint",
    )


def linked(found: DataFrame, reach: int) -> DataFrame:
    """``(uid, start, end, kind)`` of weak parts near their complements.

    An identifier counts near a secret, an opaque value near an identifier, an
    endpoint near both. Near is at most ``reach`` code points between the two.
    Parts are joined by document and stretch of ``reach`` points, an anchor being
    looked up in the stretches that it and its reach touch, so a stretch holds few parts.
    """
    part = lambda name, role, weak: found.select(
        "uid", F.lit(role).alias("role"), F.lit(weak).alias("weak"), F.explode(name).alias("s")
    ).select("uid", "role", "weak", "s.start", "s.end")
    secrets = part("assign", "secret", False).unionByName(part("hex", "secret", False)).unionByName(part("opaque", "secret", True))
    ids = part("access", "id", False).unionByName(part("user", "id", True))
    ends = part("endpoint", "endpoint", True)

    def near(left: DataFrame, right: DataFrame) -> DataFrame:
        a = left.select("uid", *[F.col(c).alias(f"a_{c}") for c in ("start", "end", "weak")])
        a = a.withColumn("stretch", F.explode(F.sequence(F.expr(f"(a_start - {reach}) div {reach} - 1"), F.expr(f"(a_end + {reach}) div {reach}"))))
        b = right.select("uid", *[F.col(c).alias(f"b_{c}") for c in ("start", "end", "weak")])
        b = b.withColumn("stretch", F.explode(F.sequence(F.expr(f"b_start div {reach}"), F.expr(f"(b_end - 1) div {reach}"))))
        apart = (F.col("a_start") <= F.col("b_end") + reach) & (F.col("b_start") <= F.col("a_end") + reach)
        overlap = (F.col("a_start") < F.col("b_end")) & (F.col("b_start") < F.col("a_end"))
        return a.join(b, ["uid", "stretch"]).where(apart & ~overlap).drop("stretch").distinct()

    pairs = near(secrets, ids)
    of = lambda df, side, kind: df.select(
        "uid", F.col(f"{side}_start").alias("start"), F.col(f"{side}_end").alias("end"), F.lit(kind).alias("kind")
    )
    both = pairs.select("uid", F.col("a_start").alias("start"), F.col("a_end").alias("end"), F.lit(False).alias("weak")).distinct()
    return (
        of(pairs.where("b_weak"), "b", LINKED[0])
        .unionByName(of(pairs.where("a_weak"), "a", LINKED[1]))
        .unionByName(of(near(both, ends), "b", LINKED[2]))
        .distinct()
    )


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", reach: int = 200) -> DataFrame:
    """One row for each input row: ``key``, the base spans ``assign``, ``access`` and ``hex``, and ``linked`` spans.

    Spans are ``array<struct<start, end, hit, ...>>``, linked ones
    ``array<struct<start, order, end, kind>>`` without those that a base span
    covers. Null text counts as empty. Repeated rows and rows with a null key are
    judged each by itself; other columns are not read.
    """
    found = keyed(scan(docs, key, text), "uid", "secret-scan")
    order = F.element_at(F.create_map(*[F.lit(x) for k, kind in enumerate(LINKED) for x in (kind, len(BASE) + k)]), F.col("kind"))
    more = linked(found, reach).groupBy("uid").agg(
        F.collect_list(F.struct("start", order.alias("order"), "end", "kind")).alias("linked")
    )
    out = found.select("uid", F.col("key").alias(key), *BASE).join(more, "uid", "left").drop("uid")
    inside = lambda s: F.exists(
        F.concat("assign", "hex"), lambda b: (s.start >= b.start) & (s.end <= b.end)
    )
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    return out.withColumn("linked", F.filter(F.coalesce("linked", none), lambda s: ~inside(s)))


def base_spans() -> Column:
    return F.concat(*[labelled(F.col(k), k, n) for n, k in enumerate(BASE)])
