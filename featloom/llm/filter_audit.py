"""How quality filters interact: what each removes in every order of application, from one count of failure combinations."""

from __future__ import annotations

import json
from collections.abc import Callable
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Failure conditions of a text, given the text and its words.
CONDITIONS: dict[str, Callable[[Column, Column], Column]] = {
    "A": lambda text, words: F.size(words) < 200,
    "B": lambda text, words: F.size(F.array_distinct(words)).cast("long") * 100 < F.size(words).cast("long") * 50,
    "C": lambda text, words: F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.length(text).cast("long") * 2,
    "D": lambda text, words: text.rlike("[#$%&*|]"),
}
#: Digests fall into so many buckets; the list of those in use is broadcast, at most 2^20 numbers.
BUCKETS = 1 << 20
#: A text counts as hot where it holds more than this share of all rows; so there are at most 1,000 hot texts.
HOT = 1000


def copies(docs: DataFrame, ids: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, digest)`` of the rows whose exact text a row with a smaller id has as well.

    ``ids`` has ``(id, digest, n)`` of all rows. Only digests that two ids share
    are looked at again. Their rows are kept by a left-semi join on digest,
    whole text and a smaller id; the other side holds each different text once,
    with its smallest id. A digest with more than a thousandth of the rows is dealt
    into slices on both sides, by a broadcast list of at most ``HOT`` digests.
    Texts move only where the bucket of their digest holds a shared one, by a
    broadcast list of at most ``BUCKETS`` numbers.
    """
    total = ids.agg(F.sum("n")).head()[0] or 0
    shared = ids.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.sum("n").alias("n")).where("least < most")
    share = F.col("n") * HOT / F.lit(float(max(total, 1)))
    shared = materialize(shared.select("digest", "least", F.when(share > 1, F.ceil(share).cast("int")).otherwise(1).alias("slices")), "shared-digests")
    bucket = F.pmod(F.xxhash64("digest"), F.lit(BUCKETS))
    used = F.broadcast(shared.select(bucket.alias("bucket")).distinct())
    hot = F.broadcast(shared.where("slices > 1").select("digest", "slices"))
    rows = docs.select(F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.where("id IS NOT NULL").withColumn("digest", F.unhex(F.sha2("text", 256)))
    rows = rows.withColumn("bucket", bucket).join(used, "bucket", "left_semi").join(hot, "digest", "left")
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("id"), F.coalesce("slices", F.lit(1))).cast("int")).drop("slices")
    dealt = shared.select("digest", "slices", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    rows = materialize(rows.join(dealt, ["digest", "slice"]).select("digest", "slice", "slices", "id", "text"), "shared-texts")
    first = rows.groupBy("digest", "text").agg(F.min("id").alias("least"), F.max("slices").alias("slices"))
    first = first.select("digest", "text", "least", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    l, r = rows.alias("l"), first.alias("r")
    same = (F.col("l.digest") == F.col("r.digest")) & (F.col("l.slice") == F.col("r.slice")) & (F.col("l.text") == F.col("r.text"))
    return l.join(r, same & (F.col("r.least") < F.col("l.id")), "left_semi").select("id", "digest").distinct()


def failures(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source",
             conditions: dict[str, Callable[[Column, Column], Column]] | None = None) -> DataFrame:
    """``(id, part, digest, n, bits)``: equal rows with their number and the filters that they fail.

    Bit ``k`` of ``bits`` is the ``k``-th of the conditions, the last bit the
    duplicate filter. Null text counts as empty, null part as ''. Rows with a null
    id are no copies of others and others no copies of them.
    """
    conditions = CONDITIONS if conditions is None else conditions
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    bits = F.lit(0)
    for k, fails in enumerate(conditions.values()):
        bits = bits + F.when(fails(F.col("text"), F.col("words")), 1 << k).otherwise(0)
    rows = rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), bits.alias("bits"))
    rows = materialize(rows.groupBy("id", "part", "digest").agg(F.count(F.lit(1)).alias("n"), F.bit_or("bits").alias("bits")), "failures")
    again = copies(docs, rows, key, text)
    # One id and text may stand under several parts: the mark goes to each of them.
    marks = again.join(rows.select("id", "part", "digest"), ["id", "digest"])
    marks = marks.select("id", "part", "digest", F.lit(0).cast("long").alias("n"), F.lit(1 << len(conditions)).alias("bits"))
    return rows.unionByName(marks).groupBy("id", "part", "digest").agg(F.sum("n").alias("n"), F.bit_or("bits").alias("bits"))


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source",
          conditions: dict[str, Callable[[Column, Column], Column]] | None = None, duplicate: str = "E",
          label_key: str = "doc_id", good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """One row per part, order of the filters and step: what the step's filter does after those before it.

    ``kept``: documents left after the step; ``removed``: taken by it;
    ``redundant``: fail its filter but were gone before; ``unique_fails``: fail
    this filter only; ``good_lost``, ``toxic_lost``: removed here and labelled 1;
    ``shapley``: what the filter removes, summed over all orders at any step.

    Documents are counted by part and combination of failures; every order is
    then read from these counts, at most ``2 ** filters`` for a part. The duplicate
    filter fails rows whose exact text a smaller id has anywhere in the table,
    removed or not. Rows count one by one, repeated ones too. Labels of an id are
    met by any of its rows; a null label or id meets nothing. Null text counts as
    empty, null part as ''. An empty table has no parts and gives no rows.
    """
    conditions = CONDITIONS if conditions is None else conditions
    names = [*conditions, duplicate]
    k, whole = len(names), 1 << len(names)
    if k > 6 or any(len(n) != 1 for n in names):
        raise ValueError("at most six filters, named by one letter each")
    found = failures(docs, key, text, part, conditions)
    known = labels.select(F.col(label_key).alias("id"), (F.col(good) == 1).alias("good"), (F.col(toxic) == 1).alias("toxic"))
    known = known.groupBy("id").agg(F.coalesce(F.max("good"), F.lit(False)).alias("good"), F.coalesce(F.max("toxic"), F.lit(False)).alias("toxic"))
    known = known.where("good OR toxic")
    none = F.lit(0).cast("long")
    counts = found.join(known, "id", "left").groupBy("part", "bits").agg(
        F.sum("n").alias("docs"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(none)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(none)).alias("toxic"),
    )
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("bits", "docs", "good", "toxic")).alias("cells"))
    # left[m]: documents that fail no filter of the set m
    passing = lambda field: F.transform(
        F.sequence(F.lit(0), F.lit(whole - 1)),
        lambda m: F.aggregate(F.filter("cells", lambda c: c.bits.bitwiseAND(m) == 0), none, lambda a, c: a + c[field]),
    )
    only = lambda bit: F.aggregate(F.filter("cells", lambda c: c.bits == bit), none, lambda a, c: a + c.docs)
    tables = cells.select("part", passing("docs").alias("left"), passing("good").alias("good"), passing("toxic").alias("toxic"),
                          F.array(*[only(1 << i) for i in range(k)]).alias("only"))
    worth = []
    for i in range(k):
        rest = [m for m in range(whole) if not m >> i & 1]
        ways = lambda m: factorial(m.bit_count()) * factorial(k - 1 - m.bit_count())
        worth.append(sum((F.col("left")[m] - F.col("left")[m | 1 << i]) * ways(m) for m in rest))
    tables = tables.withColumn("worth", F.array(*worth))
    steps = [
        {"filter_order": "".join(names[i] for i in order), "step": s + 1, "filter": order[s], "before": sum(1 << i for i in order[:s])}
        for order in permutations(range(k)) for s in range(k)
    ]
    shape = "array<struct<filter_order:string,step:int,filter:int,before:int>>"
    out = tables.withColumn("s", F.explode(F.from_json(F.lit(json.dumps(steps)), shape))).select("*", "s.*")
    bit = F.expr("shiftleft(1, filter)")
    after = F.col("before").bitwiseOR(bit)
    gone = lambda table: F.col(table)[F.col("before")] - F.col(table)[after]
    return out.select(
        "part", "filter_order", "step", F.col("left")[after].alias("kept"), gone("left").alias("removed"),
        (F.col("left")[0] - F.col("left")[bit] - gone("left")).alias("redundant"), F.col("only")[F.col("filter")].alias("unique_fails"),
        gone("good").alias("good_lost"), gone("toxic").alias("toxic_lost"), F.col("worth")[F.col("filter")].alias("shapley"),
    )
