"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of ``edges``: ``root`` is the smallest node that links reach.

    Nodes are ordered by a hash, so that long chains of rising ids break into
    short ones. Every round points each node at the first of itself and its
    neighbours, follows the pointer once more, replaces the ends of every link
    by what they point at and drops the links that became loops. A node with
    very many links meets only aggregates with partial results and joins that
    adaptive execution splits. Each round is written to the shared folder; the
    driver sees one row a round. Links with a null end and loops are ignored;
    an empty table gives an empty one.
    """
    a, b = F.col(a).cast("long"), F.col(b).cast("long")
    links = materialize(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct(), "links")
    rounds = []
    while links.head(1):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy(F.col("a").alias("node")).agg(F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("v"))).alias("n"))
        first = first.select("node", F.least("n", F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("v"))).v.alias("to"))
        first = materialize(first, "pointers")
        to = materialize(
            first.join(first.select(F.col("node").alias("to"), F.col("to").alias("next")), "to").select("node", F.col("next").alias("to")),
            "pointers",
        )
        rounds.append(to)
        links = materialize(
            links.join(to.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(to.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "links",
        )
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("a").alias("root"))
    out = rounds[0].select("node", F.col("to").alias("part"))
    for to in rounds[1:]:
        out = out.join(to.select(F.col("node").alias("part"), "to"), "part", "left").select("node", F.coalesce("to", "part").alias("part"))
    out = materialize(out, "parts")
    least = out.groupBy("part").agg(F.min("node").alias("root"))
    return out.join(least, "part").select("node", "root")
