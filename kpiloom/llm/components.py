"""Connected components of an edge table by repeated contraction, in Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kpiloom.llm.common import discard, narrowed, save


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) for every node of ``edges`` (a, b).

    Each round points every node at its smallest neighbour or itself, follows these
    pointers until all end at a node that points at itself, doubling the way each time,
    and joins them into the edges; what is left between different ends is the next
    round's table. A node left alone in a round has only smaller neighbours in the next,
    so nodes at least halve in two rounds, and a path of n nodes takes some log2(n) jumps. The pointers of all
    rounds, one after the other, lead to the root. Every round is saved, and joins run
    between saved tables, so that a hub's rows can be split by adaptive execution.
    """
    left = save(narrowed(edges.filter("a <> b").distinct()), "cc-edges")
    rounds = []
    while not left.isEmpty():
        both = left.select(F.col("a").alias("node"), F.col("b").alias("p")).union(left.select("b", "a"))
        to = save(narrowed(both.groupBy("node").agg(F.min("p").alias("p")).select(
            "node", F.least("node", "p").alias("p"))), "cc-parents")
        before = to.agg(F.sum(F.col("p").cast("decimal(38,0)"))).first()[0]  # pointers only ever get smaller
        while True:
            jumped = save(narrowed(_follow(to, to)), "cc-jump")
            moved = jumped.agg(F.sum(F.col("p").cast("decimal(38,0)"))).first()[0]
            if moved == before:
                discard(jumped)
                break
            discard(to)
            to, before = jumped, moved
        rounds.append(to)
        a = to.select(F.col("node").alias("a"), F.col("p").alias("pa"))
        b = to.select(F.col("node").alias("b"), F.col("p").alias("pb"))
        half = save(narrowed(left.join(a, "a").select("pa", "b")), "cc-half")
        fewer = save(narrowed(half.join(b, "b").filter("pa <> pb").select(
            F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()), "cc-edges")
        discard(half, left)
        left = fewer
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = rounds[0]
    for to in rounds[1:]:
        ahead = save(narrowed(_follow(out, to)), "cc-roots")
        discard(out, to)
        out = ahead
    return out.withColumnRenamed("p", "root")


def _follow(start: DataFrame, to: DataFrame) -> DataFrame:
    step = to.select(F.col("node").alias("p"), F.col("p").alias("q"))
    return start.join(step, "p", "left").select("node", F.coalesce("q", "p").alias("p"))
