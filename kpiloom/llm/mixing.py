"""Mixing sources to target weights: capped water-filling, then seeded repetition.

Targets: the sources share ``share`` times all words by weight; a source stops at
``cap`` times its own size and its excess goes to the others by weight, until no
source is above its cap. The level of that filling is found by aggregates over one
row per source, a round for each time that more sources reach their cap.

Repetition: a source at r times its size takes every document floor(r) times whole.
The rest, a fraction of the source, is filled with documents in a seeded random
order until it is full. The order is by a hash bucket of the document id, so what
each source needs to know is one bucket: documents in buckets before it are taken
once more, those in it give a fraction of their words (their first words, rounded
up or down by a seeded draw), the others nothing. No task or window ever holds the
documents of a source, only its ``BUCKETS`` sums.

Null texts have size 0 and are taken 0 times; a null source is one source, last in
order; repeated rows count each and share a draw; a source without words has target 0.
Texts of any length are counted and cut whole; an empty table gives no rows; columns of
any name pass through, as helper columns get names that the table does not have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kpiloom.llm.common import WORD_BREAK, fresh, save

WEIGHTS = (5, 2, 1)
BUCKETS = 4096


def word_count(text: Column) -> Column:
    words = F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")
    return F.size(words).cast("long")


def _draw(doc_id: Column, seed: int, what: str) -> Column:
    """A seeded whole number below 2**32 for a document."""
    key = F.concat(F.lit(f"{what}{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def in_order(sources: DataFrame, column: str) -> DataFrame:
    """``sources`` with ``place``, its rank from 0 by code point, null last. Ranges
    are ranked apart and then moved by the sizes of the ranges before them."""
    by = F.col(column).asc_nulls_last()
    parts = save(sources.repartitionByRange(by).withColumn("part", F.spark_partition_id()), "mix-ranges")
    before = (parts.groupBy("part").count().withColumn("before", F.coalesce(F.sum("count").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    place = F.row_number().over(Window.partitionBy("part").orderBy(by)) - 1
    return (parts.withColumn("place", place).join(before, "part")
            .withColumn("place", F.col("place") + F.col("before")).drop("part", "count", "before"))


def targets(sized: DataFrame, source: str, size: str, weights=WEIGHTS, share: float = 1.5,
            cap: float = 2.0) -> DataFrame:
    """One row per source: source, source_size and target."""
    sources = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = save(in_order(sources, "source").select("source", "source_size", weight.alias("weight")), "mix-sources")
    limit = F.col("source_size") * cap
    total = sources.agg(F.sum("source_size")).first()[0]
    level, full = 0.0, -1
    while total:
        over = F.col("weight") * level > limit
        capped, open_weight, n = sources.agg(
            F.sum(F.when(over, limit).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))),
            F.count_if(over)).first()
        if n == full or not open_weight:
            break
        level, full = (total * share - capped) / open_weight, n
    return sources.select("source", "source_size",
                          F.least(F.col("weight") * F.lit(level), limit).alias("target"))


def plan(sized: DataFrame, source: str, size: str, doc_id: str, seed: int = 7, **how) -> DataFrame:
    """One row per source: its target, whole repetitions and, for the fraction, the
    last bucket taken from and the part of that bucket."""
    goal = save(targets(sized, source, size, **how), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = goal.withColumn("whole", F.floor(ratio)).withColumn(
        "want", (ratio - F.floor(ratio)) * F.col("source_size"))
    bucket = _draw(F.col(doc_id), seed, "order") % BUCKETS
    sums = sized.groupBy(F.col(source).alias("s"), bucket.alias("bucket")).agg(F.sum(size).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("s").orderBy("bucket"))
    cut = (sums.withColumn("upto", upto)
           .join(goal.select("source", "want"), F.col("s").eqNullSafe(F.col("source")))
           .filter(F.col("upto") > F.col("want"))
           .groupBy("s").agg(F.min(F.struct("bucket", "n", "upto", "want")).alias("c"))
           .select("s", "c.bucket", ((F.col("c.want") - F.col("c.upto") + F.col("c.n")) / F.col("c.n")).alias("part")))
    out = goal.join(cut, F.col("source").eqNullSafe(F.col("s")), "left")
    return save(out.select("source", "source_size", "target", "whole",
                           F.coalesce("bucket", F.lit(BUCKETS)).alias("bucket"),
                           F.coalesce("part", F.lit(0.0)).alias("part")), "mix-plan")


def taken(doc_id: Column, size: Column, p: Column, seed: int) -> Column:
    """Words that the mix takes of a document, given its source's plan ``p``."""
    bucket = _draw(doc_id, seed, "order") % BUCKETS
    share = F.when(bucket < p["bucket"], 1.0).when(bucket == p["bucket"], p["part"]).otherwise(0.0)
    u = _draw(doc_id, seed, "round") / F.lit(float(1 << 32))
    return (p["whole"] * size + F.floor(share * size + u)).cast("long")


def _joined(sized: DataFrame, source: str, plans: DataFrame, name: str, keep: list[str]) -> DataFrame:
    own, = fresh(sized, name + "_source")
    p = plans.select(F.col("source").alias(own), F.struct(
        "source_size", "target", "whole", "bucket", "part").alias(name))
    return sized.join(p, F.col(source).eqNullSafe(F.col(own))).select(*keep, name)


def mix_counts(docs: DataFrame, seed: int = 7, **how) -> DataFrame:
    """One row per document: doc_id, size, source_size, target and taken words."""
    sized = save(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    plans = plan(sized, "source", "size", "doc_id", seed, **how)
    out = _joined(sized, "source", plans, "p", ["doc_id", "size"])
    return out.select("doc_id", "size", F.col("p.source_size").alias("source_size"), F.col("p.target").alias("target"),
                      taken(F.col("doc_id"), F.col("size"), F.col("p"), seed).alias("taken"))


def mix(docs: DataFrame, seed: int = 7, **how) -> DataFrame:
    """The mixed rows themselves, with all columns of ``docs``: a row for each whole
    repetition and one with the first words for a fractional one. Documents without
    words stay once, as they weigh nothing."""
    size, p, cut = fresh(docs, "_size", "_plan", "_words")
    sized = save(docs.withColumn(size, word_count(F.col("text"))), "mix-docs")
    plans = plan(sized, "source", size, "doc_id", seed, **how)
    out = _joined(sized, "source", plans, p, [*docs.columns, size])
    n = taken(F.col("doc_id"), F.col(size), F.col(p), seed)
    whole = F.when(F.col(size) == 0, F.array(F.lit(-1).cast("long"))).otherwise(
        F.array_repeat(F.lit(-1).cast("long"), F.floor(n / F.col(size)).cast("int")))
    rest = F.when((F.col(size) > 0) & (n % F.col(size) > 0), F.array(n % F.col(size))).otherwise(
        F.array().cast("array<bigint>"))
    first = F.array_join(F.slice(F.filter(F.split("text", WORD_BREAK), lambda w: w != ""), F.lit(1),
                                 F.col(cut).cast("int")), " ")
    out = out.withColumn(cut, F.explode(F.concat(whole, rest)))
    text = F.when(F.col(cut) < 0, F.col("text")).otherwise(first)
    return out.withColumn("text", text).select(*docs.columns)
