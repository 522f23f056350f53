"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Fixed base rules look at a text's own counts. Five further rules reject a document
when a ratio of those counts exceeds a cutoff, and the cutoff of each rule is
chosen per stratum (language) from labelled documents: out of a fixed grid, the
smallest cutoff whose false rejection rate is shown to be at most the rule's share
of ``max_false_rejection`` by an exact binomial test. The tests are corrected for
the number of rules and strata (Bonferroni); within one rule and stratum they are
taken from the loosest cutoff down and stop at the first failure (fixed sequence),
which needs no further correction. A stratum with too few labels to show anything
gets no cutoff, and the rule rejects nothing there.

Null texts have no words; a null language is a stratum of its own; repeated rows
are judged each; documents without any word fail the base rules. Several labels of
one document count as good only if all are 1. Texts of any length are counted whole; an
empty table gives no rows and, without labels, no cutoff; columns of any name pass
through, as helper columns get names that the table does not have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kpiloom.llm.common import WORD_BREAK, fresh, save

SYMBOLS = "#*$%&|<>"
WINDOW = 5

# rule -> cutoffs tried, loosest first; a document is rejected above the cutoff
GRID = {
    "symbols_per_word": (3.0, 2.0, 1.5, 1.0, 0.7, 0.5, 0.4, 0.3, 0.2),
    "bangs_per_word": (3.0, 2.0, 1.5, 1.0, 0.7, 0.5, 0.4, 0.3, 0.2),
    "dup_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
    "repeat_share": (0.19, 0.18, 0.17, 0.16, 0.15),
    "mean_word": (60.0, 40.0, 30.0, 25.0, 20.0, 16.0, 14.0),
}


def _count_of(text: Column, chars: str) -> Column:
    rest = text
    for c in chars:  # replace() is far cheaper than translate() where few match
        rest = F.replace(rest, F.lit(c))
    return (F.length(text) - F.length(rest)).cast("long")


def with_stats(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a struct column ``name`` of counts over each whole text."""
    t, w, h, k, s = fresh(docs, "_text", "_words", "_hashes", "_windows", "_starts")
    col = F.col
    hashed = docs.withColumn(t, F.coalesce(col("text"), F.lit("")))
    hashed = hashed.withColumn(w, F.filter(F.split(col(t), WORD_BREAK), lambda x: x != ""))
    # each word is hashed once; a window is the 64-bit hash of its five word hashes
    hashed = hashed.withColumn(h, F.transform(col(w), lambda x: F.xxhash64(x)))
    hashed = hashed.withColumn(k, F.when(F.size(h) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(h) - WINDOW),
        lambda i: F.xxhash64(*[F.get(col(h), i + j) for j in range(WINDOW)]))))
    # most texts repeat no window; in the others equal windows are neighbours once
    # sorted, and their positions go back in text order
    ordered = fresh(docs, "_ordered")[0]
    hashed = hashed.withColumn(ordered, F.when(
        F.size(F.array_distinct(col(k))) < F.size(k),
        F.sort_array(F.transform(col(k), lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    repeated = F.filter(col(ordered), lambda x, i: (
        (F.get(col(ordered), i - 1)["h"] == x["h"]) | (F.get(col(ordered), i + 1)["h"] == x["h"])))
    hashed = hashed.withColumn(s, F.coalesce(
        F.sort_array(F.transform(repeated, lambda x: x["i"])), F.array().cast("array<int>")))
    covered = F.aggregate(
        col(s), F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(i - a["last"], F.lit(WINDOW))).alias("n"), i.alias("last")),
        lambda a: a["n"])
    lines = fresh(docs, "_lines")[0]
    hashed = hashed.withColumn(lines, F.filter(
        F.split(col(t), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    stats = F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _count_of(col(t), SYMBOLS).alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        _count_of(col(t), "!").alias("n_bangs"),
    )
    return hashed.withColumn(name, stats).drop(t, w, h, k, s, ordered, lines)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])


def rule_values(s: Column) -> dict[str, Column]:
    words = F.greatest(s["n_words"], F.lit(1)).cast("double")
    return {
        "symbols_per_word": s["n_symbols"] / words,
        "bangs_per_word": s["n_bangs"] / words,
        "dup_line_share": s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1)),
        "repeat_share": s["n_repeat_words"] / words,
        "mean_word": s["word_chars"] / words,
    }


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), summed term by term with a running scale so that
    no term under- or overflows: state (log of term, scale, sum over e**scale)."""
    step = lambda a, i: F.struct(
        (a["log"] + F.log((n - i + 1) / i) + F.log(F.lit(p / (1 - p)))).alias("log"), a["sum"].alias("sum"))

    def add(a, i):
        b = step(a, i)
        high = F.greatest(b["log"], b["sum"])
        return F.struct(b["log"].alias("log"), (high + F.log(
            F.exp(b["log"] - high) + F.exp(b["sum"] - high))).alias("sum"))

    first = n * F.log(F.lit(1 - p))
    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(terms, F.struct(first.alias("log"), first.alias("sum")), add,
                       lambda a: F.least(F.exp(a["sum"]), F.lit(1.0)))


def thresholds(stats: DataFrame, labels: DataFrame, column: str, stratum: str = "lang",
               max_false_rejection: float = 0.05, error: float = 0.05) -> DataFrame:
    """One row per stratum with a chosen cutoff or null per rule.

    With probability 1 - ``error`` every stratum loses at most
    ``max_false_rejection`` of its good documents to all rules together. Labelled
    documents that fail the base rules take no part: they are gone already.
    """
    good = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
            .groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id"))
    s = F.col(column)
    held = (stats.filter(~base_failed(s)).join(good, "doc_id", "left_semi")
            .select(F.col(stratum).alias("stratum"), *[v.alias(r) for r, v in rule_values(s).items()]))
    counts = [F.count("*").alias("n")] + [
        F.count_if(F.col(r) > c).alias(f"{r}_{i}") for r, cuts in GRID.items() for i, c in enumerate(cuts)]
    per = save(held.groupBy("stratum").agg(*counts), "rule-counts")
    share = max_false_rejection / len(GRID)
    level = error / len(GRID) / max(1, per.count())  # a row per stratum

    tests = F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(float(c)).alias("cutoff"), F.col(f"{r}_{i}").alias("k"))
        for r, cuts in GRID.items() for i, c in enumerate(cuts)])).alias("t")
    # more rejections than the share itself cannot pass; counts grow as cutoffs
    # fall, so within a rule the tests that pass come before those that fail
    passed = (per.select("stratum", "n", tests).select("stratum", "n", "t.*")
              .filter(F.col("k") <= F.col("n") * share)
              .filter(binomial_cdf(F.col("k"), F.col("n"), share) <= level))
    return passed.groupBy("stratum").agg(*[
        F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(r) for r in GRID])


def judged(stats: DataFrame, cutoffs: DataFrame, column: str, kept: str, stratum: str = "lang") -> DataFrame:
    """``stats`` with a boolean column ``kept``."""
    own, *cuts = fresh(stats, "_stratum", *[f"_cut_{r}" for r in GRID])
    cut = dict(zip(GRID, cuts))
    c = cutoffs.select(F.col("stratum").alias(own), *[F.col(r).alias(cut[r]) for r in GRID])
    s = F.col(column)
    out = stats.join(c, F.col(stratum).eqNullSafe(F.col(own)), "left")
    above = F.lit(False)
    for r, v in rule_values(s).items():
        above = above | F.coalesce(v > F.col(cut[r]), F.lit(False))
    return out.withColumn(kept, ~base_failed(s) & ~above).drop(*c.columns)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: its counts, base_failed and kept."""
    stats = save(with_stats(docs.select("doc_id", "text", "lang"), "s").drop("text"), "rule-stats")
    out = judged(stats, save(thresholds(stats, labels, "s"), "rule-cutoffs"), "s", "kept")
    s = F.col("s")
    return out.select("doc_id", *[s[c].alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed(s).alias("base_failed"), "kept")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns. The texts are
    written once beside their counts, so that no join has to move them."""
    stats, kept = fresh(docs, "_stats", "_kept")
    saved = save(with_stats(docs, stats), "rule-docs")
    cutoffs = save(thresholds(saved, labels, stats), "rule-cutoffs")
    return judged(saved, cutoffs, stats, kept).filter(kept).select(*docs.columns)
