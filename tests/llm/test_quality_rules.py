import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kpiloom.llm import quality_rules
from tests.llm.texts import corpus, words


def brute(text):
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    repeated = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeated))


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_counts_match_brute_force(make, spark):
    pairs = corpus(50) + [(900, "a|b #x\n\na|b #x\n \n$$ 𝒜😀 ok\r\nok"), (901, "p q r s t p q r s t"), (902, "w " * 12)]
    got = quality_rules.quality_rules(make(pairs, "n_words lines"), labels(spark, [])).collect()
    own = [(r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got]
    assert sorted(own, key=str) == sorted([(i, brute(t)) for i, t in pairs], key=str)
    for r in got:  # without labels only the base rules decide
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed)


def exact_cdf(k, n, p):
    return sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))


@pytest.mark.parametrize("p", [0.01, 0.3])
def test_binomial_cdf_is_exact(spark, p):
    rows = [(k, n) for n in (1, 7, 50, 400) for k in (0, 1, 3, n // 3, n) if k <= n]
    df = spark.createDataFrame(rows, "k long, n long")
    got = df.select("k", "n", quality_rules.binomial_cdf(F.col("k"), F.col("n"), p).alias("c")).collect()
    for r in got:
        assert r.c == pytest.approx(exact_cdf(r.k, r.n, p), rel=1e-9)


def test_binomial_cdf_does_not_underflow(spark):
    r = spark.createDataFrame([(950, 100_000)], "k long, n long").select(
        quality_rules.binomial_cdf(F.col("k"), F.col("n"), 0.01).alias("c")).first()
    assert r.c == pytest.approx(0.0575, abs=0.002)  # about 1.58 standard deviations below the mean


def labelled(make, spark, junk_good=0):
    plain = lambda i: " ".join(f"w{(i * 7 + j) % 97}x{j}" for j in range(30))
    junk = lambda i: " ".join(f"w{i}x{j}$$$" for j in range(30))
    pairs = [(i, plain(i)) for i in range(900)] + [(i, junk(i)) for i in range(900, 1000)]
    rows = [(i, 1, 0) for i in range(900)] + [(i, int(i - 900 < junk_good), 0) for i in range(900, 1000)]
    return make(pairs), labels(spark, rows)


def cutoffs(docs, table):
    stats = quality_rules.with_stats(docs, "s")
    return quality_rules.thresholds(stats, table, "s").collect()


def test_cutoffs_reject_junk_and_keep_good(make, spark):
    docs, table = labelled(make, spark)
    (row,) = cutoffs(docs, table)
    assert row.symbols_per_word == min(quality_rules.GRID["symbols_per_word"])
    kept = {r.doc_id for r in quality_rules.keep_good(docs, table).select("doc_id").collect()}
    assert kept == set(range(900))


def test_no_cutoff_that_good_documents_speak_against(make, spark):
    docs, table = labelled(make, spark, junk_good=30)  # 3 % of the good ones look like junk
    (row,) = cutoffs(docs, table)
    assert row.symbols_per_word >= 3.0 or row.symbols_per_word is None
    assert quality_rules.keep_good(docs, table).count() == 1000


def test_cutoffs_follow_the_exact_test(make, spark):
    docs, table = labelled(make, spark)
    share = 0.05 / len(quality_rules.GRID)
    need = math.ceil(math.log(0.05 / len(quality_rules.GRID)) / math.log(1 - share))  # labels that 0 rejections need
    few = table.filter(F.col("doc_id") < need - 1)
    assert all(r[rule] is None for r in cutoffs(docs, few) for rule in quality_rules.GRID)
    enough = table.filter(F.col("doc_id") < need)
    (row,) = cutoffs(docs, enough)
    assert row.symbols_per_word is not None


def test_strata_nulls_and_conflicting_labels(make, spark):
    docs, table = labelled(make, spark)
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "de"))
    both = table.union(table.selectExpr("doc_id", "0 AS quality", "toxic").filter("doc_id < 10")).union(
        labels(spark, [(None, 1, 0), (5, None, 0)]))
    out = quality_rules.quality_rules(docs, both).collect()
    assert len(out) == 1000 and {r.doc_id for r in out if r.kept} >= set(range(900))


def test_no_rows_and_clashing_names(make, spark):
    docs = make([], "_stats _kept _words")
    assert quality_rules.keep_good(docs, labels(spark, [])).columns == docs.columns
    assert quality_rules.quality_rules(docs, labels(spark, [])).collect() == []
    docs = make(corpus(20), "_stats _kept _words stratum")
    assert quality_rules.keep_good(docs, labels(spark, [])).columns == docs.columns
