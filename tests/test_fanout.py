"""The hot-key split of many-to-many joins returns exactly the plain join, and
spreads its output under the settings that the library recommends."""

import collections
import contextlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from kpiloom.operators.joins import fanout_join, hot_keys, side_counts


def bag(df):
    cols = sorted(df.columns)
    return collections.Counter(tuple(r[c] for c in cols) for r in df.collect())


@contextlib.contextmanager
def conf(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    saved = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def split(left, right, key, how, hot_rows):
    counts = side_counts(key, a=left, b=right)
    return fanout_join(left, right, key, how, hot_keys(counts, key, "a", "b", hot_rows), hot_rows)


def largest_share(df):
    """Share of the rows that the fullest task emits."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def one_key(spark, n, name):
    # a single key, not constant-folded
    return spark.range(n).select((F.col("id") % 1 + 1).alias("k"), F.col("id").alias(name))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [1, 3, 50])
def test_fanout_equals_plain_join(spark, how, hot_rows):
    # key 0 holds a third of both sides; some keys exist on one side only; null keys
    left = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 17 == 0, F.lit(None))
        .otherwise(F.col("id") % 40).alias("k"), F.col("id").alias("l"))
    right = spark.range(240).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 19 == 0, F.lit(None))
        .otherwise(F.col("id") % 55 + 20).alias("k"), (F.col("id") * 7).alias("r"))
    assert bag(split(left, right, "k", how, hot_rows)) == bag(left.join(right, "k", how))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 6) | st.none(), min_size=0, max_size=60),
       st.lists(st.integers(0, 6) | st.none(), min_size=0, max_size=60),
       st.sampled_from(["inner", "left"]), st.integers(1, 8))
def test_fanout_property(spark, lkeys, rkeys, how, hot_rows):
    left = spark.createDataFrame([(k, i % 9) for i, k in enumerate(lkeys)], "k int, l int")
    right = spark.createDataFrame([(k, i % 4) for i, k in enumerate(rkeys)], "k int, r int")
    assert bag(split(left, right, "k", how, hot_rows)) == bag(left.join(right, "k", how))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_key_spreads_with_small_right_side(spark, how, adaptive):
    """A million pairs of one key whose sides would fit a broadcast: with adaptive
    execution and its runtime broadcast on, they still come from many tasks."""
    with conf(spark, spark__sql__adaptive__enabled=adaptive, spark__sql__shuffle__partitions="16"):
        left, right = one_key(spark, 1000, "l"), one_key(spark, 1000, "r")
        out = split(left, right, "k", how, 100)
        assert out.count() == 1_000_000
        assert largest_share(out) < 0.25
        assert largest_share(left.join(right, "k", how)) == 1


def test_null_keys_spread(spark):
    with conf(spark, spark__sql__shuffle__partitions="16",
              spark__sql__adaptive__coalescePartitions__enabled="false"):
        nulls = spark.range(2000).select(
            F.when(F.col("id") < 40, F.lit(1)).cast("int").alias("k"), F.col("id").alias("l"))
        right = spark.range(30).select((F.col("id") % 1 + 1).cast("int").alias("k"), F.col("id").alias("r"))
        out = split(nulls, right, "k", "left", 10)
        assert out.count() == 1960 + 40 * 30
        assert largest_share(out.filter("k IS NULL")) < 0.25


@pytest.mark.parametrize("how", ["inner", "left"])
def test_copies_of_one_row_spread_over_tasks(spark, how):
    """A hot key whose rows are all copies of one row is still split, and the
    result keeps every copy."""
    with conf(spark, spark__sql__shuffle__partitions="16"):
        left = one_key(spark, 6, "l").withColumn("l", F.col("l") % 2)  # 3 copies each
        right = one_key(spark, 1200, "r").withColumn("r", F.lit(7))  # identical rows
        right = right.unionByName(spark.range(3).select((F.col("id") + 5).alias("k"), F.lit(1).alias("r")))
        out = split(left, right, "k", how, 100)
        assert bag(out) == bag(left.join(right, "k", how))
        assert largest_share(out) < 0.5


def test_left_only_hot_key_is_kept_once(spark):
    with conf(spark, spark__sql__shuffle__partitions="16"):
        left = one_key(spark, 400, "l")
        right = spark.range(5).select((F.col("id") + 10).alias("k"), F.col("id").alias("r"))
        out = split(left, right, "k", "left", 20)
        assert bag(out) == bag(left.join(right, "k", "left"))
        assert out.filter("r IS NULL").count() == 400
        assert largest_share(out) < 0.5
        assert split(left, right, "k", "inner", 20).count() == 0


def test_wrong_counts_only_size_the_grid(spark):
    left, right = one_key(spark, 50, "l"), one_key(spark, 30, "r")
    hot = spark.createDataFrame([(1, 7, 3), (99, 2, 2)], "k long, _fj_lb long, _fj_rb long")
    for how in ("inner", "left"):
        assert bag(fanout_join(left, right, "k", how, hot, 5)) == bag(left.join(right, "k", how))


def test_at_risk_with_a_hot_customer(spark, staged_small, tmp_path):
    """One customer owns a third of the surveys and overdue invoices: the marts
    take the split path and still equal the plain joins."""
    from kpiloom.operators import churn, satisfaction
    from kpiloom.plans.marts import find_hot_customers
    frames = dict(staged_small)
    hot_id = frames["subs"].filter("is_active").orderBy("customer_id").first().customer_id
    third = F.when(F.xxhash64("customer_id", F.lit(7)) % 3 == 0, F.lit(hot_id)).otherwise(F.col("customer_id"))
    frames["surv"] = frames["surv"].withColumn("customer_id", third)
    frames["inv"] = frames["inv"].withColumn("customer_id", third)
    args = (frames["cust"], frames["subs"], frames["surv"], frames["inv"])
    hot = find_hot_customers(frames, str(tmp_path / "hot"), hot_rows=20)
    assert hot_id in [r.customer_id for r in hot.collect()]
    risk = churn.at_risk_customers(*args, hot=hot, hot_rows=20)
    assert "_fj_ls" in risk._jdf.queryExecution().analyzed().toString()
    assert bag(risk) == bag(churn.at_risk_customers(*args))
    surveys = satisfaction.enriched_surveys(frames["surv"], frames["cust"], frames["subs"], hot, 20)
    assert bag(surveys) == bag(satisfaction.enriched_surveys(frames["surv"], frames["cust"], frames["subs"]))
    assert find_hot_customers(frames, str(tmp_path / "none"), hot_rows=10 ** 6) is None


def test_copies_grow_with_the_sides_not_with_their_product(spark):
    """Small cells copied two rows for every hot_rows pairs: what is dealt out grew with the output."""
    from kpiloom.operators import joins

    def dealt(n):
        left, right = one_key(spark, n, "l"), one_key(spark, n, "r")
        hot = hot_keys(side_counts("k", a=left, b=right), "k", "a", "b", 2)
        grid = joins._sized(hot, 2, 4).first()
        assert n * n / (grid["_fj_lb"] * grid["_fj_rb"]) <= joins.DEFAULT_HOT_ROWS ** 2
        return n * (grid["_fj_lb"] + grid["_fj_rb"])
    assert dealt(8000) <= 9 * dealt(1000)
    with conf(spark, spark__sql__shuffle__partitions="16"):
        left = one_key(spark, 500, "l")
        right = one_key(spark, 3000, "r").withColumn("r", F.col("r") % 2)  # copies of two rows
        out = split(left, right, "k", "left", 2)
        assert bag(out.groupBy("l", "r").count()) == bag(left.join(right, "k").groupBy("l", "r").count())
        assert largest_share(out) < 0.25
