"""Positions in presentation order, against a plain sort."""

import random

from pyspark.sql import functions as F

from kpiloom.operators import ordering
from kpiloom.operators.ordering import with_position
from kpiloom.plans.marts import MART_ORDER


def test_positions_follow_the_order_with_its_nulls(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, 3, None]), rng.choice([0.5, None, -1.0]), i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, m long, x double, `_at` long").repartition(7)
    spec = [("k", "asc", "last"), ("m", "desc", "first")]
    got = sorted(map(tuple, with_position(df, spec).collect()), key=lambda r: r[-1])
    assert [r[-1] for r in got] == list(range(1, 501))
    low = lambda v: (v is None, v if v is not None else 0)
    want = sorted(rows, key=lambda r: (low(r[0]) if r[0] is not None else (True, ""), (r[1] is not None, -(r[1] or 0)),
                                       low(r[2]), low(r[3])))
    assert [r[:-1] for r in got] == want


def test_copies_of_one_row_spread_over_partitions(spark):
    df = spark.range(20_000).selectExpr("'same' AS k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = with_position(df, [("k", "asc", "last")])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(out.inputFiles()) > 1
    assert sorted(r.position for r in out.collect()) == list(range(1, 20_001))


def test_no_rows(spark):
    assert with_position(spark.createDataFrame([], "k string"), [("k", "asc", "last")]).collect() == []


def test_every_mart_has_an_order():
    assert len(MART_ORDER) == 6


def test_a_task_sorts_a_bounded_number_of_rows(spark, monkeypatch):
    """Rows that compress well are not put together in one task by their size."""
    monkeypatch.setattr(ordering, "SORT_ROWS", 500)
    monkeypatch.setattr(ordering, "SPREAD_ROWS", 500)
    df = spark.range(8000).selectExpr("id % 3 AS a", "id % 2 AS b")
    out = ordering.with_position(df, [("a", "desc", "last")])
    rows = sorted(out.collect(), key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(1, 8001))
    assert [(r.a, r.b) for r in rows] == sorted(((i % 3, i % 2) for i in range(8000)), key=lambda x: (-x[0], x[1]))
    sizes = [r["count"] for r in out.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 1200
