import math

import numpy as np
import pytest

from kpiloom.llm import ann


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS vector", "2 AS bin")


def brute(ids, x, query, k=10):
    d = np.sqrt(((x.astype(np.float64) - x[query].astype(np.float64)) ** 2).sum(1))
    return [(ids[j], d[j]) for j in np.lexsort((ids, d)) if ids[j] != ids[query]][:k]


def recall(spark, x, **how):
    ids = list(range(len(x)))
    got = ann.nearest(spark, table(spark, [(i, v.tolist(), 0) for i, v in zip(ids, x)]), **how).collect()
    hits = total = 0
    for q in range(0, len(x), 100):
        own = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        want = brute(ids, x, q)
        assert [r for r, _, _ in own] == list(range(1, len(want) + 1))
        assert [s for _, _, s in own] == sorted(s for _, _, s in own)
        for _, v, s in own:
            assert s == pytest.approx(np.sqrt(((x[v].astype(np.float64) - x[q].astype(np.float64)) ** 2).sum()), abs=1e-12)
        hits += len({v for _, v, _ in own} & {v for v, _ in want})
        total += len(want)
    return hits / total


def test_recall_of_random_directions_and_of_clusters(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 32)).astype(np.float32)
    assert recall(spark, x / np.linalg.norm(x, axis=1, keepdims=True)) >= 0.9
    centres = rng.normal(size=(30, 32))
    y = (centres[rng.integers(30, size=1500)] + 0.1 * rng.normal(size=(1500, 32))).astype(np.float32)
    assert recall(spark, y, reach=0.1) >= 0.9


def test_full_reach_is_exact_with_ties(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 3, size=(400, 4)).astype(np.float32) + 1  # many equal vectors
    ids = list(range(400))
    got = ann.nearest(spark, table(spark, [(i, v.tolist(), 0) for i, v in zip(ids, x)]), reach=1.0).collect()
    for q in range(0, 400, 100):
        own = [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])]
        assert own == [(v, pytest.approx(d)) for v, d in brute(ids, x, q)]


def test_traversal_is_in_order_of_the_sum():
    rng = np.random.default_rng(3)
    a, b = rng.random(9), rng.random(7)
    counts = rng.integers(0, 4, (9, 7))
    sums = np.sort((a[:, None] + b[None]).ravel())
    order = np.argsort((a[:, None] + b[None]).ravel())
    held = np.cumsum(counts.ravel()[order])
    for want in (1, 10, 40, int(held[-1])):
        assert ann.reached(a, b, counts, want) == pytest.approx(sums[np.searchsorted(held, want)])


def test_large_cells_are_split(spark, monkeypatch):
    monkeypatch.setattr(ann, "BIN", 16)
    monkeypatch.setattr(ann, "BLOCK", 2)
    rng = np.random.default_rng(4)
    x = (1 + 1e-3 * rng.normal(size=(600, 8))).astype(np.float32)
    assert recall(spark, x, reach=1.0) == 1.0


def test_rows_that_take_no_part(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.1], 0), (2, None, 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0),
            (6, [inf, 1.0], 0), (None, [1.0, 0.0], 0), (7, [1.0], 0), (8, [], 0), (100, [0.0, 0.0], 0), (200, [2.0, 0.0], 0),
            (1, [1.0, 0.1], 0)]
    got = ann.nearest(spark, table(spark, rows)).collect()
    own = sorted((r.query_id, r["rank"], r.vec_id) for r in got)
    assert own == [(0, 1, 1), (0, 2, 200), (200, 1, 0), (200, 2, 1)] or own == [(0, 1, 1), (0, 2, 200), (200, 1, 1), (200, 2, 0)]
    assert ann.nearest(spark, table(spark, [])).collect() == []
    assert ann.nearest(spark, table(spark, [(0, [1.0, 2.0], 0)])).collect() == []
    assert ann.nearest(spark, table(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 3.0], 0)])).collect() == []


def test_sample_is_not_a_top_k_of_every_partition(spark, monkeypatch):
    """A top-k sends SAMPLE rows of each partition to the driver."""
    monkeypatch.setattr(ann, "SAMPLE", 40)
    plans, frame = [], type(spark.range(0))
    keep = frame.toArrow
    monkeypatch.setattr(frame, "toArrow", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    for n in (30, 3000):
        entries = spark.range(0, n, 1, 8).selectExpr("array(id) AS ids", "array(cast(id AS double), 0.5D) AS vector")
        want = entries.selectExpr("xxhash64(ids[0]) AS h", "vector").orderBy("h").limit(40).collect()
        assert ann.sampled(entries, n).tolist() == [r.vector for r in want]
    assert plans and all("TakeOrdered" not in p for p in plans)


def test_blocks_times_bins_are_not_broadcast(spark):
    """Blocks as saved are small, their copies for every bin are not."""
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(600, 8)).astype(np.float32))]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        found = ann.nearest(spark, table(spark, rows))
        assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 60
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
