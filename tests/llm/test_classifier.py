import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import classifier
from tests.llm.texts import corpus


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def train_set(n=900):
    rng = np.random.default_rng(5)
    pairs, rows = [], []
    for i in range(n):
        good = bool(rng.random() < 0.7)
        words = [f"w{rng.integers(500)}" for _ in range(rng.integers(5, 80))]
        pairs.append((i, " ".join(words) + "." if good else " ".join(w + "!!" * int(rng.random() < 0.8) for w in words)))
        rows.append((i, int(good), 0))
    return pairs, rows


def test_held_out_accuracy_and_calibration(make, spark):
    pairs, rows = train_set()
    got = classifier.quality_scores(make(pairs, "score x y"), labels(spark, rows)).collect()
    truth = {i: q for i, q, _ in rows}
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert np.mean([(r.score - truth[r.doc_id]) ** 2 for r in held]) < 0.05


def test_held_out_labels_do_not_matter(make, spark):
    pairs, rows = train_set(300)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in rows]
    docs = make(pairs)
    a, b = ({r.doc_id: r.score for r in classifier.quality_scores(docs, labels(spark, x)).collect()} for x in (rows, turned))
    assert a == pytest.approx(b)


def test_normal_equations_equal_numpy(spark):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(200, len(classifier.STATS))), rng.random(200)
    model = classifier.Model(x.mean(0), x.std(0))
    df = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, y double").repartition(5)
    xx, xy = classifier._normal_sums(df, model)
    f = model.features(x)
    assert np.allclose(xx, f.T @ f) and np.allclose(xy, f.T @ y)


def test_scores_beyond_zero_and_one_keep_their_order(make, spark):
    pairs, rows = train_set(600)
    stats = classifier.stats_table(make(pairs))
    model = classifier.train(stats, labels(spark, rows), F.lit(True))
    x = np.array([r.x for r in stats.collect()])
    raw, step, score = model.ridge(x), model.step(x), model.score(x)
    assert model.low < 0 and model.high > 1 and ((raw < 0) | (raw > 1)).mean() > 0.1
    order = np.argsort(raw)
    assert (np.diff(step[order]) >= 0).all() and (np.diff(score[order]) >= 0).all()
    # neither end is one step for all that lies beyond 0 or 1
    assert len(set(step[raw > 1])) > 1 and len(set(step)) > 20


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, len(classifier.STATS)))
    model = classifier.Model(np.zeros(x.shape[1]), np.ones(x.shape[1]))
    f = model.features(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * 3.0 ** 2))
    assert np.abs(f @ f.T - exact).max() < 0.3 and np.abs(f @ f.T - exact).mean() < 0.06


def test_pooling_is_isotonic():
    good, n = np.array([0., 3, 1, 0, 4, 9]), np.array([2., 4, 4, 0, 5, 9])
    level = classifier.pool(good, n)
    assert (np.diff(level) >= 0).all()
    assert level[0] == pytest.approx(1 / 4) and level[1] == level[2] == pytest.approx(5 / 10)
    assert level[3] == pytest.approx((5 / 10 + 5 / 7) / 2)


def test_awkward_rows_and_missing_labels(make, spark):
    pairs = corpus(40)
    for rows in ([], [(None, 1, 0), (3, None, 0)], [(i, 1, 0) for i in range(40)]):
        got = classifier.quality_scores(make(pairs), labels(spark, rows)).collect()
        assert len(got) == len(pairs) and all(0 <= r.score <= 1 for r in got)
    assert classifier.quality_scores(make([]), labels(spark, [])).collect() == []
