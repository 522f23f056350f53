import pytest
from pyspark.sql import functions as F

from kpiloom.llm import mixing
from tests.llm.texts import corpus, words


def water_fill(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {s: cap * sizes[s] if s in full else left * weight[s] / open_weight for s in names}
        over = {s for s in names if s not in full and target[s] > cap * sizes[s]}
        if not over:
            return target
        full |= over


def docs(make, spread=4):
    pairs = corpus(120)
    df = make(pairs, "taken _size _plan")
    source = F.when(F.col("doc_id") % 9 == 8, None).otherwise(
        F.concat(F.lit("s"), (F.col("doc_id") % spread).cast("string")))
    return pairs, df.withColumn("source", source)


@pytest.mark.parametrize("spread", [1, 3, 4, 8])
def test_targets_and_taken(make, spread):
    pairs, df = docs(make, spread)
    got = mixing.mix_counts(df).collect()
    assert len(got) == len(pairs)
    source = {r.doc_id: r.source for r in df.select("doc_id", "source").collect()}
    sizes = {}
    for i, t in pairs:
        sizes[source[i]] = sizes.get(source[i], 0) + len(words(t))
    goal = water_fill(sizes)
    taken = dict.fromkeys(goal, 0)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(goal[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s, n in taken.items():
        assert abs(n - goal[s]) <= 5  # rounding of the documents in one bucket
    assert sum(goal.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_reruns_and_other_partitions_agree(make):
    _, df = docs(make)
    key = lambda r: (str(r.doc_id), r.size)
    a = sorted(((key(r), r.taken) for r in mixing.mix_counts(df).collect()), key=str)
    b = sorted(((key(r), r.taken) for r in mixing.mix_counts(df.repartition(7)).collect()), key=str)
    assert a == b
    c = sorted(((key(r), r.taken) for r in mixing.mix_counts(df, seed=8).collect()), key=str)
    assert a != c


def test_mixed_rows_hold_the_words_taken(make):
    pairs, df = docs(make)
    counts = {}
    for r in mixing.mix_counts(df).collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + r.taken
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    texts = {}
    for i, t in pairs:
        texts.setdefault(i, []).append(words(t))
    got = {}
    for r in mixed.collect():
        w = words(r.text)
        assert any(w == t[:len(w)] for t in texts[r.doc_id])
        got[r.doc_id] = got.get(r.doc_id, 0) + len(w)
    assert {i: n for i, n in got.items() if n} == {i: n for i, n in counts.items() if n}
    blank = [r for r in mixed.collect() if r.doc_id in (0, 1, 2)]
    assert len(blank) == 3


def test_order_is_by_code_point(spark):
    names = ["é", "Z", "a", "~", "z", "ÿ", "10", "9", "", "𝒜", "￿", None]
    df = spark.createDataFrame([(n,) for n in names], "source string")
    got = {r.source: r.place for r in mixing.in_order(df, "source").collect()}
    assert [n for n, _ in sorted(got.items(), key=lambda x: x[1])] == sorted(n for n in names if n is not None) + [None]


def test_empty_tables_and_sources_without_words(make):
    assert mixing.mix_counts(make([])).collect() == []
    assert mixing.mix(make([])).collect() == []
    got = mixing.mix_counts(make([(1, None), (2, ""), (3, "a b c d")])).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0), (3, 4, 6.0, 6)]
