import hashlib

import pytest

from kpiloom.llm import substring_dedup
from tests.llm.texts import corpus, words


def brute(pairs, window=50):
    first = {}
    for i, t in pairs:
        w = words(t)
        for j in range(len(w) - window + 1):
            key = tuple(w[j:j + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in pairs:
        w, gone = words(t), set()
        for j in range(len(w) - window + 1):
            if i is not None and first[tuple(w[j:j + window])] < i:
                gone.update(range(j, j + window))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def test_matches_brute_force(make):
    pairs = corpus(80)
    assert rows(substring_dedup.removal_counts(make(pairs, "txt km spans"))) == brute(pairs)


@pytest.mark.parametrize("window,k", [(5, 2), (8, 8), (6, 1)])
def test_small_windows_and_many_branches(make, window, k):
    import random
    rng = random.Random(window)
    pairs = [(i, " ".join(rng.choices("ab", k=rng.randint(0, 40)))) for i in range(50)]
    assert rows(substring_dedup.removal_counts(make(pairs), window, k)) == brute(pairs, window)


def test_a_large_group_of_near_copies(make, spark):
    import random
    rng = random.Random(6)
    base = [f"w{rng.randrange(300)}" for _ in range(200)]
    pairs = []
    for i in range(250):
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = f"e{rng.randrange(40)}"
        pairs.append((i, " ".join(own)))
    docs = make(pairs)
    assert rows(substring_dedup.removal_counts(docs)) == brute(pairs)
    # windows of branches leave as runs: far fewer spans than windows, and few of one document
    found = substring_dedup.save(substring_dedup.pieces(docs), "dedup-pieces")
    spans, _ = substring_dedup.repeated_spans(docs, found)
    sizes = spans.groupBy("doc_id").count().agg({"count": "max"}).first()[0]
    assert sizes < 40


def test_repeated_rows_lose_what_single_rows_lose(make):
    import random
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    passage = text(100)
    ends, inside = f"{text(80)} {passage}", f"{text(30)} {passage} {text(200)}"
    pairs = [(1, passage), (2, passage), (2, passage), (3, ends), (3, ends), (3, ends), (4, inside), (4, inside)]
    docs = make(pairs)
    assert rows(substring_dedup.removal_counts(docs)) == brute(pairs)
    kept = sorted((r.doc_id, hashlib.sha256(" ".join(words(r.text)).encode()).hexdigest())
                  for r in substring_dedup.remove_repeats(docs).collect())
    assert kept == sorted((i, h) for i, _, _, h in brute(pairs))


def test_removed_texts_keep_rows_and_columns(make):
    pairs = corpus(40)
    docs = make(pairs, "extra")
    out = substring_dedup.remove_repeats(docs)
    assert out.columns == docs.columns
    got = sorted((r.doc_id, hashlib.sha256(" ".join(words(r.text)).encode()).hexdigest()) for r in out.collect() if r.doc_id is not None)
    assert got == sorted((i, h) for i, _, _, h in brute(pairs) if i is not None)
    lost = {i for i, _, n, _ in brute(pairs) if n}
    old = {(i, t) for i, t in pairs}
    assert all((r.doc_id, r.text) in old for r in out.collect() if r.doc_id not in lost)


def test_spans_are_compared_with_the_words_at_their_source(make):
    from pyspark.sql import functions as F
    text = lambda name: " ".join([f"{name}{i}" for i in range(30)] + [f"k{i}" for i in range(16)] + [f"{name}{i}" for i in range(30, 60)])
    same = " ".join(f"s{i}" for i in range(90))
    docs = make([(1, text("a")), (2, text("b")), (3, same), (4, same)])
    found = substring_dedup.pieces(docs)
    # text 2 claims the edges of text 1
    one = found.filter("km IS NOT NULL AND doc_id = 1")
    blind = found.filter("km IS NULL OR doc_id <> 2").unionByName(one.withColumn("doc_id", F.lit(2).cast("long")).withColumn(
        "txt", F.lit(found.filter("doc_id = 2").first().txt)))
    spans, _ = substring_dedup.repeated_spans(docs, substring_dedup.save(blind, "dedup-pieces"))
    assert {r.doc_id for r in spans.collect()} == {4}


def test_nothing_to_compare(make):
    assert rows(substring_dedup.removal_counts(make([]))) == []
    assert rows(substring_dedup.removal_counts(make([(1, None), (2, "a b")]))) == brute([(1, None), (2, "a b")])
