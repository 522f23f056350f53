import random

import numpy as np
import pytest
import xxhash

from kpiloom.llm import simhash
from kpiloom.llm.components import components
from tests.llm.texts import corpus, lowered, words


def fingerprint(text, n=3):
    w = words(lowered(text))
    shingles = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest index reachable over links of at most two bits."""
    root = list(range(len(prints)))
    x = np.array(prints, np.uint64)
    changed = True
    while changed:
        changed = False
        for i in range(len(x)):
            near = np.flatnonzero(np.bitwise_count(x ^ x[i]) <= 2)
            low = min(root[j] for j in near)
            for j in near:
                if root[j] != low:
                    root[j], changed = low, True
    return root


def test_rows_match_brute_force(make):
    pairs = corpus(70)
    got = simhash.near_duplicates(make(pairs, "fp root")).collect()
    prints = [fingerprint(t) for _, t in pairs]
    roots = brute_components(prints)
    ids = {}
    for (i, _), r in zip(pairs, roots):
        if i is not None:
            ids[r] = min(ids.get(r, i), i)
    want = [(i, f"{p:016x}", ids.get(r)) for (i, _), p, r in zip(pairs, prints, roots)]
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("group", [2, 16, 256])
def test_dense_groups_are_split_without_losing_links(spark, group):
    rng = random.Random(group)
    prints = set()
    for _ in range(4):  # balls of fingerprints around four centres, and a chain
        centre = rng.getrandbits(64)
        for _ in range(150):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 3)):
                x ^= 1 << b
            prints.add(x)
    x = rng.getrandbits(64)
    for b in range(0, 60, 2):
        x ^= 3 << b
        prints.add(x)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    fps = spark.createDataFrame([(s,) for s in signed], "fp long")
    got = {r.node: r.root for r in components(simhash.near_links(fps, group)).collect()}
    mine = [got.get(s, s) for s in signed]
    want = brute_components(prints)
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_keep_one_of_each_group(make):
    pairs = corpus(70)
    docs = make(pairs, "_fp _rank")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    prints = [fingerprint(t) for _, t in pairs]
    roots = brute_components(prints)
    assert len(rows) == len(set(roots))
    by_print = dict(zip(prints, roots))
    assert len({by_print[fingerprint(r.text)] for r in rows}) == len(rows)
    best = {}
    for (i, _), r in zip(pairs, roots):
        best[r] = min(best.get(r, (True, 0)), (i is None, i or 0))
    assert all((r.doc_id is None, r.doc_id or 0) == best[by_print[fingerprint(r.text)]] for r in rows)


def test_no_rows(make):
    assert simhash.near_duplicates(make([])).collect() == []


def test_a_long_rising_path_takes_few_rounds(spark, monkeypatch):
    from kpiloom.llm import components as module
    saved = []
    keep = module.save
    monkeypatch.setattr(module, "save", lambda df, name: saved.append(name) or keep(df, name))
    n = 5000
    got = components(spark.range(n).selectExpr("id AS a", "id + 1 AS b")).agg({"root": "max", "node": "count"}).first()
    assert tuple(sorted(got)) == (0, n + 1)
    # pointers double their way: some log2(n) jumps, and a round or two of contraction
    assert saved.count("cc-jump") <= 20 and saved.count("cc-edges") <= 4


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    random.Random(2).shuffle(edges)
    df = spark.createDataFrame([(b, a) for a, b in edges] + [(300, 300)], "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, **{200 + i: 200 for i in range(9)}}
