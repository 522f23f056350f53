import random

import numpy as np
import pytest

from kpiloom.llm import jaccard_join
from tests.llm.texts import corpus, lowered, words


def shingles(text):
    w = words(lowered(text))
    return {" ".join(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {" ".join(w)} if w else set()


def brute(pairs, percent=80):
    sets = [shingles(t) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            o = len(x & sets[j])
            if x and 100 * o >= percent * (len(x) + len(sets[j]) - o) and sets[j]:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    ids = {}
    for k, (i, _) in enumerate(pairs):
        if i is not None:
            ids[find(k)] = min(ids.get(find(k), i), i)
    return sorted(((i, len(x), ids.get(find(k)) if x else i) for k, ((i, _), x) in enumerate(zip(pairs, sets))), key=str)


def near_copies(rng, n, size, edits, start):
    """Copies of one text with few words changed, some of copies of copies."""
    base = [f"w{rng.randrange(200)}" for _ in range(size)]
    made = [base]
    for _ in range(n):
        own = list(rng.choice(made[-5:]) if rng.random() < .5 else base)
        for _ in range(rng.randint(0, edits)):
            k = rng.randrange(len(own))
            own[k:k + rng.choice([0, 1, 1, 2])] = [f"e{rng.randrange(3000)}"]
        made.append(own)
    ids = list(range(start, start + len(made)))
    rng.shuffle(ids)
    return [(i, " ".join(w)) for i, w in zip(ids, made)]


@pytest.mark.parametrize("limit", [8, 4096])
def test_rows_match_brute_force(make, limit):
    rng = random.Random(limit)
    pairs = corpus(70) + near_copies(rng, 60, 120, 4, 1000) + near_copies(rng, 60, 60, 3, 2000) + near_copies(rng, 40, 30, 2, 3000)
    passage = " ".join(f"p{i}" for i in range(60))
    pairs += [(4000 + i, " ".join(f"u{rng.randrange(9)}x{i}" for _ in range(rng.randint(5, 25))) + " " + passage) for i in range(40)]
    got = jaccard_join.components_of(make(pairs, "sid row size token comp leader"), limit=limit).collect()
    assert sorted(map(tuple, got), key=str) == brute(pairs)


def test_links_at_the_threshold(make):
    word = lambda a, b: [f"t{k}" for k in range(a, b)]
    # 18 shingles of 20 + 22 - 18 and so on: around four fifths exactly
    pairs = [(i, " ".join(word(0, a) + [f"z{i}"] * b)) for i, (a, b) in enumerate(
        [(24, 0), (23, 1), (22, 2), (24, 4), (24, 5), (24, 6), (20, 0), (19, 0), (18, 0), (25, 0), (30, 0), (31, 0)])]
    for percent in (80, 95):
        got = jaccard_join.components_of(make(pairs), percent=percent).collect()
        assert sorted(map(tuple, got), key=str) == brute(pairs, percent)


def test_signatures_bound_the_difference():
    rng = np.random.default_rng(3)
    for n, m, shared in ((5, 6, 4), (100, 120, 90), (127, 130, 100), (600, 500, 400), (9000, 9000, 8500)):
        pool = rng.integers(0, 1 << 63, n + m - shared, dtype=np.uint64)
        sides, short = [], []
        for own in (pool[:n], pool[n - shared:]):
            mark, = jaccard_join.parities(own, np.zeros(len(own), np.int64), np.array([len(own)]), 15)
            sides.append(np.frombuffer(mark, np.uint64)[None])
            mark, = jaccard_join.parities(own, np.zeros(len(own), np.int64), np.array([len(own)]), 10)
            short.append(np.frombuffer(mark, np.uint64)[None])
        difference = n + m - 2 * shared
        assert difference * 0.5 < jaccard_join.apart(*sides)[0] <= difference
        assert (jaccard_join.apart(*short) == jaccard_join.apart(sides[0], short[1])).all() and jaccard_join.apart(*short)[0] <= difference


def test_small_cells_give_the_pairs_of_large_ones():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 90, dtype=np.uint64)
    length = rng.integers(1, 30, 40)
    cell = np.repeat(np.arange(40), length)
    sets = [np.sort(rng.choice(pool, int(rng.integers(50, 80)), replace=False)) for _ in cell]
    size = np.array([len(x) for x in sets])
    marks = [jaccard_join.parities(x, np.zeros(len(x), np.int64), np.array([len(x)]), 10)[0] for x in sets]
    pos, comp, part = rng.integers(0, 8, len(cell)), rng.integers(0, 9, len(cell)), rng.integers(0, 2, len(cell))
    across = (np.arange(40) % 2 == 0)[cell]
    x, y, share = jaccard_join._small_cells(cell, size, pos, comp, part, across, marks, 60)
    got = set(zip(x.tolist(), y.tolist()))
    want, near = set(), set()
    for c in range(40):
        at = np.flatnonzero(cell == c)
        for nearest, into in ((False, want), (True, near)):
            i, j = jaccard_join._cell_pairs(size[at], pos[at], comp[at], part[at], [marks[k] for k in at], c % 2 == 0, 60, nearest)
            into |= {(int(min(at[a], at[b])), int(max(at[a], at[b]))) for a, b in zip(i, j)}
    assert got == want and len(want) > 20
    i, j = jaccard_join._nearest(x, y, share)
    assert set(i.tolist()) == {k for p in want for k in p} and {(min(p), max(p)) for p in zip(i.tolist(), j.tolist())} <= want
    assert len(near) <= len(set(i.tolist()))


@pytest.mark.parametrize("most", [7, 1 << 18])
def test_skips_lose_no_pair(most):
    rng = np.random.default_rng(1)
    size, pos = rng.integers(4, 60, 300), rng.integers(0, 12, 300)
    kept = {(min(x, y), max(x, y)) for _, _, a, b in jaccard_join.block_pairs(size, pos, 80, most) for x, y in zip(a.tolist(), b.tolist())}
    for i in range(300):
        for j in range(i):
            need = jaccard_join.least_overlap(int(size[i]), int(size[j]), 80)
            may = min(size[i], size[j]) * 100 >= 80 * max(size[i], size[j]) and min(size[i] - pos[i], size[j] - pos[j]) >= need
            assert ((j, i) in kept) == may


def test_short_long_and_repeated_texts(make):
    long = " ".join(f"l{i}" for i in range(160_000))  # over 1 MB
    pairs = [(5, long), (3, long + " end"), (None, long), (7, "a b"), (8, "A B"), (9, "a b c"), (9, "a b c"), (1, ""), (2, None)]
    got = jaccard_join.components_of(make(pairs)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(5, 159_996, 3), (3, 159_997, 3), (None, 159_996, 3), (7, 1, 7), (8, 1, 7), (9, 1, 9), (9, 1, 9), (1, 0, 1), (2, 0, 2)], key=str)


def test_no_rows(make):
    assert jaccard_join.components_of(make([])).collect() == []
