import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from kpiloom.llm import periodic
from tests.llm.texts import corpus, words


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def brute_runs(w):
    """start, length, period of every run, period by period."""
    n, seen = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                seen.setdefault((i, j - i + q), q)  # the smallest period comes first
            i = j + 1
    return sorted((i, length, q) for (i, length), q in seen.items())


def expected(doc_id, w):
    runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    gone = {k for i, length, q in runs for k in range(i + q, i + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest())


def rows(df):
    return sorted((tuple(r)[:8] for r in df.collect()), key=str)


def periodic_pairs(seed=3, n=60):
    rng = random.Random(seed)
    out = corpus(40, seed)
    for i in range(100, 100 + n):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 12, 16, 31, 32, 50])
            unit = rng.choices("ab" if rng.random() < .5 else "abcdefghij", k=p)
            parts += rng.choices("abcdefghij", k=rng.randint(0, 12))
            length = rng.randint(max(2, 3 * p), 6 * p + 4)
            parts += [unit[k % p] for k in range(length)]
        out.append((i, " ".join(parts)))
    fib = ["a", "b"]
    while len(fib[-1]) < 700:
        fib.append(fib[-1] + fib[-2])
    out += [(500, " ".join(fib[-1])), (501, "x " * 1000), (502, "x y " * 700 + "x"), (503, "a b a b a b"),
            (504, "a a a a a"), (505, "a a a a a a"), (506, " ".join(f"{i % 300:o}" for i in range(1300)))]
    return out


@pytest.mark.parametrize("rewrite", [None, periodic.planted])
def test_rows_match_brute_force(make, rewrite):
    pairs = periodic_pairs()
    got = rows(periodic.digests(make(pairs, "txt octave runs kept d t"), rewrite))
    want = [expected(i, planted(i, words(t)) if rewrite else words(t)) for i, t in pairs]
    assert got == sorted(want, key=str)


def test_long_runs_are_stitched_from_tiles_of_several_rows(make):
    rng = random.Random(5)
    unit = [str(rng.random()) for _ in range(37)]
    text = " ".join([str(i) for i in range(50)] + [unit[k % 37] for k in range(2000)] + ["end"] * 40)
    docs = make([(1, text), (1, text), (None, text)])
    assert periodic.tiles(docs, tile_words=16).filter("octave = 5").count() > 10
    assert rows(periodic.digests(docs, tile_words=16)) == sorted([expected(i, words(text)) for i in (1, 1, None)], key=str)


def test_thue_morse_words_have_no_run_and_a_text_beyond_a_slice_is_whole(make):
    tm = [bin(i).count("1") % 2 for i in range(8192)]  # equal polynomial hashes modulo 2**64
    long = [f"word{i}" for i in range(150_000)] + ["tick tock boom"] * 20_000  # over 1 MB
    pairs = [(1, " ".join("ab"[b] for b in tm)), (2, " ".join(long))]
    got = {r.doc_id: r for r in periodic.digests(make(pairs)).collect()}
    assert got[1].n_runs == 0
    assert (got[2].n_runs, got[2].start, got[2].length, got[2].period) == (1, 150_000, 60_000, 3)
    assert got[2].collapsed_words == 150_003


def test_collapse_keeps_columns_and_other_texts(make):
    pairs = periodic_pairs(4, 20)
    docs = make(pairs, "_runs _txt")
    out = periodic.collapse(docs)
    assert out.columns == docs.columns
    def cut(t):
        w = words(t)
        gone = {k for i, length, q in brute_runs(w) for k in range(i + q, i + length)}
        return " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(((i, cut(t)) for i, t in pairs), key=str)


def test_no_rows(make):
    assert periodic.digests(make([])).collect() == []
