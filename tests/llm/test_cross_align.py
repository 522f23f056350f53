import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from kpiloom.llm import cross_align
from tests.llm.texts import corpus

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [(900, "<|endoftext|> is plain text"), (901, "<s> and </s> and <unk>"), (902, "two  blanks and\ttabs\n\nand lines "),
       (903, "a▁b"), (904, "naïve ﬁne ½ Ａ"), (905, "日本語のテキスト 🎉🎉 emoji"), (906, " leading"), (907, "\u0000\u0007 bell"),
       (908, "a" * 5000), (909, "x"), (910, " "), (911, "\n")]


def brute(pairs):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    names = {i: t for t, i in a.get_vocab().items()}
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [n for n in range(256) if n not in own]  # shown as the characters from 256 on, in order
    shown = {chr(n): n for n in own} | {chr(256 + k): n for k, n in enumerate(rest)}
    docs, counts = [], Counter()
    for doc, text in pairs:
        spans = []
        if text:
            ids_a = a.encode(" " + text, add_special_tokens=False).ids
            ids_b = b.encode(text)
            side_a = [(i, bytes(shown[c] for c in names[i])) for i in ids_a]
            side_b = [(i, bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i)
                       else b.id_to_piece(i).replace("▁", " ").encode()) for i in ids_b]
            if all(b"".join(x for _, x in s) == (" " + text).encode() for s in (side_a, side_b)):
                for side in (side_a, side_b):
                    at, own = 0, []
                    for i, x in side:
                        own.append((i, at, at + len(x)))
                        at += len(x)
                    spans.append(own)
        sa, sb = spans or ([], [])
        links, j0 = [], 0
        for i, s, e in sa:
            while j0 < len(sb) and sb[j0][2] <= s:
                j0 += 1
            j = j0
            while j < len(sb) and sb[j][1] < e:
                links.append((i, sb[j][0]))
                j += 1
        counts.update(links)
        ends = sorted({e for *_, e in sa} & {e for *_, e in sb})
        low, groups = 0, []
        for e in ends:
            groups.append([[i for i, s, f in side if low <= s and f <= e] for side in (sa, sb)])
            low = e
        docs.append((doc, sa, sb, groups, links))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for doc, sa, sb, groups, links in docs:
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((doc, len(sa), len(sb), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if sa else ""))
    return out, [(doc, groups) for doc, _, _, groups, _ in docs]


@pytest.mark.parametrize("hot", [0, 50, 1 << 20])
def test_rows_match_brute_force(make, hot):
    pairs = [(i, t if t is None else t[:1500]) for i, t in corpus(40)] + ODD
    got = cross_align.align(make(pairs, "pair n row times best"), A, B, hot).collect()
    want, _ = brute(pairs)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(n_a > 0 for _, n_a, *_ in want) > 30 and sum(n_a == 0 for _, n_a, *_ in want) >= 3


def test_groups_cover_the_same_bytes(make):
    pairs = [(i, t if t is None else t[:300]) for i, t in corpus(20)] + ODD
    got = cross_align.token_groups(make(pairs), A, B).collect()
    _, want = brute(pairs)
    assert sorted(((r.doc_id, [[g.a, g.b] for g in r.groups]) for r in got), key=str) == sorted(want, key=str)


def test_a_text_beyond_a_slice_and_one_long_word(make):
    words = " ".join(f"w{i * 7919 % 10007}" for i in range(200_000))
    rows = {r.doc_id: r for r in cross_align.align(make([(1, words), (2, "q" * 300_000)]), A, B).collect()}
    assert rows[1].n_links == rows[1].n_a + rows[1].n_b - rows[1].n_groups > 400_000
    assert rows[2].n_links == rows[2].n_a + rows[2].n_b - rows[2].n_groups > 0


def test_no_rows(make):
    assert cross_align.align(make([]), A, B).collect() == []
