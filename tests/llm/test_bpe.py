import hashlib
import random
import time

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kpiloom.llm import bpe
from tests.llm.texts import corpus

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as f:
        return bpe.Bpe(f.read())


def awkward():
    rng = random.Random(3)
    out = ["", "  ", "aaa aaaaaaa aaaab", "ΑΣ Σ ΟΔΟΣ", "İstanbul ǅ", "é ́x", "a\x1cb \x85c\xa0d",
           "<|endoftext|>x<|startoftext|>", "hello's I'LL 'S'd ''s", "½ ² 12３ ௧", "日本語 한국어", "don't<|endoftext",
           "\x00\x01 a​b", "ﬁ Å ﷺ", "word,word;word!!!", "Ünï-cödé."]
    ranges = [(32, 127), (128, 0x600), (0x900, 0xD7FF), (0x1F300, 0x1F700), (32, 33), (10, 11)]
    for _ in range(1500):
        out.append("".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(60))))
    return out


def test_ids_and_decoding_equal_the_library(own, library):
    texts = awkward() + [t or "" for _, t in corpus()]
    ids = own.encode([t.encode() for t in texts])
    assert ids == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [own.decode(i) for i in ids] == [library.decode(i, skip_special_tokens=False) for i in ids]


def test_cache_may_be_dropped_at_any_time(own, monkeypatch):
    texts = [t.encode() for t in awkward()[:200]]
    whole = own.encode(texts)
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 0)
    assert [own.encode([t])[0] for t in texts] == whole


def test_rows(make, library):
    pairs = corpus(30)
    got = bpe.encode(make(pairs, "ids n_tokens"), PATH).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in pairs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got), key=str) == sorted(want, key=str)
    assert all(len(r.ids) == r.n_tokens for r in got)
    assert bpe.encode(make([]), PATH).collect() == []


def test_long_words_equal_the_library_in_little_time(own, library):
    rng = random.Random(8)
    words = ["".join(rng.choices(alphabet, k=n)) for n, alphabet in (
        (bpe.LONG_WORD, "ab"), (bpe.LONG_WORD + 1, "ab"), (3000, "a"), (20_000, "etaoin"), (4000, "日本語漢字"),
        (1_000_000, "abcdefghijklmnopqrstuvwxyz0123456789"))]
    text = "short words " + " ".join(words) + " and more"
    began = time.process_time()
    got = own.encode([text.encode()])[0]
    assert time.process_time() - began < 30
    assert got == library.encode(text, add_special_tokens=False).ids
    assert max(map(len, own.cache)) <= bpe.CACHE_BYTES
