"""BPE encoding and decoding with a given tokenizer file, by batched merge rounds.

The file is a tokenizers JSON with BPE word ends: NFC, lower case, a split into
letters, single digits and other marks, then byte symbols whose last one in a word
carries the end mark. Encoding puts the symbols of many words in one flat array.
A round looks up the pair of every two neighbours by binary search among the sorted
pair keys, takes the lowest rank of each word, and merges its occurrences from left
to right; words with nothing left to merge leave the array. That equals merging one
pair at a time, because every merge of the file makes a token of its own, so no
new pair can rank before the pair that made it (checked on loading).

A word of more than ``LONG_WORD`` symbols (a text without blanks) is merged by itself: its
rounds take the lowest rank from a heap and touch that pair's places and their
neighbours only, so its work is that of its merges, not rounds times length.

Texts are cut at ASCII white space, which no token crosses, and the ids of short chunks
are remembered within a cache bounded in entries and bytes, so a worker merges each
new chunk once.

Null and empty texts have no tokens and decode to the empty text; repeated rows are
encoded each, a null doc_id stays null, an empty table gives no rows, and other columns
are not looked at. Texts are encoded whole; a slice of rows holds a few MB or one text.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Regex, normalizers
from tokenizers.pre_tokenizers import Split

from kpiloom.llm.common import slices

CACHE_CHUNKS = 400_000  # of
CACHE_BYTES = 64  # at most
LONG_WORD = 512  # symbols above which a word is merged by itself
MARKS = b".,;:!?)]}"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level tokenizers:
    printable Latin-1 characters stand for themselves, the others, in order, are
    shifted behind them."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, file: bytes):
        spec = json.loads(file)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in chain(vocab.items(), self.special.items()):
            self.tokens[i] = token
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + end] for s in symbols], np.int64)
        pairs = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]], np.int64)
        if len(set(pairs[:, 2].tolist())) != len(pairs):
            raise ValueError("two merges make one token; merge rounds need one merge for each")
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order, pairs[order, 2]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"]
        # beyond ASCII the library's own normalisers and expressions are used, so that
        # its Unicode tables hold
        self.clean = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str
        self.cut = Split(Regex(pattern), "removed", invert=True).pre_tokenize_str
        plain = pattern.replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9")
        self.words = re.compile(plain.encode()).findall
        self.special_bytes = [s.encode() for s in self.special]
        self.parts = re.compile("|".join(map(re.escape, self.special)) or "(?!)")
        self.cache: dict[bytes, tuple[int, ...]] = {}

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each (non-empty) word."""
        long = [i for i, w in enumerate(words) if len(w) > LONG_WORD]
        if long:
            out = [self.merge_long(w) if len(w) > LONG_WORD else [] for w in words]
            short = [i for i, w in enumerate(words) if len(w) <= LONG_WORD]
            for i, ids in zip(short, self.merge([words[i] for i in short]) if short else ()):
                out[i] = ids
            return out
        sizes = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(sizes)
        ids = self.inner[data]
        ids[ends - 1] = self.last[data[ends - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        out: list[list[int]] = [[]] * len(words)

        def leave(done, ids, word):
            cuts = np.flatnonzero(np.diff(word, prepend=-1))
            for w, a, b in zip(word[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(word)]):
                if done[w]:
                    out[w] = ids[a:b]

        while len(ids):
            pair = ids[:-1] << 32 | ids[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            fits = (self.keys[at] == pair) & (word[:-1] == word[1:])
            rank = np.where(fits, self.ranks[at], len(self.ranks))
            first = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.full(len(words), len(self.ranks), np.int64)
            best[word[first]] = np.minimum.reduceat(np.append(rank, len(self.ranks)), first)
            done = best == len(self.ranks)
            if done[word].any():
                stays = ~done[word]
                leave(done, ids[~stays].tolist(), word[~stays])
                ids, word, rank, made = ids[stays], word[stays], rank[stays[:-1]], self.made[at][stays[:-1]]
                rank = rank[:max(0, len(ids) - 1)]
                made = made[:max(0, len(ids) - 1)]
            else:
                made = self.made[at]
            hit = np.flatnonzero(rank == best[word[:-1]])
            if len(hit) == 0:
                continue
            # of hits that overlap (a pair of equal symbols), every second one counts
            fresh = np.diff(hit, prepend=-2) > 1
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            ids[hit] = made[hit]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            ids, word = ids[keep], word[keep]
        return out

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of pairs (beyond all ranks where they do not merge) and what they make."""
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.ranks[at], len(self.ranks)), self.made[at]

    def merge_long(self, word: bytes) -> list[int]:
        """Ids of one long word: merge rounds that touch only the pairs they merge and their
        neighbours. Symbols are linked to their neighbours, and places wait by the rank of
        the pair that begins there."""
        data = np.frombuffer(word, np.uint8)
        n, none = len(data), len(self.ranks)
        ids = np.append(self.inner[data], -1)
        ids[n - 1] = self.last[data[-1]]
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        alive, rank, made = np.append(np.ones(n, bool), False), np.full(n + 1, none), np.zeros(n + 1, np.int64)
        rank[:n - 1], made[:n - 1] = self._rank(ids[:n - 1], ids[1:n])
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def wait(places: np.ndarray) -> None:
            own = rank[places]
            order = np.argsort(own, kind="stable")
            order = order[own[order] < none]
            own, places = own[order], places[order]
            cuts = np.flatnonzero(np.diff(own, prepend=-1)).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(own)]):
                r = int(own[a])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(ranks, r)
                waiting[r].append(places[a:b])

        wait(np.arange(n))
        while ranks:
            lowest = heapq.heappop(ranks)
            hit = np.unique(np.concatenate(waiting.pop(lowest)))
            hit = hit[alive[hit] & (rank[hit] == lowest)]
            if not len(hit):
                continue
            # of hits that overlap (a pair of equal symbols), every second one counts
            fresh = np.append(True, after[hit[:-1]] != hit[1:])
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            gone = after[hit]
            ids[hit] = made[hit]
            alive[gone] = False
            after[hit] = after[gone]
            before[after[hit]] = hit
            left = before[hit]
            touched = np.unique(np.concatenate([hit, left[left >= 0]]))
            right = after[touched]
            rank[touched], made[touched] = self._rank(ids[touched], ids[right])
            rank[touched[right >= n]] = none
            wait(touched)
        return ids[:n][alive[:n]].tolist()

    def split(self, chunk: bytes) -> list[bytes | int]:
        """Words of a chunk without ASCII white space; ids of special tokens as they are."""
        core = chunk.rstrip(MARKS)
        plain = core.decode().lower()
        if plain.isalpha() and "ς" not in plain and unicodedata.is_normalized("NFC", plain):
            return [plain.encode(), chunk[len(core):]] if len(core) < len(chunk) else [plain.encode()]
        if chunk.isascii() and not (b"<" in chunk and any(t in chunk for t in self.special_bytes)):
            return self.words(chunk.lower())
        text, out, at = chunk.decode(), [], 0
        for m in chain(self.parts.finditer(text), [None]):
            part = self.clean(text[at:m.start() if m else None])
            out += [w.encode() for w, _ in self.cut(part)]
            if m:
                out.append(self.special[m[0]])
                at = m.end()
        return out

    def encode(self, texts: list[bytes]) -> list[list[int]]:
        """Ids of each UTF-8 text."""
        chunks = [t.split() for t in texts]
        cache = self.cache
        if len(cache) > CACHE_CHUNKS:
            cache.clear()
        new = list(set().union(*chunks) - cache.keys())
        parts = [self.split(c) for c in new]
        words = list({w for p in parts for w in p if not isinstance(w, int)})
        ids: dict[bytes | int, list[int]] = dict(zip(words, self.merge(words))) if words else {}
        ids.update((i, [i]) for i in self.special.values())
        made = ((c, tuple(chain.from_iterable(map(ids.__getitem__, p)))) for c, p in zip(new, parts))
        long: dict[bytes, tuple[int, ...]] = {}
        for c, found in made:
            (cache if len(c) <= CACHE_BYTES else long)[c] = found
        get = (lambda c: cache[c] if c in cache else long[c]) if long else cache.__getitem__
        return [list(chain.from_iterable(map(get, c))) for c in chunks]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space: the file names no decoder of its own."""
        return " ".join(map(self.tokens.__getitem__, ids))


_loaded: dict[str, Bpe] = {}


def _model(file) -> Bpe:
    key = hashlib.sha256(file.value).hexdigest()
    if key not in _loaded:
        _loaded[key] = Bpe(file.value)
    return _loaded[key]


def encode(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (if asked for), ids_sha256 and decoded_sha256 of every
    row of ``docs`` (doc_id, text); ``path`` is the tokenizer file on the driver."""
    with open(path, "rb") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _model(file)
        gc.disable()  # the cache holds many small tuples and no cycles
        numbers = [str(i) for i in range(len(bpe.tokens))]
        try:
            for batch in batches:
                for part in slices(batch, "text"):
                    texts = part.column("text").cast(pa.large_binary()).to_pylist()
                    ids = bpe.encode([t or b"" for t in texts])
                    out = {
                        "doc_id": part.column("doc_id"),
                        "n_tokens": pa.array(map(len, ids), pa.int64()),
                        "ids_sha256": [_sha(" ".join(map(numbers.__getitem__, i))) for i in ids],
                        "decoded_sha256": [_sha(bpe.decode(i)) for i in ids],
                    }
                    if with_ids:
                        out["ids"] = pa.array(ids, pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_pydict(out)
        finally:
            gc.enable()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema + ", ids array<int>" * with_ids)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
