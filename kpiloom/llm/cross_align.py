"""Alignment of two tokenizers' tokens over the same texts, by their byte ends.

A text is encoded by a byte-level BPE (A, with a space before the text) and by a
sentencepiece model (B, which adds that space itself), special tokens never. A token's
bytes are its entry byte-level decoded (A), or its piece with U+2581 as space and a byte
piece as that byte (B). Texts whose joined bytes of A or of B are not the space and the
text (B normalises some) have no tokens, as null and empty ones.

Chunks. Both tokenizers begin a token at a space between two letters, digits or marks, as
no token of theirs has a space behind one of these (looked up on loading; texts are not
cut otherwise). So texts are cut there, and the alignments of short chunks are
kept in a bounded cache: a worker encodes and aligns each new chunk once.

Groups. The cumulative ends of A's tokens are the keys of a dictionary to their places,
those of B's of another; the sorted intersection of the key sets are the ends that both
share, and cut both id lists into groups. Links. Within a group, a token of A and one of
B are linked where their byte ranges overlap: as only the group's own end is common, a
group of p and q tokens has p + q - 1 links, one for each stretch between neighbouring
ends of either side.

Counts. An id pair's count is how many links of the whole corpus hold it. The first pass
encodes each text once and saves its groups' digest and its distinct pairs; workers add
up pairs before Spark does. Of the counted pairs the most frequent are broadcast, at most
``HOT_PAIRS`` of them; the second pass reads the saved pairs, looks these up, and passes
the others on as (row, pair, number) rows that are joined with the counts. The table of
the best count of each B id has a row for each entry of B's vocabulary at most.

Repeated rows count each, as rows with a null doc_id; texts are encoded whole, a slice
of rows holds about 1 MB or one text; an empty table gives no rows; other columns of
``docs`` are not looked at.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from kpiloom.llm.bpe import byte_symbols
from kpiloom.llm.common import save, slices

HOT_PAIRS = 1 << 20
CACHE_CHUNKS = 300_000  # whose alignments a worker keeps, of
CACHE_CHARS = 64  # characters at most
_HELD = 1 << 18  # pairs that a worker adds up before it passes them on

# A space between two characters that no version of Unicode counts as white space: both
# tokenizers begin a token there.
_CUT = re.compile("(?<=[!-~À-ɏ]) (?=[!-~À-ɏ])")
_PLAIN = re.compile("[!-~À-ɏ](.*[!-~À-ɏ])?", re.DOTALL).fullmatch
_INNER = re.compile(rb"(?:[!-~]|[\xc3-\xc9][\x80-\xbf]|^[\x80-\xbf]) ")


# A chunk's links (A id * 2**32 + B id, 8 bytes each), its numbers of tokens of A and B and of
# groups (8 bytes each), and its groups as text.
Chunk = tuple[bytes, bytes, str]


class Pair:
    """The two encoders, the bytes of their tokens, and the alignments of frequent chunks."""

    def __init__(self, file_a: bytes, file_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread a task
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_buffer(file_a)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=file_b)
        byte = {s: i for i, s in enumerate(byte_symbols())}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array(list(map(len, t)), np.int64) for t in (self.bytes_a, self.bytes_b))
        # an id's digits, and after it the mark inside a group and that behind its side's last id
        self.text_a = np.array([[f"{i},", f"{i}|"] for i in range(len(self.bytes_a))], object)
        self.text_b = np.array([[f"{i},", f"{i};"] for i in range(len(self.bytes_b))], object)
        # where no token has a space behind such a character, texts can be cut there
        inner = any(_INNER.search(t) for t in (*self.bytes_a, *self.bytes_b))
        self.cut = (lambda text: [text]) if inner else _CUT.split
        self.cache: dict[str, Chunk] = {}

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]] | None]:
        """Ids of A and of B of each text; None where either does not give the text back."""
        spaced = [" " + t for t in texts]
        many_a = self.a.encode_batch_fast(spaced, add_special_tokens=False)
        many_b = self.b.encode(texts, num_threads=1)
        for text, a, b in zip(spaced, many_a, many_b):
            a, whole = a.ids, text.encode()
            good = (b"".join(map(self.bytes_a.__getitem__, a)) == whole
                    and b"".join(map(self.bytes_b.__getitem__, b)) == whole)
            yield (a, b) if good else None

    def chunks(self, texts: list[str | None]) -> Iterator[list[Chunk]]:
        """The aligned chunks of each text; none where a tokenizer does not give it back."""
        cut = [self.cut(t) if t else [] for t in texts]
        cache = self.cache
        if len(cache) > CACHE_CHUNKS:
            cache.clear()
        new = set().union(*cut) - cache.keys()
        lost, long = set(), {}
        # chunks that begin and end like words are encoded several as one text: tokens do not cross them
        like = [c for c in new if _PLAIN(c)]
        joined = list(self.encode([" ".join(like[i:i + 256]) for i in range(0, len(like), 256)]))
        if None in joined:
            like, joined = [], []
        rest = list(new.difference(like))
        several = list(self.encode(rest))
        lost = {c for c, x in zip(rest, several) if x is None}
        several = [x for x in several if x is not None]
        for some, ids in ((like, joined), ([c for c in rest if c not in lost], several)):
            for c, chunk in zip(some, self.align(some, ids)):
                (cache if len(c) <= CACHE_CHARS else long)[c] = chunk
        get = (lambda c: long.get(c) or cache[c]) if long else cache.__getitem__
        for parts in cut:
            yield list(map(get, parts)) if not lost or lost.isdisjoint(parts) else []

    def align(self, chunks: list[str], ids: list[tuple[list[int], list[int]]]) -> Iterator[Chunk]:
        """Chunks aligned, given the ids of A and B that cover them and the space before each.
        They lie end to end, so that one pair of dictionaries serves all: where a chunk
        ends, both sides do."""
        a, b = (np.fromiter(chain.from_iterable(side), np.int64) for side in (zip(*ids) if ids else ((), ())))
        stops = np.cumsum([len(c.encode()) + 1 for c in chunks], dtype=np.int64)
        ends_a, ends_b, cut_a, cut_b = common_ends(a, b, self.size_a, self.size_b)
        # links: each end of either side closes a stretch that one token of A and one of B cover
        ends, _ = _tally(np.concatenate([ends_a, ends_b]))
        links = (a[np.searchsorted(ends_a, ends)] << 32 | b[np.searchsorted(ends_b, ends)]).tobytes()
        marks = self.texts(a, b, cut_a, cut_b)
        upto_a, upto_b = np.searchsorted(ends_a, stops) + 1, np.searchsorted(ends_b, stops) + 1
        upto_links, upto_groups = np.searchsorted(ends, stops) + 1, np.searchsorted(cut_a, upto_a) + 1
        numbers = np.diff(np.stack([upto_a, upto_b, upto_groups], axis=1), axis=0, prepend=0).tobytes()
        at_link = at_mark = 0
        for i, (next_link, next_mark) in enumerate(zip((upto_links * 8).tolist(), (upto_a + upto_b).tolist())):
            yield links[at_link:next_link], numbers[24 * i:24 * i + 24], "".join(marks[at_mark:next_mark])[:-1]
            at_link, at_mark = next_link, next_mark

    def groups(self, a: list[int], b: list[int]) -> Iterator[tuple[list[int], list[int]]]:
        """The ids of A and of B of each group of a text."""
        _, _, cut_a, cut_b = common_ends(np.array(a, np.int64), np.array(b, np.int64), self.size_a, self.size_b)
        a0 = b0 = 0
        for a1, b1 in zip(cut_a.tolist(), cut_b.tolist()):
            yield a[a0:a1], b[b0:b1]
            a0, b0 = a1, b1

    def texts(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> list[str]:
        """Each id and the mark behind it, of all groups as `a1,a2|b1;a3|b2,b3;`."""
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[cut_a - 1] = last_b[cut_b - 1] = 1
        out = np.empty(len(a) + len(b), object)
        # a group's tokens of A come after all of B in the groups before, those of B after its own of A
        before = np.append(0, cut_b[:-1])[:len(cut_b)]
        out[np.arange(len(a)) + np.repeat(before, np.diff(cut_a, prepend=0))] = self.text_a[a, last_a]
        out[np.arange(len(b)) + np.repeat(cut_a, np.diff(cut_b, prepend=0))] = self.text_b[b, last_b]
        return out.tolist()


def common_ends(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """The tokens' ends on either side, and how many of each side's tokens end up to each
    end that both share, in order."""
    ends_a, ends_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
    place_a, place_b = dict(zip(ends_a.tolist(), count(1))), dict(zip(ends_b.tolist(), count(1)))
    common = sorted(place_a.keys() & place_b.keys())
    return (ends_a, ends_b, np.fromiter(map(place_a.__getitem__, common), np.int64),
            np.fromiter(map(place_b.__getitem__, common), np.int64))


_loaded: dict[str, Pair] = {}


def _pair(file_a, file_b) -> Pair:
    key = hashlib.sha256(file_a.value).hexdigest() + hashlib.sha256(file_b.value).hexdigest()
    if key not in _loaded:
        _loaded[key] = Pair(file_a.value, file_b.value)
    return _loaded[key]


def _files(docs: DataFrame, path_a: str, path_b: str) -> list:
    out = []
    for path in (path_a, path_b):  # two vocabulary files
        with open(path, "rb") as f:
            out.append(docs.sparkSession.sparkContext.broadcast(f.read()))
    return out


def _tally(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    return keys[first], np.diff(np.append(first, len(keys)))


def _counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, place = np.unique(keys, return_inverse=True)
    return unique, np.bincount(place, counts, len(unique)).astype(np.int64)


def _first_pass(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row for every text (with its distinct pairs, as A id * 2**32 + B id, and how often it
    has each), and rows of pairs added up by a worker (pair, n)."""
    file_a, file_b = _files(docs, path_a, path_b)
    kinds = {"doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
             "groups_sha256": pa.string(), "pairs_a": pa.list_(pa.int32()), "pairs_b": pa.list_(pa.int32()),
             "times": pa.list_(pa.int32()), "pair": pa.int64(), "n": pa.int64()}

    def batch(size: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[c], k) if c in columns else pa.nulls(size, k)
                                           for c, k in kinds.items()], list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(file_a, file_b)
        gc.disable()  # the cache holds many small tuples and no cycles
        held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        size = 0
        for part in (p for b in batches for p in slices(b, "text")):
            out: dict[str, list] = {c: [] for c in list(kinds)[1:9]}
            for chunks in pair.chunks(part.column("text").to_pylist()):
                links, numbers, groups = zip(*chunks) if chunks else ((), (), ())
                links = np.frombuffer(b"".join(links), np.int64)
                found, times = _tally(links)
                held[0].append(found)
                held[1].append(times)
                size += len(found)
                numbers = np.frombuffer(b"".join(numbers), np.int64).reshape(-1, 3).sum(axis=0)
                sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if chunks else ""
                for c, v in zip(out, (*numbers.tolist(), len(links), sha, (found >> 32).astype(np.int32),
                                      found.astype(np.uint32).astype(np.int32), times.astype(np.int32))):
                    out[c].append(v)
            yield batch(part.num_rows, doc_id=part.column("doc_id"), **out)
            if size > 4 * _HELD:
                keys, counts = _counted(*map(np.concatenate, held))
                if len(keys) > _HELD:
                    yield batch(len(keys), pair=keys, n=counts)
                    keys = counts = keys[:0]
                held, size = ([keys], [counts]), len(keys)
        keys, counts = _counted(*map(np.concatenate, held))
        yield batch(len(keys), pair=keys, n=counts)

    schema = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "pairs_a array<int>, pairs_b array<int>, times array<int>, pair long, n long")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pair_counts(added: DataFrame) -> DataFrame:
    """pair, n and best (whether no pair of the B id has a higher count), from rows (pair, n)."""
    counts = save(added.groupBy("pair").agg(F.sum("n").alias("n")), "align-pairs")
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    # one row for each entry of B's vocabulary at most
    highest = counts.groupBy(b.alias("b")).agg(F.max("n").alias("highest"))
    return save(counts.withColumn("b", b).join(F.broadcast(highest), "b")
                .select("pair", "n", (F.col("n") == F.col("highest")).alias("best")), "align-counts")


def _hot(counts: DataFrame, most: int) -> tuple[np.ndarray, ...]:
    """pair, n and best of the most frequent pairs, sorted by pair: whole powers of two of
    counts, ``most`` pairs at most."""
    sizes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("b")).agg(F.count("*").alias("k")).collect()
    total, least = 0, 1 << 62
    for b, k in sorted(sizes, reverse=True):
        total += k
        if total > most:
            break
        least = 1 << b
    table = counts.filter(F.col("n") >= least).toArrow()
    pairs, n, best = (table.column(c).to_numpy() for c in ("pair", "n", "best"))
    by = np.argsort(pairs)
    return pairs[by], n[by], best[by]


def align(docs: DataFrame, path_a: str, path_b: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """For every row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose
    pair's count is the highest of its B id), count_sum (of all links' pair counts) and
    groups_sha256. The paths are tokenizer files on the driver."""
    made = save(_first_pass(docs, path_a, path_b), "align-texts")
    counts = pair_counts(made.filter("pair IS NOT NULL").select("pair", "n"))
    hot = docs.sparkSession.sparkContext.broadcast(_hot(counts, hot_pairs))
    texts = made.filter("n_a IS NOT NULL").drop("pair", "n")
    plain = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kinds = {c: pa.string() if c.endswith("sha256") else pa.int64() for c in plain}
    kinds |= {"row": pa.int64(), "n_best": pa.int64(), "count_sum": pa.int64(), "pair": pa.int64(), "times": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = hot.value
        at = TaskContext.get().partitionId() << 40
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                lists = batch.column("pairs_a")
                sizes = np.diff(lists.offsets.to_numpy())
                # a slice's lists keep the offsets of the whole, `flatten` does not
                own = (lists.flatten().to_numpy().astype(np.int64) << 32
                       | batch.column("pairs_b").flatten().to_numpy())
                times = batch.column("times").flatten().to_numpy().astype(np.int64)
                text = np.repeat(np.arange(batch.num_rows), sizes)
                row = at + np.arange(batch.num_rows)
                at += batch.num_rows
                place = np.minimum(np.searchsorted(pairs, own), max(0, len(pairs) - 1))
                known = pairs[place] == own if len(pairs) else np.zeros(len(own), bool)
                total = np.zeros((2, batch.num_rows), np.int64)
                here = place[known]
                np.add.at(total[0], text[known], times[known] * best[here])
                np.add.at(total[1], text[known], times[known] * n[here])
                rest = ~known
                columns = {c: batch.column(c) for c in plain} | {"row": row, "n_best": total[0], "count_sum": total[1]}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[c], k) if c in columns and c not in plain else columns.get(c, pa.nulls(batch.num_rows, k))
                     for c, k in kinds.items()], list(kinds))
                columns = {"row": row[text[rest]], "pair": own[rest], "times": times[rest]}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[c], k) if c in columns else pa.nulls(int(rest.sum()), k) for c, k in kinds.items()],
                    list(kinds))

    schema = ", ".join(f"{c} {'string' if k == pa.string() else 'long'}" for c, k in kinds.items())
    found = save(texts.mapInArrow(run, schema), "align-found")
    more = (found.filter("pair IS NOT NULL").select("row", "pair", "times").join(counts, "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                 F.sum(F.col("times") * F.col("n")).alias("more_sum")))
    plus = lambda c, m: (F.col(c) + F.coalesce(m, F.lit(0))).alias(c)
    return found.filter("pair IS NULL").join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", plus("n_best", "more_best"), plus("count_sum", "more_sum"),
        "groups_sha256")


def token_groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id and groups (an array of structs of A ids and B ids that cover the same
    bytes) of every row of ``docs``."""
    file_a, file_b = _files(docs, path_a, path_b)
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(file_a, file_b)
        for part in (p for b in batches for p in slices(b, "text")):
            texts = part.column("text").to_pylist()
            ids = [(([], []) if x is None or not t else x) for t, x in zip(texts, pair.encode([t or "" for t in texts]))]
            groups = [[{"a": x, "b": y} for x, y in pair.groups(a, b)] for a, b in ids]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(groups, kind)], ["doc_id", "groups"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, groups array<struct<a array<int>, b array<int>>>")
