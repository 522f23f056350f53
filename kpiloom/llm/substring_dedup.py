"""Substring deduplication over a sparse De Bruijn graph of the corpus.

A word goes if a window of ``WINDOW`` consecutive words over it also starts in a
document with a smaller doc_id. Windows are judged on the input.

Edges. Every window has one token k-mer that represents it: the one with the
smallest hash, the leftmost of equals. That choice depends on the window's words
alone, so equal windows have equal k-mers at equal offsets. The windows of a text
that share a k-mer occurrence are consecutive; the words that they span, with the
k-mer's place in them, are an edge of the graph. There is one edge for some 18 words,
not one for each, and only edges whose k-mer occurs in several documents go on.

Paths. Edges that follow each other in every occurrence of both are joined, in Spark,
to nonbranching paths: a repeated passage becomes one row for each occurrence, with
the coordinates (document, text, first window) of its first occurrence, its source.
An edge's key holds a hash of its k-mer and a 64-bit digest of all the words that it
spans. A later document than the source may lose the whole path: the words of every
such span are read from both texts, at the span's own coordinates and at the source's,
and compared by their sha256. A span that differs from its source (keys that collide)
stays.

Branches. Where a k-mer continues in different ways, only some windows of an edge may
be repeated. Each distinct edge of such a k-mer is read once more at its source
coordinates and its windows are digested one by one: those found at the same offset
of the same k-mer in a smaller document go, wherever the edge itself was first seen;
neighbouring ones leave as one run.

All groups are reduced by minima and counts before anything is joined to them, and
joins run between saved tables, so a passage that a third of all documents share is
split over tasks.

Null texts have no words; texts shorter than a window keep all, texts of any length are
worked on whole (a slice holds 1 MB or one text); an empty table gives no rows, and
columns of any name pass through; repeats within one
document stay; rows with equal doc_id are judged each, against smaller ids only (rows
that repeat both id and words have one set of edges, whose spans hold for all of them);
a null doc_id has no order, so its words stay and are no source. Kept words are
joined by one space where a text lost words; other texts stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from kpiloom.llm.common import (
    discard, find_words, fresh, joined_words, save, slices, span_hashes, text_bytes, word_hashes,
)

WINDOW = 50
K = 16


def _representatives(hashes: np.ndarray, window: int, k: int) -> np.ndarray:
    """For every window of words, the position of its representing k-mer."""
    at = np.arange(len(hashes) - k + 1)
    value = span_hashes(hashes, at, at + k)
    width, have = window - k + 1, 1
    while have < width:  # smallest of the first `have` k-mers, doubled each time
        step = min(have, width - have)
        left, right = value[:-step], value[step:]
        at = np.where(left <= right, at[:-step], at[step:])
        value = np.minimum(left, right)
        have += step
    return at


class _Text:
    """Words of the texts of a slice in flat arrays."""

    def __init__(self, column: pa.Array):
        data, offsets = text_bytes(column)
        starts, ends, self.first = find_words(data, offsets)
        self.joined, self.at = joined_words(data, starts, ends)
        self.data, self.starts, self.ends = data, starts, ends

    def words(self, a: int, b: int) -> bytes:
        return self.joined[self.at[a]:max(self.at[a], self.at[b] - 1)]

    def edges(self, window: int, k: int) -> tuple[np.ndarray, ...]:
        """First and last window of every edge and its k-mer's position and hash."""
        n = len(self.starts) - window + 1
        none = np.zeros(0, np.int64)
        if n <= 0:
            return none, none, none, none.astype(np.uint64)
        hashes = word_hashes(self.data, self.starts, self.ends)
        own = _representatives(hashes, window, k)
        sizes = np.maximum(np.diff(self.first) - window + 1, 0)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        inside = np.repeat(self.first[:-1] - upto[:-1], sizes) + np.arange(upto[-1])
        own = own[inside]
        cut = np.flatnonzero(np.diff(own, prepend=-1))
        last = np.append(cut[1:], len(own))[:len(cut)] - 1
        place = own[cut]
        return inside[cut], inside[last], place, span_hashes(hashes, place, place + k)


def _text_key(words: bytes) -> int:
    return np.uint64(xxhash.xxh3_64_intdigest(words)).astype(np.int64).item()


def pieces(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """A row for every text (n_words, sha256 of its joined words) and for every edge
    (km, edge, lo, n): k-mer hash, digest of all its words, first window, windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                text = _Text(part.column("text"))
                bounds = list(zip(text.first[:-1].tolist(), text.first[1:].tolist()))
                whole = [text.words(a, b) for a, b in bounds]
                key = np.array([_text_key(w) for w in whole], np.int64)
                ids = part.column("doc_id")
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids, "txt": key, "n_words": pa.array(np.diff(text.first), pa.int64()),
                    "sha256": [hashlib.sha256(w).hexdigest() for w in whole],
                    **{c: pa.nulls(len(key), t) for c, t in (("km", pa.int64()), ("edge", pa.int64()),
                                                             ("lo", pa.int32()), ("n", pa.int32()))}})
                lo, hi, place, km = text.edges(window, k)
                digest = xxhash.xxh3_64_intdigest
                edge = np.fromiter((digest(text.joined[a:b], o) for a, b, o in zip(
                    text.at[lo].tolist(), (text.at[hi + window] - 1).tolist(), (place - lo).tolist())),
                    np.uint64, len(lo))
                doc = np.searchsorted(text.first, lo, "right") - 1
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids.take(pa.array(doc)), "txt": key[doc],
                    "n_words": pa.nulls(len(lo), pa.int64()), "sha256": pa.nulls(len(lo), pa.string()),
                    "km": km.view(np.int64), "edge": edge.view(np.int64),
                    "lo": (lo - text.first[doc]).astype(np.int32), "n": (hi - lo + 1).astype(np.int32)})

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, txt long, n_words long, sha256 string, km long, edge long, lo int, n int")


def _paths(edges: DataFrame) -> DataFrame:
    """Occurrences of repeated edges, joined where they follow each other in all
    occurrences of both: doc_id, txt, lo, n and the source's coordinates."""
    in_text = Window.partitionBy("doc_id", "txt").orderBy("lo")
    steps = save(edges.withColumn("before", F.lag(F.struct(
        "km", "edge", "occurs", (F.col("lo") + F.col("n")).alias("end"))).over(in_text))
        .withColumn("before", F.when(F.col("before.end") == F.col("lo"), F.col("before"))), "path-steps")
    joints = save(steps.filter("before IS NOT NULL")
                  .groupBy("km", "edge", "before.km", "before.edge")
                  .agg(F.count("*").alias("c"), F.first("occurs").alias("o"), F.first("before.occurs").alias("p"))
                  .filter("c = o AND c = p").toDF("km", "edge", "km0", "edge0", "c", "o", "p")
                  .select("km", "edge", F.lit(True).alias("joined")), "path-joints", narrow=True)
    marked = save(steps.join(joints, ["km", "edge"], "left"), "path-marked")
    number = F.sum(F.when(F.col("joined"), 0).otherwise(1)).over(in_text)
    paths = save(marked.withColumn("path", number).groupBy("doc_id", "txt", "path")
                 .agg(F.min("lo").alias("lo"), F.sum("n").alias("n"), F.min_by("source", "lo").alias("source")), "paths", narrow=True)
    discard(steps, joints, marked)
    return paths


def _read_places(edges: DataFrame, spans: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """What ``texts`` have at coordinates. A row for each window of ``edges`` at their
    sources: km, edge, w (digest of the window with its offset), i (its place in the edge)
    and doc_id. And one for each span of ``spans`` and its place in the source: doc_id,
    txt, start, end and words (their sha256), if the text has so many."""
    at_source = edges.select("source.doc_id", "source.txt", F.struct("km", "edge", "source.lo", "n").alias("e"))
    at_source = at_source.groupBy("doc_id", "txt").agg(F.collect_list("e").alias("edges"))
    places = spans.select("doc_id", "txt", "start", "end").union(_in_source(spans).select("doc_id", "txt", "start", "end"))
    places = places.distinct().groupBy("doc_id", "txt").agg(F.collect_list(F.struct("start", "end")).alias("places"))
    wanted = at_source.join(places, ["doc_id", "txt"], "full")
    rows = texts.join(wanted, "doc_id").select("doc_id", "text", "txt", "edges", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for part in slices(batch, "text"):
                text = _Text(part.column("text"))
                out: list[list] = [[], [], [], [], []]
                read: list[list] = [[], [], [], [], []]
                for d, (doc, txt, found, places) in enumerate(zip(*(
                        part.column(c).to_pylist() for c in ("doc_id", "txt", "edges", "places")))):
                    a, b = text.first[d].item(), text.first[d + 1].item()
                    if _text_key(text.words(a, b)) != txt:
                        continue
                    for s in places or ():
                        if a + s["end"] <= b:
                            w = hashlib.sha256(text.words(a + s["start"], a + s["end"])).digest()
                            for column, v in zip(read, (doc, txt, s["start"], s["end"], w)):
                                column.append(v)
                    for e in found or ():
                        for i in range(e["n"]):
                            p = a + e["lo"] + i
                            w = digest(text.words(p, p + window))
                            for column, v in zip(out, (e["km"], e["edge"], w, i, doc)):
                                column.append(v)
                none = lambda rows, *types: [pa.nulls(len(rows[0]), t) for t in types]
                yield pa.RecordBatch.from_arrays([
                    pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                    pa.array(np.array(out[2], np.uint64).view(np.int64)), pa.array(out[3], pa.int32()),
                    pa.array(out[4], pa.int64()),
                    *none(out, pa.int64(), pa.int64(), pa.int64(), pa.binary())], names)
                yield pa.RecordBatch.from_arrays([
                    *none(read, pa.int64(), pa.int64(), pa.int64(), pa.int32()), pa.array(read[0], pa.int64()),
                    pa.array(read[1], pa.int64()), pa.array(read[2], pa.int64()), pa.array(read[3], pa.int64()),
                    pa.array(read[4], pa.binary())], names)

    names = ["km", "edge", "w", "i", "doc_id", "txt", "start", "end", "words"]
    return rows.mapInArrow(run, "km long, edge long, w long, i int, doc_id long, txt long, start long, end long, words binary")


def _in_source(spans: DataFrame) -> DataFrame:
    """The spans' places in their sources."""
    return spans.select("source.doc_id", "source.txt", F.col("source.lo").cast("long").alias("start"),
                        (F.col("source.lo") + F.col("end") - F.col("start")).alias("end"))


def _verified(spans: DataFrame, read: DataFrame) -> DataFrame:
    """The ``spans`` whose words are those at their source's coordinates."""
    here = read.select("doc_id", "txt", "start", "end", "words")
    there = read.select(F.struct("doc_id", "txt", F.col("start").cast("int").alias("lo")).alias("source"),
                        (F.col("end") - F.col("start")).alias("n"), "words")
    return (spans.join(here, ["doc_id", "txt", "start", "end"]).withColumn("n", F.col("end") - F.col("start"))
            .join(there, ["source", "n", "words"]).select(*spans.columns))


def repeated_spans(docs: DataFrame, found: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """doc_id, txt, start, end (words, end exclusive) of the spans to remove, source
    (null for single windows), given the ``pieces`` of ``docs``; and the texts that
    share a k-mer with another document."""
    edges = found.filter("km IS NOT NULL AND doc_id IS NOT NULL").drop("n_words", "sha256")
    shared = save(edges.groupBy("km").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
                  .filter("a < b").select("km"), "shared-kmers", narrow=True)
    # repeated rows have the same edges; dealt anew, so that the join can still split a hot k-mer
    near = save(edges.join(shared, "km").repartition("doc_id", "txt", "lo").distinct(), "shared-edges")
    discard(shared)
    kinds = save(near.groupBy("km", "edge").agg(
        F.min(F.struct("doc_id", "txt", "lo")).alias("source"), F.max("doc_id").alias("last"),
        F.max("n").alias("n"), F.count("*").alias("occurs")), "edge-kinds", narrow=True)
    several = kinds.filter("source.doc_id < last").select("km", "edge", "source", "occurs")
    paths = _paths(near.join(several, ["km", "edge"]))
    spans = paths.filter("source.doc_id < doc_id").select(
        "doc_id", "txt", F.col("lo").cast("long").alias("start"), (F.col("lo") + F.col("n") + (window - 1)).alias("end"), "source")

    branching = save(kinds.groupBy("km").agg(
        F.count("*").alias("ways"), F.min("source.doc_id").alias("a"), F.max("source.doc_id").alias("b"))
        .filter("ways > 1 AND a < b").select("km"), "branching-kmers", narrow=True)
    open_kinds = save(kinds.join(branching, "km"), "branching-edges", narrow=True)
    texts = save(docs.select("doc_id", "text").join(
        near.select("doc_id").distinct(), "doc_id", "left_semi"), "shared-texts")
    read = save(_read_places(open_kinds, spans, texts, window), "places-read")
    discard(kinds, branching, open_kinds)
    # repeated rows are read once each
    words = save(read.filter("words IS NOT NULL").select("doc_id", "txt", "start", "end", "words").distinct(),
                 "span-words", narrow=True)
    windows = read.filter("w IS NOT NULL")
    first = save(windows.groupBy("km", "w").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
                 .filter("a < b").select("km", "w", "a"), "branch-first", narrow=True)
    found = (windows.join(first, ["km", "w"]).filter("a < doc_id").groupBy("km", "edge", "doc_id")
             .agg(F.collect_set("i").alias("gone")))  # at most the windows of one edge
    # neighbouring windows are one run, from the first to the last of them
    edge_of = lambda step: F.filter("gone", lambda i: ~F.array_contains(F.col("gone"), i + step))
    gone = save(found.select("km", "edge", "doc_id", F.arrays_zip(
        F.array_sort(edge_of(-1)).alias("a"), F.array_sort(edge_of(1)).alias("b")).alias("runs")), "branch-gone", narrow=True)
    # later documents with the same edge lose all of it with its path
    single = near.join(gone, ["km", "edge", "doc_id"]).select(
        "doc_id", "txt", "lo", F.explode("runs").alias("r")).select(
        "doc_id", "txt", (F.col("lo") + F.col("r.a")).cast("long").alias("start"),
        (F.col("lo") + F.col("r.b") + window).cast("long").alias("end"), F.lit(None).cast(paths.schema["source"].dataType).alias("source"))
    out = save(_verified(spans, words).unionByName(single), "repeated-spans", narrow=True)
    discard(near, paths, read, words, first, gone)
    return out, texts


def _cut(rows: DataFrame, columns: list[str], spans: str, made: list[str]) -> DataFrame:
    """``columns`` of ``rows`` with text less the words of the row's spans, and three
    columns ``made``: the input text's key, words removed and the kept words' sha256."""
    like = [F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit("")]
    schema = rows.select(*columns, *[c.alias(m) for c, m in zip(like, made)]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                text = _Text(part.column("text"))
                old, new, keys, lost, sums = part.column("text").to_pylist(), [], [], [], []
                for d, found in enumerate(part.column(spans).to_pylist()):
                    a, b = text.first[d].item(), text.first[d + 1].item()
                    keys.append(_text_key(text.words(a, b)))
                    cover = np.zeros(b - a + 1, np.int64)
                    for s in found or ():
                        if s["txt"] == keys[-1]:
                            cover[s["start"]] += 1
                            cover[s["end"]] -= 1
                    stays = np.cumsum(cover[:-1]) == 0
                    lost.append(len(stays) - int(stays.sum()))
                    kept = b" ".join(text.joined[i:j - 1] for i, j in zip(
                        text.at[a:b][stays].tolist(), text.at[a + 1:b + 1][stays].tolist()))
                    new.append(kept.decode() if lost[-1] else old[d])
                    sums.append(hashlib.sha256(kept).hexdigest())
                arrays = [pa.array(new, pa.string()) if c == "text" else part.column(c) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(keys, pa.int64()), pa.array(lost, pa.int64()), pa.array(sums, pa.string())],
                    [*columns, *made])

    return rows.mapInArrow(run, schema)


def _by_doc(spans: DataFrame, name: str) -> DataFrame:
    return spans.groupBy("doc_id").agg(F.collect_list(F.struct("txt", "start", "end")).alias(name))


def removal_counts(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs``."""
    found = save(pieces(docs, window, k), "dedup-pieces")
    spans, texts = repeated_spans(docs, found, window)
    cut = _cut(texts.join(_by_doc(spans, "spans"), "doc_id"), ["doc_id", "text"], "spans",
               ["txt", "n_removed", "kept"])
    lost = save(cut.select("doc_id", "txt", "n_removed", "kept").distinct(), "dedup-lost", narrow=True)
    # texts that lose nothing need no second look: their digest is known already
    return (found.filter("km IS NULL").join(lost, ["doc_id", "txt"], "left")
            .select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
                    F.coalesce("kept", "sha256").alias("kept_sha256")))


def remove_repeats(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """``docs`` with all columns and rows, each text less its repeated words."""
    found = save(pieces(docs, window, k), "dedup-pieces")
    spans, texts = repeated_spans(docs, found, window)
    discard(found, texts)
    names = fresh(docs, "_spans", "_txt", "_removed", "_kept")
    rows = docs.join(_by_doc(spans, names[0]), "doc_id", "left").select(*docs.columns, names[0])
    return _cut(rows, docs.columns, names[0], names[1:]).select(*docs.columns)
