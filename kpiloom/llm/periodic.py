"""Periodic runs: stretches of words that repeat with a period, found tile by tile.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) of at least max(MIN_WORDS, MIN_TURNS * q) words that no neighbouring word
extends. Put differently: with E[i] true where word i equals word i + q, it is an
interval of E that cannot grow, and q words more.

Tiles. Periods are searched by octave, P <= q < 2P. An octave's zones of s words (1.5 P,
3 at least) tile the document; an interval of E that is long enough for a run holds a
whole zone. A zone's tile is the zone with s words before, s after and 2P more, so tiles
overlap and each is solved from its own words. Documents are exploded into tiles, but
only where some period of the octave holds over the whole zone: a hash of the zone's
words is compared with those q words on, for all zones and q of an octave at once.
Periods that are a multiple of a smaller one are left to that one's octave.

Solving. In a tile the Z-function from the zone's first word gives for every period how
far E holds to the right, that of the reversed words before it how far to the left. Both
compare words, not hashes; a period counts if its words are not themselves periodic.
That is decided on one period's words, which decide it for the whole run. Fragments
are cut at the tile's ends, joined within a row of neighbouring tiles, and dealt by
document and period, where overlapping ones are stitched to whole intervals.

Tiles go out in rows of at most some ``TILE_WORDS`` words of neighbouring zones, so a
long document's tiles are spread over tasks; only texts with such zones move to meet
their runs. Tiles of distinct rows are solved each; equal fragments of repeated rows
(same doc_id, same text) are one.

Null and empty texts have no words and no runs; a null doc_id is a document like any
other (and is not rewritten); repeated rows each get a row; a document of any length is
worked on whole, in arrays of some 50 bytes a word; an empty table gives no rows; other
columns of ``docs`` are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from kpiloom.llm.common import fresh, mix, save, slices

MIN_WORDS = 6
MIN_TURNS = 4
TILE_WORDS = 4096
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 1 << 20  # comparisons made at a time

Rewrite = Callable[[int | None, int], "np.ndarray | None"]


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The places from which the words of a text of n words are taken, where every
    tenth document (by the crc32 of its id) gets a periodic end; else None."""
    if doc_id is None or not n:
        return None
    g, r = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if r:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


def words_of(text: str | None, doc_id: int | None, rewrite: Rewrite | None) -> list[str]:
    found = _WORD.findall(text or "")
    place = rewrite(doc_id, len(found)) if rewrite else None
    return found if place is None else [found[i] for i in place.tolist()]


def zone_words(octave: int) -> int:
    """Words of a zone: an interval of E of a run's least length holds one."""
    return 3 << max(octave - 1, 0)


_factor = np.zeros(2, np.int64)


def least_factors(n: int) -> np.ndarray:
    """The least prime factor of every number up to n."""
    global _factor
    if len(_factor) <= n:
        _factor = np.arange(max(n + 1, 1 << 16))
        for i in range(2, int(len(_factor) ** 0.5) + 1):
            if _factor[i] == i:
                part = _factor[i * i::i]
                part[part == np.arange(i * i, len(_factor), i)] = i
    return _factor


def _zones(ids: np.ndarray, end: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each octave the first words of the zones over which some period of the octave
    holds, by hash. ``ids``: words of several texts, with a word of its own after each
    text; ``end``: each word's text's end; ``longest``: the words of the longest text."""
    level = mix((ids.astype(np.uint64) + np.uint64(1)) * _STEP)  # of blocks of 2**octave words
    pair = lambda a, by: mix(a[:-by] * _STEP + a[by:]) if len(a) > by else a[:0]
    below, octave = level, 0
    while MIN_TURNS << octave <= longest:
        step, size = 1 << octave, zone_words(octave)
        if octave:
            below, level = level, pair(level, step >> 1)
        whole = pair(pair(level, 1), 1) if octave == 0 else pair(level, step >> 1)
        at = np.arange(0, len(whole), size)
        at = at[at + size + step <= end[at]]
        found = []
        rows = max(1, _CHUNK // step)
        for lo in range(0, len(at), rows):
            zone = at[lo:lo + rows]
            for q0 in range(step, 2 * step, _CHUNK):
                q = np.arange(q0, min(q0 + _CHUNK, 2 * step))
                other = zone[:, None] + q
                same = np.take(whole, other, mode="clip") == whole[zone][:, None]
                z, p = np.nonzero(same & (other < len(whole)))
                if len(z):
                    found.append(zone[z[_primitive(zone[z], q[p], level, below, octave)]])
        if found:
            yield octave, np.unique(np.concatenate(found))
        octave += 1


def _primitive(at: np.ndarray, q: np.ndarray, level: np.ndarray, below: np.ndarray, octave: int) -> np.ndarray:
    """Whether the q words from ``at`` have no smaller period that divides q, by hash."""
    good, left, factor = np.ones(len(q), bool), q.copy(), least_factors(2 << octave)
    while (left > 1).any():
        some = np.flatnonzero((left > 1) & good)
        if not len(some):
            break
        prime = factor[left[some]]
        left[some] //= prime
        d = q[some] // prime
        size = q[some] - d  # words to compare; at least half a block
        big = size >= 1 << octave
        same = np.zeros(len(some), bool)
        for which, blocks, width in ((big, level, 1 << octave), (~big, below, 1 << max(octave - 1, 0))):
            a, by, last = at[some[which]], d[which], size[which] - width
            same[which] = (blocks[a] == blocks[a + by]) & (blocks[a + last] == blocks[a + last + by])
        good[some] = ~same
        left[~good] = 1
    return good


def _blocks(octave: int, zones: np.ndarray, end: np.ndarray, words: int) -> Iterator[tuple[int, int]]:
    """First zone and number of zones of runs of neighbouring zones of one text."""
    size = zone_words(octave)
    most = max(1, words // size)
    cut = np.flatnonzero((np.diff(zones) != size) | (end[zones[1:]] != end[zones[:-1]])) + 1
    for a, b in zip(np.append(0, cut).tolist(), np.append(cut, len(zones)).tolist()):
        for c in range(a, b, most):
            yield int(zones[c]), min(most, b - c)


def tiles(docs: DataFrame, rewrite: Rewrite | None = None, tile_words: int = TILE_WORDS) -> DataFrame:
    """A row for every text: doc_id, txt (a key of its words), n, kept (sha256 of all its words) and,
    if it has tiles, text; and a row for each run of tiles: doc_id, txt, octave, at (place
    of the first of ``ids``), zone (place of the first zone among them), zones and ids."""
    schema = ("doc_id long, txt long, n long, kept string, text string, octave int, at long, zone int, "
              "zones int, ids array<int>, deal long")
    names = [c.split()[0] for c in schema.split(", ")]

    def rows(size: int, **columns) -> pa.RecordBatch:
        kinds = {"kept": pa.string(), "text": pa.string(), "octave": pa.int32(), "zone": pa.int32(),
                 "zones": pa.int32(), "ids": pa.list_(pa.int32())}
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c], kinds.get(c, pa.int64())) if c in columns else pa.nulls(size, kinds.get(c, pa.int64()))
             for c in names], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text"):
                doc_ids, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
                number: dict[str, int] = {}
                flat, first, kept, keys = [], [0], [], []
                for doc, text in zip(doc_ids, texts):
                    own = words_of(text, doc, rewrite)
                    joined = " ".join(own).encode()
                    kept.append(hashlib.sha256(joined).hexdigest())
                    keys.append(np.uint64(xxhash.xxh3_64_intdigest(joined)).astype(np.int64).item())
                    flat += [number.setdefault(w, len(number)) for w in own]
                    flat.append(-len(first))  # a word of its own
                    first.append(len(flat))
                ids, first = np.array(flat, np.int64), np.array(first)
                sizes = np.diff(first) - 1
                del flat
                end = np.repeat(first[1:] - 1, sizes + 1)
                has, out = set(), {c: [] for c in ("doc_id", "txt", "octave", "at", "zone", "zones", "ids", "deal")}
                for octave, zones in _zones(ids, end, int(sizes.max(initial=0))):
                    size = zone_words(octave)
                    for zone, count in _blocks(octave, zones, end, tile_words):
                        d = int(np.searchsorted(first, zone, "right")) - 1
                        lo = max(zone - size, int(first[d]))
                        hi = min(zone + (count + 1) * size + (2 << octave), int(end[zone]))
                        has.add(d)
                        deal += 1
                        for c, v in zip(out, (doc_ids[d], keys[d], octave, lo - int(first[d]), zone - lo, count,
                                              ids[lo:hi].astype(np.int32), deal)):
                            out[c].append(v)
                        if len(out["ids"]) >= 1024:
                            yield rows(len(out["ids"]), **out)
                            out = {c: [] for c in out}
                yield rows(len(out["ids"]), **out)
                yield rows(len(keys), doc_id=doc_ids, txt=keys, n=sizes, kept=kept,
                           text=[t if d in has else None for d, t in enumerate(texts)])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def z_function(x: list[int], upto: int) -> list[int]:
    """z[i]: how many items from i on agree with those from 0 on, for 0 < i < upto."""
    n = len(x)
    z = [n] + [0] * (min(upto, n) - 1)
    a = b = 0
    for i in range(1, len(z)):
        k = min(b - i, z[i - a]) if i < b else 0
        while i + k < n and x[k] == x[i + k]:
            k += 1
        z[i] = k
        if i + k > b:
            a, b = i, i + k
    return z


def solve(ids: list[int], octave: int, zone: int) -> list[tuple[int, int, int]]:
    """period, first and end of E of the fragments of a tile whose zone starts at
    ``zone`` of ``ids``, for periods of the octave that hold over the whole zone."""
    step, size = 1 << octave, zone_words(octave)
    z = z_function(ids[zone:zone + 2 * size + 2 * step], 2 * step)
    factor, found = least_factors(2 * step), []
    for q in range(step, len(z)):
        if z[q] < size:
            continue
        left = q
        while left > 1 and z[q // int(factor[left])] < q - q // int(factor[left]):
            left //= int(factor[left])
        if left == 1:  # no smaller period divides q over q words
            found.append(q)
    if not found:
        return []
    before = ids[max(0, zone - size):zone][::-1]
    last = min(zone + 2 * step, len(ids))
    turned = before + [-1 << 40] + ids[max(0, zone - size):last][::-1]
    back = z_function(turned, len(before) + 1 + last - zone)
    # the words that end at zone + q are `last - zone - q` places into the turned tile
    reach = lambda q: back[len(before) + 1 + last - zone - q] if before else 0
    return [(q, zone - min(reach(q), size), zone + min(z[q], 2 * size)) for q in found]


def fragments(rows: DataFrame) -> DataFrame:
    """doc_id, txt, period, lo, hi of the fragments of tiles, joined within each row."""
    schema = "doc_id long, txt long, period long, lo long, hi long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, txt, octave, at, zone, zones, ids in zip(*(batch.column(c).to_pylist() for c in (
                    "doc_id", "txt", "octave", "at", "zone", "zones", "ids"))):
                open_ends: dict[int, list[int]] = {}
                size = zone_words(octave)
                for i in range(zones):
                    for q, lo, hi in solve(ids, octave, zone + i * size):
                        have = open_ends.get(q)
                        if have and lo <= have[1]:
                            have[1] = max(have[1], hi)
                            continue
                        if have:
                            out.append((doc, txt, q, at + have[0], at + have[1]))
                        open_ends[q] = [lo, hi]
                out += [(doc, txt, q, at + lo, at + hi) for q, (lo, hi) in open_ends.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)], ["doc_id", "txt", "period", "lo", "hi"])

    return rows.mapInArrow(run, schema)


def stitch(parts: DataFrame) -> DataFrame:
    """doc_id, txt, start, length and period of every run, from fragments."""
    own = Window.partitionBy("doc_id", "txt", "period").orderBy("lo", "hi")
    reach = F.max("hi").over(own.rowsBetween(Window.unboundedPreceding, -1))
    start = F.when(F.col("lo") <= reach, 0).otherwise(1)
    number = F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0))
    return (parts.distinct().withColumn("new", start).withColumn("number", number)
            .groupBy("doc_id", "txt", "period", "number").agg(F.min("lo").alias("start"), F.max("hi").alias("hi"))
            .withColumn("length", F.col("hi") - F.col("start") + F.col("period"))
            .filter((F.col("length") >= MIN_WORDS) & (F.col("length") >= MIN_TURNS * F.col("period")))
            .select("doc_id", "txt", "start", "length", "period"))


def find_runs(docs: DataFrame, rewrite: Rewrite | None = None, tile_words: int = TILE_WORDS) -> tuple[DataFrame, DataFrame]:
    """The saved runs (doc_id, txt, start, length, period) of all texts, and a saved row for
    every text (doc_id, txt, n, kept, and text where it may have runs)."""
    made = save(tiles(docs, rewrite, tile_words), "runs-tiles")
    spread = made.filter("octave IS NOT NULL").select(
        "doc_id", "txt", "octave", "at", "zone", "zones", "ids", "deal")
    # dealt by a running number, as a document's tiles, or those of repeated rows, may be many
    parts = fragments(spread.repartition("deal"))
    found = save(stitch(parts), "runs-found")
    return found, made.filter("octave IS NULL").select("doc_id", "txt", "n", "kept", "text")


def digests(docs: DataFrame, rewrite: Rewrite | None = None, tile_words: int = TILE_WORDS) -> DataFrame:
    """A row for every row of ``docs``: doc_id, n_runs, the run with the greatest length to
    period (start, length, period, exponent_milli), runs_sha256, collapsed_sha256 (words
    left when each run keeps its first period alone) and collapsed_words."""
    found, texts = find_runs(docs, rewrite, tile_words)
    schema = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
              "runs_sha256 string, collapsed_sha256 string, collapsed_words long")
    names = [c.split()[0] for c in schema.split(", ")]
    lists = found.groupBy("doc_id", "txt").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    lists = lists.select(F.col("doc_id").alias("d"), F.col("txt").alias("t"), "runs")
    some = texts.filter("text IS NOT NULL").select("doc_id", "txt", "text")
    some = some.join(lists, some["doc_id"].eqNullSafe(lists["d"]) & (some["txt"] == lists["t"]), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out: list[tuple] = []
                for doc, text, runs in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "runs"))):
                    own = words_of(text, doc, rewrite)
                    runs = sorted((r["start"], r["period"], r["length"]) for r in runs or ())
                    cover = np.zeros(len(own) + 1, np.int64)
                    best, lines = None, []
                    for start, q, length in runs:
                        lines.append(f"{start},{length},{q}\n")
                        cover[start + q] += 1
                        cover[start + length] -= 1
                        if best is None or length * best[1] > best[2] * q:
                            best = start, q, length
                    stays = np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()
                    start, q, length = best or (None, None, None)
                    out.append((doc, len(runs), start, length, q, 1000 * length // q if best else None,
                                hashlib.sha256("".join(lines).encode()).hexdigest(),
                                hashlib.sha256(" ".join([own[i] for i in stays]).encode()).hexdigest(), len(stays)))
                columns = list(zip(*out)) if out else [[]] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string() if n.endswith("sha256") else pa.int64()) for n, c in zip(names, columns)], names)

    none = F.lit(None).cast("long")
    plain = texts.filter("text IS NULL").select(
        "doc_id", F.lit(0).cast("long").alias("n_runs"), none.alias("start"), none.alias("length"), none.alias("period"),
        none.alias("exponent_milli"), F.lit(hashlib.sha256(b"").hexdigest()).alias("runs_sha256"),
        F.col("kept").alias("collapsed_sha256"), F.col("n").alias("collapsed_words"))
    return plain.unionByName(some.select("doc_id", "text", "runs").mapInArrow(run, schema))


def collapse(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns, every run cut to its first period: the kept words joined by
    one space where a text lost words, other texts as they are."""
    found, _ = find_runs(docs)
    spans, key = fresh(docs, "_runs", "_txt")
    lists = found.groupBy("doc_id", "txt").agg(F.collect_list(F.struct("start", "length", "period")).alias(spans))
    by_doc = lists.groupBy("doc_id").agg(F.collect_list(F.struct("txt", spans)).alias(key))
    by_doc = by_doc.select(F.col("doc_id").alias(spans), key)
    rows = docs.join(by_doc, docs["doc_id"].eqNullSafe(by_doc[spans]), "left").drop(spans)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                for d, found in enumerate(part.column(key).to_pylist()):
                    if not found:
                        continue
                    own = words_of(texts[d], None, None)
                    txt = np.uint64(xxhash.xxh3_64_intdigest(" ".join(own).encode())).astype(np.int64).item()
                    cover = np.zeros(len(own) + 1, np.int64)
                    for r in (r for f in found if f["txt"] == txt for r in f[spans]):
                        cover[r["start"] + r["period"]] += 1
                        cover[r["start"] + r["length"]] -= 1
                    if cover.any():
                        texts[d] = " ".join([own[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in columns], columns)

    return rows.mapInArrow(run, docs.schema)
