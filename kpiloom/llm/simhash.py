"""SimHash near-duplicates found with pivot distance tables.

A text's fingerprint has a bit set where more than half of the XXH64 hashes of its
word shingles have it. Texts are linked when their fingerprints differ in at most
MAX_BITS = 2 bits; a component is everything that links reach. Equal fingerprints
are one node from the start, so copies never meet each other.

Search. The Hamming distances of a fingerprint to many reference fingerprints
(pivots) are its coordinates, and two fingerprints within 2 bits have coordinates
that differ by at most 2 each. Two bits touch at most two of four 16-bit bands, so
such a pair agrees on all pivots that lie in two bands; for pivots that are the
bands' single bits these coordinates are the bits themselves, and the six choices
of two bands are the keys by which fingerprints meet. Within a key, rows are sorted
by their distance to the first pivot and only compared while that differs by at
most 2; a pair goes if any of the other pivots' distances differs by more; survivors
are verified by their exact Hamming distance.

Dense keys. A key with more than ``GROUP`` fingerprints is split by the same rule over
the bits that it leaves open (32, then 16): each step gives six finer keys, and after
the third at most 8 bits are open, so at most 256 fingerprints are left, with no
pair lost. Links leave a task as one link to the smallest member for each
fingerprint, so their number is linear in the fingerprints, not in the pairs.

Null, empty and blank texts have fingerprint zero and are linked like any other;
repeated rows are near-duplicates; a null doc_id never names a component unless all
its rows have none. Texts of any length are worked on whole (a slice holds 1 MB or one
text); an empty table gives no rows; columns of any name pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from kpiloom.llm.common import find_words, fresh, joined_words, lower, save, slices, text_bytes
from kpiloom.llm.components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
BANDS = 4
GROUP = 256
PIVOTS = np.random.default_rng(64).integers(0, 1 << 63, 24, dtype=np.int64) * 2 + 1


def fingerprint(hashes: np.ndarray) -> int:
    """The fingerprint of one text's shingle hashes; zero if it has none."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    most = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(most, bitorder="little").view(np.uint64)[0])


def _text_fingerprints(column: pa.Array, shingle: int) -> np.ndarray:
    data, offsets = text_bytes(column)
    starts, ends, first = find_words(data, offsets)
    joined, at = joined_words(lower(data), starts, ends)
    counts = np.diff(first)
    shingles = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    upto = np.concatenate([[0], np.cumsum(shingles)])
    word = np.repeat(first[:-1] - upto[:-1], shingles) + np.arange(upto[-1])
    stop = np.minimum(word + shingle, np.repeat(first[1:], shingles))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(at[word].tolist(), (at[stop] - 1).tolist())),
                         np.uint64, len(word))
    return np.array([fingerprint(hashes[a:b]) if b > a else 0 for a, b in zip(upto[:-1], upto[1:])],
                    np.uint64).view(np.int64)


def with_fingerprints(docs: DataFrame, name: str, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` (with a column text) and its fingerprints as a long column ``name``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                made = pa.array(_text_fingerprints(part.column("text"), shingle), pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, name])

    schema = docs.select("*", F.lit(0).cast("long").alias(name)).schema
    return docs.mapInArrow(run, schema)


def _masks(open_bits: list[int]) -> list[tuple[int, list[int]]]:
    """For each choice of two of four bands of the open bits: their mask and the bits left open."""
    size = len(open_bits) // BANDS
    bands = [open_bits[i * size:(i + 1) * size] for i in range(BANDS)]
    out = []
    for pair in combinations(range(BANDS), BANDS - MAX_BITS):
        fixed = [b for i in pair for b in bands[i]]
        out.append((sum(1 << b for b in fixed), [b for b in open_bits if b not in fixed]))
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def key_masks(level: int) -> dict[int, tuple[int, list[int]]]:
    """Path of choices -> (mask of all fixed bits, bits left open) at a level."""
    out = {0: (0, list(range(64)))}
    for _ in range(level):
        out = {path * 6 + i: (mask | more, rest) for path, (mask, bits) in out.items()
               for i, (more, rest) in enumerate(_masks(bits))}
    return out


def _keys(fp: Column, path: Column | None, level: int) -> Column:
    """The six keys of a fingerprint at a level, below a path of the level before."""
    def six(p):
        masks = key_masks(level)
        return F.array(*[F.struct(F.lit(p * 6 + i).alias("path"), fp.bitwiseAND(
            F.lit(_signed(masks[p * 6 + i][0])).cast("long")).alias("bits")) for i in range(6)])
    if path is None:
        return six(0)
    out = six(0)
    for p in range(1, 6 ** (level - 1)):
        out = F.when(path == p, six(p)).otherwise(out)
    return out


def _near(group: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint and the smallest one that links within its group reach."""
    table = np.bitwise_count((fp[:, None] ^ PIVOTS[None, :]).view(np.uint64)).astype(np.int8)
    order = np.lexsort((table[:, 0], group))
    group, fp, table = group[order], fp[order], table[order]
    root = np.arange(len(fp))
    pairs = []
    left = np.arange(len(fp))
    step = 0
    while len(left):
        step += 1
        left = left[left + step < len(fp)]
        left = left[group[left] == group[left + step]]
        left = left[table[left + step, 0] - table[left, 0] <= MAX_BITS]
        near = left[np.abs(table[left] - table[left + step]).max(axis=1, initial=0) <= MAX_BITS]
        near = near[np.bitwise_count((fp[near] ^ fp[near + step]).view(np.uint64)) <= MAX_BITS]
        pairs.append(np.stack([near, near + step]))
    a, b = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return fp, fp[root]


def _links(groups: DataFrame) -> DataFrame:
    """Links (a, b) within rows of a list of fingerprints."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                lists = batch.column("fps").slice(start, 2000)
                sizes = np.diff(lists.offsets.to_numpy())
                a, b = _near(np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy())
                far = a != b
                yield pa.RecordBatch.from_arrays([pa.array(a[far]), pa.array(b[far])], ["a", "b"])

    return groups.mapInArrow(run, "a long, b long").distinct()


def near_links(fps: DataFrame, group: int = GROUP) -> DataFrame:
    """Links (a, b) of distinct fingerprints ``fps`` (fp) that connect all that lie
    within MAX_BITS of each other."""
    keyed = fps.select("fp", F.explode(_keys(F.col("fp"), None, 1)).alias("k")).select("fp", "k.*")
    found = None
    for level in (1, 2, 3):
        sizes = save(keyed.groupBy("path", "bits").count().filter("count > 1"), f"simhash-keys-{level}", narrow=True)
        shared = save(keyed.join(sizes, ["path", "bits"]), f"simhash-groups-{level}")
        few = shared if level == 3 else shared.filter(F.col("count") <= group)
        links = _links(few.groupBy("path", "bits").agg(F.collect_list("fp").alias("fps")))
        found = links if found is None else found.union(links)
        dense = shared.filter(F.col("count") > group)
        if level == 3 or dense.isEmpty():
            return found
        keyed = (dense.select("fp", F.explode(_keys(F.col("fp"), F.col("path"), level + 1)).alias("k"))
                 .select("fp", "k.*").distinct())


def classes(docs: DataFrame, fp: str, doc_id: str, group: int = GROUP) -> DataFrame:
    """fp, root (smallest fingerprint reachable) and component_id of every fingerprint."""
    fps = save(docs.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("first")), "simhash-fps", narrow=True)
    roots = components(near_links(fps.select("fp"), group))
    rooted = save(fps.join(roots, fps["fp"] == roots["node"], "left")
                  .select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-roots", narrow=True)
    ids = save(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-components", narrow=True)
    return save(rooted.join(ids, "root").select("fp", "root", "component_id"), "simhash-classes", narrow=True)


def near_duplicates(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, fingerprint and component_id of every row of ``docs``."""
    fp = save(with_fingerprints(docs.select("doc_id", "text"), "fp").select("doc_id", "fp"), "simhash-docs")
    return (fp.join(classes(fp, "fp", "doc_id", group), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, that with the smallest doc_id (of rows that share
    it, the first in the table), with all columns. Texts move once, to meet the
    numbers of the rows that stay."""
    fp, row = fresh(docs, "_fp", "_row")
    saved = save(with_fingerprints(docs, fp).withColumn(row, F.monotonically_increasing_id()), "simhash-texts")
    known = classes(saved, fp, "doc_id")
    ids = saved.select("doc_id", F.col(fp).alias("fp"), F.col(row).alias("row"))
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("row").alias("row"))
    first = save(ids.join(known, "fp").groupBy("root").agg(F.min(order).alias("o"))
                 .select(F.col("o.row").alias(row)), "simhash-keep", narrow=True)
    # a shuffle at every size, where Spark would broadcast the numbers of a small table
    return saved.join(first.hint("merge"), row, "left_semi").select(*docs.columns)
