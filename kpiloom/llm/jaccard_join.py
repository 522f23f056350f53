"""Jaccard join of word shingle sets, with skips that set relations allow.

A document's set holds its distinct ``SHINGLE``-word shingles (lower-cased A-Z; a shorter
text is one shingle, a text without words has an empty set, linked with nothing). Two
sets link if 100 * |x & y| >= percent * |x | y|; a component is all that links reach.
Equal sets are one set from the start.

Index lists. All sets are ordered alike, rare shingles first: by the size of a shingle's
bucket in a table of 2**BUCKET_BITS counts over the whole corpus, then by hash. Linked
sets share a shingle among the first n - ceil(percent * n / 100) + 1 of each, so lists of
these shingles' sets, with the shingle's position, hold every pair. A shingle whose
bucket is far larger than the mean is split by set over several lists.

Skipping in lists. A list's entries stand in blocks by set size, by position within a
block. Two blocks of sizes n and m need an overlap of o; at their first common shingle
no more than n - p and m - q are left from positions p and q, so only the heads up to
n - o and m - o meet, and the rest of both blocks is skipped unseen. Of pairs left, parity
signatures of some 2 to 4 bits a shingle bound the symmetric difference from below: in
lists folded to 2**SHORT_BITS bits, as a set is in many of them, and whole afterwards.

Answers from similar sets. Each set is first compared with one leader: of the sets that
head its lists that which most name, if size and signature leave a link possible. If
they differ by half the set or less, the two differences are kept: with them the
leader's answers give the set's: |x & y| = |L & y| - |(L - x) & y| + |(x - L) & y|, with
|L & y| computed once for all followers of a leader that meet y. Linked sets and leaders
form components, and lists whose sets all are in one component are dropped whole. In
other lists, in pieces of at most ``LIST`` sets, each set is compared with the nearest by
signature of another component, in ``ROUNDS`` rounds; at last with every set of another component that the skips leave. So a group of near
copies costs a few comparisons a set, and no list emits its pairs within a component.

Shingles and sets are compared by 64-bit hashes. Null and empty texts have empty sets;
repeated rows are linked as any equal sets; a null doc_id never names a component unless
no row of it has one; texts of any length are worked on whole; an empty table gives no
rows; other columns of ``docs`` are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from kpiloom.llm.common import discard, find_words, lower, mix, save, slices, text_bytes, word_hashes
from kpiloom.llm.components import components

SHINGLE = 5
PERCENT = 80
BUCKET_BITS = 20
BUCKET_RANGES = 16
LIST = 4096
SMALL_CELL = 64  # sets of a piece that is compared together with others
SIGNATURE_BITS = 8, 15  # powers of two: the least and the most bits of a signature,
SHORT_BITS = 9  # and the most of those that lists carry
FILTER_BITS = 28  # of the table of sets whose shingles are wanted, at most
FOLLOWERS = 64  # answered in one row
ROUNDS = 1
_STEP = np.uint64(0x9E3779B97F4A7C15)


def least_overlap(n, m, percent: int):
    """The least common shingles of linked sets of n and m."""
    return -(-(percent * (n + m)) // (100 + percent))


def prefix_length(n, percent: int):
    return n - -(-(percent * n) // 100) + 1


def shingles_of(column: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's shingles, one text after the other, and each text's number of them."""
    data, offsets = text_bytes(column)
    data = lower(data)
    starts, ends, first = find_words(data, offsets)
    words = word_hashes(data, starts, ends)
    n = np.diff(first)
    each = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    upto = np.append(0, np.cumsum(each))
    at = np.repeat(first[:-1] - upto[:-1], each) + np.arange(upto[-1])
    width = np.minimum(n, shingle)
    own = np.repeat(width, each)
    h = words[at]
    for k in range(1, shingle):  # a text with fewer words is one narrower shingle
        wide = own > k
        if wide.all():
            h = mix(h * _STEP + words[at + k])
        else:
            h[wide] = mix(h[wide] * _STEP + words[at[wide] + k])
    return h + np.repeat((shingle - width).astype(np.uint64), each), each


def shingle_sets(column: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, one text after the other; and each text's number of them."""
    h, each = shingles_of(column, shingle)
    at = np.append(0, np.cumsum(each))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[at[:-1][each > 0]] = True
    return h[new], np.add.reduceat(np.append(new, False), at[:-1], dtype=np.int64) * (each > 0)


def signature_bits(size: np.ndarray, most: int = SIGNATURE_BITS[1]) -> np.ndarray:
    """Bits of the signature of sets of ``size``: the power of two from twice the size on."""
    return 1 << np.clip(np.frexp(np.maximum(2 * size - 1, 1))[1], SIGNATURE_BITS[0], most).astype(np.int64)


def parities(h: np.ndarray, text: np.ndarray, sizes: np.ndarray, most: int) -> list[bytes]:
    """Each text's signature: for every bit whether an odd number of its shingles fall there."""
    bits = signature_bits(sizes, most)
    begin = np.append(0, np.cumsum(bits))
    place = begin[text] + (mix(h) & (bits[text] - 1).astype(np.uint64)).astype(np.int64)
    marks = np.packbits((np.bincount(place, minlength=begin[-1]) & 1).astype(np.uint8)).tobytes()
    return [marks[a // 8:b // 8] for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]


def _folded(marks: np.ndarray, words: int) -> np.ndarray:
    """Signatures (rows) as those of fewer bits."""
    return np.bitwise_xor.reduce(marks.reshape(len(marks), -1, words), axis=1)


def apart(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """At most what only one of both sets has, for rows of signatures, each side of a width."""
    words = min(s.shape[1], t.shape[1])
    return np.bitwise_count(_folded(s, words) ^ _folded(t, words)).sum(axis=1, dtype=np.int64)


def bucket_ranks(docs: DataFrame, shingle: int) -> tuple[np.ndarray, int]:
    """log2 of the count of shingles in each bucket, one byte each, and of the mean count."""
    size = (1 << BUCKET_BITS) // BUCKET_RANGES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for part in (p for b in batches for p in slices(b, "text")):
            h, _ = shingles_of(part.column("text"), shingle)
            total += np.bincount((h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=1 << BUCKET_BITS)
        found = [at for at in range(BUCKET_RANGES) if total[at * size:(at + 1) * size].any()]
        planes = [np.ascontiguousarray(total[at * size:(at + 1) * size].view(np.uint8).reshape(-1, 8).T) for at in found]
        yield pa.RecordBatch.from_pydict({
            "at": pa.array(found, pa.int32()), "counts": pa.array([zlib.compress(p.tobytes(), 1) for p in planes], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, counts in zip(batch.column("at").to_pylist(), batch.column("counts")):
                planes = np.frombuffer(zlib.decompress(counts.as_py()), np.uint8).reshape(8, -1)
                sums[at] = sums.get(at, 0) + np.ascontiguousarray(planes.T).view(np.int64)[:, 0]
        for at, total in sums.items():
            yield pa.RecordBatch.from_pydict({
                "at": pa.array([at], pa.int32()), "total": pa.array([int(total.sum())], pa.int64()),
                "ranks": pa.array([np.frexp(total)[1].astype(np.uint8).tobytes()], pa.binary())})

    ranks, shingles = np.zeros(1 << BUCKET_BITS, np.uint8), 0
    parts = docs.select("text").mapInArrow(count, "at int, counts binary").repartition(BUCKET_RANGES, "at")
    for r in parts.mapInArrow(add, "at int, total long, ranks binary").collect():  # BUCKET_RANGES rows at most
        ranks[r["at"] * size:(r["at"] + 1) * size] = np.frombuffer(r["ranks"], np.uint8)
        shingles += r["total"]
    return ranks, (shingles >> BUCKET_BITS).bit_length()


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))


def sets(docs: DataFrame, ranks: np.ndarray, percent: int, shingle: int) -> DataFrame:
    """doc_id, key (of the row's contents), row, sid (hash of the set), size, signature, prefix
    and the ranks of its shingles, of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # 2**BUCKET_BITS bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, row = shared.value, TaskContext.get().partitionId() << 40
        for part in (p for b in batches for p in slices(b, "text")):
            h, sizes = shingle_sets(part.column("text"), shingle)
            at = np.append(0, np.cumsum(sizes))
            text = np.repeat(np.arange(len(sizes)), sizes)
            signatures, short = (parities(h, text, sizes, most) for most in (SIGNATURE_BITS[1], SHORT_BITS))
            rank = table[(h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
            keys = [xxhash.xxh3_64_intdigest(h[a:b].tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            place = rank.astype(np.uint64) << np.uint64(58) | h >> np.uint64(6)  # by rank, then by hash
            length = np.where(sizes > 0, prefix_length(sizes, percent), 0)
            upto = np.append(0, np.cumsum(length))
            chosen = np.zeros(upto[-1], np.int64)
            for a, b, c, n in zip(at[:-1].tolist(), at[1:].tolist(), upto.tolist(), length.tolist()):
                chosen[c:c + n] = a + np.argsort(place[a:b], kind="stable")[:n]
            lists = lambda values: pa.ListArray.from_arrays(pa.array(upto, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("key"), pa.array(row + np.arange(len(sizes))), pa.array(np.array(keys, np.uint64).view(np.int64)),
                pa.array(sizes), 
                pa.array(signatures, pa.binary()), pa.array(short, pa.binary()),
                lists(pa.array(h[chosen].view(np.int64))), lists(pa.array(rank[chosen].view(np.int8)))],
                ["doc_id", "key", "row", "sid", "size", "signature", "short", "prefix", "rank"])
            row += len(sizes)

    return _keyed(docs).mapInArrow(
        run, "doc_id long, key long, row long, sid long, size long, signature binary, short binary, prefix array<long>, rank array<tinyint>")


def shared_lists(own: DataFrame, mean: int) -> DataFrame:
    """token, pos, sid, size and leader of the entries of lists with several sets. ``own``: a
    row (sid, size, prefix, rank) for each distinct set."""
    entry = own.select("sid", F.col("size").cast("int").alias("size"), F.posexplode(F.arrays_zip("prefix", "rank")).alias("pos", "e"))
    # a bucket of 16 times the mean or more: a list for each such share
    hot = F.greatest(F.col("e.rank") - F.lit(mean + 4), F.lit(0)).cast("int")
    entry = entry.withColumn("hot", hot).select(
        F.col("e.prefix").alias("token"), F.expr("CAST(pmod(xxhash64(sid), shiftleft(1L, hot)) AS INT)").alias("part"),
        "pos", "sid", "size", (F.col("hot") > 0).alias("split"))
    names = ["token", "pos", "sid", "size", "leader"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, leader, goes_on = None, 0, False  # the last row seen, its list's first set, if that is another row
        for batch in batches:
            if not batch.num_rows:
                continue
            row = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("token", "part", "pos", "sid", "size", "split")]
            if held is not None:
                row = [np.append(h, x) for h, x in zip(held, row)]
            token, part, pos, sid, size, split = row
            same = (token[1:] == token[:-1]) & (part[1:] == part[:-1])  # as the row before
            begins = np.append(not goes_on, ~same)
            first = np.maximum.accumulate(np.where(begins, np.arange(len(token)), -1))
            heads = np.where(first >= 0, sid[first], leader)
            keep = split | ~begins | np.append(same, False)
            keep[-1] = False  # decided with the next row
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (token, pos, sid, size, heads)], names)
            held, leader, goes_on = [x[-1:] for x in row], heads[-1], not begins[-1]
        if held is not None and (goes_on or held[5][0]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (held[0], held[2], held[3], held[4], np.array([leader], np.int64))], names)

    by_list = entry.repartition("token", "part").sortWithinPartitions("token", "part", "sid")
    return by_list.mapInArrow(run, "token long, pos int, sid long, size int, leader long")


def _bit_table(keys: DataFrame) -> tuple[np.ndarray, int]:
    """A table of one bit for each bucket of the column ``key``, and the bits of its size."""
    bits = min(max((8 * keys.count()).bit_length(), 12), FILTER_BITS)
    ranges = 16
    size = (1 << bits) // ranges

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, np.ndarray] = {}
        for batch in batches:
            bucket = (batch.column("key").to_numpy().view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
            for at in np.unique(bucket // size).tolist():
                tables.setdefault(at, np.zeros(size, bool))[bucket[bucket // size == at] % size] = True
        for at, table in tables.items():
            yield pa.RecordBatch.from_pydict({"at": pa.array([at], pa.int32()), "bits": pa.array([np.packbits(table).tobytes()], pa.binary())})

    out = np.zeros((1 << bits) // 8, np.uint8)
    spread = keys.select("key").repartition(ranges, F.shiftrightunsigned("key", 60))
    for r in spread.mapInArrow(mark, "at int, bits binary").collect():  # `ranges` rows, 2**FILTER_BITS bits at most
        out[r["at"] * size // 8:(r["at"] + 1) * size // 8] |= np.frombuffer(r["bits"], np.uint8)
    return out, bits


def bodies(docs: DataFrame, sids: DataFrame, known: DataFrame) -> DataFrame:
    """sid and body (a text that has the set, compressed: smaller than its shingles' hashes)
    of each of ``sids``, from the rows that stand for them (``known``: sid, key)."""
    wanted = save(known.join(sids, "sid").select("sid", "key"), "jaccard-wanted", narrow=True)
    table, bits = _bit_table(wanted)
    shared = docs.sparkSession.sparkContext.broadcast(table)  # 2**FILTER_BITS bits at most

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor().compress
        for part in (p for b in batches for p in slices(b, "text")):
            bucket = part.column("key").to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            hit = shared.value[(bucket >> np.uint64(3)).astype(np.int64)] << (bucket & np.uint64(7)).astype(np.uint8) & 128
            some = part.filter(pa.array(hit.astype(bool)))
            texts = some.column("text").cast(pa.large_binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([some.column("key"), pa.array([pack(t or b"") for t in texts], pa.binary())],
                                             ["key", "body"])

    picked = _keyed(docs).mapInArrow(pick, "key long, body binary").groupBy("key").agg(F.first("body").alias("body"))
    return picked.join(wanted, "key").select("sid", "body")


def _sets_of(column: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """The sets of bodies, about a slice of texts at a time."""
    unpack = zstandard.ZstdDecompressor().decompress
    for start in range(0, len(column), 64):
        texts = pa.array([unpack(b) for b in column.slice(start, 64).to_pylist()], pa.large_binary())
        h, sizes = shingle_sets(texts, shingle)
        at = np.append(0, np.cumsum(sizes)).tolist()
        yield from (h[a:b] for a, b in zip(at[:-1], at[1:]))


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which items of a are in b; both sorted and distinct."""
    if not len(b):
        return np.zeros(len(a), bool)
    return b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a


def _links(o, n, m, percent: int):
    return 100 * o >= percent * (n + m - o)


def leaders(lists: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """sid and leader: of the sets that head its lists that which most of them name, if
    both may be linked by size and signature."""
    named = lists.filter("sid <> leader").groupBy("sid", "leader").agg(F.count("*").alias("c"))
    named = named.groupBy("sid").agg(F.max_by("leader", F.struct("c", "leader")).alias("leader"))
    of = lambda key, s, n: known.select(F.col("sid").alias(key), F.col("signature").alias(s), F.col("size").alias(n))
    both = named.join(of("sid", "s", "size"), "sid").join(of("leader", "t", "m"), "leader")
    return both.mapInArrow(_may_link(percent, "sid", "leader"), "sid long, leader long")


def likely(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y, cx, cy) that whole signatures leave."""
    of = lambda key, s, n: known.select(F.col("sid").alias(key), F.col("signature").alias(s), F.col("size").alias(n))
    both = pairs.join(of("x", "s", "size"), "x").join(of("y", "t", "m"), "y")
    return both.mapInArrow(_may_link(percent, "x", "y", "cx", "cy"), "x long, y long, cx long, cy long")


def _may_link(percent: int, *columns: str):
    """Keeps rows whose sets may be linked by signatures s and t and sizes size and m."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = lambda c: [np.frombuffer(x, np.uint64)[None] for x in batch.column(c).to_pylist()]
        for batch in batches:
            far = np.fromiter((apart(s, t)[0] for s, t in zip(rows("s"), rows("t"))), np.int64, batch.num_rows)
            n, m = (batch.column(c).to_numpy().astype(np.int64) for c in ("size", "m"))
            yield batch.select(list(columns)).filter(pa.array(far <= most_apart(n, m, percent)))

    return run


def most_apart(n, m, percent: int):
    """The most that only one of two linked sets of n and m has."""
    return n + m - 2 * least_overlap(n, m, percent)


def follow(texts: DataFrame, best: DataFrame, percent: int, shingle: int) -> DataFrame:
    """sid, leader, linked, minus and plus (the leader's shingles that the set lacks, and the set's own)
    of every set that differs from its leader by at most half its size."""
    pairs = best.join(texts, "sid").join(texts.select(F.col("sid").alias("leader"), F.col("body").alias("base")), "leader")
    names = ["sid", "leader", "linked", "minus", "plus"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for sid, leader, x, base in zip(batch.column("sid").to_pylist(), batch.column("leader").to_pylist(),
                                            _sets_of(batch.column("body"), shingle), _sets_of(batch.column("base"), shingle)):
                both = _common(x, base)
                o = int(both.sum())
                if 2 * (len(x) + len(base) - 2 * o) > len(x):
                    continue
                for column, v in zip(out, (sid, leader, bool(_links(o, len(x), len(base), percent)),
                                           base[~_common(base, x)].tobytes(), x[~both].tobytes())):
                    column.append(v)
            kinds = pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    return pairs.select("sid", "leader", "body", "base").mapInArrow(
        run, "sid long, leader long, linked boolean, minus binary, plus binary")


def block_pairs(size: np.ndarray, pos: np.ndarray, percent: int,
                most: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Pairs of places in a list that skips leave: two sizes, and heads of their blocks
    against each other, about ``most`` pairs at a time."""
    order = np.lexsort((pos, size))
    sizes, starts = np.unique(size[order], return_index=True)
    stops = np.append(starts[1:], len(order))
    blocks = list(zip(sizes.tolist(), starts.tolist(), stops.tolist()))
    for i, (n, a, b) in enumerate(blocks):
        for m, c, d in blocks[i:]:
            if 100 * n < percent * m:
                break
            need = least_overlap(n, m, percent)
            left = order[a:a + np.searchsorted(pos[order[a:b]], n - need, "right")]
            right = order[c:c + np.searchsorted(pos[order[c:d]], m - need, "right")]
            step = max(1, most // max(1, len(right)))
            for k in range(0, len(left), step) if len(right) else ():
                x, y = np.repeat(left[k:k + step], len(right)), np.tile(right, len(left[k:k + step]))
                own = x != y if n != m else x < y
                yield n, m, x[own], y[own]


def _cell_pairs(size: np.ndarray, pos: np.ndarray, comp: np.ndarray, part: np.ndarray, marks: list[bytes], across: bool,
                percent: int, nearest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places x, y of pairs of different components in a cell that signatures leave; only
    each set's ``nearest`` if so asked. ``across``: pairs of different parts only."""
    found = [(np.zeros(0, np.int64),) * 3]
    wide = max(map(len, marks)) // 8
    best = np.full(len(size), np.inf)
    partner = np.full(len(size), -1)
    matrix: dict[int, np.ndarray] = {}  # signatures of a size, by place
    row = np.zeros(len(size), np.int64)
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        row[at] = np.arange(len(at))
        matrix[n] = np.frombuffer(b"".join([marks[i] for i in at.tolist()]), np.uint64).reshape(len(at), -1)
    for n, m, x, y in block_pairs(size, pos, percent, max(1 << 10, (1 << 20) // wide)):
        own = comp[x] != comp[y]
        if across:
            own &= part[x] != part[y]
        x, y = x[own], y[own]
        if not len(x):
            continue
        far = apart(matrix[n][row[x]], matrix[m][row[y]])
        near = far <= most_apart(n, m, percent)
        x, y, share = x[near], y[near], far[near] / most_apart(n, m, percent) if most_apart(n, m, percent) else far[near] * 0.0
        if not nearest:
            found.append((x, y, share))
            continue
        for a, b in ((x, y), (y, x)):
            order = np.lexsort((share, a))
            first = order[np.append(True, a[order][1:] != a[order][:-1])[:len(order)]]
            first = first[share[first] < best[a[first]]]
            best[a[first]], partner[a[first]] = share[first], b[first]
    if nearest:
        x = np.flatnonzero(partner >= 0)
        return x, partner[x]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _small_cells(cell: np.ndarray, size: np.ndarray, pos: np.ndarray, comp: np.ndarray, part: np.ndarray,
                 across: np.ndarray, marks: list[bytes], percent: int) -> tuple[np.ndarray, ...]:
    """The same pairs (x, y and how near they are) of many small cells at once, whose
    entries stand together: neighbours at distance 1, 2 and so on."""
    wide = np.array([len(m) for m in marks]) // 8
    row, matrix = np.zeros(len(wide), np.int64), {}
    for w in np.unique(wide).tolist():
        at = np.flatnonzero(wide == w)
        row[at] = np.arange(len(at))
        matrix[w] = np.frombuffer(b"".join([marks[i] for i in at.tolist()]), np.uint64).reshape(-1, w)
    found, step = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], 0
    while True:
        step += 1
        x = np.flatnonzero(cell[:-step] == cell[step:]) if step < len(cell) else np.zeros(0, np.int64)
        if not len(x):
            return tuple(np.concatenate(c) for c in zip(*found))
        y = x + step
        n, m = size[x], size[y]
        need = least_overlap(n, m, percent)
        good = (comp[x] != comp[y]) & (pos[x] <= n - need) & (pos[y] <= m - need) & (
            100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (~across[x] | (part[x] != part[y]))
        x, y = x[good], y[good]
        for w in matrix:
            for v in matrix:
                own = (wide[x] == w) & (wide[y] == v)
                if own.any():
                    i, j = x[own], y[own]
                    far, most = apart(matrix[w][row[i]], matrix[v][row[j]]), most_apart(size[i], size[j], percent)
                    near = far <= most
                    found.append((i[near], j[near], far[near] / np.maximum(most[near], 1)))


def _nearest(x: np.ndarray, y: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of all pairs of a place, with either end, the nearest."""
    a, b, s = np.concatenate([x, y]), np.concatenate([y, x]), np.concatenate([share, share])
    order = np.lexsort((s, a))
    first = order[np.append(True, a[order][1:] != a[order][:-1])[:len(order)]]
    return a[first], b[first]


def open_pairs(lists: DataFrame, comps: DataFrame, signatures: DataFrame, percent: int, limit: int,
               nearest: bool = False) -> DataFrame:
    """x, y, cx, cy: pairs of sets of different components that lists leave to be compared;
    of each set in a list only the ``nearest`` of another component if so asked."""
    named = save(lists.select("token", "pos", "sid", "size").join(comps, "sid"), "jaccard-named", narrow=True)
    sizes = named.groupBy("token").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.count("*").alias("m"))
    sizes = save(sizes.filter("a < b").select("token", F.ceil(F.col("m") / limit).cast("int").alias("cells")), "jaccard-open", narrow=True)
    entry = save(named.join(sizes, "token"), "jaccard-entries", narrow=True).join(signatures, "sid")
    part = F.expr("CAST(pmod(xxhash64(sid), cells) AS INT)")
    dealt = entry.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))).select(
        "token", F.least("part", "other").alias("g"), F.greatest("part", "other").alias("h"),
        F.struct("sid", "comp", "size", "pos", "part", "signature").alias("e"))
    cells = dealt.groupBy("token", "g", "h").agg(F.collect_list("e").alias("es"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("es")
            at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            items = lists.flatten()
            sid, comp, size, pos, part = (items.field(c).to_numpy() for c in ("sid", "comp", "size", "pos", "part"))
            marks = items.field("signature")
            across = batch.column("g").to_numpy() != batch.column("h").to_numpy()
            out: list[tuple] = [(np.zeros(0, np.int64),) * 4]

            def add(x: np.ndarray, y: np.ndarray) -> None:
                swap = sid[x] > sid[y]
                x, y = np.where(swap, y, x), np.where(swap, x, y)
                out.append((sid[x], sid[y], comp[x], comp[y]))

            length = np.diff(at)
            cell = np.repeat(np.arange(len(length)), length)
            size, pos = size.astype(np.int64), pos.astype(np.int64)
            small = np.flatnonzero(length[cell] <= SMALL_CELL)
            for k in range(0, len(small), 1 << 16):
                # cut at a cell's begin: the last one of a slice is left to the next
                some = small[k:k + (1 << 16) + SMALL_CELL]
                first_cell = cell[small[k - 1]] if k else -1
                last_cell = cell[small[k + (1 << 16) - 1]] if k + (1 << 16) <= len(small) else len(length)
                some = some[(cell[some] > first_cell) & (cell[some] <= last_cell)]
                x, y, share = _small_cells(cell[some], size[some], pos[some], comp[some], part[some], across[cell[some]],
                                           marks.take(pa.array(some)).to_pylist(), percent)
                if nearest:
                    x, y = _nearest(x, y, share)
                add(some[x], some[y])
            for i in np.flatnonzero(length > SMALL_CELL).tolist():
                a, b = at[i], at[i + 1]
                x, y = _cell_pairs(size[a:b], pos[a:b], comp[a:b], part[a:b], marks.slice(a, b - a).to_pylist(),
                                   bool(across[i]), percent, nearest)
                add(x + a, y + a)
            rows = np.unique(np.stack([np.concatenate(c) for c in zip(*out)], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], ["x", "y", "cx", "cy"])

    return cells.mapInArrow(run, "x long, y long, cx long, cy long").distinct()


def answers(pairs: DataFrame, texts: DataFrame, followers: DataFrame, percent: int, shingle: int) -> DataFrame:
    """a and b (components) of the pairs that link, answered from the leaders' answers."""
    empty = F.lit(b"")
    # x without a leader leads itself; whatever meets y through one leader is answered together
    led = pairs.join(followers.select(F.col("sid").alias("x"), "leader", "minus", "plus"), "x", "left").select(
        "y", F.coalesce("leader", "x").alias("leader"), F.struct(
            "cx", "cy", F.coalesce("minus", empty).alias("minus"), F.coalesce("plus", empty).alias("plus")).alias("f"),
        F.xxhash64("x").alias("deal"))
    many = save(led, "jaccard-led", narrow=True)
    cells = many.groupBy("y", "leader").agg(F.ceil(F.count("*") / FOLLOWERS).alias("cells"))
    grouped = many.join(cells, ["y", "leader"]).groupBy(
        "y", "leader", F.expr("pmod(deal, cells)").alias("cell")).agg(F.collect_list("f").alias("fs"))
    rows = save(grouped.select("y", "leader", "fs"), "jaccard-grouped")
    rows = rows.join(texts.select(F.col("sid").alias("y"), "body"), "y").join(
        texts.select(F.col("sid").alias("leader"), F.col("body").alias("base")), "leader")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: set[tuple[int, int]] = set()
            for y, base, followers in zip(_sets_of(batch.column("body"), shingle), _sets_of(batch.column("base"), shingle),
                                          batch.column("fs").to_pylist()):
                common = int(_common(base, y).sum())
                for f in followers:
                    minus, plus = np.frombuffer(f["minus"], np.uint64), np.frombuffer(f["plus"], np.uint64)
                    o = common - int(_common(minus, y).sum()) + int(_common(plus, y).sum())
                    if _links(o, len(base) - len(minus) + len(plus), len(y), percent):
                        out.add((min(f["cx"], f["cy"]), max(f["cx"], f["cy"])))
            a, b = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.select("body", "base", "fs").mapInArrow(run, "a long, b long").distinct()


def components_of(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, limit: int = LIST) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach) of every
    row of ``docs`` (doc_id, text)."""
    ranks, mean = bucket_ranks(docs, shingle)
    made = save(sets(docs, ranks, percent, shingle), "jaccard-sets")
    known = save(made.filter("size > 0").groupBy("sid").agg(
        F.min("row").alias("row"), F.min("doc_id").alias("first"), F.first("signature").alias("signature"), F.first("short").alias("short"),
        F.first("size").alias("size"), F.min("key").alias("key")), "jaccard-known", narrow=True)
    own = made.select("row", "sid", "size", "prefix", "rank").join(known.select("row"), "row", "left_semi")
    lists = save(shared_lists(own, mean), "jaccard-lists")
    rows = save(made.select("doc_id", "sid", F.col("size").alias("n_shingles")), "jaccard-rows", narrow=True)
    discard(made)
    best = save(leaders(lists, known, percent), "jaccard-best", narrow=True)
    texts = save(bodies(docs, best.select("sid").union(best.select("leader")).distinct(), known), "jaccard-texts")
    followers = save(follow(texts, best, percent, shingle), "jaccard-followers")
    linked = components(followers.filter("linked").select(F.col("sid").alias("a"), F.col("leader").alias("b")))

    def labelled(comps: DataFrame, merged: DataFrame) -> DataFrame:
        top = merged.select(F.col("node").alias("comp"), F.col("root").alias("top"))
        return save(comps.join(top, "comp", "left").select("sid", F.coalesce("top", "comp").alias("comp")), "jaccard-components", narrow=True)

    comps = labelled(known.select("sid", F.col("sid").alias("comp")), linked)
    short = known.select("sid", F.col("short").alias("signature"))
    for left in range(ROUNDS, -1, -1):  # the last round, with all pairs, is always run
        found = save(open_pairs(lists, comps, short, percent, limit, nearest=left > 0), "jaccard-found")
        pairs = save(likely(found, known, percent), "jaccard-pairs")
        discard(found)
        sids = pairs.select(F.col("x").alias("sid")).union(pairs.select("y")).distinct()
        more = save(bodies(docs, sids.join(texts, "sid", "left_anti"), known), "jaccard-more-texts")
        texts = texts.unionByName(more.join(texts, "sid", "left_anti"))
        links = save(answers(pairs, texts, followers, percent, shingle), "jaccard-answers")
        comps = labelled(comps, components(links))
    discard(lists)
    roots = comps.join(known.select("sid", "first"), "sid").select("sid", "first", F.col("comp").alias("root"))
    roots = save(roots, "jaccard-roots", narrow=True)
    ids = save(roots.groupBy("root").agg(F.min("first").alias("component_id")), "jaccard-ids", narrow=True)
    classes = save(roots.join(ids, "root").select("sid", "component_id"), "jaccard-classes", narrow=True)
    linked = rows.filter("n_shingles > 0").join(classes, "sid").select("doc_id", "n_shingles", "component_id")
    return linked.unionByName(rows.filter("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
