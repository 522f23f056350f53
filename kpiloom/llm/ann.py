"""Approximate nearest neighbours by an inverted multi-index.

Index. The two halves of the vectors are quantised apart, each with its own k-means
codebook of ``centroids`` entries, fitted on at most ``SAMPLE`` rows (those with the
smallest id hashes); a vector lies in the cell of its pair of centroids. Every row is
indexed. Equal vectors are one entry with its k + 1 smallest ids, as no answer can
hold more of them. Cells are packed into bins of about ``BIN`` entries, and a larger
cell is split over several, so that no group or task grows with a cell.

Search. For each query the pairs of centroids are traversed by rising sum of the two
distances with a heap, until the cells passed hold the share ``reach`` of all entries
(and at least k + 1); the sum reached bounds the query's cells. Blocks of queries meet
the bins that any of them reaches, the entries inside a query's bound are reranked
by their exact distance, and each block and bin passes on at most k + 1 of a query.

``reach`` is what recall costs: the tests and the README state it, measured against
brute force. Vectors of random directions have no near neighbours to speak of and
need a large share; clustered data need far less.

Rows whose id or vector is null, zero, of another length than the most frequent one,
or has null or non-finite components take no part; ties go to the smaller vec_id;
repeated rows (same id and vector) count once; a table without such rows has no answers. Other
columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kpiloom.llm.common import save, settings

SAMPLE = 20_000
TOP_BITS = 12
MAX_CENTROIDS = 64
BIN = 2048
BLOCK = 256
REACH = 0.7


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part."""
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~bad
                 & F.exists("vector", lambda x: x != 0))
    v = v.withColumn("size", F.size("vector"))
    return v


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * x @ c.T, 0)


def codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means centroids of a bounded sample."""
    x = np.unique(x, axis=0)
    k = min(k, len(x))
    c = x[np.random.default_rng(0).choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _distances(x, c).argmin(1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        counts = np.bincount(near, minlength=k)
        c[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return c


def reached(first: np.ndarray, second: np.ndarray, counts: np.ndarray, want: int) -> float:
    """The sum of distances up to which a query's cells hold ``want`` entries: pairs
    are taken from a heap that holds, for each centroid of the first half already
    met, its pair with the next centroid of the second half."""
    a, b = np.argsort(first), np.argsort(second)
    x, y = first[a].tolist(), second[b].tolist()
    n = counts[np.ix_(a, b)].tolist()
    heap, held, bound = [(x[0] + y[0], 0, 0)], 0, 0.0
    while heap and held < want:
        bound, i, j = heapq.heappop(heap)
        held += n[i][j]
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
    return bound


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def sampled(entries: DataFrame, size: int) -> np.ndarray:
    """The vectors of the at most ``SAMPLE`` entries with the smallest id hashes.

    Rows beyond the hash range that holds so many are dropped first, by its top bits'
    counts, and the rest is sorted by a shuffle: a top-k would send ``SAMPLE`` rows of
    every partition to the driver, which grows with the table."""
    drawn = entries.select("vector", F.xxhash64(F.get("ids", F.lit(0))).alias("h"))
    top = F.shiftright("h", 64 - TOP_BITS)
    if size > SAMPLE:
        held = 0
        for row in sorted(drawn.groupBy(top.alias("top")).count().collect()):  # at most 2 ** TOP_BITS rows
            held += row["count"]
            if held >= SAMPLE:
                break
        drawn = drawn.filter(top <= row["top"])
    with settings(entries.sparkSession, {"spark.sql.execution.topKSortFallbackThreshold": "0"}):
        found = drawn.orderBy("h", "vector").limit(SAMPLE).select("vector").toArrow()
    return _matrix(found.column("vector").combine_chunks()) if found.num_rows else np.zeros((0, 0))


class Index:
    """Entries (cell, bin, ids, vector) in a saved table, codebooks and cell sizes."""

    def __init__(self, vectors: DataFrame, k: int, centroids: int | None = None):
        v = save(usable(vectors), "ann-vectors")
        lengths = v.groupBy("size").count().orderBy(F.desc("count"), "size").limit(1).collect()
        self.k, self.dim = k, lengths[0]["size"] if lengths else 0
        self.vectors = v.filter(F.col("size") == self.dim).drop("size")
        if not self.dim:
            return
        rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
        entries = save(self.vectors.distinct().withColumn("r", rank).filter(F.col("r") <= k + 1)
                       .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-entries")
        self.size = entries.count()
        self.cut = self.dim // 2
        x = sampled(entries, self.size)
        n = centroids or min(MAX_CENTROIDS, max(4, math.ceil(math.sqrt(self.size / 16))))
        self.books = codebook(x[:, :self.cut], n), codebook(x[:, self.cut:], n)
        self.width = len(self.books[1])
        cells = save(self._with_cells(entries), "ann-cells")
        self.counts = np.zeros(len(self.books[0]) * self.width, np.int64)
        for row in cells.groupBy("cell").count().collect():  # at most MAX_CENTROIDS ** 2 rows
            self.counts[row["cell"]] = row["count"]
        first, parts = self._bins()
        # both lists have one number a cell
        part = F.pmod(F.xxhash64("vector"), F.get(F.lit(parts.tolist()), "cell").cast("long"))
        self.entries = cells.withColumn("bin", F.get(F.lit(first.tolist()), "cell") + part)

    def _with_cells(self, entries: DataFrame) -> DataFrame:
        books, cut, width = self.books, self.cut, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = _matrix(batch.column("vector"))
                    cell = (_distances(x[:, :cut], books[0]).argmin(1) * width
                            + _distances(x[:, cut:], books[1]).argmin(1))
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())],
                                                     ["vector", "ids", "cell"])

        return entries.select("vector", "ids").mapInArrow(run, "vector array<double>, ids array<long>, cell int")

    def _bins(self) -> tuple[np.ndarray, np.ndarray]:
        """For each cell its first bin and over how many bins it is split."""
        parts = np.maximum(1, -(-self.counts // BIN))
        first, at, room = np.zeros(len(parts), np.int64), -1, 0
        for c, n in enumerate(self.counts.tolist()):
            if parts[c] > 1:
                first[c], at, room = at + 1, at + parts[c], 0
            else:
                if at < 0 or n > room:
                    at, room = at + 1, BIN
                first[c], room = at, room - n
        return first, parts

    def search(self, queries: DataFrame, reach: float = REACH) -> DataFrame:
        """query_id, rank, vec_id and score of the k nearest found to each query row
        (vec_id, vector) other than itself."""
        k, cut, width, books, counts = self.k, self.cut, self.width, self.books, self.counts
        want = max(k + 1, math.ceil(reach * self.size))
        first, parts = self._bins()
        grid = counts.reshape(-1, width)

        def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _matrix(batch.column("vector"))
                a, b = _distances(x[:, :cut], books[0]), _distances(x[:, cut:], books[1])
                bound = np.array([reached(p, q, grid, want) for p, q in zip(a, b)])
                bins = []
                for p, q, r in zip(a, b, bound):
                    cells = np.flatnonzero(((p[:, None] + q[None, :]) <= r).ravel() & (counts > 0))
                    bins.append(np.unique(np.concatenate([np.arange(first[c], first[c] + parts[c]) for c in cells])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("vector"), pa.array(bound),
                     pa.array(bins, pa.list_(pa.int64()))], ["vec_id", "vector", "bound", "bins"])

        n = queries.count()
        asked = queries.repartition("vec_id").mapInArrow(bounds, "vec_id long, vector array<double>, bound double, bins array<long>")
        block = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-n // BLOCK))).cast("long"))
        blocks = save(asked.groupBy(block.alias("block")).agg(
            F.collect_list(F.struct("vec_id", "vector", "bound")).alias("queries"),
            F.array_distinct(F.flatten(F.collect_list("bins"))).alias("bins")), "ann-queries")
        bins = save(self.entries.groupBy("bin").agg(
            F.collect_list(F.struct("vector", "ids", "cell")).alias("entries")), "ann-bins")
        # a block goes to each of its bins: its size as saved says nothing of that, and a
        # broadcast decided by it would pass all of these copies through the driver
        pairs = (blocks.select("queries", F.explode("bins").alias("bin")).join(bins.hint("merge"), "bin")
                 .select("queries", "entries"))

        def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    q, e = (batch.column(c).slice(row, 1).flatten() for c in ("queries", "entries"))
                    x, y = _matrix(q.field("vector")), _matrix(e.field("vector"))
                    cell = e.field("cell").to_numpy()
                    near = (_distances(x[:, :cut], books[0])[:, cell // width]
                            + _distances(x[:, cut:], books[1])[:, cell % width]) <= q.field("bound").to_numpy()[:, None]
                    guess = np.where(near, _distances(x, y), np.inf)
                    ids, own = e.field("ids").to_pylist(), q.field("vec_id").to_pylist()
                    out: list[list] = [[], [], []]
                    for i, query in enumerate(own):
                        some = np.flatnonzero(near[i])
                        if len(some) > k + 1:  # by product form, with room for its rounding
                            edge = np.partition(guess[i][some], k)[k]
                            some = some[guess[i][some] <= edge + 1e-9 * (1 + edge)]
                        found = [(d, v) for d, j in zip(np.sqrt(((y[some] - x[i]) ** 2).sum(1)).tolist(), some.tolist())
                                 for v in ids[j] if v != query]
                        for d, v in sorted(found)[:k]:
                            out[0].append(query)
                            out[1].append(v)
                            out[2].append(d)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                        ["query_id", "vec_id", "score"])

        found = pairs.mapInArrow(rerank, "query_id long, vec_id long, score double").distinct()
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
        return (found.withColumn("rank", rank).filter(F.col("rank") <= k)
                .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def nearest(spark: SparkSession, vectors: DataFrame, every: int = 100, k: int = 10,
            reach: float = REACH) -> DataFrame:
    """The k nearest found to every row whose vec_id is divisible by ``every``."""
    index = Index(vectors, k)
    if not index.dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = save(index.vectors.filter(F.col("vec_id") % every == 0).distinct(), "ann-asked")
    return index.search(queries, reach)
