"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Statistics of each whole text (lengths, shares of character kinds, repetition) are
standardised by the training rows and mapped to ``FEATURES`` random Fourier features,
whose inner products approximate a Gaussian kernel of the statistics. Every task
adds up the normal equations of its training rows; the sums meet by matrix row, so
that no task or the driver holds more than one matrix. The ridge solution scores a
text, and an isotonic map, fitted to the labels of a quarter of the training rows
that the equations leave out, turns scores into probabilities: their scores fall in
``STEPS`` equal steps, and adjacent violators are pooled over the counts of these.

Beyond ``SAMPLE`` labelled rows the fit uses about so many, drawn by a hash of the id;
statistics and scores cover all rows. Labels, language, source and id are never
inputs. Null and empty texts have zero statistics and a score like any other; a
null doc_id or quality does not train; several labels of one document count as 1
only if all are; repeated rows are scored each; without labels of both kinds all
scores are the share of good labels (0.5 without any). A text of any length is counted
whole; an empty table gives no rows; other columns are not looked at. The steps run from
the lowest to the highest ridge score of the fitted rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kpiloom.llm.common import find_words, save, slices, text_bytes, word_hashes

SAMPLE = 200_000
FEATURES = 256
STEPS = 1000
RIDGE = 1e-3
STATS = ("log_words", "mean_word", "upper", "digit", "punct", "symbol", "bang", "pipe", "high", "space",
         "line_words", "dup_lines", "distinct_words", "top_word", "repeat_trigrams", "short_words",
         "long_words", "stop_marks")

_KINDS = np.zeros((10, 256), bool)
_KINDS[0, 65:91] = True
_KINDS[1, 48:58] = True
_KINDS[2, [ord(c) for c in ".,;:?'\"()-"]] = True
_KINDS[3, [ord(c) for c in "#$%&*<>@^_=+~/\\{}[]"]] = True
_KINDS[4, ord("!")] = True
_KINDS[5, ord("|")] = True
_KINDS[6, 128:] = True
_KINDS[7, [32, 9, 10, 11, 12, 13]] = True
_KINDS[8, ord("\n")] = True
_KINDS[9, [ord(c) for c in ".!?"]] = True


def _share_repeated(values: np.ndarray) -> tuple[float, float]:
    """Shares of distinct values and of the most frequent one."""
    if not len(values):
        return 0.0, 0.0
    ordered = np.sort(values)
    cuts = np.flatnonzero(np.diff(ordered)) + 1
    sizes = np.diff(np.concatenate([[0], cuts, [len(ordered)]]))
    return len(sizes) / len(values), sizes.max() / len(values)


def text_stats(column: pa.Array) -> np.ndarray:
    """A row of STATS for every text."""
    data, offsets = text_bytes(column)
    starts, ends, first = find_words(data, offsets)
    hashes = word_hashes(data, starts, ends)
    sizes = ends - starts
    kinds = np.zeros((len(_KINDS), len(offsets)), np.int64)
    for k, table in enumerate(_KINDS):
        at = np.flatnonzero(table[data])
        kinds[k] = np.searchsorted(at, offsets)
    kinds = np.diff(kinds, axis=1)
    triples = hashes[:-2] * np.uint64(3) + hashes[1:-1] * np.uint64(5) + hashes[2:] * np.uint64(7) if len(hashes) > 2 else hashes[:0]
    out = np.zeros((len(offsets) - 1, len(STATS)))
    for d in range(len(out)):
        a, b = int(first[d]), int(first[d + 1])
        n = b - a
        length = max(1, int(offsets[d + 1] - offsets[d]))
        words = max(1, n)
        lines = bytes(data[offsets[d]:offsets[d + 1]]).split(b"\n") if kinds[8, d] else []
        lines = [x for x in lines if x.strip()]
        distinct, top = _share_repeated(hashes[a:b])
        tri, _ = _share_repeated(triples[a:max(a, b - 2)])
        size = sizes[a:b]
        k = kinds[:, d]
        out[d] = (np.log1p(n), min(50.0, size.sum() / words), k[0] / length, k[1] / length, k[2] / words,
                  k[3] / words, k[4] / words, k[5] / words, k[6] / length, k[7] / length,
                  np.log1p(n / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)) if lines else 0.0,
                  distinct, top, 1 - tri if n > 2 else 0.0, (size <= 2).sum() / words, (size > 14).sum() / words,
                  k[9] / words)
    return out


def stats_table(docs: DataFrame) -> DataFrame:
    """doc_id and x, the statistics of every row's text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x = pa.array(list(text_stats(part.column("text"))), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), x], ["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


class Model:
    """Centre and scale of the statistics, random frequencies, weights, calibration."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray, seed: int = 0, width: float = 3.0):
        rng = np.random.default_rng(seed)
        self.centre, self.scale = centre, scale
        self.w = rng.normal(0, 1 / width, (len(centre), FEATURES))
        self.b = rng.uniform(0, 2 * np.pi, FEATURES)
        self.beta = np.zeros(FEATURES + 1)
        self.low, self.high = 0.0, 1.0
        self.level = np.full(STEPS, 0.5)

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8) @ self.w + self.b
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z), np.ones((len(x), 1))])

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.beta

    def step(self, x: np.ndarray) -> np.ndarray:
        """The step of each row's ridge score, of STEPS from the lowest to the highest that
        the fitted rows have."""
        raw = (self.ridge(x) - self.low) / max(self.high - self.low, 1e-12)
        return np.clip(np.floor(raw * STEPS), 0, STEPS - 1).astype(np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.level[self.step(x)]


def pool(good: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Isotonic means of steps with ``good`` of ``n`` each; empty steps take the value
    between their neighbours."""
    blocks: list[list[float]] = []
    for i in np.flatnonzero(n):
        blocks.append([good[i], n[i], i, i])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            g, m, _, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + g, blocks[-1][1] + m, blocks[-1][2], last]
    at = [p for block in blocks for p in block[2:]]
    # add-one counts keep the ends off 0 and 1
    value = [(g + 1) / (m + 2) for g, m, _, _ in blocks for _ in range(2)]
    return np.maximum.accumulate(np.interp(np.arange(len(n)), at, value))


def _normal_sums(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """X'X and X'y over rows of x and y: one matrix per task, added up row by row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            if batch.num_rows:
                f = model.features(_matrix(batch.column("x")))
                total += f.T @ np.column_stack([f, batch.column("y").to_numpy()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "v"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, v in zip(batch.column("i").to_pylist(), _matrix(batch.column("v")) if batch.num_rows else ()):
                sums[i] = sums.get(i, 0) + v
        yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.int32()), pa.array(
            [v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["i", "v"])

    schema = "i int, v array<double>"
    parts = rows.mapInArrow(run, schema).repartition(8, "i").mapInArrow(add, schema).collect()
    out = np.zeros((FEATURES + 1, FEATURES + 2))
    for r in parts:
        out[r["i"]] += r["v"]
    return out[:, :-1], out[:, -1]


def train(stats: DataFrame, labels: DataFrame, learns: Column) -> Model:
    """The model of the labelled rows of ``stats`` for which ``learns`` holds."""
    good = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").cast("double").alias("y"))
    rows = save(stats.filter(learns).join(good, "doc_id").withColumn("h", F.xxhash64("doc_id")), "classifier-rows")
    labelled = max(rows.count(), 1)
    rows = rows.filter(F.pmod(F.xxhash64("h"), F.lit(labelled)) < SAMPLE)
    fit, held = rows.filter("pmod(h, 4) <> 0"), rows.filter("pmod(h, 4) = 0")
    moments = [c for i in range(len(STATS)) for c in (
        F.avg(F.get("x", F.lit(i))), F.stddev_pop(F.get("x", F.lit(i))))]
    n, share, *m = fit.agg(F.count("*"), F.avg("y"), *moments).first()
    if not n:
        return Model(np.zeros(len(STATS)), np.ones(len(STATS)))
    model = Model(np.array(m[::2]), np.maximum(np.array(m[1::2]), 1e-6))
    model.level[:] = share
    xx, xy = _normal_sums(fit, model)
    model.beta = np.linalg.solve(xx + RIDGE * n * np.eye(len(xx)), xy)

    def ridge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(model.ridge(_matrix(batch.column("x"))))], ["r"])

    # ridge scores are no probabilities: the steps cover what the fitted rows have
    model.low, model.high = fit.select("x").mapInArrow(ridge, "r double").agg(F.min("r"), F.max("r")).first()

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = pa.array(model.step(_matrix(batch.column("x"))), pa.int32())
                yield pa.RecordBatch.from_arrays([s, batch.column("y")], ["step", "y"])

    counts = held.select("x", "y").mapInArrow(steps, "step int, y double").groupBy("step").agg(
        F.sum("y").alias("good"), F.count("*").alias("n")).collect()  # at most STEPS rows
    if len(counts) > 1 and 0 < share < 1:
        table = np.zeros((2, STEPS))
        for r in counts:
            table[:, r["step"]] = r["good"], r["n"]
        model.level = pool(*table)
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(model.score(_matrix(batch.column("x"))))], ["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: Column, folds: int) -> Column:
    """Whether crc32 of the id's text leaves 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 1, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    stats = save(stats_table(docs), "classifier-stats")
    model = train(stats, labels, ~held_out(F.col("doc_id"), folds))
    return score(stats, model).select(
        "doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
