"""Helpers shared by the pipeline operators: saved tables, fresh names, flat word arrays."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# A word is a run of bytes outside the ASCII white space 0x20 and 0x09-0x0D.
WORD_BREAK = r"[\x20\x09-\x0D]+"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Python tasks cut their input into slices of about so many text bytes.
SLICE_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a session that names none (a local test) gets one under the temporary folder.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    base = conf or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kpiloom-"))
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# What Spark gathers for a Python task at a time: a few slices, where its own limit is 64 MB
# for each task in the JVM, and again in Python.
_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with these settings meanwhile."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def lean(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Small Arrow batches, and shuffle files that go with the action that made them: for
    steps that run here and whose tables are saved."""
    return settings(spark, {**_BATCHES, _CLEANUP: "true"})


def narrowed(df: DataFrame) -> DataFrame:
    """``df`` in an eighth of the shuffle's partitions."""
    spark = df.sparkSession
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(max(2 * spark.sparkContext.defaultParallelism, shuffled // 8))


def save(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage, and an executor lost later costs only the reading of its part.

    A ``narrow`` table has few short columns and far fewer rows than what was shuffled
    for it: an eighth of the shuffle's partitions write it, so that rounds over such
    tables make no heaps of tiny files. The shuffle files of the write are of no use
    afterwards and go at once, by a setting that holds for the session meanwhile."""
    spark = df.sparkSession
    if narrow:
        df = narrowed(df)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with settings(spark, {_CLEANUP: "true"}):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def discard(*saved: DataFrame) -> None:
    """Delete tables made by ``save`` of which nothing will be read any more: whatever was
    made from them has been saved itself."""
    for df in saved:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.saved_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, made from ``names``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column one after the other, and where each begins
    (one more offset than texts). Null texts are empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes of text; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def lower(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased."""
    return _LOWER[data]


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of each text's first word
    (one more than texts)."""
    inside = ~_IS_SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    before[edge] = False
    after[edge - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, SLICE_BYTES + 65536)
        tables = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            t = np.full(n, b, np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        _powers[:] = tables
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for every span, from one running sum."""
    power, inverse = _power_table(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power[:len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    return span_hashes(data, starts, ends)


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All words of a slice joined by one space, and the start of each in that
    (one more than words, as if another word followed)."""
    sizes = ends - starts + 1
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    out = np.full(int(at[-1]), 32, np.uint8)
    source = np.repeat(starts - at[:-1], sizes) + np.arange(at[-1])
    inside = np.ones(len(out), bool)
    inside[at[1:] - 1] = False
    out[inside] = data[source[inside]]
    return out.tobytes(), at
