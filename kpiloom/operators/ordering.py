"""Presentation order with positions, computed without putting all rows in one task."""

from __future__ import annotations

import uuid
from typing import List, Sequence, Tuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.session import shared_dir

# (column, 'asc' or 'desc', nulls 'first' or 'last')
OrderSpec = Sequence[Tuple[str, str, str]]

# A task sorts about SORT_ROWS rows, however many there are; fewer, down to SPREAD_ROWS,
# where the shuffle has partitions for them.
SORT_ROWS = 1 << 18
SPREAD_ROWS = 1 << 13

# monotonically_increasing_id() holds the partition above so many bits, the row below
_ROW_BITS = 33


def sort_columns(spec: OrderSpec) -> list:
    """Sort expressions of an order."""
    return [getattr(F.col(f"`{c}`"), f"{d}_nulls_{n}")() for c, d, n in spec]


def full_order(df: DataFrame, spec: OrderSpec) -> List[Tuple[str, str, str]]:
    """The order with all remaining columns behind it, ascending with nulls last.

    A declared order leaves ties open, and its keys may have few distinct values,
    which range partitions cannot split; the other columns settle and spread them.
    """
    named = {c for c, _, _ in spec}
    return [*spec, *((c, "asc", "last") for c in df.columns if c not in named)]


def with_position(df: DataFrame, spec: OrderSpec, position: str = "position") -> DataFrame:
    """``df`` and a column ``position``, counted from 1 in the order of ``spec``; rows that
    tie in it follow their other columns, and equal rows come in any order.

    A window over all rows would sort them in one task.  Here the rows are written as they
    come and counted, then range partitioned and sorted, in as many partitions as their
    number asks for (adaptive execution would put them together by their compressed
    size, and tasks would grow with the table), and written with their partition and place in it to the shared
    folder, and numbered by what the partitions before theirs hold: one count for each
    partition is all that is added up in one place.  Equal rows are told apart by a
    running number, so that copies of one row spread over partitions too.  An executor
    lost later costs the reading of its part of the written table.
    """
    if position in df.columns:
        raise ValueError(f"there is a column {position} already")
    tie, at, index, before = (_unused(df, c) for c in ("_tie", "_at", "_part", "_before"))
    spark, run = df.sparkSession, uuid.uuid4().hex
    as_made, path = (f"{shared_dir(spark)}/{name}-{run}" for name in ("unordered", "ordered"))
    df.write.parquet(as_made)
    rows = spark.read.schema(df.schema).parquet(as_made)
    order = [*sort_columns(full_order(df, spec)), F.col(tie)]
    ordered = (rows.withColumn(tie, F.monotonically_increasing_id())
               .repartitionByRange(sort_partitions(spark, rows.count()), *order)
               .sortWithinPartitions(*order).drop(tie)
               .withColumn(at, F.monotonically_increasing_id()))
    ordered.write.parquet(path)
    as_made = spark._jvm.org.apache.hadoop.fs.Path(as_made)
    as_made.getFileSystem(spark._jsc.hadoopConfiguration()).delete(as_made, True)
    saved = spark.read.schema(ordered.schema).parquet(path)
    part = F.shiftright(at, _ROW_BITS)
    sizes = saved.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row a partition
    total, offsets = 0, []
    for row in sorted(sizes):
        offsets.append((row["part"], total))
        total += row["n"]
    firsts = spark.createDataFrame(offsets, f"{index} long, {before} long")  # a row a partition
    saved = saved.join(F.broadcast(firsts), part == F.col(index))
    place = F.col(at).bitwiseAND((1 << _ROW_BITS) - 1)
    return saved.select(*[f"`{c}`" for c in df.columns], (F.col(before) + place + 1).cast("long").alias(position))


def sort_partitions(spark: SparkSession, rows: int) -> int:
    """In how many partitions ``rows`` rows are sorted."""
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-rows // SORT_ROWS), min(shuffled, -(-rows // SPREAD_ROWS)))


def _unused(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name
