"""Readers and sinks for the seven source tables and the marts."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from typing import Dict, List, Optional, Sequence, Tuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.sources.schemas import SOURCE_SCHEMAS


# The column that a permissive CSV reader fills with a line that does not fit.
BAD_LINE = "_bad_line"

# Files whose headers are read at a time (one line each).
_HEADER_THREADS = 16


def csv_headers(spark: SparkSession, path: str) -> Dict[Tuple[str, ...], List[str]]:
    """The files under ``path`` by their header's column names; empty files are left out.

    The driver reads one line of each file, several at a time, through the file system
    and codecs that Spark uses.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in spark.read.text(path).inputFiles()]

    def first_line(file) -> str:
        stream = file.getFileSystem(conf).open(file)
        try:
            codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file)
            data = codec.createInputStream(stream) if codec else stream
            lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(data, "UTF-8"))
            line = lines.readLine()
            while line is not None and not line.strip():
                line = lines.readLine()
            return line or ""
        finally:
            stream.close()

    groups: Dict[Tuple[str, ...], List[str]] = {}
    with ThreadPoolExecutor(_HEADER_THREADS) as pool:
        for file, line in zip(paths, pool.map(first_line, paths)):
            if line:
                names = tuple(next(csv.reader([line.lstrip("\ufeff")])))
                groups.setdefault(names, []).append(file.toString())
    return groups


def _read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool,
              permissive: bool = False) -> DataFrame:
    """The schema's columns as text, found by the names of each file's own header: files
    with the same header are one scan, and the scans are united by name.  With
    ``permissive`` a line that does not fit its header is in the column ``BAD_LINE``."""
    reader = (spark.read.option("header", True).option("mode", "PERMISSIVE" if permissive else "FAILFAST")
              .option("encoding", "UTF-8").option("escape", '"').option("multiLine", multi_line)
              .option("enforceSchema", False).option("columnNameOfCorruptRecord", BAD_LINE))
    names = [f.name for f in schema.fields]
    groups = csv_headers(spark, path)
    if not groups:
        raise ValueError(f"{path} has no header")
    out = None
    for header, files in sorted(groups.items()):
        missing = [n for n in names if n not in header]
        if missing:
            raise ValueError(f"{files[0]} has no column {', '.join(missing)}")
        twice = [n for n in names if header.count(n) > 1]
        if twice:
            raise ValueError(f"{files[0]} has the column {', '.join(twice)} twice")
        # of other columns that a header names twice, each but the first gets a name of its own
        text = [T.StructField(n if n not in header[:i] else f"{n}.{i}", T.StringType()) for i, n in enumerate(header)]
        if permissive:
            text.append(T.StructField(BAD_LINE, T.StringType()))
        part = reader.schema(T.StructType(text)).csv(files)
        part = part.select(*names, *([BAD_LINE] if permissive else []))
        out = part if out is None else out.unionByName(part)
    return out


def _field(f: T.StructField, fmt: str) -> Column:
    """A source column before its cast: an empty number of a CSV file is null."""
    blank = fmt == "csv" and not isinstance(f.dataType, T.StringType)
    return F.nullif(F.trim(f.name), F.lit("")) if blank else F.col(f.name)


def read_source(spark: SparkSession, path: str, name: str, fmt: str = "csv",
                multi_line: bool = False) -> DataFrame:
    """Read one source table with its fixed schema (no inference).

    CSV files carry a header row each, by whose names the columns are found in any
    order, which may differ from file to file; quotes within quoted fields are doubled
    (RFC 4180), and ``multi_line`` allows line breaks in them (such a file is then read
    by one task).  Empty fields read as null, other text (including a single blank) is
    kept verbatim for staging to clean.  Parquet columns are selected by name and cast
    to the declared types.  A line that does not fit its header, or a number that does
    not cast, ends the run; :mod:`kpiloom.sources.rejects` sets such rows aside.
    """
    schema = SOURCE_SCHEMAS[name]
    df = _read_csv(spark, path, schema, multi_line) if fmt == "csv" else spark.read.format(fmt).load(path)
    return df.select([_field(f, fmt).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_sources(spark: SparkSession, base: str, fmt: str = "csv") -> dict:
    """All seven sources from ``base/<name>.<fmt>``."""
    return {name: read_source(spark, f"{base}/{name}.{fmt}", name, fmt)
            for name in SOURCE_SCHEMAS}


def register(df: DataFrame, name: str) -> DataFrame:
    """Expose a frame to SQL as a temporary view (the staging 'view' sink)."""
    df.createOrReplaceTempView(name)
    return df


def write_source(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a source table the way :func:`read_source` reads it."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = (writer.option("header", True).option("escape", '"').option("encoding", "UTF-8")
                  .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    writer.save(path)


def write_mart(df: DataFrame, path: Optional[str] = None, table: Optional[str] = None,
               partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Full-refresh write of a mart (the 'table' sink): overwrite a path or a table."""
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table is not None:
        writer.saveAsTable(table)
    elif path is not None:
        writer.save(path)
    else:
        raise ValueError("write_mart needs a path or a table name")
