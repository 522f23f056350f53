"""Published tables: new data beside the old, made visible by one small file.

``mode("overwrite")`` deletes a table before its successor exists, so a write that fails
leaves nothing, and readers of a running write see half of it.  Here every publication
writes data files under a version of its own and then a numbered manifest that says
which version holds each partition; readers take the highest number.  The manifest is
created in one step and never replaced, so two writers cannot both publish a number:
the later one fails and leaves what is published alone.

    <path>/data/[month=2024-01-01/]v=<version>/part-*.parquet
    <path>/manifests/<number>.json

A table may be partitioned by one column.  :func:`refresh` publishes some partitions
anew and keeps the files of all others; readers list the partitions they want, or
filter on the column, and other files are not touched.  Paths are of any file system
that Spark reads; the driver handles one manifest and the names of partitions, no data.
"""

from __future__ import annotations

import json
import uuid
from typing import Dict, List, Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VERSION = "v"  # column of the version folders
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class PublishConflict(RuntimeError):
    """Another writer published first."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _manifest_path(path: str, number: int) -> str:
    return f"{path}/manifests/{number:012d}.json"


def manifest_numbers(spark: SparkSession, path: str) -> List[int]:
    """Numbers of all publications that can still be read, in order."""
    fs, folder = _fs(spark, path), _path(spark, f"{path}/manifests")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, path: str, number: Optional[int] = None) -> Optional[dict]:
    """A publication's manifest; the latest one's by default, None if there is none."""
    if number is None:
        numbers = manifest_numbers(spark, path)
        if not numbers:
            return None
        number = numbers[-1]
    stream = _fs(spark, path).open(_path(spark, _manifest_path(path, number)))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def _commit(spark: SparkSession, path: str, made: dict, number: int) -> None:
    jvm, target = spark._jvm, _path(spark, _manifest_path(path, number))
    aside = _path(spark, f"{path}/manifests/_{uuid.uuid4().hex}")
    stream = _fs(spark, path).create(aside, False)
    try:
        stream.write(bytearray(json.dumps(made).encode()))
    finally:
        stream.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.getFileSystem(
        spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(aside, target, plain)  # whole at once; fails if the number is taken
    except Exception as e:
        _fs(spark, path).delete(aside, False)
        if "FileAlreadyExists" in str(e):
            raise PublishConflict(f"{path}: publication {number} exists") from e
        raise


def _write_version(df: DataFrame, path: str, partition_by: Optional[str]) -> Dict[str, str]:
    """Write ``df`` under a new version; folder name of each partition -> version."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    if _VERSION in df.columns:
        raise ValueError(f"a published table cannot have a column {_VERSION}")
    columns = [partition_by, _VERSION] if partition_by else [_VERSION]
    # append only adds files; nobody reads them before a manifest names their version
    df.withColumn(_VERSION, F.lit(version)).write.mode("append").partitionBy(*columns).parquet(f"{path}/data")
    depth = f"{path}/data/*/{_VERSION}={version}" if partition_by else f"{path}/data/{_VERSION}={version}"
    found = _fs(spark, path).globStatus(_path(spark, depth))
    return {(s.getPath().getParent().getName() if partition_by else ""): version for s in found or []}


def _folder(spark: SparkSession, column: str, value) -> str:
    """The name of a partition's folder, as the writer makes it."""
    if value is None:
        return f"{column}={_NULL_FOLDER}"
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{column}={escape(str(value))}"


def publish(df: DataFrame, path: str, partition_by: Optional[str] = None) -> int:
    """Publish ``df`` as the whole table; the number of the publication.

    Until the manifest is written, and if anything fails before, readers keep the
    table that was published before.
    """
    spark = df.sparkSession
    numbers = manifest_numbers(spark, path)
    number = numbers[-1] + 1 if numbers else 1
    parts = _write_version(df, path, partition_by)
    _commit(spark, path, {"schema": df.schema.jsonValue(), "partition_by": partition_by, "parts": parts}, number)
    return number


def refresh(df: DataFrame, path: str, values: Sequence) -> int:
    """Publish the rows of ``df`` as the partitions ``values`` of the table (one without
    rows is empty afterwards); the files of all other partitions stay as they are."""
    spark = df.sparkSession
    old = manifest(spark, path)
    if old is None or not old["partition_by"]:
        raise ValueError(f"{path} has no published table with partitions")
    if T.StructType.fromJson(old["schema"]).simpleString() != df.schema.simpleString():
        raise ValueError(f"{path} is published with other columns")
    number, column = manifest_numbers(spark, path)[-1] + 1, old["partition_by"]
    wanted = {_folder(spark, column, v) for v in values}
    parts = _write_version(df, path, column)
    if set(parts) - wanted:
        raise ValueError(f"rows of partitions that are not refreshed: {sorted(set(parts) - wanted)[:5]}")
    kept = {name: version for name, version in old["parts"].items() if name not in wanted}
    _commit(spark, path, {**old, "parts": {**kept, **parts}}, number)
    return number


def read_published(spark: SparkSession, path: str, number: Optional[int] = None,
                   values: Optional[Sequence] = None) -> DataFrame:
    """A published table (the latest publication, or ``number``), or only its partitions
    ``values``.  Filters on the partition column prune folders before files are listed
    to tasks."""
    made = manifest(spark, path, number)
    if made is None:
        raise ValueError(f"nothing is published at {path}")
    schema, column = T.StructType.fromJson(made["schema"]), made["partition_by"]
    parts = made["parts"]
    if values is not None:
        wanted = {_folder(spark, column, v) for v in values}
        parts = {name: version for name, version in parts.items() if name in wanted}
    folders = [f"{path}/data/{name + '/' if name else ''}{_VERSION}={version}" for name, version in sorted(parts.items())]
    if not folders:
        return spark.createDataFrame([], schema)
    own = T.StructType([*schema.fields, T.StructField(_VERSION, T.StringType())])
    return (spark.read.schema(own).option("basePath", f"{path}/data").parquet(*folders)
            .select(*[f"`{f.name}`" for f in schema.fields]))


def drop_before(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Forget all but the last ``keep`` publications and delete the versions that only
    they name; the number of version folders deleted.  Not to be run while a writer is
    between its data and its manifest."""
    numbers = manifest_numbers(spark, path)
    gone, stay = numbers[:-keep] if keep else [], numbers[-keep:] if keep else numbers
    used = {(n, v) for k in stay for n, v in manifest(spark, path, k)["parts"].items()}
    old = {(n, v) for k in gone for n, v in manifest(spark, path, k)["parts"].items()} - used
    fs = _fs(spark, path)
    for k in gone:  # manifests first: what can be read has its files
        fs.delete(_path(spark, _manifest_path(path, k)), False)
    for name, version in sorted(old):
        fs.delete(_path(spark, f"{path}/data/{name + '/' if name else ''}{_VERSION}={version}"), True)
    return len(old)
