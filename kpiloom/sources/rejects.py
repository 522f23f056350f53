"""Reading a source that has bad rows: they are set aside, counted and explained.

The strict reader ends the run at the first line that does not fit its header, number
that does not cast, or (in staging) text that is no date: right for a small table, but
one bad row in 100 TB then costs the whole run.  :func:`land_source` parses the input
once and writes typed rows and rejects side by side; a row is rejected exactly when
the strict reader or the staging cast would have raised.
"""

from __future__ import annotations

from typing import Optional, Tuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.sources.io import BAD_LINE, _field, _read_csv
from kpiloom.sources.schemas import DATE_COLUMNS, SOURCE_SCHEMAS

MALFORMED, NO_NUMBER, NO_DATE = "malformed line", "not a number", "not a date"

_ITEM = "struct<column_name:string,reason:string,value:string>"


class TooManyRejects(RuntimeError):
    """More rows were rejected than the caller allows."""


def parse_source(spark: SparkSession, path: str, name: str, fmt: str = "csv",
                 multi_line: bool = False) -> DataFrame:
    """Every row of a source: its typed columns (null where a value does not cast),
    ``rejects`` (an array of column_name, reason and value, empty for a good row) and
    ``record`` (a bad row's fields as JSON, or the line as it stands)."""
    schema = SOURCE_SCHEMAS[name]
    if fmt == "csv":
        df = _read_csv(spark, path, schema, multi_line, permissive=True)
        bad_line = F.col(BAD_LINE)
    else:
        df, bad_line = spark.read.format(fmt).load(path), F.lit(None).cast("string")
    items = [F.when(bad_line.isNotNull(), F.struct(
        F.lit(None).cast("string").alias("column_name"), F.lit(MALFORMED).alias("reason"), bad_line.alias("value")))]
    typed = []
    for f in schema.fields:
        raw = _field(f, fmt)
        value = raw.try_cast(f.dataType)
        typed.append(value.alias(f.name))
        reason = NO_NUMBER
        if f.name in DATE_COLUMNS[name]:  # stays text here and is cast in staging
            raw = F.nullif(F.trim(F.col(f.name).cast("string")), F.lit(""))
            value, reason = raw.try_cast("date"), NO_DATE
        elif isinstance(f.dataType, T.StringType):
            continue
        items.append(F.when(bad_line.isNull() & raw.isNotNull() & value.isNull(), F.struct(
            F.lit(f.name).alias("column_name"), F.lit(reason).alias("reason"),
            F.col(f.name).cast("string").alias("value"))))
    found = F.filter(F.array(*items), lambda x: x.isNotNull()).cast(f"array<{_ITEM}>")
    record = F.coalesce(bad_line, F.to_json(F.struct(*[f.name for f in schema.fields])))
    return (df.select(*typed, found.alias("rejects"), record.alias("record"))
            .withColumn("record", F.when(F.size("rejects") > 0, F.col("record"))))


def land_source(spark: SparkSession, path: str, name: str, out: str, fmt: str = "csv",
                multi_line: bool = False, max_rejected: Optional[int] = None) -> Tuple[DataFrame, DataFrame]:
    """Parse a source once into ``out`` (shared storage), good rows and bad rows in folders
    of their own, and read both back: the source with its fixed schema, and the rejects,
    one row for each thing wrong (source, column_name, reason, value, record).

    With more than ``max_rejected`` bad rows the run ends, after both were written.
    """
    parsed = parse_source(spark, path, name, fmt, multi_line)
    flagged = parsed.withColumn("accepted", F.size("rejects") == 0)
    flagged.write.partitionBy("accepted").parquet(out)
    landed = spark.read.schema(flagged.schema).parquet(out)  # both folders, or what there is of them
    good = landed.filter("accepted").select([f.name for f in SOURCE_SCHEMAS[name].fields])
    bad = landed.filter("NOT accepted")
    if max_rejected is not None:
        n = bad.count()
        if n > max_rejected:
            raise TooManyRejects(f"{n} rows of {name} rejected, {max_rejected} allowed; see {out}/accepted=false")
    rejects = bad.select(F.lit(name).alias("source"), F.explode("rejects").alias("r"), "record").select(
        "source", "r.column_name", "r.reason", "r.value", "record")
    return good, rejects


def reject_counts(rejects: DataFrame) -> DataFrame:
    """How many things are wrong, by source, column and reason."""
    return rejects.groupBy("source", "column_name", "reason").agg(F.count(F.lit(1)).alias("rejected"))
