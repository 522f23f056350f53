"""Published tables: what is published stays readable whatever happens to a writer."""

import contextlib
import datetime as dt
import io
import os

import pytest
from pyspark.sql import functions as F

from kpiloom.plans.marts import refresh_months
from kpiloom.sources import published
from kpiloom.sources.published import drop_before, manifest_numbers, publish, read_published, refresh

MONTHS = [dt.date(2024, m, 1) for m in (1, 2, 3)]


def table(spark, rows):
    return spark.createDataFrame(rows, "month date, country string, n long")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path)
            for f in names if f.endswith(".parquet")}


def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    path, old = str(tmp_path / "t"), [(MONTHS[0], "DK", 1), (None, "SE", 2)]
    assert publish(table(spark, old), path) == 1
    broken = table(spark, [(MONTHS[0], "NO", i) for i in range(50)]).withColumn("n", F.expr("IF(n = 40, raise_error('lost'), n)"))
    with pytest.raises(Exception, match="lost"):
        publish(broken, path)
    assert rows(read_published(spark, path)) == sorted(old, key=str) and manifest_numbers(spark, path) == [1]
    new = [(MONTHS[1], "DE", 3)]
    running = read_published(spark, path)  # a reader that began before the next publication
    assert publish(table(spark, new), path) == 2
    assert rows(running) == sorted(old, key=str) and rows(read_published(spark, path)) == new
    assert rows(read_published(spark, path, number=1)) == sorted(old, key=str)


def test_two_writers_cannot_publish_one_number(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish(table(spark, [(MONTHS[0], "DK", 1)]), path)
    publish(table(spark, [(MONTHS[0], "DK", 2)]), path)
    with monkeypatch.context() as m:  # a writer that has not seen the second one
        m.setattr(published, "manifest_numbers", lambda *_: [1])
        with pytest.raises(published.PublishConflict):
            publish(table(spark, [(MONTHS[0], "DK", 3)]), path)
    assert rows(read_published(spark, path)) == [(MONTHS[0], "DK", 2)]


def test_a_month_is_refreshed_and_the_others_files_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [(m, c, 1) for m in (*MONTHS, None) for c in ("DK", "SE")]
    publish(table(spark, first), path, "month")
    before = files(path)
    mart = table(spark, [(m, c, 9) for m in (*MONTHS, None) for c in ("DK", "NL")])
    assert refresh_months(mart, path, [MONTHS[1], None]) == 2
    want = [r for r in first if r[0] in (MONTHS[0], MONTHS[2])] + [(m, c, 9) for m in (MONTHS[1], None) for c in ("DK", "NL")]
    assert rows(read_published(spark, path)) == sorted(want, key=str)
    after = files(path)
    assert before.items() <= after.items()
    kept = [f for f in before if "2024-02" not in f and "HIVE" not in f]
    used = {f[7:] for f in read_published(spark, path).inputFiles()}
    assert kept and all(f in used for f in kept) and len(used) == len(kept) + len(after) - len(before)
    # a month without rows is empty afterwards, and rows of other months are refused
    assert refresh(table(spark, []), path, [MONTHS[0]]) == 3
    assert MONTHS[0] not in {r[0] for r in rows(read_published(spark, path))}
    with pytest.raises(ValueError, match="not refreshed"):
        refresh(mart, path, [MONTHS[0]])


def test_reading_months_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(table(spark, [(m, "DK", 1) for m in MONTHS]), path, "month")
    assert rows(read_published(spark, path, values=[MONTHS[2]])) == [(MONTHS[2], "DK", 1)]
    df = read_published(spark, path).filter(F.col("month") >= F.lit(MONTHS[1]))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    line = next(x for x in buf.getvalue().splitlines() if x.startswith("PartitionFilters"))
    assert "month" in line and rows(df) == [(m, "DK", 1) for m in MONTHS[1:]]
    assert read_published(spark, path, values=[]).count() == 0


def test_old_versions_are_dropped(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(table(spark, [(m, "DK", 1) for m in MONTHS]), path, "month")
    for k in (2, 3, 4):
        refresh(table(spark, [(MONTHS[0], "DK", k)]), path, [MONTHS[0]])
    want = rows(read_published(spark, path))
    assert drop_before(spark, path, keep=2) == 2 and manifest_numbers(spark, path) == [3, 4]
    assert rows(read_published(spark, path)) == want and (MONTHS[0], "DK", 3) in rows(read_published(spark, path, 3))
    assert len(files(path)) == 4
