import hashlib
import io

import pytest
from pyspark.sql import functions as F

from kpiloom.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "html AS payload", "url AS same")


LONG = "<p>" + "x" * 1200 + "é</p>"
ROWS = [(1, "http://a/1", LONG), (2, "http://a/2", LONG), (3, "http://b/3", LONG), (4, "http://a/4", "short"),
        (5, "http://a/5", "short"), (6, None, None), (7, "http://c/\r\nX: 1", ""), (8, "http://c/8", "y" * 1000),
        (9, "http://c/9", "y" * 1000), (10, "http://d/ä", "z" * 300_000), (None, "http://e", "lone"), (4, "http://a/4", "short")]


def want(rows):
    last = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= 1000 and i is not None:
            last[p] = max(last.get(p, i), i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        keep = last.get(p, i)
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "response" if keep == i else "revisit", None if keep == i else keep))
    return sorted(out, key=str)


def test_round_trip(spark):
    got = warc.round_trip(pages(spark, ROWS)).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == want(ROWS)
    assert warc.round_trip(pages(spark, [])).collect() == []


@pytest.fixture
def archive(spark, tmp_path):
    warc.write(pages(spark, ROWS).repartition(3), str(tmp_path / "w"))
    return str(tmp_path / "w")


def test_pushed_filters(spark, archive):
    df = warc.read(spark, archive, "page_id long, record_type string, target_uri string, payload binary")
    only = df.filter((F.col("record_type") == "response") & F.col("target_uri").startswith("http://a/"))
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "FilterExec" not in plan and "Filter (" not in plan
    assert sorted(r.page_id for r in only.collect()) == [4, 4, 5]
    assert [r.page_id for r in df.filter("target_uri IS NULL").collect()] == [6]
    assert sorted(r.page_id for r in df.filter("target_uri IN ('http://a/1', 'http://d/ä')").collect()) == [1, 10]
    assert sorted(r.page_id for r in df.filter("page_id > 8").collect()) == [9, 10]
    assert df.filter("target_uri LIKE 'http://c/%0D%0AX%'").count() == 1
    assert bytes(df.filter("page_id = 10").first().payload) == b"z" * 300_000


class Counting(io.BytesIO):
    got = 0

    def read(self, n=-1):
        out = super().read(n)
        self.got += len(out)
        return out


def test_unwanted_payloads_are_not_decoded():
    import os
    big = os.urandom(1 << 20)  # does not compress
    data = b"".join(warc.member(warc.record(i, f"http://h/{i}", big, "response", None)) for i in range(5))
    f = Counting(data)
    got = list(warc.read_records(f, lambda h: h["x-page-id"] == "3", True))
    assert len(got) == 1 and got[0][2] == big
    assert f.got < 1.2 * len(big) + (1 << 18)  # one payload, and the first bytes of the others
    f = Counting(data)
    assert [n for _, n, p in warc.read_records(f, lambda h: True, False)] == [len(big)] * 5
    assert f.got < len(big)


def test_members_of_other_writers():
    import gzip
    records = [warc.record(i, None, b"body %d" % i, "response", None) for i in range(3)]
    data = b"".join(gzip.compress(r) for r in records)
    assert [p for _, _, p in warc.read_records(io.BytesIO(data), lambda h: True, True)] == [b"body 0", b"body 1", b"body 2"]
    # ours are readable as plain gzip
    assert gzip.decompress(b"".join(map(warc.member, records))) == b"".join(records)


def test_files_roll_and_partitions_pack(spark, tmp_path):
    path = str(tmp_path / "r")
    spark.dataSource.register(warc.WarcSource)
    rows = warc.with_types(pages(spark, [(i, "u", "text %d" % i) for i in range(200)])).coalesce(1)
    rows.write.format(warc.FORMAT).option("file_bytes", 5000).mode("append").save(path)
    files = list((tmp_path / "r").iterdir())
    assert len(files) > 3 and all(f.name.endswith(".warc.gz") for f in files)
    df = spark.read.format(warc.FORMAT).option("partition_bytes", 12_000).schema("page_id long").load(path)
    assert 1 < df.rdd.getNumPartitions() < len(files)
    assert sorted(r.page_id for r in df.collect()) == list(range(200))


def test_cut_off_archive_is_an_error():
    data = warc.member(warc.record(1, "u", b"x" * 5000, "response", None))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(data[:60]), lambda h: True, True))
