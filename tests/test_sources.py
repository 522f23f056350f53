"""Source readers and sinks: CSV with a header and fixed schema, views, tables."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from kpiloom.operators import staging
from kpiloom.plans.marts import MART_NAMES, build_and_write
from kpiloom.sources import read_source, read_sources, register, write_mart
from kpiloom.sources.driver_tables import load_sources
from kpiloom.sources.published import read_published
from kpiloom.sources.rejects import TooManyRejects, land_source, reject_counts
from kpiloom.sources.schemas import SOURCE_SCHEMAS

CUSTOMERS_CSV = """customer_id,customer_name,country,segment,signup_date,plan_type,monthly_revenue,partner_id
K1,Nordlys Revision ApS,DK,MID,2020-05-04,premium,1500,P7
K2,Brückner Treuhand GmbH,DE,SMB,2022-09-12,basic,650,
"""

SUBSCRIPTIONS_CSV = """subscription_id,customer_id,plan_type,start_date,end_date,churn_date,churn_reason,mrr,country
T1,K1,premium,2020-05-04,,, ,1500,DK
T2,K2,basic,2022-09-12,2024-01-31,2024-01-31,competitor,650,DE
"""


def test_csv_source_keeps_blanks_and_utf8(spark, tmp_path):
    (tmp_path / "customers.csv").write_text(CUSTOMERS_CSV, encoding="utf-8")
    (tmp_path / "subscriptions.csv").write_text(SUBSCRIPTIONS_CSV, encoding="utf-8")
    cust = read_source(spark, str(tmp_path / "customers.csv"), "customers")
    assert dict(cust.dtypes)["monthly_revenue"] == "bigint"
    rows = {r.customer_id: r for r in cust.collect()}
    assert rows["K2"].customer_name == "Brückner Treuhand GmbH"
    assert rows["K2"].partner_id is None
    subs = staging.stg_subscriptions(
        read_source(spark, str(tmp_path / "subscriptions.csv"), "subscriptions"),
        dt.date(2024, 4, 1))
    r = {row.subscription_id: row for row in subs.collect()}
    assert r["T1"].is_active and r["T1"].churn_reason is None
    assert r["T2"].is_churned and r["T2"].days_since_churn == 61


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'comment,csat_score,nps_score,survey_date,customer_id,country,survey_id,extra\n'
        '"He said ""great"", twice",10,1,2024-01-05,C1,DK,S1,x\n'
        ',,,"",C2,,S2,\n', encoding="utf-8")
    rows = {r.survey_id: r for r in read_source(spark, str(tmp_path / "a.csv"), "nps_surveys").collect()}
    assert (rows["S1"].nps_score, rows["S1"].csat_score) == (1, 10)
    assert rows["S1"].comment == 'He said "great", twice' and rows["S1"].customer_id == "C1"
    assert rows["S2"].nps_score is None and rows["S2"].survey_date in (None, "")


def test_csv_line_breaks_missing_columns_and_mixed_headers(spark, tmp_path):
    header = "survey_id,customer_id,survey_date,nps_score,csat_score,country,comment\n"
    (tmp_path / "b.csv").write_text(header + 'S1,C1,2024-01-05,9,5,DK,"two\nlines"\n', encoding="utf-8")
    row = read_source(spark, str(tmp_path / "b.csv"), "nps_surveys", multi_line=True).first()
    assert row.comment == "two\nlines"
    (tmp_path / "c.csv").write_text("survey_id,customer_id\nS1,C1\n", encoding="utf-8")
    with pytest.raises(ValueError, match="nps_score"):
        read_source(spark, str(tmp_path / "c.csv"), "nps_surveys")
    folder = tmp_path / "d"
    folder.mkdir()
    (folder / "1.csv").write_text(header + "S1,C1,2024-01-05,9,5,DK,a\n", encoding="utf-8")
    (folder / "2.csv").write_text("\ufeff" + header.replace("nps_score,csat_score", "csat_score,nps_score")
                                  + "S2,C1,2024-01-05,9,5,DK,b\n", encoding="utf-8")
    with gzip.open(folder / "3 x.csv.gz", "wt", encoding="utf-8") as f:
        f.write('"note, long",note,note,' + header + "q,r,s,S3,C2,2024-01-06,7,4,SE,c\n")
    (folder / "4.csv").write_text("", encoding="utf-8")
    rows = {r.survey_id: (r.nps_score, r.csat_score, r.comment) for r in read_source(spark, str(folder), "nps_surveys").collect()}
    assert rows == {"S1": (9, 5, "a"), "S2": (5, 9, "b"), "S3": (7, 4, "c")}
    (folder / "5.csv").write_text(header.replace("country", "comment") + "S4,C1,2024-01-05,9,5,DK,a\n", encoding="utf-8")
    with pytest.raises(ValueError, match="country"):
        read_source(spark, str(folder), "nps_surveys")


DIRTY = ("survey_id,customer_id,survey_date,nps_score,csat_score,country,comment\n"
         "S1,C1,2024-01-05,9,5,DK,fine\n"
         "S2,C1,2024-02-30,nine,5,DK,two faults\n"
         "S3,C1,2024-01-05,9,5,DK,a,field too many\n"
         "S4,C1,2024-01-05\n"
         "S5,,,,,,\n"
         "S6,C1, 2024-01-05 , 7 ,5,DK,blanks are trimmed\n")


def test_rejects_are_set_aside_and_explained(spark, tmp_path):
    (tmp_path / "s.csv").write_text(DIRTY, encoding="utf-8")
    good, rejects = land_source(spark, str(tmp_path / "s.csv"), "nps_surveys", str(tmp_path / "out"))
    assert good.schema == SOURCE_SCHEMAS["nps_surveys"]
    assert sorted(r.survey_id for r in good.collect()) == ["S1", "S5", "S6"]
    assert good.filter("survey_id = 'S6'").first().nps_score == 7
    found = sorted((r.column_name or "", r.reason, r.value) for r in rejects.collect())
    assert found == [("", "malformed line", "S3,C1,2024-01-05,9,5,DK,a,field too many"), ("", "malformed line", "S4,C1,2024-01-05"),
                     ("nps_score", "not a number", "nine"), ("survey_date", "not a date", "2024-02-30")]
    record = json.loads(rejects.filter("reason = 'not a date'").first().record)
    assert record["comment"] == "two faults" and record["nps_score"] == "nine"
    assert {(r.column_name, r.rejected) for r in reject_counts(rejects).collect()} == {
        (None, 2), ("nps_score", 1), ("survey_date", 1)}
    # what is set aside is what the strict reader and staging stop at, and nothing else
    staging.stg_nps_surveys(good).collect()
    with pytest.raises(Exception, match="(?i)malformed|cast"):
        read_source(spark, str(tmp_path / "s.csv"), "nps_surveys").collect()
    with pytest.raises(TooManyRejects, match="3 rows"):
        land_source(spark, str(tmp_path / "s.csv"), "nps_surveys", str(tmp_path / "out2"), max_rejected=2)


def test_rejects_of_a_clean_and_of_a_parquet_source(spark, tmp_path, sf_small):
    src = load_sources(spark, sf_small)["invoices"]
    write_mart(src.withColumn("amount", F.expr("IF(amount % 7 = 0, 'x', CAST(amount AS STRING))")), path=str(tmp_path / "p"))
    good, rejects = land_source(spark, str(tmp_path / "p"), "invoices", str(tmp_path / "o1"), fmt="parquet")
    bad = src.filter("amount % 7 = 0").count()
    assert rejects.count() == bad > 0 and good.count() == src.count() - bad
    write_mart(src, path=str(tmp_path / "q"))
    good, rejects = land_source(spark, str(tmp_path / "q"), "invoices", str(tmp_path / "o2"), fmt="parquet", max_rejected=0)
    assert good.count() == src.count() and rejects.count() == 0


def test_parquet_round_trip_and_view(spark, tmp_path, sf_small):
    src = load_sources(spark, sf_small)
    for name, df in src.items():
        write_mart(df, path=str(tmp_path / f"{name}.parquet"))
    back = read_sources(spark, str(tmp_path), fmt="parquet")
    assert {n: df.count() for n, df in back.items()} == {n: df.count() for n, df in src.items()}
    register(staging.stg_partners(back["partners"]), "stg_partners_view")
    assert spark.sql("SELECT count(*) FROM stg_partners_view").first()[0] == 10


def test_build_and_write_checks_written_marts(spark, tmp_path, sf_small):
    report = build_and_write(spark, load_sources(spark, sf_small), str(tmp_path))
    rows = report.collect()
    failed = {(r.model, r.column_name, r.check_name) for r in rows if r.failures}
    assert len(rows) == 68
    assert failed == {("stg_invoices", "customer_id", "not_null"), ("stg_invoices", "customer_id", "relationships"),
                      ("stg_leads", "customer_id", "not_null"), ("stg_nps_surveys", "customer_id", "not_null")}
    for name in MART_NAMES:
        assert read_published(spark, str(tmp_path / name)).count() > 0


def test_models_as_sql_views(spark, sf_small):
    from kpiloom.plans.marts import model_frames, register_models
    register_models(model_frames(load_sources(spark, sf_small), as_of=dt.date(2024, 4, 1)))
    n = spark.sql("SELECT count(*) FROM mart_churn WHERE record_type = 'at_risk_customer'")
    from kpiloom.plans.registry import QUERIES
    assert n.first()[0] == QUERIES["at_risk_customers"](spark, sf_small).count() > 0
    joined = spark.sql("SELECT count(*) FROM stg_invoices i LEFT JOIN stg_customers c "
                       "USING (customer_id)").first()[0]
    assert joined == spark.sql("SELECT count(*) FROM stg_invoices").first()[0] == 1500
