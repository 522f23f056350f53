"""Staging semantics on edge rows the seeds and the driver mapping lack."""

import datetime as dt

import pytest

from kpiloom.operators import staging
from rows import frame

AS_OF = dt.date(2024, 4, 1)


def test_subscription_blank_dates_and_flags(spark):
    subs = staging.stg_subscriptions(frame(spark, "subscriptions", [
        dict(subscription_id="S1", customer_id="C1", churn_date="", end_date=""),
        dict(subscription_id="S2", customer_id="C1", churn_date="  ", end_date=" "),
        dict(subscription_id="S3", customer_id="C1", churn_date=None, end_date="2024-01-31"),
        dict(subscription_id="S4", customer_id="C1", churn_date="2024-05-01",
             end_date="2024-05-01", churn_reason="competitor"),
    ]), AS_OF)
    r = {row.subscription_id: row for row in subs.collect()}
    assert r["S1"].is_active and not r["S1"].is_churned and r["S1"].days_since_churn is None
    assert r["S2"].is_active and r["S2"].churn_reason is None
    assert not r["S3"].is_active and not r["S3"].is_churned     # ended, never churned
    assert r["S4"].is_churned and r["S4"].days_since_churn == -30  # churn after as_of


def test_invoice_status_untrimmed_and_overdue_days(spark):
    inv = staging.stg_invoices(frame(spark, "invoices", [
        dict(invoice_id="I1", status=" overdue", due_date="2024-03-01"),
        dict(invoice_id="I2", status="overdue", due_date="2024-04-10"),
        dict(invoice_id="I3", status="paid_late", due_date="2024-01-31", paid_date="2024-02-10"),
        dict(invoice_id="I4", status="paid", due_date="2024-01-31", paid_date="2024-01-20"),
    ]), AS_OF)
    r = {row.invoice_id: row for row in inv.collect()}
    assert r["I1"].is_currently_overdue and r["I1"].status == " overdue"
    assert r["I1"].days_overdue == 31
    assert r["I2"].days_overdue == -9                               # not yet due
    assert r["I3"].days_overdue == 10 and not r["I3"].is_currently_overdue
    assert r["I4"].days_overdue == 0


def test_upsell_types_and_revenue(spark):
    ups = staging.stg_upsell_events(frame(spark, "upsell_events", [
        dict(upsell_id="U1", from_plan="basic", to_plan="premium", add_on="x"),
        dict(upsell_id="U2", from_plan="premium", to_plan="premium", add_on="tax"),
        dict(upsell_id="U3", from_plan="premium", to_plan="premium", add_on=" "),
        dict(upsell_id="U4", from_plan=None, to_plan="premium", add_on=None,
             add_on_revenue=None),
    ]))
    r = {row.upsell_id: row for row in ups.collect()}
    assert r["U1"].upsell_type == "plan_upgrade"            # upgrade wins over add-on
    assert r["U2"].upsell_type == "add_on_sale"
    assert r["U3"].upsell_type == "unknown" and r["U3"].add_on is None
    assert r["U4"].upsell_type == "unknown" and r["U4"].incremental_revenue == 0


def test_customer_region_and_tenure(spark):
    cust = staging.stg_customers(frame(spark, "customers", [
        dict(customer_id="C1", country="SE", signup_date="2024-03-02"),
        dict(customer_id="C2", country="FR"),
    ]), AS_OF)
    r = {row.customer_id: row for row in cust.collect()}
    assert r["C1"].region == "Scandinavia" and r["C1"].tenure_days == 30
    assert r["C2"].region is None


def test_leads_hours_and_status(spark):
    leads = staging.stg_leads(frame(spark, "leads", [
        dict(lead_id="L1", lead_date="2024-01-05", assigned_at="2024-01-06",
             lead_status=" unassigned"),
        dict(lead_id="L2", lead_date="2024-01-05", assigned_at="", converted_at="2024-01-09",
             lead_status="converted"),
    ]))
    r = {row.lead_id: row for row in leads.collect()}
    assert r["L1"].hours_to_assign == 24 and r["L1"].lead_status == "unassigned"
    assert r["L2"].hours_to_assign is None and r["L2"].days_to_convert == 4
    assert r["L2"].is_converted and not r["L1"].is_converted


def test_partner_tenure_counts_month_boundaries(spark):
    part = staging.stg_partners(frame(spark, "partners", [
        dict(partner_id="P1", contract_start_date="2024-01-31")]), dt.date(2024, 2, 1))
    assert part.first().partner_tenure_months == 1


def test_nps_categories(spark):
    surv = staging.stg_nps_surveys(frame(spark, "nps_surveys", [
        dict(survey_id="A", nps_score=9, csat_score=4), dict(survey_id="B", nps_score=7,
                                                            csat_score=3),
        dict(survey_id="C", nps_score=6, csat_score=5), dict(survey_id="D", nps_score=None)]))
    r = {row.survey_id: row for row in surv.collect()}
    assert [r[k].nps_category for k in "ABCD"] == ["promoter", "passive", "detractor", None]
    assert [r[k].is_satisfied for k in "ABC"] == [True, False, True]


def test_invalid_date_text_raises(spark):
    cust = staging.stg_customers(frame(spark, "customers", [
        dict(customer_id="C1", signup_date="not a date")]), AS_OF)
    with pytest.raises(Exception):
        cust.collect()


def test_thresholds_come_from_config(spark):
    from kpiloom import KpiConfig
    from kpiloom.operators import upselling
    cfg = KpiConfig(nps_low_score=5, nps_high_score=10, upsell_min_tenure_days=400)
    surv = staging.stg_nps_surveys(frame(spark, "nps_surveys", [
        dict(survey_id="A", nps_score=9), dict(survey_id="B", nps_score=6),
        dict(survey_id="C", nps_score=5), dict(survey_id="D", nps_score=10)]), cfg)
    r = {row.survey_id: row.nps_category for row in surv.collect()}
    assert r == {"A": "passive", "B": None, "C": "detractor", "D": "promoter"}
    cust = staging.stg_customers(frame(spark, "customers", [
        dict(customer_id="C1", signup_date="2023-06-01"),     # 305 days
        dict(customer_id="C2", signup_date="2022-06-01")]), AS_OF)
    subs = staging.stg_subscriptions(frame(spark, "subscriptions", [
        dict(customer_id="C1"), dict(customer_id="C2")]), AS_OF)
    eligible = upselling.eligible_customers(cust, subs, cfg).collect()
    assert [e.customer_id for e in eligible] == ["C2"]


def test_as_of_defaults_to_today(spark):
    from pyspark.sql import functions as F
    cust = staging.stg_customers(frame(spark, "customers", [dict(customer_id="C1")]))
    row = cust.select("tenure_days", F.datediff(F.current_date(), "signup_date")).first()
    assert row[0] == row[1]
