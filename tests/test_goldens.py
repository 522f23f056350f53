"""Hand-derived values: own seed-shaped rows whose results were worked out on paper."""

import datetime as dt

import pytest

from kpiloom.operators import debt, partners, satisfaction, staging, upselling
from kpiloom.plans.marts import MART_ORDER, build_marts, present
from rows import sources

AS_OF = dt.date(2024, 4, 1)


def staged(spark, **tables):
    return staging.stage_all(sources(spark, **tables), as_of=AS_OF)


def test_partner_with_four_active_customers(spark):
    """MRR 21450 over 4 customers and 185 months in all: LTV 5362.5 * 46.25."""
    mrr = [9000, 6000, 4000, 2450]
    start = ["2019-08-01", "2020-03-15", "2020-05-09", "2021-07-30"]  # 56 + 49 + 47 + 33 = 185
    st = staged(
        spark, partners=[dict(partner_id="P5", contract_start_date="2017-11-01", monthly_fee=22000, commission_rate=0.09)],
        customers=[dict(customer_id=f"C{i}", partner_id="P5") for i in range(4)],
        subscriptions=[dict(customer_id=f"C{i}", mrr=m, start_date=s) for i, (m, s) in enumerate(zip(mrr, start))])
    r = partners.mart_roi_partnerships(st["part"], st["cust"], st["subs"], st["leads"], AS_OF).first()
    assert (r.total_customers, r.active_customers, r.churned_customers) == (4, 4, 0)
    assert (r.active_mrr, r.total_mrr_ever) == (21450, 21450)
    assert r.estimated_avg_ltv == 248015.63  # 248015.625, half away from zero
    assert r.monthly_commission_owed == 1930.5
    assert (r.total_monthly_cost, r.net_monthly_value, r.roi_pct) == (23930.5, -2480.5, -10.37)
    assert (r.partner_tenure_months, r.payback_period_months, r.cost_per_acquired_customer) == (77, 79.0, 423500.0)


def test_debt_of_one_market_and_month(spark):
    st = staged(spark, customers=[dict(customer_id="C1"), dict(customer_id="C2")], invoices=[
        dict(customer_id="C1", amount=1200, status="paid", paid_date="2024-01-28"),
        dict(customer_id="C2", amount=550, status="overdue")])
    r = debt.debt_summary(debt.enriched_invoices(st["inv"], st["cust"])).first()
    assert (r.total_invoices, r.total_invoiced, r.overdue_amount) == (2, 1750, 550)
    assert (r.overdue_rate_pct, r.recovery_rate_pct, r.dso_days, r.avg_days_overdue) == (50.0, 0.0, 9.4, 61.0)


def test_overdue_total_and_worst_buckets(spark):
    amounts = {"C1": 600, "C2": 550, "C3": 640, "C4": 700, "C5": 580, "C6": 520}
    due = {"C1": "2024-01-31", "C2": "2024-01-31", "C3": "2024-01-31", "C4": "2024-02-29", "C5": "2024-02-29", "C6": "2024-03-31"}
    st = staged(spark, customers=[dict(customer_id=c) for c in amounts], invoices=[
        dict(customer_id=c, amount=a, status="overdue", due_date=due[c]) for c, a in amounts.items()])
    rows = {r.customer_id: r for r in debt.high_risk_debtors(st["inv"], st["cust"]).collect()}
    assert sum(r.total_overdue_amount for r in rows.values()) == 3590
    assert [rows[c].max_days_overdue for c in amounts] == [61, 61, 61, 32, 32, 1]
    assert [rows[c].worst_aging_bucket for c in amounts] == ["61-90 days"] * 3 + ["31-60 days"] * 2 + ["1-30 days"]


@pytest.mark.parametrize("mrr,opportunity", [(580, 522.0), (640, 576.0)])
def test_upsell_opportunity(spark, mrr, opportunity):
    st = staged(spark, customers=[dict(customer_id="C1", monthly_revenue=mrr)],
                subscriptions=[dict(customer_id="C1")], upsell_events=[dict(customer_id="C1")])
    r = upselling.attach_rate_by_segment(st["cust"], st["subs"], st["ups"]).first()
    assert (r.eligible_count, r.upsold_count, r.upsell_attach_rate_pct) == (1, 1, 100.0)
    assert r.estimated_upsell_opportunity_mrr == opportunity


def test_two_unhappy_responses(spark):
    st = staged(spark, customers=[dict(customer_id="C1", monthly_revenue=550), dict(customer_id="C2", monthly_revenue=530)],
                subscriptions=[dict(customer_id="C1"), dict(customer_id="C2")], nps_surveys=[
        dict(customer_id="C1", nps_score=2, csat_score=1, survey_date="2024-02-10"),
        dict(customer_id="C2", nps_score=3, csat_score=2, survey_date="2024-02-20")])
    r = satisfaction.nps_monthly(st["surv"], st["cust"], st["subs"]).first()
    assert (r.survey_responses, r.nps_score, r.csat_pct, r.avg_nps_raw, r.avg_csat_raw) == (2, -100.0, 0.0, 2.5, 1.5)
    assert r.detractor_mrr_at_risk == 1080


def test_every_mart_is_presented_in_its_order(spark, sf_small):
    """Rows of each mart, read in partition order, follow its declared keys."""
    from kpiloom.sources.driver_tables import load_sources
    for name, mart in build_marts(load_sources(spark, sf_small), as_of=AS_OF).items():
        rows = present(mart, name).collect()
        keys = []
        for r in rows:
            key = []
            for column, direction, nulls in MART_ORDER[name]:
                value = r[column]
                if isinstance(value, dt.date):
                    value = value.toordinal()
                first = value is None and nulls == "first"
                last = value is None and nulls == "last"
                key.append((0 if first else 2 if last else 1, Reversed(value) if direction == "desc" else value)
                           if value is not None else (0 if first else 2, 0))
            keys.append(tuple(key))
        assert keys == sorted(keys), name
        assert len(rows) > 1


class Reversed:
    """Orders values the other way round."""

    def __init__(self, value):
        self.value = value

    def __lt__(self, other):
        return other.value < self.value

    def __eq__(self, other):
        return self.value == other.value
