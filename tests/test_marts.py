"""Mart semantics on hand-built edge rows (FIXTURES.md §3)."""

import datetime as dt

from pyspark.sql import functions as F

from kpiloom.functions.kpi import month_start, round_ratio
from kpiloom.operators import churn, debt, partners, satisfaction, staging, supply_demand
from kpiloom.operators.union import conform, union_records
from kpiloom.plans.marts import build_marts
from rows import sources

AS_OF = dt.date(2024, 4, 1)

def nps_from_enriched(enriched):
    """The same aggregate read directly off the enriched (fanned-out) rows."""
    cat = F.col("nps_category")
    total = F.count(F.lit(1))
    promoters, detractors = F.count_if(cat == "promoter"), F.count_if(cat == "detractor")
    nps, csat = F.col("nps_score"), F.col("csat_score")
    return (enriched
            .withColumn("month", month_start("survey_date"))
            .groupBy("month", "country", "segment", "plan_type")
            .agg(total.alias("survey_responses"),
                 promoters.alias("promoters"),
                 F.count_if(cat == "passive").alias("passives"),
                 detractors.alias("detractors"),
                 round_ratio(promoters - detractors, total, 1, 100).alias("nps_score"),
                 round_ratio(F.count_if(F.col("is_satisfied")), total, 1, 100).alias("csat_pct"),
                 round_ratio(F.sum(nps), F.count(nps), 2).alias("avg_nps_raw"),
                 round_ratio(F.sum(csat), F.count(csat), 2).alias("avg_csat_raw"),
                 F.sum(F.when(cat == "detractor", F.col("mrr")).otherwise(0))
                 .alias("detractor_mrr_at_risk"),
                 F.sum("mrr").alias("total_surveyed_mrr")))


def debt_by_parts(inv, cust):
    """The same mart as the union of its three parts (a plan per record type)."""
    enriched = debt.enriched_invoices(inv, cust)
    summary = conform(debt.debt_summary(enriched), debt.MART_DEBT_COLUMNS,
                      record_type="'monthly_debt_summary'")
    n, amt = "invoice_count", "total_amount"
    aging = conform(debt.aging_breakdown(enriched), debt.MART_DEBT_COLUMNS,
                    record_type="'aging_breakdown'",
                    total_invoices=n, total_invoiced=amt, overdue_count=n, overdue_amount=amt)
    n, amt = "overdue_invoice_count", "total_overdue_amount"
    debtors = conform(debt.high_risk_debtors(inv, cust), debt.MART_DEBT_COLUMNS,
                      record_type="'high_risk_debtors'",
                      total_invoices=n, total_invoiced=amt, overdue_count=n,
                      overdue_amount=amt, avg_days_overdue="max_days_overdue",
                      aging_bucket="worst_aging_bucket")
    return union_records([summary, aging, debtors])


def staged(spark, **tables):
    return staging.stage_all(sources(spark, **tables), as_of=AS_OF)


def test_supply_sla_and_gap(spark):
    leads = [dict(country="DK", assigned_at="2024-01-06"),          # 24 h: no breach
             dict(country="DK", assigned_at="2024-01-07")]          # 48 h: breach
    leads += [dict(country="NO", assigned_at="", lead_status=" unassigned")]  # none assigned
    # exactly 10 % unassigned: not a gap; 2 of 10 would be
    leads += [dict(country="SE", lead_status=" unassigned", assigned_at="")]
    leads += [dict(country="SE") for _ in range(9)]
    st = staged(spark, leads=leads)
    rows = {r.country: r for r in supply_demand.mart_supply_demand(st["leads"]).collect()}
    assert rows["DK"].sla_breaches == 1 and rows["DK"].sla_breach_rate_pct == 50.0
    assert rows["DK"].avg_hours_to_assign == 36.0
    assert rows["NO"].sla_breach_rate_pct is None and rows["NO"].has_supply_gap
    assert rows["NO"].assignment_rate_pct == 0.0
    assert rows["SE"].unassigned_rate_pct == 10.0 and rows["SE"].has_supply_gap is False


def test_at_risk_scores_and_fanout(spark):
    st = staged(
        spark,
        customers=[dict(customer_id="C1"), dict(customer_id="C2")],
        subscriptions=[dict(customer_id="C1", start_date="2020-01-01"),
                       dict(customer_id="C2", start_date="2024-03-20")],  # tenure 12 days
        nps_surveys=[dict(customer_id="C1", nps_score=3), dict(customer_id="C1", nps_score=10),
                     dict(customer_id="C2", nps_score=2)],
        invoices=[dict(customer_id="C1", status="overdue", due_date="2024-03-01"),
                  dict(customer_id="C1", status="overdue", due_date="2024-02-01"),
                  dict(customer_id="C2", status="overdue", due_date="2024-03-01")])
    every = spark.createDataFrame([("C1", 1, 2, 2), ("C2", 1, 1, 1)],
                                  "customer_id string, n_active long, n_surveys long, n_overdue long")
    for hot in (None, every):   # plain joins, and keys split into single-row slices
        risk = churn.at_risk_customers(st["cust"], st["subs"], st["surv"], st["inv"],
                                       as_of=AS_OF, hot=hot, hot_rows=1).collect()
        c1 = sorted(r.risk_score for r in risk if r.customer_id == "C1")
        c2 = [(r.risk_score, r.churn_risk_level) for r in risk if r.customer_id == "C2"]
        assert c1 == [2, 2, 5, 5]            # two surveys × two overdue invoices
        assert c2 == [(6, "high")]           # detractor + overdue + new subscription


def test_partner_without_customers(spark):
    st = staged(spark, partners=[dict(partner_id="P1", monthly_fee=12000),
                                 dict(partner_id="P2", monthly_fee=0)])
    rows = {r.partner_id: r for r in partners.mart_roi_partnerships(
        st["part"], st["cust"], st["subs"], st["leads"], AS_OF).collect()}
    p1, p2 = rows["P1"], rows["P2"]
    assert (p1.total_customers, p1.active_mrr, p1.partner_leads) == (0, 0, 0)
    assert p1.roi_pct == -100.0 and p1.payback_period_months is None
    assert p1.cost_per_acquired_customer is None and p1.total_monthly_cost == 12000.0
    assert p2.roi_pct is None


def test_partner_revenue_with_duplicate_partner_rows(spark):
    """Pre-aggregating before the partner join keeps the row-level join's counts."""
    st = staged(spark,
                customers=[dict(customer_id="C1", partner_id="P1")],
                subscriptions=[dict(customer_id="C1", mrr=1000),
                               dict(customer_id="C1", mrr=500, churn_date="2023-01-01",
                                    end_date="2023-01-01")],
                partners=[dict(partner_id="P1", commission_rate=0.12),
                          dict(partner_id="P1", commission_rate=0.1)])
    r = partners.partner_revenue(st["cust"], st["subs"], st["part"], AS_OF).first()
    assert (r.total_customers, r.active_customers, r.churned_customers) == (1, 2, 2)
    assert (r.active_mrr, r.total_mrr_ever) == (2000, 3000)
    assert r.monthly_commission_owed == 240.0      # 2000 × max rate 0.12


def test_debtor_worst_bucket_is_lexical(spark):
    st = staged(spark, customers=[dict(customer_id="C1")],
                invoices=[dict(customer_id="C1", status="overdue", due_date="2023-10-01"),
                          dict(customer_id="C1", status="overdue", due_date="2024-04-20")])
    r = debt.high_risk_debtors(st["inv"], st["cust"]).first()
    assert r.worst_aging_bucket == "current" and r.max_days_overdue == 183


def test_response_rate_and_active_detractor(spark):
    st = staged(spark,
                customers=[dict(customer_id="C1", country="DK"),
                           dict(customer_id="C2", country="DK"),
                           dict(customer_id="C3", country="NO")],
                subscriptions=[dict(customer_id="C1")],
                nps_surveys=[dict(customer_id="C1", nps_score=2),
                             dict(customer_id="C1", nps_score=9),
                             dict(customer_id="C3", nps_score=1)])
    rate = {r.country: r for r in satisfaction.response_rate(st["cust"], st["surv"]).collect()}
    assert (rate["DK"].surveyed_customers, rate["DK"].active_customers) == (1, 1)
    assert (rate[None].surveyed_customers, rate[None].active_customers) == (0, 1)
    assert rate[None].response_rate_pct == 0.0 and rate["NO"].response_rate_pct == 100.0
    det = {r.customer_id: r.is_active_detractor
           for r in satisfaction.detractor_detail(st["surv"], st["cust"], st["subs"]).collect()}
    assert det == {"C1": True, "C3": None}


def test_nps_rollup_equals_fanned_out_rows(spark, sf_small):
    """Weighted rollup == aggregate over the enriched rows, incl. null-MRR edges."""
    import collections
    st = staged(
        spark,
        customers=[dict(customer_id="C1", monthly_revenue=None),
                   dict(customer_id="C2", monthly_revenue=None),
                   dict(customer_id="C3"), dict(customer_id="C3", segment="ENT")],
        subscriptions=[dict(customer_id="C1"), dict(customer_id="C1"),
                       dict(customer_id="C3"), dict(customer_id="C3"),
                       dict(customer_id="C3", churn_date="2023-01-01", end_date="2023-01-01")],
        nps_surveys=[dict(customer_id="C1", nps_score=2), dict(customer_id="C1", nps_score=9),
                     dict(customer_id="C2", nps_score=1), dict(customer_id="C3", nps_score=5),
                     dict(customer_id="C3", nps_score=None, survey_date="2024-02-03"),
                     dict(customer_id="C9", nps_score=8)])
    from kpiloom.plans.registry import staged as staged_tables
    for frames in (st, staged_tables(spark, sf_small)):
        s, c, u = frames["surv"], frames["cust"], frames["subs"]
        rows = nps_from_enriched(satisfaction.enriched_surveys(s, c, u))
        fast = satisfaction.nps_monthly(s, c, u)
        bag = lambda df: collections.Counter(tuple(r) for r in df.select(sorted(df.columns))
                                             .collect())
        assert bag(fast) == bag(rows)


def test_marts_keep_contract_columns(spark):
    marts = build_marts(sources(spark), as_of=AS_OF)
    widths = {name: len(df.columns) for name, df in marts.items()}
    assert widths == {"mart_supply_demand": 17, "mart_churn": 22, "mart_upselling": 17,
                      "mart_roi_partnerships": 23, "mart_debt_collection": 24,
                      "mart_customer_satisfaction": 26}


def test_presentation_order_sorts_nulls_high(spark):
    from kpiloom.plans.marts import present
    st = staged(spark, partners=[dict(partner_id="P1", monthly_fee=12000),
                                 dict(partner_id="P2", monthly_fee=0),
                                 dict(partner_id="P3", monthly_fee=500)],
                customers=[dict(customer_id="C1", partner_id="P3")],
                subscriptions=[dict(customer_id="C1", mrr=1000)])
    roi = partners.mart_roi_partnerships(st["part"], st["cust"], st["subs"], st["leads"], AS_OF)
    order = [(r.partner_id, r.roi_pct) for r in present(roi, "mart_roi_partnerships").collect()]
    assert order[0] == ("P2", None)                  # roi desc, nulls first
    assert [p for p, _ in order[1:]] == ["P3", "P1"]

    st = staged(spark, customers=[dict(customer_id="C1")],
                subscriptions=[dict(customer_id="C1"),
                               dict(customer_id="C1", churn_date="2023-05-02",
                                    end_date="2023-05-02", churn_reason="competitor")],
                nps_surveys=[dict(customer_id="C1", nps_score=2)])
    churn_rows = present(churn.mart_churn(st["cust"], st["subs"], st["surv"], st["inv"],
                                          as_of=AS_OF), "mart_churn").collect()
    kinds = [(r.record_type, r.month) for r in churn_rows]
    assert kinds[0][0] == "at_risk_customer" and kinds[0][1] is None
    assert [m for k, m in kinds if k == "monthly_churn_summary"] == [
        dt.date(2024, 4, 1), dt.date(2023, 5, 1)]       # month desc


def test_response_rate_matches_row_level_form_with_duplicate_customers(spark):
    """Distinct pairs give the row-level join's distinct counts, duplicates included."""
    from pyspark.sql import functions as F
    st = staged(spark,
                customers=[dict(customer_id="C1", country="DK"),
                           dict(customer_id="C1", country="NO"),
                           dict(customer_id="C2", country="SE"),
                           dict(customer_id="C3", country=None)],
                subscriptions=[dict(customer_id="C1"), dict(customer_id="C1")],
                nps_surveys=[dict(customer_id="C1"), dict(customer_id="C1"),
                             dict(customer_id="C3"), dict(customer_id="C9")])
    enriched = satisfaction.enriched_surveys(st["surv"], st["cust"], st["subs"])
    c = st["cust"].select("customer_id")
    sv = enriched.select(F.col("customer_id").alias("sv_id"), "country")
    reference = (c.join(sv, c.customer_id == sv.sv_id, "left").groupBy("country")
                 .agg(F.countDistinct("sv_id").alias("s"), F.countDistinct("customer_id")
                      .alias("a")))
    want = {r.country: (r.s, r.a) for r in reference.collect()}
    got = {r.country: (r.surveyed_customers, r.active_customers)
           for r in satisfaction.response_rate(st["cust"], st["surv"]).collect()}
    assert got == want


def test_debt_grouping_sets_equal_the_three_parts(spark, sf_small):
    import collections
    st = staged(spark,
                customers=[dict(customer_id="C1"), dict(customer_id="C2", segment="ENT")],
                invoices=[dict(customer_id="C1", status="overdue", due_date="2024-01-10"),
                          dict(customer_id="C1", status="overdue", due_date="2024-04-20"),
                          dict(customer_id="C1", status="paid"),
                          dict(customer_id="C2", status="paid_late", paid_date="2024-02-05"),
                          dict(customer_id="C9", status="overdue", amount=None),
                          dict(customer_id="C9", status="paid", amount=None),
                          dict(customer_id="C2", status=None)])
    from kpiloom.plans.registry import staged as staged_tables
    for frames in (st, staged_tables(spark, sf_small)):
        one = debt.mart_debt_collection(frames["inv"], frames["cust"])
        parts = debt_by_parts(frames["inv"], frames["cust"])
        bag = lambda df: collections.Counter(tuple(r) for r in df.collect())
        assert one.columns == parts.columns
        assert bag(one) == bag(parts)


def test_presentation_sort_spreads_ties(spark, staged_small):
    """At-risk rows share their declared sort keys; tiebreakers let a range
    partitioning spread them instead of one partition per key value."""
    from pyspark.sql import functions as F
    from kpiloom.plans.marts import present
    mart = churn.mart_churn(staged_small["cust"], staged_small["subs"], staged_small["surv"],
                            staged_small["inv"], as_of=AS_OF)
    saved = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = (present(mart, "mart_churn").filter("record_type = 'at_risk_customer'")
                 .select(F.spark_partition_id().alias("p")).distinct().count())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", saved)
    assert parts > 3


def test_attach_rate_equals_the_row_form(spark, staged_small):
    """Weighted by active subscriptions == counted over the eligible rows."""
    from pyspark.sql import functions as F
    from kpiloom.operators import upselling
    st = staged_small
    rows = upselling.eligible_customers(st["cust"], st["subs"]).join(
        upselling.upsold_customers(st["ups"]).withColumn("u", F.lit(1)), "customer_id", "left")
    want = {(r.country, r.segment): (r.n, r.u, r.m) for r in rows.groupBy("country", "segment").agg(
        F.count("*").alias("n"), F.count("u").alias("u"), F.sum("mrr").alias("m")).collect()}
    got = {(r.country, r.segment): (r.eligible_count, r.upsold_count, r.eligible_mrr_base)
           for r in upselling.attach_rate_by_segment(st["cust"], st["subs"], st["ups"]).collect()}
    assert got == want and want


def test_full_precision_of_rates_and_shares(spark):
    from kpiloom.config import KpiConfig
    from kpiloom.functions.kpi import decimal_sql
    from kpiloom.operators import upselling
    assert [decimal_sql(x) for x in ("0.9", "0.125", "2", "1E+2", "12.50")] == [
        "CAST('0.9' AS DECIMAL(2,1))", "CAST('0.125' AS DECIMAL(4,3))", "CAST('2' AS DECIMAL(1,0))",
        "CAST('100' AS DECIMAL(3,0))", "CAST('12.50' AS DECIMAL(4,2))"]
    st = staged(spark, partners=[dict(partner_id="P1", commission_rate=0.1234567)],
                customers=[dict(customer_id="C1", partner_id="P1")],
                subscriptions=[dict(customer_id="C1", mrr=100_000_000)],
                upsell_events=[dict(customer_id="C1")])
    roi = partners.mart_roi_partnerships(st["part"], st["cust"], st["subs"], st["leads"], AS_OF).first()
    assert roi.monthly_commission_owed == 12345670.0
    import dataclasses
    cfg = dataclasses.replace(KpiConfig(), upsell_opportunity_share="0.125")
    row = upselling.attach_rate_by_segment(st["cust"], st["subs"], st["ups"], cfg).first()
    assert row.estimated_upsell_opportunity_mrr == 125.0


def hot_customer_tables(spark):
    """Half of all subscriptions and invoices belong to one customer."""
    subs = [dict(customer_id="C1" if i % 2 else f"C{2 + i % 40}", mrr=100 + i) for i in range(400)]
    inv = [dict(customer_id="C1" if i % 2 else f"C{2 + i % 40}", status="overdue", amount=10 + i,
                due_date="2024-01-10") for i in range(400)]
    cust = [dict(customer_id=f"C{i}", partner_id=f"P{i % 3}") for i in range(1, 45)]
    return staged(spark, customers=cust, subscriptions=subs, invoices=inv,
                  partners=[dict(partner_id=f"P{i}") for i in range(3)])


def test_hot_customer_meets_the_dimension_as_one_row(spark):
    """Raw rows of a hot customer are summed before the join: what the join reads is
    one row per customer, whatever the number of its subscriptions or invoices."""
    st = hot_customer_tables(spark)
    for df in (partners.partner_revenue(st["cust"], st["subs"], st["part"], AS_OF),
               debt.high_risk_debtors(st["inv"], st["cust"])):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        lines = plan.splitlines()
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        join = next(i for i, line in enumerate(lines) if "Join" in line and "customer_id" in line)
        below = [line for line in lines[join + 1:] if depth(line) > depth(lines[join])]
        assert any("Aggregate [customer_id" in line for line in below), plan
    rows = debt.high_risk_debtors(st["inv"], st["cust"]).collect()
    hot = next(r for r in rows if r.customer_id == "C1")
    assert hot.overdue_invoice_count == 200 and hot.total_overdue_amount == sum(10 + i for i in range(1, 400, 2))
    want = debt.enriched_invoices(st["inv"], st["cust"]).filter("is_currently_overdue").count()
    assert sum(r.overdue_invoice_count for r in rows) == want
