"""Hand-built source rows for edge-case tests (dates as ISO text, like the seeds)."""

from kpiloom.sources.schemas import SOURCE_SCHEMAS

DEFAULTS = {
    "customers": dict(customer_name="Acme ApS", country="DK", segment="SMB",
                      signup_date="2021-03-15", plan_type="basic", monthly_revenue=1000,
                      partner_id=None),
    "subscriptions": dict(plan_type="basic", start_date="2021-03-15", end_date="",
                          churn_date="", churn_reason=" ", mrr=1000, country="DK"),
    "leads": dict(customer_id="C1", country="DK", service_type="accounting",
                  lead_date="2024-01-05", assigned_at="2024-01-05", converted_at="",
                  lead_status="pending", lead_source="organic"),
    "invoices": dict(customer_id="C1", issue_date="2024-01-01", due_date="2024-01-31",
                     paid_date="", amount=1000, currency="DKK", status="paid", country="DK"),
    "partners": dict(partner_name="Partner", country="DK", partner_type="accounting_firm",
                     contract_start_date="2019-01-01", monthly_fee=15000, commission_rate=0.1,
                     status="active"),
    "nps_surveys": dict(customer_id="C1", survey_date="2024-01-15", nps_score=8, csat_score=4,
                        country="DK", comment="ok"),
    "upsell_events": dict(customer_id="C1", upsell_date="2024-02-15", from_plan="basic",
                          to_plan="premium", add_on="", add_on_revenue=500, sales_rep="SR01",
                          country="DK"),
}

KEYS = {"customers": "customer_id", "subscriptions": "subscription_id", "leads": "lead_id",
        "invoices": "invoice_id", "partners": "partner_id", "nps_surveys": "survey_id",
        "upsell_events": "upsell_id"}


def frame(spark, name, rows):
    """A source frame from partial row dicts (missing fields take defaults)."""
    schema = SOURCE_SCHEMAS[name]
    full = []
    for i, r in enumerate(rows):
        row = dict(DEFAULTS[name])
        row[KEYS[name]] = f"{name[:2].upper()}{i}"
        row.update(r)
        full.append(tuple(row.get(f.name) for f in schema.fields))
    return spark.createDataFrame(full, schema)


def sources(spark, **tables):
    """All seven sources; unspecified tables are empty."""
    return {name: frame(spark, name, tables.get(name, [])) for name in SOURCE_SCHEMAS}
