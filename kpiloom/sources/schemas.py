"""Fixed source schemas.  Dates arrive as text and are cast in staging."""

from pyspark.sql import types as T

_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(name, typ, True) for name, typ in cols])


SOURCE_SCHEMAS = {
    "customers": _schema(
        ("customer_id", _S), ("customer_name", _S), ("country", _S), ("segment", _S),
        ("signup_date", _S), ("plan_type", _S), ("monthly_revenue", _L), ("partner_id", _S)),
    "subscriptions": _schema(
        ("subscription_id", _S), ("customer_id", _S), ("plan_type", _S), ("start_date", _S),
        ("end_date", _S), ("churn_date", _S), ("churn_reason", _S), ("mrr", _L), ("country", _S)),
    "leads": _schema(
        ("lead_id", _S), ("customer_id", _S), ("country", _S), ("service_type", _S),
        ("lead_date", _S), ("assigned_at", _S), ("converted_at", _S), ("lead_status", _S),
        ("lead_source", _S)),
    "invoices": _schema(
        ("invoice_id", _S), ("customer_id", _S), ("issue_date", _S), ("due_date", _S),
        ("paid_date", _S), ("amount", _L), ("currency", _S), ("status", _S), ("country", _S)),
    "partners": _schema(
        ("partner_id", _S), ("partner_name", _S), ("country", _S), ("partner_type", _S),
        ("contract_start_date", _S), ("monthly_fee", _L), ("commission_rate", _D),
        ("status", _S)),
    "nps_surveys": _schema(
        ("survey_id", _S), ("customer_id", _S), ("survey_date", _S), ("nps_score", _L),
        ("csat_score", _L), ("country", _S), ("comment", _S)),
    "upsell_events": _schema(
        ("upsell_id", _S), ("customer_id", _S), ("upsell_date", _S), ("from_plan", _S),
        ("to_plan", _S), ("add_on", _S), ("add_on_revenue", _L), ("sales_rep", _S),
        ("country", _S)),
}

# Columns that staging casts to dates.
DATE_COLUMNS = {
    "customers": ("signup_date",),
    "subscriptions": ("start_date", "end_date", "churn_date"),
    "leads": ("lead_date", "assigned_at", "converted_at"),
    "invoices": ("issue_date", "due_date", "paid_date"),
    "partners": ("contract_start_date",),
    "nps_surveys": ("survey_date",),
    "upsell_events": ("upsell_date",),
}

SOURCE_NAMES = tuple(SOURCE_SCHEMAS)
